import random

import numpy as np
import pyarrow as pa
import pytest

from pactframe.llm import common

ODD = ["", None, " ", "a", " a", "a ", "é\xa0b\x85c", "\t\n\x0b\x0c\r x", "x" * 64, "x" * 65, "y " + "z" * 200_000 + " w", "Ab aB", "\x1c a", "a\x00b"]


@pytest.mark.parametrize("block", [7, common.BLOCK])
@pytest.mark.parametrize("lower", [False, True])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string(), pa.binary()])
def test_equal_words_and_only_they_have_equal_hashes(monkeypatch, block, lower, kind):
    monkeypatch.setattr(common, "BLOCK", block)
    dice = random.Random(block)
    texts = ODD + ["".join(dice.choice("ab C\n") for _ in range(dice.randint(0, 9))) for _ in range(200)]
    met = {}
    for some in (texts, texts[3:], texts[:0], [None, None]):
        for cut in (0, 2):
            # a slice shares the buffers of the whole array
            got = pa.array([None if t is None else t.encode() for t in some], pa.binary()).cast(kind).slice(cut)
            hashes, lengths = common.word_hashes(got, lower)
            words = [common.words_of(t, lower) for t in some[cut:]]
            assert lengths.tolist() == [len(w) for w in words]
            for word, h in zip((w for text in words for w in text), hashes.tolist(), strict=True):
                assert met.setdefault(word, h) == h
    assert len(set(met.values())) == len(met)


def test_no_memory_is_kept_per_word():
    """Words of a corpus are all new in the worst case; nothing of them stays in the worker, whatever their number."""
    tracemalloc = pytest.importorskip("tracemalloc")
    texts = pa.array([" ".join(f"w{k * 500 + i}" for i in range(500)) for k in range(400)])
    common.word_hashes(texts)  # the powers are kept
    tracemalloc.start()
    hashes, _ = common.word_hashes(texts)
    assert len(np.unique(hashes)) == 200_000
    del hashes
    kept, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept < 1e6
