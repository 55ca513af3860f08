import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pactframe.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY, OURS = Tokenizer.from_file(PATH), packing.Encoder(PATH)


def ids_of(text: str) -> list[int]:
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text",
    ["", " ", "a b", "a  b", " a", "a ", "a\n b", "a \nb", "x\x1c y", "x \x85y", "it's <|endoftext|> here", "<|endoftext|> a",
     "a\0 b", "a　 b", "a᠎ b ​ c", "\t\t x\r\n y", "\x1c\x1d \x85", "a" * 3000, " " * 900 + "x", "é ́x  12 34, 5"],
)
def test_ids_are_the_librarys(text):
    assert np.frombuffer(OURS.encode(text), "<u4").tolist() == ids_of(text)


@settings(max_examples=1000, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x3100, exclude_categories=["Cs"]) | st.sampled_from(" \n\t"), max_size=40))
def test_any_text_has_the_librarys_ids(text):
    assert np.frombuffer(OURS.encode(text), "<u4").tolist() == ids_of(text)


def test_the_quick_loop_is_used_and_agrees_on_all_texts():
    import duckdb

    assert OURS.quick is not None
    texts = duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' UNION ALL SELECT html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()
    for (text,) in texts:
        assert np.frombuffer(OURS.encode(text), "<u4").tolist() == ids_of(text)


def check_packed(got, docs, capacity=1024):
    """Every document in whole pieces, every sequence gapless from 0 and not too long."""
    want = []
    for doc_id, text in docs:
        ids = [*ids_of(text), 2]
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want.append((doc_id, k, a, b - a, zlib.crc32(np.asarray(ids[a:b], "<u4").tobytes())))
    assert Counter(want) == Counter(tuple(r[:5]) for r in got)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = packing.pack(spark, docs, PATH).collect()
    used = check_packed(got, [(r.doc_id, r.text) for r in docs.collect()])
    least = -(-sum(r.length for r in got) // 1024)
    assert used <= least * 1.01 + 1


def test_edges(spark, frame):
    docs = [(1, None), (1, None), (None, "no id"), (2, ""), (3, "word " * 5000), (3, "word " * 5000), (4, "a b " * 511 + "a")]
    check_packed(packing.pack(spark, frame(docs, extra=True), PATH).collect(), docs)
    assert packing.pack(spark, frame([]), PATH).collect() == []


def test_parts_of_a_length_are_numbered_without_holes(spark):
    pieces = spark.createDataFrame([(k % 50, k, 0, 7 if k % 3 else 1024, k) for k in range(999)], packing.PIECES)
    got = packing.ranked(pieces, part_rows=100).collect()
    for length in (7, 1024):
        ranks = sorted(r["rank"] for r in got if r.length == length)
        assert ranks == list(range(len(ranks)))


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_and_few_sequences(seed):
    dice = random.Random(seed)
    sizes = [min(1024, max(1, int(dice.lognormvariate(5, 1.2)))) for _ in range(dice.choice([1, 30, 5000]))]
    histogram = dict(Counter(sizes))
    made = packing.plan(histogram)
    used = Counter()
    for lengths, n in made:
        assert sum(lengths) <= 1024
        for x in lengths:
            used[x] += n
    assert used == Counter(histogram)
    bins = []  # best-fit decreasing over single pieces
    for x in sorted(sizes, reverse=True):
        fit = min((b for b in bins if b[0] >= x), default=None)
        if fit is None:
            bins.append([1024 - x])
        else:
            fit[0] -= x
    assert sum(n for _, n in made) <= len(bins)
