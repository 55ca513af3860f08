import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pactframe.llm import fill_middle as fim

ODD = [None, "", "a", "é", "\n\n", "ab cd", "keep <P> plain", "<S>", "x <M", "P><P", "<<<", "a\u0000b c", "😀 emoji 😀x", "word " * 50_000, "a" * 300_000]


def expected(doc_id, text, seed=1):
    """By the plain rule: units by findall, joined again."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def corpus():
    dice = random.Random(7)
    docs = [(k, "".join(dice.choice("abXZ <>PSM\né.,") for _ in range(dice.randint(0, 60)))) for k in range(400)]
    docs += [(1000 + k, t) for k, t in enumerate(ODD)]
    return docs + [(None, "no id at all"), (None, None), (3, "twice"), (3, "twice"), (-5, "below zero id")]


def test_against_the_plain_rule(frame):
    docs = corpus()
    got = fim.fill_in_middle(frame(docs, extra=True)).collect()
    want = [(i, *expected(i, t)) for i, t in docs]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_every_text_is_rebuilt(frame):
    docs = corpus()
    made = fim.fill_in_middle(frame(docs), seed=9).withColumn("back", fim.restored(F.col("form"), F.col("output")))
    got = [(r.doc_id, r.back) for r in made.select("doc_id", "back").collect()]
    assert sorted(map(repr, got)) == sorted(repr((i, t or "")) for i, t in docs)


def test_digests_hash_output_and_text(frame):
    docs = [(k, t) for k, t in corpus() if k is not None][:300]
    got = {r.doc_id: r for r in fim.digests(frame(docs)).collect()}
    for i, t in docs:
        assert got[i].output_sha256 == hashlib.sha256(expected(i, t)[4].encode()).hexdigest()
        assert got[i].restored_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
def test_blocks_give_the_ends_of_one_match(block):
    dice = random.Random(block)
    for _ in range(200):
        text = "".join(dice.choice("abc é\n1") for _ in range(dice.randint(0, 40)))
        ends = [e for part in fim.unit_ends(text, block) for e in part.tolist()]
        assert ends == [m.end() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
        assert [fim.end_of(fim.unit_ends(text, block), k) for k in range(len(ends) + 1)] == [0, *ends]


def test_text_beyond_a_block():
    text = "ab, é" * 700_000
    n, form, prefix, _, output = expected(4, text)
    parts = fim.split_text(4, text, 1)
    assert (parts.n, parts.form, len(parts.prefix)) == (n, form, prefix)
    assert fim.arrange(text, parts) == output


def test_empty(frame):
    assert fim.digests(frame([])).collect() == []
