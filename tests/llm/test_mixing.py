import random
from collections import Counter

import duckdb
import pandas as pd
import pytest

from pactframe.llm import mixing


def corpus():
    dice = random.Random(4)
    docs = [(k, "w " * dice.choice([0, 1, 3, 50, 900]), dice.choice(["a", "b", "c", "é", "Z", "z10", "z9"])) for k in range(400)]
    docs += [(1000 + k, "hot " * 40, "hot") for k in range(300)]
    return docs + [(2000, None, "a"), (2001, "x y", None), (None, "p q r", "a"), (None, "p q r", "b"), (5, "twice", "a"), (5, "twice", "a"), (2002, "", "empty")]


def sql(docs):
    with duckdb.connect() as db:
        db.register("documents", pd.DataFrame(docs, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
        return db.execute(mixing.MIX_SQL).fetchall()


def test_against_sql_on_odd_rows(frame):
    docs = corpus()
    key = lambda r: tuple((x is not None, x) for x in r)
    got = sorted((tuple(r) for r in mixing.mix_sources(frame(docs, extra=True)).collect()), key=key)
    want = sorted(sql(docs), key=key)
    assert [r[:3] + r[4:] for r in got] == [tuple(r[:3]) + tuple(r[4:]) for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])


def test_targets_by_resharing(frame):
    docs = corpus()
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len((text or "").split())
    left = {s: 1 + k % 3 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    want, total = {}, sum(sizes.values())
    while left:
        level = (total - sum(want.values())) / sum(left.values())
        full = [s for s, w in left.items() if level * w >= 3 * sizes[s]]
        for s in full or list(left):
            want[s] = min(3.0 * sizes[s], level * left[s])
            del left[s]
    got = {r.skey[1:] if r.skey != "-" else None: r.target for r in mixing.targets(mixing.size_table(frame(docs))).collect()}
    assert got == pytest.approx(want)


def test_taken_is_near_the_target_and_repeats(frame):
    docs = corpus()
    got = mixing.mix_sources(frame(docs)).collect()
    again = mixing.mix_sources(frame(docs[::-1])).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert all(r.taken <= 3 * r["size"] for r in got)
    by = {}
    for r in got:
        by.setdefault((r.source_size, r.target), []).append(r)
    for (_, target), rows in by.items():
        assert abs(sum(r.taken for r in rows) - target) <= max(r["size"] for r in rows)


def test_take_repeats_rows(frame):
    docs = frame(corpus(), extra=True)
    out = mixing.take(docs)
    assert out.columns == docs.columns
    words = sum(len(r.text.split()) for r in out.collect())
    assert words == sum(r.taken for r in mixing.mix_sources(docs).collect())


def test_empty(frame):
    assert mixing.mix_sources(frame([])).collect() == []
    assert mixing.take(frame([])).collect() == []
