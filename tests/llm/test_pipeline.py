from collections import Counter

import corpus_pipeline as pipe
import pytest
from test_near_dedup import brute as near_brute
from test_packing import check_packed
from test_substring_dedup import brute as windows_brute

from pactframe.llm import line_crf, queries
from pactframe.llm.common import stage


@pytest.fixture(scope="module")
def steps(spark, sf):
    """Every stage's input and output, collected."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs.collect()]
    for name, step in pipe.STAGES:
        docs = stage(step(spark, docs, sf), "test-pipeline")
        if name != "pack":
            assert docs.columns == list(pipe.COLUMNS)
        out.append(docs.collect())
    return out


def test_quality(spark, sf, steps):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    field = line_crf.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    good = {r.doc_id for r, s in zip(steps[0], line_crf.document_scores(field, [r.text for r in steps[0]]), strict=True) if s >= 0.5}
    assert {r.doc_id for r in steps[1]} == good
    assert 0.7 * len(steps[0]) < len(good) < len(steps[0])


def test_one_of_each_group_stays(steps):
    want = {r[0] for r in near_brute([(r.doc_id, r.text) for r in steps[1]]) if r[3]}
    assert {r.doc_id for r in steps[2]} == want and len(steps[2]) == len(want)


def test_passages(steps):
    want = {r[0]: r for r in windows_brute([(r.doc_id, r.text) for r in steps[2]], 20)}
    before = {r.doc_id: r.text for r in steps[2]}
    got = {r.doc_id: r for r in steps[3]}
    assert set(got) == {i for i, r in want.items() if r[1] == 0 or r[2] < r[1]}
    for i, r in got.items():
        assert len(r.text.split()) == want[i][1] - want[i][2] and r.n_chars == len(r.text)
        assert want[i][2] or r.text == before[i]


def test_mix(steps):
    taken = Counter(r.doc_id for r in steps[4])
    assert max(taken.values()) <= 3
    size, mixed = Counter(), Counter()
    for r in steps[3]:
        size[r.source] += len(r.text.split())
        mixed[r.source] += len(r.text.split()) * taken[r.doc_id]
    left, target, total = {s: 1 + k % 3 for k, s in enumerate(sorted(size))}, {}, sum(size.values())
    while left:
        level = (total - sum(target.values())) / sum(left.values())
        full = [s for s, w in left.items() if level * w > 3 * size[s]]
        for s in full or list(left):
            target[s] = min(3 * size[s], level * left[s])
            del left[s]
        if not full:
            break
    for s, want in target.items():
        assert abs(mixed[s] - want) <= max(len(r.text.split()) for r in steps[3] if r.source == s)


def test_packing(steps):
    check_packed(steps[5], [(r.doc_id, r.text) for r in steps[4]])


def test_registered_once_each():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_odd_rows_and_further_columns(spark, sf, tmp_path):
    """Nulls in every column, empty, repeated and very long texts, clashing names: nothing crashes, nothing foreign comes out."""
    prose = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(3).collect()]
    long = " ".join(f"{w}{k}" for k, w in enumerate((prose[0] + " " + prose[1]).split() * 40))
    rows = [(1, prose[0], "en", "s", 5), (1, prose[0], "en", "s", 5), (2, None, None, None, None), (3, "", "en", "s", 0), (None, prose[1], "en", None, 7),
            (4, "short", "en", "t", 5), (5, long, "fr", "t", 9), (6, prose[2], None, "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "'x' AS kept_id", "'y' AS doc", "1 AS size", "'z' AS label", "2 AS score"
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    out = pipe.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} <= {1, None, 4, 5, 6}
    assert all(0 < r.length <= 1024 and 0 <= r.offset <= 1024 - r.length for r in out)


def test_an_empty_table_goes_through(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert pipe.run(spark, str(tmp_path)).collect() == []
