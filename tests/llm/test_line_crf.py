import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pactframe.llm import line_crf as crf


def brute_marginals(odds, links):
    """Sum over all label sequences."""
    total, good, pairs = 0.0, np.zeros(len(odds)), np.zeros((2, 2))
    for labels in itertools.product((0, 1), repeat=len(odds)):
        w = math.exp(sum(o for o, y in zip(odds, labels, strict=True) if y) + sum(links[a, b] for a, b in itertools.pairwise(labels)))
        total += w
        good += w * np.array(labels)
        for a, b in itertools.pairwise(labels):
            pairs[a, b] += w
    return good / total, pairs / total


def test_forward_backward_against_all_sequences():
    dice = np.random.default_rng(3)
    lengths = np.array([1, 7, 3, 10, 1])
    odds = dice.normal(0, 3, lengths.sum())
    links = dice.normal(0, 1, (2, 2))
    got, pairs = crf.marginals(odds, lengths, links)
    at, want_pairs = 0, np.zeros((2, 2))
    for n in lengths:
        want, some = brute_marginals(odds[at : at + n], links)
        assert got[at : at + n] == pytest.approx(want)
        want_pairs += some
        at += n
    assert pairs == pytest.approx(want_pairs)


def test_document_score_is_the_weighted_mean_of_its_lines(frame, rows):
    field = crf.Field(np.linspace(-1, 1, crf.N_FEATURES), np.array([[1.0, -1], [-1, 1]]))
    docs = frame([(1, "a line\n\nTHE !! OTHER ###\nthird"), (2, None), (3, "x" * 50_000), (3, "x" * 50_000), (None, "\n \n")], extra=True)
    scores = rows(crf.score(docs, field))
    lines = crf.label_lines(docs, field).collect()
    for r in scores:
        own = {x.line: x for x in lines if x.doc_id == r["doc_id"]}.values()
        size = [max(len(x.text.encode()), 1) for x in own]
        assert r["score"] == pytest.approx(sum(x.good * s for x, s in zip(own, size, strict=True)) / sum(size))
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 3 == 1)
    assert len(scores) == 5
    assert crf.score(frame([]), field).collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    field = crf.train(docs, labels)
    got = crf.score(docs, field).join(labels, "doc_id").filter("held_out")
    right, n = got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 80 and right > 0.95
    kept = crf.keep_good(docs, field)
    assert kept.columns == docs.columns
    assert kept.count() == crf.score(docs, field).filter("predicted = 1").count()


def test_without_labels_or_with_one(spark, frame):
    docs = frame([(k, "some text\nmore") for k in range(9)])
    for labels in ([], [(k, 1, 0) for k in range(9)], [(0, None, None), (None, 1, 0)]):
        field = crf.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        assert all(0 <= r.score <= 1 for r in crf.score(docs, field).collect())
