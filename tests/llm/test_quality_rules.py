import math
import random
import re

import pytest
from pyspark.sql import functions as F

from pactframe.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    at, seen, covered, lines, dup = {}, {}, set(), set(), 0
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i : i + 3]), []).append(i)
    for places in at.values():
        if len(places) > 1:
            covered.update(p + k for p in places for k in range(3))
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def corpus():
    dice = random.Random(9)
    good, bad = [f"g{k}" for k in range(60)], [f"b{k}" for k in range(60)]
    docs = []
    for k in range(240):
        pool = good if k % 4 else bad
        sep = dice.choice([" ", "\n", " \t", " \x85", "é "])
        docs.append((k, sep.join(dice.choice(pool) for _ in range(dice.choice([0, 1, 2, 3, 4, 49, 50, 51, 200])))))
    docs += [(900, None), (901, ""), (902, "a b c " * 40), (903, "same line\n" * 30), (904, "#|<>&%$* " * 60), (905, "w " * 30_000)]
    return docs + [(None, "no id " * 30), (7, docs[7][1])]


def labels_of(spark, docs):
    rows = [(i, int(i % 4 != 0), int(i % 40 == 1)) for i, _ in docs if i is not None and i < 200] + [(None, 1, 0), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_against_brute_force(spark, frame):
    docs = corpus()
    labels = labels_of(spark, docs)
    got = qr.judge(frame(docs, extra=True), labels, buckets=4096, missed=0.05).collect()
    assert len(got) == len(docs)
    words = sorted({w for _, t in docs for w in WORD.findall(t or "")})
    pairs = sorted({p for _, t in docs for w in [WORD.findall(t or "")] for p in zip(w, w[1:], strict=False)})
    one = {r.a: r.h % 4096 for r in spark.createDataFrame([(w,) for w in words], "a string").select("a", F.xxhash64("a").alias("h")).collect()}
    two = {(r.a, r.b): r.h % 4096 for r in spark.createDataFrame(pairs, "a string, b string").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()}
    grams = lambda t: [one[x] for x in WORD.findall(t or "")] + [two[p] for w in [WORD.findall(t or "")] for p in zip(w, w[1:], strict=False)]
    trusted = {r.doc_id for r in qr.trusted_ids(labels).collect()}
    raw, good = [0] * 4096, [0] * 4096
    for i, t in docs:
        for g in grams(t):
            raw[g] += 1
            good[g] += i in trusted
    weight = [math.log((g + 1) / (sum(good) + 4096)) - math.log((r + 1) / (sum(raw) + 4096)) for g, r in zip(good, raw, strict=True)]
    ratio = lambda t: sum(weight[g] for g in grams(t)) / len(grams(t)) if grams(t) else 0.0
    failed = lambda b: b[0] < 50 or 100 * b[4] > 50 * b[0]
    inside = sorted(ratio(t) for i, t in docs if i in trusted and not failed(base(t)))
    limit = inside[max(0, math.ceil(0.05 * len(inside)) - 1)]
    want = sorted(((i, *base(t), failed(base(t))) for i, t in docs), key=repr)
    assert sorted((tuple(r[:7]) for r in got), key=repr) == want
    for r in got:
        texts = [t for i, t in docs if i == r.doc_id]
        assert any(r.ratio == pytest.approx(ratio(t), abs=1e-9) for t in texts)
        assert r.kept == (not r.base_failed and r.ratio >= limit - 1e-12)
    kept = {r.doc_id for r in got if r.kept}
    long = {i for i, t in docs if i is not None and i < 900 and not failed(base(t))}
    assert {i for i in long if i % 4} - kept == set() or len({i for i in long if i % 4} - kept) < 0.1 * len(long)
    assert not {i for i in long if i % 4 == 0} & kept


def test_without_trusted_documents_and_empty(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = qr.judge(frame([(1, "w%d " % 1 + " ".join(f"x{k}" for k in range(60))), (2, None)]), none).collect()
    assert {(r.doc_id, r.kept, r.ratio) for r in got} == {(1, True, 0.0), (2, False, 0.0)}
    assert qr.judge(frame([]), none).collect() == []


def test_no_python_in_the_plans(spark, frame):
    df = qr.base_columns(frame([(1, "a")]), "doc_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_trusted_label_counts(spark):
    labels = spark.range(30_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert qr.trusted_ids(labels).count() == 30_000


def test_quantile_over_ranges(spark):
    values = spark.range(1_000).selectExpr("double((id * 7919) % 1000 div 3) AS ratio")
    ordered = sorted(r.ratio for r in values.collect())
    for share in (0.0005, 0.005, 0.5):
        assert qr.quantile(values, "ratio", share, span=90).first().limit == ordered[max(1, math.ceil(share * 1_000)) - 1]
    assert qr.quantile(values.filter("ratio < 0"), "ratio", 0.5).first().limit is None


def test_sent_or_shuffled_ids_give_the_same(spark):
    docs = spark.range(60).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 60), x -> concat('w', x * (id % 7 + 1) % 53))) AS text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS quality", "0 AS toxic")
    few, many = (sorted(tuple(r) for r in qr.judge(docs, labels, sent=n).collect()) for n in (10, 100))
    assert few == many and len(few) == 60
