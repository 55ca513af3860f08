"""The heavy-group plans must give what the ordinary plans give."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pactframe.operators import amend, consolidate, documents, pricing, skew
from pactframe.operators.skew import HEAVY_MAX, fits, heavy_keys, lag_in_group, number_rows
from pactframe.plans import catalog, views
from pactframe.session import cut


def rows_of(df):
    return sorted(df.collect(), key=str)


@pytest.fixture(scope="module")
def skewed(spark, sf):
    """Given order lines, a third of them moved to one affair, with NULL order keys among them."""
    lines = views.table(spark, sf, "lineitem")
    affair = F.when(F.col("l_suppkey") % 3 == 0, F.lit("hot")).otherwise((F.col("l_orderkey") % 50).cast("string"))
    rows = lines.select(
        affair.alias("affair_id"), (F.col("l_linenumber") > 4).alias("is_av"),
        F.when(F.col("l_linenumber") > 4, F.col("l_linenumber") - 4).alias("avenant_number"),
        F.when(F.col("l_tax") > 0.02, F.date_format("l_shipdate", "yyyy-MM-dd")).alias("signature_date_cp"),
        F.lit(None).cast("string").alias("signature_date_av"),
        F.concat_ws("|", "l_orderkey", "l_linenumber").alias("request_id"),
        F.concat_ws("|", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate").alias("pos"),
        (F.col("l_returnflag") == "R").alias("one_shot_service"), (F.col("l_linestatus") == "O").alias("is_volume_product"),
        F.when(F.col("l_discount") > 0.02, F.col("l_extendedprice")).alias("price_unitaire"), F.col("l_extendedprice").alias("loyer"),
        F.concat("l_returnflag", "l_linestatus").alias("product_key"),
    )
    return rows.distinct()


@pytest.mark.parametrize("order", [consolidate.sequence_products, lambda d, floor: consolidate.consolidate(d.filter("not is_av").drop("is_av"), d.filter("is_av").drop("is_av"), floor)])
def test_numbering(skewed, order):
    plain, split = order(skewed, floor=10**9), order(skewed, floor=60)
    assert heavy_keys(skewed, ["affair_id"], floor=60) is not None
    assert rows_of(plain) == rows_of(split.select(*plain.columns))


def test_gate(skewed):
    columns = ["affair_id", "request_id", "pos", "price_unitaire", "loyer", "rent_moved"]
    plain, split = (pricing.clean_rents(skewed, floor=f).select(*columns) for f in (10**9, 60))
    assert rows_of(plain) == rows_of(split)


def test_delta(skewed):
    seq = consolidate.sequence_products(skewed).withColumn("loyer_periodicity", F.lit("Mensuelle"))
    plain, split = (amend.amendment_delta(seq, floor=f) for f in (10**9, 20))
    assert plain.count() > 100
    assert rows_of(plain) == rows_of(split)


def test_lag_over_short_runs(spark):
    rng = random.Random(7)
    rows = [("g", i, rng.choice([None, rng.random()])) for i in sorted(rng.sample(range(5000), 300))] + [("h", 1, 2.0)]
    df = spark.createDataFrame(rows, "k string, seq long, v double")
    plain = lag_in_group(df, ["k"], "seq", "v", "p", floor=10**9)
    assert rows_of(plain) == rows_of(lag_in_group(df, ["k"], "seq", "v", "p", floor=10, span=16))


def test_heavy_list_is_bounded(spark):
    df = spark.range(30_000).select((F.col("id") % 15_000).alias("k"))
    assert heavy_keys(df, ["k"], floor=1).count() == HEAVY_MAX
    assert heavy_keys(df, ["k"], floor=2) is None
    assert fits(df, 30_000) and not fits(df, 29_999)


def test_null_keys_are_kept(spark):
    df = spark.createDataFrame([(None, i) for i in range(20)] + [("a", 1)], "k string, v long")
    assert number_rows(df, "k", ["v"], floor=5).count() == 21


def test_running_sums_cross_ranges_and_no_range_grows_with_a_group(spark, monkeypatch):
    """One group of most rows, some NULL groups and orders, ties: numbers and sums of a plain loop, ranges near `span`."""
    rng = random.Random(3)
    rows = [("hot", rng.choice([None, rng.randrange(400)]), rng.randrange(9)) for _ in range(1500)]
    rows += [(rng.choice([None, "a", "b"]), rng.randrange(5), rng.randrange(9)) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, o long, v long").repartition(4)
    held = []
    monkeypatch.setattr(skew, "cut", lambda t: held.append(cut(t)) or held[-1])
    got = skew.running(df, ["k"], [F.asc_nulls_last("o"), F.col("v")], "n", {"upto": F.col("v")}, span=50).collect()
    assert max(r["count"] for r in held[0].groupBy("_range").count().collect()) < 3 * 50
    assert sorted((r.k, r.o, r.v) for r in got if r.k and r.o is not None) == sorted(r for r in rows if r[0] and r[1] is not None)
    groups = {}
    for r in sorted(got, key=lambda r: r.n):
        groups.setdefault(r.k, []).append(r)
    for own in groups.values():
        assert [r.n for r in own] == list(range(1, len(own) + 1))
        assert [(r.o is None, r.o or 0, r.v) for r in own] == sorted((r.o is None, r.o or 0, r.v) for r in own)
        assert [r.upto for r in own] == [sum(x.v for x in own[:k]) for k in range(len(own))]


def test_what_is_behind_a_group_plan_runs_once(spark):
    """With a cheaper table of sizes, rows pass an observed input a single time, as long as no key is heavy."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    plain = spark.range(900).selectExpr("cast(id % 3 as string) AS k", "id AS v")
    for floor in (10, 400, 10**6):
        before = seen.value
        got = number_rows(plain.mapInArrow(count, "k string, v long"), "k", ["v"], floor=floor, span=100, sizes=plain)
        assert sorted((r.k, r.v) for r in got.filter("seq = 300").collect()) == [("0", 897), ("1", 898), ("2", 899)]
        assert floor == 10 or seen.value - before == 900


def test_oversized_affair_is_split_whole(spark, sf):
    classified = documents.classify(documents.match_affairs(views.docs(spark, sf), views.affairs(spark, sf)))
    whole = documents.concat_contents(classified)
    parts = documents.concat_contents(classified, max_chars=30_000)
    assert parts.filter("part > 0").count() > 0
    assert whole.agg(F.max("n_parts")).first()[0] == 1

    def total(df):
        out = df.groupBy("affair_id").agg(
            F.sum("n_cg").alias("cg"), F.sum("n_cp").alias("cp"),
            F.sum(F.length("cg_content") - F.greatest(F.col("n_cg") - 1, F.lit(0))).alias("cg_chars"),
            F.sum(F.length("cp_content") - F.greatest(F.col("n_cp") - 1, F.lit(0))).alias("cp_chars"))
        return rows_of(out)

    assert total(whole) == total(parts)


@pytest.mark.parametrize("limit", [1, 6, 10, 17, 10_000])
def test_parts_in_order_are_the_whole_text(spark, limit):
    rows = [("a", f"d{k:02d}", "t" * (k % 5) + str(k), k % 3 == 0, k % 4 == 0) for k in range(30)] + [("b", "x", "small", True, False)]
    df = spark.createDataFrame(rows, "affair_id string, id string, content string, is_cg boolean, is_cp boolean").withColumn("is_av", F.lit(False))
    parts = sorted(documents.concat_contents(df, limit).filter("affair_id = 'a'").collect(), key=lambda r: r.part)
    assert [r.part for r in parts] == list(range(parts[0].n_parts))
    for text, n, at in (("cg_content", "n_cg", 3), ("cp_content", "n_cp", 4)):
        want = "\n".join(r[2] for r in rows[:30] if r[at])
        assert "\n".join(r[text] for r in parts if r[n]) == want


def test_split_report_does_not_read_texts(spark, sf):
    classified = documents.classify(documents.match_affairs(views.docs(spark, sf), views.affairs(spark, sf)))
    plan = documents.split_report(classified)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in "".join(x for x in plan.split("\n") if "ReadSchema" in x).split("ReadSchema")[1]


def test_affairs_by_equality_match_the_literal_test(spark, sf):
    docs = documents.with_id_lc(views.docs(spark, sf).filter(F.endswith("id", F.lit(".pdf"))))
    wanted = spark.createDataFrame([("src1",), ("SRC10",), ("cadre",), ("e",), ("nowhere",)], "affair_id string")
    listed = documents.match_affairs(views.docs(spark, sf), wanted.withColumnRenamed("affair_id", "affair"))
    assert rows_of(documents.affair_pairs(docs, wanted)) == rows_of(listed.select("id", "affair_id"))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def allowed(a, b):
    short = min(len(a), len(b))
    if any(c.isdigit() for c in a + b) or max(len(a), len(b)) > amend.MAX_FUZZY:
        return 0
    return 2 if short >= 8 else 1 if short >= 4 else 0


def best_matches(cp, av, share):
    """By the definition: every pair of an affair's descriptions, words respelled by the nearest of its CP words."""
    cp, av = ({" ".join(n.split()).lower() for n in side} - {""} for side in (cp, av))
    vocabulary = {w for c in cp for w in c.split()}

    def respelled(w):
        near = sorted((distance(w, k), k) for k in vocabulary if distance(w, k) <= allowed(w, k))
        return w if w in vocabulary or not near else near[0][1]

    want = {}
    for v in av:
        for c in cp:
            a, b = {respelled(w) for w in v.split()}, set(c.split())
            like = len(a & b) / len(a | b)
            if v == c or like >= share:
                want[v] = min(want.get(v, (True, 0, "")), (v != c, -like, c))
    return {v: (c, round(1.0 if not differs else -like, 9)) for v, (differs, like, c) in want.items()}


words = st.one_of(st.text("abc", min_size=1, max_size=6), st.sampled_from(["abonnement", "abonnements", "abonement", "mensuel", "mensuels", "s1 2015", "s2 2015"]))
names = st.lists(st.lists(words, min_size=1, max_size=4).map(" ".join), min_size=1, max_size=10)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(names, names, st.sampled_from([0.3, 0.5, 0.8]))
def test_similar_descriptions_against_all_pairs(spark, cp, av, share):
    left = spark.createDataFrame([("a", n) for n in cp], "affair_id string, product_name string")
    right = spark.createDataFrame([("a", n) for n in av], "affair_id string, product_name string")
    got = {r.av_desc: (r.cp_desc, round(r.likeness, 9)) for r in amend.match_by_description(left, right, share).collect()}
    assert got == best_matches(cp, av, share)


def test_plurals_and_typing_errors_are_the_same_words(spark):
    left = spark.createDataFrame([("a", n) for n in ("Abonnement WMS mensuel", "Licence EDI 2015", "Support premium")], "affair_id string, product_name string")
    right = spark.createDataFrame(
        [("a", n) for n in ("Abonnements WMS mensuels", "License EDI 2015", "Licence EDI 2016", "Suport premum", "b")] + [("b", "Support premium")],
        "affair_id string, product_name string",
    )
    got = {(r.affair_id, r.av_desc): (r.cp_desc, round(r.likeness, 3)) for r in amend.match_by_description(left, right).collect()}
    assert got == {
        ("a", "abonnements wms mensuels"): ("abonnement wms mensuel", 1.0), ("a", "license edi 2015"): ("licence edi 2015", 1.0),
        ("a", "licence edi 2016"): ("licence edi 2015", 0.5), ("a", "suport premum"): ("support premium", 1.0),
    }


def test_near_words_against_every_pair(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 11))) for _ in range(80)]
    bent = [w[:k] + rng.choice(["", "x", "ab"]) + w[k + rng.randint(0, 2):] for w in base for k in [rng.randrange(len(w))]] + ["abcd1", "z" * 60, "z" * 61]
    df = [spark.createDataFrame([(w,) for w in sorted(set(ws) - {""})], "word string") for ws in (base + ["z" * 61], bent)]
    got = {(r.word, r.near): r.edits for r in amend.near_words(df[1], df[0]).collect()}
    want = {(a, b): distance(a, b) for a in set(bent) - {""} for b in {*base, "z" * 61} if distance(a, b) <= allowed(a, b)}
    assert got == want


def test_volume_names_meet_only_themselves(spark):
    def named(years):
        rows = [("a", f"Abonnement volume WMS {k % 50} — {y} S{1 + k % 2}") for k in range(250) for y in years]
        return spark.createDataFrame(rows, "affair_id string, product_name string")

    cp, av = named((2015, 2016)), named((2016, 2017))
    got = amend.match_by_description(cp, av).collect()
    assert got and all(r.av_desc == r.cp_desc and "2016" in r.av_desc for r in got)
    assert spark.createDataFrame(cp.limit(9).collect()).select(F.size(amend.words_of(F.col("product_name"))).alias("n")).agg(F.sum("n")).first()[0] == 0


def test_uncoded_amendment_meets_a_coded_row_and_unlike_costs_are_not_subtracted(spark):
    ddl = ("affair_id string, request_id string, pos int, is_av boolean, avenant_number int, product_code string, product_name string, "
           "loyer double, loyer_periodicity string, price_unitaire double, signature_date_cp string, signature_date_av string")
    rows = [
        ("a", "c", 0, False, None, "W1", "Abonnement WMS", 100.0, "Mensuelle", None, "2020-01-01", None),
        ("a", "v", 0, True, 1, None, "abonnement  wms", 1500.0, "Annuelle", None, None, "2021-01-01"),
        ("b", "c", 0, False, None, "X", "Licence", 100.0, "Mensuelle", None, "2020-01-01", None),
        ("b", "v", 0, True, 1, "X", "Licence", None, None, 7.0, None, "2021-01-01"),
    ]
    seq = consolidate.sequence_products(spark.createDataFrame(rows, ddl))
    got = {r.affair_id: (r.product_key, r.basis, r.delta, r.reason) for r in amend.amendment_delta(amend.with_product_key(seq)).collect()}
    assert got == {"a": ("W1", "annual_rent", 300.0, None), "b": ("X", None, None, "unlike costs")}


def test_amendments_are_compared_on_rows_dealt_once(spark, sf):
    plan = catalog.QUERIES["amendment_delta"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "- Window " in line]
    assert sum("row_number()" in line for line in windows) == 1 and sum("lag(" in line for line in windows) == 1
    behind = plan[plan.index("lag(") :]
    assert "Exchange" not in behind[: behind.index("row_number()")]


def test_descriptions_of_affairs_without_amendments_are_not_written(spark, monkeypatch):
    written = []
    monkeypatch.setattr(amend, "cut", lambda df: written.append(df) or df)
    ddl = "affair_id string, product_name string"
    cp = spark.createDataFrame([("a", "Abonnement WMS"), ("a", "abonnement  wms"), ("b", "Licence"), (None, "Licence")], ddl)
    av = spark.createDataFrame([("a", "Abonnements WMS"), (None, "Licence")], ddl)
    got = [tuple(r) for r in amend.match_by_description(cp, av).collect()]
    assert got == [("a", "abonnements wms", "abonnement wms", 1.0)]
    assert not any("b" in {r.affair_id for r in df.collect()} for df in written if "affair_id" in df.columns)
