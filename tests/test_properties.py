"""Properties that must hold for any input."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pactframe.functions import text, values
from pactframe.operators import documents, lines, responses

LOOSE = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
texts = st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\0"), max_size=260), min_size=1, max_size=30)


@LOOSE
@given(texts)
def test_slug(spark, given_):
    df = spark.createDataFrame([(p,) for p in given_], "p string")
    once = text.slug(F.col("p"))
    for r in df.select(once.alias("s"), text.slug(once).alias("again")).collect():
        assert re.fullmatch(r"[A-Za-z0-9._-]{0,200}", r.s) and r.s == r.s.strip("-_.") and r.again == r.s


@LOOSE
@given(texts)
def test_strip_is_the_wide_one(spark, given_):
    df = spark.createDataFrame([(p,) for p in given_], "p string")
    for r in df.select("p", text.strip(F.col("p")).alias("s")).collect():
        assert r.s == r.p.strip()


@LOOSE
@given(st.lists(st.sampled_from(["CADRE", "CP", "AVENANT-", "-avenant-", "CG", "note", "Application", "BDC-licence"]), min_size=1, max_size=6))
def test_class_rows_equal_class_counts(spark, kinds):
    df = spark.createDataFrame([("a", f"x_{k}_{i}.pdf", "t") for i, k in enumerate(kinds)], "affair_id string, id string, content string")
    flagged = documents.classify(df)
    r = documents.split_report(flagged).first()
    assert documents.classify_documents(flagged).count() == r.n_cg + r.n_cp + r.n_av


@LOOSE
@given(st.lists(st.one_of(st.none(), st.sampled_from(["null", "x", "unknown"])), min_size=1, max_size=10))
def test_missing_round_trip(spark, given_):
    df = spark.createDataFrame([(v,) for v in given_], "v string")
    back = values.normalize_missing(values.render_missing(df))
    assert [r.v for r in back.collect()] == [None if v == "null" else v for v in given_]


@LOOSE
@given(st.lists(st.integers(1, 9_999_999), min_size=1, max_size=8))
def test_printed_amounts_are_read_back(spark, cents):
    def shown(c):
        return f"{c // 100:,}".replace(",", " ") + f",{c % 100:02d} €"

    body = " puis ".join(f"Poste{chr(65 + i)} {shown(c)}" for i, c in enumerate(cents))
    rows = lines.priced_lines(spark.createDataFrame([("d", body)], "id string, content string")).orderBy("amount_no").collect()
    assert [r.amount for r in rows] == [c / 100 for c in cents]


@LOOSE
@given(st.lists(st.text(max_size=40), min_size=1, max_size=10))
def test_any_answer_gets_one_status(spark, bodies):
    df = spark.createDataFrame([(str(i), b, "stop", 1, 1, 2) for i, b in enumerate(bodies)],
                               "request_id string, arguments string, finish_reason string, prompt_tokens long, completion_tokens long, total_tokens long")
    got = responses.response_status(df).collect()
    assert len(got) == len(bodies) and {r.status for r in got} <= {"bad_json", "no_products", "ok"}
