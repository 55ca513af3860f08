"""Nested answers, totals of sections, and many affairs at once."""

import random

import pytest
from pyspark.sql import functions as F

from pactframe.operators import audit, documents, lines, responses
from pactframe.session import cut


def test_nested_fields_of_odd_answers(spark):
    said = [
        ("a", '{"products":[{"x":1,"o":{"p":{"q":"t","n":null}},"l":[1,{"z":2}],"e":{}},{"o":"plain","x":true}]}'),
        ("b", '{"products":[]}'), ("c", '{"products":["text",3]}'), ("d", "{broken"), ("e", None), ("f", '{"other":1}'), ("g", '{"products":[{"a.b":"dot","":"none"}]}'),
    ]
    got = responses.nested_fields(spark.createDataFrame(said, "request_id string, arguments string"))
    assert {(r.request_id, r.pos, r.name): r.value for r in got.collect()} == {
        ("a", 0, "x"): "1", ("a", 0, "o.p.q"): "t", ("a", 0, "o.p.n"): None, ("a", 0, "l"): '[1,{"z":2}]', ("a", 0, "e"): "{}",
        ("a", 1, "o"): "plain", ("a", 1, "x"): "true", ("g", 0, "a.b"): "dot", ("g", 0, ""): "none",
    }
    table = {r.name: (r.n_products, r.n_values) for r in responses.nested_schema(got).collect()}
    assert table["x"] == (2, 2) and table["o.p.n"] == (1, 0) and len(table) == 8
    assert responses.nested_fields(spark.createDataFrame([], "request_id string, arguments string")).collect() == []


LINES = "affair_id string, id string, line_no int, amount_no int, label string, amount double, is_recap boolean"


def totals(spark, rows, floor=10**6):
    found = audit.section_totals(spark.createDataFrame(rows, LINES), floor=floor).collect()
    return {(r.affair_id, r.id, r.line_no): (r.level, float(r.printed), float(r.expected), r.aligned) for r in found}


def test_sections_totals_and_overall(spark):
    """A wrong sub-total under a right total, a second total that starts anew, an overall total over both."""
    rows = [
        ("a", "d", 0, 0, "WMS", 100.0, False), ("a", "d", 1, 0, "KPI", 20.5, False), ("a", "d", 2, 0, "Sous-total abonnements", 120.5, True),
        ("a", "d", 3, 0, "Licence", 50.0, False), ("a", "d", 3, 1, "Remise", -5.0, False), ("a", "d", 4, 0, "Sous-total licences", 50.0, True),
        ("a", "d", 5, 0, "Total", 165.5, True), ("a", "d", 6, 0, "Support", 10.0, False), ("a", "d", 7, 0, "Total support", 10.0, True),
        ("a", "e", 0, 0, "Option", 1.0, False), ("a", "e", 1, 0, "Total général", 176.5, True), ("a", "e", 2, 0, "Récapitulatif", 9.0, True),
        ("b", "d", 0, 0, "Total", 0.0, True), (None, "d", 0, 0, "x", 3.0, False), (None, "d", 1, 0, "Total", 3.0, True),
    ]
    want = {
        ("a", "d", 2): ("section", 120.5, 120.5, True), ("a", "d", 4): ("section", 50.0, 45.0, False), ("a", "d", 5): ("total", 165.5, 165.5, True),
        ("a", "d", 7): ("total", 10.0, 10.0, True), ("a", "e", 1): ("overall", 176.5, 176.5, True), ("a", "e", 2): ("total", 9.0, 0.0, False),
        ("b", "d", 0): ("total", 0.0, 0.0, True), (None, "d", 1): ("total", 3.0, 3.0, True),
    }
    assert totals(spark, rows) == want
    assert totals(spark, rows, floor=4) == want  # the same rows by ranges


def test_many_affairs_are_met_in_place(spark):
    """5,000 affairs: what equality on substrings finds, without a shuffle of the texts."""
    dice = random.Random(2)
    docs = [(f"{dice.choice('MNP')}_co_src{dice.randrange(8000)}_CP-{k}.pdf", "text") for k in range(300)] + [("x.PDF", "t"), (None, "t"), ("SRC12_src12.pdf", "t")]
    df = spark.createDataFrame(docs, "id string, content string")
    names = [f"src{k}" for k in range(4999)] + ["SRC12", "cp-1", ""]
    wanted = spark.createDataFrame([(n,) for n in names], "affair string")
    met = documents.match_affairs(df, wanted)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    low = documents.with_id_lc(df.filter(F.endswith("id", F.lit(".pdf"))))
    pairs = documents.affair_pairs(low, wanted.filter("affair <> ''").select(F.col("affair").alias("affair_id")))
    assert sorted(map(tuple, met.select("id", "affair_id").collect())) == sorted(map(tuple, pairs.collect()))


@pytest.mark.parametrize("limit", [2, 0])
def test_every_way_of_matching_affairs_agrees(spark, monkeypatch, limit):
    df = spark.createDataFrame([("a_src1-x.pdf",), ("src10.pdf",), ("b.pdf",), ("Src1.pdf",)], "id string")
    wanted = spark.createDataFrame([("src1",), ("SRC10",), ("x",)], "affair string")
    plain = sorted(map(tuple, documents.match_affairs(df, wanted).select("id", "affair_id").collect()))
    monkeypatch.setattr(documents, "LITERAL_AFFAIRS", 2)
    monkeypatch.setattr(documents, "AUTOMATON_AFFAIRS", limit or 10)
    assert sorted(map(tuple, documents.match_affairs(df, wanted).select("id", "affair_id").collect())) == plain and len(plain) == 5


def test_price_confidence_writes_no_more_than_it_returns(spark, monkeypatch):
    docs = spark.createDataFrame([("a", "d", "Licence 10 € HT / mois\nTotal 10 € HT"), (None, "e", "Licence 5 € HT\nLicence 7 € HT")], "affair_id string, id string, content string")
    rows, written = lines.priced_lines(docs), []
    every = audit.price_confidence(rows)
    monkeypatch.setattr(audit, "cut", lambda df: written.append(df.columns) or cut(df))
    shown = ["affair_id", "id", "line_no", "amount_no"]
    few = audit.price_confidence(rows, shown)
    assert not {"line", "currency", "cadence", "quantity"} & {c for columns in written for c in columns}
    assert set(rows.columns) < set(every.columns) and few.columns[:4] == shown
    assert sorted(few.collect(), key=str) == sorted(every.select(*few.columns).collect(), key=str)
    assert {(r.id, r.line_no, r.has_conflict, r.is_aligned, r.confidence) for r in few.collect()} == {
        ("d", 0, False, True, 0.9), ("e", 0, True, False, 0.5), ("e", 1, True, False, 0.5),
    }
