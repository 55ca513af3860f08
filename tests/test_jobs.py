"""Stores, files, answers and whole jobs, faults included."""

import json
import os
import uuid
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pactframe import sinks
from pactframe.operators import requests, responses, results
from pactframe.plans import flow, views
from pactframe.schemas import PRODUCT_COLUMNS, RESPONSES
from pactframe.sources import files, store
from pactframe.streaming.ingest import stream_documents

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers cannot import a test module


@pytest.fixture()
def contracts(tmp_path):
    root = tmp_path / "blobs"
    texts = {
        "M/acme/deal/CADRE-1.pdf": "Conditions générales", "M/acme/deal/CP-2.PDF": "upper suffix",
        "M/acme/deal/CP-3.pdf": "Abonnement WMS 1 000 € HT / mois\nLicence 500 € HT\nTotal 1 500 €",
        "M/acme/deal/AVENANT-4.pdf": "Abonnement volume WMS 1 200 € HT / mois\nLicence extra 50 € HT",
        "M/acme/deal/CP-ASP-5.pdf": "left out", "M/short.pdf": "short path", "M/acme/deal/broken-6.pdf": "BROKEN", "M/acme/deal/note.txt": "no pdf",
    }
    for path, body in texts.items():
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(body, encoding="utf-8")
    return str(root)


def analyze(path, content):
    text = content.decode("utf-8")
    if text == "BROKEN":
        raise ValueError("unreadable")
    return {"content": text, "languages": [], "page_count": 2}


def test_scan_lists_pdfs_of_either_case(spark, contracts):
    found = files.relative_paths(files.scan_pdfs(spark, contracts), contracts)
    assert {r.path for r in found.select("path").collect()} >= {"M/acme/deal/CP-2.PDF", "M/short.pdf"}
    assert found.count() == 7
    assert "content" not in files.scan_pdfs(spark, contracts).select("path")._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


def test_ingest(spark, contracts, tmp_path):
    got = flow.ingest(spark, contracts, ["ACME", "short"], analyze)
    docs = {r.id: r for r in got.documents.collect()}
    assert set(docs) == {f"M_acme_deal_{n}" for n in ("CADRE-1.pdf", "CP-2.PDF", "CP-3.pdf", "AVENANT-4.pdf", "CP-ASP-5.pdf")}
    one = docs["M_acme_deal_CP-3.pdf"]
    assert (one.language, one.page_count, one.company_affair_path, one.title) == ("unknown", 2, "M/acme/deal", "CP-3.pdf")
    bad = {r.path: r.error for r in got.quarantine.collect()}
    assert bad == {"M/short.pdf": "short path", "M/acme/deal/broken-6.pdf": "ValueError: unreadable"}
    assert got.cost.first().mean_pages == 2.0
    out = tmp_path / "md"
    for _ in range(2):
        sinks.write_documents_text(got.documents, str(out))
    assert sorted(os.listdir(out)) == sorted(f"{i}.md" for i in docs)
    assert (out / "M_acme_deal_CADRE-1.pdf.md").read_text(encoding="utf-8") == "Conditions générales"


def test_stream_then_replay(spark, contracts, tmp_path):
    where = str(tmp_path / "store")
    for _ in range(2):  # a fresh checkpoint makes the second run a full replay
        query = stream_documents(spark, contracts, where, str(tmp_path / f"cp{_}"), analyze)
        query.awaitTermination(120)
        assert query.exception() is None
    assert store.current(spark, where, ["id"]).count() == 5
    refused = {r.path: r.error for r in spark.read.parquet(f"{where}-quarantine").collect()}
    assert refused["M/short.pdf"] == "short path" and "broken" in "".join(refused) and len(refused) == 2
    store.compact(spark, where, str(tmp_path / "compacted"), ["id"])
    assert store.current(spark, str(tmp_path / "compacted"), ["id"]).count() == 5


def test_a_file_that_fails_once_comes_through_and_one_that_always_fails_is_parked(spark, tmp_path):
    """Each epoch brings one new file; failed ones are offered again, three times in all."""
    root, calls = tmp_path / "blobs" / "M" / "acme" / "deal", tmp_path / "calls"
    root.mkdir(parents=True)
    calls.mkdir()

    def shaky(path, content):
        name = os.path.basename(path)
        n = len([f for f in os.listdir(calls) if f.startswith(name)])
        (calls / f"{name}-{n}").touch()
        if "always" in name or ("once" in name and n == 0):
            raise TimeoutError("slow")
        return {"content": content.decode(), "languages": ["fr"], "page_count": 1}

    where = str(tmp_path / "store")
    for epoch, names in enumerate((["once.pdf", "always.pdf", "good.pdf"], ["b.pdf"], ["c.pdf"], ["d.pdf"], ["e.pdf"])):
        for name in names:
            (root / name).write_text(name)
        query = stream_documents(spark, str(tmp_path / "blobs"), where, str(tmp_path / "cp"), shaky)
        query.awaitTermination(120)
        assert query.exception() is None
        if epoch == 0:
            assert {r.title for r in store.current(spark, where, ["id"]).collect()} == {"good.pdf"}
    assert {r.title for r in store.current(spark, where, ["id"]).collect()} == {"once.pdf", "good.pdf", "b.pdf", "c.pdf", "d.pdf", "e.pdf"}
    latest = {os.path.basename(r.path): (r.error, r.attempts) for r in store.current(spark, f"{where}-quarantine", ["path"]).collect()}
    assert latest == {"once.pdf": (None, 2), "always.pdf": ("TimeoutError: slow", 3)}
    assert sorted(f.rsplit("-", 1)[0] for f in os.listdir(calls)).count("always.pdf") == 3


def test_an_empty_batch_replaces_too(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "id string, v int")
    store.append_batch(df, str(tmp_path / "s"), 1)
    store.append_batch(df.withColumn("id", F.lit("b")), str(tmp_path / "s"), 2)
    store.append_batch(df.limit(0), str(tmp_path / "s"), 1)
    assert [(r.id, r.v) for r in store.current(spark, str(tmp_path / "s"), ["id"]).collect()] == [("b", 1)]


def test_no_answer_is_paid_for_twice(spark, tmp_path):
    """A task dies in the third wave: the next run sends only what the log lacks, and failed requests again."""
    sent, log = tmp_path / "sent", str(tmp_path / "log")
    sent.mkdir()

    def connect(die_at, fail):
        def start():
            def reply(messages):
                name = messages[0]["content"]
                (sent / f"{name}-{uuid.uuid4().hex}").touch()
                if len(os.listdir(sent)) == die_at:
                    os._exit(1)
                if fail and name == "r7":
                    raise TimeoutError("slow")
                return {"arguments": f'{{"products":["{name}"]}}', "finish_reason": "tool_calls", "prompt_tokens": 1, "completion_tokens": 1}

            return reply

        return start

    ddl = "request_id string, messages array<struct<role:string,content:string>>"
    asked = spark.createDataFrame([(f"r{k}", [("user", f"r{k}")]) for k in range(40)], ddl)
    with pytest.raises(Exception, match="(?i)worker|python|abort"):
        requests.answer_requests(asked, connect(21, False), 2, log, per_task=4).count()
    kept = {r.request_id for r in requests.logged_answers(spark, log).collect()}
    assert 0 < len(kept) < 40
    first = requests.answer_requests(asked, connect(0, True), 2, log, per_task=4)
    assert {r.request_id for r in first.filter(requests.is_error()).collect()} <= {"r7"}
    again = requests.answer_requests(asked, connect(0, False), 2, log, per_task=4).collect()
    assert sorted(r.request_id for r in again) == sorted(f"r{k}" for k in range(40))
    assert all(r.finish_reason == "tool_calls" and r.request_id in r.arguments for r in again)
    times = [f.split("-")[0] for f in os.listdir(sent)]
    assert all(times.count(r) == 1 for r in kept)


def test_a_bucketed_store_rewrites_only_what_is_touched(spark, tmp_path):
    root, ddl = str(tmp_path / "store"), "id string, v int, at int"
    frame = lambda rows: spark.createDataFrame(rows, ddl)
    schema = frame([]).schema
    assert store.bucketed(spark, root, schema).count() == 0 and store.upsert_buckets(frame([]), root, ["id"], ["at"], 8) == []
    first = [(f"k{k}", k, 0) for k in range(200)]
    assert store.upsert_buckets(frame(first), root, ["id"], ["at"], 8) == list(range(8))
    second = [("k5", 50, 1), ("k5", 51, 2)]
    touched = store.upsert_buckets(frame(second), root, ["id"], ["at"], 99)  # the store keeps its own number of buckets
    assert len(touched) == 1
    written = os.listdir(f"{root}/data/version=2")
    assert [d for d in written if d.startswith("bucket=")] == [f"bucket={touched[0]}"]
    want = {f"k{k}": k for k in range(200)} | {"k5": 51}
    assert {r.id: r.v for r in store.bucketed(spark, root, schema).collect()} == want
    assert [r.v for r in store.bucket_of_key(spark, root, schema, {"id": "k5"}).collect()] == [51]
    # a run that dies before its manifest is there changes nothing, and the next one takes its place
    frame([("k6", 0, 9)]).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{root}/data/version=3")
    assert {r.id: r.v for r in store.bucketed(spark, root, schema).collect()} == want
    store.upsert_buckets(frame([("new", 1, 1), (None, 0, 1)]), root, ["id"], ["at"])
    store.upsert_buckets(frame([(None, 2, 2)]), root, ["id"], ["at"])
    got = {r.id: r.v for r in store.bucketed(spark, root, schema).collect()}
    assert got == want | {"new": 1, None: 2}


def test_upsert_twice_is_once(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "id string, v int, t string")
    new = spark.createDataFrame([("b", 2, "y"), ("b", 3, "z"), ("c", 2, "n")], "id string, v int, t string")
    once = store.upsert_by_key(old, new, ["id"], ["v"])
    assert sorted(map(tuple, once.collect())) == [("a", 1, "x"), ("b", 3, "z"), ("c", 2, "n")]
    assert sorted(map(tuple, store.upsert_by_key(once, new, ["id"], ["v"]).collect())) == sorted(map(tuple, once.collect()))
    assert store.upsert_by_key(None, new, ["id"], ["v"]).count() == 2


def answer(spark, rows):
    return spark.createDataFrame([(i, a, f, 1, 1, 2) for i, a, f in rows], RESPONSES)


def test_answer_faults(spark):
    df = answer(spark, [
        ("good", '{"products":[{"product_name":"A","duree_de_service":48,"price_unitaire":"null"},{"product_name":"B"}]}', "stop"),
        ("none", None, "stop"), ("cut", '{"products":[{"product_name":"A"', "length"), ("broken", '{"products":[{', "stop"),
        ("empty", '{"products":[]}', "stop"), ("missing", "{}", "stop"), ("extra", '{"products":[{"product_name":"A","zzz":1,"affair_id":"q"}]}', "stop"),
    ])
    assert {r.request_id: r.status for r in responses.response_status(df).collect()} == {
        "good": "ok", "none": "no_tool_call", "cut": "truncated", "broken": "bad_json", "empty": "no_products", "missing": "no_products", "extra": "ok"}
    rows = responses.parse_responses(df).orderBy("request_id", "pos").collect()
    assert [(r.request_id, r.pos, r.product_name, r.duree_de_service) for r in rows] == [
        ("extra", 0, "A", None), ("good", 0, "A", "48"), ("good", 1, "B", None)]
    assert [tuple(r) for r in responses.unknown_keys(df).collect()] == [("extra", 0, "zzz")]


def connect():
    def reply(messages):
        assert [m["role"] for m in messages] == ["system", "user"]
        text = messages[1]["content"]
        if "AVENANT" in text.split("\n")[2]:
            product = {"product_name": "WMS", "one_shot_service": False, "is_volume_product": True, "loyer": 1200, "signature_date_av": "01/02/2020", "avenant_number": 1}
        else:
            product = {"product_name": "WMS", "one_shot_service": True, "is_volume_product": False, "loyer": 1000, "signature_date_cp": "2019-01-01"}
        full = {c: product.get(c) for c in PRODUCT_COLUMNS}
        return {"arguments": json.dumps({"products": [full]}), "finish_reason": "tool_calls", "prompt_tokens": 10, "completion_tokens": 5}

    return reply


def test_run_with_an_extractor(spark, contracts):
    docs = flow.ingest(spark, contracts, None, analyze).documents
    affairs = spark.createDataFrame([("Deal",), ("nobody",)], "affair string")
    got = flow.run(docs, affairs, connect, "Q", "QA", "P", parallelism=2)
    rows = got.products.orderBy("seq").collect()
    assert [(r.seq, r.is_av, r.price_unitaire, r.loyer) for r in rows] == [(1, False, 1000.0, None), (2, True, None, 1200.0)]
    assert [(r.id, len(r.rows)) for r in got.results.collect()] == [("Deal", 2)]
    assert {r.status for r in got.extracted.status.collect()} == {"ok"}
    assert got.extracted.cost.first().prompt_tokens == 20
    coded = flow.run(docs, affairs, connect, include_avenants=False, parallelism=2).products
    assert [(r.is_av, r.loyer) for r in coded.collect()] == [(False, 1000.0)]  # flags not mixed: gate shut


def test_run_by_rules_is_native(spark, contracts):
    docs = flow.ingest(spark, contracts, None, analyze).documents
    got = flow.run(docs, spark.createDataFrame([("deal",)], "affair string"))
    names = [(r.product_name, r.price_unitaire, r.loyer) for r in got.products.orderBy("seq").collect()]
    assert sorted(names, key=str) == sorted([("Abonnement WMS", None, 1000.0), ("Licence", 500.0, None), ("Abonnement volume WMS", None, 1200.0), ("Licence extra", 50.0, None)], key=str)
    assert "Python" not in got.products._jdf.queryExecution().optimizedPlan().toString()


def test_whole_job_by_rules(spark, tmp_path):
    """Files to stored documents, enriched rows, stored results and three exports."""
    root = tmp_path / "blobs" / "M" / "acme" / "deal"
    root.mkdir(parents=True)
    texts = {
        "CADRE-1.pdf": "Devise de facturation : USD\nDébut de facturation : à la signature\nDate de signature : 01/02/2019\nLe contrat est renouvelé par reconduction tacite.",
        "CP-2.pdf": "Devise de facturation : EUR\nDate de signature : 15/03/2019\nAbonnement WMS\n1 200 € HT / trimestre\nLicence 500 € HT",
        "AVENANT-3.pdf": "Date de signature : 20/04/2020\nAbonnements WMS 1 500 € HT / trimestre\nPricing mensuel volumes\n| Famille | Nombre de lignes par an | 2021 S1 |\n| --- | --- | --- |\n| Bons | 12 000 | 500 € |",
    }
    for name, body in texts.items():
        (root / name).write_text(body, encoding="utf-8")
    got = flow.ingest(spark, str(tmp_path / "blobs"), None, analyze)
    where, results_at = str(tmp_path / "docs"), str(tmp_path / "results")
    flow.save_ingested(got, where, 1, str(tmp_path / "texts"))
    docs = store.current(spark, where, ["id"])
    assert docs.count() == 3 and len(list((tmp_path / "texts").glob("*.md"))) == 3
    out = flow.run(docs, spark.createDataFrame([("deal",)], "affair string"))
    rows = {(r.is_av, r.product_name): r for r in out.products.collect()}
    wms, amended = rows[False, "Abonnement WMS"], rows[True, "Abonnements WMS"]
    volume = rows[True, "Abonnement volume Bons — 2021 S1"]
    assert (volume.loyer, volume.quantity, volume.price_unitaire, volume.is_volume_product, volume.evidence_avenant) == (500.0, 12000.0, 0.5, True, None)
    assert amended.evidence_avenant == "ancien 4800.00, nouveau 6000.00, écart +1200.00" and wms.evidence_avenant is None
    assert (wms.service_start_date, amended.service_start_date) == ("2019-03-15", "2020-04-20")
    assert (wms.loyer, wms.loyer_periodicity, wms.loyer_annuele, wms.reconduction_tacite) == (1200.0, "Trimestrielle", 4800.0, True)
    assert (wms.signature_date_cg, wms.signature_date_cp, wms.date_end_of_contract) == ("2019-02-01", "2019-03-15", "2099-12-31")
    assert (amended.signature_date_av, amended.signature_date_cp, amended.loyer_annuele) == ("2020-04-20", None, 6000.0)
    licence = rows[False, "Licence"]
    assert (licence.one_shot_service, licence.price_unitaire, licence.loyer, licence.date_end_of_contract) == (True, 500.0, None, None)
    for batch in (1, 1, 2):
        folders = flow.save(out, str(tmp_path / "exports"), results_at, batch)
    assert set(folders) == {"cgcp", "avenants", "products"}
    assert spark.read.parquet(folders["products"]).count() == 4 and spark.read.parquet(folders["avenants"]).count() == 2
    assert [(r.id, len(r.rows)) for r in flow.saved_results(spark, results_at).collect()] == [("deal", 4)]


def test_failing_extractor_is_isolated(spark, sf):
    def broken():
        def reply(messages):
            raise TimeoutError("slow")

        return reply

    asked = spark.createDataFrame([("r", "a", "CGCP", [("user", "x")])], "request_id string, affair_id string, doc_class string, messages array<struct<role:string,content:string>>")
    row = requests.apply_extractor(asked, broken, 1).first()
    assert (row.arguments, row.finish_reason) == (None, "error: TimeoutError: slow")


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("a", "x|y\nz", None), ("b", "q", 1.5)], "affair_id string, product_name string, loyer double")
    for kind in sinks.FORMATS:
        target = sinks.export_products(df, str(tmp_path), f"t_{kind}", kind)
        assert len([d for d in os.listdir(target) if d.startswith("folder=")]) == 2
    assert {r[0] for r in spark.read.text(str(tmp_path / "t_markdown")).collect()} == {"| a | x\\|y z | null |", "| b | q | 1.5 |"}
    read = spark.read.option("header", True).csv(str(tmp_path / "t_csv"), multiLine=True)
    assert {(r.affair_id, r.loyer) for r in read.collect()} == {("a", "null"), ("b", "1.5")}
    assert [tuple(r) for r in sinks.exported(spark, str(tmp_path / "t_parquet"), "b").collect()] == [("b", "q", 1.5)]
    seen, metrics = sinks.observe(df, "seen")
    seen.collect()
    assert metrics.get["n_rows"] == 2


def test_an_export_of_many_affairs_has_few_folders_and_a_failed_one_shows_nothing(spark, tmp_path):
    many = spark.range(20_000).selectExpr("cast(id as string) AS affair_id", "id AS seq")
    target = sinks.export_products(many, str(tmp_path), "many", folders=16)
    assert len([d for d in os.listdir(target) if d.startswith("folder=")]) == 16
    assert sinks.exported(spark, target, "777", 16).first().seq == 777 and spark.read.parquet(target).count() == 20_000
    broken = many.selectExpr("affair_id", "if(seq = 19999, cast(raise_error('no') as bigint), seq) AS seq")
    with pytest.raises(Exception, match="no"):
        sinks.export_products(broken, str(tmp_path), "broken", folders=16)
    left = tmp_path / "broken"
    assert not left.exists() or not [f for f in left.rglob("*.parquet") if "_temporary" not in str(f)]


def test_results_are_replaced_per_affair(spark):
    ddl = "affair_id string, seq long, product_name string"
    old = results.pack_results(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x")], ddl), max_rows=1)
    new = results.pack_results(spark.createDataFrame([("a", 1, "z")], ddl), max_rows=1)
    rows = results.upsert_results(old, new).collect()
    assert sorted((r.id, r.part, r.rows[0].product_name) for r in rows) == [("a", 0, "z"), ("b", 0, "x")]


def test_plans(spark, sf, tmp_path):
    """Filters reach Parquet, unused text is not read, hot keys are cut before the shuffle, no Python runs."""
    where = str(tmp_path / "docs")
    views.docs(spark, sf).write.parquet(where)
    from pactframe.operators import documents as pick

    plan = pick.docs_for_affair(store.documents(spark, where), "src1").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "StringContains(id_lc,src1)" in plan and "StringEndsWith(id,.pdf)" in plan and "content" not in plan
    events = views.table(spark, sf, "events")
    plan = store.latest_per_key(events, ["user_id"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    listed = pick.match_affairs(views.docs(spark, sf), views.affairs(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in listed and "Cartesian" not in listed


@pytest.mark.parametrize("kind", ["window", "pairs"])
def test_no_nested_loops_or_python(spark, sf, kind):
    import __spark_entry__ as entry

    names = ["sequence_products", "clean_rents"] if kind == "window" else ["match_by_description", "match_affairs", "rule_extract", "sla_check"]
    for name in names:
        plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
