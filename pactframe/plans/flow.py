"""Whole jobs: files to documents, documents to priced tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactframe.functions.contract import overconsumption, service_start
from pactframe.functions.values import flag
from pactframe.operators.amend import resolve_terms, with_amendment_evidence
from pactframe.operators.audit import confidence, text_signals
from pactframe.operators.consolidate import consolidate
from pactframe.operators.documents import (
    avenant_texts,
    classify,
    exclude_kinds,
    match_affairs,
    split_report,
)
from pactframe.operators.lines import rule_extract
from pactframe.operators.pricing import apply_null_rules, clean_rents, contract_end, derive_rents, volume_unit_price
from pactframe.operators.requests import (
    answer_requests,
    attach_responses,
    avenant_requests,
    cgcp_requests,
    token_cost,
)
from pactframe.operators.responses import parse_responses, rectify, response_status, unknown_keys
from pactframe.operators.results import pack_results
from pactframe.operators.skew import number_rows
from pactframe.operators.terms import contract_terms
from pactframe.schemas import PRODUCT_COLUMNS
from pactframe.session import checkpoint_dir, cut
from pactframe.sinks import export_products, write_documents_text
from pactframe.sources.files import (
    apply_analyzer,
    build_documents,
    page_cost,
    relative_paths,
    scan_pdfs,
    select_affairs,
)
from pactframe.sources.store import append_batch, latest_per_key
from pactframe.streaming.ingest import TRIES


@dataclass
class Ingested:
    documents: DataFrame
    quarantine: DataFrame
    cost: DataFrame


def ingest(
    spark: SparkSession,
    root: str,
    affairs: list[str] | None,
    analyze: Callable[[str, bytes], dict],
    model: str = "prebuilt-layout",
) -> Ingested:
    """Files of the affairs, analyzed once each. Failed files and short paths go to quarantine."""
    files = select_affairs(relative_paths(scan_pdfs(spark, root), root), affairs)
    analyzed = cut(apply_analyzer(files, analyze))
    good = build_documents(analyzed.filter("error IS NULL"), model)
    bad_path = good.filter(~F.col("path_ok")).select(F.col("file_path").alias("path"), F.lit("short path").alias("error"))
    docs = good.filter("path_ok")
    return Ingested(docs, analyzed.filter("error IS NOT NULL").select("path", "error").unionByName(bad_path), page_cost(docs))


def prepare(docs: DataFrame, affairs: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """Documents per affair, unwanted kinds left out, with class flags."""
    kept, _ = exclude_kinds(match_affairs(docs, affairs), kinds)
    return classify(kept)


@dataclass
class Extracted:
    products: DataFrame
    status: DataFrame
    cost: DataFrame
    unknown: DataFrame


def extract(requests: DataFrame, connect: Callable, parallelism: int, log: str | None = None) -> Extracted:
    """Requests to rectified product rows. Answers are written as they come: a run with the same `log` pays for none twice."""
    requests = cut(requests)  # read by several steps, and made from all texts
    log = log or f"{checkpoint_dir(requests.sparkSession).rstrip('/')}/answers-{uuid.uuid4().hex}"
    answers = answer_requests(requests, connect, parallelism, log)
    keys = requests.select("request_id", "affair_id", "doc_class")
    known = attach_responses(keys, answers)
    products = parse_responses(known)
    return Extracted(
        rectify(products, carried=["affair_id", "request_id", "doc_class", "pos"]),
        response_status(known),
        token_cost(known, by=["affair_id"]),
        unknown_keys(known),
    )


def extract_by_rules(classified: DataFrame) -> DataFrame:
    """Product rows from the line rules, in the shape `extract` gives."""
    cgcp = classified.filter(F.col("is_cg") | F.col("is_cp")).select(
        "affair_id", F.concat("affair_id", F.lit("|CGCP")).alias("request_id"), F.lit("CGCP").alias("doc_class"), "id", "content"
    )
    av = avenant_texts(classified).select(
        "affair_id", F.concat("affair_id", F.lit("|AV|"), "id").alias("request_id"), F.lit("AV").alias("doc_class"), "id", "content"
    )
    rows = cut(rule_extract(cgcp.unionByName(av)))  # texts are read once, not per later step
    rows = number_rows(rows, "request_id", ["id", "line_no", "amount_no"], name="_at")
    return rectify(
        rows.withColumn("pos", F.col("_at").cast("int") - 1).drop("id", "line_no", "amount_no", "_at"),
        carried=["affair_id", "request_id", "doc_class", "pos"],
    )


# Terms a contract states once for all its lines; the CP's word comes before the CG's.
TERMS = [
    "numero_de_contrat", "devise_de_facturation", "reconduction_tacite", "tax_basis", "bon_de_commande_code",
    "debut_facturation", "payment_methods", "payment_terms", "reval_method", "reval_rate_per", "reval_formula",
]


def affair_terms(classified: DataFrame) -> DataFrame:
    """One row per affair: `TERMS` from its CP, else its CG, and the signature dates of both.

    Of several documents of a class, the first in id order that states a term counts.
    """
    def stated(name: str) -> DataFrame:
        found = contract_terms(classified.filter(f"is_{name}").select("affair_id", "id", "content"))
        dated = found.withColumn("signed", F.date_format("signature_date", "yyyy-MM-dd"))
        return dated.groupBy("affair_id").agg(
            *[F.expr(f"min_by({c}, id) FILTER (WHERE {c} IS NOT NULL)").alias(c) for c in [*TERMS, "signed"]]
        )

    cg, cp = cut(stated("cg")), cut(stated("cp"))
    terms = resolve_terms(cg, cp, TERMS).drop(*[f"{c}_source" for c in TERMS])
    dates = cg.select("affair_id", F.col("signed").alias("signature_date_cg")).join(
        cp.select("affair_id", F.col("signed").alias("signature_date_cp")), "affair_id", "full"
    )
    return terms.join(dates, "affair_id", "full")


def enrich(rows: DataFrame, classified: DataFrame) -> DataFrame:
    """Rule rows with what follows from their contracts and from each other, in the same shape.

    Contract terms, signature and start dates where the line has none, rents per invoice and year,
    unit and excess prices of volume lines, contract ends, rules on what a line must not carry, and a
    confidence for printed prices from six signals of their lines.
    """
    carried = [c for c in rows.columns if c not in PRODUCT_COLUMNS]
    given = [*TERMS, "signature_date_cg", "signature_date_cp"]
    terms = affair_terms(classified).withColumnsRenamed({c: f"_{c}" for c in given})
    amended = contract_terms(avenant_texts(classified)).select(
        F.concat("affair_id", F.lit("|AV|"), "id").alias("request_id"),
        F.date_format("signature_date", "yyyy-MM-dd").alias("_signature_date_av"),
    )
    met = rows.join(terms, "affair_id", "left").join(amended, "request_id", "left")
    is_av = F.col("doc_class") == "AV"
    filled = {c: F.coalesce(c, f"_{c}") for c in TERMS}
    filled |= {c: F.when(~is_av, F.coalesce(c, f"_{c}")) for c in ("signature_date_cg", "signature_date_cp")}
    filled["signature_date_av"] = F.coalesce("signature_date_av", "_signature_date_av")
    known = met.withColumns(filled).withColumn("_excess", overconsumption(F.col("evidence_price")))
    known = known.withColumns(
        {
            "usage_overconsumption_price": F.coalesce("usage_overconsumption_price", "_excess.price"),
            "usage_overconsumption_periodicity": F.coalesce("usage_overconsumption_periodicity", "_excess.periodicity"),
            "overconsumption_term_mode": F.coalesce("overconsumption_term_mode", "_excess.term_mode"),
        }
    )
    started = service_start(F.col("debut_facturation"), F.col("signature_date_av"), F.col("signature_date_cp"))
    known = volume_unit_price(known).withColumns(
        {
            "price_unitaire": F.coalesce("price_unitaire", "volume_unit_price"),
            "service_start_date": F.coalesce("service_start_date", F.date_format(started, "yyyy-MM-dd")),
        }
    )
    ended = contract_end(apply_null_rules(derive_rents(known)))
    end = F.coalesce("date_end_of_contract", F.date_format("date_end_calc", "yyyy-MM-dd"))
    printed = ended.withColumns({"date_end_of_contract": end, "_printed": F.coalesce("loyer", "price_unitaire")})
    # one payment needs no cadence; a row of a table is told by its pipe
    due = F.when(flag(F.col("one_shot_service")), F.lit("once")).otherwise(F.coalesce("loyer_periodicity", F.lit("unknown")))
    told = text_signals(
        printed.withColumn("_due", due), ["request_id"], "product_name", "_printed", "evidence_price", "_due", F.startswith("evidence_price", F.lit("|"))
    )
    scored = confidence(told, "price_unitaire", "evidence_price", "confidence_price")
    return rectify(scored.select(*carried, *PRODUCT_COLUMNS), carried=carried)


@dataclass
class Outcome:
    products: DataFrame
    results: DataFrame
    report: DataFrame
    extracted: Extracted | None
    cpcg: DataFrame
    avenants: DataFrame | None


def run(
    docs: DataFrame,
    affairs: DataFrame,
    connect: Callable | None = None,
    question: str = "",
    avenant_question: str = "",
    prompt: str = "",
    include_avenants: bool = True,
    parallelism: int | None = None,
    log: str | None = None,
    kinds: list[str] | None = None,
) -> Outcome:
    """Documents and affairs to the priced table and packed results of every affair.

    Without `connect` the rows come from the line rules. With it, `parallelism` says how many
    requests the service takes at once, and `log` keeps the answers for a later run. Only affairs
    whose split holds are extracted; the report names the others.
    """
    if connect is not None and parallelism is None:
        raise ValueError("parallelism: how many requests the service takes at once")
    classified = prepare(docs, affairs, kinds)
    report = split_report(classified)
    sound = classified.join(report.filter("ok").select("affair_id"), "affair_id", "left_semi")
    extracted = None
    if connect is None:
        rows = cut(enrich(extract_by_rules(sound), sound))
    else:
        requests = cgcp_requests(sound, question, prompt)
        if include_avenants:
            requests = requests.unionByName(avenant_requests(sound, avenant_question, prompt))
        extracted = extract(requests, connect, parallelism, log)
        rows = extracted.products
    cpcg = rows.filter("doc_class = 'CGCP'").drop("doc_class")
    av = rows.filter("doc_class = 'AV'").drop("doc_class") if include_avenants else None
    products = clean_rents(consolidate(cpcg, av)).drop("rent_moved")
    if av is not None:
        products = with_amendment_evidence(cut(products))  # read by several steps
    return Outcome(products, pack_results(products), report, extracted, cpcg, av)


def save(outcome: Outcome, root: str, results: str, batch: int, format: str = "parquet") -> dict[str, str]:
    """Upsert the packed results as a batch of the store `results` and export the three tables below `root`.

    Writing the same batch again replaces it. Returns the folders of the exports.
    """
    append_batch(outcome.results, results, batch)
    tables = {"cgcp": outcome.cpcg, "avenants": outcome.avenants, "products": outcome.products}
    return {tag: export_products(df, root, tag, format) for tag, df in tables.items() if df is not None}


def saved_results(spark: SparkSession, results: str) -> DataFrame:
    """Records of the newest batch of each affair: an affair's records are replaced together."""
    stored = spark.read.parquet(results)
    newest = stored.groupBy("id").agg(F.max("batch").alias("batch"))
    return stored.join(newest, ["id", "batch"]).drop("batch")


def save_ingested(got: Ingested, store: str, batch: int, texts: str | None = None) -> None:
    """Upsert the documents as a batch of `store`, the quarantine beside it, and a text file per document."""
    append_batch(latest_per_key(got.documents, ["id"], ["file_path"]), store, batch)
    tried = F.when(F.col("error") == "short path", TRIES).otherwise(1).cast("int")  # a short path is not worth another try
    append_batch(got.quarantine.withColumn("attempts", tried), f"{store.rstrip('/')}-quarantine", batch)
    if texts:
        write_documents_text(got.documents, texts)
