"""The registered queries: each reads whole tables and returns one DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactframe.functions import contract, text, values
from pactframe.operators import amend, audit, consolidate as merge, documents as pick, lines as read, pricing
from pactframe.operators import requests as ask
from pactframe.operators import responses as answers
from pactframe.operators import results, terms
from pactframe.plans import views
from pactframe.session import cut
from pactframe.sources import files, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PROMPT = "Return every priced product."
QUESTION = "List the products of the contract."
AVENANT_QUESTION = "List the products of each amendment."


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _iso(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


# --- paths, ids, listing -----------------------------------------------------


@query
def parse_path(spark, sf):
    docs = views.paths(spark, sf).select("path")
    pages = views.table(spark, sf, "pages").select(F.col("url").alias("path"))
    return docs.unionByName(pages).select("path", text.parse_path(F.col("path")).alias("p")).select("path", "p.*")


@query
def slug(spark, sf):
    return views.table(spark, sf, "pages").select("page_id", text.slug(F.col("url")).alias("slug"))


@query
def affairs_list(spark, sf):
    given = views.table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit(" "), "source", F.lit(" ,, "), "lang", F.lit(", ")).alias("given")
    )
    return given.select("doc_id", F.explode(text.affairs_list(F.col("given"))).alias("affair"))


@query
def select_affair(spark, sf):
    return files.select_affair(views.paths(spark, sf).select("path"), "SRC1")


@query
def build_documents(spark, sf):
    return files.build_documents(views.analyzed(spark, sf)).withColumn("content", F.md5("content"))


@query
def page_cost(spark, sf):
    return files.page_cost(views.docs(spark, sf), by=["language"])


@query
def id_collisions(spark, sf):
    visited = views.table(spark, sf, "pages").select(
        text.slug(F.col("url")).alias("id"), F.col("url").alias("file_path")
    )
    return files.id_collisions(visited)


# --- stores --------------------------------------------------------------------


@query
def document_count(spark, sf):
    return store.document_count(views.docs(spark, sf))


@query
def fetch_by_ids(spark, sf):
    docs = views.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang", "n_chars")
    ids = views.table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return store.fetch_by_ids(docs, ids)


@query
def latest_per_key(spark, sf):
    events = views.table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return store.latest_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query
def upsert_documents(spark, sf):
    """Labelled documents come again with a changed text; pages are new."""
    docs = views.table(spark, sf, "documents")
    old = docs.select(F.concat(F.lit("d"), "doc_id").alias("id"), F.md5("text").alias("content"), F.lit(1).alias("version"))
    again = docs.join(views.table(spark, sf, "labels"), "doc_id").select(
        F.concat(F.lit("d"), "doc_id").alias("id"), F.md5(F.concat("text", F.col("quality").cast("string"))).alias("content"),
        (F.lit(2) + F.col("quality")).alias("version"),
    )
    new = views.table(spark, sf, "pages").select(
        F.concat(F.lit("p"), "page_id").alias("id"), F.md5("html").alias("content"), F.lit(2).alias("version")
    )
    return store.upsert_by_key(old, again.unionByName(new), ["id"], ["version", "content"])


# --- documents of an affair ----------------------------------------------------


@query
def docs_for_affair(spark, sf):
    return pick.docs_for_affair(views.docs(spark, sf), "Src1").select("id", "page_count")


@query
def exclude_kinds(spark, sf):
    return pick.exclude_kinds(views.docs(spark, sf))[0].select("id")


@query
def excluded_ids(spark, sf):
    return pick.exclude_kinds(views.docs(spark, sf))[1]


@query
def match_affairs(spark, sf):
    return pick.match_affairs(views.docs(spark, sf), views.affairs(spark, sf)).select("affair_id", "id")


def _classified(spark, sf):
    kept, _ = pick.exclude_kinds(pick.match_affairs(views.docs(spark, sf), views.affairs(spark, sf)))
    return pick.classify(kept)


@query
def classify_documents(spark, sf):
    return pick.classify_documents(pick.classify(views.docs(spark, sf))).select("id", "doc_class")


@query
def split_report(spark, sf):
    return pick.split_report(_classified(spark, sf))


@query
def concat_contents(spark, sf):
    joined = pick.concat_contents(_classified(spark, sf))
    return joined.select(
        "affair_id", "part", "n_cg", "n_cp",
        F.length("cg_content").cast("long").alias("cg_chars"), F.md5("cg_content").alias("cg_md5"),
        F.length("cp_content").cast("long").alias("cp_chars"), F.md5("cp_content").alias("cp_md5"),
    )


def _shown(requests: DataFrame) -> DataFrame:
    said = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    chat = F.array_join(said, "\n")
    return requests.select("request_id", "affair_id", "doc_class", F.length(chat).cast("long").alias("chars"), F.md5(chat).alias("chat_md5"))


@query
def cgcp_requests(spark, sf):
    return _shown(ask.cgcp_requests(_classified(spark, sf), QUESTION, PROMPT))


@query
def avenant_requests(spark, sf):
    return _shown(ask.avenant_requests(_classified(spark, sf), AVENANT_QUESTION, PROMPT))


# --- answers ---------------------------------------------------------------------


@query
def attach_responses(spark, sf):
    """Every user's request against the answers of that number; some have none."""
    requests = views.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("request_id"))
    return ask.attach_responses(requests, views.responses(spark, sf)).select(
        "request_id", "finish_reason", "prompt_tokens", "completion_tokens"
    )


@query
def token_cost(spark, sf):
    return ask.token_cost(views.responses(spark, sf), by=["affair_id"])


@query
def response_status(spark, sf):
    return answers.response_status(views.responses(spark, sf))


@query
def parse_responses(spark, sf):
    return answers.parse_responses(views.responses(spark, sf)).select(
        "request_id", "affair_id", "pos", "product_name", "price_unitaire", "quantity", "loyer"
    )


@query
def nested_fields(spark, sf):
    return answers.nested_fields(views.nested_answers(spark, sf))


@query
def nested_schema(spark, sf):
    return answers.nested_schema(answers.nested_fields(views.nested_answers(spark, sf)))


@query
def unknown_keys(spark, sf):
    return answers.unknown_keys(views.responses(spark, sf))


@query
def coercion_losses(spark, sf):
    return answers.coercion_losses(views.responses(spark, sf))


@query
def rent_status(spark, sf):
    return answers.rent_status(views.responses(spark, sf))


def _texts(df: DataFrame) -> DataFrame:
    """Arrays as text, for comparison."""
    return df.withColumn("payment_methods", F.array_join("payment_methods", ","))


@query
def rectify_products(spark, sf):
    rows = views.products(spark, sf).drop("is_av")
    scrambled = rows.select(*sorted(rows.columns, reverse=True))
    return _texts(answers.rectify(scrambled))


@query
def normalize_missing(spark, sf):
    marked = views.products(spark, sf).select(
        "request_id", "pos",
        F.coalesce("signature_date_cp", F.lit("null")).alias("signature_date_cp"),
        F.coalesce("product_code", F.lit("null")).alias("product_code"),
    )
    return values.normalize_missing(marked, ["signature_date_cp", "product_code"])


@query
def render_missing(spark, sf):
    rows = views.products(spark, sf).select(
        "request_id", "pos", "signature_date_cp", "signature_date_av", "avenant_number", "product_code",
        "one_shot_service", "reval_method",
    )
    return values.render_missing(rows)


@query
def enum_violations(spark, sf):
    return answers.enum_violations(views.products(spark, sf))


@query
def format_violations(spark, sf):
    found = answers.format_violations(views.products(spark, sf))
    shown = F.when(F.col("column").startswith("confidence_"), F.col("value").cast("double") * 25).otherwise(F.length("value"))
    return found.select("affair_id", "request_id", "pos", "column", F.round(shown, 4).alias("measure"))


# --- consolidation -----------------------------------------------------------------


def _split_products(spark, sf):
    rows = views.products(spark, sf)
    return rows.filter(~F.col("is_av")).drop("is_av"), rows.filter("is_av").drop("is_av")


@query
def consolidate(spark, sf):
    cpcg, av = _split_products(spark, sf)
    rows = merge.consolidate(cpcg, av, sizes=views.product_affairs(spark, sf))
    return rows.select("affair_id", "request_id", "pos", "is_av", _iso(F.col("signature_date")).alias("signature_date"), "seq")


@query
def sequence_products(spark, sf):
    return merge.sequence_products(views.products(spark, sf), sizes=views.product_affairs(spark, sf)).select("affair_id", "request_id", "pos", "seq")


@query
def avenant_coverage(spark, sf):
    return merge.avenant_coverage(views.products(spark, sf).filter("is_av"))


@query
def amendment_delta(spark, sf):
    rows = cut(views.products(spark, sf).select(*amend.COMPARED))
    # keys first: sequence and comparison then read the rows once, dealt by affair
    sequenced = merge.sequence_products(amend.with_product_key(rows, 0.3), sizes=rows)
    return amend.amendment_delta(sequenced, sizes=rows)


@query
def match_by_description(spark, sf):
    rows = cut(views.products(spark, sf).select("affair_id", "is_av", "product_name"))
    return amend.match_by_description(rows.filter(~F.col("is_av")), rows.filter("is_av"), 0.3)


@query
def resolve_terms(spark, sf):
    columns = ["devise_de_facturation", "reconduction_tacite", "billing_frequency"]
    return amend.resolve_terms(views.cg_terms(spark, sf), views.cp_terms(spark, sf), columns)


@query
def pack_results(spark, sf):
    packed = results.pack_results(merge.consolidate_flagged(views.products(spark, sf), sizes=views.product_affairs(spark, sf)))
    names = F.array_join(F.transform("rows", lambda r: r["product_name"]), "|")
    codes = F.array_join(F.transform("rows", lambda r: F.coalesce(r["product_code"], F.lit("null"))), "|")
    return packed.select("id", "part", "first_seq", F.size("rows").alias("n_rows"), names.alias("names"), codes.alias("codes"))


@query
def unpack_results(spark, sf):
    packed = results.pack_results(merge.consolidate_flagged(views.products(spark, sf), sizes=views.product_affairs(spark, sf)))
    return results.unpack_results(packed).select(
        "affair_id", "seq", "product_name", "product_code", F.round("loyer", 2).alias("loyer"), "avenant_number", "one_shot_service"
    )


@query
def upsert_results(spark, sf):
    """Affairs with amendments get new records; the others keep theirs. Which those are is known from the incoming rows."""
    rows = views.products(spark, sf)
    sizes = views.product_affairs(spark, sf)
    before = results.pack_results(merge.consolidate_flagged(rows.filter(~F.col("is_av")), sizes=sizes))
    lines = views.table(spark, sf, "lineitem").filter("l_linenumber > 4")
    touched = lines.select(F.col("l_orderkey").cast("string").alias("id")).distinct()
    again = merge.consolidate_flagged(rows.join(touched.withColumnRenamed("id", "affair_id"), "affair_id", "left_semi"), sizes=sizes)
    return results.upsert_results(before, results.pack_results(again), touched).select("id", "part", F.size("rows").alias("n_rows"))


# --- prices ----------------------------------------------------------------------------


RENTS = ["price_unitaire", "loyer", "billing_frequency", "loyer_periodicity"]


@query
def clean_rents(spark, sf):
    return pricing.clean_rents(views.products(spark, sf), sizes=views.product_affairs(spark, sf)).select("affair_id", "request_id", "pos", *RENTS)


@query
def clean_rents_unsafe(spark, sf):
    return pricing.clean_rents(views.products(spark, sf), safe=False).select("affair_id", "request_id", "pos", *RENTS)


@query
def clean_rents_moved(spark, sf):
    return pricing.clean_rents_moved(views.products(spark, sf))


@query
def derive_rents(spark, sf):
    return pricing.derive_rents(views.products(spark, sf)).select(
        "request_id", "pos", "loyer_facturation", "loyer_facturation_status", "loyer_annuele", "loyer_annuele_status"
    )


@query
def volume_unit_price(spark, sf):
    return pricing.volume_unit_price(views.products(spark, sf)).select("request_id", "pos", "volume_unit_price")


@query
def contract_end(spark, sf):
    return pricing.contract_end(views.products(spark, sf)).select(
        "request_id", "pos", _iso(F.col("date_end_calc")).alias("date_end_calc"), "date_end_status"
    )


@query
def apply_null_rules(spark, sf):
    return pricing.apply_null_rules(views.products(spark, sf)).select(
        "request_id", "pos", "price_unitaire", "loyer", "billing_frequency", "loyer_periodicity", "term_mode",
        "reval_method", "is_volume_product", "usage_overconsumption_price",
    )


@query
def null_rule_violations(spark, sf):
    return pricing.null_rule_violations(views.products(spark, sf))


# --- values in texts ---------------------------------------------------------------------


FRENCH_MONTHS = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"]


@query
def parse_dates(spark, sf):
    """Order dates written five ways."""
    names = "array(" + ", ".join(f"'{m}'" for m in FRENCH_MONTHS) + ")"
    written = F.expr(
        "case o_orderkey % 5 when 0 then date_format(o_orderdate, 'yyyy-MM-dd') when 1 then date_format(o_orderdate, 'dd/MM/yyyy')"
        " when 2 then concat(' ', lower(date_format(o_orderdate, 'd MMM yyyy')))"
        f" when 3 then concat(day(o_orderdate), ' ', element_at({names}, month(o_orderdate)), ' ', year(o_orderdate))"
        " else concat('le ', date_format(o_orderdate, 'yyyyMMdd')) end"
    )
    return views.table(spark, sf, "orders").select("o_orderkey", _iso(values.parse_date(written)).alias("parsed"))


@query
def parse_numbers(spark, sf):
    written = F.expr(
        "case l_linenumber when 1 then concat(' ', l_extendedprice) when 2 then concat(l_extendedprice, 'd') when 3 then 'null'"
        " when 4 then concat('-', l_extendedprice) when 5 then concat(cast(l_quantity as int), 'e2') when 6 then '' else null end"
    )
    return views.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", values.parse_number(written).alias("number")
    )


@query
def line_flags(spark, sf):
    lines = read.text_lines(views.lines(spark, sf), low=True)
    return lines.select("id", "line_no", contract.line_flags(F.col("low")).alias("f")).select("id", "line_no", "f.*")


@query
def priced_lines(spark, sf):
    return read.priced_lines(views.lines(spark, sf)).drop("line", "is_period", "unit_only")


@query
def drop_recaps(spark, sf):
    return read.drop_recaps(read.text_lines(views.lines(spark, sf), low=True)).select("affair_id", "id", "line_no", F.md5("line").alias("line_md5"))


@query
def rule_extract(spark, sf):
    return read.rule_extract(views.lines(spark, sf)).select(
        "affair_id", "id", "line_no", "amount_no", "product_name", "is_included", "one_shot_service", "is_volume_product",
        "price_unitaire", "loyer", "loyer_periodicity", "devise_de_facturation", "tax_basis",
        "product_code", "quantity", "quantity_periodicity",
    )


@query
def volume_period(spark, sf):
    """Names of volume lines built per order line, among ordinary names."""
    rows = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "l_shipdate")
    rows = views.spread(rows).join(views.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    half = F.when(F.month("l_shipdate") <= 6, "S1").otherwise("S2")
    name = F.when(F.col("l_linestatus") == "O", contract.volume_name(F.col("p_type"), F.year("l_shipdate"), half)).otherwise(F.col("p_name"))
    rows = rows.withColumn("product_name", name)
    return rows.select("l_orderkey", "l_linenumber", "product_name", contract.volume_period(F.col("product_name")).alias("v")).select(
        "l_orderkey", "l_linenumber", "product_name", "v.*"
    )


@query
def service_start(spark, sf):
    rows = views.spread(views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"))
    rows = rows.join(views.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    wording = F.expr(
        "case l_linenumber % 3 when 0 then 'Effet à la signature du contrat' when 1 then date_format(l_shipdate, 'dd/MM/yyyy') else 'selon planning' end"
    )
    av = F.expr("if(l_linenumber > 4, date_format(l_shipdate, 'dd/MM/yyyy'), null)")
    cp = F.expr("date_format(o_orderdate, 'yyyy-MM-dd')")
    return rows.select("l_orderkey", "l_linenumber", _iso(contract.service_start(wording, av, cp)).alias("service_start"))


@query
def overconsumption(spark, sf):
    wording = F.expr(
        "case l_linenumber % 4 when 0 then concat('utilisateur supplémentaire ', cast(l_quantity as int), ',05 € / mois')"
        " when 1 then concat('unité d’œuvre surcotée de ', cast(l_quantity as int), '% vs palier, facturée par semestre, terme échu')"
        " when 2 then 'Hébergement 10 € par an' else null end"
    )
    rows = views.spread(views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"))
    said = rows.select("*", wording.alias("said"))
    said = said.withColumn("low", F.lower("said"))
    return said.select(
        "l_orderkey", "l_linenumber", "l_quantity", contract.overconsumption(F.col("said"), F.col("low")).alias("o")
    ).select("l_orderkey", "l_linenumber", "l_quantity", "o.*")


@query
def split_duration(spark, sf):
    orders = views.table(spark, sf, "orders")
    wording = F.expr(
        "case o_orderkey % 3 when 0 then concat(12 * (1 + o_custkey % 5), ' mois + prorata de la  période en cours')"
        " when 1 then cast(12 * (1 + o_custkey % 5) as string) else 'durée du projet' end"
    )
    return orders.select("o_orderkey", contract.split_duration(wording, F.col("o_orderstatus") == "P").alias("d")).select("o_orderkey", "d.*")


@query
def payment_methods(spark, sf):
    text_ = F.col("content")
    return views.contract_texts(spark, sf).select(
        "id", F.array_join(contract.payment_methods(text_), ",").alias("methods"), contract.payment_terms(text_).alias("terms")
    )


@query
def contract_terms(spark, sf):
    found = terms.contract_terms(views.contract_texts(spark, sf))
    return found.select(
        "id", "numero_de_contrat", "devise_de_facturation", "reconduction_tacite", "tax_basis", "bon_de_commande",
        "bon_de_commande_code", "debut_facturation", _iso(F.col("signature_date")).alias("signature_date"), "era",
    )


@query
def reval_terms(spark, sf):
    texts = views.contract_texts(spark, sf).withColumn("low", F.lower("content"))
    return texts.select("id", contract.reval_terms(F.col("content"), F.col("low")).alias("r")).select("id", "r.*")


@query
def clean_evidence(spark, sf):
    docs = views.spread(views.table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.md5(text.clean_evidence(F.col("text"))).alias("evidence_md5"))


@query
def citations(spark, sf):
    quoted = F.expr(
        "concat('Prix ', l_extendedprice, ' [CP p', l_linenumber, '] puis', if(l_returnflag = 'R', concat(' [AV', l_suppkey % 9, ', p', l_partkey, ']'), ' [XX p1]'))"
    )
    rows = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag")
    rows = views.spread(rows).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.posexplode(text.citations(quoted)).alias("n", "c"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "n", "c.source", "c.page")


# --- audits ---------------------------------------------------------------------------------


@query
def affair_constancy(spark, sf):
    return audit.affair_constancy(views.products(spark, sf))


@query
def row_count_check(spark, sf):
    return audit.row_count_check(read.priced_lines(views.lines(spark, sf)), views.products(spark, sf))


@query
def sla_check(spark, sf):
    products = views.products(spark, sf)
    level = F.when(F.col("one_shot_service") & F.col("is_included"), F.lit("04317"))
    named = F.when(F.col("is_av") & F.col("is_volume_product"), F.lit("Niveau de service Standard")).otherwise(F.col("product_name"))
    return audit.sla_check(views.lines(spark, sf), products.withColumns({"product_code": level, "product_name": named}))


@query
def total_alignment(spark, sf):
    found = audit.total_alignment(read.priced_lines(views.lines(spark, sf)))
    return found.select("affair_id", "n_recaps", F.col("lines_total").cast("double").alias("lines_total"), F.col("gap").cast("double").alias("gap"), "aligned")


@query
def section_totals(spark, sf):
    found = audit.section_totals(read.priced_lines(views.lines(spark, sf)))
    money = [F.col(c).cast("double").alias(c) for c in ("printed", "expected", "gap")]
    return found.select("affair_id", "id", "line_no", "amount_no", "level", *money, "aligned")


@query
def value_conflicts(spark, sf):
    return audit.value_conflicts(views.products(spark, sf))


@query
def price_confidence(spark, sf):
    shown = ["affair_id", "id", "line_no", "amount_no", "label"]
    found = audit.price_confidence(read.priced_lines(views.lines(spark, sf)), shown)
    signals = [c for c in audit.SIGNALS if c in found.columns]
    return found.select(*shown, *signals, "confidence")


@query
def confidence_score(spark, sf):
    signals = views.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "if(l_linenumber = 7, null, cast(l_quantity as int)) as value",
        "if(l_linenumber % 3 = 0, null, concat('q ', if(l_linestatus = 'O', cast(l_quantity as int), -1))) as evidence",
        "l_linenumber % 3 <> 0 as has_evidence", "l_returnflag <> 'N' as is_labelled", "l_tax > 0.02 as is_nearby",
        "l_discount > 0.03 as is_aligned", "l_suppkey % 7 = 0 as has_conflict", "l_partkey % 5 = 0 as is_distant",
        "if(l_suppkey % 3 = 0, null, l_suppkey % 3 = 1) as overrides_cg", "l_partkey % 11 = 0 as is_missing_data",
        "l_suppkey % 11 = 0 as is_ambiguous", "l_quantity > 45 as is_garbled",
    )
    scored = audit.confidence(signals, "value", "evidence")
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "confidence")


@query
def confidence_audit(spark, sf):
    return audit.confidence_audit(views.products(spark, sf))
