"""Contract-shaped views over the given tables. Everything derives from whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactframe.functions.text import slug
from pactframe.schemas import PRODUCT


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """An input of fewer pieces than cores is dealt out first; a large one is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def paths(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").withColumn(
        "path",
        F.expr(
            "concat(upper(left(lang, 1)), '/co_', lang, '/', source, '/',"
            " element_at(array('CADRE', 'CP', concat('AVENANT-', doc_id % 4), 'CONTRAT-SAAS', 'CG-AVENANT-1', 'CP-ASP-x'),"
            " cast((doc_id div 20) % 6 + 1 as int)), '-', doc_id, if(doc_id % 11 = 0, '.PDF', '.pdf'))"
        ),
    )


def docs(spark: SparkSession, sf: str) -> DataFrame:
    key = slug(F.col("path"))
    return paths(spark, sf).select(
        key.alias("id"),
        F.lower(key).alias("id_lc"),
        F.col("path").alias("file_path"),
        F.col("text").alias("content"),
        F.col("lang").alias("language"),
        F.expr("cast(1 + n_chars div 1800 as int)").alias("page_count"),
        F.col("n_chars").cast("long").alias("n_chars"),
    )


def affairs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("source").alias("affair")).distinct()


def analyzed(spark: SparkSession, sf: str) -> DataFrame:
    return paths(spark, sf).select(
        "path",
        F.col("text").alias("content"),
        F.expr("if(lang = 'en', cast(array() as array<string>), array(lang))").alias("languages"),
        F.expr("cast(1 + n_chars div 1800 as int)").alias("page_count"),
        F.lit(None).cast("string").alias("error"),
    )


def _period(col: str, modulo: int) -> str:
    return f"element_at(array('Mensuelle', 'Trimestrielle', 'Semestrielle', 'Annuelle', null), cast({col} % {modulo} + 1 as int))"


PRODUCT_VALUES = {
    "company_name": "concat('Client ', o_custkey)",
    "numero_de_contrat": "concat(date_format(o_orderdate, 'yyyyMM'), if(o_orderpriority = '1-URGENT', '/', '-'), o_custkey)",
    "signature_date_cp": "if(l_linenumber <= 4, date_format(o_orderdate, 'yyyy-MM-dd'), null)",
    "signature_date_av": "if(l_linenumber > 4, date_format(l_shipdate, 'dd/MM/yyyy'), null)",
    "avenant_number": "if(l_linenumber > 4, l_linenumber - 4, null)",
    "product_code": "if(l_tax = 0, null, p_type)",
    # amendments write some names in the plural, and some with a letter left out
    "product_name": "case when l_linenumber = 6 then concat(p_name, 's') when l_linenumber = 7 then concat(left(p_name, 1), substr(p_name, 3)) else p_name end",
    "duree_de_service": "case when l_partkey % 77 = 0 then '99999999999 mois' when l_partkey % 7 = 0 then null"
    " else concat(12 * (1 + l_partkey % 5), ' mois') end",
    "duree_de_service_notes": "if(l_suppkey % 2 = 0, '+ prorata de la période en cours', null)",
    "reconduction_tacite": "o_orderstatus = 'P'",
    "term_mode": "element_at(array('À échoir', 'Échu', 'Annuel'), cast(l_linenumber % 3 + 1 as int))",
    "billing_frequency": _period("l_partkey", 5),
    "payment_methods": "if(l_linenumber = 3, array('virement', 'bitcoin'), array('virement'))",
    "price_unitaire": "if(l_returnflag = 'R' and l_linenumber % 2 = 0, null, l_extendedprice / l_quantity)",
    "quantity": "l_quantity",
    "quantity_periodicity": _period("l_suppkey", 4),
    "is_volume_product": "l_linestatus = 'O'",
    "loyer": "l_extendedprice",
    "devise_de_facturation": "case l_suppkey % 10 when 0 then 'USD' when 1 then 'XAF' else 'EUR' end",
    "loyer_periodicity": _period("l_linenumber", 5),
    "one_shot_service": "l_returnflag = 'R'",
    "tax_basis": "'HT'",
    "is_included": "l_discount = 0",
    "usage_overconsumption_price": "if(l_partkey % 3 = 0, '0.05', null)",
    "usage_notes": "repeat('ab', cast(4 * l_quantity as int))",
    "reval_method": "element_at(array('fixed_rate', 'index_formula', 'Syntec', null), cast(l_linenumber % 4 + 1 as int))",
    "evidence_price": "if(l_tax < 0.04, null, concat('PU ', cast(l_quantity as int), ' x'))",
    "evidence_usage": "if(l_suppkey % 2 = 0, null, 'tarif 0.05 EUR')",
    "evidence_revalorization": "if(l_suppkey % 3 = 0, null, 'révision par Syntec')",
    "evidence_billing": "if(l_partkey % 2 = 0, null, 'facture Mensuelle')",
    "evidence_dates": "if(l_partkey % 3 = 0, null, concat('signé le ', date_format(o_orderdate, 'yyyy-MM-dd')))",
    "evidence_avenant": "if(l_suppkey % 2 = 0, null, 'avenant 1')",
    "evidence_contract_errors": "if(l_partkey % 10 = 0, concat('prix manquant; ', repeat('x', 130 + l_suppkey % 20)), null)",
    "confidence_price": "l_quantity / 25",
    "confidence_usage": "l_linenumber / 10D",
    "confidence_revalorization": "l_linenumber / 8D",
    "confidence_billing": "l_linenumber / 10D",
    "confidence_dates": "if(l_linenumber = 1, null, 1D)",
    "confidence_company": "if(l_linenumber = 2, 0.95D, 1D)",
    "confidence_avenant": "0.9D",
}
TIE = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_tax"]


def products(spark: SparkSession, sf: str) -> DataFrame:
    """One product row per order line, all product columns present.

    Orders are joined last and by `affair_id`: whatever groups by affair finds the rows dealt by it, and the wide rows are
    not shuffled again.
    """
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    lines = table(spark, sf, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    orders = table(spark, sf, "orders").withColumn("_affair", F.col("o_orderkey").cast("string"))
    rows = lines.withColumn("affair_id", F.col("l_orderkey").cast("string")).join(orders, F.col("affair_id") == F.col("_affair"))
    rows = rows.withColumns(
        {
            "is_av": F.col("l_linenumber") > 4,
            "request_id": F.expr("concat(l_orderkey, if(l_linenumber > 4, concat('|AV|', l_linenumber - 4), '|CGCP'))"),
        }
    )
    rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("affair_id", "is_av", "request_id").orderBy(*TIE)) - 1)

    def value(name: str, kind) -> Column:
        return (F.expr(PRODUCT_VALUES[name]) if name in PRODUCT_VALUES else F.lit(None)).cast(kind).alias(name)

    return rows.select("affair_id", "request_id", "pos", "is_av", *[value(f.name, f.dataType) for f in PRODUCT.fields])


def product_affairs(spark: SparkSession, sf: str) -> DataFrame:
    """The affair of each row that `products` is made from: one column, read without joins."""
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("affair_id"))


def cg_terms(spark: SparkSession, sf: str) -> DataFrame:
    """General terms by order, from its customer. Those of household customers are filed under keys of their own, so that
    either side has keys that the other lacks."""
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return orders.select(
        F.expr("if(c_mktsegment = 'HOUSEHOLD', -o_orderkey, o_orderkey)").alias("affair_id"),
        F.expr("case c_mktsegment when 'BUILDING' then 'USD' when 'MACHINERY' then null else 'EUR' end").alias("devise_de_facturation"),
        F.expr("if(o_orderpriority = '3-MEDIUM', null, c_mktsegment in ('AUTOMOBILE', 'BUILDING'))").alias("reconduction_tacite"),
        F.expr("if(c_mktsegment = 'FURNITURE', 'Annuelle', 'Mensuelle')").alias("billing_frequency"),
    )


def cp_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Specific terms by order, some of them not stated."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("affair_id"),
        F.expr("if(o_orderstatus = 'O', null, 'GBP')").alias("devise_de_facturation"),
        F.expr("if(o_orderstatus = 'O', null, o_orderstatus = 'P')").alias("reconduction_tacite"),
        F.expr("if(o_orderpriority = '5-LOW', null, 'Trimestrielle')").alias("billing_frequency"),
    )


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """One answer per event, as JSON text: good, empty, cut off (or whole, but at the length limit), with an unknown
    key, with a price no number column takes, or with a rent said to be unknown."""
    full = (
        "concat('{\"products\":[', if(event_type = 'error' and event_id % 89 <> 0, '', concat('{\"product_name\":\"', event_type,"
        " '\",\"price_unitaire\":', if(event_id % 83 = 0, '\"1 200,50\"', cast(value as string)), if(event_id % 79 = 0, ',\"loyer_annuele\":\"unknown\"', ''),"
        " ',\"quantity\":', get_json_object(props, '$.k'),"
        " if(event_id % 89 = 0, ',\"remise\":1', ''), '}')), ']}')"
    )
    at_limit = F.expr("event_id % 97 = 0")
    cut = F.expr("event_id % 97 = 0 and event_id % 194 <> 0")
    text = F.expr(full)
    return spread(table(spark, sf, "events").drop("ts")).select(
        F.col("event_id").cast("string").alias("request_id"),
        F.col("user_id").cast("string").alias("affair_id"),
        F.when(cut, F.left(text, F.length(text) - 5)).otherwise(text).alias("arguments"),
        F.when(at_limit, F.lit("length")).otherwise(F.lit("tool_calls")).alias("finish_reason"),
        F.expr("1000 + event_id % 5000").alias("prompt_tokens"),
        F.expr("200 + event_id % 700").alias("completion_tokens"),
        F.expr("1200 + event_id % 5000 + event_id % 700").alias("total_tokens"),
    )


def nested_answers(spark: SparkSession, sf: str) -> DataFrame:
    """One answer per event with objects in objects, lists, nulls and keys that only some products have; some are cut off."""
    text = (
        "concat('{\"products\":[', if(event_type = 'error', '', concat('{\"product_name\":\"', event_type, '\",\"price\":{\"unit\":', floor(value),"
        " ',\"per\":{\"period\":\"Mensuelle\",\"count\":null}},\"meta\":', props, ',\"tags\":[\"a\",{\"b\":1}],\"none\":{}',"
        " if(event_id % 89 = 0, ',\"remise\":{\"rate\":0.5}', ''), '},{\"product_name\":\"second\"}')), ']}')"
    )
    whole = F.expr(text)
    return spread(table(spark, sf, "events").drop("ts")).select(
        F.col("event_id").cast("string").alias("request_id"),
        F.when(F.expr("event_id % 97 = 0"), F.left(whole, F.length(whole) - 5)).otherwise(whole).alias("arguments"),
    )


def _money(cents: str) -> str:
    whole = f"({cents} div 100)"
    return (
        f"concat(if({whole} >= 1000, concat({whole} div 1000, ' ', lpad({whole} % 1000, 3, '0')), cast({whole} as string)),"
        f" ',', lpad({cents} % 100, 2, '0'))"
    )


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """A text per order line: priced lines, recaps, service levels, discounts, a label above its price, and a table: one
    with code, quantity, unit price and rent, one with semester cells, or a row without a header."""
    used = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]
    rows = spread(table(spark, sf, "lineitem").select(*used))
    rows = rows.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.withColumns(
        {"cents": F.expr("cast(round(l_extendedprice * 100) as bigint)"), "units": F.expr("cast(l_quantity as bigint) * 100")}
    )
    # written once, as columns: texts that repeat them would make a method too long to be compiled
    rows = rows.withColumns({"money": F.expr(_money("cents")), "unit_money": F.expr(_money("units"))})
    money, units = "money", "unit_money"
    count = "cast(l_quantity as int)"
    tables = [
        f"""if(l_suppkey % 9 = 0, concat('| Code | Libellé | Quantité mensuelle | Prix unitaire | Loyer mensuel HT |\n| --- | --- | --- | --- | --- |\n',
              '| 04317 | ', p_name, ' | ', {count}, ' | ', {units}, ' € | ', {money}, ' € |'), null)""",
        f"""if(l_suppkey % 9 = 1, concat('Pricing mensuel volumes\n| Famille | Nombre de lignes par an | ', 2015 + l_linenumber, ' S1 | ',
              2015 + l_linenumber, ' S2 |\n|---|---|---|---|\n| ', p_name, ' | ', {count}, ' | ', {money}, ' € | ', {units}, ' € HT |'), null)""",
        f"if(l_suppkey % 9 = 2 and l_returnflag = 'R', concat('| 04311 | ', p_name, ' | ', {count}, ' | ', {money}, ' € HT |'), null)",
    ]
    parts = [
        f"concat(p_name, ' ', {money}, ' € HT', case l_linenumber % 3 when 0 then ' / mois' when 1 then ' par an' else '' end)",
        f"if(l_returnflag = 'A', concat('Licence ', {units}, ' EUR ', {money}, ' EUR TTC'), null)",
        f"""case l_linenumber
              when 1 then concat('Total ', {money}, ' € HT')
              when 2 then 'SLA Standard Inclus'
              when 3 then concat('Total abonnement, montant forfaitaire mensuel total de : ', {money}, ' €')
              when 4 then concat('REMISE COMMERCIALE -', {money}, ' € HT')
              when 5 then 'Utilisateur supplémentaire 10 € / mois'
              when 6 then 'palier S1, unité d’œuvre surcotée de 15%'
              when 7 then 'Hypercare Gratuit' end""",
        "if(l_returnflag = 'N', 'Option étendue', null)",
        f"if(l_returnflag = 'N', concat({money}, ' € HT / mois'), null)",
        *tables,
    ]
    return rows.select(
        F.col("l_orderkey").cast("string").alias("affair_id"),
        F.expr("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)").alias("id"),
        F.expr("concat_ws('\n', " + ", ".join(parts) + ")").alias("content"),
    )


def contract_texts(spark: SparkSession, sf: str) -> DataFrame:
    """A short contract per order, stating its terms in words."""
    parts = [
        "concat('CONTRAT CADRE DE REFERENCE ', date_format(o_orderdate, 'yyyyMM'), '00-', o_custkey)",
        "concat('Devise de facturation : ', element_at(array('EUR', 'USD', 'GBP'), cast(o_custkey % 3 + 1 as int)))",
        "case o_orderstatus when 'P' then 'Le contrat est renouvelé par reconduction tacite.'"
        " when 'F' then 'Le contrat est conclu sans reconduction tacite.' end",
        "if(o_orderpriority = '1-URGENT', concat('Selon bon de commande ', date_format(o_orderdate, 'yyyyMM'), ' ', lpad(o_custkey, 6, '0')), null)",
        "concat('Date de signature : ', date_format(o_orderdate, 'dd/MM/yyyy'))",
        "case o_orderpriority when '2-HIGH' then 'Début de facturation : PV VABF'"
        " when '5-LOW' then concat('Début de facturation : ', date_format(o_orderdate, 'yyyy-MM-dd')) end",
        "case o_custkey % 4 when 0 then 'Prix HT' when 1 then 'Prix TTC' end",
        "case o_custkey % 3 when 0 then '☒ Virement ☐ Prélèvement ☒ Chèque A 45 jours date de facture'"
        " when 1 then '☐ Virement ☒ Prélèvement' else '☒ Lettre de change ☒ Portail' end",
        "case o_orderkey % 4 when 0 then concat('Revalorisation annuellement de ', 1 + o_custkey % 5, ' % le 1er janvier à partir de 2016')"
        " when 1 then concat('Indexation : PN = PN-1 × (SN/SN-1), plafonnée à ', 1 + o_custkey % 5, '%')"
        " when 2 then 'Révision selon accord des parties' end",
    ]
    return spread(table(spark, sf, "orders").drop("o_totalprice")).select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.expr("concat_ws('\n', " + ", ".join(parts) + ")").alias("content"),
    )
