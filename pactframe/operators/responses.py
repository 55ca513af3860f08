"""Answers to product rows, and the checks on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactframe.functions.values import flag, normalize_missing
from pactframe.schemas import (
    CONFIDENCE_OF,
    ENUMS,
    PAYMENT_METHODS,
    PRODUCT,
    PRODUCT_COLUMNS,
    PRODUCT_KEYS,
)
from pactframe.session import cut

BROKEN = "_broken"
DERIVED_RENTS = ["loyer_facturation", "loyer_annuele"]
UNKNOWN = ("unknown",)
ERROR_ITEM, EVIDENCE, NOTES = 140, 80, 160


def decode(responses: DataFrame, schema: T.StructType = PRODUCT) -> DataFrame:
    """Adds `products` (typed array) and `status` to each response.

    An answer that parses is used whatever its finish reason; one cut off in the middle of its JSON is `truncated`.
    """
    answer = T.StructType(
        [T.StructField("products", T.ArrayType(schema)), T.StructField(BROKEN, T.StringType())]
    )
    parsed = F.from_json("arguments", answer, {"columnNameOfCorruptRecord": BROKEN, "mode": "PERMISSIVE"})
    status = (
        F.when(F.col("arguments").isNull(), "no_tool_call")
        .when(
            F.col("_answer.products").isNull() & F.col(f"_answer.{BROKEN}").isNotNull(),
            F.when(F.col("finish_reason") == "length", F.lit("truncated")).otherwise(F.lit("bad_json")),
        )
        .when(F.coalesce(F.size("_answer.products"), F.lit(0)) <= 0, "no_products")
        .otherwise("ok")
    )
    return (
        responses.withColumn("_answer", parsed)
        .withColumns({"status": status, "products": F.col("_answer.products")})
        .drop("_answer")
    )


def response_status(responses: DataFrame) -> DataFrame:
    rows = F.when(F.col("status") == "ok", F.size("products")).otherwise(0)
    hit_limit = flag(F.col("finish_reason") == "length")
    return decode(responses).select("request_id", "status", rows.alias("n_products"), hit_limit.alias("hit_limit"))


def parse_responses(responses: DataFrame, schema: T.StructType = PRODUCT) -> DataFrame:
    """One row per product of the usable answers, keeping the other columns of the response."""
    done = ("arguments", "products", "status", "finish_reason", "prompt_tokens", "completion_tokens", "total_tokens", "messages")
    good = decode(responses, schema).filter("status = 'ok'")
    carried = [c for c in good.columns if c not in done]
    rows = good.select(*carried, F.posexplode("products").alias("pos", "_product"))
    return normalize_missing(
        rows.select(*carried, "pos", "_product.*"),
        [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)],
    )


def nested_fields(responses: DataFrame) -> DataFrame:
    """request_id, pos, name, value: every field of every product of the answers that parse, objects flattened to dotted
    names, whatever keys they have. Lists and empty objects are kept as JSON text; a JSON null is a NULL value.

    Objects are opened level by level; each level is written once, and as many are as the deepest answer has.
    """
    tvf = responses.sparkSession.tvf
    parsed = responses.select("request_id", F.try_parse_json("arguments").alias("_answer"))
    products = F.try_variant_get("_answer", "$.products", "variant")
    rows = parsed.select("request_id", products.alias("_products")).lateralJoin(tvf.variant_explode(F.col("_products").outer()))
    level = rows.select("request_id", "pos", F.lit(None).cast("string").alias("name"), F.col("value").alias("_value"))
    found = []
    while True:
        opened = level.lateralJoin(tvf.variant_explode(F.col("_value").outer()).select(F.col("key"), F.col("value").alias("_inner")))
        kind = F.schema_of_variant("_inner")
        opened = opened.select(
            "request_id", "pos", F.concat_ws(".", "name", "key").alias("name"), F.col("_inner").alias("_value"),
            (F.startswith(kind, F.lit("OBJECT<")) & (kind != "OBJECT<>")).alias("_open"),
            F.startswith(kind, F.lit("ARRAY")).alias("_list"),
        )
        held = cut(opened)
        text = F.when(F.col("_list"), F.to_json("_value")).otherwise(F.coalesce(F.try_variant_get("_value", "$", "string"), F.nullif(F.to_json("_value"), F.lit("null"))))
        found.append(held.filter(~F.col("_open")).select("request_id", F.col("pos").cast("int").alias("pos"), "name", text.alias("value")))
        level = held.filter("_open").select("request_id", "pos", "name", "_value")
        if level.limit(1).count() == 0:
            return reduce(DataFrame.unionByName, found)


def nested_schema(fields: DataFrame) -> DataFrame:
    """The columns a table of these answers would have: name, products that have it, products where it is not NULL."""
    return fields.groupBy("name").agg(F.count(F.lit(1)).alias("n_products"), F.count("value").alias("n_values"))


def _objects(responses: DataFrame, schema: T.StructType) -> DataFrame:
    """request_id, pos, `_typed` and `_given` (the same product as a map of texts) of the usable answers."""
    loose = F.from_json("arguments", "products ARRAY<MAP<STRING, STRING>>")["products"]
    good = decode(responses, schema).filter("status = 'ok'").select("request_id", "products", loose.alias("loose"))
    both = good.select("request_id", F.posexplode(F.arrays_zip("products", "loose")).alias("pos", "_both"))
    return both.select("request_id", "pos", F.col("_both.products").alias("_typed"), F.col("_both.loose").alias("_given"))


def coercion_losses(responses: DataFrame, schema: T.StructType = PRODUCT) -> DataFrame:
    """Values that the typed columns could not take, as (request_id, pos, column, given); stated absences are none."""
    found = []
    for field in schema.fields:
        if isinstance(field.dataType, T.StringType):
            continue
        given = F.try_element_at("_given", F.lit(field.name))
        stated = ~F.lower(F.trim(given)).isin("", "null", *UNKNOWN)
        lost = given.isNotNull() & stated & F.col(f"_typed.{field.name}").isNull()
        found.append(F.when(lost, F.struct(F.lit(field.name).alias("column"), given.alias("given"))))
    return _objects(responses, schema).select("request_id", "pos", F.inline(F.array_compact(F.array(*found))))


def rent_status(responses: DataFrame, columns: list[str] = DERIVED_RENTS, schema: T.StructType = PRODUCT) -> DataFrame:
    """For the two derived rents, `ok` with a number, `unknown` where the answer says so, else NULL."""
    def status(name: str) -> Column:
        said = F.lower(F.trim(F.try_element_at("_given", F.lit(name)))).isin(*UNKNOWN)
        known = F.col(f"_typed.{name}").isNotNull()
        return F.when(known, F.lit("ok")).when(said, F.lit("unknown")).alias(f"{name}_status")

    return _objects(responses, schema).select("request_id", "pos", *[status(c) for c in columns])


def unknown_keys(responses: DataFrame, expected: list[str] = PRODUCT_COLUMNS + ["affair_id"]) -> DataFrame:
    """Keys of product objects that the schema does not have, as (request_id, pos, key)."""
    loose = F.from_json("arguments", "products ARRAY<MAP<STRING, STRING>>")["products"]
    known = F.array(*[F.lit(k) for k in expected])
    objects = responses.select("request_id", F.posexplode(loose).alias("pos", "_object"))
    return objects.select("request_id", "pos", F.explode(F.array_except(F.map_keys("_object"), known)).alias("key"))


def validate_columns(df: DataFrame, expected: list[str] = PRODUCT_COLUMNS) -> None:
    """Column names must be exactly the expected ones, once each; order is free. Reads no data."""
    extra = sorted(set(df.columns) - set(expected))
    missing = [c for c in expected if c not in df.columns]
    twice = sorted({c for c in df.columns if df.columns.count(c) > 1})
    if extra or missing or twice:
        raise ValueError(f"column mismatch: unexpected {extra}, missing {missing}, repeated {twice}")


def rectify(df: DataFrame, carried: list[str] | None = None, schema: T.StructType = PRODUCT) -> DataFrame:
    """The product columns in their fixed order and types, after the carried key columns."""
    carried = [c for c in (carried if carried is not None else PRODUCT_KEYS) if c in df.columns]
    validate_columns(df.drop(*carried), schema.fieldNames())
    return df.select(*carried, *[F.col(f.name).cast(f.dataType) for f in schema.fields])


def _violations(df: DataFrame, checks: list[tuple[str, Column, Column]], columns: list[str]) -> DataFrame:
    """Long table of failed checks: one pass, no self-unions. A check is (name, value, failed)."""
    found = F.array(
        *[
            F.when(
                flag(failed),
                F.struct(F.lit(name).alias(columns[0]), value.cast("string").alias(columns[1])),
            )
            for name, value, failed in checks
        ]
    )
    keys = [k for k in PRODUCT_KEYS if k in df.columns]
    return df.select(*keys, F.inline(F.array_compact(found)))


def enum_violations(products: DataFrame) -> DataFrame:
    """Values outside their list, as (keys, column, value)."""
    checks = [(c, F.col(c), ~F.col(c).isin(allowed)) for c, allowed in ENUMS.items() if c in products.columns]
    if "payment_methods" in products.columns:
        wrong = F.filter("payment_methods", lambda m: ~m.isin(PAYMENT_METHODS))
        checks.append(("payment_methods", F.array_join(wrong, ","), F.size(wrong) > 0))
    return _violations(products, checks, ["column", "value"])


def format_violations(products: DataFrame) -> DataFrame:
    """Values that break a format or length rule, as (keys, column, value).

    A fractional amendment number never reaches its integer column: `coercion_losses` reports it.
    """
    have = set(products.columns)
    checks: list[tuple[str, Column, Column]] = []
    if "numero_de_contrat" in have:
        checks.append(("numero_de_contrat", F.col("numero_de_contrat"), ~F.col("numero_de_contrat").rlike(r"^\d+-\d+$")))
    if {"quantity", "is_volume_product"} <= have:
        checks.append(("quantity", F.col("quantity"), F.col("is_volume_product") & (F.col("quantity") % 1 != 0)))
    for c in CONFIDENCE_OF:
        if c in have:
            checks.append((c, F.col(c), ~F.col(c).between(0.0, 1.0)))
    for c in sorted(have):
        if c.startswith("evidence_") and c != "evidence_contract_errors":
            checks.append((c, F.col(c), F.length(c) > EVIDENCE))
    if "evidence_contract_errors" in have:
        items = F.split("evidence_contract_errors", r"\s*[;\n]\s*")
        long = F.filter(items, lambda x: F.length(x) > ERROR_ITEM)
        checks.append(("evidence_contract_errors", F.array_join(long, ";"), F.size(long) > 0))
    if "usage_notes" in have:
        checks.append(("usage_notes", F.col("usage_notes"), F.length("usage_notes") > NOTES))
    return _violations(products, checks, ["column", "value"])


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
