"""Prices, rents and contract ends of product rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactframe.functions.contract import split_duration
from pactframe.functions.values import flag, months_of, parse_number
from pactframe.operators.consolidate import signature_date
from pactframe.operators.responses import _violations, any_of
from pactframe.operators.skew import HEAVY_ROWS, by_weight
from pactframe.schemas import RECURRING_FIELDS, TACIT_END


#: Longest duration read as one: a hundred years.
MAX_MONTHS = 1200


def _mixed(name: str) -> Column:
    return F.bool_or(name) & ~F.bool_and(name)


def with_gate(products: DataFrame, floor: float = HEAVY_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """Adds `_open`: both flags take both values within the affair."""
    if not {"one_shot_service", "is_volume_product"} <= set(products.columns):
        return products.withColumn("_open", F.lit(False))
    both = ["one_shot_service", "is_volume_product"]

    def light(part: DataFrame) -> DataFrame:
        w = Window.partitionBy("affair_id")
        seen = [F.bool_or(c).over(w) & ~F.bool_and(c).over(w) for c in both]
        return part.withColumn("_open", flag(seen[0] & seen[1]))

    def heavy(part: DataFrame) -> DataFrame:
        gate = part.groupBy(F.col("affair_id").alias("_affair")).agg(flag(_mixed(both[0]) & _mixed(both[1])).alias("_open"))
        same = F.col("affair_id").eqNullSafe(F.col("_affair"))
        return part.join(F.broadcast(gate), same).drop("_affair")  # heavy keys are few

    return by_weight(products, ["affair_id"], light, heavy, floor, sizes)


def clean_rents(products: DataFrame, safe: bool = True, floor: float = HEAVY_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """One-shot rows: a rent without a price becomes the price; recurring fields go unless it is a volume row.

    With `safe`, only in affairs whose flags are mixed. Adds `rent_moved`.
    """
    gated = with_gate(products, floor, sizes) if safe else products.withColumn("_open", F.lit(True))
    price = F.col("price_unitaire")
    number = price if isinstance(products.schema["price_unitaire"].dataType, T.NumericType) else parse_number(price)
    one_shot = F.col("_open") & flag(F.col("one_shot_service"))
    move = one_shot & number.isNull() & F.col("loyer").isNotNull()
    clear = one_shot & flag(~F.col("is_volume_product"))
    moved = gated.withColumns(
        {
            "rent_moved": move,
            "price_unitaire": F.when(move, F.col("loyer").cast(products.schema["price_unitaire"].dataType)).otherwise(price),
        }
    )
    present = [c for c in RECURRING_FIELDS if c in products.columns]
    return moved.withColumns({c: F.when(~clear, F.col(c)) for c in present}).drop("_open")


def clean_rents_moved(products: DataFrame, safe: bool = True) -> DataFrame:
    """Per affair, how many rents were moved."""
    return clean_rents(products, safe).groupBy("affair_id").agg(F.count_if("rent_moved").alias("n_moved"))


def derive_rents(products: DataFrame) -> DataFrame:
    """Rent per invoice and per year with a status: `ok`, `unknown` without a rent period, NULL when one-shot."""
    rent, rent_months = F.col("loyer"), months_of(F.col("loyer_periodicity"))
    billing_months = months_of(F.col("billing_frequency"))
    recurring = ~flag(F.col("one_shot_service")) & rent.isNotNull()

    def status(known: Column) -> Column:
        return F.when(recurring, F.when(known, F.lit("ok")).otherwise(F.lit("unknown")))

    return products.withColumns(
        {
            "loyer_facturation": F.when(recurring, rent * billing_months / rent_months),
            "loyer_facturation_status": status(rent_months.isNotNull() & billing_months.isNotNull()),
            "loyer_annuele": F.when(recurring, rent * 12 / rent_months),
            "loyer_annuele_status": status(rent_months.isNotNull()),
        }
    )


def volume_unit_price(products: DataFrame) -> DataFrame:
    """For volume rows, the monthly rent over the monthly quantity."""
    price = F.try_divide(
        F.col("loyer") * months_of(F.col("quantity_periodicity")),
        months_of(F.col("loyer_periodicity")) * F.col("quantity"),
    )
    return products.withColumn("volume_unit_price", F.when(flag(F.col("is_volume_product")), price))


def contract_end(products: DataFrame) -> DataFrame:
    """Adds `date_end_calc` and its status.

    One-shot and included rows have no end; tacit renewal ends in 2099; otherwise
    the signature plus the duration, plus the months left in the signature year
    when the notes mention a prorata. A duration that is no number of months up to
    `MAX_MONTHS` leaves the end unknown.
    """
    signed = signature_date()
    months = split_duration(F.col("duree_de_service"), F.lit(False))["duree_mois"]
    prorata = F.when(F.lower("duree_de_service_notes").contains("prorata"), 12 - F.month(signed)).otherwise(0)
    none = flag(F.col("one_shot_service")) | flag(F.col("is_included"))
    tacit = flag(F.col("reconduction_tacite"))
    whole = (months + prorata).try_cast("int")
    end = F.add_months(signed, F.when(whole.between(0, MAX_MONTHS), whole))
    return products.withColumns(
        {
            "date_end_calc": F.when(none, F.lit(None).cast("date")).when(tacit, F.to_date(F.lit(TACIT_END))).otherwise(end),
            "date_end_status": F.when(none, F.lit(None).cast("string"))
            .when(tacit, F.lit("ok"))
            .otherwise(F.when(end.isNull(), F.lit("unknown")).otherwise(F.lit("ok"))),
        }
    )


def _null_rules() -> list[tuple[str, Column, list[str]]]:
    included, one_shot = flag(F.col("is_included")), flag(F.col("one_shot_service"))
    reval = ["reval_method", "reval_rate_per", "reval_formula", "reval_compute_when", "reval_apply_when",
             "reval_apply_from", "reval_source"]
    return [
        ("included", included, ["price_unitaire"]),
        ("one_shot", one_shot, RECURRING_FIELDS),
        ("one_shot_or_included", one_shot | included,
         ["term_mode", *reval, "loyer_facturation", "loyer_annuele", "loyer_periodicity"]),
        ("not_volume", ~flag(F.col("is_volume_product")),
         ["usage_overconsumption_price", "usage_overconsumption_periodicity", "overconsumption_term_mode"]),
    ]


def apply_null_rules(products: DataFrame) -> DataFrame:
    """Clears the fields that included, one-shot and non-volume rows must not carry."""
    out: dict[str, Column] = {}
    for name in products.columns:
        hits = [cond for _, cond, columns in _null_rules() if name in columns]
        if hits:
            out[name] = F.when(~any_of(hits), F.col(name))
    out["is_volume_product"] = F.when(flag(F.col("one_shot_service")), F.lit(False)).otherwise(F.col("is_volume_product"))
    return products.withColumns(out)


def null_rule_violations(products: DataFrame) -> DataFrame:
    """The fields those rules would clear, as (keys, rule, column)."""
    checks = [
        (rule, F.lit(name), cond & F.col(name).isNotNull())
        for rule, cond, columns in _null_rules()
        for name in columns
        if name in products.columns
    ]
    volume = flag(F.col("one_shot_service")) & flag(F.col("is_volume_product"))
    checks.append(("one_shot", F.lit("is_volume_product"), volume))
    return _violations(products, checks, ["rule", "column"])
