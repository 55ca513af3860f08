"""One product table per affair out of the CG/CP and the amendment answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactframe.functions.values import missing_to_null, parse_date
from pactframe.operators.skew import HEAVY_ROWS, number_rows


def signature_date() -> Column:
    """Amendment date, else CP date."""
    return parse_date(F.coalesce(missing_to_null(F.col("signature_date_av")), missing_to_null(F.col("signature_date_cp"))))


def union_products(cpcg: DataFrame, av: DataFrame | None) -> DataFrame:
    """All rows of both, by column name. Repeated products stay."""
    left = cpcg.withColumn("is_av", F.lit(False))
    if av is None:
        return left
    return left.unionByName(av.withColumn("is_av", F.lit(True)), allowMissingColumns=True)


def consolidate(cpcg: DataFrame, av: DataFrame | None, floor: float = HEAVY_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """Union in signature order; `seq` is the position in the affair, unreadable dates last."""
    return consolidate_flagged(union_products(cpcg, av), floor, sizes)


def consolidate_flagged(products: DataFrame, floor: float = HEAVY_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """The same for one table that has both kinds of rows and `is_av`: it is read once. For `sizes` see `by_weight`."""
    rows = products.withColumn("signature_date", signature_date())
    return number_rows(rows, "affair_id", ["signature_date", "is_av", "avenant_number", "request_id", "pos"], floor=floor, sizes=sizes)


def sequence_products(products: DataFrame, floor: float = HEAVY_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """`seq` with the CP products first whatever their dates, then the amendments by date."""
    rows = products.withColumn("signature_date", signature_date())
    return number_rows(rows, "affair_id", ["is_av", "signature_date", "avenant_number", "request_id", "pos"], floor=floor, sizes=sizes)


def sort_avenants(av: DataFrame) -> DataFrame:
    """Amendment rows by number, missing last, for a reader of the rows: the order of an export."""
    return av.orderBy("affair_id", F.asc_nulls_last("avenant_number"), "request_id", "pos")


def avenant_coverage(av: DataFrame) -> DataFrame:
    """Per affair: amendment tables received and distinct amendment numbers in them."""
    return av.groupBy("affair_id").agg(
        F.count_distinct("request_id").alias("n_received"),
        F.count_distinct("avenant_number").alias("n_numbers"),
    )
