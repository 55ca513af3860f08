"""Result rows per affair: packing, unpacking, upserting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactframe.schemas import PRODUCT_COLUMNS

#: Rows of one record unless the caller says otherwise.
MAX_PACKED = 10_000


def _packed(field: T.StructField) -> Column:
    col = F.col(field.name)
    return F.round(col, 10).alias(field.name) if isinstance(field.dataType, T.DoubleType) else col


def pack_results(products: DataFrame, columns: list[str] | None = None, max_rows: int = MAX_PACKED) -> DataFrame:
    """`{id, rows}` per affair in `seq` order, `seq` counting from 1 without gaps.

    An affair of more than `max_rows` rows takes several records, numbered by `part`,
    so that no record or task grows with the affair. Each record names the `seq` of
    its first row, so it is read back without knowing the limit it was written with.
    """
    columns = columns or [c for c in PRODUCT_COLUMNS if c in products.columns]
    body = F.struct(*[_packed(products.schema[c]) for c in columns])
    part = F.floor((F.col("seq") - 1) / max_rows).cast("int")
    rows = products.select(F.col("affair_id").cast("string").alias("id"), part.alias("part"), F.struct("seq", body.alias("row")).alias("entry"))
    packed = rows.groupBy("id", "part").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    return packed.select("id", "part", F.col("entries.seq")[0].alias("first_seq"), F.col("entries.row").alias("rows"))


def unpack_results(results: DataFrame) -> DataFrame:
    """Back to product rows with their `seq`."""
    rows = results.select(F.col("id").alias("affair_id"), "first_seq", F.posexplode("rows").alias("_at", "_row"))
    return rows.select("affair_id", (F.col("first_seq") + F.col("_at")).alias("seq"), "_row.*")


def upsert_results(existing: DataFrame | None, packed: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    """New records replace all records of their affairs.

    `touched` (id) names these affairs where they are known from a cheaper table than
    the packed records, which are then made once.
    """
    if existing is None:
        return packed
    ids = (packed if touched is None else touched).select("id").distinct()
    return existing.join(ids, "id", "left_anti").unionByName(packed)
