"""Keeping one huge group from landing in one task.

A key is *heavy* when it weighs more than a floor. At most `HEAVY_MAX` keys are
treated as heavy, the heaviest first; every other key then weighs less than
1/HEAVY_MAX of the whole, so the ordinary group plan is safe for it. The heavy
list is therefore bounded by construction and may be broadcast.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactframe.session import cut

HEAVY_MAX = 10_000
HEAVY_ROWS = 1_000_000


def heavy_keys(df: DataFrame, keys: list[str], weight: Column | None = None, floor: float = HEAVY_ROWS) -> DataFrame | None:
    """The heavy keys with their `weight`, as a small local table; None when there are none."""
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    found = (
        df.groupBy(*keys).agg(total.alias("weight"))
        .filter(F.col("weight") > floor).orderBy(F.desc("weight")).limit(HEAVY_MAX)
    )
    rows = found.collect()  # bounded by HEAVY_MAX
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def fits(df: DataFrame, max_rows: int = HEAVY_MAX) -> bool:
    """Whether a table has at most `max_rows` rows; reads no more than needed to tell."""
    return df.limit(max_rows + 1).count() <= max_rows


def same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def by_weight(
    df: DataFrame,
    keys: list[str],
    light: Callable[[DataFrame], DataFrame],
    heavy: Callable[[DataFrame], DataFrame],
    floor: float = HEAVY_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """`light` on the ordinary groups, `heavy` on the heavy ones; the same rows come out either way.

    `sizes` is a cheaper table with some of the keys and at least as many rows of each, such as the written table that
    `df` is made from: with it, what is behind `df` runs a single time, unless a key is heavy and `sizes` lacks others.
    Only a table of more rows than the floor can hold a heavy key, so that a small one costs a look at row counts.
    """
    bound = df if sizes is None else sizes
    known = [k for k in keys if k in bound.columns]
    found = heavy_keys(bound.select(*known), known, floor=floor) if bound.select(*known).count() > floor else None
    if found is not None and known != keys:
        found = heavy_keys(df.select(*keys), keys, floor=floor)
    if found is None:
        return light(df)
    found = F.broadcast(found.drop("weight"))
    cond = same_key(df, found, keys)
    return light(df.join(found, cond, "left_anti")).unionByName(heavy(df.join(found, cond, "left_semi")))


def _comparable(df: DataFrame, name: str) -> list[tuple[str, Column]]:
    """Two never-NULL columns that order a nullable one, NULLs last."""
    kind = df.schema[name].dataType
    empty = {T.StringType: "", T.DateType: "1970-01-01", T.BooleanType: "false"}.get(type(kind), "0")
    return [
        (f"_missing_{name}", F.col(name).isNull().cast("int")),
        (f"_sort_{name}", F.coalesce(F.col(name), F.lit(empty).cast(kind))),
    ]


def running(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    number: str | None = None,
    before: dict[str, Column] | None = None,
    span: int = HEAVY_ROWS,
) -> DataFrame:
    """Adds the 1-based `number` of each row in its group and, per name in `before`, the sum over the rows before it.

    For groups that no task can hold. Rows are dealt into ranges of about `span` rows in the order of group and `order`;
    each range numbers and sums its own rows and is written once. A group in several ranges adds the totals of its
    earlier ranges: at most one row per range, whatever the groups. Rows that tie keep one arbitrary order.
    """
    amounts = before or {}
    keys = dict(pair for c in group for pair in _comparable(df, c))
    ranges = max(1, -(-df.count() // span))
    rows = df.withColumns({**keys, "_tie": F.monotonically_increasing_id(), **{f"_amount_{k}": v for k, v in amounts.items()}})
    dealt = rows.repartitionByRange(ranges, *keys, *order, "_tie").withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy("_range", *keys).orderBy(*order, "_tie")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = {"_at": F.row_number().over(inside)}
    local |= {f"_local_{k}": F.coalesce(F.sum(f"_amount_{k}").over(earlier), F.lit(0)) for k in amounts}
    held = cut(dealt.withColumns(local))
    totals = held.groupBy("_range", *keys).agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_amount_{k}").alias(f"_total_{k}") for k in amounts])
    above = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = {"_rows": F.sum("_rows").over(above), **{f"_total_{k}": F.sum(f"_total_{k}").over(above) for k in amounts}}
    offsets = totals.withColumns(sums).filter(F.col("_rows").isNotNull())  # fewer rows than ranges
    joined = held.join(F.broadcast(offsets), ["_range", *keys], "left")
    added = [(F.col("_at") + F.coalesce("_rows", F.lit(0))).cast("long").alias(number)] if number else []
    added += [(F.col(f"_local_{k}") + F.coalesce(f"_total_{k}", F.lit(0))).alias(k) for k in amounts]
    return joined.select(*df.columns, *added)


def number_rows(
    df: DataFrame, group: str, order: list[str], name: str = "seq", floor: float = HEAVY_ROWS,
    span: int = HEAVY_ROWS, sizes: DataFrame | None = None,
) -> DataFrame:
    """1-based position of each row in its group, by `order`, NULLs last.

    Ordinary groups use one window; heavy ones are numbered in ranges, so that no task holds one.
    """
    by = [F.asc_nulls_last(c) for c in order]

    def light(part: DataFrame) -> DataFrame:
        return part.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*by)).cast("long"))

    def heavy(part: DataFrame) -> DataFrame:
        return running(part, [group], by, number=name, span=span)

    return by_weight(df, [group], light, heavy, floor, sizes)


def lag_in_group(
    df: DataFrame, group: list[str], seq: str, value: str, name: str, floor: float = HEAVY_ROWS, span: int = 100_000,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Value of the previous row in the group by `seq`, NULL for the first.

    In heavy groups rows are cut into runs of `span` positions; a run's first row
    takes the last value of the nearest earlier run, found on one row per run.
    """

    def light(part: DataFrame) -> DataFrame:
        return part.withColumn(name, F.lag(value).over(Window.partitionBy(*group).orderBy(seq)))

    def heavy(part: DataFrame) -> DataFrame:
        of_group = dict(pair for c in group for pair in _comparable(part, c))
        cut = part.withColumns({**of_group, "_run": F.floor(F.col(seq) / span)})
        keys = [*of_group, "_run"]
        lasts = cut.groupBy(*keys).agg(F.max_by(F.struct(F.col(value).alias("v")), seq).alias("_last"))
        lasts = lasts.withColumn("_carry", F.lag("_last").over(Window.partitionBy(*of_group).orderBy("_run")))
        inside = Window.partitionBy(*keys).orderBy(seq)
        rows = cut.withColumns({"_at": F.row_number().over(inside), "_lag": F.lag(value).over(inside)})
        rows = rows.join(lasts.drop("_last"), keys)
        previous = F.when(F.col("_at") == 1, F.col("_carry.v")).otherwise(F.col("_lag"))
        return rows.withColumn(name, previous).select(*part.columns, name)

    return by_weight(df, group, light, heavy, floor, sizes)
