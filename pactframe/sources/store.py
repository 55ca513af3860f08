"""Document and result tables at rest: read, merge by key, append batches.

A store is a Parquet folder with one `batch=<n>` directory per write. A batch is
replaced as a whole when it is replayed, so a lost driver or a repeated stream
epoch does no harm, and the current state is the newest row per key.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactframe.operators.skew import same_key
from pactframe.session import cut

#: Buckets of a store that is cut by key.
BUCKETS = 256


def documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def document_count(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).alias("n_documents"))


def fetch_by_ids(docs: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """The rows of the wanted ids, in one scan."""
    return docs.join(ids.select(key), key, "left_semi")


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The last row per key. The rank filter runs before the shuffle too, so a hot key is cut map-side."""
    last = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order_by])
    return df.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").drop("_rank")


def upsert_by_key(existing: DataFrame | None, incoming: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Incoming rows insert or replace whole rows; the last incoming row per key wins."""
    newest = latest_per_key(incoming, keys, order_by)
    if existing is None:
        return newest
    kept = existing.join(newest.select(*keys), keys, "left_anti")
    return kept.unionByName(newest, allowMissingColumns=True)


def append_batch(df: DataFrame, root: str, batch: int) -> None:
    """Write one batch into a folder of its own; writing it again replaces it, also by nothing."""
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/batch={int(batch)}")


def current(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """The store's state: newest batch per key."""
    return latest_per_key(spark.read.parquet(root), keys, ["batch"]).drop("batch")


def compact(spark: SparkSession, root: str, target: str, keys: list[str]) -> None:
    """Copy the current state to a fresh folder as one batch; the folder read is left alone."""
    newest = spark.read.parquet(root).agg(F.max("batch")).first()[0]
    append_batch(current(spark, root, keys), target, newest)


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, root: str) -> list[Row]:
    """(bucket, version, buckets) of the newest version of a bucketed store; none where there is no store yet."""
    try:
        rows = spark.read.schema("bucket int, held long, buckets int, version long").parquet(f"{root.rstrip('/')}/manifest")
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    newest = rows.agg(F.max("version")).first()[0]
    return rows.filter(F.col("version") == newest).collect()  # a row per bucket


def _read_buckets(spark: SparkSession, root: str, held: dict[int, int], schema: T.StructType) -> DataFrame | None:
    base = f"{root.rstrip('/')}/data"
    paths = [f"{base}/version={version}/bucket={bucket}" for bucket, version in sorted(held.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def upsert_buckets(incoming: DataFrame, root: str, keys: list[str], order_by: list[str], buckets: int = BUCKETS) -> list[int]:
    """Upsert into a store cut into buckets by a hash of the key; only buckets that the incoming rows touch are read and
    written. Returns these.

    A version holds new files for its touched buckets alone; its manifest, one small file, says which version each bucket
    is read from, and makes the version visible when it is there. A run that fails before leaves the store as it was, and
    readers of an older version keep their files. The number of buckets is that of the store, once there is one.
    """
    spark, root = incoming.sparkSession, root.rstrip("/")
    before = _manifest(spark, root)
    held = {r.bucket: r.held for r in before}
    buckets = before[0].buckets if before else buckets
    version = max((r.version for r in before), default=0) + 1
    rows = cut(latest_per_key(incoming, keys, order_by))
    touched = sorted(r[0] for r in rows.select(_bucket(keys, buckets)).distinct().collect())  # at most `buckets`
    if not touched:
        return []
    old = _read_buckets(spark, root, {b: v for b, v in held.items() if b in touched}, incoming.schema)
    merged = rows if old is None else old.join(rows.select(*keys), same_key(old, rows, keys), "left_anti").unionByName(rows)
    placed = merged.withColumn("bucket", _bucket(keys, buckets)).hint("rebalance", "bucket")
    placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/data/version={version}")
    now = held | dict.fromkeys(touched, version)
    listed = spark.createDataFrame([(b, v, buckets) for b, v in sorted(now.items())], "bucket int, held long, buckets int")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/version={version}")
    return touched


def bucketed(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All rows of a bucketed store in its newest version."""
    rows = _read_buckets(spark, root, {r.bucket: r.held for r in _manifest(spark, root)}, schema)
    return spark.createDataFrame([], schema) if rows is None else rows


def bucket_of_key(spark: SparkSession, root: str, schema: T.StructType, key: dict[str, object]) -> DataFrame:
    """The row of one key of a bucketed store: one bucket is read."""
    listed = _manifest(spark, root)
    kinds = [F.lit(v).cast(schema[k].dataType) for k, v in key.items()]
    number = spark.range(1).select(F.pmod(F.xxhash64(*kinds), F.lit(listed[0].buckets if listed else 1))).first()[0]
    rows = _read_buckets(spark, root, {r.bucket: r.held for r in listed if r.bucket == number}, schema)
    if rows is None:
        return spark.createDataFrame([], schema)
    for name, value in key.items():
        rows = rows.filter(F.col(name) == value)
    return rows
