"""New contract files as they arrive: the batch steps under a file stream."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactframe.schemas import FILES
from pactframe.session import cut
from pactframe.sources.files import PDF_GLOB, apply_analyzer, build_documents, relative_paths, select_affairs
from pactframe.sources.store import append_batch, latest_per_key

#: Tries a file gets in all, and failed files read again in one epoch.
TRIES, MOST_RETRIED = 3, 200
QUEUE = "path string, error string, attempts int, batch long"


def stream_pdfs(spark: SparkSession, root: str, max_files: int = 10_000) -> DataFrame:
    return (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .option("pathGlobFilter", PDF_GLOB)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(root)
    )


def due_again(spark: SparkSession, quarantine: str, epoch: int, tries: int, most: int) -> DataFrame | None:
    """(path, attempts) of at most `most` files that failed in epochs before this one and have tries left, fewest tries first."""
    try:
        stored = spark.read.schema(QUEUE).parquet(quarantine)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    latest = latest_per_key(stored.filter(F.col("batch") < epoch), ["path"], ["batch"])
    due = latest.filter((F.col("error").isNotNull()) & (F.col("attempts") < tries)).select("path", "attempts")
    return due.orderBy("attempts", "path").limit(most)


def read_again(spark: SparkSession, root: str, paths: list[str]) -> DataFrame | None:
    """The files of a short list that are still there."""
    frames = []
    for path in paths:
        try:
            frames.append(spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{path}"))
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
    return relative_paths(reduce(DataFrame.unionByName, frames), root) if frames else None


def ingest_epoch(
    batch: DataFrame, epoch: int, root: str, store: str, quarantine: str, analyze: Callable[[str, bytes], dict], tries: int = TRIES, most: int = MOST_RETRIED
) -> None:
    """One epoch: its files and those due for another try, analyzed once, to the store and the queue of failed files.

    The queue holds a row per file and epoch (path, error, attempts): a file is due while its latest row has an error and
    tries are left; a file that comes through gets a row without error. A short path can never come through, and is parked
    at once. An epoch that is run again sees the queue as it was before it, and replaces its own batches. With an empty
    `batch` only files due again are tried.
    """
    spark = batch.sparkSession
    due = due_again(spark, quarantine, epoch, tries, most)
    waiting = {r.path: r.attempts for r in due.collect()} if due is not None else {}  # at most `most`
    again = read_again(spark, root, list(waiting)) if waiting else None
    analyzed = apply_analyzer(batch, analyze)
    analyzed = cut(analyzed if again is None else analyzed.unionByName(apply_analyzer(again, analyze)))  # paid for: written
    docs = build_documents(analyzed.filter("error IS NULL"))
    append_batch(latest_per_key(docs.filter("path_ok"), ["id"], ["file_path"]), store, epoch)
    before = spark.createDataFrame(list(waiting.items()), "path string, _tried int")
    seen = analyzed.select("path", "error").join(F.broadcast(before), "path", "left")
    told = seen.filter(F.col("error").isNotNull() | F.col("_tried").isNotNull())
    failed = told.select("path", "error", (F.coalesce("_tried", F.lit(0)) + 1).cast("int").alias("attempts"))
    short = docs.filter(~F.col("path_ok")).select(
        F.col("file_path").alias("path"), F.lit("short path").alias("error"), F.lit(tries).cast("int").alias("attempts")
    )
    append_batch(failed.unionByName(short), quarantine, epoch)


def stream_documents(
    spark: SparkSession,
    root: str,
    store: str,
    checkpoint: str,
    analyze: Callable[[str, bytes], dict],
    affairs: list[str] | None = None,
    trigger: dict | None = None,
    quarantine: str | None = None,
    tries: int = TRIES,
) -> StreamingQuery:
    """Analyze arriving files and append them to the document store, one batch per epoch.

    Files whose analysis fails and short paths go to the `quarantine` store, by default beside the document store, and are
    tried again in later epochs, `tries` times in all (see `ingest_epoch`).
    """
    refused = quarantine or f"{store.rstrip('/')}-quarantine"
    files = select_affairs(relative_paths(stream_pdfs(spark, root), root), affairs)

    def write(batch: DataFrame, epoch: int) -> None:
        ingest_epoch(batch, epoch, root, store, refused, analyze, tries)

    return (
        files.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
