"""Where results go: per-document texts, product exports, observed counts."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from pactframe.functions.values import render_missing

FORMATS = ("parquet", "csv", "json", "markdown")
#: Folders of an export.
FOLDERS = 256


def write_documents_text(docs: DataFrame, out_dir: str) -> None:
    """`<id>.md` per document, written by the executors to a folder they all reach.

    A file is written whole under a task-private name, then moved, so repeated
    tasks only replace a file by itself.
    """

    def write(rows: Iterator[Row]) -> None:
        import os
        import uuid

        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(out_dir) if "://" in out_dir else (fs.LocalFileSystem(), os.path.abspath(out_dir))
        store.create_dir(base, recursive=True)
        for row in rows:
            temporary = f"{base}/.{uuid.uuid4().hex}"
            with store.open_output_stream(temporary) as out:
                out.write((row["content"] or "").encode("utf-8"))
            store.move(temporary, f"{base}/{row['id']}.md")

    docs.select("id", "content").foreachPartition(write)


def markdown_line(cells: list[str]) -> Column:
    """Already rendered cells as one Markdown table line."""
    safe = [F.regexp_replace(F.replace(F.col(c), F.lit("|"), F.lit("\\|")), r"\s*\n\s*", " ") for c in cells]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *safe), F.lit(" |"))


def folder_of(affair: Column, folders: int) -> Column:
    """Number of the folder an affair's rows are exported to."""
    return F.pmod(F.xxhash64(affair), F.lit(folders)).cast("int")


def export_products(
    products: DataFrame, path: str, tag: str, format: str = "parquet", max_records: int = 1_000_000, folders: int = FOLDERS
) -> str:
    """Write `<path>/<tag>` in at most `folders` folders, whatever the number of affairs. Returns the folder above them.

    An affair's rows are in one folder, which `folder_of` names, and carry `affair_id`; a large affair takes several files.
    Files appear when the whole job has succeeded.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    target = f"{path.rstrip('/')}/{tag}"
    placed = products.withColumn("folder", folder_of(F.col("affair_id"), folders)).hint("rebalance", "folder")
    if format == "markdown":
        cells = ["affair_id", *[c for c in products.columns if c != "affair_id"]]
        out = render_missing(placed, keep=["folder"]).select("folder", markdown_line(cells).alias("value"))
        writer = out.write.mode("overwrite").format("text")
    else:
        rendered = placed if format == "parquet" else render_missing(placed, keep=["folder"])
        writer = rendered.write.mode("overwrite").format(format)
        if format == "csv":
            writer = writer.option("header", "true")
    writer.option("maxRecordsPerFile", max_records).partitionBy("folder").save(target)
    return target


def exported(spark: SparkSession, target: str, affair: str, folders: int = FOLDERS) -> DataFrame:
    """The rows of one affair from a Parquet export: one folder is read."""
    number = spark.range(1).select(folder_of(F.lit(affair), folders)).first()[0]
    rows = spark.read.parquet(target)
    return rows.filter((F.col("folder") == number) & (F.col("affair_id") == affair)).drop("folder")


def observe(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count and total text length, gathered while the table is used, without a job of their own."""
    seen = Observation(name)
    metrics = [F.count(F.lit(1)).alias("n_rows")]
    if "content" in df.columns:
        metrics.append(F.sum(F.length("content")).alias("n_chars"))
    return df.observe(seen, *metrics), seen
