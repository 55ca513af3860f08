"""Contract files: listing, reading, the pluggable analysis step, document rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactframe.functions.text import basename, has_word, parse_path, slug
from pactframe.schemas import ANALYZED, EXTRAPOLATED_DOCUMENTS, PAGE_PRICE_PER_1000

PDF_GLOB = "*.[pP][dD][fF]"


def scan_pdfs(spark: SparkSession, root: str) -> DataFrame:
    """Every PDF below `root`. Bytes are read only by plans that select `content`."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", PDF_GLOB)
        .option("recursiveFileLookup", "true")
        .load(root)
    )


def relative_paths(files: DataFrame, root: str) -> DataFrame:
    """Paths below the store root, as `letter/company/...`."""
    tail = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "", root).strip("/") + "/"
    return files.withColumn("path", F.regexp_replace("path", "^.*?" + re.escape(tail), ""))


def select_affair(df: DataFrame, affair: str | None, col: str = "path") -> DataFrame:
    """Rows whose path mentions the affair, case ignored; no affair keeps all."""
    return df.filter(has_word(F.lower(col), affair)) if affair else df


def select_affairs(df: DataFrame, affairs: list[str] | None, col: str = "path") -> DataFrame:
    """Rows whose path mentions any of the affairs."""
    if not affairs:
        return df
    path = F.lower(col)
    return df.filter(F.exists(F.array(*[F.lit(a.lower()) for a in affairs]), lambda a: F.contains(path, a)))


def apply_analyzer(
    files: DataFrame, analyze: Callable[[str, bytes], dict]
) -> DataFrame:
    """Run `analyze(path, bytes)` on each file; a failing file becomes a row with `error`.

    Files are analyzed where they are read, so that their bytes never cross the network; how many
    go to a task is the scan's `spark.sql.files.maxPartitionBytes` and `openCostInBytes`.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    got = analyze(path, bytes(content))
                    rows.append((path, got.get("content"), list(got.get("languages") or []), int(got["page_count"]), None))
                except Exception as err:  # isolate the file, keep the batch
                    rows.append((path, None, None, None, f"{type(err).__name__}: {err}"))
            frame = pd.DataFrame(rows, columns=ANALYZED.fieldNames())
            yield frame.astype({"page_count": "Int32"})

    return files.select("path", "content").mapInPandas(run, ANALYZED)


def build_documents(analyzed: DataFrame, model: str = "prebuilt-layout") -> DataFrame:
    """One document row per analyzed file."""
    at = parse_path(F.col("path"))
    doc_id = slug(F.col("path"))
    return analyzed.withColumn("at", at).select(
        doc_id.alias("id"),
        basename(F.col("path")).alias("title"),
        F.coalesce("content", F.lit("")).alias("content"),
        F.length(F.coalesce("content", F.lit(""))).cast("long").alias("n_chars"),
        F.col("path").alias("file_path"),
        F.coalesce(F.try_element_at("languages", F.lit(1)), F.lit("unknown")).alias("language"),
        F.col("page_count").cast("int").alias("page_count"),
        F.lit(model).alias("analyse_doc_model"),
        F.col("at.letter").alias("company_letter"),
        F.col("at.company").alias("company_name"),
        F.col("at.affair").alias("company_affair"),
        F.col("at.company_key").alias("company_name_path"),
        F.col("at.affair_key").alias("company_affair_path"),
        F.lower(doc_id).alias("id_lc"),
        F.col("at.path_ok").alias("path_ok"),
    )


def page_cost(
    docs: DataFrame,
    by: list[str] | None = None,
    price_per_1000: float = PAGE_PRICE_PER_1000,
    n_docs: int = EXTRAPOLATED_DOCUMENTS,
) -> DataFrame:
    """Mean pages and the analysis price of one and of `n_docs` documents; no row for no documents."""
    price = F.lit(price_per_1000 / 1000)
    stats = docs.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n_docs"), F.avg("page_count").alias("mean_pages"))
    return stats.filter("n_docs > 0").withColumns(
        {
            "price_single": price * F.col("mean_pages"),
            "price_total": price * F.lit(n_docs) * F.col("mean_pages"),
        }
    )


def id_collisions(docs: DataFrame) -> DataFrame:
    """Ids shared by several paths, which an upsert would merge."""
    return docs.groupBy("id").agg(F.count_distinct("file_path").alias("n_paths")).filter("n_paths > 1")


def id_ok(doc_id: Column) -> Column:
    """Whether an affair query can find the id: the suffix test is case-sensitive."""
    return F.endswith(doc_id, F.lit(".pdf"))
