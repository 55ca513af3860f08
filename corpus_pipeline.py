"""Training-data pipeline over documents: each stage works on all that the stage before it kept.

Quality classifier, near-duplicates, repeated passages, mixing, packing. Repeats that the mix asks for are repeated rows;
a text that loses a passage has a new n_chars.

Defined results: a null or empty text is judged as one empty line, is like no other, loses nothing, and is left out by
the mix, as it has no words; a null id is kept as it is, and so is a null source, which is a source of its own; repeated
rows stay together in the stage of near duplicates, which keeps or drops an id, and in the mix; ties go to the smaller
id; a very long text is one row up to the packing, which cuts it; an empty table gives no rows; columns beyond the five
of documents end with the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactframe.llm import line_crf, mixing, near_dedup, packing, substring_dedup
from pactframe.llm.common import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores 0.5 or more."""
    field = line_crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return line_crf.keep_good(docs.select(*COLUMNS), field)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.keep_first(docs.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without words under 20-word windows that stand earlier in the corpus."""
    return substring_dedup.dedup_texts(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.take(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what was taken, packed into sequences."""
    return packing.pack(spark, docs, TOKENIZER)


STAGES = [
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("mix", mix),
    ("pack", pack),
]
#: SQL cannot express the stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
