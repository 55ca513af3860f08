"""Quality rules: hashed n-gram log-likelihood ratio between trusted and raw text, after plain counting rules.

Words and word pairs are hashed into `BUCKETS` buckets. Two multinomials, one of trusted documents and one of all
documents, are smoothed and compared: a document's ratio is the mean over its n-grams of log(p_trusted / p_raw). A
document is kept if that mean reaches a threshold fitted once: the score below which the share `MISSED` of the trusted
documents lies. The table of `BUCKETS` weights has a fixed size and reaches the tasks as the value of a scalar subquery.

Only DataFrame functions are used. Defined results: a null or empty text has no words, fails the base rules and is not
kept; without any trusted document every ratio is 0 and the base rules decide; repeated rows are judged alike, each
once; columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactframe.llm.common import WORD_BREAK, stage
from pactframe.operators.skew import HEAVY_ROWS, fits, running

BUCKETS = 10_000
SMOOTHING = 1.0
MISSED = 0.005
#: So many trusted ids, 8 bytes each, are sent to the tasks; of more, texts are shuffled to them. The rows are the same.
SENT_IDS = 1_000_000
# The counted symbols, the white space of the word rule, and the two limits of the base rules.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50


def words(text: Column) -> Column:
    """Words in order; splitting leaves an empty piece at most at either end."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def base_columns(docs: DataFrame, *kept: str) -> DataFrame:
    """The columns `kept`, w (words), and the counting rules: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    A word is repeated if a 3-word window over it occurs twice or more in the text. Windows are numbered by a 64-bit
    hash and sorted once with their places; one repeats if a neighbour in that order has the same hash. This takes
    n log n steps in the length of a text, whatever repeats how often.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split("text0", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    counted = docs.select(*kept, text.alias("text0")).select(
        *kept,
        words(F.col("text0")).alias("w"),
        lines.alias("lines"),
        F.length(F.translate("text0", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text0") - F.length(F.translate("text0", SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    named = [*kept, "w", "word_chars", "n_symbols", F.size("w").cast("long").alias("n_words")]
    windows = F.expr("""
        if(size(w) < 4, array(), sort_array(transform(
            slice(w, 1, size(w) - 2), (x, i) -> named_struct('h', xxhash64(x, w[i + 1], w[i + 2]), 'i', i))))
    """)
    sorted_windows = counted.select(
        *named, (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), windows.alias("s")
    )
    places = F.expr("""
        filter(transform(s, (x, k) -> if(get(s, k - 1).h = x.h or get(s, k + 1).h = x.h, x.i, null)), i -> i is not null)
    """)
    base = [*kept, "w", "word_chars", "n_symbols", "n_words", "n_dup_lines"]
    covered = F.expr("size(array_distinct(flatten(transform(places, i -> array(i, i + 1, i + 2)))))").cast("long")
    return sorted_windows.select(*base, places.alias("places")).select(*base, covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of every labelled good, not toxic document."""
    return labels.filter("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()


def quantile(values: DataFrame, name: str, share: float, span: int = HEAVY_ROWS) -> DataFrame:
    """One row, `limit`: the smallest value that at least the given share reaches at most; NULL without rows.

    The values are numbered in ranges, so that no task holds them all.
    """
    rank = max(1, math.ceil(share * values.count()))
    numbered = running(values.select(name), [], [F.col(name)], number="at", span=span)
    return numbered.filter(F.col("at") == rank).agg(F.max(name).alias("limit"))


def weights(marked: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row with one array: log(p_trusted / p_raw) of each bucket, from the n-grams of every document."""
    grams = F.expr(f"""
        concat(transform(w, x -> pmod(xxhash64(x), {buckets})),
               transform(slice(w, 2, size(w)), (x, i) -> pmod(xxhash64(w[i], x), {buckets})))
    """)
    counts = (
        marked.select("trusted", words(F.col("text")).alias("w"))
        .select("trusted", F.explode(grams).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.count_if("trusted").alias("good"))
    )
    every = counts.sparkSession.range(0, buckets, 1, 1).withColumnRenamed("id", "bucket").join(counts, "bucket", "left")
    raw, good = F.coalesce("raw", F.lit(0)), F.coalesce("good", F.lit(0))
    ordered = F.sort_array(F.collect_list(F.struct("bucket", raw.alias("raw"), good.alias("good")))).alias("cells")
    total = every.agg(ordered, F.sum(raw).alias("n_raw"), F.sum(good).alias("n_good"))
    ratio = F.expr(f"""
        transform(cells, c -> if(n_good = 0, 0D,
            ln((c.good + {SMOOTHING}D) / (n_good + {SMOOTHING * buckets}D)) - ln((c.raw + {SMOOTHING}D) / (n_raw + {SMOOTHING * buckets}D))))
    """)
    return total.select(ratio.alias("weights"))


def mean_ratio(buckets: int = BUCKETS) -> Column:
    """Mean weight of the n-grams of `w` (0 without words), looked up in the array `weights`."""
    return F.expr(f"""
        if(size(w) = 0, 0D, aggregate(
            transform(w, (x, i) -> weights[pmod(xxhash64(x), {buckets})]
                + if(i = 0, 0D, weights[pmod(xxhash64(w[i - 1], x), {buckets})])), 0D, (a, x) -> a + x) / (2 * size(w) - 1))
    """)


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, missed: float = MISSED, sent: int = SENT_IDS) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, ratio."""
    trusted = trusted_ids(labels).withColumn("trusted", F.lit(True))
    trusted = F.broadcast(trusted) if fits(trusted, sent) else trusted
    marked = docs.select("doc_id", "text").join(trusted, "doc_id", "left")
    table = stage(weights(marked, buckets), "ratio-weights")
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    based = base_columns(docs.select("doc_id", "text"), "doc_id")
    scored = stage(
        based.withColumn("weights", table.scalar()).select("doc_id", *columns, mean_ratio(buckets).alias("ratio")), "ratio-scores"
    )
    inside = scored.filter(~base_failed()).join(trusted, "doc_id", "left_semi")
    limit = stage(quantile(inside, "ratio", missed), "ratio-limit")
    verdict = ~base_failed() & (F.col("ratio") >= F.coalesce(limit.scalar(), F.lit(0.0)))
    return scored.select("doc_id", *columns, base_failed().alias("base_failed"), verdict.alias("kept"), "ratio")
