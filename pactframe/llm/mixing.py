"""Mixing sources to target weights by nested hash thresholds.

Every row gets a hash of its id and text. Words are summed per source and leading hash digits; the running sum over the
at most 4,096 cells of a source finds the cell in which its budget ends, and only rows of that cell are split by three
more digits, three times over. A row is then taken by comparing its hash with its source's threshold: nothing is sorted.

Only DataFrame functions are used. Defined results: a null or empty text has size 0 and takes 0 words; a null source is
a source of its own and the last; repeated rows share a hash, so they are taken or left together; a source without words
has target 0; an empty table gives an empty result. Columns beyond the three named ones are ignored by `size_table` and
kept by `take`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactframe.llm.common import n_words, stage

DIGITS, LEVELS = 3, 3
#: Above any hexadecimal text: the threshold of a source that is taken as a whole.
ALL = "g"
#: A table of sources of at most so many rows may be broadcast; a larger one is joined by a shuffle.
BROADCAST_SOURCES = 10_000


def row_hash(doc_id: Column, text: Column, seed: int) -> Column:
    """Hexadecimal md5 of seed, id and text; both have a defined form when null."""
    parts = [F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def source_key(source: Column) -> Column:
    """A key that is never null: null and the text 'null' stay apart."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source))


def size_table(docs: DataFrame, seed: int = 17) -> DataFrame:
    """doc_id, source, source key, size and hash of each row; written once, so that texts are read once."""
    return stage(
        docs.select(
            "doc_id",
            "source",
            source_key(F.col("source")).alias("skey"),
            n_words(F.col("text")).alias("size"),
            F.substring(row_hash(F.col("doc_id"), F.col("text"), seed), 1, DIGITS * LEVELS).alias("hash"),
        ),
        "mix-sizes",
    )


def targets(sizes: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0), max_repeats: int = 3) -> DataFrame:
    """Words to take per source: weights repeat in the order of the sources; no target is above `max_repeats` x its size.

    Sources by ascending cap per weight: those at the front are capped while their cap lies below the level that the
    remaining words and weights give; all others get the level of the first uncapped source times their weight. This is
    where resharing the excess again and again ends. The windows run over one row per source, not over documents.
    """
    each = sizes.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    ranked = each.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    order = Window.orderBy("per_weight", "rank")
    whole = Window.partitionBy()
    level = (
        ranked.withColumn("weight", weight)
        .withColumn("cap", (F.col("source_size") * max_repeats).cast("double"))
        .withColumn("per_weight", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(whole).cast("double"))
        .withColumn("capped_before", F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
        .withColumn("weight_left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("capped_before")) / F.col("weight_left"))
    )
    free = F.max(F.when(F.col("per_weight") > F.col("level"), F.col("level"))).over(whole)
    return level.withColumn("target", F.least("cap", F.coalesce(free * F.col("weight"), F.col("cap")))).select(
        "skey", "source_size", "target"
    )


def thresholds(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source: whole repeats, and the hash below which a row is taken once more."""
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = goals.withColumn("repeats", repeats).withColumn("budget", F.col("target") - F.col("repeats") * F.col("source_size"))
    state = stage(state.withColumn("prefix", F.lit("")), "mix-goals")
    for depth in range(1, LEVELS + 1):
        inside = sizes.join(hinted(state.select("skey", "prefix")), "skey").filter(F.col("hash").startswith(F.col("prefix")))
        cells = inside.groupBy("skey", F.substring("hash", 1, depth * DIGITS).alias("cell")).agg(F.sum("size").alias("words"))
        run = Window.partitionBy("skey").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        after = cells.withColumn("upto", F.sum("words").over(run)).join(hinted(state.select("skey", "budget")), "skey")
        edge = after.filter(F.col("upto") > F.col("budget")).groupBy("skey").agg(
            F.min(F.struct("cell", "words", "upto")).alias("edge")
        )
        state = stage(
            state.join(edge, "skey", "left")
            .withColumn("budget", F.col("budget") - F.coalesce(F.col("edge.upto") - F.col("edge.words"), F.lit(0)))
            .withColumn("prefix", F.coalesce("edge.cell", F.lit(ALL)))
            .withColumn("last_words", F.coalesce("edge.words", F.lit(0)))
            .select("skey", "source_size", "target", "repeats", "budget", "prefix", "last_words"),
            "mix-edges",
        )
    # the last cell goes in as a whole if that comes nearer to the budget than leaving it out
    nearer = (F.col("last_words") > 0) & (F.col("last_words") - F.col("budget") < F.col("budget"))
    return state.select("skey", "source_size", "target", "repeats", F.col("prefix").alias("below"), nearer.alias("with_edge"))


def hinted(per_source: DataFrame) -> DataFrame:
    """A table with one row per source, broadcast only after counting that it is small."""
    few = per_source.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    return F.broadcast(per_source) if few else per_source


def times(hash_: Column) -> Column:
    """How often a row is taken, from its hash and its source's threshold."""
    once_more = (hash_ < F.col("below")) | ((hash_ == F.col("below")) & F.col("with_edge"))
    return F.col("repeats") + once_more.cast("long")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0), max_repeats: int = 3, seed: int = 17) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words taken, repeats counted)."""
    sizes = size_table(docs, seed)
    plan = thresholds(sizes, targets(sizes, weights, max_repeats))
    return sizes.join(hinted(plan), "skey").select(
        "doc_id", "size", "source_size", "target", (times(F.col("hash")) * F.col("size")).alias("taken")
    )


def take(docs: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0), max_repeats: int = 3, seed: int = 17) -> DataFrame:
    """The mix itself: documents with all their columns, each as often as it is taken.

    Rows without words add nothing to a mix and are left out.
    """
    sizes = size_table(docs, seed)
    plan = hinted(thresholds(sizes, targets(sizes, weights, max_repeats)).withColumnRenamed("skey", "mix_skey"))
    hashed = F.substring(row_hash(F.col("doc.doc_id"), F.col("doc.text"), seed), 1, DIGITS * LEVELS)
    joined = docs.select(F.struct("*").alias("doc")).join(plan, source_key(F.col("doc.source")) == F.col("mix_skey"))
    counted = joined.select("doc", F.when(n_words(F.col("doc.text")) > 0, times(hashed)).otherwise(F.lit(0)).alias("n"))
    return counted.select("doc", F.explode(F.expr("if(n > 0, array_repeat(0, int(n)), array())")).alias("copy")).select("doc.*")


# DuckDB: the same hash and cells, by plain running sums
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS skey,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         substr(md5('17|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 9) AS hash
  FROM documents),
s AS (SELECT skey, min(source) AS source, sum(size)::BIGINT AS source_size FROM d GROUP BY skey),
r AS (SELECT *, 1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight,
             row_number() OVER (ORDER BY source NULLS LAST) AS rank, source_size * 3.0::DOUBLE AS cap FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE - (sum(cap) OVER (ORDER BY cap / weight, rank ROWS UNBOUNDED PRECEDING) - cap))
             / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
t AS (SELECT skey, source_size, least(cap, coalesce(max(CASE WHEN cap / weight > level THEN level END) OVER () * weight, cap)) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS repeats FROM t),
b AS (SELECT *, target - repeats * source_size AS budget FROM p),
c AS (SELECT skey, hash, sum(size) AS words FROM d GROUP BY skey, hash),
u AS (SELECT c.*, sum(words) OVER (PARTITION BY skey ORDER BY hash ROWS UNBOUNDED PRECEDING) AS upto FROM c),
e AS (SELECT u.skey, u.hash, upto <= budget OR (upto - words <= budget AND words > 0 AND upto - budget < budget - (upto - words)) AS more
      FROM u JOIN b ON u.skey = b.skey)
SELECT d.doc_id, d.size, b.source_size, b.target, ((b.repeats + e.more::INT) * d.size)::BIGINT AS taken
FROM d JOIN b ON d.skey = b.skey JOIN e ON e.skey = d.skey AND e.hash = d.hash
"""
