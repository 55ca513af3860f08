"""Choosing an affair's documents, classifying them, gathering their text."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactframe.functions.text import has_any, has_word
from pactframe.operators.skew import fits, running
from pactframe.schemas import (
    AV_KEYWORDS,
    AVENANT_HEADER,
    CG_KEYWORDS,
    CG_VETO,
    CP_KEYWORDS,
    EXCLUDED_KINDS,
)

#: Up to so many affairs are tested one by one in an expression, and up to so many by one automaton in each task.
LITERAL_AFFAIRS, AUTOMATON_AFFAIRS = 1_000, 100_000
SLUG_LIMIT = 200
MAX_CHARS = 64_000_000


def with_id_lc(docs: DataFrame) -> DataFrame:
    return docs if "id_lc" in docs.columns else docs.withColumn("id_lc", F.lower("id"))


def chars(docs: DataFrame) -> Column:
    """Length of a text: the stored one where there is one, so that the text itself is not read."""
    return F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.length("content").cast("long")


def docs_for_affair(docs: DataFrame, keyword: str) -> DataFrame:
    """Documents whose id mentions the keyword, case ignored, and ends with `.pdf`, case kept.

    Both tests are plain string predicates on stored columns, so Parquet gets them.
    """
    docs = with_id_lc(docs)
    return docs.filter(has_word(F.col("id_lc"), keyword) & F.endswith("id", F.lit(".pdf")))


def is_excluded(kinds: list[str] | None = None) -> Column:
    return has_any(F.col("id_lc"), EXCLUDED_KINDS if kinds is None else kinds)


def exclude_kinds(docs: DataFrame, kinds: list[str] | None = None, enabled: bool = True) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded ids); with `enabled=False` everything is kept."""
    docs = with_id_lc(docs)
    hit = is_excluded(kinds) if enabled else F.lit(False)
    return docs.filter(~hit), docs.filter(hit).select("id")


def classify(docs: DataFrame) -> DataFrame:
    """Adds `is_cg`, `is_cp`, `is_av`; one document may be several, or none."""
    docs = with_id_lc(docs)
    low = F.col("id_lc")
    return docs.withColumns(
        {
            "is_cg": has_any(low, CG_KEYWORDS) & ~has_word(low, CG_VETO),
            "is_cp": has_any(low, CP_KEYWORDS),
            "is_av": has_any(low, AV_KEYWORDS),
        }
    )


def classify_documents(docs: DataFrame) -> DataFrame:
    """One row per document and class it belongs to."""
    flagged = docs if "is_cg" in docs.columns else classify(docs)
    classes = F.array(*[F.when(F.col(f"is_{c.lower()}"), F.lit(c)) for c in ("CG", "CP", "AV")])
    return flagged.withColumn("doc_class", F.explode(F.array_compact(classes)))


def match_affairs(docs: DataFrame, affairs: DataFrame) -> DataFrame:
    """Each document once per affair its id mentions, adding `affair_id`.

    A short affair list becomes literals tested in place, a longer one an automaton that reads each
    id once, whatever their number; neither shuffles anything, and texts do not leave the JVM. A list
    beyond that is matched by equality: ids (at most 200 characters) are cut into their substrings of
    the lengths that occur among the affairs.
    """
    docs = with_id_lc(docs).filter(F.endswith("id", F.lit(".pdf")))
    wanted = affairs.select(F.col("affair").alias("affair_id")).filter("affair_id <> ''").distinct()
    if fits(wanted, AUTOMATON_AFFAIRS):
        names = sorted(tuple(r) for r in wanted.select("affair_id", F.lower("affair_id")).collect())  # at most AUTOMATON_AFFAIRS
        if not names:
            return docs.withColumn("affair_id", F.lit(None).cast("string")).filter(F.lit(False))
        if len(names) > LITERAL_AFFAIRS:
            return docs.withColumn("affair_id", F.explode(mentioned(names)("id_lc")))
        literals = F.array(*[F.lit(n) for n, _ in names])
        hits = F.filter(literals, lambda a: F.contains(F.col("id_lc"), F.lower(a)))
        return docs.withColumn("affair_id", F.explode(hits))
    pairs = affair_pairs(docs.select("id", "id_lc"), wanted)
    return docs.join(pairs, "id")


def mentioned(names: list[tuple[str, str]]):
    """A function of ids: the names, given with their lower-case forms, that an id in lower case holds, in order."""

    @F.pandas_udf("array<string>")
    def find(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick  # on executors only

        machine = ahocorasick.Automaton()
        for name, low in names:
            machine.add_word(low, [*machine.get(low, []), name])
        machine.make_automaton()
        for ids in parts:
            yield ids.map(lambda x: sorted({n for _, found in machine.iter(x or "") for n in found}))

    return find


def affair_pairs(ids: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, affair_id) by equality on substrings of the lengths that occur."""
    wanted = wanted.withColumn("piece", F.lower("affair_id"))
    wanted = wanted.filter(F.length("piece") <= SLUG_LIMIT)  # an id is no longer, so none can contain it
    lengths = [r[0] for r in wanted.select(F.length("piece")).distinct().collect()]  # at most SLUG_LIMIT numbers
    low = F.col("id_lc")

    def pieces(n: int) -> Column:
        starts = F.when(F.length(low) >= n, F.sequence(F.lit(1), F.length(low) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda at: F.substring(low, at, F.lit(n)))

    cut = ids.withColumn("piece", F.explode(F.array_distinct(F.flatten(F.array(*[pieces(n) for n in lengths])))))
    return cut.join(wanted, "piece").select("id", "affair_id").distinct()


def split_report(classified: DataFrame) -> DataFrame:
    """Per affair: class counts, overlaps, orphans, and whether the split adds up with at least one CP."""
    size = F.coalesce(chars(classified), F.lit(0))
    n_classes = F.col("is_cg").cast("int") + F.col("is_cp").cast("int") + F.col("is_av").cast("int")
    counts = classified.groupBy("affair_id").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if("is_cg").alias("n_cg"),
        F.count_if("is_cp").alias("n_cp"),
        F.count_if("is_av").alias("n_av"),
        F.count_if(n_classes > 1).alias("n_overlap"),
        F.count_if(n_classes == 0).alias("n_orphan"),
        F.sum(F.when(F.col("is_cg"), size).otherwise(0)).alias("cg_chars"),
        F.sum(F.when(F.col("is_cp"), size).otherwise(0)).alias("cp_chars"),
        F.sum(F.when(F.col("is_av"), size).otherwise(0)).alias("av_chars"),
    )
    adds_up = F.col("n_docs") == F.col("n_cg") + F.col("n_cp") + F.col("n_av")
    reason = F.when(~adds_up, F.lit("count mismatch")).when(F.col("n_cp") == 0, F.lit("no CP"))
    return counts.withColumn("reason", reason).withColumn("ok", F.col("reason").isNull())


def assert_split(report: DataFrame) -> None:
    """Raises on the first affairs whose split does not hold."""
    bad = report.filter(~F.col("ok")).select("affair_id", "reason").limit(5).collect()
    if bad:
        raise ValueError("CG/CP/AV split fails: " + ", ".join(f"{r.affair_id} ({r.reason})" for r in bad))


def with_parts(classified: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """Adds `part`, `n_parts`: which text of its affair a CG or CP document goes to.

    The caller states the limit. Parts are runs of documents in id order: a document
    belongs to part k if the texts before it in its affair hold k times `max_chars`.
    The parts of an affair, in order, are its whole text; a part exceeds the limit by
    less than its last document. Only ids and lengths are sorted, in ranges that no
    affair grows, and only those of affairs over the limit; where none is, nothing is.
    """
    size = F.coalesce(chars(classified), F.lit(0)) * (F.col("is_cg").cast("int") + F.col("is_cp").cast("int"))
    narrow = classified.select("affair_id", "id", size.alias("chars"))
    large = narrow.groupBy("affair_id").agg(F.sum("chars").alias("total")).filter(F.col("total") > max_chars).select("affair_id")
    if large.limit(1).count() == 0:
        return classified.withColumns({"n_parts": F.lit(1), "part": F.lit(0)})
    summed = running(narrow.join(large, "affair_id", "left_semi"), ["affair_id"], [F.asc("id")], before={"chars_before": F.col("chars")})
    placed = summed.withColumn("part", F.floor(F.col("chars_before") / max_chars).cast("int"))
    cut = placed.groupBy("affair_id", "id").agg(F.min("part").alias("part"))
    # parts that no document starts in are left out of the numbering
    order = Window.partitionBy("affair_id").orderBy("part")
    used = cut.select("affair_id", "part").distinct().withColumn("number", (F.row_number().over(order) - 1).cast("int"))
    count = used.groupBy("affair_id").agg(F.count(F.lit(1)).cast("int").alias("n_parts"))
    placed = cut.join(used, ["affair_id", "part"]).join(count, "affair_id").select("affair_id", "id", F.col("number").alias("part"), "n_parts")
    joined = classified.join(placed, ["affair_id", "id"], "left")
    return joined.withColumns({"part": F.coalesce("part", F.lit(0)), "n_parts": F.coalesce("n_parts", F.lit(1))})


def _joined_text(flag: str) -> Column:
    texts = F.collect_list(F.when(F.col(flag), F.struct("id", F.coalesce("content", F.lit("")).alias("content"))))
    return F.array_join(F.sort_array(texts).getField("content"), "\n")


def concat_contents(classified: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """CG and CP texts of each affair, newline-joined in id order; no document of a class gives an empty text.

    An affair over `max_chars` has several rows; those with documents of a class, newline-joined
    in `part` order, are exactly the class's whole text.
    """
    wanted = with_parts(classified.filter(F.col("is_cg") | F.col("is_cp")), max_chars)
    return wanted.groupBy("affair_id", "part", "n_parts").agg(
        F.count_if("is_cg").alias("n_cg"),
        F.count_if("is_cp").alias("n_cp"),
        _joined_text("is_cg").alias("cg_content"),
        _joined_text("is_cp").alias("cp_content"),
    )


def avenant_texts(classified: DataFrame) -> DataFrame:
    """One row per amendment document, its text under the fixed header."""
    return classified.filter("is_av").select(
        "affair_id", "id", F.concat(F.lit(AVENANT_HEADER), F.coalesce("content", F.lit(""))).alias("content")
    )


__all__ = [
    "affair_pairs", "assert_split", "avenant_texts", "chars", "classify", "classify_documents",
    "concat_contents", "docs_for_affair", "exclude_kinds", "match_affairs", "mentioned", "split_report", "with_parts",
]
