"""CP over CG, amendments over earlier rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactframe.functions.contract import VOLUME_NAME
from pactframe.functions.text import squeeze
from pactframe.functions.values import months_of
from pactframe.operators.consolidate import sequence_products
from pactframe.operators.skew import HEAVY_ROWS, lag_in_group
from pactframe.session import cut


#: Longer words are only equal to themselves: what is left of a word grows with the square of its letters.
MAX_FUZZY = 40


def resolve_terms(cg: DataFrame, cp: DataFrame, columns: list[str], key: str = "affair_id") -> DataFrame:
    """Each term from the CP when it has one, else from the CG, with `<term>_source`."""
    right = cp.select(key, *[F.col(c).alias(f"_cp_{c}") for c in columns])
    both = cg.select(key, *[F.col(c).alias(f"_cg_{c}") for c in columns]).join(right, key, "full")
    out: list[Column] = [F.col(key)]
    for c in columns:
        a, b = F.col(f"_cp_{c}"), F.col(f"_cg_{c}")
        out.append(F.coalesce(a, b).alias(c))
        out.append(F.when(a.isNotNull(), F.lit("CP")).when(b.isNotNull(), F.lit("CG")).alias(f"{c}_source"))
    return both.select(*out)


def normal_description(col: Column) -> Column:
    return F.lower(squeeze(col))


def words_of(desc: Column) -> Column:
    """Different words of a description; none for the name of a volume, which names a product and a period."""
    found = F.array_distinct(F.filter(F.split(desc, r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    return F.when(desc.rlike("(?i)" + VOLUME_NAME), F.array().cast("array<string>")).otherwise(found)


def edits_allowed(word: Column) -> Column:
    """How many letters may differ: none in short words and in whatever holds a digit, one, or two from eight letters on."""
    letters = F.length(word)
    plain = ~word.rlike(r"\d") & (letters <= MAX_FUZZY)
    return F.when(plain & (letters >= 8), F.lit(2)).when(plain & (letters >= 4), F.lit(1)).otherwise(F.lit(0))


def shortened(word: Column) -> Column:
    """The word and what is left of it when up to as many letters as may differ are taken out."""

    def less_one(w: Column) -> Column:
        at = F.sequence(F.lit(1), F.length(w))
        return F.transform(at, lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))

    allowed, once = edits_allowed(word), less_one(word)
    twice = F.flatten(F.transform(once, less_one))
    return F.array_distinct(
        F.when(allowed == 2, F.concat(F.array(word), once, twice)).when(allowed == 1, F.concat(F.array(word), once)).otherwise(F.array(word))
    )


def near_words(words: DataFrame, known: DataFrame) -> DataFrame:
    """(word, near, edits): distinct words of `words` and those of `known` within the edits that the shorter one allows.

    Two words that differ in k letters share what is left of both when the right k letters or fewer are taken out, so they
    meet by equality on that; the distance is then measured.
    """
    left = words.select("word", F.explode(shortened(F.col("word"))).alias("rest"))
    right = known.select(F.col("word").alias("near"), F.explode(shortened(F.col("word"))).alias("rest"))
    met = left.join(right, "rest").select("word", "near").distinct()
    edits = met.withColumn("edits", F.levenshtein("word", "near"))
    return edits.filter(F.col("edits") <= F.least(edits_allowed(F.col("word")), edits_allowed(F.col("near"))))


def respelled(words: DataFrame, known: DataFrame, desc: str) -> DataFrame:
    """Words (affair_id, `desc`, word) with those that their affair's `known` words lack replaced by the nearest of these:
    fewest edits, then first in order. A word without a near one stays."""
    both = ["affair_id", "word"]
    vocabulary = known.select(*both).distinct()
    strange = cut(words.select(*both).distinct().join(vocabulary, both, "left_anti"))
    near = near_words(strange.select("word").distinct(), vocabulary.select("word").distinct())
    local = strange.join(near, "word").join(vocabulary.withColumnRenamed("word", "near"), ["affair_id", "near"])
    best = local.groupBy(*both).agg(F.min(F.struct("edits", "near")).alias("best"))
    spelled = words.join(best, both, "left").withColumn("word", F.coalesce("best.near", "word"))
    return spelled.select("affair_id", desc, "word").distinct()


def match_by_description(cp: DataFrame, av: DataFrame, min_share: float = 0.5) -> DataFrame:
    """For each amendment description of an affair, the likeliest CP description and its `likeness`.

    Equal descriptions have likeness 1. Others are as like as their sets of words: shared words over all words, which
    has to reach `min_share`; ties go to the first in order. An amendment's word that the affair's CP descriptions lack
    counts as the one of their words that is nearest in spelling, within one or two letters, so that plurals and typing
    errors are shared words. Names of volumes only equal themselves: another period is another product.

    Descriptions meet on words, the rarest first: two sets that share enough share one of the first
    `size - ceil(min_share * size) + 1` words of either, so frequent words form no pairs. CP descriptions of
    affairs without amendments go no further than being told apart.
    """
    def descriptions(products: DataFrame, name: str) -> DataFrame:
        named = products.select("affair_id", normal_description(F.col("product_name")).alias(name))
        return named.filter(F.col(name) != "").distinct()

    # read by several steps below: written once, so that the products behind them are not
    wanted = cut(descriptions(av, "av_desc"))
    known = cut(descriptions(cp, "cp_desc").join(wanted.select("affair_id").distinct(), "affair_id", "left_semi"))
    same = known.select("affair_id", F.col("cp_desc").alias("av_desc"), F.lit(True).alias("_same"))
    met = cut(wanted.join(same, ["affair_id", "av_desc"], "left"))
    settled = met.filter("_same").select("affair_id", "av_desc", F.col("av_desc").alias("cp_desc"), F.lit(1.0).alias("likeness"))
    open_ = met.filter("_same IS NULL").drop("_same")

    # words are read by several steps too
    cp_words = cut(known.select("affair_id", "cp_desc", F.explode(words_of(F.col("cp_desc"))).alias("word")))
    often = cp_words.groupBy("affair_id", "word").agg(F.count(F.lit(1)).alias("n"))

    def rarest_first(words: DataFrame, name: str) -> DataFrame:
        counted = words.join(often, ["affair_id", "word"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
        ordered = F.sort_array(F.collect_list(F.struct("n", "word")))["word"]
        one = counted.groupBy("affair_id", name).agg(ordered.alias(f"{name}_words"))
        size = F.size(f"{name}_words")
        head = F.slice(f"{name}_words", F.lit(1), (size - F.ceil(F.lit(min_share) * size) + 1).cast("int"))
        return one.withColumn("word", F.explode(head))

    av_words = open_.select("affair_id", "av_desc", F.explode(words_of(F.col("av_desc"))).alias("word"))
    av_words = respelled(cut(av_words), cp_words, "av_desc")
    met = rarest_first(av_words, "av_desc").join(rarest_first(cp_words, "cp_desc"), ["affair_id", "word"])
    shared = F.size(F.array_intersect("av_desc_words", "cp_desc_words"))
    likeness = shared / (F.size("av_desc_words") + F.size("cp_desc_words") - shared)
    close = met.withColumn("likeness", likeness).filter(F.col("likeness") >= min_share)
    best = close.groupBy("affair_id", "av_desc").agg(F.min(F.struct(-F.col("likeness"), "cp_desc")).alias("best"))
    found = best.select("affair_id", "av_desc", "best.cp_desc", (-F.col("best.col1")).alias("likeness"))
    return settled.unionByName(found)


#: What names, orders and prices a product row: all that matching and comparing amendments read.
COMPARED = [
    "affair_id", "request_id", "pos", "is_av", "avenant_number", "product_code", "product_name", "signature_date_cp", "signature_date_av",
    "loyer", "loyer_periodicity", "price_unitaire",
]


def amendment_delta(sequenced: DataFrame, floor: float = HEAVY_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """Old cost, new cost and difference where an amendment restates a product of the affair.

    `product_key` names the product; rows are compared with the nearest earlier row of the
    same key by `seq`. Like is compared with like: rents on an annual `basis` where both rows
    have one, else unit prices where both have one; otherwise the costs are NULL and `reason`
    says what is missing. Rows that had their key before their `seq` stay dealt by affair.
    """
    annual = F.col("loyer") * 12 / months_of(F.col("loyer_periodicity"))
    rows = sequenced.filter(F.col("product_key").isNotNull()).select(
        "affair_id", "product_key", "seq", "is_av", "avenant_number",
        F.struct(annual.alias("rent"), F.col("price_unitaire").alias("price")).alias("_cost"),
    )
    lagged = lag_in_group(rows, ["affair_id", "product_key"], "seq", "_cost", "_old", floor, sizes=sizes)
    rents = F.col("_old.rent").isNotNull() & F.col("_cost.rent").isNotNull()
    prices = F.col("_old.price").isNotNull() & F.col("_cost.price").isNotNull()
    costs = [F.when(rents, F.col(f"{side}.rent")).when(prices, F.col(f"{side}.price")) for side in ("_old", "_cost")]
    none = [F.col(f"{side}.rent").isNull() & F.col(f"{side}.price").isNull() for side in ("_old", "_cost")]
    reason = F.when(~(rents | prices), F.when(none[0], F.lit("no old cost")).when(none[1], F.lit("no new cost")).otherwise(F.lit("unlike costs")))
    return lagged.filter(F.col("is_av") & F.col("_old").isNotNull()).select(
        "affair_id", "product_key", "seq", "avenant_number",
        F.when(rents, F.lit("annual_rent")).when(prices, F.lit("unit_price")).alias("basis"),
        costs[0].alias("old_cost"), costs[1].alias("new_cost"), (costs[1] - costs[0]).alias("delta"), reason.alias("reason"),
    )


def with_product_key(products: DataFrame, min_share: float = 0.5) -> DataFrame:
    """Adds `product_key`: the code; without one, the key of the CP row with the same or the likeliest description, else
    the row's own description. A CP description stands for the smallest code among its rows, else for itself."""
    desc = normal_description(F.col("product_name"))
    cp = products.filter(~F.col("is_av"))
    uncoded = products.filter(F.col("product_code").isNull())
    keys = cut(
        cp.withColumn("cp_desc", desc).filter("cp_desc <> ''").groupBy("affair_id", "cp_desc").agg(
            F.coalesce(F.min("product_code"), F.col("cp_desc")).alias("cp_key"), F.bool_or(F.col("product_code").isNull()).alias("_asked")
        )
    )
    # a row per distinct description, read by every later pass: written once
    matched = match_by_description(cp, uncoded.filter("is_av"), min_share).join(keys, ["affair_id", "cp_desc"])
    by_av = cut(matched.select("affair_id", F.col("av_desc").alias("_desc"), F.lit(True).alias("_av"), F.col("cp_key").alias("_key")))
    by_cp = keys.filter("_asked").select("affair_id", F.col("cp_desc").alias("_desc"), F.lit(False).alias("_av"), F.col("cp_key").alias("_key"))
    coded = products.filter(F.col("product_code").isNotNull()).withColumn("product_key", F.col("product_code"))
    named = uncoded.withColumns({"_desc": desc, "_av": F.col("is_av")})
    keyed = named.join(by_av.unionByName(by_cp), ["affair_id", "_desc", "_av"], "left")
    return coded.unionByName(keyed.withColumn("product_key", F.coalesce("_key", "_desc")).select(*products.columns, "product_key"))


def with_amendment_evidence(products: DataFrame, min_share: float = 0.5) -> DataFrame:
    """`evidence_avenant` of amendment rows that restate a product, where none is given: old cost, new cost, difference."""
    rows = cut(products.select(*COMPARED))
    sequenced = sequence_products(rows, sizes=rows)
    money = lambda name: F.col(name).cast("decimal(18,2)").cast("string")
    sign = F.when(F.col("delta") >= 0, F.lit("+")).otherwise(F.lit(""))
    text = F.concat(F.lit("ancien "), money("old_cost"), F.lit(", nouveau "), money("new_cost"), F.lit(", écart "), sign, money("delta"))
    delta = amendment_delta(with_product_key(sequenced, min_share), sizes=rows).select("affair_id", "seq", text.alias("_change"))
    told = delta.join(sequenced.select("affair_id", "seq", "request_id", "pos"), ["affair_id", "seq"]).drop("seq")
    keyed = products.join(told, ["affair_id", "request_id", "pos"], "left")
    return keyed.withColumn("evidence_avenant", F.coalesce("evidence_avenant", "_change")).select(*products.columns)
