"""Column functions on paths, ids and short texts. All native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactframe.schemas import SLUG_MAX

# What counts as blank at the ends of a text (wider than the plain space).
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(BLANKS))


def squeeze(col: Column) -> Column:
    """Strip, and turn every run of blanks into one space."""
    return strip(F.regexp_replace(col, "[" + BLANKS + "]+", " "))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def slug(path: Column, max_len: int = SLUG_MAX) -> Column:
    """Key-safe id of a path. Lossy, so two paths may share one (see `id_collisions`)."""
    flat = F.translate(strip(path), "/\\?#", "____")
    safe = F.regexp_replace(flat, "[^A-Za-z0-9._-]+", "-")
    return F.btrim(F.substring(safe, 1, max_len), F.lit("-_."))


def parse_path(path: Column) -> Column:
    """Struct of the fields a `letter/company/.../file` path carries; `path_ok` is false for shorter ones."""
    parts = F.filter(F.split(strip(path), r"[\\/]+"), lambda p: p != "")
    n = F.size(parts)
    ok = F.coalesce(n >= 3, F.lit(False))
    letter = F.when(ok, F.try_element_at(parts, F.lit(1)))
    company = F.when(ok, F.try_element_at(parts, F.lit(2)))
    affair = F.when(n > 3, F.array_join(F.slice(parts, F.lit(3), F.greatest(n - 3, F.lit(0))), "/"))
    company_key = F.concat_ws("/", letter, company)
    return F.struct(
        letter.alias("letter"),
        company.alias("company"),
        affair.alias("affair"),
        F.when(ok, F.try_element_at(parts, F.lit(-1))).alias("filename"),
        F.when(ok, company_key).alias("company_key"),
        F.when(ok, F.concat_ws("/", company_key, F.coalesce(affair, F.lit("root")))).alias("affair_key"),
        ok.alias("path_ok"),
    )


def has_word(haystack_lc: Column, needle: Column | str) -> Column:
    """Substring test on an already lower-cased text."""
    needle = F.lit(needle.lower()) if isinstance(needle, str) else F.lower(needle)
    return F.contains(haystack_lc, needle)


def has_any(haystack_lc: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for word in words:
        out = out | has_word(haystack_lc, word)
    return out


def affairs_list(text: Column) -> Column:
    """Comma-separated affairs as an array, trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(text, ","), strip), lambda a: a != "")


def fold_accents(col: Column) -> Column:
    """Lower case without the French accents. For words; long texts are tested in plain lower case."""
    return F.translate(F.lower(col), "àâäéèêëîïôöùûüç", "aaaeeeeiioouuuc")


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def first_match(col: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, NULL without one; evaluates its input once."""
    return F.try_element_at(F.regexp_extract_all(col, F.lit(pattern), F.lit(group)), F.lit(1))


def clean_evidence(col: Column, max_len: int = 80) -> Column:
    """One line of at most `max_len` characters."""
    return blank_to_null(F.left(squeeze(col), F.lit(max_len)))


CITATION = r"\[\s*((?:CP|CG|AV)\w*)\s*,?\s*p\s*(\d+)\s*\]"


def citations(col: Column) -> Column:
    """Array of (source, page) from tags like `[CP p12]` or `[AV2, p4]`."""
    source = F.regexp_extract_all(col, F.lit(CITATION), F.lit(1))
    page = F.regexp_extract_all(col, F.lit(CITATION), F.lit(2))
    return F.zip_with(
        source, page, lambda s, p: F.struct(s.alias("source"), p.try_cast("int").alias("page"))
    )
