"""Column functions on dates, numbers, periods and missing values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactframe.functions.text import fold_accents, literal_map, strip
from pactframe.schemas import PERIODS

# First letters of the month names read in contracts, accents folded.
MONTH_STEMS = {
    "jan": 1, "fev": 2, "feb": 2, "mar": 3, "avr": 4, "apr": 4, "mai": 5, "may": 5, "juin": 6, "jun": 6,
    "juil": 7, "jul": 7, "aou": 8, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
}
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
DAY_FIRST = r"^\d{2}/\d{2}/\d{4}$"
NAMED_DATE = r"^(\d{1,2})(?:er)? +([a-z]+)\.? +(\d{4})$"
NUMBER = r"(?i)^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?)$"


def parse_date(col: Column) -> Column:
    """ISO, day-first, or day + month name (French or English); anything else is NULL.

    The shape is tested first, so text that is no date costs no failed parse.
    """
    text = strip(col)
    low = fold_accents(text)
    word = F.regexp_extract(low, NAMED_DATE, 2)
    stem = F.when(word.startswith("jui"), F.left(word, F.lit(4))).otherwise(F.left(word, F.lit(3)))
    month = F.try_element_at(literal_map(MONTH_STEMS), stem)
    year, day = F.regexp_extract(low, NAMED_DATE, 3), F.regexp_extract(low, NAMED_DATE, 1)
    turned = F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2))
    return (
        F.when(text.rlike(ISO_DATE), text.try_cast("date"))
        .when(text.rlike(DAY_FIRST), turned.try_cast("date"))
        .when(low.rlike(NAMED_DATE) & month.isNotNull(), F.concat_ws("-", year, month.cast("string"), day).try_cast("date"))
    )


def parse_number(col: Column) -> Column:
    """Number in a text, else NULL. Type suffixes such as `12.5d` are not numbers."""
    text = strip(col.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def months_of(period: Column) -> Column:
    """Months in a named period; NULL for unknown ones."""
    return F.try_element_at(literal_map(PERIODS), period)


def missing_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit("null"))


def normalize_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Text `null` becomes a real NULL in string columns."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: missing_to_null(F.col(c)) for c in names})


def render_missing(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Export form: every column as text, NULL written as `null`."""
    keep = keep or []

    def text(field: T.StructField) -> Column:
        col = F.col(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            col = F.to_json(col)
        return F.coalesce(col.cast("string"), F.lit("null")).alias(field.name)

    return df.select(*[F.col(f.name) if f.name in keep else text(f) for f in df.schema.fields])


def flag(col: Column) -> Column:
    """A missing flag does not hold."""
    return F.coalesce(col, F.lit(False))
