"""Column functions for the wording found in contract texts. All native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactframe.functions.text import blank_to_null, first_match, fold_accents, literal_map, squeeze, strip
from pactframe.functions.values import parse_date
from pactframe.schemas import CURRENCIES

# --- fixed values: wordings that carry a meaning ----------------------------
# On the text in lower case:
# A pattern tried at every place looks first for the letters that it can begin with.
ONE_TIME = (
    r"(?=[acdehklmops][efinorty])\b(?:concession|licen[cs]es?|droits? d['’]usage|otc|mise en (?:œ|oe)uvre|set-?up|milestone|on order|"
    r"after design phase|at delivery|end of uat|production start-?up|kick-?off|hypercare)\b"
)
INCLUDED = r"(?=[cgi][nor])\b(?:inclus|gratuit|compris)e?s?\b"
ZERO_PRICE = r"(?=0)(?<![\p{L}\d.,])0(?:[.,]0+)?\s*€"
VOLUME = r"(?=[dpsuv][12aeénotu])\b(?:volumes?|unit[ée]s? d['’](?:œ|oe)uvre|paliers?|s[12]|d[ée]gressif|utilisateurs?|suppl[ée]mentaires?)\b"
OVERCONSUMPTION = (
    r"(?=[acdpsu][12aeénotu])(?:d[ée]passement|compl[ée]ment de consommation|surconsommation|au-del[àa] de l['’]engagement|"
    r"utilisateur suppl[ée]mentaire|seat additionnel|palier|unit[ée] d['’](?:œ|oe)uvre|\bs[12]\b|d[ée]gressif)"
)
RECAP = r"^[\s|*-]*(?:(?:sous-)?total|r[ée]cap(?:itulatif|s)?)(?!\p{L})"
RECAP_EXCEPTION = "montant forfaitaire mensuel total"
CADENCE = r"(?=[amst/p])(trimestriel|semestriel|mensuel|annuel|(?:par |/ |/)(?:trimestre|semestre|mois|an\b))"
CADENCE_NOUNS = {"mois": "Mensuelle", "trimestre": "Trimestrielle", "semestre": "Semestrielle", "an": "Annuelle"}
CADENCE_WORDS = {
    "mensuel": "Mensuelle", "trimestriel": "Trimestrielle", "semestriel": "Semestrielle", "annuel": "Annuelle",
    **{lead + noun: period for noun, period in CADENCE_NOUNS.items() for lead in ("par ", "/ ", "/")},
}
SLA = r"\bsla\b|niveaux? de services?"
SLA_LEVEL = r"\b(standard|premium)\b"
TACIT = r"reconduction tacite|tacite reconduction|renouvellement automatique|automatic (?:reconduction|renewal)"
NOT_TACIT = r"(?:sans|pas de|aucune|exclut (?:toute|la)) (?:reconduction tacite|tacite reconduction|renouvellement automatique)"
AT_SIGNATURE = r"[àa] la signature"
IN_ARREARS = r"(?<!\p{L})[ée]chue?s?(?!\p{L})"
IN_ADVANCE = r"[àa] [ée]choir"
# On the text as printed:
AMOUNT = r"(?=[-−\d])(?<![\p{L}\d.,])[-−]?(?:\d{1,3}(?:[ .\u00a0\u202f]\d{3})+|\d+)(?:[.,]\d+)?"
CURRENCY_WORD = r"€|EUR|\$|USD|£|GBP|CHF|CAD|AUD|¥|JPY"
GAP = r"[ \t\u00a0\u202f]*"  # an amount and its currency stand on one line
PRICED = rf"({AMOUNT}){GAP}(?:({CURRENCY_WORD})(?:{GAP}(HT|TTC)\b)?|(HT|TTC)\b)"
CURRENCY_CODES = {"€": "EUR", "$": "USD", "£": "GBP", "¥": "JPY", **{c: c for c in CURRENCIES}}
THOUSANDS_DOT = r"(?<=[1-9][\d.]{0,9})\.(?=\d{3}(?:\D|$))"
AMOUNT_LETTERS = {"\u2212": "-", ",": ".", " ": "", "\u00a0": "", "\u202f": ""}
CAP = r"(?i)(plafonné\p{L}*\s+à\s+\d+(?:[.,]\d+)?\s*%)"
# --- end of fixed values ----------------------------------------------------


def amount_value(raw: Column) -> Column:
    """Number as printed: thousands separators out, decimal comma to point."""
    number = F.when(F.contains(raw, F.lit(".")), F.regexp_replace(raw, THOUSANDS_DOT, "")).otherwise(raw)
    for printed, plain in AMOUNT_LETTERS.items():
        number = F.replace(number, F.lit(printed), F.lit(plain))
    return number.try_cast("double")


def currency_of(word: Column) -> Column:
    """ISO code of a printed currency; NULL for none."""
    return F.try_element_at(literal_map(CURRENCY_CODES), word)


def cadence_named(low: Column) -> Column:
    """First cadence a lower-case text names, else NULL."""
    found = F.regexp_extract(low, CADENCE, 1)
    return F.when(found != "", F.try_element_at(literal_map(CADENCE_WORDS), found))


def cadence_of(low: Column) -> Column:
    """First cadence a lower-case text names, else `unknown`."""
    return F.coalesce(cadence_named(low), F.lit("unknown"))


def is_recap(low: Column) -> Column:
    """Total or recap wording, unless it is the price of a product family."""
    return low.rlike(RECAP) & ~F.contains(low, F.lit(RECAP_EXCEPTION))


def line_flags(low: Column) -> Column:
    zero = F.contains(low, F.lit("€")) & low.rlike(ZERO_PRICE)
    return F.struct(
        low.rlike(ONE_TIME).alias("is_one_time"),
        (low.rlike(INCLUDED) | zero).alias("is_included"),
        low.rlike(VOLUME).alias("is_volume"),
        low.rlike(OVERCONSUMPTION).alias("is_overconsumption"),
    )


def volume_name(family: Column, year: Column, half: Column) -> Column:
    return F.concat(F.lit("Abonnement volume "), family, F.lit(" — "), year.cast("string"), F.lit(" "), half)


VOLUME_NAME = r"^Abonnement volume (.+) — (\d{4}) (S[12])$"


def volume_period(name: Column) -> Column:
    """Family, year and half-year of a volume product name; NULL fields for other names."""
    return F.struct(
        first_match(name, VOLUME_NAME, 1).alias("family"),
        F.regexp_extract(name, VOLUME_NAME, 2).try_cast("int").alias("year"),
        first_match(name, VOLUME_NAME, 3).alias("half"),
    )


DURATION = r"^\s*(\d+(?:[.,]\d+)?)\s*(?:mois|Mois|MOIS|months?)?\s*((?s).*)$"


def split_duration(text: Column, tacit: Column) -> Column:
    """Months and the remainder; with tacit renewal the duration is `indeterminé`."""
    months = first_match(text, DURATION)
    rest = F.when(months.isNotNull(), F.regexp_extract(text, DURATION, 2)).otherwise(text)
    holds = F.coalesce(tacit, F.lit(False))
    return F.struct(
        F.when(holds, F.lit("indeterminé")).otherwise(months).alias("duree"),
        F.when(~holds, F.translate(months, ",", ".").try_cast("double")).alias("duree_mois"),
        blank_to_null(squeeze(rest)).alias("notes"),
    )


def service_start(text: Column, signature_av: Column, signature_cp: Column) -> Column:
    """The signature date when the text says so, else the date the text prints, else NULL."""
    at_signature = F.lower(text).rlike(AT_SIGNATURE)
    return F.when(at_signature, F.coalesce(parse_date(signature_av), parse_date(signature_cp))).otherwise(
        parse_date(text)
    )


UNIT_PRICE = r"(\d+(?:[.,]\d+)?)\s*(?:€|EUR)"


def overconsumption(text: Column, low: Column | None = None) -> Column:
    """Unit price for excess use as text when printed, else the rule wording; NULL without such wording."""
    low = F.lower(text) if low is None else low
    price = F.translate(first_match(text, UNIT_PRICE), ",", ".")
    return F.when(
        low.rlike(OVERCONSUMPTION),
        F.struct(
            F.coalesce(price, squeeze(text)).alias("price"),
            price.try_cast("double").alias("unit_price"),
            F.nullif(cadence_of(low), F.lit("unknown")).alias("periodicity"),
            F.when(low.rlike(IN_ARREARS), F.lit("Échu"))
            .when(low.rlike(IN_ADVANCE), F.lit("À échoir"))
            .alias("term_mode"),
        ),
    )


CHECKED = r"☒\s*(\p{L}+)"
# Plain wording on the form -> enum member.
METHOD_WORDS = {
    "virement": "virement", "prelevement": "prelevement", "cheque": "cheque", "portal": "portal", "portail": "portal",
}
DELAY = r"([AÀ] \d+ jours(?: fin de mois| date de facture)?)"


def payment_methods(text: Column) -> Column:
    """Checked boxes as enum members in form order; unknown ones are `other`."""

    known = literal_map(METHOD_WORDS)

    def member(word: Column) -> Column:
        return F.coalesce(F.try_element_at(known, fold_accents(word)), F.lit("other"))

    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(CHECKED), F.lit(1)), member))


def payment_terms(text: Column) -> Column:
    """The delay wording, such as `A 45 jours date de facture`."""
    return first_match(text, DELAY)


FORMULA = r"(PN?\s*=\s*[^,;\n]+)"
PERCENT = r"(\d+(?:[.,]\d+)?)\s*%"
COMPUTED = r"\b((?:annuelle|semestrielle|trimestrielle|mensuelle)ment)\b"
APPLIED = r"(?i)\b(le 1er \p{L}+)"
APPLIED_FROM = r"(?<!\p{L})[àa] (?:partir|compter) de (\d{4})"


def reval_terms(text: Column, low: Column | None = None) -> Column:
    """Revaluation method, rate when fixed, formula with its cap, and the timing wordings."""
    low = F.lower(text) if low is None else low
    formula = first_match(text, FORMULA)
    indexed = F.contains(low, F.lit("syntec")) | F.contains(low, F.lit("indice")) | formula.isNotNull()
    about = low.rlike("revalori|r[ée]vis|index|syntec") | formula.isNotNull()
    rate = F.translate(first_match(text, PERCENT), ",", ".").try_cast("double")
    return F.when(
        about,
        F.struct(
            F.when(indexed, F.lit("index_formula")).when(rate.isNotNull(), F.lit("fixed_rate")).otherwise(F.lit("textual")).alias("reval_method"),
            F.when(~indexed, rate).alias("reval_rate_per"),
            F.when(indexed, F.concat_ws(", ", strip(formula), first_match(text, CAP))).alias("reval_formula"),
            first_match(low, COMPUTED).alias("reval_compute_when"),
            first_match(text, APPLIED).alias("reval_apply_when"),
            first_match(low, APPLIED_FROM).alias("reval_apply_from"),
        ),
    )
