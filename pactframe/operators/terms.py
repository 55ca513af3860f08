"""Contract-level terms read out of a document's text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactframe.functions.contract import NOT_TACIT, TACIT, payment_methods, payment_terms, reval_terms
from pactframe.functions.text import first_match, squeeze
from pactframe.functions.values import parse_date
from pactframe.schemas import CURRENCIES

# --- fixed values: where a document states a term ---------------------------
CONTRACT_NUMBER = r"(?<![\d-])(\d+-\d+)(?![\d-])"
CURRENCY = r"[Dd]evise de facturation\s*:?\s*(" + "|".join(CURRENCIES) + r")\b"
SIGNED = r"(?:[Dd]ate de signature|[Ss]igné(?:e)? le)\s*:?\s*(\d{1,2}/\d{2}/\d{4}|\d{4}-\d{2}-\d{2}|\d{1,2} \p{L}+ \d{4})"
TAX_BASIS = r"\b(HT|TTC)\b"
ORDER_FORM_WORDS = "bon de commande"
ORDER_FORM = r"(?i)bon de commande\s+(\d{6} \d{6}|[\w-]*\d[\w-]*)"
BILLING_START = r"[Dd]ébut de facturation\s*:?\s*([^\n]+)"
NEW_STYLE_YEAR = 2023
# --- end of fixed values ----------------------------------------------------


def contract_terms(docs: DataFrame) -> DataFrame:
    """One row per document: number, currency, renewal, tax basis, order form, billing start, era.

    Renewal is false only where the text rules it out, NULL where it is silent, so
    the CP can override the CG (`resolve_terms`).
    """
    text, low = F.col("content"), F.col("_low")
    keys = [c for c in docs.columns if c != "content"]
    found = docs.withColumn("_low", F.lower(text)).select(
        *keys,
        first_match(text, CONTRACT_NUMBER).alias("numero_de_contrat"),
        first_match(text, CURRENCY).alias("devise_de_facturation"),
        F.when(low.rlike(NOT_TACIT), F.lit(False)).when(low.rlike(TACIT), F.lit(True)).alias("reconduction_tacite"),
        first_match(text, TAX_BASIS).alias("tax_basis"),
        F.contains(low, F.lit(ORDER_FORM_WORDS)).alias("bon_de_commande"),
        first_match(text, ORDER_FORM).alias("bon_de_commande_code"),
        squeeze(first_match(text, BILLING_START)).alias("debut_facturation"),
        first_match(text, SIGNED).alias("_signed"),
        payment_methods(text).alias("payment_methods"),
        payment_terms(text).alias("payment_terms"),
        reval_terms(text, low).alias("_reval"),
    )
    signed = F.col("signature_date")
    era = F.when(F.year(signed) > NEW_STYLE_YEAR, F.lit("new")).when(signed.isNotNull(), F.lit("old"))
    return (
        found.withColumn("signature_date", parse_date(F.col("_signed")))
        .withColumns({"era": era, **{f: F.col("_reval")[f] for f in ("reval_method", "reval_rate_per", "reval_formula")}})
        .drop("_signed", "_reval")
    )
