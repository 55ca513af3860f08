"""Fixed values and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# They decide results, so they are stated here once, as text.

CP_KEYWORDS = ["SOUSCRIPTION", "CP", "CONTRAT-SAAS", "CONTRAT-PRESTATIONS", "BDC-LICENCE", "CONTRAT-P"]
CG_KEYWORDS = ["CADRE", "CG"]
AV_KEYWORDS = ["AVENANT-", "APPLICATION"]
CG_VETO = "-avenant-"

EXCLUDED_KINDS = ["-ASP-", "ANNEXE-DONNEES-PERSONNELLES"]
EXCLUDED_VENDOR_KIND = "PLAN-PROJET-"  # followed by the vendor's own name

CADRE_HEADER = "=== DOC: CADRE — type=cadre ===\n"
SOUSCRIPTION_HEADER = "=== DOC: SOUSCRIPTION — type=souscription ===\n"
AVENANT_HEADER = "=== DOC: AVENANT — type=avenant ===\n"
CONTENT_LABEL = "DOCUMENT CONTENT:\n\n"
TASK_LABEL = "\n\nTASK:\n"
BLOCK_GAP = "\n\n"

PAGE_PRICE_PER_1000 = 8.626
INPUT_EUR_PER_1M = 1.73
OUTPUT_EUR_PER_1M = 6.91
EXTRAPOLATED_DOCUMENTS = 2000
SLUG_MAX = 200

PERIODS = {"Mensuelle": 1, "Trimestrielle": 3, "Semestrielle": 6, "Annuelle": 12}
CURRENCIES = ["EUR", "USD", "GBP", "CHF", "CAD", "AUD", "JPY"]
TACIT_END = "2099-12-31"
SLA_CODES = {"04311": "Standard", "04317": "Premium"}

PRODUCT_FIELDS = """
  company_name STRING, numero_de_contrat STRING, signature_date_cg STRING, signature_date_cp STRING,
  signature_date_av STRING, avenant_number INT, product_code STRING, product_name STRING,
  service_start_date STRING, duree_de_service STRING, duree_de_service_notes STRING,
  date_end_of_contract STRING, reconduction_tacite BOOLEAN, term_mode STRING, billing_frequency STRING,
  bon_de_commande BOOLEAN, bon_de_commande_code STRING, payment_methods ARRAY<STRING>, payment_terms STRING,
  debut_facturation STRING, price_unitaire DOUBLE, quantity DOUBLE, quantity_periodicity STRING,
  is_volume_product BOOLEAN, loyer DOUBLE, loyer_facturation DOUBLE, loyer_annuele DOUBLE,
  devise_de_facturation STRING, loyer_periodicity STRING, one_shot_service BOOLEAN, tax_basis STRING,
  is_included BOOLEAN, usage_overconsumption_price STRING, usage_overconsumption_periodicity STRING,
  usage_term_mode STRING, overconsumption_term_mode STRING, usage_notes STRING, billing_modality_notes STRING,
  reval_method STRING, reval_rate_per DOUBLE, reval_formula STRING, reval_compute_when STRING,
  reval_apply_when STRING, reval_apply_from STRING, reval_source STRING, evidence_product STRING,
  evidence_price STRING, evidence_payment_methods STRING, evidence_date_end_of_contract STRING,
  evidence_avenant STRING, evidence_usage STRING, evidence_revalorization STRING, evidence_billing STRING,
  evidence_dates STRING, evidence_contract_errors STRING, confidence_price DOUBLE, confidence_usage DOUBLE,
  confidence_revalorization DOUBLE, confidence_billing DOUBLE, confidence_dates DOUBLE,
  confidence_company DOUBLE, confidence_avenant DOUBLE
"""

TERM_MODES = ["À échoir", "Échu", "unknown"]
CADENCES = ["Mensuelle", "Trimestrielle", "Annuelle", "unknown"]
ENUMS = {
    "devise_de_facturation": CURRENCIES,
    "tax_basis": ["HT", "TTC", "unknown"],
    "term_mode": TERM_MODES,
    "loyer_periodicity": CADENCES,
    "usage_overconsumption_periodicity": CADENCES + ["Semestrielle"],
    "quantity_periodicity": CADENCES + ["Semestrielle"],
    "usage_term_mode": TERM_MODES,
    "overconsumption_term_mode": TERM_MODES,
    "reval_method": ["fixed_rate", "index_formula", "textual", "unknown"],
    "reval_source": ["CG", "CP", "unknown"],
    "billing_frequency": CADENCES,
}
PAYMENT_METHODS = ["virement", "prelevement", "cheque", "portal", "other"]

# confidence column -> (value it rates, evidence it must rest on)
CONFIDENCE_OF = {
    "confidence_price": ("price_unitaire", "evidence_price"),
    "confidence_usage": ("usage_overconsumption_price", "evidence_usage"),
    "confidence_revalorization": ("reval_method", "evidence_revalorization"),
    "confidence_billing": ("billing_frequency", "evidence_billing"),
    "confidence_dates": ("signature_date_cp", "evidence_dates"),
    "confidence_company": ("company_name", None),
    "confidence_avenant": ("avenant_number", "evidence_avenant"),
}

RECURRING_FIELDS = ["loyer", "loyer_facturation", "loyer_annuele", "billing_frequency", "loyer_periodicity"]
AFFAIR_DATES = ["signature_date_cg", "signature_date_cp"]
AFFAIR_FIELDS = ["company_name", "numero_de_contrat", "devise_de_facturation", "reconduction_tacite"]
# --- end of fixed values ----------------------------------------------------

TYPES = {
    "STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(), "BINARY": T.BinaryType(), "TIMESTAMP": T.TimestampType(),
    "ARRAY<STRING>": T.ArrayType(T.StringType()),
}


def struct(fields: str) -> T.StructType:
    """Schema from `name TYPE, ...`; needs no session, so executors can import it."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


PRODUCT = struct(PRODUCT_FIELDS)
PRODUCT_COLUMNS = PRODUCT.fieldNames()
PRODUCT_KEYS = ["affair_id", "request_id", "pos"]

FILES = struct("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
ANALYZED = struct("path STRING, content STRING, languages ARRAY<STRING>, page_count INT, error STRING")
DOCUMENTS = struct(
    "id STRING, title STRING, content STRING, file_path STRING, language STRING, page_count INT,"
    "analyse_doc_model STRING, company_letter STRING, company_name STRING, company_affair STRING,"
    "company_name_path STRING, company_affair_path STRING, id_lc STRING, path_ok BOOLEAN"
)
MESSAGE = struct("role STRING, content STRING")
REQUESTS = struct("request_id STRING, affair_id STRING, doc_class STRING").add("messages", T.ArrayType(MESSAGE))
RESPONSES = struct(
    "request_id STRING, arguments STRING, finish_reason STRING,"
    "prompt_tokens BIGINT, completion_tokens BIGINT, total_tokens BIGINT"
)


def excluded_kinds(vendor: str | None = None) -> list[str]:
    """Kinds left out before extraction; a vendor adds its own project-plan kind."""
    return EXCLUDED_KINDS + ([EXCLUDED_VENDOR_KIND + vendor] if vendor else [])
