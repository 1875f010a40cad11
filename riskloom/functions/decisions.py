"""Decision rules, identifiers and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.numeric import col

# Default thresholds of the service and of the domain rule.
SERVICE_THRESHOLD = 0.3
DOMAIN_THRESHOLD = 0.5

# Folder of each document type, and the accepted file types.
DOCUMENT_FOLDERS = {
    2: "identity",
    3: "financial/income",
    4: "employment",
    5: "financial/banking",
    6: "personal",
    7: "personal",
    8: "personal",
    9: "financial/insurance",
    10: "financial/tax",
    11: "personal",
    12: "personal",
    13: "personal",
    14: "personal",
    15: "identity",
    16: "financial/pension",
    17: "personal",
    18: "employment",
    19: "financial/credit",
    20: "employment",
    21: "other",
}
EXTENSIONS = ["pdf", "jpg", "jpeg", "png"]


def decide(probability: Column | str, threshold: float = SERVICE_THRESHOLD) -> Column:
    """Service rule: reject at or above the threshold."""
    p = col(probability)
    return F.when(p >= threshold, "reject").when(p.isNotNull(), "approve")


def domain_decide(risk_score: Column | str, threshold: float = DOMAIN_THRESHOLD) -> Column:
    """Domain rule: reject only above the threshold."""
    p = col(risk_score)
    return F.when(p > threshold, "rejected").when(p.isNotNull(), "approved")


def debt_to_income(credit: Column | str, income: Column | str) -> Column:
    """Credit over income; +infinity for a zero income."""
    amount, earned = col(credit).cast("double"), col(income).cast("double")
    return F.when(earned == 0, F.lit(float("inf"))).otherwise(F.try_divide(amount, earned))


def trace_ids(key: Column | str) -> tuple[Column, Column]:
    """Deterministic 128-bit trace id and 64-bit span id of a key, in hex."""
    digest = F.sha2(F.concat(F.lit("loan_application:"), col(key).cast("string")), 256)
    return F.substring(digest, 1, 32), F.substring(digest, 33, 16)


def document_path(key: Column | str, document_type: Column | str, document_id: Column | str, extension: Column | str) -> Column:
    """``key/folder/id.ext`` with a safe key; NULL for a blank key, an unknown
    document type or a file type that is not accepted."""
    trimmed = F.regexp_replace(col(key), r"(?U)^\s+|\s+$", "")
    safe = F.regexp_replace(trimmed, r"[^A-Za-z0-9_.:-]", "_")
    ext = F.lower(F.regexp_replace(F.coalesce(col(extension), F.lit("")), r"^\.+", ""))
    folders = F.create_map(*[F.lit(v) for pair in DOCUMENT_FOLDERS.items() for v in pair])
    folder = F.try_element_at(folders, col(document_type).cast("int"))
    return F.when(
        (F.length(trimmed) > 0) & ext.isin(EXTENSIONS),
        F.concat(safe, F.lit("/"), folder, F.lit("/"), col(document_id), F.lit("."), ext),
    )
