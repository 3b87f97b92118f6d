"""Lookup tables of the report rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- Fixed values: prescribed by the report's rules, must not be changed. -----

FI_CODE = "42"

LOCAL_ISSUER = "A029"
LOCAL = "Local"
INTER = "Inter"

CARD_METHOD = "payment01"
CARD_SERVICE = "CPF"

SERVICE_SYSTEM_TYPES = {
    "payment01": "CPF",
    "payment02": "OTH",
    "payment03": "OTH",
    "payment04": "OTH",
}

MERCHANT_BUSINESS_TYPES = {
    "brand01": "30101",
    "brand02": "30102",
    "brand03": "30103",
    "brand04": "30104",
}

BACKEND_TRANSACTION_TYPES = {
    "b03": "000004",
    "b04": "000004",
    "b05": "000004",
    "b06": "000004",
    "b12": "000001",
    "b14": "000002",
    "b15": "000003",
}

# (card type, country, card brand, transaction type code)
CARD_TRANSACTION_TYPES = [
    ("type01", "Local", "brand01", "010001"),
    ("type01", "Local", "brand02", "010002"),
    ("type01", "Local", "brand03", "010003"),
    ("type01", "Local", "other", "010004"),
    ("type01", "Inter", "brand01", "010011"),
    ("type01", "Inter", "brand02", "010012"),
    ("type01", "Inter", "brand03", "010013"),
    ("type01", "Inter", "other", "010014"),
    ("type02", "Local", "brand01", "010021"),
    ("type02", "Local", "brand02", "010022"),
    ("type02", "Local", "brand03", "010023"),
    ("type02", "Local", "other", "010024"),
    ("type02", "Inter", "brand01", "010031"),
    ("type02", "Inter", "brand02", "010032"),
    ("type02", "Inter", "brand03", "010033"),
    ("type02", "Inter", "other", "010034"),
]
OTHER_BRAND = "other"
UNKNOWN_TRANSACTION_TYPE = "099999"

UNKNOWN_MERCHANT_CATEGORY = "9999"

# (inclusive upper bound of the average amount, range code), then the open range
AMOUNT_RANGES = [
    (500, "94560000001"),
    (1000, "94560000002"),
    (2000, "94560000003"),
    (5000, "94560000004"),
    (10000, "94560000005"),
    (30000, "94560000006"),
]
TOP_AMOUNT_RANGE = "94560000007"

REPORT_FILE_PREFIX = "ACME_"

# --- End of fixed values. -----------------------------------------------------

LISTED_BRANDS = sorted({brand for _, _, brand, _ in CARD_TRANSACTION_TYPES} - {OTHER_BRAND})


def card_transaction_types(spark: SparkSession) -> DataFrame:
    """The card transaction types as a 16-row relation of non-null strings.

    A ``VALUES`` relation carries its true size, so the planner knows at plan
    time that it is tiny.
    """
    rows = ", ".join(str(row) for row in CARD_TRANSACTION_TYPES)
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS card_transaction_types"
        "(card_type_lkp, country_lkp, card_brand_lkp, transaction_type_code_lkp)"
    )
