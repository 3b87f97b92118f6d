"""Explicit schemas of the inputs and of the report.

Nothing is inferred: inference costs a full extra read of the files, loses the
leading zeros of category codes and turns a whole money column into text when a
single value is malformed.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Wide and fine enough to take what a file holds; only sums are rounded, to cents.
AMOUNT = T.DecimalType(28, 6)

# Spark sums decimal(28,6) into decimal(38,6); the report keeps its whole digits, so a
# total that can be summed can also be written.
TOTAL_AMOUNT = T.DecimalType(34, 2)

CORRUPT_RECORD = "_corrupt_record"

TRANSACTIONS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("amount", AMOUNT),
        T.StructField("payment_method", T.StringType()),
        T.StructField("card_type", T.StringType()),
        T.StructField("card_brand", T.StringType()),
        T.StructField("card_country_issuer_code", T.StringType()),
        T.StructField("backend_name", T.StringType()),
        T.StructField("merchant_category_id", T.StringType()),
    ]
)

MERCHANT_CATEGORIES = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("code", T.StringType()),
    ]
)

# A version of a category holds from its start until the next one of its id starts.
CATEGORY_VERSIONS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("valid_from", T.DateType()),
    ]
)

# A fee holds for a category's transactions from ``starts`` until the day before ``ends``.
FEE_PERIODS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("fee_code", T.StringType()),
        T.StructField("rate", T.DecimalType(6, 4)),
        T.StructField("starts", T.DateType()),
        T.StructField("ends", T.DateType()),
    ]
)

GROUP_KEYS = [
    "date",
    "service_system_type",
    "transaction_type",
    "merchant_business_type",
    "merchant_category_code",
]

# The group keys that are known before the category is looked up.
ID_KEYS = [key for key in GROUP_KEYS if key != "merchant_category_code"]

REPORT = T.StructType(
    [
        T.StructField("fi_code", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("service_system_type", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("merchant_business_type", T.StringType()),
        T.StructField("merchant_category_code", T.StringType()),
        T.StructField("amount", TOTAL_AMOUNT),
        T.StructField("number", T.LongType()),
        T.StructField("terminal_average_amount_range", T.StringType()),
    ]
)
