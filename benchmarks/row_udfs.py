"""The same report with its rules as row-at-a-time Python functions.

Only a yardstick for the built-in expressions; nothing else uses it.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymonth import lookups
from tallymonth.operators.dimensions import join_category_code
from tallymonth.queries import fixture
from tallymonth.schemas import GROUP_KEYS

CARD_CODES = {row[:3]: row[3] for row in lookups.CARD_TRANSACTION_TYPES}
BOUNDS, CODES = zip(*lookups.AMOUNT_RANGES, (None, lookups.TOP_AMOUNT_RANGE))


@F.udf("string")
def service(method):
    return lookups.SERVICE_SYSTEM_TYPES.get(method) or ""


@F.udf("string")
def business(service_type, brand):
    is_card = service_type == lookups.CARD_SERVICE
    return (is_card and lookups.MERCHANT_BUSINESS_TYPES.get(brand)) or ""


@F.udf("string")
def card_code(card_type, brand, issuer):
    country = lookups.LOCAL if issuer == lookups.LOCAL_ISSUER else lookups.INTER
    return CARD_CODES.get((card_type, country, brand)) or lookups.UNKNOWN_TRANSACTION_TYPE


@F.udf("string")
def category(service_type, code):
    catch_all = lookups.UNKNOWN_MERCHANT_CATEGORY
    return code or (catch_all if service_type == lookups.CARD_SERVICE else None)


@F.udf("string")
def amount_range(average):
    return None if average is None else CODES[bisect_left(BOUNDS[:-1], average)]


def report_with_row_udfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = join_category_code(
        fixture.transactions(spark, sf_dir), fixture.categories(spark, sf_dir)
    ).withColumn("service_system_type", service("payment_method"))
    keyed = rows.select(
        F.date_format(F.last_day("date"), "yyyy-MM-dd").alias("date"),
        "service_system_type",
        card_code("card_type", "card_brand", "card_country_issuer_code").alias("transaction_type"),
        business("service_system_type", "card_brand").alias("merchant_business_type"),
        category("service_system_type", "code").alias("merchant_category_code"),
        "amount",
    )
    grouped = keyed.groupBy(*GROUP_KEYS).agg(
        F.sum("amount").alias("amount"),
        F.count("amount").alias("number"),
        F.round(F.avg("amount"), 2).alias("average"),
    )
    return grouped.select(
        F.lit(lookups.FI_CODE).alias("fi_code"),
        *GROUP_KEYS,
        "amount",
        "number",
        amount_range("average").alias("terminal_average_amount_range"),
    )
