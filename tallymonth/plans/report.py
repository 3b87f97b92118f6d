"""The monthly report."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymonth.functions import rules
from tallymonth.operators import dimensions
from tallymonth.operators.spread import HOT_ROWS
from tallymonth.operators.totals import merged_totals, totals
from tallymonth.profiles import AS_IMPLEMENTED, RuleProfile
from tallymonth.schemas import GROUP_KEYS, ID_KEYS, REPORT


def classified(
    transactions: DataFrame, profile: RuleProfile, also: dict[str, Column] | None = None
) -> DataFrame:
    """Everything a transaction's group depends on, except its category code; and the
    columns of the transactions that ``also`` names.

    ``date`` stays a date until after the aggregation: four bytes in the key
    instead of ten characters, and one formatting per group, not per row.
    """
    keys = rules.card_lookup_keys(
        profile,
        F.col("payment_method"),
        F.col("card_type"),
        F.col("card_brand"),
        F.col("card_country_issuer_code"),
    )
    service_type = rules.service_system_type(F.col("payment_method"))
    return dimensions.with_card_code(transactions, keys).select(
        rules.month_end(F.col("date")).alias("date"),
        service_type.alias("service_system_type"),
        rules.transaction_type(
            profile,
            F.col("payment_method"),
            F.col("backend_name"),
            F.col("transaction_type_code_lkp"),
        ).alias("transaction_type"),
        rules.merchant_business_type(service_type, F.col("card_brand")).alias(
            "merchant_business_type"
        ),
        "merchant_category_id",
        "amount",
        *[column.alias(name) for name, column in (also or {}).items()],
    )


def with_merchant_category(rows: DataFrame, profile: RuleProfile) -> DataFrame:
    code = rules.merchant_category_code(
        F.col("service_system_type"), F.col("code"), profile.blank_category_code_is_missing
    )
    return rows.withColumn("merchant_category_code", code)


def group_totals(
    transactions: DataFrame,
    categories: DataFrame,
    profile: RuleProfile = AS_IMPLEMENTED,
    small_categories: bool = False,
) -> DataFrame:
    """Sum and count per report group; ``date`` is the month end as a date.

    With ``small_categories``, which the caller has measured to fit a broadcast
    (``fits_broadcast``), lookups and partial sums run in the stage that reads the
    transactions and one shuffle finishes them.

    Otherwise the transactions are summed per category id first. The join with
    the large side then moves sums instead of transactions, and a hot category
    is one row per group in it. Sums and counts are exact, so both ways give the
    same result, repeated category ids included.
    """
    rows = classified(transactions, profile)
    if small_categories:
        coded = dimensions.with_category_code_broadcast(rows, categories)
        return totals(with_merchant_category(coded, profile), GROUP_KEYS, profile)

    parts = totals(rows, [*ID_KEYS, "merchant_category_id"], profile)
    coded = dimensions.join_category_code(parts, categories.hint("merge"))
    return merged_totals(with_merchant_category(coded, profile), GROUP_KEYS)


def group_totals_as_of(
    transactions: DataFrame,
    versions: DataFrame,
    profile: RuleProfile = AS_IMPLEMENTED,
    small_versions: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``group_totals`` with the category codes that were in force on each day.

    ``versions`` has id, code and valid_from; see :func:`dimensions.with_category_code_as_of`.
    The transactions are summed per category id and day first, so that the as-of
    join moves sums.
    """
    rows = classified(transactions, profile, {"day": F.col("date")})
    parts = totals(rows, [*ID_KEYS, "merchant_category_id", "day"], profile)
    coded = dimensions.with_category_code_as_of(parts, versions, "day", small_versions, hot_rows)
    return merged_totals(with_merchant_category(coded, profile), GROUP_KEYS)


def monthly_report(
    transactions: DataFrame,
    categories: DataFrame,
    profile: RuleProfile = AS_IMPLEMENTED,
    small_categories: bool = False,
) -> DataFrame:
    """The nine report columns, one row per group. Planning it runs no job."""
    return as_report(group_totals(transactions, categories, profile, small_categories), profile)


def as_report(grouped: DataFrame, profile: RuleProfile) -> DataFrame:
    """The report columns of group totals."""
    return grouped.select(
        rules.fi_code().alias("fi_code"),
        rules.report_date(F.col("date")).alias("date"),
        "service_system_type",
        "transaction_type",
        "merchant_business_type",
        "merchant_category_code",
        rules.total_amount(F.col("amount")).alias("amount"),
        "number",
        rules.terminal_average_amount_range(profile, F.col("amount"), F.col("number")).alias(
            "terminal_average_amount_range"
        ),
    ).select(*REPORT.fieldNames())


def of_month(transactions: DataFrame, month_end: datetime.date) -> DataFrame:
    """Transactions of one report month.

    A plain range on ``date``, so a source can skip files or row groups by it.
    """
    first = month_end.replace(day=1)
    return transactions.filter(F.col("date").between(F.lit(first), F.last_day(F.lit(first))))


def report_for_month(
    transactions: DataFrame,
    categories: DataFrame,
    month_end: datetime.date,
    profile: RuleProfile = AS_IMPLEMENTED,
    small_categories: bool = False,
) -> DataFrame:
    """The report's rows of one month, computed from that month's input only."""
    rows = of_month(transactions, month_end)
    return monthly_report(rows, categories, profile, small_categories)


def report_months(transactions: DataFrame) -> DataFrame:
    """Distinct report dates.

    Every transaction lands in some group, so the input's months are the
    report's months and neither lookups nor totals are needed.
    """
    months = transactions.select(rules.month_end(F.col("date")).alias("month")).distinct()
    return months.select(rules.report_date(F.col("month")).alias("date"))


def report_file_names(transactions: DataFrame) -> DataFrame:
    """The file each report date is written to."""
    months = transactions.select(rules.month_end(F.col("date")).alias("month")).distinct()
    return months.select(
        rules.report_date(F.col("month")).alias("date"),
        rules.report_file_name(F.col("month")).alias("file_name"),
    )


def record_count(report: DataFrame) -> DataFrame:
    return report.agg(F.count("*").alias("reporting_records"))


def input_counts(transactions: DataFrame, categories: DataFrame) -> DataFrame:
    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(F.count("*").alias("records")).select(
            F.lit(name).alias("input"), "records"
        )

    return counted(transactions, "transactions").union(
        counted(categories, "merchant_categories")
    )


def preview(rows: DataFrame, records: int = 5) -> DataFrame:
    """The first few rows in column order, nulls first; the same ones every time."""
    return rows.orderBy(*rows.columns).limit(records)
