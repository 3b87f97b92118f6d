"""The registered queries: each operator over the whole derived tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymonth import scratch
from tallymonth.functions import rules
from tallymonth.lookups import card_transaction_types
from tallymonth.operators import dimensions
from tallymonth.operators.totals import totals
from tallymonth.operators.unmatched import unmatched_ids, unused_categories
from tallymonth.plans import compare, customers, fees, rollup, trends
from tallymonth.plans import report as plans
from tallymonth.profiles import AS_IMPLEMENTED, AS_SPECIFIED, RuleProfile
from tallymonth.queries.fixture import (
    categories,
    dated_categories,
    fee_periods,
    large_categories,
    payments,
    rough_categories,
    rough_transactions,
    transactions,
)
from tallymonth.schemas import GROUP_KEYS
from tallymonth.sinks import files as sinks
from tallymonth.sources import files as sources
from tallymonth.sources import nested
from tallymonth.streaming import monthly as streaming

Query = Callable[[SparkSession, str], DataFrame]

ONE_MONTH = datetime.date(1998, 12, 31)


# Scans


def tx_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir)


def mcc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories(spark, sf_dir)


def tx_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.new_directory(spark, "transactions")
    transactions(spark, sf_dir).write.option("header", True).csv(path)
    return sources.read_transactions(spark, path)


def mcc_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.new_directory(spark, "categories")
    categories(spark, sf_dir).write.option("header", True).csv(path)
    return sources.read_merchant_categories(spark, path)


def _rough_transactions(
    spark: SparkSession, sf_dir: str, keep_corrupt_record: bool = False
) -> DataFrame:
    path = scratch.new_directory(spark, "rough-transactions")
    rough_transactions(spark, sf_dir).write.option("header", True).csv(path)
    return sources.read_transactions(spark, path, keep_corrupt_record)


def _rough_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.new_directory(spark, "rough-categories")
    rough_categories(spark, sf_dir).write.option("header", True).csv(path)
    return sources.read_merchant_categories(spark, path)


def rough_tx_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids beyond 32 bits, amounts finer than cents, malformed values as nulls."""
    return _rough_transactions(spark, sf_dir)


def rough_mcc_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rough_categories(spark, sf_dir)


def rejected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.rejected_values(_rough_transactions(spark, sf_dir, keep_corrupt_record=True))


def tx_type_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup's rows with the number of transactions each one matches."""
    keys = ["card_type", "card_brand", "card_country"]
    country = rules.card_country(F.col("card_country_issuer_code"))
    used = (
        transactions(spark, sf_dir)
        .withColumn("card_country", country)
        .groupBy(*keys)
        .agg(F.count("*").alias("used"))
    )
    table = card_transaction_types(spark)
    same = (
        (table["card_type_lkp"] == used["card_type"])
        & (table["card_brand_lkp"] == used["card_brand"])
        & (table["country_lkp"] == used["card_country"])
    )
    return table.join(used, same, "left").select(
        *table.columns, F.coalesce("used", F.lit(0)).alias("transactions")
    )


# Column rules


def fi_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).select(rules.fi_code().alias("fi_code"), "*")


def month_end_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.col("date")
    return transactions(spark, sf_dir).select(
        date.alias("transaction_date"), rules.report_date(rules.month_end(date)).alias("date")
    )


def service_system_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    method = F.col("payment_method")
    return transactions(spark, sf_dir).select(
        method, rules.service_system_type(method).alias("service_system_type")
    )


def merchant_business_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    service_type = rules.service_system_type(F.col("payment_method"))
    return transactions(spark, sf_dir).select(
        service_type.alias("service_system_type"),
        "card_brand",
        rules.merchant_business_type(service_type, F.col("card_brand")).alias(
            "merchant_business_type"
        ),
    )


def card_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    issuer = F.col("card_country_issuer_code")
    return transactions(spark, sf_dir).select(
        issuer, rules.card_country(issuer).alias("card_country")
    )


def backend_transaction_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    backend = F.col("backend_name")
    return transactions(spark, sf_dir).select(
        backend, rules.backend_transaction_type(backend).alias("backend_transaction_type")
    )


# Lookups


def _category_codes(rows: DataFrame) -> DataFrame:
    service_type = rules.service_system_type(F.col("payment_method"))
    return rows.select(
        "merchant_category_id",
        service_type.alias("service_system_type"),
        rules.merchant_category_code(service_type, F.col("code")).alias("merchant_category_code"),
    )


def merchant_category_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = categories(spark, sf_dir)
    rows = dimensions.with_category_code(
        transactions(spark, sf_dir), given, dimensions.fits_broadcast(given)
    )
    return _category_codes(rows)


def merchant_category_code_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken when the categories are too large to broadcast."""
    rows = transactions(spark, sf_dir).select(
        "date", "amount", "payment_method", "merchant_category_id"
    )
    return _category_codes(
        dimensions.with_category_code_shuffled(rows, large_categories(spark, sf_dir))
    )


def merchant_category_code_text_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids met by their value, in whatever form the files hold them."""
    given = _rough_categories(spark, sf_dir)
    rows = dimensions.with_category_code(
        _rough_transactions(spark, sf_dir), given, dimensions.fits_broadcast(given)
    )
    return _category_codes(rows)


def _transaction_type(profile: RuleProfile) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        method, card_type, brand, issuer, backend = (
            F.col(name)
            for name in (
                "payment_method",
                "card_type",
                "card_brand",
                "card_country_issuer_code",
                "backend_name",
            )
        )
        keys = rules.card_lookup_keys(profile, method, card_type, brand, issuer)
        code = F.col("transaction_type_code_lkp")
        return dimensions.with_card_code(transactions(spark, sf_dir), keys).select(
            method,
            card_type,
            brand,
            issuer,
            backend,
            rules.transaction_type(profile, method, backend, code).alias("transaction_type"),
        )

    return query


def mcc_duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.duplicate_category_ids(large_categories(spark, sf_dir))


# Lookups by time


# Few enough for the tables used to hold ids beyond it, at any scale.
FEW_HOT_ROWS = 500


def category_code_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category code in force on each transaction's date, versions broadcast if they fit."""
    versions = dated_categories(spark, sf_dir)
    rows = transactions(spark, sf_dir).select("date", "amount", "merchant_category_id")
    small = dimensions.fits_broadcast(versions)
    return dimensions.with_category_code_as_of(rows, versions, small_versions=small)


def category_code_as_of_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken with too many versions to broadcast, and ids that are cut by time."""
    rows = transactions(spark, sf_dir).select("date", "amount", "merchant_category_id")
    return dimensions.with_category_code_as_of(
        rows, dated_categories(spark, sf_dir), hot_rows=FEW_HOT_ROWS
    )


def report_with_dated_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report with the codes that were in force on each transaction's date."""
    grouped = plans.group_totals_as_of(
        transactions(spark, sf_dir), dated_categories(spark, sf_dir), AS_SPECIFIED
    )
    return plans.as_report(grouped, AS_SPECIFIED)


def _fees(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    rows = transactions(spark, sf_dir).select("date", "amount", "merchant_category_id")
    return dimensions.with_fee_periods(rows, fee_periods(spark, sf_dir), **options)


def fee_period_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction with every fee period of its category that holds its date."""
    small = dimensions.fits_broadcast(fee_periods(spark, sf_dir), columns=("id", "fee_code"))
    return _fees(spark, sf_dir, small_periods=small)


def fee_period_join_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken with too many periods to broadcast, and bins that are dealt out."""
    return _fees(spark, sf_dir, hot_rows=FEW_HOT_ROWS)


def fee_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fees per month and fee code, each fee rounded to cents."""
    periods = fee_periods(spark, sf_dir)
    small = dimensions.fits_broadcast(periods, columns=("id", "fee_code"))
    rows = transactions(spark, sf_dir).select("date", "amount", "merchant_category_id")
    grouped = fees.fee_totals(rows, periods, small_periods=small)
    return grouped.select(
        rules.report_date(F.col("month")).alias("date"),
        "fee_code",
        F.col("fees").cast("decimal(34,2)").alias("fees"),
        "records",
    )


# Totals


def monthly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions(spark, sf_dir).select(
        rules.month_end(F.col("date")).alias("month"),
        rules.service_system_type(F.col("payment_method")).alias("service_system_type"),
        "amount",
    )
    return totals(rows, ["month", "service_system_type"], AS_IMPLEMENTED).select(
        rules.report_date(F.col("month")).alias("date"),
        "service_system_type",
        rules.total_amount(F.col("amount")).alias("amount"),
        "number",
    )


def _group_totals(profile: RuleProfile) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        amount, number = F.col("amount"), F.col("number")
        given = categories(spark, sf_dir)
        small = dimensions.fits_broadcast(given)
        grouped = plans.group_totals(transactions(spark, sf_dir), given, profile, small)
        return grouped.select(
            rules.report_date(F.col("date")).alias("date"),
            *GROUP_KEYS[1:],
            rules.total_amount(amount).alias("amount"),
            number,
            rules.average_amount(amount, number).alias("average_amount"),
        )

    return query


def _amount_range(profile: RuleProfile) -> Query:
    """Range per month and category id: the rule without the category lookup."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = transactions(spark, sf_dir).select(
            rules.month_end(F.col("date")).alias("month"), "merchant_category_id", "amount"
        )
        amount, number = F.col("amount"), F.col("number")
        return totals(rows, ["month", "merchant_category_id"], profile).select(
            rules.report_date(F.col("month")).alias("date"),
            "merchant_category_id",
            rules.total_amount(amount).alias("amount"),
            number,
            rules.terminal_average_amount_range(profile, amount, number).alias(
                "terminal_average_amount_range"
            ),
        )

    return query


# Report


def _report(profile: RuleProfile) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        given = categories(spark, sf_dir)
        small = dimensions.fits_broadcast(given)
        return plans.monthly_report(transactions(spark, sf_dir), given, profile, small)

    return query


report_as_implemented = _report(AS_IMPLEMENTED)
report_as_specified = _report(AS_SPECIFIED)


def report_with_large_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as it is planned when the categories are too large to broadcast."""
    return plans.monthly_report(
        transactions(spark, sf_dir),
        large_categories(spark, sf_dir),
        AS_SPECIFIED,
        small_categories=False,
    )


def report_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.report_months(transactions(spark, sf_dir))


def report_for_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = categories(spark, sf_dir)
    small = dimensions.fits_broadcast(given)
    return plans.report_for_month(
        transactions(spark, sf_dir), given, ONE_MONTH, small_categories=small
    )


def report_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.report_file_names(transactions(spark, sf_dir))


def report_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.record_count(report_as_implemented(spark, sf_dir))


def input_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.input_counts(transactions(spark, sf_dir), categories(spark, sf_dir))


def tx_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.preview(transactions(spark, sf_dir))


def mcc_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.preview(categories(spark, sf_dir))


# Nested payments


def _stored_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.new_directory(spark, "payments")
    nested.write_payments(payments(spark, sf_dir), path)
    return nested.read_payments(spark, path)


def nested_payment_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of payments written as JSON lines and read back; their numbers left out, as
    line numbers repeat in the given tables."""
    return nested.payment_items(_stored_payments(spark, sf_dir)).drop("item")


def nested_rejected_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.rejected_items(_stored_payments(spark, sf_dir)).drop("item")


# Stream


FILES, FILES_A_BATCH = 6, 2


def report_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly files as a stream of transaction files leaves them, three batches later.

    Every file holds transactions of all months, so each batch corrects all of them.
    """
    inputs, state, output, checkpoint = (
        scratch.new_directory(spark, f"stream-{name}")
        for name in ("transactions", "state", "report", "checkpoint")
    )
    rows = transactions(spark, sf_dir)
    rows.repartition(FILES).write.option("header", True).csv(inputs)
    sink = streaming.MonthlyReportSink(categories(spark, sf_dir), output, state, compact_every=2)
    stream = streaming.read_transaction_stream(spark, inputs, FILES_A_BATCH)
    streaming.start_monthly_report(stream, sink, checkpoint, once=True).awaitTermination()
    return sinks.read_monthly_files(spark, output)


# Comparisons, subtotals and trends


def report_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the two rule profiles make different, group by group."""
    return compare.reconciled(
        report_as_implemented(spark, sf_dir), report_as_specified(spark, sf_dir)
    )


def report_row_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.row_differences(
        report_as_implemented(spark, sf_dir), report_as_specified(spark, sf_dir)
    )


def report_subtotals(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = categories(spark, sf_dir)
    small = dimensions.fits_broadcast(given)
    return rollup.subtotals(
        transactions(spark, sf_dir), given, AS_SPECIFIED, small_categories=small
    )


def trailing_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve-month totals of each category id and payment method."""
    keys = {name: F.col(name) for name in ("merchant_category_id", "payment_method")}
    return trends.trailing_totals(transactions(spark, sf_dir), keys)


def top_categories_of_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"merchant_category_id": F.col("merchant_category_id")}
    return trends.top_of_month(transactions(spark, sf_dir), keys)


# Customers


def _by_service_type() -> dict[str, Column]:
    return {"service_system_type": rules.service_system_type(F.col("payment_method"))}


def customers_of_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions(spark, sf_dir, "o_custkey")
    return customers.customers_exactly(rows, _by_service_type(), "o_custkey")


def customers_of_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions(spark, sf_dir, "o_custkey")
    return customers.customers_exactly(rows, _by_service_type(), "o_custkey", quarters=True)


def customers_of_quarter_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact number of customers, whether the estimate from monthly sketches is within its
    stated error, and whether the sketch is within its stated size."""
    rows = transactions(spark, sf_dir, "o_custkey")
    path = scratch.new_directory(spark, "sketches")
    customers.customer_sketches(rows, _by_service_type(), "o_custkey").write.parquet(path)
    names = list(_by_service_type())
    quarters = customers.merged_by_quarter(spark.read.parquet(path), names)
    estimates = customers.estimated(quarters, names).withColumnRenamed("customers", "estimate")
    sizes = quarters.select(
        rules.report_date(F.col("month")).alias("date"),
        *names,
        (F.octet_length("sketch") <= customers.MOST_SKETCH_BYTES).alias("bounded"),
    )
    exact = customers.customers_exactly(rows, _by_service_type(), "o_custkey", quarters=True)
    keys = ["date", *names]
    off = F.abs(F.col("estimate") - F.col("customers"))
    close = off <= F.col("customers") * customers.relative_error()
    return exact.join(estimates, keys).join(sizes, keys).select(
        *keys, "customers", close.alias("close"), "bounded"
    )


# Ids without a match


def unmatched_category_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = categories(spark, sf_dir)
    rows = transactions(spark, sf_dir)
    found = unmatched_ids(rows, given, dimensions.category_keys(rows, given))
    return found.withColumn("amount", rules.total_amount(F.col("amount")))


def unused_merchant_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = large_categories(spark, sf_dir)
    rows = transactions(spark, sf_dir)
    return unused_categories(rows, given, dimensions.category_keys(rows, given))


# Sinks


def _csv_roundtrip(profile: RuleProfile) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch.new_directory(spark, "report")
        sinks.write_monthly_files(_report(profile)(spark, sf_dir), path, profile)
        return sinks.read_monthly_files(spark, path)

    return query


def report_csv_plain_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.new_directory(spark, "report-plain")
    sinks.write_plain_csv(report_as_implemented(spark, sf_dir), path)
    # An empty string comes back as it was written; null and empty print alike
    # in the monthly files, so both round trips are compared without it.
    back = sinks.read_plain_csv(spark, path)
    texts = [name for name, kind in back.dtypes if kind == "string"]
    return back.withColumns({name: F.nullif(F.col(name), F.lit("")) for name in texts})


QUERIES: dict[str, Query] = {
    "tx_scan": tx_scan,
    "mcc_scan": mcc_scan,
    "tx_csv_scan": tx_csv_scan,
    "mcc_csv_scan": mcc_csv_scan,
    "rough_tx_csv_scan": rough_tx_csv_scan,
    "rough_mcc_csv_scan": rough_mcc_csv_scan,
    "rejected_values": rejected_values,
    "tx_type_lookup": tx_type_lookup,
    "fi_code": fi_code,
    "month_end_date": month_end_date,
    "service_system_type": service_system_type,
    "merchant_business_type": merchant_business_type,
    "card_country": card_country,
    "backend_transaction_type": backend_transaction_type,
    "merchant_category_code": merchant_category_code,
    "merchant_category_code_shuffled": merchant_category_code_shuffled,
    "merchant_category_code_text_ids": merchant_category_code_text_ids,
    "transaction_type": _transaction_type(AS_IMPLEMENTED),
    "transaction_type_as_specified": _transaction_type(AS_SPECIFIED),
    "mcc_duplicate_ids": mcc_duplicate_ids,
    "category_code_as_of": category_code_as_of,
    "category_code_as_of_sorted": category_code_as_of_sorted,
    "report_with_dated_categories": report_with_dated_categories,
    "fee_period_join": fee_period_join,
    "fee_period_join_shuffled": fee_period_join_shuffled,
    "fee_totals": fee_totals,
    "monthly_totals": monthly_totals,
    "group_totals": _group_totals(AS_IMPLEMENTED),
    "group_totals_as_specified": _group_totals(AS_SPECIFIED),
    "terminal_average_amount_range": _amount_range(AS_IMPLEMENTED),
    "terminal_average_amount_range_as_specified": _amount_range(AS_SPECIFIED),
    "report_as_implemented": report_as_implemented,
    "report_as_specified": report_as_specified,
    "report_with_large_categories": report_with_large_categories,
    "report_months": report_months,
    "report_for_month": report_for_month,
    "report_file_names": report_file_names,
    "report_record_count": report_record_count,
    "input_counts": input_counts,
    "tx_preview": tx_preview,
    "mcc_preview": mcc_preview,
    "report_csv_roundtrip": _csv_roundtrip(AS_IMPLEMENTED),
    "report_csv_roundtrip_as_specified": _csv_roundtrip(AS_SPECIFIED),
    "report_csv_plain_roundtrip": report_csv_plain_roundtrip,
    "report_streamed": report_streamed,
    "report_reconciliation": report_reconciliation,
    "report_row_differences": report_row_differences,
    "report_subtotals": report_subtotals,
    "trailing_year": trailing_year,
    "top_categories_of_month": top_categories_of_month,
    "customers_of_month": customers_of_month,
    "customers_of_quarter": customers_of_quarter,
    "customers_of_quarter_from_sketches": customers_of_quarter_from_sketches,
    "unmatched_category_ids": unmatched_category_ids,
    "unused_merchant_categories": unused_merchant_categories,
    "nested_payment_items": nested_payment_items,
    "nested_rejected_items": nested_rejected_items,
}
