"""Batch launcher: read the two files, write one report.

    spark-submit --py-files tallymonth.zip run_report.py \
        --transactions PATH --categories PATH --output PATH
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallymonth.operators.dimensions import duplicate_category_ids, fits_broadcast
from tallymonth.plans.report import as_report, group_totals_as_of, monthly_report
from tallymonth.profiles import AS_IMPLEMENTED, PROFILES, RuleProfile
from tallymonth.schemas import CORRUPT_RECORD
from tallymonth.sinks import files as sinks
from tallymonth.sources.files import (
    read_category_versions,
    read_merchant_categories,
    read_transactions,
    rejected_values,
)


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallymonth", description="Write the monthly report.")
    parser.add_argument("--transactions", required=True, help="CSV of transactions")
    parser.add_argument("--categories", required=True, help="CSV of merchant categories")
    parser.add_argument("--output", required=True, help="directory to write to")
    parser.add_argument("--profile", choices=sorted(PROFILES), default=AS_IMPLEMENTED.name)
    parser.add_argument(
        "--sink",
        choices=["monthly", "partitions", "plain"],
        default="monthly",
        help="one file per month, one directory per month, or one plain CSV directory",
    )
    parser.add_argument(
        "--keep-malformed",
        action="store_true",
        help="go on with malformed records, their unreadable values missing, and count them",
    )
    parser.add_argument(
        "--dated-categories",
        action="store_true",
        help="the categories have a valid_from column; transactions get the code of their day",
    )
    return parser.parse_args(argv)


def dated_report(
    spark: SparkSession, path: str, transactions: DataFrame, profile: RuleProfile, strict: bool
) -> DataFrame:
    """The report by the category codes that were in force on each transaction's day."""
    versions = read_category_versions(spark, path, fail_on_malformed=strict)
    small = fits_broadcast(versions)
    return as_report(group_totals_as_of(transactions, versions, profile, small), profile)


def plain_report(
    spark: SparkSession, path: str, transactions: DataFrame, profile: RuleProfile, strict: bool
) -> DataFrame:
    """The report by one code a category."""
    categories = read_merchant_categories(spark, path, fail_on_malformed=strict)
    if not duplicate_category_ids(categories).isEmpty():
        print("Warning: merchant category ids repeat; their transactions count once per code")
    return monthly_report(transactions, categories, profile, fits_broadcast(categories))


def main(argv: list[str] | None = None) -> int:
    """Run the report and return its record count."""
    options = arguments(argv)
    profile = PROFILES[options.profile]
    # Recording the Python line of every column doubles the time to build a plan.
    spark = (
        SparkSession.builder.appName("Monthly transaction report")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )

    strict = not options.keep_malformed
    transactions = read_transactions(
        spark, options.transactions, keep_corrupt_record=not strict, fail_on_malformed=strict
    )
    malformed = Observation("malformed transactions")
    observed = not strict and not options.dated_categories
    if observed:
        # Counted by the scan that feeds the report; a task that runs again may count twice.
        transactions = transactions.observe(malformed, F.count(CORRUPT_RECORD).alias("records"))
    made = dated_report if options.dated_categories else plain_report
    report = made(spark, options.categories, transactions, profile, strict)
    # Counting the files just written is cheaper than computing the report again.
    if options.sink == "plain":
        sinks.write_plain_csv(report, options.output)
        records = sinks.read_plain_csv(spark, options.output).count()
    elif options.sink == "partitions":
        sinks.write_month_partitions(report, options.output, profile)
        records = sinks.read_monthly_files(spark, options.output).count()
    else:
        names = sinks.write_monthly_files(report, options.output, profile)
        written = [f"{options.output.rstrip('/')}/{name}" for name in names]
        records = sinks.read_monthly_files(spark, written).count() if written else 0
    if not strict:
        # Dated categories may take several scans, so these are counted by one of their own.
        rejected = malformed.get["records"] if observed else rejected_values(transactions).first()["rejected"]
        print(f"Malformed transactions: {rejected}")
    print(f"Reporting records: {records}")
    return records


if __name__ == "__main__":
    main()
