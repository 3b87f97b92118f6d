"""Launcher of the streamed report: keep the monthly files of a directory of transactions.

    spark-submit --py-files tallymonth.zip run_stream.py \
        --transactions DIR --categories PATH --output DIR --state DIR --checkpoint DIR
"""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import SparkSession

from tallymonth.profiles import AS_IMPLEMENTED, PROFILES
from tallymonth.sources.files import read_merchant_categories
from tallymonth.streaming.monthly import (
    MonthlyReportSink,
    read_transaction_stream,
    start_monthly_report,
)


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(
        prog="tallymonth.streaming", description="Keep the monthly report of a stream of files."
    )
    parser.add_argument("--transactions", required=True, help="directory of CSV files")
    parser.add_argument("--categories", required=True, help="CSV of merchant categories")
    parser.add_argument("--output", required=True, help="directory of the monthly files")
    parser.add_argument("--state", required=True, help="directory of the totals so far")
    parser.add_argument("--checkpoint", required=True, help="directory of what has been read")
    parser.add_argument("--profile", choices=sorted(PROFILES), default=AS_IMPLEMENTED.name)
    parser.add_argument("--lateness-days", type=int, default=31, help="until a month is closed")
    parser.add_argument("--files-a-batch", type=int, help="most files of one batch")
    parser.add_argument("--once", action="store_true", help="end when all files are taken")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    """Run the stream and return how many rows for closed months it has noted in all."""
    options = arguments(argv)
    spark = SparkSession.builder.appName("Streamed transaction report").getOrCreate()
    sink = MonthlyReportSink(
        read_merchant_categories(spark, options.categories),
        options.output,
        options.state,
        PROFILES[options.profile],
        datetime.timedelta(days=options.lateness_days),
    )
    stream = read_transaction_stream(spark, options.transactions, options.files_a_batch)
    start_monthly_report(stream, sink, options.checkpoint, options.once).awaitTermination()
    corrections = sink.corrections(spark).agg({"records": "sum"}).first()[0] or 0
    print(f"Records for closed months: {corrections}")
    return corrections


if __name__ == "__main__":
    main()
