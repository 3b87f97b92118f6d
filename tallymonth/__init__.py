"""Monthly card-transaction reports on Spark."""

from tallymonth.operators.asof import as_of
from tallymonth.operators.dimensions import (
    fits_broadcast,
    with_category_code_as_of,
    with_fee_periods,
)
from tallymonth.operators.intervals import interval_join
from tallymonth.operators.unmatched import not_among, unmatched_ids, unused_categories, without_match
from tallymonth.plans.compare import reconciled, row_differences
from tallymonth.plans.customers import (
    customer_sketches,
    customers_exactly,
    estimated,
    merged_by_quarter,
)
from tallymonth.plans.report import (
    as_report,
    group_totals,
    group_totals_as_of,
    input_counts,
    monthly_report,
    preview,
    record_count,
    report_file_names,
    report_for_month,
    report_months,
)
from tallymonth.plans.rollup import subtotals
from tallymonth.plans.trends import top_of_month, trailing_totals
from tallymonth.profiles import AS_IMPLEMENTED, AS_SPECIFIED, PROFILES, RuleProfile
from tallymonth.sinks.files import (
    read_monthly_files,
    read_plain_csv,
    write_month_partitions,
    write_monthly_files,
    write_plain_csv,
)
from tallymonth.sources.files import (
    conformed,
    read_category_versions,
    read_fee_periods,
    read_merchant_categories,
    read_transactions,
)
from tallymonth.sources.nested import (
    payment_items,
    payment_transactions,
    read_payments,
    rejected_items,
    write_payments,
)
from tallymonth.streaming.monthly import (
    MonthlyReportSink,
    read_transaction_stream,
    start_monthly_report,
)

__all__ = [
    "AS_IMPLEMENTED",
    "AS_SPECIFIED",
    "PROFILES",
    "MonthlyReportSink",
    "RuleProfile",
    "as_of",
    "as_report",
    "conformed",
    "customer_sketches",
    "customers_exactly",
    "estimated",
    "fits_broadcast",
    "group_totals",
    "group_totals_as_of",
    "input_counts",
    "interval_join",
    "merged_by_quarter",
    "monthly_report",
    "not_among",
    "payment_items",
    "payment_transactions",
    "preview",
    "read_category_versions",
    "read_fee_periods",
    "read_merchant_categories",
    "read_monthly_files",
    "read_payments",
    "read_plain_csv",
    "read_transaction_stream",
    "read_transactions",
    "reconciled",
    "record_count",
    "rejected_items",
    "report_file_names",
    "report_for_month",
    "report_months",
    "row_differences",
    "start_monthly_report",
    "subtotals",
    "top_of_month",
    "trailing_totals",
    "unmatched_ids",
    "unused_categories",
    "with_category_code_as_of",
    "with_fee_periods",
    "without_match",
    "write_month_partitions",
    "write_monthly_files",
    "write_payments",
    "write_plain_csv",
]
