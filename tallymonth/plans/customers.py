"""Distinct customers per month and group, exactly and by sketches that can be merged.

The exact form keeps each (month, group, customer) once and counts; a frequent group is
spread by its customers. The sketches are bounded by ``2^LG_K`` registers each, however many
customers they have seen: stored once a month, they give any span of months without
reading transactions again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymonth.functions import rules

# Registers of a sketch, as a power of two. Its relative standard error is 1.04 / sqrt(2^LG_K);
# an estimate is taken to be within ``DEVIATIONS`` of these.
LG_K = 12
DEVIATIONS = 4
MOST_SKETCH_BYTES = (1 << LG_K) * 5 // 4 + 128


def relative_error(lg_k: int = LG_K) -> float:
    """The bound on an estimate's relative error."""
    return DEVIATIONS * 1.04 / 2 ** (lg_k / 2)


def _rows(transactions: DataFrame, keys: dict[str, Column], customer: str) -> DataFrame:
    return transactions.filter("date is not null").select(
        rules.month_end(F.col("date")).alias("month"),
        *[column.alias(name) for name, column in keys.items()],
        F.col(f"`{customer}`").cast("string").alias("counted"),
    )


def customers_exactly(
    transactions: DataFrame, keys: dict[str, Column], customer: str, quarters: bool = False
) -> DataFrame:
    """date, the keys and ``customers``: how many different ones there are in each month, or
    in each quarter, named by its last day.

    Missing customers are not counted, so a group may have 0. Dates that are missing leave a
    transaction out. A null key is a key of its own.
    """
    rows = _rows(transactions, keys, customer)
    if quarters:
        rows = rows.withColumn("month", _quarter_end(F.col("month")))
    names = list(keys)
    once = rows.groupBy("month", *names, "counted").agg(F.lit(1).alias("one"))
    grouped = once.groupBy("month", *names).agg(F.count("counted").alias("customers"))
    return grouped.select(rules.report_date(F.col("month")).alias("date"), *names, "customers")


def customer_sketches(
    transactions: DataFrame, keys: dict[str, Column], customer: str, lg_k: int = LG_K
) -> DataFrame:
    """month (its last day), the keys and ``sketch``: what to store for each month.

    A group without any customer has an empty sketch.
    """
    rows = _rows(transactions, keys, customer)
    return rows.groupBy("month", *keys).agg(F.hll_sketch_agg("counted", F.lit(lg_k)).alias("sketch"))


def _quarter_end(month: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(month, "quarter"), 2))


def merged_by_quarter(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """month (the quarter's last day), the keys and ``sketch`` of monthly sketches."""
    named = sketches.withColumn("month", _quarter_end(F.col("month")))
    return named.groupBy("month", *keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """date, the keys and ``customers`` as the sketches have it."""
    return sketches.select(
        rules.report_date(F.col("month")).alias("date"),
        *keys,
        F.hll_sketch_estimate("sketch").alias("customers"),
    )
