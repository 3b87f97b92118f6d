"""Totals over trailing months, and the strongest categories of each month.

Both look at monthly totals, which are few, never at transactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallymonth.functions import rules

def _month_number(month_end: Column) -> Column:
    return F.year(month_end) * 12 + F.month(month_end) - 1


def _month_end(number: Column) -> Column:
    first = F.make_date(F.floor(number / 12).cast("int"), (number % 12 + 1).cast("int"), F.lit(1))
    return F.last_day(first)


def monthly_amounts(transactions: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """(the keys, month as a number, amount, number): sums per month and key.

    Transactions without a date belong to no month and are left out.
    """
    rows = transactions.filter("date is not null").select(
        *[column.alias(name) for name, column in keys.items()],
        _month_number(F.col("date")).alias("month_number"),
        F.col("amount").alias("tx_amount"),
    )
    return rows.groupBy(*keys, "month_number").agg(
        F.sum("tx_amount").alias("amount"), F.count("*").alias("number")
    )


def trailing_totals(
    transactions: DataFrame, keys: dict[str, Column], months: int = 12
) -> DataFrame:
    """date, the keys, amount and number of the month, and of the ``months`` months up to it.

    Every key has a row for each month from its first one until its last one has left the
    trailing range; months without transactions have 0, and so have months whose amounts
    are all missing. A null key is a key of its own. The missing months are made from each
    key's first and last month, not from a calendar of all keys.
    """
    if months < 1:
        raise ValueError("a trailing range has at least one month")
    names = list(keys)
    totals = monthly_amounts(transactions, keys)
    bounds = totals.groupBy(*names).agg(
        F.min("month_number").alias("first"), F.max("month_number").alias("last")
    )
    every = bounds.select(
        *names, F.explode(F.sequence(F.col("first"), F.col("last") + (months - 1))).alias("month_number")
    )
    # Added to the totals as rows of zero and summed: no join, and null keys need no care.
    kind = totals.schema["amount"].dataType
    zero = every.select(
        *names, "month_number", F.lit(0).cast(kind).alias("amount"), F.lit(0).cast("long").alias("number")
    )
    filled = totals.unionByName(zero).groupBy(*names, "month_number").agg(
        F.sum("amount").cast(kind).alias("amount"), F.sum("number").alias("number")
    )
    trailing = (
        Window.partitionBy(*names).orderBy("month_number").rangeBetween(-(months - 1), Window.currentRow)
    )
    return filled.select(
        rules.report_date(_month_end(F.col("month_number"))).alias("date"),
        *names,
        rules.total_amount(F.col("amount")).alias("amount"),
        "number",
        rules.total_amount(F.sum("amount").over(trailing)).alias("trailing_amount"),
        F.sum("number").over(trailing).alias("trailing_number"),
    )


def top_of_month(
    transactions: DataFrame, keys: dict[str, Column], places: int = 3
) -> DataFrame:
    """date, the keys, amount, number and ``place`` of the keys with the largest amounts of
    each month.

    Keys with equal amounts share a place and all of them are kept, so there may be more
    than ``places`` rows a month; the next place counts them all. Keys without any amount come
    last. Each task keeps its own best rows before the totals are shuffled to be ranked.
    """
    names = list(keys)
    order = Window.partitionBy("month_number").orderBy(F.col("amount").desc_nulls_last())
    ranked = monthly_amounts(transactions, keys).withColumn("place", F.rank().over(order))
    return ranked.filter(F.col("place") <= places).select(
        rules.report_date(_month_end(F.col("month_number"))).alias("date"),
        *names,
        rules.total_amount(F.col("amount")).alias("amount"),
        "number",
        "place",
    )
