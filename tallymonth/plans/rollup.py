"""Totals of several groupings of the report's keys in one pass.

Every transaction is counted into each grouping in the task that reads it, and partial sums
of all groupings share one shuffle. ``level`` is the grouping id, a bit for each key that is
rolled up (the last key is the lowest bit), so a missing key and a subtotal, both null in the
key's column, are told apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymonth.functions import rules
from tallymonth.operators import dimensions
from tallymonth.plans.report import classified, with_merchant_category
from tallymonth.profiles import AS_IMPLEMENTED, RuleProfile
from tallymonth.schemas import GROUP_KEYS


def rolled_up(keys: list[str]) -> list[list[str]]:
    """The groupings of a rollup: all keys, then without the last, down to none."""
    return [keys[:size] for size in range(len(keys), -1, -1)]


def subtotals(
    transactions: DataFrame,
    categories: DataFrame,
    profile: RuleProfile = AS_IMPLEMENTED,
    groupings: list[list[str]] | None = None,
    small_categories: bool = False,
) -> DataFrame:
    """The report keys, ``level``, amount, number and average per group of every grouping.

    ``groupings`` are lists of report keys, by default those of a rollup in the report's order;
    an empty list is the grand total, which an empty table does not have. A grouping given
    twice is given twice in the result. With ``small_categories``, which the caller has
    measured, one shuffle is all.
    """
    keys = list(GROUP_KEYS)
    groupings = rolled_up(keys) if groupings is None else groupings
    unknown = {key for grouping in groupings for key in grouping} - set(keys)
    if unknown or not groupings:
        raise ValueError(f"groupings are lists of {keys}; got {groupings}")
    rows = classified(transactions, profile)
    if small_categories:
        coded = dimensions.with_category_code_broadcast(rows, categories)
    else:
        coded = dimensions.with_category_code_shuffled(rows, categories)
    coded = with_merchant_category(coded, profile).select(*keys, "amount")
    counted = F.count("*") if profile.counts_missing_amounts else F.count("amount")
    grouped = coded.groupingSets([[F.col(k) for k in g] for g in groupings], *keys).agg(
        F.grouping_id(*keys).cast("long").alias("level"),
        F.sum("amount").alias("amount"),
        counted.alias("number"),
    )
    amount, number = F.col("amount"), F.col("number")
    return grouped.select(
        rules.report_date(F.col("date")).alias("date"),
        *keys[1:],
        "level",
        rules.total_amount(amount).alias("amount"),
        number,
        rules.average_amount(amount, number).alias("average_amount"),
    )
