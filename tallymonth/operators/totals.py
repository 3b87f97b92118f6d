"""Totals per group of transactions.

Every total is a sum or a count, so it is combined on the map side: however many
rows a group holds, each task ships at most one row for it. Amounts are decimals,
so a sum is exact and does not depend on the order of its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymonth.profiles import RuleProfile


def totals(rows: DataFrame, keys: list[str], profile: RuleProfile) -> DataFrame:
    """``amount`` and ``number`` per group of transactions."""
    counted = F.count("*") if profile.counts_missing_amounts else F.count("amount")
    return rows.groupBy(*keys).agg(
        F.sum("amount").alias("amount"), counted.alias("number")
    )


def merged_totals(parts: DataFrame, keys: list[str]) -> DataFrame:
    """``amount`` and ``number`` per coarser group, from totals of finer ones."""
    return parts.groupBy(*keys).agg(
        F.sum("amount").alias("amount"), F.sum("number").alias("number")
    )
