"""What differs between two reports.

Both sides are put into one table and grouped, which is a full outer join on keys where null
equals null: one shuffle with partial sums, nothing that a frequent group could slow down,
and rows that occur several times on a side are counted instead of multiplied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymonth.schemas import GROUP_KEYS, TOTAL_AMOUNT

SIDES = ("left", "right")
KEYS = list(GROUP_KEYS)


def _both(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """(side, one struct column a name) of both reports; struct fields cannot clash."""
    sides = []
    for name, rows in zip(SIDES, (left, right), strict=True):
        own = F.struct(*[F.col(f"`{column}`") for column in columns])
        sides.append(rows.select(F.lit(name).alias("side"), own.alias("row")))
    return sides[0].unionByName(sides[1])


def reconciled(left: DataFrame, right: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per group of either report: its keys, both sides' rows, amount and number,
    the differences (right less left), and ``status``.

    A null key is a value like any other. ``left_rows`` and ``right_rows`` say how many
    rows a side has for a group; their amounts and numbers are added up. A side without
    the group, or with null amounts alone, has a null amount, and counts as nothing in the
    difference. Status is ``left only``, ``right only``, ``equal`` or ``differs``; groups
    differ if their rows, amounts or numbers do, and no amount differs from an amount of 0.
    Two empty reports give an empty result.
    """
    keys = keys or KEYS
    both = _both(left, right, [*keys, "amount", "number"])
    of = {name: F.when(F.col("side") == name, 1) for name in SIDES}
    sums = []
    for name in SIDES:
        here = F.col("side") == name
        sums += [
            F.count(of[name]).alias(f"{name}_rows"),
            F.sum(F.when(here, F.col("row.amount"))).cast(TOTAL_AMOUNT).alias(f"{name}_amount"),
            F.coalesce(F.sum(F.when(here, F.col("row.number"))), F.lit(0)).alias(f"{name}_number"),
        ]
    grouped = both.groupBy(F.struct(*[F.col(f"row.`{key}`") for key in keys]).alias("group")).agg(*sums)
    nothing = F.lit(0).cast(TOTAL_AMOUNT)
    amounts = {name: F.coalesce(f"{name}_amount", nothing) for name in SIDES}
    same = (
        F.col("left_amount").eqNullSafe(F.col("right_amount"))
        & (F.col("left_number") == F.col("right_number"))
        & (F.col("left_rows") == F.col("right_rows"))
    )
    status = (
        F.when(F.col("right_rows") == 0, "left only")
        .when(F.col("left_rows") == 0, "right only")
        .when(same, "equal")
        .otherwise("differs")
    )
    return grouped.select(
        "group.*",
        *[f"{name}_{what}" for what in ("rows", "amount", "number") for name in SIDES],
        (amounts["right"] - amounts["left"]).cast(TOTAL_AMOUNT).alias("amount_difference"),
        (F.col("right_number") - F.col("left_number")).alias("number_difference"),
        status.alias("status"),
    )


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows that one report has more often than the other: their columns, ``side`` and how
    many ``times`` more.

    This is EXCEPT ALL in both directions, in one pass. Both must have the same columns.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"reports have other columns: {left.columns} and {right.columns}")
    both = _both(left, right, left.columns)
    more = F.sum(F.when(F.col("side") == SIDES[0], 1).otherwise(-1))
    counted = both.groupBy("row").agg(more.alias("more")).filter("more != 0")
    side = F.when(F.col("more") > 0, SIDES[0]).otherwise(SIDES[1])
    columns = [F.col(f"row.`{name}`").alias(name) for name in left.columns if name not in ("side", "times")]
    return counted.select(*columns, side.alias("side"), F.abs("more").alias("times"))
