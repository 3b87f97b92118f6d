"""Dealing the rows of frequent keys to several tasks.

A key may hold a large share of all rows. Its rows get a salt, and the rows they are to
meet are repeated once for each salt. Salts must not change when a task runs again, so they
depend on a row's content and on the partition it is in, never on the order of rows:
unequal rows spread by their content, equal ones by their partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# More rows of one key than a task should get; and how many such keys are treated apart, by
# number of rows. A key beyond these holds less than one row in ``MOST_HOT_KEYS``.
HOT_ROWS = 1_000_000
MOST_HOT_KEYS = 10_000

# Rows that meet nothing are dealt to so many groups.
LONERS = 1 << 20


def spread(rows: DataFrame) -> Column:
    """A whole number to take a salt from."""
    hashed = [
        F.col(f"`{field.name}`") for field in rows.schema if not _holds_map(field.dataType)
    ]
    content = F.xxhash64(*hashed) if hashed else F.lit(0)
    return F.shiftright(content, 1) + F.spark_partition_id()


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(field.dataType) for field in kind)
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def most_frequent(
    keyed: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, most: int = MOST_HOT_KEYS
) -> DataFrame:
    """The keys with more than ``hot_rows`` rows and their number, ``most`` of them at most."""
    counted = keyed.groupBy(*keys).agg(F.count("*").alias("hot_n"))
    hot = counted.filter(F.col("hot_n") > hot_rows)
    return hot.orderBy(F.desc("hot_n"), *keys).limit(most)
