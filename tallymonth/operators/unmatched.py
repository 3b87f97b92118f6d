"""Which category ids of the transactions have no category, and which categories no transaction.

Transactions are counted per id before anything is joined, so the joins meet one row an id
however frequent it is, and missing ids are one row too. What a null id means is said by each
function; SQL's ``NOT IN`` would return nothing at all as soon as one category had no id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING, UNKNOWN, NO_CODE = "missing id", "unknown id", "without code"


def counted_ids(rows: DataFrame, key: Column) -> DataFrame:
    """(id, records, amount) of (amount and) the key; null ids are one group."""
    return rows.select(key.alias("id"), "amount").groupBy("id").agg(
        F.count("*").alias("records"), F.sum("amount").alias("amount")
    )


def without_match(counted: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``counted`` whose id is not among ``ids`` (NOT EXISTS): null ids, which equal
    nothing, are without a match; null ids among ``ids`` match nothing."""
    return counted.join(ids.select("id").distinct(), "id", "left_anti")


def not_among(counted: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``counted`` whose id is certainly not among ``ids`` (NOT IN).

    A null may be any id. So if ``ids`` holds a null, no row is certain and none returned; if
    ``ids`` is empty all are, null ids included; else null ids are left out.
    """
    known = ids.select("id").distinct()
    # The state of ``ids`` as one row for each possible reason: at most two rows to broadcast.
    state = known.select(F.when(F.col("id").isNull(), "null").otherwise("any").alias("state")).distinct()
    rest = without_match(counted, known)
    marked = rest.withColumn("some", F.lit("any")).withColumn("hole", F.lit("null"))
    no_hole = marked.join(F.broadcast(state), F.col("hole") == F.col("state"), "left_anti")
    empty = F.broadcast(state)
    without_ids = no_hole.filter("id is null").join(empty, F.col("some") == F.col("state"), "left_anti")
    return no_hole.filter("id is not null").unionByName(without_ids).drop("some", "hole")


def unmatched_ids(
    rows: DataFrame, categories: DataFrame, keys: tuple[Column, Column]
) -> DataFrame:
    """id, reason, records, amount: ids of rows that lead to no category code.

    ``reason`` is ``missing id`` for rows without one (a null id), ``unknown id`` where no
    category has it, and ``without code`` where all its categories lack one, blank codes
    included. Repeated categories count once. Empty tables give what follows: without
    categories every id is unknown, without rows nothing is unmatched.
    """
    key, category_key = keys
    has_code = F.max(F.coalesce(F.trim("code") != "", F.lit(False)))
    known = categories.select(category_key.alias("known_id"), F.col("code").cast("string").alias("code"))
    known = known.filter("known_id is not null").groupBy("known_id").agg(has_code.alias("has_code"))
    counted = counted_ids(rows, key)
    met = counted.join(known, F.col("id") == F.col("known_id"), "left")
    reason = (
        F.when(F.col("id").isNull(), MISSING)
        .when(F.col("known_id").isNull(), UNKNOWN)
        .when(~F.col("has_code"), NO_CODE)
    )
    found = met.withColumn("reason", reason).filter("reason is not null")
    return found.select("id", "reason", "records", "amount")


def unused_categories(
    rows: DataFrame, categories: DataFrame, keys: tuple[Column, Column]
) -> DataFrame:
    """The categories (id, code) that no row has, as often as they are there; those without an
    id among them, as nothing can have it."""
    key, category_key = keys
    used = rows.select(key.alias("used_id")).filter("used_id is not null").distinct()
    named = categories.select("id", "code", category_key.alias("category_key"))
    unused = named.join(used, F.col("category_key") == F.col("used_id"), "left_anti")
    return unused.select("id", "code")
