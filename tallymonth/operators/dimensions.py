"""Lookups of transactions in the two dimensions.

The card transaction types are 16 fixed rows and always broadcast. The merchant
categories come from outside. A caller that has measured them (``fits_broadcast``) may
have them broadcast; else they are joined by shuffle, all but the rows of hot keys.
Planning a lookup runs no job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallymonth.functions import rules
from tallymonth.lookups import card_transaction_types
from tallymonth.operators import asof, intervals
from tallymonth.operators.spread import HOT_ROWS, MOST_HOT_KEYS, most_frequent, spread

BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024

# Upper estimate of what one broadcast row takes besides its text.
ROW_OVERHEAD_BYTES = 64

# How many ids with more than ``HOT_ROWS`` rows may be broadcast, and how many of their categories.
MOST_HOT_IDS = MOST_HOT_KEYS
MOST_HOT_CODES = 250_000

KEY = "category_key_lkp"


def _key(frame: DataFrame, name: str) -> Column:
    """The key a category id joins by. Whole numbers have one text each already."""
    if isinstance(frame.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("string")
    return rules.category_key(F.col(name))


def category_keys(rows: DataFrame, categories: DataFrame) -> tuple[Column, Column]:
    """The keys by which rows and categories meet."""
    return _key(rows, "merchant_category_id"), _key(categories, "id")


def _keyed(categories: DataFrame) -> DataFrame:
    return categories.select(_key(categories, "id").alias(KEY), "code")


def fits_broadcast(
    categories: DataFrame,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    columns: tuple[str, ...] = ("id", "code"),
) -> bool:
    """Measure a table by its text columns: one distributed sum, one number back."""
    row_bytes = F.lit(ROW_OVERHEAD_BYTES)
    for name in columns:
        row_bytes += F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    measured = categories.agg(F.sum(row_bytes).alias("bytes")).first()["bytes"]
    return (measured or 0) <= limit_bytes


def join_category_code(rows: DataFrame, categories: DataFrame) -> DataFrame:
    """Left join on the category id by its value. A missing id matches nothing."""
    same = _key(rows, "merchant_category_id") == F.col(KEY)
    return rows.join(_keyed(categories), same, "left").drop(KEY)


def with_category_code_broadcast(rows: DataFrame, categories: DataFrame) -> DataFrame:
    """The join on a broadcast copy. Only for categories known to be small."""
    return join_category_code(rows, F.broadcast(categories))


def hot_category_ids(
    rows: DataFrame, hot_rows: int = HOT_ROWS, most: int = MOST_HOT_IDS
) -> DataFrame:
    """Ids with more than ``hot_rows`` rows: the ``most`` frequent ones at most."""
    return _counted_hot_ids(rows, hot_rows, most).select("hot_id")


def _counted_hot_ids(rows: DataFrame, hot_rows: int, most: int) -> DataFrame:
    keyed = rows.select(_key(rows, "merchant_category_id").alias("hot_id"))
    return most_frequent(keyed.filter("hot_id is not null"), ["hot_id"], hot_rows, most)


def _hot_ids(
    rows: DataFrame, categories: DataFrame, hot_rows: int, most: int, most_codes: int
) -> DataFrame:
    """(hot_id, stays, groups): which hot ids have so few categories that all of them
    together fit a broadcast, and into how many groups the rows of the others are dealt.

    Ids with the fewest categories come first, until ``most_codes`` rows are reached.
    """
    hot = _counted_hot_ids(rows, hot_rows, most)
    keyed = categories.select(_key(categories, "id").alias("code_id"))
    same = F.col("code_id") == F.col("hot_id")
    codes = keyed.join(F.broadcast(hot), same, "left_semi").groupBy("code_id")
    counted = hot.join(codes.agg(F.count("*").alias("codes")), same, "left")
    # One task, of ``most`` rows at most.
    order = Window.orderBy(F.coalesce("codes", F.lit(0)), "hot_id")
    return counted.select(
        "hot_id",
        (F.coalesce(F.sum("codes").over(order), F.lit(0)) <= most_codes).alias("stays"),
        F.ceil(F.col("hot_n") / max(1, hot_rows)).cast("int").alias("groups"),
    )


def with_category_code_shuffled(
    rows: DataFrame,
    categories: DataFrame,
    hot_rows: int = HOT_ROWS,
    most_hot_ids: int = MOST_HOT_IDS,
    most_hot_codes: int = MOST_HOT_CODES,
) -> DataFrame:
    """Left join by shuffle for categories too large to broadcast.

    A single category, or the rows without one, may hold a large share of all rows.
    Rows with a hot id stay where they are and meet a broadcast of the hot ids'
    categories alone; these are ``most_hot_codes`` at most. Rows of hot ids with more
    categories than that are dealt to several groups, and those categories are repeated for
    each group. Rows without an id meet nothing and stay. Only the rest is shuffled as it is.
    Equal rows are no matter, and a recomputed task gives the same rows again. The hot ids
    cost one pass over the id column; the rows are then read once for those that stay and
    once for those that go.
    """
    hot = F.broadcast(_hot_ids(rows, categories, hot_rows, most_hot_ids, most_hot_codes))
    key = _key(rows, "merchant_category_id")
    marked = rows.withColumn("spread_lkp", spread(rows)).join(hot, key == F.col("hot_id"), "left")
    stays = F.coalesce(F.col("stays"), key.isNull())

    keyed = categories.select(_key(categories, "id").alias(KEY), "code")
    given = keyed.join(hot, F.col(KEY) == F.col("hot_id"), "left")
    few = F.broadcast(given.filter("stays").select(KEY, "code"))
    stay = marked.filter(stays).select(*rows.columns)
    same = _key(stay, "merchant_category_id") == F.col(KEY)
    at_rest = stay.join(few, same, "left").drop(KEY)

    groups = F.coalesce("groups", F.lit(1))
    go = marked.filter(~stays).select(
        *rows.columns, F.pmod("spread_lkp", groups.cast("long")).cast("int").alias("salt_lkp")
    )
    dealt = given.filter(F.coalesce(~F.col("stays"), F.lit(True))).select(
        KEY, "code", F.explode(F.sequence(F.lit(0), groups - 1)).alias("salt")
    )
    met = (_key(go, "merchant_category_id") == F.col(KEY)) & (F.col("salt_lkp") == F.col("salt"))
    moved = go.join(dealt.hint("merge"), met, "left").drop(KEY, "salt", "salt_lkp")
    return at_rest.unionByName(moved)


def with_category_code(
    rows: DataFrame, categories: DataFrame, small_categories: bool = False
) -> DataFrame:
    """Add ``code`` of each row's merchant category, null where there is none.

    ``small_categories`` says that the caller found them to fit a broadcast.

    A category id that occurs more than once repeats the row once per code; see
    :func:`duplicate_category_ids`.
    """
    if small_categories:
        return with_category_code_broadcast(rows, categories)
    return with_category_code_shuffled(rows, categories)


def with_category_code_as_of(
    rows: DataFrame,
    versions: DataFrame,
    at: str = "date",
    small_versions: bool = False,
    hot_rows: int = HOT_ROWS,
    most_hot_ids: int = MOST_HOT_IDS,
) -> DataFrame:
    """Add ``code`` of the category version (id, code, valid_from) in force at ``at``.

    A version holds from ``valid_from`` on until the next of its id, also one without a code; see
    :func:`asof.as_of`.
    """
    keys = category_keys(rows, versions)
    return asof.as_of(
        rows, versions, keys, at, "valid_from", ["code"], small_versions, hot_rows, most_hot_ids
    )


def with_fee_periods(
    rows: DataFrame,
    periods: DataFrame,
    small_periods: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each row once for every fee period (id, fee_code, rate, starts, ends) of its category
    that holds its date; see :func:`intervals.interval_join`."""
    keys = category_keys(rows, periods)
    return intervals.interval_join(
        rows, periods, keys, "date", ("starts", "ends"), ["fee_code", "rate"], small_periods, hot_rows
    )


def duplicate_category_ids(categories: DataFrame) -> DataFrame:
    """Ids that would repeat transactions and so inflate their totals."""
    return (
        categories.groupBy(_key(categories, "id").alias("id"))
        .agg(F.count("*").alias("occurrences"))
        .filter((F.col("occurrences") > 1) & F.col("id").isNotNull())
    )


def with_card_code(rows: DataFrame, keys: tuple[Column, Column, Column]) -> DataFrame:
    """Add ``transaction_type_code_lkp`` for the (card type, country, brand) keys."""
    table = F.broadcast(card_transaction_types(rows.sparkSession))
    card_type, country, brand = keys
    match = (
        (card_type == table["card_type_lkp"])
        & (brand == table["card_brand_lkp"])
        & (country == table["country_lkp"])
    )
    return rows.join(table, match, "left").drop("card_type_lkp", "card_brand_lkp", "country_lkp")
