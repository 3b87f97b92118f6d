"""As-of join: each row meets the version of its key that is in force at its time.

A version is in force from its start until the next one of its key starts. Small version
tables are broadcast as periods. Otherwise rows and versions are put into one table, sorted
by key and time, and the last version is carried forward: one shuffle, no matter how
many versions a key has.

Keys with too many rows are cut by time, at quantiles of their rows; the version in
force at a cut is added to what comes after it. If a single moment of a key is too frequent
itself, its rows are dealt to several groups, to each of which the versions of that
stretch of time are given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallymonth.operators.spread import HOT_ROWS, LONERS, MOST_HOT_KEYS, most_frequent, spread

# A frequent key is cut into so many stretches of time.
STRETCHES = 64
QUANTILE_ACCURACY = 2000


def _keyed_rows(rows: DataFrame, key: Column, at: str) -> DataFrame:
    """(row, key, at, spread); rows without a key or a time have no key."""
    columns = [F.col(f"`{name}`") for name in rows.columns]
    named = F.when(F.col(f"`{at}`").isNotNull(), key)
    return rows.select(
        F.struct(*columns).alias("row"),
        named.alias("key"),
        F.col(f"`{at}`").alias("at"),
        spread(rows).alias("spread"),
    )


def _versions(versions: DataFrame, key: Column, start: str, values: list[str]) -> DataFrame:
    """(key, at, value) of the versions that have a key, equal ones once."""
    value = F.struct(*[F.col(f"`{name}`") for name in values])
    found = versions.select(key.alias("key"), F.col(f"`{start}`").alias("at"), value.alias("value"))
    return found.filter("key is not null").distinct()


def _result(rows: DataFrame, joined: DataFrame, values: list[str]) -> DataFrame:
    own = [F.col(f"row.`{name}`").alias(name) for name in rows.columns if name not in values]
    return joined.select(*own, *[F.col(f"value.`{name}`").alias(name) for name in values])


def periods_of(versions: DataFrame) -> DataFrame:
    """(key, start, end, value): one version a start, the greatest value of several; the last
    period of a key has no end, a version without a start no start."""
    single = versions.groupBy("key", "at").agg(F.max("value").alias("value"))
    order = Window.partitionBy("key").orderBy(F.col("at").asc_nulls_first())
    return single.select(
        "key", F.col("at").alias("start"), F.lead("at").over(order).alias("end"), "value"
    )


def cut_times(
    keyed: DataFrame, hot_rows: int = HOT_ROWS, most: int = MOST_HOT_KEYS
) -> DataFrame:
    """(key, bounds, salts) of the frequent keys of (key, at).

    ``bounds`` are up to ``STRETCHES - 1`` times, at about equal numbers of rows; ``salts`` says
    for each stretch between them into how many groups its rows are dealt. A time that is a
    bound several times over holds that many shares of the rows. Two passes over key and time.
    """
    known = keyed.filter("key is not null").select("key", "at")
    hot = F.broadcast(most_frequent(known, ["key"], hot_rows, most))
    shares = F.array(*[F.lit(i / STRETCHES) for i in range(1, STRETCHES)])
    found = known.join(hot, "key").groupBy("key").agg(
        F.max("hot_n").alias("n"),
        F.percentile_approx("at", shares, QUANTILE_ACCURACY).alias("quantiles"),
    )
    found = found.withColumn("bounds", F.array_distinct("quantiles"))
    times = F.transform(
        "bounds", lambda bound: F.size(F.filter("quantiles", lambda other: other == bound))
    )
    groups = F.transform(
        F.concat(F.array(F.lit(0)), times),
        lambda shared: F.ceil((shared + 1) * F.col("n") / (STRETCHES * hot_rows)).cast("int"),
    )
    return found.select("key", "bounds", groups.alias("salts"))


def _stretch(time: Column) -> Column:
    """Which stretch of its key a time is in; 0 for a key that is not cut."""
    passed = F.size(F.filter("bounds", lambda bound: bound <= time))
    return F.when(F.col("bounds").isNotNull() & time.isNotNull(), passed).otherwise(0)


def _opening_values(versions: DataFrame, cuts: DataFrame) -> DataFrame:
    """(key, stretch, at, value, salts): what is in force as each stretch but the first begins.

    Only the last version of each stretch is looked at: a few rows for each frequent key.
    """
    last = versions.filter("bounds is not null").groupBy("key", "stretch").agg(
        F.max(F.struct("at", "value")).alias("last")
    )
    every = cuts.select(
        "key", F.explode(F.sequence(F.lit(0), F.size("bounds"))).alias("stretch"), "salts"
    )
    order = Window.partitionBy("key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    opened = every.join(last, ["key", "stretch"], "left").withColumn(
        "opening", F.max("last").over(order)
    )
    return opened.filter("opening is not null").select(
        "key", "stretch", F.lit(None).cast(versions.schema["at"].dataType).alias("at"),
        F.col("opening.value").alias("value"), "salts",
    )


def carried_forward(
    keyed: DataFrame, versions: DataFrame, hot_rows: int = HOT_ROWS, most: int = MOST_HOT_KEYS
) -> DataFrame:
    """(row, value) of (row, key, at, spread) and the versions (key, at, value)."""
    cuts = cut_times(keyed, hot_rows, most)
    marked = keyed.join(F.broadcast(cuts), "key", "left").withColumn("stretch", _stretch(F.col("at")))
    groups = F.when(F.col("key").isNull(), F.lit(LONERS)).otherwise(
        F.coalesce(F.get("salts", F.col("stretch")), F.lit(1))
    )
    salt = F.pmod(F.col("spread"), groups.cast("long")).cast("int")
    given = versions.join(F.broadcast(cuts), "key", "left").withColumn(
        "stretch", _stretch(F.col("at"))
    )
    given = given.select("key", "stretch", "at", "value", "salts", "bounds")
    known = given.drop("bounds").unionByName(_opening_values(given, cuts))
    each = F.coalesce(F.get("salts", F.col("stretch")), F.lit(1)) - 1
    events = marked.select(
        "key", "stretch", salt.alias("salt"), "at", F.lit(1).alias("side"), "row",
        F.lit(None).cast(versions.schema["value"].dataType).alias("value"),
    ).unionByName(
        known.select(
            "key", "stretch", F.explode(F.sequence(F.lit(0), each)).alias("salt"), "at",
            F.lit(0).alias("side"),
            F.lit(None).cast(keyed.schema["row"].dataType).alias("row"), "value",
        )
    )
    order = (
        Window.partitionBy("key", "stretch", "salt")
        .orderBy(F.col("at").asc_nulls_first(), "side", F.col("value").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = events.withColumn("value", F.last("value", ignorenulls=True).over(order))
    return carried.filter("side = 1").select("row", "value")


def as_of(
    rows: DataFrame,
    versions: DataFrame,
    keys: tuple[Column, Column],
    at: str,
    start: str,
    values: list[str],
    small_versions: bool = False,
    hot_rows: int = HOT_ROWS,
    most_hot_keys: int = MOST_HOT_KEYS,
) -> DataFrame:
    """Every row with the ``values`` of the version in force at its time, else nulls.

    ``keys`` are the key of a row and that of a version. A version holds from its start on,
    the start included, also where its values are null; without a start it holds before
    all others. Of several versions of a key with one start the greatest holds (by
    ``values`` in turn, nulls least). Rows without key or time, and rows before the first
    version, get nulls. Repeated rows stay as they are, one result each. Columns of rows that
    are named like a value are replaced. Empty tables are no exception.

    ``small_versions`` says that the caller found the versions to fit a broadcast: then
    rows are not moved at all.
    """
    key, version_key = keys
    known = _versions(versions, version_key, start, values)
    keyed = _keyed_rows(rows, key, at)
    if not small_versions:
        return _result(rows, carried_forward(keyed, known, hot_rows, most_hot_keys), values)
    periods = periods_of(known).withColumnRenamed("key", "version_key")
    same = (
        (F.col("key") == F.col("version_key"))
        & (F.col("start").isNull() | (F.col("at") >= F.col("start")))
        & (F.col("end").isNull() | (F.col("at") < F.col("end")))
    )
    return _result(rows, keyed.drop("spread").join(F.broadcast(periods), same, "left"), values)
