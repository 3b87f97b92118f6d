"""Fees of transactions by the periods that hold them, summed without listing the pairs.

A fee is amount times rate, rounded half up to cents, away from zero. What rounding adds to a
product depends on the last digits of its two factors alone. So fees are summed as sums of
amounts times rates, exactly, and what rounding adds is summed over the different last digits
of a day's amounts and of its rates. Both are bounded by their decimal types, whatever the
number of transactions and periods.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymonth.functions import rules
from tallymonth.operators import dimensions

# Decimal places of a fee.
PLACES = 2

# More last digits than this, and the product of two would not fit a long.
MOST_DIGITS = 9

MOMENT = ["date", "merchant_category_id"]


def _units(value: Column, kind: T.DecimalType) -> Column:
    """A decimal in units of its last place."""
    return (value * F.lit(10**kind.scale)).cast("decimal(38,0)")


def _last_digits(value: Column, kind: T.DecimalType, digits: int) -> Column:
    """The last digits of a decimal, with its sign, as a whole number."""
    return (_units(value, kind) % F.lit(10**digits)).cast("long")


def _rounding(product: Column, digits: int) -> Column:
    """What rounding half up, away from zero, adds to a number of which the last digits are
    those of ``product``, in units of its last place."""
    one, half = 10**digits, 10**digits // 2
    rest = product % F.lit(one)
    return F.when(rest >= half, one - rest).when(rest <= -half, -one - rest).otherwise(-rest)


def fee_totals(rows: DataFrame, periods: DataFrame, small_periods: bool = False) -> DataFrame:
    """(month, fee_code, fees, records) of the transactions (date, amount,
    merchant_category_id) in all fee periods that hold them, each fee rounded to cents.

    The periods are joined with the days that each category has transactions on.
    ``records`` counts pairs without an amount or a rate as well; ``fees`` is null where no
    pair has both.
    """
    amount, rate = rows.schema["amount"].dataType, periods.schema["rate"].dataType
    digits = amount.scale + rate.scale - PLACES
    if not 0 < digits <= MOST_DIGITS:
        raise ValueError(f"no exact sums of {amount.simpleString()} times {rate.simpleString()}")

    # Amounts without last digits are left out of what follows from these, nulls among them.
    amounts = rows.groupBy(*MOMENT, _last_digits(F.col("amount"), amount, digits).alias("a")).agg(
        F.count("*").alias("n"), F.count("amount").alias("known"), F.sum("amount").alias("sum")
    )
    moments = amounts.groupBy(*MOMENT).agg(
        F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("sum").alias("sum")
    )
    held = dimensions.with_fee_periods(moments, periods, small_periods=small_periods)
    rated = held.withColumn("r", _last_digits(F.col("rate"), rate, digits))

    month = rules.month_end(F.col("date")).alias("month")
    product = _units(F.col("sum"), amount) * _units(F.col("rate"), rate).cast("decimal(19,0)")
    products = rated.groupBy(month, "fee_code").agg(
        F.sum(product.cast("decimal(38,0)")).alias("products"),
        F.sum("n").alias("records"),
        F.sum(F.when(F.col("rate").isNotNull(), F.col("known")).otherwise(0)).alias("known"),
    )

    # The last digits of rates meet those of amounts by day and category, once whatever the
    # number of periods; the periods of each fee code meet the sums.
    codes = rated.filter("r <> 0").groupBy(*MOMENT, "fee_code", "r").agg(F.count("*").alias("times"))
    rates = codes.groupBy(*MOMENT).agg(F.collect_set("r").alias("rates"))
    pairs = (
        amounts.filter("a <> 0")
        .join(rates.hint("merge"), MOMENT)
        .select(*MOMENT, "a", "known", F.explode("rates").alias("r"))
    )
    added = pairs.groupBy(*MOMENT, "r").agg(
        F.sum(_rounding(F.col("a") * F.col("r"), digits) * F.col("known")).alias("added")
    )
    rounded = (
        codes.join(added.hint("merge"), [*MOMENT, "r"])
        .groupBy(month, "fee_code")
        .agg(F.sum(F.col("added").cast("decimal(20,0)") * F.col("times")).alias("added"))
        .select(F.col("month").alias("of_month"), F.col("fee_code").alias("of_code"), "added")
    )
    same = (F.col("month") == F.col("of_month")) & F.col("fee_code").eqNullSafe(F.col("of_code"))
    # Whole cents, as what is divided has no last digits left.
    cents = ((F.col("products") + F.coalesce("added", F.lit(0))) / F.lit(10**digits)).cast("decimal(32,0)")
    fees = cents * F.lit(Decimal(1).scaleb(-PLACES))
    return products.join(rounded, same, "left").select(
        "month", "fee_code", F.when(F.col("known") > 0, fees).alias("fees"), "records"
    )
