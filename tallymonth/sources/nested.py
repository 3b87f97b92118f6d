"""Payments as other systems send them: one record with an array of items, each with a map
of attributes, in JSON lines or any nested table.

Numbers and dates are read as text, so a value that cannot be read is known with its place, and
spoils its own item only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymonth.schemas import AMOUNT, TRANSACTIONS

ITEM = T.StructType(
    [
        T.StructField("amount", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("merchant_category_id", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]
)

PAYMENTS = T.StructType(
    [
        T.StructField("payment_id", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("items", T.ArrayType(ITEM)),
    ]
)

# The transaction columns that an item keeps among its attributes.
ATTRIBUTES = ["card_type", "card_brand", "card_country_issuer_code", "backend_name"]


def read_payments(spark: SparkSession, path: str) -> DataFrame:
    """Payments from JSON lines. Fields that are not there are null, others are left out; a
    line that is no JSON is a payment of nulls."""
    return spark.read.schema(PAYMENTS).json(path)


def write_payments(payments: DataFrame, path: str) -> None:
    """Payments as JSON lines, null fields left out."""
    payments.select(*PAYMENTS.fieldNames()).write.mode("errorifexists").json(path)


def nested_payments(items: DataFrame, payment_id: Column, order: Column) -> DataFrame:
    """Payments of transactions in text form: the items of one payment in one array, in the
    given order, equal places by their content. Attributes that are null are not in the map.

    Rows without an amount, payment method, category id and attributes stand for payments
    without items.
    """
    pairs = [F.struct(F.lit(name).alias("key"), F.col(name).alias("value")) for name in ATTRIBUTES]
    given = F.filter(F.array(*pairs), lambda pair: pair["value"].isNotNull())
    entries = F.struct(
        order.alias("order"), "amount", "payment_method", "merchant_category_id", given.alias("given")
    )
    something = F.coalesce(
        *[F.col(name).cast("string") for name in ("amount", "payment_method", "merchant_category_id", *ATTRIBUTES)]
    ).isNotNull()
    grouped = items.groupBy(payment_id.cast("string").alias("payment_id"), "date").agg(
        F.sort_array(F.collect_list(F.when(something, entries))).alias("entries")
    )
    made = F.transform(
        "entries",
        lambda e: F.struct(
            e["amount"].alias("amount"),
            e["payment_method"].alias("payment_method"),
            e["merchant_category_id"].alias("merchant_category_id"),
            F.map_from_entries(e["given"]).alias("attributes"),
        ),
    )
    return grouped.select("payment_id", "date", made.alias("items"))


def _each_item(payments: DataFrame) -> DataFrame:
    """(payment_id, date, item, place): one row an item; a payment without items, its array empty
    or null, has one row with a null place."""
    return payments.select("payment_id", "date", F.posexplode_outer("items").alias("place", "item"))


def _read_date(text: Column) -> Column:
    return text.try_cast(T.DateType())


def _read_amount(text: Column) -> Column:
    return text.try_cast(AMOUNT)


def payment_items(payments: DataFrame) -> DataFrame:
    """payment_id, item and the transaction columns: one row an item, numbered from 1.

    A payment without items keeps one row, its item number, amount and id null. Values that
    cannot be read are null; a null item is an item whose values are all missing. Attributes
    beyond the transaction columns are left out, missing ones and a missing map give nulls.
    """
    item = F.col("item")
    columns = {
        "date": _read_date(F.col("date")),
        "amount": _read_amount(item["amount"]),
        "payment_method": item["payment_method"],
        **{name: item["attributes"][name] for name in ATTRIBUTES},
        "merchant_category_id": item["merchant_category_id"],
    }
    return _each_item(payments).select(
        "payment_id",
        (F.col("place") + 1).alias("item"),
        *[columns[name].alias(name) for name in TRANSACTIONS.fieldNames()],
    )


def payment_transactions(payments: DataFrame) -> DataFrame:
    """The items as transactions; payments without items are none."""
    return payment_items(payments).filter("item is not null").select(*TRANSACTIONS.fieldNames())


def rejected_items(payments: DataFrame) -> DataFrame:
    """payment_id, item, field, value: every value that cannot be read, with its place.

    The date of a payment is its own, so it is reported once, without an item number.
    """
    date = F.col("date")
    bad_date = date.isNotNull() & _read_date(date).isNull()
    amount = F.col("item")["amount"]
    bad_amount = amount.isNotNull() & _read_amount(amount).isNull()
    kind = "struct<item:int,field:string,value:string>"
    nothing = F.lit(None).cast(kind)
    first = F.coalesce(F.col("place"), F.lit(0)) == 0
    found = F.array(
        F.when(
            first & bad_date,
            F.struct(F.lit(None).cast("int").alias("item"), F.lit("date").alias("field"), date.alias("value")),
        ).otherwise(nothing),
        F.when(
            bad_amount,
            F.struct((F.col("place") + 1).alias("item"), F.lit("amount").alias("field"), amount.alias("value")),
        ).otherwise(nothing),
    )
    rejects = _each_item(payments).select("payment_id", F.explode(F.array_compact(found)).alias("reject"))
    return rejects.select("payment_id", "reject.*")
