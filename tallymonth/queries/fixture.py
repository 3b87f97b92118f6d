"""Card transactions and merchant categories derived from the star-schema tables.

One transaction per line item. The rules (`FIXTURES.md` section 2) are chosen so
that every branch of the report, every code and every kind of missing value
occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymonth.sources.nested import nested_payments

# The columns used; with them given, opening a table runs no job.
TABLES = {
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_returnflag STRING"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "part": "p_partkey BIGINT, p_size INT, p_retailprice DOUBLE",
    "nation": "n_nationkey INT",
    "supplier": "s_suppkey BIGINT",
}

IS_CARD = "o_orderpriority IN ('1-URGENT', '2-HIGH')"

TRANSACTION_COLUMNS = [
    "CAST(o_orderdate AS DATE) AS date",
    """CAST(CASE
        WHEN l_linenumber = 7 AND l_suppkey % 10 = 3 THEN NULL
        WHEN l_suppkey % 7 = 0 THEN l_quantity * 10
        WHEN l_suppkey % 7 = 1 THEN p_retailprice
        WHEN l_suppkey % 7 = 2 THEN p_retailprice + 500
        WHEN l_suppkey % 7 = 3 THEN p_retailprice + 2000
        WHEN l_suppkey % 7 = 4 THEN p_retailprice + 6000
        WHEN l_suppkey % 7 = 5 THEN p_retailprice + 15000
        ELSE l_extendedprice END AS DECIMAL(18,2)) AS amount""",
    f"""CASE
        WHEN {IS_CARD} THEN 'payment01'
        WHEN o_orderpriority = '3-MEDIUM' THEN 'payment02'
        WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'payment03'
        WHEN l_linenumber <= 5 THEN 'payment04'
        WHEN l_linenumber = 6 THEN 'payment99' END AS payment_method""",
    f"""CASE WHEN {IS_CARD} THEN CASE
        WHEN l_returnflag = 'A' THEN 'type01'
        WHEN l_returnflag = 'R' THEN 'type02'
        WHEN l_linenumber <= 4 THEN 'type01' END END AS card_type""",
    f"""CASE WHEN {IS_CARD} THEN CASE p_size % 6
        WHEN 0 THEN 'brand01'
        WHEN 1 THEN 'brand02'
        WHEN 2 THEN 'brand03'
        WHEN 3 THEN 'brand04'
        WHEN 4 THEN 'other' END END AS card_brand""",
    """CASE WHEN c_nationkey % 5 IN (0, 1) THEN 'A029'
        WHEN c_nationkey % 5 <> 4 THEN 'A100' END AS card_country_issuer_code""",
    f"""CASE WHEN NOT {IS_CARD} THEN CASE
        WHEN l_linenumber = 1 THEN 'b03'
        WHEN l_linenumber = 2 THEN 'b04'
        WHEN l_linenumber = 3 THEN 'b05'
        WHEN l_linenumber = 4 THEN 'b06'
        WHEN l_linenumber = 5 THEN 'b12'
        WHEN l_linenumber = 6 THEN 'b14'
        WHEN l_linenumber = 7 AND l_returnflag = 'A' THEN 'b15'
        WHEN l_returnflag = 'R' THEN 'b99' END END AS backend_name""",
    """CASE WHEN l_suppkey % 8 <> 7 THEN CAST(l_suppkey % 31 AS INT) END
        AS merchant_category_id""",
]

CATEGORY_COLUMNS = [
    "n_nationkey AS id",
    """CASE WHEN n_nationkey % 9 <> 8
        THEN lpad(CAST(n_nationkey * 211 + 742 AS STRING), 4, '0') END AS code""",
]


# A table that grows with the data; keys that end in 9 repeat the id before them. Some codes
# are missing, some blank.
LARGE_CATEGORY_COLUMNS = [
    "p_partkey - IF(p_partkey % 10 = 9, 1, 0) AS id",
    """CASE WHEN p_partkey % 7 = 3 THEN '' WHEN p_partkey % 9 <> 8
        THEN lpad(CAST(p_partkey % 10000 AS STRING), 4, '0') END AS code""",
]

# Codes that change over time: several versions an id, some on one day, some without a code or
# a start or with a blank code, and one id in eleven that is never used.
DATED_CATEGORY_COLUMNS = [
    "CAST(p_partkey % 34 AS INT) AS id",
    """CASE WHEN p_partkey % 11 = 5 THEN '' WHEN p_partkey % 9 <> 8
        THEN lpad(CAST(p_partkey % 10000 AS STRING), 4, '0') END AS code""",
    """CASE WHEN p_partkey % 200 <> 7
        THEN date_add(DATE'1992-06-01', CAST((p_partkey * 37) % 2200 AS INT)) END AS valid_from""",
]

# Fee periods of any length that overlap, touch, have no start or no end, or are empty.
FEE_PERIOD_COLUMNS = [
    "CAST(s_suppkey % 33 AS INT) AS id",
    "concat('fee', CAST(s_suppkey % 7 AS STRING)) AS fee_code",
    "CAST((s_suppkey % 50) / 1000 AS DECIMAL(6,4)) AS rate",
    """CASE WHEN s_suppkey % 13 <> 0
        THEN date_add(DATE'1992-01-01', CAST((s_suppkey * 53) % 2500 AS INT)) END AS starts""",
    """CASE WHEN s_suppkey % 11 <> 0 THEN date_add(DATE'1992-01-01',
        CAST((s_suppkey * 53) % 2500 + power(s_suppkey % 10, 3) - 1 AS INT)) END AS ends""",
]

# As a file may hold them: amounts finer than cents, ids beyond 32 bits, with idle zeros or
# letters, and malformed dates and amounts.
ROUGH_TRANSACTION_COLUMNS = [
    """CASE WHEN l_linenumber = 6 AND l_suppkey % 3 = 0
        THEN concat(lpad(CAST(l_suppkey % 28 + 1 AS STRING), 2, '0'), '/12/2018')
        ELSE concat('2018-12-', lpad(CAST(l_suppkey % 28 + 1 AS STRING), 2, '0')) END AS date""",
    """CASE WHEN l_suppkey % 20 = 7 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), 'x')
        WHEN l_suppkey % 20 <> 8
        THEN CAST(CAST(l_extendedprice * l_discount AS DECIMAL(28,6)) AS STRING) END AS amount""",
    "'payment01' AS payment_method",
    "'type01' AS card_type",
    "'brand01' AS card_brand",
    "'A029' AS card_country_issuer_code",
    "CAST(NULL AS STRING) AS backend_name",
    """CASE l_linenumber
        WHEN 1 THEN CAST(l_suppkey + 3000000000 AS STRING)
        WHEN 2 THEN concat(CAST(l_suppkey + 3000000000 AS STRING), '.0')
        WHEN 3 THEN concat('000', CAST(l_suppkey + 3000000000 AS STRING))
        WHEN 4 THEN concat('m', CAST(l_suppkey AS STRING))
        WHEN 5 THEN concat(CAST(l_suppkey + 3000000000 AS STRING), '.5') END
        AS merchant_category_id""",
]

ROUGH_CATEGORY_COLUMNS = [
    """stack(2,
        concat(CAST(s_suppkey + IF(s_suppkey % 2 = 0, 3000000000, 9000000000) AS STRING), '.00'),
        lpad(CAST(s_suppkey % 10000 AS STRING), 4, '0'),
        concat('m', CAST(s_suppkey AS STRING)),
        lpad(CAST((s_suppkey + 5000) % 10000 AS STRING), 4, '0')) AS (id, code)""",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


# Items as a payment system sends them, in text; some amounts cannot be read.
PAYMENT_COLUMNS = [
    "l_orderkey AS payment_id",
    "l_linenumber AS place",
    """CASE WHEN o_orderkey % 40 = 3 THEN date_format(o_orderdate, 'dd/MM/yyyy')
        ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS date""",
    "CASE WHEN l_suppkey % 20 = 7 THEN concat(CAST(amount AS STRING), 'x') ELSE CAST(amount AS STRING) END AS amount",
    "payment_method",
    "CAST(merchant_category_id AS STRING) AS merchant_category_id",
    "card_type",
    "card_brand",
    "card_country_issuer_code",
    "backend_name",
]


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested payments, one per order with its line items; orders without any among them."""
    more = ["l_orderkey", "l_linenumber", "l_suppkey", "o_orderkey", "o_orderdate"]
    items = transactions(spark, sf_dir, *more).selectExpr(*PAYMENT_COLUMNS)
    sold = table(spark, sf_dir, "lineitem").select("l_orderkey")
    orders = table(spark, sf_dir, "orders")
    empty = orders.join(sold, orders["o_orderkey"] == sold["l_orderkey"], "left_anti").selectExpr(
        "o_orderkey AS payment_id", "CAST(CAST(o_orderdate AS DATE) AS STRING) AS date"
    )
    every = items.unionByName(empty, allowMissingColumns=True)
    return nested_payments(every, F.col("payment_id"), F.col("place"))


def transactions(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """The transactions, read from lineitem, orders, customer and part; ``more`` names columns
    of these tables.

    Orders meet their customers before they meet the line items, so the customer
    join moves orders only. No side is bounded at scale, so none is hinted: the
    planner broadcasts by size, and skewed keys are left to adaptive execution.
    """
    orders, customers, parts, items = (
        table(spark, sf_dir, name) for name in ("orders", "customer", "part", "lineitem")
    )
    placed = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    sold = items.join(parts, items["l_partkey"] == parts["p_partkey"])
    rows = sold.join(placed, items["l_orderkey"] == orders["o_orderkey"])
    return rows.selectExpr(*TRANSACTION_COLUMNS, *more)


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merchant categories, read from nation; codes keep their leading zero."""
    return table(spark, sf_dir, "nation").selectExpr(*CATEGORY_COLUMNS)


def large_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchant categories as many as parts, some ids repeated."""
    return table(spark, sf_dir, "part").selectExpr(*LARGE_CATEGORY_COLUMNS)


def dated_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of merchant categories (id, code, valid_from), as many as parts."""
    return table(spark, sf_dir, "part").selectExpr(*DATED_CATEGORY_COLUMNS)


def fee_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods (id, fee_code, rate, starts, ends), as many as suppliers."""
    return table(spark, sf_dir, "supplier").selectExpr(*FEE_PERIOD_COLUMNS)


def rough_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as text with every fault a file may have, one per line item."""
    return table(spark, sf_dir, "lineitem").selectExpr(*ROUGH_TRANSACTION_COLUMNS)


def rough_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two categories per supplier: one by a long number, one by a name."""
    return table(spark, sf_dir, "supplier").selectExpr(*ROUGH_CATEGORY_COLUMNS)
