"""Readers of the two inputs.

Columns are found by the names in the header, in any case, wherever they stand; columns the
report does not use are left in the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymonth.schemas import (
    AMOUNT,
    CATEGORY_VERSIONS,
    CORRUPT_RECORD,
    FEE_PERIODS,
    MERCHANT_CATEGORIES,
    TRANSACTIONS,
)


def _require_columns(names: list[str], schema: T.StructType, where: str) -> None:
    there = {name.lower() for name in names}
    missing = [name for name in schema.fieldNames() if name not in there]
    if missing:
        raise ValueError(f"{where} lacks the columns {missing}; it has {names}")


def _read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keep_corrupt_record: bool,
    fail_on_malformed: bool,
) -> DataFrame:
    # Without type inference, asking for the columns reads only the first line.
    header = spark.read.option("header", True).csv(path).columns
    _require_columns(header, schema, path)
    types = {field.name: field.dataType for field in schema}
    in_file = T.StructType(
        [T.StructField(name, types.get(name.lower(), T.StringType())) for name in header]
    )
    wanted = schema.fieldNames()
    reader = spark.read.option("header", True)
    reader = reader.option("mode", "FAILFAST" if fail_on_malformed else "PERMISSIVE")
    if keep_corrupt_record or fail_on_malformed:
        # With columns pruned by the parser, a line that is cut short looks whole.
        reader = reader.option("columnPruning", False)
    if keep_corrupt_record:
        in_file = in_file.add(CORRUPT_RECORD, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_RECORD)
        wanted = [*wanted, CORRUPT_RECORD]
    # Each further file of a directory must have the header of the first.
    return reader.option("enforceSchema", False).schema(in_file).csv(path).select(*wanted)


def read_transactions(
    spark: SparkSession,
    path: str,
    keep_corrupt_record: bool = False,
    amount_type: T.DecimalType = AMOUNT,
    fail_on_malformed: bool = False,
) -> DataFrame:
    """Transactions from CSV with a header.

    A malformed value becomes null and its row is kept. With
    ``keep_corrupt_record`` the raw line of such a row is kept beside it; see
    :func:`rejected_values`. With ``fail_on_malformed`` the first such row fails the
    job that meets it, at no cost to the others. Ids are text and never malformed.
    An amount finer than ``amount_type`` is rounded as it is read; a finer type
    keeps it, and the report rounds the sums only.
    """
    schema = T.StructType(
        [
            T.StructField(field.name, amount_type) if field.name == "amount" else field
            for field in TRANSACTIONS
        ]
    )
    return _read_csv(spark, path, schema, keep_corrupt_record, fail_on_malformed)


def read_merchant_categories(
    spark: SparkSession,
    path: str,
    keep_corrupt_record: bool = False,
    fail_on_malformed: bool = False,
) -> DataFrame:
    """Merchant categories from CSV with a header. Ids and codes stay text."""
    return _read_csv(spark, path, MERCHANT_CATEGORIES, keep_corrupt_record, fail_on_malformed)


def read_category_versions(
    spark: SparkSession, path: str, fail_on_malformed: bool = False
) -> DataFrame:
    """Versions of merchant categories (id, code, valid_from) from CSV with a header.

    A version without a date holds before all others; so does one whose date cannot be read,
    unless ``fail_on_malformed`` is set.
    """
    return _read_csv(spark, path, CATEGORY_VERSIONS, False, fail_on_malformed)


def read_fee_periods(spark: SparkSession, path: str, fail_on_malformed: bool = False) -> DataFrame:
    """Fee periods (id, fee_code, rate, starts, ends) from CSV with a header; see
    :func:`read_category_versions` for dates."""
    return _read_csv(spark, path, FEE_PERIODS, False, fail_on_malformed)


def rejected_values(transactions: DataFrame) -> DataFrame:
    """One row on transactions read with ``keep_corrupt_record``: how many records there
    are, how many were malformed, and how many of these lost their date or their amount."""
    malformed = F.col(CORRUPT_RECORD).isNotNull()
    return transactions.agg(
        F.count("*").alias("records"),
        F.count(CORRUPT_RECORD).alias("rejected"),
        F.count_if(malformed & F.col("date").isNull()).alias("without_date"),
        F.count_if(malformed & F.col("amount").isNull()).alias("without_amount"),
    )


def conformed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Any table with the schema's columns, in its order and types."""
    _require_columns(rows.columns, schema, "the table")
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
