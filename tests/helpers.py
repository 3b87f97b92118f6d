"""Frames from model rows, and plans as text."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame, SparkSession

from tallymonth.schemas import MERCHANT_CATEGORIES, TRANSACTIONS


def transactions_of(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame([tuple(row) for row in rows], TRANSACTIONS)


def categories_of(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame([tuple(row) for row in rows], MERCHANT_CATEGORIES)


def plan_of(frame: DataFrame, mode: str = "formatted") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain(mode)
    return text.getvalue()


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str):
    """Settings by their names under spark.sql, with dots written as underscores."""
    names = {name: f"spark.sql.{name.replace('_', '.')}" for name in values}
    before = {name: spark.conf.get(names[name]) for name in values}
    for name, value in values.items():
        spark.conf.set(names[name], value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(names[name], value)
