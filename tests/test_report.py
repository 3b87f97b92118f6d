"""The whole report on hand-made and on random rows."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymonth import (
    AS_IMPLEMENTED,
    AS_SPECIFIED,
    conformed,
    input_counts,
    monthly_report,
    preview,
    record_count,
    report_file_names,
    report_for_month,
    report_months,
)
from tallymonth.operators.dimensions import duplicate_category_ids
from tallymonth.queries import fixture
from tallymonth.schemas import REPORT, TRANSACTIONS
from tests import model
from tests.helpers import categories_of, transactions_of
from tests.model import Category, Transaction

PROFILES = [AS_IMPLEMENTED, AS_SPECIFIED]
BOTH_WAYS = [True, False]


def reported(spark, transactions, categories, profile, small=True) -> list:
    frame = monthly_report(
        transactions_of(spark, transactions),
        categories_of(spark, categories),
        profile,
        small_categories=small,
    )
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in REPORT]
    return [tuple(row) for row in frame.collect()]


def check_against_model(spark, transactions, categories) -> None:
    for profile in PROFILES:
        wanted = model.report(transactions, categories, profile is AS_SPECIFIED)
        for small in BOTH_WAYS:
            rows = reported(spark, transactions, categories, profile, small)
            assert len(rows) == len(set(rows))
            assert set(rows) == wanted


def test_one_group(spark) -> None:
    rows = [Transaction(amount=Decimal("400.00")), Transaction(amount=Decimal("700.10"))]
    expected = (
        "42",
        "2018-12-31",
        "CPF",
        "010001",
        "30101",
        "0742",
        Decimal("1100.10"),
        2,
        "94560000002",
    )
    for profile in PROFILES:
        assert reported(spark, rows, [Category()], profile) == [expected]


def test_missing_amounts(spark) -> None:
    none_given = [Transaction(amount=None)] * 2
    (row,) = reported(spark, none_given, [Category()], AS_IMPLEMENTED)
    assert row[6:] == (None, 0, None)
    (row,) = reported(spark, none_given, [Category()], AS_SPECIFIED)
    assert row[6:] == (None, 2, None)

    one_given = [Transaction(amount=Decimal("800.00")), Transaction(amount=None)]
    (row,) = reported(spark, one_given, [Category()], AS_IMPLEMENTED)
    assert row[6:] == (Decimal("800.00"), 1, "94560000002")
    (row,) = reported(spark, one_given, [Category()], AS_SPECIFIED)
    assert row[6:] == (Decimal("800.00"), 2, "94560000001")


def test_every_kind_of_missing_field(spark) -> None:
    blanks = [
        Transaction(**{name: value})
        for name in Transaction._fields
        for value in ([None, ""] if isinstance(getattr(Transaction(), name), str) else [None])
    ]
    cash = [row._replace(payment_method="payment03", backend_name="b04") for row in blanks]
    check_against_model(spark, [Transaction(), *blanks, *cash], [Category()])


def test_categories_missing_unmatched_without_code_and_repeated(spark) -> None:
    categories = [
        Category(1, "0742"),
        Category(2, None),
        Category(3, "1000"),
        Category(3, "2000"),
        Category(4, "3000"),
        Category(4, "3000"),
        Category(None, "4000"),
        Category(5, ""),
    ]
    rows = [
        Transaction(merchant_category_id=key, payment_method=method)
        for key in (1, 2, 3, 4, 5, 99, None)
        for method in ("payment01", "payment02")
    ]
    check_against_model(spark, rows, categories)
    duplicates = duplicate_category_ids(categories_of(spark, categories))
    assert sorted(map(tuple, duplicates.collect())) == [("3", 2), ("4", 2)]


def test_no_transactions_and_no_categories(spark) -> None:
    check_against_model(spark, [], [Category()])
    check_against_model(spark, [Transaction()], [])


def some(*values):
    return st.sampled_from(values)


TRANSACTION = st.builds(
    Transaction,
    date=some(
        None, datetime.date(2018, 12, 3), datetime.date(2018, 12, 31), datetime.date(2020, 2, 1)
    ),
    amount=st.none()
    | some("500.00", "500.01", "499.99", "0.01").map(Decimal)
    | st.decimals(min_value=-50, max_value=60000, places=2),
    payment_method=some("payment01", "payment01", "payment02", "payment04", "payment99", "", None),
    card_type=some("type01", "type02", "type03", None),
    card_brand=some("brand01", "brand03", "brand04", "other", "", None),
    card_country_issuer_code=some("A029", "A100", "", None),
    backend_name=some("b03", "b12", "b14", "b15", "b99", None),
    merchant_category_id=some(1, 2, 3, 9, None),
)
CATEGORY = st.builds(Category, id=some(1, 2, 3, None), code=some("0742", "5000", "", None))


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    transactions=st.lists(TRANSACTION, min_size=1, max_size=60),
    categories=st.lists(CATEGORY, min_size=1, max_size=5),
)
def test_random_rows_against_the_model(spark, transactions, categories) -> None:
    check_against_model(spark, transactions, categories)


def test_amounts_finer_than_cents_are_rounded_once(spark) -> None:
    fine = spark.createDataFrame([("0.335",)] * 3, "a string").selectExpr(
        "DATE '2018-12-03' AS date",
        "CAST(a AS DECIMAL(20,4)) AS amount",
        "'payment01' AS payment_method",
        "'type01' AS card_type",
        "'brand01' AS card_brand",
        "'A029' AS card_country_issuer_code",
        "CAST(NULL AS STRING) AS backend_name",
        "1 AS merchant_category_id",
    )
    row = monthly_report(fine, categories_of(spark, [Category()])).first()
    assert (row["amount"], row["number"]) == (Decimal("1.01"), 3)


def test_input_of_other_types_and_order_is_conformed(spark) -> None:
    loose = spark.createDataFrame(
        [("x", "1", 12.5, "2018-12-03", None, "b03", "A029", "brand01", "type01", "payment01")],
        "extra string, merchant_category_id string, amount double, date string, unused string, "
        "backend_name string, card_country_issuer_code string, card_brand string, "
        "card_type string, payment_method string",
    )
    rows = conformed(loose, TRANSACTIONS)
    assert [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in TRANSACTIONS
    ]
    assert rows.first()["amount"] == Decimal("12.50")
    with pytest.raises(ValueError, match="card_brand"):
        conformed(loose.drop("card_brand"), TRANSACTIONS)


@pytest.mark.parametrize("profile", PROFILES, ids=lambda p: p.name)
def test_invariants_on_the_derived_tables(spark, sf_dir, profile) -> None:
    transactions = fixture.transactions(spark, sf_dir)
    report = monthly_report(transactions, fixture.categories(spark, sf_dir), profile)
    found = report.agg(
        F.sum("number").alias("number"),
        F.sum("amount").alias("amount"),
        F.count("*").alias("rows"),
        F.count_distinct(F.struct(*report.columns[1:6])).alias("keys"),
    ).first()
    given_rows = transactions.agg(
        F.count("*").alias("all"),
        F.count("amount").alias("with_amount"),
        F.sum("amount").alias("amount"),
    ).first()
    counted = given_rows["all" if profile is AS_SPECIFIED else "with_amount"]
    assert found["number"] == counted
    assert found["amount"] == given_rows["amount"]
    assert found["rows"] == found["keys"]


def test_one_month_is_that_part_of_the_report(spark, sf_dir) -> None:
    transactions = fixture.transactions(spark, sf_dir)
    categories = fixture.categories(spark, sf_dir)
    month = datetime.date(1997, 2, 28)
    whole = monthly_report(transactions, categories).filter(F.col("date") == "1997-02-28")
    part = report_for_month(transactions, categories, month)
    assert sorted(map(str, part.collect())) == sorted(map(str, whole.collect())) != []


def test_months_files_counts_and_preview(spark) -> None:
    rows = [
        Transaction(date=datetime.date(2018, 12, 3), amount=Decimal("3.00")),
        Transaction(date=datetime.date(2018, 12, 9), amount=Decimal("2.00")),
        Transaction(date=datetime.date(2018, 11, 9), amount=Decimal("1.00")),
        Transaction(date=None),
    ]
    transactions, categories = transactions_of(spark, rows), categories_of(spark, [Category()])
    report = monthly_report(transactions, categories)

    months = {row["date"] for row in report_months(transactions).collect()}
    assert months == {"2018-12-31", "2018-11-30", None}
    assert months == {row["date"] for row in report.select("date").distinct().collect()}
    assert {tuple(row) for row in report_file_names(transactions).collect()} == {
        ("2018-12-31", "ACME_20181231.csv"),
        ("2018-11-30", "ACME_20181130.csv"),
        (None, "ACME_UNDATED.csv"),
    }
    assert record_count(report).collect() == [(3,)]
    assert {tuple(row) for row in input_counts(transactions, categories).collect()} == {
        ("transactions", 4),
        ("merchant_categories", 1),
    }
    first = preview(transactions, 2).collect()
    assert [row["date"] for row in first] == [None, datetime.date(2018, 11, 9)]
