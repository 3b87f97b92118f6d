"""Each rule table row by row, with missing and unknown keys."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymonth import lookups
from tallymonth.functions import rules
from tallymonth.operators import dimensions
from tallymonth.profiles import AS_IMPLEMENTED, AS_SPECIFIED
from tests.helpers import transactions_of
from tests.model import BACKEND, BUSINESS, SERVICE, Transaction, card_code, rounded


def applied(spark, schema: str, rows: list[tuple], column) -> list:
    """The column's value for each row, in the order of the rows."""
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    return [row["out"] for row in frame.select("i", column.alias("out")).orderBy("i").collect()]


def test_month_end(spark) -> None:
    days = [(2018, 12, 3), (2018, 12, 31), (2020, 2, 1), (2019, 2, 28), (2000, 2, 29), (1999, 4, 30)]
    rows = [(datetime.date(*day),) for day in days] + [(None,)]
    out = applied(spark, "d date", rows, rules.report_date(rules.month_end(F.col("d"))))
    assert out == [
        "2018-12-31",
        "2018-12-31",
        "2020-02-29",
        "2019-02-28",
        "2000-02-29",
        "1999-04-30",
        None,
    ]


def test_fixed_tables_agree_with_the_model() -> None:
    assert lookups.SERVICE_SYSTEM_TYPES == SERVICE
    assert lookups.MERCHANT_BUSINESS_TYPES == BUSINESS
    assert lookups.BACKEND_TRANSACTION_TYPES == BACKEND
    assert len(lookups.CARD_TRANSACTION_TYPES) == 16
    for card_type, country, brand, code in lookups.CARD_TRANSACTION_TYPES:
        assert card_code(card_type, brand, country == "Local") == code


def test_service_system_type(spark) -> None:
    methods = [*SERVICE, "payment99", "PAYMENT01", "", None]
    out = applied(
        spark, "m string", [(m,) for m in methods], rules.service_system_type(F.col("m"))
    )
    assert out == ["CPF", "OTH", "OTH", "OTH", "", "", "", ""]


def test_merchant_business_type(spark) -> None:
    brands = [*BUSINESS, "other", "", None]
    rows = [(service, brand) for service in ("CPF", "OTH", "") for brand in brands]
    out = applied(
        spark,
        "s string, b string",
        rows,
        rules.merchant_business_type(F.col("s"), F.col("b")),
    )
    assert out == ["30101", "30102", "30103", "30104", "", "", ""] + [""] * 14


def test_merchant_category_code(spark) -> None:
    rows = [("CPF", "0742"), ("CPF", None), ("OTH", "0742"), ("OTH", None), ("", None)]
    out = applied(
        spark,
        "s string, c string",
        rows,
        rules.merchant_category_code(F.col("s"), F.col("c")),
    )
    assert out == ["0742", "9999", "0742", None, None]


def test_card_country(spark) -> None:
    rows = [("A029",), ("A100",), ("a029",), ("",), (None,)]
    out = applied(spark, "c string", rows, rules.card_country(F.col("c")))
    assert out == ["Local", "Inter", "Inter", "Inter", "Inter"]


def test_backend_transaction_type(spark) -> None:
    names = [*BACKEND, "b99", "", None]
    out = applied(
        spark, "b string", [(n,) for n in names], rules.backend_transaction_type(F.col("b"))
    )
    assert out == [*BACKEND.values(), "099999", "099999", "099999"]


def transaction_types(spark, rows: list[Transaction], profile) -> list[str]:
    columns = [
        F.col(name)
        for name in ("payment_method", "card_type", "card_brand", "card_country_issuer_code")
    ]
    numbered = [
        row._replace(merchant_category_id=position) for position, row in enumerate(rows)
    ]
    frame = dimensions.with_card_code(
        transactions_of(spark, numbered), rules.card_lookup_keys(profile, *columns)
    )
    code = rules.transaction_type(
        profile, columns[0], F.col("backend_name"), F.col("transaction_type_code_lkp")
    )
    out = frame.select("merchant_category_id", code.alias("code")).orderBy(
        F.col("merchant_category_id").cast("int")
    )
    return [row["code"] for row in out.collect()]


@pytest.mark.parametrize("profile", [AS_IMPLEMENTED, AS_SPECIFIED], ids=lambda p: p.name)
def test_card_table(spark, profile) -> None:
    rows = [
        Transaction(
            card_type=card_type,
            card_brand=brand,
            card_country_issuer_code="A029" if country == "Local" else "A100",
        )
        for card_type, country, brand, _ in lookups.CARD_TRANSACTION_TYPES
    ]
    codes = [code for *_, code in lookups.CARD_TRANSACTION_TYPES]
    assert transaction_types(spark, rows, profile) == codes


def test_where_the_profiles_part_on_transaction_type(spark) -> None:
    other_method = {"payment_method": "payment02", "backend_name": "b12"}
    cases = [
        # row, as implemented, as specified
        (Transaction(card_country_issuer_code=None), "010011", "099999"),
        (Transaction(card_country_issuer_code=""), "010011", "099999"),
        (Transaction(card_brand="brand04"), "099999", "010004"),
        (Transaction(card_brand=None), "099999", "099999"),
        (Transaction(card_brand=""), "099999", "099999"),
        (Transaction(card_type=None), "099999", "099999"),
        (Transaction(card_type="type03"), "099999", "099999"),
        (Transaction(**other_method), "010001", "000001"),
        (Transaction(**other_method)._replace(card_type=None), "099999", "000001"),
        (Transaction(payment_method="payment99", backend_name="b15"), "010001", "000003"),
        (Transaction(payment_method=None, backend_name="b14"), "010001", "000002"),
        (Transaction(payment_method="payment03", backend_name="b99"), "010001", "099999"),
        (Transaction(payment_method="payment03", backend_name=None), "010001", "099999"),
        (Transaction(backend_name="b12"), "010001", "010001"),
    ]
    rows = [row for row, _, _ in cases]
    assert transaction_types(spark, rows, AS_IMPLEMENTED) == [code for _, code, _ in cases]
    assert transaction_types(spark, rows, AS_SPECIFIED) == [code for _, _, code in cases]


SUMS = [
    # amount, number, average
    ("500003.00", 1000, "500.00"),
    ("500005.00", 1000, "500.01"),
    ("0.01", 2, "0.01"),
    ("0.01", 3, "0.00"),
    ("-0.01", 2, "-0.01"),
    ("-1.01", 2, "-0.51"),
    ("5.00", 3, "1.67"),
    ("0.00", 7, "0.00"),
    ("9999999999999999999999.99", 999999999999, "10000000000.01"),
]


def test_average_amount(spark) -> None:
    rows = [(Decimal(amount), number) for amount, number, _ in SUMS] + [(None, 0), (None, 3)]
    out = applied(
        spark,
        "a decimal(28,2), n bigint",
        rows,
        rules.average_amount(F.col("a"), F.col("n")),
    )
    assert out == [Decimal(average) for *_, average in SUMS] + [None, None]
    assert out[:-2] == [rounded(amount, number) for amount, number in rows[:-2]]


def test_ranges_around_their_bounds(spark) -> None:
    rows, expected = [], []
    for position, (bound, code) in enumerate(lookups.AMOUNT_RANGES):
        following = [*lookups.AMOUNT_RANGES, (None, lookups.TOP_AMOUNT_RANGE)][position + 1][1]
        for step, wanted in (("-0.01", code), ("0.00", code), ("0.01", following)):
            rows.append(((Decimal(bound) + Decimal(step)) * 3, 3))
            expected.append(wanted)
    rows += [(Decimal("-5.00"), 1), (Decimal("0.00"), 1), (Decimal("1e15"), 1), (None, 0), (None, 2)]
    expected += ["94560000001", "94560000001", "94560000007", None, None]
    for profile in (AS_IMPLEMENTED, AS_SPECIFIED):
        column = rules.terminal_average_amount_range(profile, F.col("a"), F.col("n"))
        assert applied(spark, "a decimal(28,2), n bigint", rows, column) == expected


def test_rounding_before_the_range_differs_by_profile(spark) -> None:
    rows = [(Decimal("500003.00"), 1000), (Decimal("500005.00"), 1000)]
    implemented = rules.terminal_average_amount_range(AS_IMPLEMENTED, F.col("a"), F.col("n"))
    specified = rules.terminal_average_amount_range(AS_SPECIFIED, F.col("a"), F.col("n"))
    schema = "a decimal(28,2), n bigint"
    assert applied(spark, schema, rows, implemented) == ["94560000001", "94560000002"]
    assert applied(spark, schema, rows, specified) == ["94560000002", "94560000002"]


def test_file_names(spark) -> None:
    rows = [(datetime.date(2018, 12, 31),), (None,)]
    out = applied(spark, "d date", rows, rules.report_file_name(F.col("d")))
    assert out == ["ACME_20181231.csv", "ACME_UNDATED.csv"]
