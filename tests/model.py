"""The report worked out row by row in plain Python, to check the Spark jobs against."""

from __future__ import annotations

import calendar
import datetime
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction
from typing import NamedTuple

SERVICE = {"payment01": "CPF", "payment02": "OTH", "payment03": "OTH", "payment04": "OTH"}
BUSINESS = {"brand01": "30101", "brand02": "30102", "brand03": "30103", "brand04": "30104"}
# The prescribed codes, written out apart from the package's own tables.
BACKEND = {
    "b03": "000004",
    "b04": "000004",
    "b05": "000004",
    "b06": "000004",
    "b12": "000001",
    "b14": "000002",
    "b15": "000003",
}
CARD = {
    ("type01", True, "brand01"): "010001",
    ("type01", True, "brand02"): "010002",
    ("type01", True, "brand03"): "010003",
    ("type01", True, "other"): "010004",
    ("type01", False, "brand01"): "010011",
    ("type01", False, "brand02"): "010012",
    ("type01", False, "brand03"): "010013",
    ("type01", False, "other"): "010014",
    ("type02", True, "brand01"): "010021",
    ("type02", True, "brand02"): "010022",
    ("type02", True, "brand03"): "010023",
    ("type02", True, "other"): "010024",
    ("type02", False, "brand01"): "010031",
    ("type02", False, "brand02"): "010032",
    ("type02", False, "brand03"): "010033",
    ("type02", False, "other"): "010034",
}
RANGES = [
    "94560000001",
    "94560000002",
    "94560000003",
    "94560000004",
    "94560000005",
    "94560000006",
    "94560000007",
]
BOUNDS = (500, 1000, 2000, 5000, 10000, 30000)


class Transaction(NamedTuple):
    date: datetime.date | None = datetime.date(2018, 12, 3)
    amount: Decimal | None = Decimal("100.00")
    payment_method: str | None = "payment01"
    card_type: str | None = "type01"
    card_brand: str | None = "brand01"
    card_country_issuer_code: str | None = "A029"
    backend_name: str | None = None
    merchant_category_id: int | None = 1


class Category(NamedTuple):
    id: int | None = 1
    code: str | None = "0742"


def month_end(date: datetime.date | None) -> str | None:
    if date is None:
        return None
    return str(date.replace(day=calendar.monthrange(date.year, date.month)[1]))


def card_code(card_type: str | None, brand: str | None, local: bool) -> str | None:
    return CARD.get((card_type, local, brand))


def transaction_type(tx: Transaction, specified: bool) -> str:
    local = tx.card_country_issuer_code == "A029"
    brand = tx.card_brand
    if specified:
        if tx.payment_method != "payment01":
            return BACKEND.get(tx.backend_name, "099999")
        if not (tx.card_type and brand and tx.card_country_issuer_code):
            return "099999"
        if brand not in ("brand01", "brand02", "brand03"):
            brand = "other"
    return card_code(tx.card_type, brand, local) or "099999"


def amount_range(total: Decimal | None, number: int, specified: bool) -> str | None:
    if total is None:
        return None
    average = Fraction(total) / number
    if not specified:
        average = Fraction(rounded(total, number))
    return RANGES[sum(average > bound for bound in BOUNDS)]


def rounded(total: Decimal, number: int) -> Decimal:
    """Average in cents, half away from zero, without an inexact step."""
    cents = Fraction(total) * 100 / number
    whole = int(abs(cents) + Fraction(1, 2))
    return Decimal(whole if cents >= 0 else -whole).scaleb(-2)


def report(
    transactions: list[Transaction], categories: list[Category], specified: bool
) -> set[tuple]:
    groups: dict[tuple, list[Decimal | None]] = defaultdict(list)
    for tx in transactions:
        service = SERVICE.get(tx.payment_method, "")
        is_card = service == "CPF"
        codes = [
            c.code
            for c in categories
            if c.id is not None and c.id == tx.merchant_category_id
        ] or [None]
        for code in codes:
            if specified and code == "":
                code = None
            if code is None and is_card:
                code = "9999"
            key = (
                month_end(tx.date),
                service,
                transaction_type(tx, specified),
                BUSINESS.get(tx.card_brand, "") if is_card else "",
                code,
            )
            groups[key].append(tx.amount)

    rows = set()
    for key, amounts in groups.items():
        given = [amount for amount in amounts if amount is not None]
        total = sum(given) if given else None
        number = len(amounts) if specified else len(given)
        if total is not None:
            total = total.quantize(Decimal("0.01"), ROUND_HALF_UP)
        rows.add(("42", *key, total, number, amount_range(total, number, specified)))
    return rows
