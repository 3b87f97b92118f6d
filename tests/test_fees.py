"""Fee totals against brute force, and what their join is given."""

from __future__ import annotations

import datetime
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tallymonth.plans import fees

DAY = datetime.date(2018, 1, 20)
CENT = Decimal("0.01")


def day(number: int | None) -> datetime.date | None:
    return None if number is None else DAY + datetime.timedelta(days=number)


def brute_fees(rows: list, periods: list) -> dict:
    found = defaultdict(lambda: [None, 0])
    for date, amount, id_ in rows:
        for period, code, rate, start, end in periods:
            if (
                id_ is None or date is None or id_ != period
                or (start is not None and date < start) or (end is not None and date >= end)
                or (start is not None and end is not None and end <= start)
            ):
                continue
            month = (date.replace(day=28) + datetime.timedelta(days=4)).replace(day=1)
            total = found[month - datetime.timedelta(days=1), code]
            total[1] += 1
            if amount is not None and rate is not None:
                fee = (amount * rate).quantize(CENT, ROUND_HALF_UP)
                total[0] = fee + (total[0] or 0)
    return {key: tuple(value) for key, value in found.items()}


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("amounts", ["decimal(18,2)", "decimal(28,6)"])
def test_fee_totals_are_brute_force(spark, small: bool, amounts: str) -> None:
    random.seed(3)
    scale = int(amounts[-2])
    # Ties of both signs, numbers without last digits, nulls and large numbers.
    picked = ["0", "0.5", "-0.5", "100", "-300", "12.34", "-99.99", "9999999999.99", "0.01", "50.05"]
    rates = ["0", "0.01", "-0.01", "0.03", "0.0001", "-0.4999", "0.5", "99.9999", "1"]

    def amount() -> Decimal | None:
        if random.random() < 0.1:
            return None
        return Decimal(random.choice(picked)) + random.randrange(300) * Decimal(1).scaleb(-scale)

    rows = [(day(random.choice([None, *range(25)])), amount(), random.choice([1, 1, 2, 3, None])) for _ in range(400)]
    rows += rows[:40]
    # One category with amounts, but none known.
    rows += [(day(60), None, 4)] * 3
    periods = []
    for i in range(60):
        start, length = random.choice([None, *range(-30, 25)]), random.choice([None, -1, 0, 1, 7, 40])
        end = None if length is None else (start or 0) + length
        rate = random.choice([None, *map(Decimal, rates)])
        periods.append((random.choice([1, 2, 4, None]), random.choice(["a", "b", None]), rate, day(start), day(end)))
    periods += periods[:5] + [(4, "unknown", Decimal("0.5"), None, None), (1, "free", Decimal(0), None, None)]
    found = fees.fee_totals(
        spark.createDataFrame(rows, f"date date, amount {amounts}, merchant_category_id int"),
        spark.createDataFrame(periods, "id int, fee_code string, rate decimal(6,4), starts date, ends date"),
        small,
    )
    got = {(r.month, r.fee_code): (r.fees, r.records) for r in found.collect()}
    expected = brute_fees(rows, periods)
    assert got == expected
    assert None in {total for total, _ in expected.values()}


def test_pairs_of_transactions_and_periods_are_not_listed(spark, monkeypatch) -> None:
    pairs = []
    join = fees.dimensions.with_fee_periods

    def counted(*args, **options):
        pairs.append(join(*args, **options))
        return pairs[-1]

    monkeypatch.setattr(fees.dimensions, "with_fee_periods", counted)
    rows = spark.range(5000).selectExpr(
        "date_add(DATE'2018-01-01', CAST(id % 2 AS INT)) AS date",
        "CAST(id / 100 AS DECIMAL(18,2)) AS amount", "1 AS merchant_category_id",
    )
    periods = spark.range(200).selectExpr(
        "1 AS id", "'a' AS fee_code", "CAST(id % 3 / 1000 AS DECIMAL(6,4)) AS rate",
        "CAST(NULL AS DATE) AS starts", "CAST(NULL AS DATE) AS ends",
    )
    (total,) = fees.fee_totals(rows, periods, True).collect()
    assert total.records == 5000 * 200
    assert [frame.count() for frame in pairs] == [2 * 200]
