"""The report's column rules as built-in expressions.

Each function maps columns to a column. All of them compile into the stage that
reads the data; none leaves the JVM.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymonth import lookups
from tallymonth.profiles import RuleProfile
from tallymonth.schemas import TOTAL_AMOUNT


def _translate(key: Column, table: dict[str, str], default: str) -> Column:
    """Look the key up in a small fixed table; null and unknown keys give the default."""
    pairs = ", ".join(f"'{value}', '{code}'" for value, code in table.items())
    return F.coalesce(F.try_element_at(F.expr(f"map({pairs})"), key), F.lit(default))


def _missing_if_blank(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


# A number in plain notation: its sign, whole part and decimals without idle zeros.
PLAIN_NUMBER = r"^\+?(-?)0*([0-9]+)(?:(\.[0-9]*[1-9])0*|\.0*)?$"


def category_key(identifier: Column) -> Column:
    """A category id in the form that equal ids share; null for a blank one.

    A number in plain notation counts by its value, so ``7``, ``007`` and ``7.0`` are the
    same id, however long it is. Any other text counts as it stands, trimmed.
    """
    text = F.trim(identifier.cast("string"))
    return _missing_if_blank(F.regexp_replace(text, PLAIN_NUMBER, "$1$2$3"))


def fi_code() -> Column:
    return F.lit(lookups.FI_CODE)


def month_end(date: Column) -> Column:
    """Last day of the month, as a date. Grouping on it is cheaper than on text."""
    return F.last_day(date)


def report_date(month_end_date: Column) -> Column:
    """The report's text form of a month end."""
    return F.date_format(month_end_date, "yyyy-MM-dd")


def service_system_type(payment_method: Column) -> Column:
    return _translate(payment_method, lookups.SERVICE_SYSTEM_TYPES, "")


def merchant_business_type(service_type: Column, card_brand: Column) -> Column:
    by_brand = _translate(card_brand, lookups.MERCHANT_BUSINESS_TYPES, "")
    return F.when(service_type == lookups.CARD_SERVICE, by_brand).otherwise(F.lit(""))


def merchant_category_code(
    service_type: Column, code: Column, blank_is_missing: bool = False
) -> Column:
    """The looked-up code; only card rows get the catch-all code in its absence."""
    if blank_is_missing:
        code = _missing_if_blank(code)
    catch_all = F.when(
        service_type == lookups.CARD_SERVICE, F.lit(lookups.UNKNOWN_MERCHANT_CATEGORY)
    )
    return F.coalesce(code, catch_all)


def card_country(issuer: Column) -> Column:
    """Local or foreign card. A missing issuer is foreign."""
    return F.when(issuer == lookups.LOCAL_ISSUER, F.lit(lookups.LOCAL)).otherwise(
        F.lit(lookups.INTER)
    )


def backend_transaction_type(backend: Column) -> Column:
    return _translate(
        backend, lookups.BACKEND_TRANSACTION_TYPES, lookups.UNKNOWN_TRANSACTION_TYPE
    )


def card_lookup_keys(
    profile: RuleProfile,
    payment_method: Column,
    card_type: Column,
    card_brand: Column,
    issuer: Column,
) -> tuple[Column, Column, Column]:
    """Keys (card type, country, brand) into the card transaction types.

    A key the profile rules out is null, and so matches nothing.
    """
    country = card_country(issuer)
    if not profile.missing_issuer_is_inter:
        country = F.when(_missing_if_blank(issuer).isNotNull(), country)

    brand = card_brand
    if profile.unlisted_brand_is_other:
        given = _missing_if_blank(card_brand)
        brand = F.when(given.isin(lookups.LISTED_BRANDS), given).when(
            given.isNotNull(), F.lit(lookups.OTHER_BRAND)
        )

    if not profile.card_table_for_all_methods:
        card_type = F.when(payment_method == lookups.CARD_METHOD, card_type)
    return card_type, country, brand


def transaction_type(
    profile: RuleProfile, payment_method: Column, backend: Column, card_code: Column
) -> Column:
    """The looked-up card code, or what the profile puts in its place."""
    by_card = F.coalesce(card_code, F.lit(lookups.UNKNOWN_TRANSACTION_TYPE))
    if profile.card_table_for_all_methods:
        return by_card
    return F.when(payment_method == lookups.CARD_METHOD, by_card).otherwise(
        backend_transaction_type(backend)
    )


def total_amount(amount: Column) -> Column:
    """A sum as the report states it, in cents."""
    return F.round(amount, 2).cast(TOTAL_AMOUNT)


def amount_text(profile: RuleProfile, amount: Column) -> Column:
    """A total as the monthly files print it, with two decimals or at least one."""
    text = amount.cast("string")
    return text if profile.prints_two_decimals else F.regexp_replace(text, "0$", "")


def average_amount(amount: Column, number: Column) -> Column:
    """Total over count, rounded half-up to cents, without an inexact step.

    Dividing decimals would round to some scale first and then again to cents.
    Whole-number division of cents does it once: floor((2*|cents| + n) / (2*n)).
    Null where nothing was counted.
    """
    cents = F.abs(amount * 100)
    counted = F.nullif(number, F.lit(0)).cast("decimal(20,0)")
    rounded = F.call_function("div", 2 * cents + counted, 2 * counted)
    signed = F.when(amount < 0, -rounded).otherwise(rounded)
    return (signed.cast("decimal(20,0)") / 100).cast("decimal(20,2)")


def terminal_average_amount_range(
    profile: RuleProfile, amount: Column, number: Column
) -> Column:
    """Range code of the average amount; null for a group without any amount.

    The comparison is multiplied out, so nothing is divided or rounded: an
    average rounds to at most the bound exactly if it is less than half a cent
    above it. Dividing once per bound would also make the generated method too
    long for the JVM to compile.
    """

    def within(bound: int) -> Column:
        if profile.rounds_average_before_range:
            return amount < number * F.lit(bound + Decimal("0.005"))
        return amount <= number * F.lit(Decimal(bound))

    case = F.when(amount.isNull(), F.lit(None).cast("string"))
    for bound, code in lookups.AMOUNT_RANGES:
        case = case.when(within(bound), F.lit(code))
    return case.otherwise(F.lit(lookups.TOP_AMOUNT_RANGE))


def report_file_stem(month_end_date: Column) -> Column:
    """File name without extension. Rows without a date go to a file of their own."""
    stamp = F.coalesce(F.date_format(month_end_date, "yyyyMMdd"), F.lit("UNDATED"))
    return F.concat(F.lit(lookups.REPORT_FILE_PREFIX), stamp)


def report_file_name(month_end_date: Column) -> Column:
    return F.concat(report_file_stem(month_end_date), F.lit(".csv"))
