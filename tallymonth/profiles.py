"""Rule profiles: the two readings of the report's rules.

The written specification and the behaviour in production differ in a few
points. Both are supported; one pipeline runs either, driven by these switches.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RuleProfile:
    """Where the two readings of the rules part.

    card_table_for_all_methods: look every row up in the card table; otherwise
        only card payments, and the rest by backend.
    missing_issuer_is_inter: a missing issuer country counts as foreign;
        otherwise the transaction type is unknown.
    unlisted_brand_is_other: a brand outside the card table uses its "other"
        rows; otherwise only the literal value does.
    blank_category_code_is_missing: a blank category code counts as none.
    counts_missing_amounts: ``number`` counts records; otherwise only those with
        an amount.
    rounds_average_before_range: the average is rounded to cents before the
        range is chosen; otherwise the exact quotient decides.
    prints_two_decimals: the monthly files print 100.50; otherwise a last zero is
        left off, 100.5, as for a floating-point number.
    """

    name: str
    card_table_for_all_methods: bool
    missing_issuer_is_inter: bool
    unlisted_brand_is_other: bool
    blank_category_code_is_missing: bool
    counts_missing_amounts: bool
    rounds_average_before_range: bool
    prints_two_decimals: bool


AS_IMPLEMENTED = RuleProfile(
    name="as_implemented",
    card_table_for_all_methods=True,
    missing_issuer_is_inter=True,
    unlisted_brand_is_other=False,
    blank_category_code_is_missing=False,
    counts_missing_amounts=False,
    rounds_average_before_range=True,
    prints_two_decimals=False,
)

AS_SPECIFIED = RuleProfile(
    name="as_specified",
    card_table_for_all_methods=False,
    missing_issuer_is_inter=False,
    unlisted_brand_is_other=True,
    blank_category_code_is_missing=True,
    counts_missing_amounts=True,
    rounds_average_before_range=False,
    prints_two_decimals=True,
)

PROFILES = {profile.name: profile for profile in (AS_IMPLEMENTED, AS_SPECIFIED)}
