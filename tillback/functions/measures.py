"""Amounts, rates and flags as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillback.domains import DAMAGE_WORDS, RETURN_WINDOW_DAYS

MONEY_TOTAL = "decimal(22,2)"
UNIT_TOTAL = "decimal(20,0)"
RATE = "decimal(10,4)"


# --- strict lane (decimals) -------------------------------------------------------------------

def quotient(numerator: Column, denominator: Column, numerator_scale: int = 0) -> Column:
    """Decimal quotient, null for a zero denominator.

    The warehouse this lane reproduces keeps six digits more than the numerator has, so the value
    is rounded there first; that is visible in about one four-digit rate out of two hundred.
    """
    exact = numerator / F.nullif(denominator, F.lit(0))
    return exact.cast(f"decimal(30,{numerator_scale + 6})")


def rate(numerator: Column, denominator: Column, numerator_scale: int = 0) -> Column:
    return quotient(numerator, denominator, numerator_scale).cast(RATE)


def count_rate(numerator: Column, denominator: Column) -> Column:
    """Rate of two whole numbers."""
    return rate(numerator.cast(UNIT_TOTAL), denominator.cast(UNIT_TOTAL))


def or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def settled(condition: Column) -> Column:
    """A condition whose unknown outcome counts as false."""
    return F.coalesce(condition, F.lit(False))


def any_true(flag: Column) -> Column:
    """True when the flag holds anywhere in the group; false for a group without a true value."""
    return F.count_if(flag) > 0


# --- lenient lane (doubles, nulls kept) -------------------------------------------------------

def safe_rate(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, F.round(numerator / denominator, 4))


def rounded_sum(column: str) -> Column:
    return F.round(F.sum(column), 2)


# --- shared -----------------------------------------------------------------------------------

def days_between(start: str, end: str) -> Column:
    return F.datediff(F.col(end), F.col(start))


def is_late(days: Column) -> Column:
    return days > RETURN_WINDOW_DAYS


def is_damaged(condition: Column, reason: Column, *, inside_words: bool) -> Column:
    """Damage by item condition or return reason; ``inside_words`` also finds it within the reason."""
    by_reason = reason.rlike("|".join(DAMAGE_WORDS)) if inside_words else reason.isin(DAMAGE_WORDS)
    return settled(condition.isin(DAMAGE_WORDS) | by_reason)
