"""Price text to number, one rule per kind of page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, matched, number, strip

# Fixed values.
NO_PRICE = "0.00"
EUR_TO_SAR = 4.39


def clean_price(text: Column) -> Column:
    """``'SAR 1,234.50'`` -> 1234.5; NULL when no number is left."""
    bare = F.replace(F.replace(text, F.lit("SAR"), F.lit("")), F.lit(","), F.lit(""))
    return number(bare)


def whole_and_fraction(whole: Column, fraction: Column) -> Column:
    """Join ``'1,299.'`` and ``'50'``; the fraction may be missing."""
    integer = F.rtrim(F.replace(whole, F.lit(","), F.lit("")), F.lit("."))
    return F.when(
        F.length(whole) > 0,
        F.when(F.length(fraction) > 0, F.concat_ws(".", integer, fraction)).otherwise(integer),
    )


def after_sar(text: Column) -> Column:
    """Digits after the currency marker."""
    return F.replace(matched(text, r"(?i)SAR\s*([\d.,]+)"), F.lit(","), F.lit(""))


def two_decimals(text: Column) -> Column:
    """A price is only accepted with exactly two decimals."""
    return F.replace(matched(text, r"([\d,]+\.\d{2})"), F.lit(","), F.lit(""))


def integer_price(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(""))


def superscript_price(text: Column, sup: Column) -> Column:
    """Digits whose tail sits in a <sup>; whole numbers get '.00'."""
    parts = F.struct(
        F.regexp_replace(text, r"\D", "").alias("digits"),
        F.regexp_replace(F.coalesce(sup, F.lit("")), r"\D", "").alias("cents"),
    )

    def joined(p: Column) -> Column:
        digits, cents = p["digits"], p["cents"]
        has_cents = F.length(cents) > 0
        split_off = has_cents & F.endswith(digits, cents) & (F.length(digits) > F.length(cents))
        head = F.substring(digits, F.lit(1), F.length(digits) - F.length(cents))
        integer = F.when(split_off, head).otherwise(digits)
        return F.when(
            F.length(digits) > 0,
            F.concat(integer, F.lit("."), F.when(has_cents, cents).otherwise("00")),
        )

    return let(parts, joined)


def euro_price(text: Column, rate: float = EUR_TO_SAR) -> Column:
    """Euro text (',' is a thousands mark) to riyal, rounded to cents."""
    bare = F.replace(F.replace(strip(text), F.lit("€"), F.lit("")), F.lit(","), F.lit(""))
    return F.round(number(bare) * F.lit(rate), 2)


def per_unit(price: Column, size: Column) -> Column:
    """price / size; NULL instead of infinity or an error."""
    return F.try_divide(price, size)
