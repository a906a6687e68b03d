"""Null-safe text parsing used by the gates and the clean projections.

Everything is a native expression, so it stays inside whole-stage code generation. `try_cast` never raises,
whatever the ANSI setting is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Business id formats.
ID_PATTERNS = {
    "customer_id": r"^CUST[0-9]{6}$",
    "restaurant_id": r"^REST[0-9]{5}$",
    "delivery_partner_id": r"^DP[0-9]{5}$",
    "menu_item_id": r"^MENU[0-9]{5}_[0-9]{4}$",
    "order_id": r"^ORD[0-9]{12}$",
    "order_item_id": r"^ITE[0-9]{15}$",
    "delivery_id": r"^DEL[0-9]{12}$",
    "rating_id": r"^RAT[0-9]{12}$",
}
PLAIN_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"


def text(name: str) -> Column:
    return F.trim(F.col(name))


def blank(name: str) -> Column:
    return F.coalesce(F.length(text(name)) == 0, F.lit(True))


def key_text(name: str) -> Column:
    return F.upper(text(name))


def well_formed(name: str, pattern_of: str | None = None) -> Column:
    return F.coalesce(text(name).rlike(ID_PATTERNS[pattern_of or name]), F.lit(False))


def plain_number(value: Column) -> Column:
    """The trimmed text where it is a number in plain decimal notation: no exponents, no special values."""
    return F.when(F.trim(value).rlike(PLAIN_NUMBER), F.trim(value))


def as_decimal(name: str, precision: int = 18, scale: int = 2) -> Column:
    """Plain decimal notation only: no exponents, no special values."""
    return plain_number(F.col(name)).try_cast(f"decimal({precision},{scale})")


def as_int(name: str) -> Column:
    return F.when(text(name).rlike(r"^[+-]?[0-9]+$"), text(name)).try_cast("int")


def as_whole(name: str) -> Column:
    """Two steps: text to decimal (rounded to cents), then truncated to an integer."""
    return as_decimal(name).try_cast("int")


def as_date(name: str, day_first: bool = False) -> Column:
    """Month-first slashes, optionally day-first dashes, then ISO."""
    formats = [F.try_to_date(text(name), "M/d/yyyy")]
    if day_first:
        formats.append(F.try_to_date(text(name), "d-M-yyyy"))
    return F.coalesce(*formats, text(name).try_cast("date"))


def as_timestamp(name: str) -> Column:
    return text(name).try_cast("timestamp_ntz")


def is_yes(name: str) -> Column:
    return F.coalesce(key_text(name) == "Y", F.lit(False))


def is_yes_or_no(name: str) -> Column:
    return F.coalesce(key_text(name).isin("Y", "N"), F.lit(False))


def or_unknown_name(name: str) -> Column:
    return F.when(blank(name), F.lit("UNKNOWN NAME")).otherwise(text(name))


def text_hash(column: Column) -> Column:
    """Review hash: SHA-256 of the lower-cased, space-trimmed text."""
    return F.sha2(F.lower(F.trim(column)), 256)
