"""Money expressions. Stored money is whole kobo; naira appears only at the edge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the fee schedule, in kobo.
TRANSFER_PER_MILLE = 5
TRANSFER_MIN = 5_000
TRANSFER_MAX = 100_000
DEFAULT_PER_MILLE = 15
FLAT_FEE = 10_000
FLAT_FEE_ABOVE = 250_000
DEFAULT_MAX = 200_000


def _div(left: Column, right: int) -> Column:
    return F.call_function("div", left, F.lit(right).cast("long"))


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def naira(kobo: Column) -> Column:
    """Kobo as naira, double, for reports."""
    return kobo.cast("double") / F.lit(100.0)


def format_naira(kobo: Column) -> Column:
    """Exact text such as 1,234,567.89, without passing through a float."""
    size = F.abs(kobo)
    return F.concat(
        F.when(kobo < 0, "-").otherwise(""),
        F.format_number(_div(size, 100), 0),
        F.lit("."),
        F.lpad((size % 100).cast("string"), 2, "0"),
    )


def fee_kobo(amount: Column, channel: Column) -> Column:
    """Bank transfers pay a clamped share, every other channel a capped share plus a flat part."""
    transfer = F.least(
        F.greatest(_div(amount * TRANSFER_PER_MILLE, 1000), _long(TRANSFER_MIN)),
        _long(TRANSFER_MAX),
    )
    flat = F.when(amount > FLAT_FEE_ABOVE, _long(FLAT_FEE)).otherwise(_long(0))
    other = F.least(_div(amount * DEFAULT_PER_MILLE, 1000) + flat, _long(DEFAULT_MAX))
    return F.when(channel == "bank_transfer", transfer).otherwise(other)


def to_ngn_kobo(kobo: Column, currency: Column, fx: Column) -> Column:
    """USD converts at the row's rate and truncates to whole kobo; a missing rate gives 0."""
    converted = (kobo * F.coalesce(fx, F.lit(0.0))).cast("long")
    return F.when(currency == "USD", converted).otherwise(kobo)


def round_to(value: Column, digits: int) -> Column:
    """Round the scaled double, half away from zero, as SQL engines on doubles do. Rounding
    the decimal text instead would differ where a tie is not a double."""
    scale = F.lit(float(10**digits))
    return F.round(value * scale) / scale


def rate(part: Column, whole: Column, digits: int) -> Column:
    """Guarded ratio: null when there is nothing to divide by."""
    return round_to(F.try_divide(part.cast("double"), whole.cast("double")), digits)
