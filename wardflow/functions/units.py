"""Plausibility filters, unit harmonisation and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def plausible(v, lo: float | None = None, hi: float | None = None) -> Column:
    """Not null and within the inclusive bounds given."""
    v = _c(v)
    cond = v.isNotNull()
    if lo is not None:
        cond = cond & (v >= F.lit(float(lo)))
    if hi is not None:
        cond = cond & (v <= F.lit(float(hi)))
    return cond


def normalize_fio2(v) -> Column:
    """Percent stays, a fraction becomes percent, anything else NULL."""
    v = _c(v)
    return (F.when(v.between(20.0, 100.0), v)
             .when(v.between(0.2, 1.0), v * F.lit(100.0)))


def normalize_temp(v) -> Column:
    """Celsius stays, Fahrenheit is converted, anything else NULL."""
    v = _c(v)
    return (F.when(v.between(20.0, 50.0), v)
             .when(v.between(68.0, 122.0), (v - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)))


def ml_to_l(v) -> Column:
    """Millilitres to litres."""
    return _c(v) / F.lit(1000.0)


def value_text(v, decimals: int = 3) -> Column:
    """H7: display text of a number, at most ``decimals`` places, trailing
    zeros and a trailing point removed (``12``, ``0.5``, ``37.778``).

    The text is never read back by any operator; it is kept for parity with
    the reference's ``cvalue`` column.
    """
    v = _c(v)
    fixed = F.format_string(f"%.{decimals}f", v)
    text = F.regexp_replace(F.regexp_replace(fixed, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(v.isNotNull(), text)
