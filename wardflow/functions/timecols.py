"""Time arithmetic on timestamp_ntz columns.

Differences are taken in whole microseconds (exact long arithmetic) and only
then turned into seconds or window indexes, so window boundaries never
depend on double rounding of two ~1.7e9-second epochs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardflow.schemas import WINDOW_HOURS

US_PER_SECOND = 1_000_000
US_PER_HOUR = 3600 * US_PER_SECOND


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a timestamp or timestamp_ntz column
    (session time zone pinned to UTC by ``wardflow.session``)."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def epoch_seconds(ts) -> Column:
    """H2: ``date_part('epoch', ts)`` as a double with fractional seconds."""
    return epoch_micros(ts) / F.lit(1e6)


def diff_micros(ts, start) -> Column:
    """Signed ``ts - start`` in microseconds (long)."""
    return epoch_micros(ts) - epoch_micros(start)


def window_index(ts, start, hours: int) -> Column:
    """1-based stay-relative window, ``floor(|ts - start| / h) + 1``.

    ``abs`` mirrors events before ``start`` into the first windows, as the
    reference text does (Q8).  Returned as double like the reference.
    """
    if hours <= 0:
        raise ValueError("window size must be positive")
    width = F.lit(hours * US_PER_HOUR)
    return (F.floor(F.abs(diff_micros(ts, start)) / width) + 1).cast("double")


def hour_diff(ts, start) -> Column:
    """Signed hours from the start of ``start``'s clock hour (H3)."""
    return diff_micros(ts, F.date_trunc("hour", _c(start).cast("timestamp"))) / F.lit(float(US_PER_HOUR))


def window_column(hours: int) -> str:
    """E5: name of the precomputed window column for a size."""
    if hours not in WINDOW_HOURS:
        raise ValueError(f"window size must be one of {WINDOW_HOURS}, got {hours}")
    return f"tw_{hours}hr"


def add_windows(df, ts: str = "charttime", start: str = "intime",
                hours=WINDOW_HOURS, with_hour_diff: bool = True):
    """Add ``hour_diff`` and ``tw_{h}hr`` for each size in ``hours``."""
    cols = {}
    if with_hour_diff:
        cols["hour_diff"] = hour_diff(ts, start)
    for h in hours:
        cols[f"tw_{h}hr"] = window_index(ts, start, h)
    return df.withColumns(cols)


def add_micros(ts, micros) -> Column:
    """``ts + micros`` as timestamp_ntz (long microsecond offset)."""
    return F.timestamp_micros(epoch_micros(ts) + _c(micros)).cast("timestamp_ntz")
