"""Tolerance interval join of events to spans.

An event row matches a span row when the equi keys are equal and

    ts - start >= -tolerance   and   end - ts >= -tolerance

(both inclusive).  With ``by_key``, and where every key has at most ``FEW_SPANS`` spans (an
admission's stays), the equi keys alone make the join: an event is moved once,
or not at all where it already lies by its key, and meets no more spans than
that.  Otherwise time is cut into buckets on several levels, each
``FACTOR`` times as wide as the one below.  A span, with its tolerance, goes
to the lowest level whose buckets are as wide as the span is long, so it lies
in two buckets there at most, however long it is; an event looks into one
bucket of every level that any span is on (mostly one or two).  Level and
bucket join the equi keys, so an event meets only spans of its key near it,
each once, and work stays near-linear in a key's history; the range residual
then decides.  Rows with NULL keys or NULL times never match.  An event may
match several spans (e.g. two stays of one admission), in which case it is
emitted once per span (Q19).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.timecols import US_PER_SECOND, epoch_micros

#: Width of the narrowest time buckets: a week, the order of a stay's length.
BUCKET_SECONDS = 7 * 86400
#: Each level's buckets are so many times as wide as those of the level below.
FACTOR_BITS = 4
FACTOR = 1 << FACTOR_BITS
#: Spans that a key may have for its events to be joined without buckets.
FEW_SPANS = 16


def span_level(length: Column, width: int) -> Column:
    """The lowest level whose buckets (``width`` microseconds wide at level 0)
    are at least ``length`` microseconds wide."""
    above = []
    while width < 1 << 62:
        above.append(F.when(length > width, 1).otherwise(0))
        width <<= FACTOR_BITS
    return sum(above[1:], above[0])


def _bucket(micros: Column, width: int, level: Column) -> Column:
    return F.floor(micros / F.call_function("shiftleft", F.lit(width), level * FACTOR_BITS))


def _crowded(spans: DataFrame, keys: list[str]) -> bool:
    """Whether a key has more than ``FEW_SPANS`` spans (partial counts before
    the shuffle; only the keys move)."""
    return not spans.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > FEW_SPANS).isEmpty()


def interval_join(events: DataFrame, spans: DataFrame, on: str | list[str],
                  ts: str = "charttime", start: str = "intime", end: str = "outtime",
                  tolerance_seconds: float = 3600, span_columns: list[str] | None = None,
                  salt: int = 1, bucket_seconds: float = BUCKET_SECONDS, by_key: bool = False) -> DataFrame:
    """Inner interval join.

    ``span_columns`` are the span-side columns to carry (besides ``start`` and
    ``end``); a span column that also exists on the event side replaces it
    only when listed here, so C3 (stay id from the span) and C4 (stay id kept
    from the event) are the same call with different ``span_columns``.

    ``by_key`` is for keys that mostly have few spans: one count of the spans
    by key, run here, tells whether any has more than ``FEW_SPANS``, and if
    none has, the keys alone are joined.  Otherwise the levels in use come from one aggregate over
    the spans (a scalar subquery of a few small numbers).  Skew: a key holding
    a large share of the events is split by its time buckets if it has many
    spans, a key of few spans or a hot bucket by AQE's skew join.  ``salt > 1`` splits it
    explicitly instead (for sessions without AQE): each event gets a deterministic salt in
    [0, salt) from a hash of its row, each span row is repeated once per salt
    value, and the salt joins the equi keys, so a hot key's events spread
    over ``salt`` tasks while every event still meets every span of its
    bucket.  ``bucket_seconds`` should be near a typical span's length;
    longer spans go to wider buckets.
    """
    on = [on] if isinstance(on, str) else list(on)
    span_columns = list(span_columns or [])
    tol = F.lit(int(round(tolerance_seconds * US_PER_SECOND)))
    carry = [c for c in [start, end] + span_columns if c not in on]
    carry = list(dict.fromkeys(carry))
    # NULL keys match nothing; without them here, the join and the levels below read the spans by one plan
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    s = spans.where(known).select(*[F.col(k).alias(f"__k_{k}") for k in on],
                                  *[F.col(c).alias(f"__s_{c}") for c in carry])
    ev = events.drop(*[c for c in carry if c in events.columns])
    out_cols = list(ev.columns)
    width = int(round(bucket_seconds * US_PER_SECOND))
    lo = epoch_micros(F.col(f"__s_{start}")) - tol
    hi = epoch_micros(F.col(f"__s_{end}")) + tol
    # NULL times match nothing, nor do spans that end before they start
    s = s.where(lo <= hi)
    equal = list(on)
    if not by_key or _crowded(s, [f"__k_{k}" for k in on]):
        s = s.withColumn("__k___level", span_level(hi - lo, width))
        levels = s.agg(F.collect_set("__k___level").alias("levels"))
        first, last = _bucket(lo, width, F.col("__k___level")), _bucket(hi, width, F.col("__k___level"))
        s = s.withColumn("__k___bucket", F.explode(F.when(first < last, F.array(first, last)).otherwise(F.array(first))))
        ev = ev.withColumn("__levels", levels.scalar()).withColumn("__level", F.explode_outer("__levels")).drop("__levels")
        ev = ev.withColumn("__bucket", _bucket(epoch_micros(F.col(ts)), width, F.col("__level")))
        equal += ["__level", "__bucket"]
    if salt > 1:
        equal.append("__salt")
        ev = ev.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in out_cols]),
                                            F.lit(salt)))
        s = s.withColumn("__k___salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                            F.lit(salt - 1).cast("long"))))
    cond = [F.col(k) == F.col(f"__k_{k}") for k in equal]
    t = epoch_micros(F.col(ts))
    cond += [t >= lo, t <= hi]
    joined = ev.join(s, cond, "inner")
    return joined.select(*out_cols, *[F.col(f"__s_{c}").alias(c) for c in carry])
