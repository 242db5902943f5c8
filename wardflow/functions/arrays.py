"""Array-column maths for sequence preparation.

All higher-order functions (transform / filter / aggregate / zip_with) run
inside the JVM with codegen; no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pad(seq, n: int, value=0) -> Column:
    """K3: left-pad with ``value`` to length ``n``; longer sequences keep their
    last ``n`` elements (pre-padding, pre-truncation)."""
    s = _c(seq)
    size = F.size(s)
    head = F.array_repeat(F.lit(value), F.greatest(F.lit(n) - size, F.lit(0)))
    tail = F.slice(s, F.greatest(size - F.lit(n), F.lit(0)) + 1, F.lit(n))
    return F.concat(head, tail)


def pad_vectors(seq, n: int, width: int) -> Column:
    """K3 for a sequence of vectors: left-pad with zero vectors of ``width``."""
    s = _c(seq)
    size = F.size(s)
    zero = F.array_repeat(F.lit(0.0), width)
    head = F.array_repeat(zero, F.greatest(F.lit(n) - size, F.lit(0)))
    tail = F.slice(s, F.greatest(size - F.lit(n), F.lit(0)) + 1, F.lit(n))
    return F.concat(head, tail)


def delta_pairs(seq) -> Column:
    """Non-overlapping step pairs (x0, x1), (x2, x3), ...  as an array
    of structs ``(first, second)``; an odd length is an error."""
    s = _c(seq)
    even = F.filter(s, lambda x, i: i % 2 == 0)
    odd = F.filter(s, lambda x, i: i % 2 == 1)
    checked = F.when(F.size(s) % 2 == 0, F.arrays_zip(even.alias("first"), odd.alias("second"))) \
               .otherwise(F.raise_error(F.lit("delta_pairs needs an even-length sequence")))
    return checked


def array_sum(arr) -> Column:
    return F.aggregate(_c(arr), F.lit(0.0), lambda acc, x: acc + x)


def softmax(arr) -> Column:
    """K6: numerically stable softmax (the max is subtracted first)."""
    a = _c(arr)
    m = F.array_max(a)
    e = F.transform(a, lambda x: F.exp(x - m))
    s = array_sum(e)
    return F.transform(e, lambda x: x / s)


def hadamard(a, b) -> Column:
    """K6: elementwise product."""
    return F.zip_with(_c(a), _c(b), lambda x, y: x * y)


def dot(a, weights) -> Column:
    """``sum(a_i * w_i)`` with ``weights`` a column or a Python list."""
    w = F.array(*[F.lit(float(v)) for v in weights]) if isinstance(weights, (list, tuple)) \
        else _c(weights)
    return array_sum(hadamard(_c(a), w))


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def halves(arr, width: int) -> tuple[Column, Column]:
    """The first and second ``width`` channels (c and h)."""
    a = _c(arr)
    return F.slice(a, 1, width), F.slice(a, width + 1, width)


def repeat_concat(arr, times: int) -> Column:
    """``concat(a, a, ..., a)``."""
    a = _c(arr)
    return F.concat(*([a] * times))
