"""Vector expressions on ``array<double>`` / ``array<float>`` columns.

All are higher-order SQL functions (``zip_with``, ``aggregate``, ``transform``), so they run inside
whole-stage code generation with no Python.  Arrays of floats are widened to double first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def to_float32(v: Column) -> Column:
    """narrow to ``array<float>``."""
    return v.cast("array<float>")


def sq_l2(a: Column, b: Column) -> Column:
    """F8: squared Euclidean distance.  Unequal lengths raise (``zip_with`` would pad with NULL)."""
    a, b = as_double(a), as_double(b)
    checked = F.when(F.size(a) == F.size(b), F.lit(True)).otherwise(
        F.raise_error(F.lit("vectors of different dimension")))
    total = F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x)
    return F.when(checked, total)


def l2(a: Column, b: Column) -> Column:
    """Euclidean distance."""
    return F.sqrt(sq_l2(a, b))


def distance(a: Column, b: Column, metric: str = "l2") -> Column:
    if metric == "l2":
        return l2(a, b)
    if metric == "sqeuclidean":
        return sq_l2(a, b)
    raise ValueError(f"unknown metric {metric!r}; choose 'l2' or 'sqeuclidean'")


def in_box(v: Column, q: Column, r) -> Column:
    """P10: every coordinate within ``r`` of the query (axis-aligned box ``q ± r``)."""
    r = r if isinstance(r, Column) else F.lit(float(r))
    return F.forall(F.zip_with(as_double(v), as_double(q), lambda x, y: F.abs(x - y) <= r), lambda ok: ok)


def pad_or_cut(v: Column, length: int) -> Column:
    """zero-pad or cut to exactly ``length`` values."""
    return F.slice(F.concat(as_double(v), F.array_repeat(F.lit(0.0), length)), 1, length)


def pad_or_cut_rows(m: Column, width: int) -> Column:
    """pad or cut every row of ``array<array<double>>`` to ``width``, then flatten row-major."""
    return F.flatten(F.transform(m, lambda row: pad_or_cut(row, width)))


def stack_rows(*blocks: Column) -> Column:
    """stack matrices (``array<array<double>>``) by rows."""
    return F.concat(*blocks)


def peak_normalize(v: Column) -> Column:
    """divide by the largest absolute value; an all-zero signal stays NULL-free zero."""
    v = as_double(v)
    peak = F.array_max(F.transform(v, lambda x: F.abs(x)))
    # the peak is spread into an array once; a lambda that referenced it would recompute it per element
    return F.zip_with(v, F.array_repeat(peak, F.size(v)), lambda x, p: F.coalesce(F.try_divide(x, p), F.lit(0.0)))


def full_windows(v: Column, width: int) -> Column:
    """consecutive windows of ``width`` values; a partial last window is dropped, a signal
    shorter than one window gives an empty array (an ascending ``sequence(0, -1)`` would count down)."""
    n_full = F.floor(F.size(v) / F.lit(width)).cast("int")
    idx = F.when(n_full > 0, F.sequence(F.lit(0), n_full - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(idx, lambda i: F.slice(v, i * width + 1, width))


def mean_rows(m: Column, width: int) -> Column:
    """A9 on one matrix: element-wise mean of the rows of ``array<array<double>>`` (rows of ``width``);
    an empty matrix gives NULL."""
    n = F.size(m)
    summed = F.aggregate(m, F.array_repeat(F.lit(0.0), width),
                         lambda acc, row: F.zip_with(acc, row, lambda a, b: a + b))
    return F.when(n > 0, F.transform(summed, lambda x: x / n))


def element(v: Column, i: int) -> Column:
    """0-based element access."""
    return F.element_at(v, i + 1)
