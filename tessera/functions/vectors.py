"""Vector column math on ARRAY<FLOAT|DOUBLE>.

Accumulation is always in double.  Division uses ``try_divide`` so that a zero
norm gives NULL (ANSI mode raises on plain division by zero).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v) -> Column:
    return F.transform(_c(v), lambda x: x.cast("double"))


def dot(a, b) -> Column:
    """M1."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda s, v: s + v)


def norm(a) -> Column:
    """M2."""
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0).cast("double"),
                              lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine_distance(a, b, norm_a=None, norm_b=None) -> Column:
    """M3: 1 - cos; NULL when a norm is zero."""
    na = _c(norm_a) if norm_a is not None else norm(a)
    nb = _c(norm_b) if norm_b is not None else norm(b)
    return F.lit(1.0) - F.try_divide(dot(a, b), na * nb)


def concat_layers(fwd, bwd) -> Column:
    """Forward and backward halves into one layer vector."""
    return F.concat(_c(fwd), _c(bwd))


def zeros(dim) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)
