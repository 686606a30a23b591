"""Column functions over vectors, native and in double precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions.text import let


def finite(v: Column) -> Column:
    """Not null, and without a null or non-finite component."""
    return F.coalesce(F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))


def usable(v: Column) -> Column:
    """Finite, not empty and not zero."""
    return finite(v) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def inner_product(a: Column, b: Column) -> Column:
    """Sum of the products in the order of the components."""
    return _sum(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y))


def norm(v: Column) -> Column:
    """Euclidean norm, without overflow where it is finite."""
    x = v.cast("array<double>")
    return let(F.array_max(F.transform(x, F.abs)), lambda top: top * F.sqrt(_sum(F.transform(x, lambda y: (y / top) * (y / top)))))
