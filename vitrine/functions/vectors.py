"""Vector expressions (H17) in the JVM (higher-order functions run interpreted, row by row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions._util import as_col


def dot(u, v) -> Column:
    """Sum of element products, accumulated in double."""
    prods = F.zip_with(as_col(u), as_col(v), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def norm(u) -> Column:
    u = as_col(u)
    return F.sqrt(F.aggregate(u, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def normalise(u) -> Column:
    """Unit vector in double; a zero vector stays zero.

    The squared norm is the aggregate's accumulator and the division runs in
    its finish step, so the norm is computed once per row rather than once
    per element (an expression captured in a lambda is re-evaluated for
    every element)."""
    u = as_col(u)
    return F.aggregate(
        u,
        F.lit(0.0),
        lambda acc, x: acc + x.cast("double") * x.cast("double"),
        lambda acc: F.transform(u, lambda x: F.when(acc == 0, F.lit(0.0)).otherwise(x.cast("double") / F.sqrt(acc))),
    )


def cosine(u, v) -> Column:
    """Cosine similarity; a zero vector scores 0 against anything."""
    nu, nv = norm(u), norm(v)
    return F.when((nu == 0) | (nv == 0), F.lit(0.0)).otherwise(dot(u, v) / (nu * nv))
