"""Vector expressions over ARRAY<FLOAT|DOUBLE> columns (higher-order functions).

Spark 4.1 has no vector type for SQL arrays; these stay in code-generated
higher-order functions and compute in DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _dbl(c) -> Column:
    return F.transform(_c(c), lambda x: x.cast("double"))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_dbl(a), _dbl(b), lambda x, y: x * y),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(_dbl(a), lambda x: x * x),
                              F.lit(0.0).cast("double"), lambda acc, x: acc + x))


def cosine(a, b) -> Column:
    """1 - scipy cosine distance; NULL when either side has zero norm."""
    na, nb = norm(a), norm(b)
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb))


def l2_normalize_expr(a) -> Column:
    """F.normalize(p=2): x / max(||x||, eps).  The vector and its norm are bound once: a norm
    named inside the division would be summed anew for every component."""
    def scaled(v):
        return F.transform(F.array(F.greatest(norm(v), F.lit(1e-12))), lambda n: F.transform(v, lambda x: x / n))[0]
    return F.transform(F.array(_dbl(a)), scaled)[0]
