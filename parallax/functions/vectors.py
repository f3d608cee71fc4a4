"""Vector Column helpers over array<double>.

Everything is a higher-order array expression (transform / zip_with / aggregate), so
it stays in the JVM with no Python (these functions run outside generated code).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: position-table length, normalization epsilon, frequency base
MAX_POSITIONS = 80
NORM_EPS = 1e-6
FREQ_BASE = 10000.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v) -> Column:
    return _c(v).cast("array<double>")


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def vsum(v) -> Column:
    return F.aggregate(_c(v), F.lit(0.0), lambda acc, x: acc + x)


def scale(v, s) -> Column:
    return F.transform(_c(v), lambda x: x * s)


def add(a, b) -> Column:
    """H16 residual add."""
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


def relu(v) -> Column:
    """H16 rectifier."""
    return F.transform(_c(v), lambda x: F.greatest(x, F.lit(0.0)))


def position_value(pos, dim, d_model: int, variant: str = "a") -> Column:
    """H8 (variant a): column j uses exponent 2j/d, sine on even and cosine on odd j.
    H9 (variant b, standard): exponent 2*floor(j/2)/d."""
    pos, dim = _c(pos).cast("double"), _c(dim)
    if variant == "a":
        angle = pos / F.pow(F.lit(FREQ_BASE), F.lit(2.0) * dim.cast("double") / F.lit(float(d_model)))
    else:
        angle = pos * F.exp((F.lit(2.0) * F.floor(dim / 2).cast("double")) * F.lit(-math.log(FREQ_BASE) / d_model))
    return F.when(dim % 2 == 0, F.sin(angle)).otherwise(F.cos(angle))


def position_vector(pos, d_model: int, variant: str = "a") -> Column:
    """The position table row for ``pos`` as array<double>, computed in-row (no join)."""
    return F.transform(F.sequence(F.lit(0), F.lit(d_model - 1)),
                       lambda j: position_value(pos, j, d_model, variant))


def layer_norm(v, eps: float = NORM_EPS, alpha: float = 1.0, bias: float = 0.0) -> Column:
    """Alpha * (x - mean) / (std_{n-1} + eps) + bias per vector.

    The per-vector statistics enter the element lambdas through ``array_repeat`` (an
    argument evaluated once per row), so the optimizer cannot inline an O(n) aggregate
    into an O(n) loop.  An empty vector stays empty; a vector of one value, which has no
    deviation, gives null."""
    v = _c(v)
    n = F.size(v)
    mean = F.try_divide(vsum(v), n.cast("double"))
    dev = F.zip_with(v, F.array_repeat(mean, n), lambda x, m: x - m)
    std = F.sqrt(F.try_divide(F.aggregate(dev, F.lit(0.0), lambda acc, x: acc + x * x), n.cast("double") - 1))
    return F.zip_with(dev, F.array_repeat(std, n),
                      lambda x, sd: F.lit(alpha) * x / (sd + F.lit(eps)) + F.lit(bias))
