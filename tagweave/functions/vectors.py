"""Vector and logit maths as column expressions (one vector or one pair per row)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Logits:
    """Affine map from cosine to logit; ``log_scale`` is stored as the model stores it."""

    log_scale: float = math.log(10.0)
    bias: float = -2.5

    @property
    def scale(self) -> float:
        return math.exp(self.log_scale)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def doubles(v: Column | str) -> Column:
    return _col(v).cast("array<double>")


def l2_norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(_col(v), F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(v: Column | str) -> Column:
    """Unit vector; null for a zero vector.

    The norm is bound through a one-element array: named in the lambda directly, it would be
    computed again for each element.
    """
    v = _col(v)
    scaled = F.transform(F.array(l2_norm(v)), lambda n: F.transform(v, lambda x: F.try_divide(x, n)))
    defined = F.filter(scaled, lambda unit: F.forall(unit, lambda x: x.isNotNull()))
    return F.get(defined, F.lit(0))


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(_col(a), _col(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; null when either side is a zero vector."""
    return F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def log_sigmoid(x: Column) -> Column:
    """Stable for large negative x, where log(sigmoid(x)) would be log(0)."""
    return F.least(x, F.lit(0.0)) - F.log1p(F.exp(-F.abs(x)))


def logit(similarity: Column, logits: Logits = Logits()) -> Column:
    return similarity * F.lit(logits.scale) + F.lit(logits.bias)
