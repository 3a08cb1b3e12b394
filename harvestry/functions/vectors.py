"""Vector expressions on array columns: built-in higher-order functions, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def doubles(v: Column | str) -> Column:
    return _col(v).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, z: s + z)


def squared_l2(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, z: s + z)


def l2(a: Column | str, b: Column | str) -> Column:
    return F.sqrt(F.greatest(squared_l2(a, b), F.lit(0.0)))


def norm(v: Column | str) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column | str) -> Column:
    """v over its norm; a zero vector stays zero. The norm is the element of an array of one, so that it is computed once for a row and not for each number."""
    own = doubles(v)
    return F.transform(F.array(norm(v)), lambda n: F.when(n == 0, own).otherwise(F.transform(own, lambda x: x / n)))[0]


def cosine(a: Column | str, b: Column | str) -> Column:
    """Null if either vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def concat_features(*parts: Column | str) -> Column:
    """Features of several encoders or layers, one after the other."""
    return F.concat(*(doubles(p) for p in parts))


def soft_content_score(image: Column | str, prompts: list[list[float]], positive: int) -> Column:
    """Softmax of the image's similarities to the prompts; the largest share of the first `positive` ones."""
    sims = F.array(*(dot(image, F.array(*(F.lit(float(x)) for x in p))) for p in prompts))
    powers = F.transform(sims, lambda s: F.exp(s - F.array_max(sims)))
    total = F.aggregate(powers, F.lit(0.0), lambda s, z: s + z)
    return F.array_max(F.slice(powers, 1, positive)) / total
