"""Dense-vector column functions (V1–V3) on ``array<float|double>`` columns.

All JVM-side higher-order functions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(u, v) -> Column:
    """V2: Σ u_i·v_i."""
    return F.aggregate(F.zip_with(_col(u), _col(v), lambda a, b: a.cast("double") * b.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def norm(u) -> Column:
    return F.sqrt(F.aggregate(_col(u), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(u, eps: float = 0.0) -> Column:
    """V1: u / (‖u‖ + eps). With eps = 0 a zero vector is left as is."""
    n = norm(u)
    if eps > 0:
        return F.transform(_col(u), lambda x: x.cast("double") / (n + F.lit(eps)))
    return F.when(n > 0, F.transform(_col(u), lambda x: x.cast("double") / n)).otherwise(
        F.transform(_col(u), lambda x: x.cast("double")))


def cosine(u, v) -> Column:
    """V2: cosine similarity, 0 when either norm is 0."""
    nu, nv = norm(u), norm(v)
    return F.when((nu > 0) & (nv > 0), dot(u, v) / (nu * nv)).otherwise(F.lit(0.0))


def pair_features(ucols, icols) -> dict[str, Column]:
    """V3: (cosine, L2 distance, mean absolute difference) over paired scalar
    columns ``uf_c`` ↔ ``c`` — one projection instead of a row loop."""
    us = [F.coalesce(_col(c).cast("double"), F.lit(0.0)) for c in ucols]
    vs = [F.coalesce(_col(c).cast("double"), F.lit(0.0)) for c in icols]
    if not us:
        z = F.lit(0.0)
        return {"cos_user_item": z, "l2_user_item": z, "absdiff_mean_user_item": z}
    dotp = sum((a * b for a, b in zip(us, vs)), F.lit(0.0))
    nu = F.sqrt(sum((a * a for a in us), F.lit(0.0)))
    nv = F.sqrt(sum((b * b for b in vs), F.lit(0.0)))
    l2 = F.sqrt(sum(((a - b) * (a - b) for a, b in zip(us, vs)), F.lit(0.0)))
    ad = sum((F.abs(a - b) for a, b in zip(us, vs)), F.lit(0.0)) / F.lit(float(len(us)))
    return {
        "cos_user_item": F.when((nu > 0) & (nv > 0), dotp / (nu * nv)).otherwise(F.lit(0.0)),
        "l2_user_item": l2,
        "absdiff_mean_user_item": ad,
    }
