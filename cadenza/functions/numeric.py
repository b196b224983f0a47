"""Numeric and null rules (N1–N3, N8–N13) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c) -> Column:
    """text→number failures, NaN and NULL become 0.0 (ANSI-safe ``try_cast``)."""
    return F.coalesce(F.nanvl(_col(c).cast("string").try_cast("double"), F.lit(0.0)), F.lit(0.0))


def safe_id(c) -> Column:
    """Bad ids become -1; numbers that were read as floats lose their fraction, as an integer cast does."""
    s = _col(c).cast("string")
    return F.coalesce(s.try_cast("bigint"), s.try_cast("double").try_cast("bigint"), F.lit(-1).cast("bigint"))


def number(df: DataFrame, c: str) -> Column:
    """N1 by the column's type: numeric columns are cast, never turned into text."""
    if isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType)):
        return F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))
    return safe_double(c)


def safe_numeric(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: number(df, c) for c in cols if c in df.columns})


# The recognised boolean spellings and the share needed to accept them.
BOOL_TRUE = ("true", "yes", "y", "1")
BOOL_FALSE = ("false", "no", "n", "0")
BOOL_MIN_SHARE = 0.8


def boolize(df: DataFrame, cols) -> DataFrame:
    """Booleans become 1/0, and numeric columns stay as they are, NULL and NaN as 0.
    A text column gets a whole-column decision: if at least 80 % of the values
    (NULL counts as unrecognised) are a known boolean spelling, map them to 1/0 and
    the rest to 0; otherwise coerce to a number with 0 for failures.

    The decision is one global aggregate per column joined back as a broadcast
    scalar row (one row, proven size) — no driver-side branch.
    """
    known = list(BOOL_TRUE + BOOL_FALSE)
    typed = [c for c in cols if isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType))]
    df = safe_numeric(df, typed)
    cols = [c for c in cols if c not in typed]
    if not cols:
        return df
    share = df.agg(*[F.avg(F.coalesce(F.lower(F.col(c).cast("string")).isin(known), F.lit(False)).cast("double")).alias(f"__s_{c}")
                     for c in cols])
    from cadenza.plans.ordering import attach_scalars
    out = attach_scalars(df, share)  # one-row aggregate as a scalar subquery
    for c in cols:
        low = F.lower(F.col(c).cast("string"))
        mapped = F.when(low.isin(list(BOOL_TRUE)), F.lit(1.0)).when(low.isin(list(BOOL_FALSE)), F.lit(0.0)).otherwise(F.lit(0.0))
        out = out.withColumn(c, F.when(F.coalesce(F.col(f"__s_{c}"), F.lit(0.0)) >= BOOL_MIN_SHARE, mapped)
                             .otherwise(safe_double(c)))
    return out.drop(*[f"__s_{c}" for c in cols])


def clip01(c) -> Column:
    """Clip to [0, 1]."""
    return F.least(F.greatest(_col(c), F.lit(0.0)), F.lit(1.0))


def pop_blend(score, prior, blend: float) -> Column:
    """(1-b)·score + b·prior, b clipped to [0,1]; no-op when b is 0."""
    b = max(0.0, min(1.0, float(blend)))
    if b <= 0:
        return _col(score)
    return (1.0 - b) * _col(score) + b * F.coalesce(_col(prior), F.lit(0.0))


def alpha_blend(ranker, als, alpha) -> Column:
    """α·ranker + (1-α)·als with α clipped to [0, 1]; α may be a column."""
    a = clip01(alpha if isinstance(alpha, Column) else F.lit(float(alpha)))
    return a * _col(ranker) + (F.lit(1.0) - a) * _col(als)


def similarity(x, mu, max_diff: float) -> Column:
    """0.5 when either side is NULL, else max(0, 1 - |x - mu| / max_diff)."""
    x, mu = _col(x), _col(mu)
    return F.when(x.isNull() | mu.isNull(), F.lit(0.5)).otherwise(
        F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(x - mu) / F.lit(float(max_diff))))


# Default weights of the playlist score and similarity widths.
W_BASE, W_TEMPO, W_VALENCE = 0.6, 0.2, 0.2
TEMPO_WIDTH, VALENCE_WIDTH = 80.0, 1.0


def final_score(base, tempo_sim, valence_sim, w_base=W_BASE, w_tempo=W_TEMPO, w_valence=W_VALENCE) -> Column:
    """Weighted playlist score."""
    return w_base * _col(base) + w_tempo * _col(tempo_sim) + w_valence * _col(valence_sim)


def stable_round(c, digits: int = 6) -> Column:
    """round(x·10^d)/10^d — identical on engines that share IEEE arithmetic, so
    scores that are equal up to float noise tie exactly and the ranking's unique
    tie-breaker decides (used before ranking on sums of several terms)."""
    f = float(10 ** digits)
    return F.round(_col(c) * F.lit(f), 0) / F.lit(f)
