"""Interaction tables: aggregation, ids, k-core, splits and weighting
(A1, P1, N4, I1, J16, G1, I2, P6, B1, B2, A17, A22).

The interaction table is ``(user_id, item_id, plays double)``, one row per pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.plans.ordering import attach_scalars, dense_ids
from cadenza.session import cut_table

# BM25 parameters used by the training pipeline.
BM25_K1 = 1.2
BM25_B = 0.75


def aggregate_plays(log: DataFrame, user: str = "user_id", item: str = "item_id", plays: str | None = "plays") -> DataFrame:
    """A1: sum plays per (user, item); a missing plays column counts rows.
    Null keys are dropped first (pandas group-by semantics). Partial aggregation
    runs map-side, so a hot user is pre-combined before the shuffle."""
    value = F.col(plays).cast("double") if plays else F.lit(1.0)
    return (log.where(F.col(user).isNotNull() & F.col(item).isNotNull())
               .groupBy(F.col(user).alias("user_id"), F.col(item).alias("item_id"))
               .agg(F.sum(value).alias("plays")))


def min_plays(inter: DataFrame, threshold: int) -> DataFrame:
    """Keep pairs with plays ≥ threshold (applied only when threshold > 1)."""
    return inter.where(F.col("plays") >= threshold) if threshold > 1 else inter


def log1p_plays(inter: DataFrame) -> DataFrame:
    """N4."""
    return inter.withColumn("plays", F.log1p("plays"))


def degrees(inter: DataFrame, key: str) -> DataFrame:
    """Rows per user or per item."""
    return inter.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def pq_core(inter: DataFrame, user_min: int = 0, item_min: int = 0) -> DataFrame:
    """G1: bipartite (p, q)-core — drop users below ``user_min`` rows, then items
    below ``item_min``, until nothing changes. The core is unique, so the
    removal order does not matter. Each round is two partial aggregations and two
    semi joins, written as a table, whose rows are counted from its files' footers; the
    only driver traffic is that count."""
    if user_min <= 0 and item_min <= 0:
        return inter
    cur = cut_table(inter)
    n = cur.count()
    while True:  # every round but the last removes rows, so it ends
        if user_min > 0:
            keep = degrees(cur, "user_id").where(F.col("n") >= user_min).select("user_id")
            cur = cur.join(keep, "user_id", "left_semi")
        if item_min > 0:
            keep = degrees(cur, "item_id").where(F.col("n") >= item_min).select("item_id")
            cur = cur.join(keep, "item_id", "left_semi")
        cur = cut_table(cur)
        m = cur.count()
        if m == n:
            return cur
        n = m


def id_maps(named: DataFrame, user_col: str = "username", item_col: str = "artist") -> tuple[DataFrame, DataFrame]:
    """Dense ids over the sorted distinct user and item names."""
    users = dense_ids(named.select(F.col(user_col).cast("string").alias("username")), "username", "user_id")
    items = dense_ids(named.select(F.col(item_col).cast("string").alias("item_name")), "item_name", "item_id")
    return users, items


def encode_ids(named: DataFrame, users: DataFrame, items: DataFrame,
               user_col: str = "username", item_col: str = "artist") -> DataFrame:
    """Names → dense ids through the two dimension tables (shuffle joins;
    AQE turns them into broadcasts when a dimension is small at run time)."""
    return (named.withColumn("username", F.col(user_col).cast("string"))
                 .withColumn("item_name", F.col(item_col).cast("string"))
                 .join(users, "username").join(items, "item_name")
                 .select("user_id", "item_id", "plays"))


def split_hash_col(seed: int = 42):
    """Content hash of a pair: first 32 bits of md5('user|item|seed')."""
    s = F.concat_ws("|", F.col("user_id").cast("string"), F.col("item_id").cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def _check_ratios(val_ratio: float, test_ratio: float) -> None:
    if val_ratio < 0 or test_ratio < 0 or val_ratio + test_ratio >= 1.0:
        raise ValueError(f"val_ratio+test_ratio must be < 1.0 (got {val_ratio}+{test_ratio})")


def split_approx(inter: DataFrame, val_ratio: float = 0.1, test_ratio: float = 0.1, seed: int = 42) -> DataFrame:
    """I2 (scalable form): threshold the pair hash — no sort, no shuffle.
    Hash order low→high is train, val, test, like the exact form."""
    _check_ratios(val_ratio, test_ratio)
    u = split_hash_col(seed) / F.lit(4294967296.0)
    return inter.withColumn(
        "split", F.when(u < 1.0 - val_ratio - test_ratio, "train").when(u < 1.0 - test_ratio, "val").otherwise("test"))


#: Pairs are counted per leading bits of their hash; the two groups that hold the cuts are ranked.
SPLIT_BITS = 16


def split_exact(inter: DataFrame, val_ratio: float = 0.1, test_ratio: float = 0.1, seed: int = 42) -> DataFrame:
    """I2 (exact sizes): order pairs by (hash, user, item), then the first
    n - round(n·v) - round(n·t) rows are train, the next round(n·v) val, the rest
    test; rounding half-even.

    No global sort: rows are counted per leading SPLIT_BITS of their hash (at most 2^16 counts). The hash prefix
    decides the split of a row, unless the prefix holds one of the two cuts; only the
    rows of these prefixes, about n / 2^16 each, are ranked. The rows are written once, so that neither the counts nor the branches nor
    the splits' consumers compute them again."""
    _check_ratios(val_ratio, test_ratio)
    h = cut_table(inter.withColumn("__h", split_hash_col(seed)).withColumn("__p", F.shiftright("__h", 32 - SPLIT_BITS)))
    counts = {r[0]: r[1] for r in h.groupBy("__p").count().collect()}  # at most 2^SPLIT_BITS rows
    n = sum(counts.values())
    val, test = round(n * val_ratio), round(n * test_ratio)
    cuts = (n - val - test, n - test)  # first rows of val and of test
    before, at = 0, []
    for p in sorted(counts):
        at += [(p, before)] * sum(before < c < before + counts[p] for c in set(cuts))
        before += counts[p]
    starts = dict(at)
    # a prefix below a cut's is wholly before it
    first, total = [1 << SPLIT_BITS] * 2, 0
    for p in sorted(counts):
        for k, c in enumerate(cuts):
            if total >= c and first[k] == 1 << SPLIT_BITS:
                first[k] = p
        total += counts[p]
    by_prefix = F.when(F.col("__p") < first[0], "train").when(F.col("__p") < first[1], "val").otherwise("test")
    cols = [*inter.columns, "split"]
    if not starts:
        return h.withColumn("split", by_prefix).select(*cols)
    w = Window.partitionBy("__p").orderBy("__h", "user_id", "item_id")
    offset = F.lit(0)
    for p, b in starts.items():
        offset = F.when(F.col("__p") == p, b).otherwise(offset)
    near = F.col("__p").isin(*starts)
    ranked = h.where(near).withColumn("__r", F.row_number().over(w) - 1 + offset)
    ranked = ranked.withColumn("split", F.when(F.col("__r") < cuts[0], "train").when(F.col("__r") < cuts[1], "val").otherwise("test"))
    return h.where(~near).withColumn("split", by_prefix).select(*cols).unionByName(ranked.select(*cols))


def split_of(splits: DataFrame, name: str) -> DataFrame:
    return splits.where(F.col("split") == name).drop("split")


def split_users(splits: DataFrame, target: str = "all") -> DataFrame:
    """Distinct users of one split, or of all splits."""
    df = splits if target == "all" else splits.where(F.col("split") == target)
    return df.select("user_id").distinct()


def _weight_inputs(train: DataFrame, universe: DataFrame | None):
    users = (universe if universe is not None else train).select("user_id").distinct()
    n_users = users.agg(F.count(F.lit(1)).cast("double").alias("__N"))
    dfreq = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("__df"))
    return n_users, dfreq


def bm25_weight(train: DataFrame, universe: DataFrame | None = None, k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """B1: BM25 on the user × item matrix.

    w = x(K1+1) / (K1·(1-B+B·len_u/avglen) + x) · idf_i,
    idf_i = ln N - ln(1 + df_i), N = users in ``universe`` (rows incl. empty ones),
    len_u = Σ x of the user, avglen = Σ x / N.
    """
    n_users, dfreq = _weight_inputs(train, universe)
    ulen = train.groupBy("user_id").agg(F.sum("plays").alias("__len"))
    tot = train.agg(F.sum("plays").alias("__tot"))
    scal = attach_scalars(n_users, tot).select("__N", (F.col("__tot") / F.col("__N")).alias("__avg"))
    x = F.col("plays")
    out = attach_scalars(train.join(dfreq, "item_id").join(ulen, "user_id"), scal)
    idf = F.log(F.col("__N")) - F.log1p(F.col("__df").cast("double"))
    norm = (1.0 - b) + b * F.col("__len") / F.col("__avg")
    return out.select("user_id", "item_id", (x * (k1 + 1.0) / (k1 * norm + x) * idf).alias("weight"))


def tfidf_weight(train: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """B2: w = √x · (ln N − ln(1 + df_i))."""
    n_users, dfreq = _weight_inputs(train, universe)
    out = attach_scalars(train.join(dfreq, "item_id"), n_users)
    idf = F.log(F.col("__N")) - F.log1p(F.col("__df").cast("double"))
    return out.select("user_id", "item_id", (F.sqrt("plays") * idf).alias("weight"))
