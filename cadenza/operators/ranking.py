"""Per-user ranking: top-N, seen exclusion, labels, blends.

Every ranking ends in a unique key (``item_id asc``), so ties are deterministic.
``row_number() … <= N`` is planned as a ``WindowGroupLimit`` that also runs
partially before the shuffle, so a hot user ships at most N rows per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.plans.ordering import global_rank


def topn(df: DataFrame, score_col: str, n: int, rank_col: str = "rank", base: int = 0,
         group_col: str = "user_id", tie_col: str = "item_id") -> DataFrame:
    """Best ``n`` rows per group by score desc, tie → ``tie_col`` asc.
    ``base`` 0 gives the candidate ranks (0-based), 1 the exported ranks."""
    w = Window.partitionBy(group_col).orderBy(F.col(score_col).desc(), F.col(tie_col).asc())
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") <= n)
              .withColumn(rank_col, (F.col("__rn") - 1 + base).cast("long"))
              .drop("__rn"))


def unseen(cands: DataFrame, seen: DataFrame) -> DataFrame:
    """Drop (user, item) pairs already seen — an anti join, so seen items never
    appear (the reference scored them −inf and could still emit them)."""
    return cands.join(seen.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def label_join(cands: DataFrame, truth: DataFrame, label_col: str = "label") -> DataFrame:
    """label = 1 when (user, item) is a pair of ``truth`` else 0. A user's items of ``truth`` come as one list, so that the
    candidates move by user at most, and not at all if they lie by user already."""
    t = truth.groupBy("user_id").agg(F.collect_set("item_id").alias("__t"))
    hit = F.coalesce(F.array_contains("__t", F.col("item_id")), F.lit(False)).cast("long")
    rest = [c for c in cands.columns if c not in ("user_id", "item_id", label_col)]
    return cands.join(t.hint("shuffle_hash"), "user_id", "left").select("user_id", "item_id", *rest, hit.alias(label_col))


#: Item ranks below this are broadcast.
BROADCAST_RANKS = 200_000
#: About so many candidate rows make a task.
CANDIDATE_ROWS = 1_000_000


def topn_unseen_by_item_score(users: DataFrame, seen: DataFrame, item_scores: DataFrame, n: int,
                              score_col: str = "score") -> DataFrame:
    """Exact top-``n`` unseen items per user when the score depends on the item only
    (popularity prior) — without pairing every user with every item.

    Items get a global rank r (distributed sort). A user with m seen items only
    needs ranks r < n + m, so seen items of higher rank play no part. A user's seen
    ranks in order leave gaps; the first n ranks of the gaps are the result. Gaps
    move, not candidates: each user's n rows are made where its gaps lie, sorted and
    partitioned by user, and the items of ranks below ``BROADCAST_RANKS`` are broadcast.
    """
    ranked = global_rank(item_scores.select("item_id", score_col),
                         [F.col(score_col).desc(), F.col("item_id").asc()], "__ir")
    m = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("__m"))
    u = users.select("user_id").distinct()
    most, n_users = u.join(m, "user_id", "left").agg(F.coalesce(F.max("__m"), F.lit(0)), F.count(F.lit(1))).first()
    ranked = ranked.where(F.col("__ir") < n + most)
    small = n + most <= BROADCAST_RANKS

    def hinted(df):
        return F.broadcast(df) if small else df

    ranks = seen.select("user_id", "item_id").join(hinted(ranked.select("item_id", "__ir")), "item_id").select("user_id", "__ir")
    ranks = ranks.join(u, "user_id", "left_semi").unionByName(u.select("user_id", F.lit(-1).cast("long").alias("__ir")))
    tasks = max(int(users.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_users * n // CANDIDATE_ROWS))
    w = Window.partitionBy("user_id").orderBy("__ir")
    below = F.dense_rank().over(w) - 1  # seen ranks below the gap, its own lower end included unless that is -1
    gaps = ranks.repartition(tasks, "user_id").select("user_id", "__ir", below.cast("long").alias("__below"), F.lead("__ir").over(w).alias("__next"))
    # the gap's ranks are __ir + 1 to __next - 1; rank x is the unseen item number x - __below, of which those below n are wanted
    last = F.least(F.coalesce(F.col("__next") - 1, F.lit(n + most - 1)), F.col("__below") + (n - 1))
    gaps = gaps.select("user_id", "__below", (F.col("__ir") + 1).alias("__first"), last.alias("__last")).where("__first <= __last")
    cand = gaps.select("user_id", F.explode(F.sequence("__first", "__last")).alias("__ir"), "__below")
    cand = cand.select("user_id", "__ir", (F.col("__ir") - F.col("__below")).alias("rank"))
    out = cand if small else cand.where(F.col("__ir") < BROADCAST_RANKS)
    out = out.join(F.broadcast(ranked.where(F.col("__ir") < BROADCAST_RANKS)), "__ir")
    if not small:
        out = out.unionByName(cand.join(ranked.where(F.col("__ir") >= BROADCAST_RANKS), "__ir"))
    return out.select("user_id", "item_id", score_col, "rank")


def in_dimension(df: DataFrame, dim: DataFrame, col: str, dim_col: str | None = None) -> DataFrame:
    """Keep rows whose id exists in the dimension (0 ≤ id < n for dense ids) —
    a semi join, not a driver-side range test."""
    d = dim.select(F.col(dim_col or col).alias(col)).distinct()
    return df.join(d, col, "left_semi")


def lookup_user(users: DataFrame, user_id=None, username: str | None = None) -> DataFrame:
    """P5: the dimension row of one user by id or by name; raises when absent.
    The result is one row, safe to broadcast into the scoring join."""
    if user_id is None and username is None:
        raise ValueError("give user_id or username")
    cond = (F.col("user_id") == F.lit(user_id)) if user_id is not None else (F.col("username") == F.lit(username))
    hit = users.where(cond).limit(2)
    n = hit.count()
    if n != 1:
        raise ValueError(f"user {user_id if user_id is not None else username!r} not found" if n == 0
                         else "user lookup is ambiguous")
    return hit
