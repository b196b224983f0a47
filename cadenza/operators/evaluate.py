"""Ranking metrics at K, both families.

* family ``split`` (trainer): per user with positives in the truth split,
  precision = hits / K, AP = Σ hits_r / r / min(K, |pos|), NDCG with binary gain and
  ideal = min(K, |pos|) ones; averages over users with positives.
* family ``list`` (list evaluator): per user of the list, k' = min(K, len),
  precision = hits in k' / k', AP divided by max(1, positives in the whole list),
  NDCG with gain 2^rel − 1 and ideal = the list's labels sorted; mean over users.

All per-user quantities are window/aggregate expressions; the ideal-DCG values
come from a K-row table (bounded by the parameter K).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.operators.ranking import label_join


def _disc(pos_col):
    """1 / log2(pos + 1) for a 1-based position."""
    return F.lit(1.0) / F.log2(F.col(pos_col).cast("double") + 1.0)


def _ideal_table(spark: SparkSession, k: int) -> DataFrame:
    """m → Σ_{r ≤ m} 1/log2(r+1) for m = 0..k (k + 1 rows)."""
    r = spark.range(0, k + 1).withColumnRenamed("id", "__m")
    return r.withColumn("__idcg", F.when(F.col("__m") > 0, F.aggregate(
        F.sequence(F.lit(1), F.col("__m").cast("int")), F.lit(0.0),
        lambda acc, x: acc + F.lit(1.0) / F.log2(x.cast("double") + 1.0))).otherwise(F.lit(0.0)))


def per_user_split(ranked: DataFrame, truth: DataFrame, k: int, rank_col: str = "rank") -> DataFrame:
    """Per-user split-family metrics. ``ranked`` holds (user_id, item_id, rank 0-based)."""
    spark = ranked.sparkSession
    pos = truth.select("user_id", "item_id").distinct().groupBy("user_id").agg(F.count(F.lit(1)).alias("__p"))
    top = ranked.where(F.col(rank_col) < k).select("user_id", "item_id", (F.col(rank_col) + 1).alias("__pos"))
    lab = label_join(top, truth, "__rel")
    w = Window.partitionBy("user_id").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    lab = lab.withColumn("__hits", F.sum("__rel").over(w))
    agg = lab.groupBy("user_id").agg(
        F.sum("__rel").alias("__h"),
        F.sum(F.when(F.col("__rel") > 0, F.col("__hits") / F.col("__pos"))).alias("__ap"),
        F.sum(F.when(F.col("__rel") > 0, _disc("__pos"))).alias("__dcg"))
    users = pos.join(agg, "user_id", "left").withColumn("__m", F.least(F.col("__p"), F.lit(k)).cast("long"))
    users = users.join(F.broadcast(_ideal_table(spark, k)), "__m")
    return users.select(
        "user_id",
        (F.coalesce(F.col("__h"), F.lit(0)) / F.lit(float(k))).alias("precision"),
        (F.coalesce(F.col("__ap"), F.lit(0.0)) / F.col("__m")).alias("ap"),
        F.when(F.col("__idcg") > 0, F.coalesce(F.col("__dcg"), F.lit(0.0)) / F.col("__idcg"))
         .otherwise(F.lit(0.0)).alias("ndcg"))


def per_user_list(scored: DataFrame, k: int, score_col: str = "score", label_col: str = "label",
                  tie_col: str = "item_id", extra_keys=()) -> DataFrame:
    """Per-user list-family metrics over (user_id, item_id, score, label);
    ``extra_keys`` (e.g. a sweep parameter) extend the group key.

    Only bounded pieces of a list are ever sorted: its length and positive count
    are aggregates, and precision, AP and DCG need the top k by score, the ideal
    DCG the top k by label — both ``row_number() <= k`` (a partial
    ``WindowGroupLimit`` before the shuffle), so a huge list is not sorted in one task."""
    keys = [*extra_keys, "user_id"]
    rel = F.col(label_col).cast("double")
    base = scored.select(*keys, tie_col, score_col, label_col)
    cnt = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("__len"),
                                  F.sum(F.when(rel > 0, 1).otherwise(0)).alias("__npos"))
    by_score = Window.partitionBy(*keys).orderBy(F.col(score_col).desc(), F.col(tie_col).asc())
    top = base.withColumn("__pos", F.row_number().over(by_score)).where(F.col("__pos") <= k)
    top = top.withColumn("__hits", F.sum(F.when(rel > 0, 1).otherwise(0)).over(
        Window.partitionBy(*keys).orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)))
    at = top.groupBy(*keys).agg(
        F.sum(F.when(rel > 0, 1).otherwise(0)).alias("__h"),
        F.sum(F.when(rel > 0, F.col("__hits") / F.col("__pos")).otherwise(0.0)).alias("__ap"),
        F.sum((F.pow(F.lit(2.0), rel) - 1.0) * _disc("__pos")).alias("__dcg"))
    by_label = Window.partitionBy(*keys).orderBy(F.col(label_col).desc(), F.col(tie_col).asc())
    itop = base.withColumn("__ipos", F.row_number().over(by_label)).where(F.col("__ipos") <= k)
    ai = itop.groupBy(*keys).agg(F.sum((F.pow(F.lit(2.0), rel) - 1.0) * _disc("__ipos")).alias("__idcg"))
    agg = cnt.join(at, keys).join(ai, keys).withColumn("__k", F.least(F.col("__len"), F.lit(k)))
    return agg.select(
        *keys,
        F.when(F.col("__k") > 0, F.col("__h") / F.col("__k")).otherwise(F.lit(0.0)).alias("precision"),
        (F.col("__ap") / F.greatest(F.col("__npos"), F.lit(1))).alias("ap"),
        F.when(F.col("__idcg") > 0, F.col("__dcg") / F.col("__idcg")).otherwise(F.lit(0.0)).alias("ndcg"))


def summarize(per_user: DataFrame, k: int, family: str) -> DataFrame:
    """One row — k, users, precision@k, map@k, ndcg@k (0.0 when no users)."""
    return per_user.agg(
        F.lit(k).cast("long").alias("k"),
        F.lit(family).alias("family"),
        F.count(F.lit(1)).cast("long").alias("users"),
        F.coalesce(F.avg("precision"), F.lit(0.0)).alias("precision_at_k"),
        F.coalesce(F.avg("ap"), F.lit(0.0)).alias("map_at_k"),
        F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("ndcg_at_k"))


def eval_delta(base: DataFrame, new: DataFrame) -> DataFrame:
    """E5: absolute and relative change of each metric (new vs base), per family."""
    b = base.select("family", *[F.col(c).alias(f"b_{c}") for c in ("precision_at_k", "map_at_k", "ndcg_at_k")])
    n = new.select("family", *[F.col(c).alias(f"n_{c}") for c in ("precision_at_k", "map_at_k", "ndcg_at_k")])
    j = b.join(n, "family")
    cols = ["family"]
    for c in ("precision_at_k", "map_at_k", "ndcg_at_k"):
        cols.append((F.col(f"n_{c}") - F.col(f"b_{c}")).alias(f"delta_{c}"))
        cols.append(F.when(F.col(f"b_{c}") != 0, (F.col(f"n_{c}") - F.col(f"b_{c}")) / F.col(f"b_{c}"))
                    .alias(f"rel_{c}"))
    return j.select(*cols)
