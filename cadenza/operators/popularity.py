"""Popularity and activity aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.plans.ordering import attach_scalars


def pop_prior(train: DataFrame, items: DataFrame | None = None, pop_from: str = "plays") -> DataFrame:
    """prior_i = log1p(s_i) / max_j log1p(s_j), 0 when the max is 0.

    ``pop_from``: 'plays' (Σ plays, as the ALS trainer), 'rows' (row count, as the
    single-user predictor) or 'none' (all zeros). Items of ``items`` absent from
    ``train`` get s = 0. The max is a one-row aggregate attached by broadcast.
    """
    if pop_from not in ("plays", "rows", "none"):
        raise ValueError(f"pop_from must be plays/rows/none, got {pop_from}")
    value = F.col("plays") if pop_from == "plays" else F.lit(1.0)
    s = train.groupBy("item_id").agg(F.sum(value).alias("__s"))
    if items is not None:
        s = items.select("item_id").distinct().join(s, "item_id", "left").fillna(0.0, ["__s"])
    s = s.withColumn("__l", F.log1p("__s"))
    if pop_from == "none":
        return s.select("item_id", F.lit(0.0).alias("prior"))
    mx = s.agg(F.max("__l").alias("__mx"))
    return attach_scalars(s, mx).select(
        "item_id", F.when(F.col("__mx") > 0, F.col("__l") / F.col("__mx")).otherwise(F.lit(0.0)).alias("prior"))


def _distinct(col: str, unique: bool):
    """Distinct values in a group; with ``unique`` pairs a plain count, which needs no second shuffle."""
    return (F.count(col) if unique else F.countDistinct(col)).cast("long")


def item_popularity(train: DataFrame, items: DataFrame | None = None, unique: bool = False) -> DataFrame:
    """Distinct users and Σ plays per item; catalog items without plays get 0. ``unique``: no pair is there twice."""
    pop = train.groupBy("item_id").agg(_distinct("user_id", unique).alias("item_pop_users"),
                                       F.sum("plays").alias("item_pop_plays"))
    if items is None:
        return pop
    return (items.join(pop, "item_id", "left")
                 .fillna({"item_pop_users": 0, "item_pop_plays": 0.0}))


def user_activity(train: DataFrame, unique: bool = False) -> DataFrame:
    """A10: distinct items, total and mean plays per user (train split only). ``unique``: no pair is there twice."""
    return train.groupBy("user_id").agg(
        _distinct("item_id", unique).alias("user_seen_items"),
        F.sum("plays").alias("user_total_plays"),
        F.avg("plays").alias("user_mean_plays"))


def attach_user_activity(profiles: DataFrame, activity: DataFrame) -> DataFrame:
    """Left join the activity onto profiles, missing → 0 (shared by training
    and inference, so there is no train/serve skew)."""
    return (profiles.join(activity, "user_id", "left")
                    .fillna({"user_seen_items": 0, "user_total_plays": 0.0, "user_mean_plays": 0.0}))
