"""Second stage: the rerank feature table, LambdaRank, prediction and blend
(J5, J6, J17, V3, V4, N5–N7, N10, N14, M4–M7, S12, W8).

Feature rows are candidates ⟕ user profiles ⟕ item features ⟕ user activity —
one builder for training and inference. Per-user lists are bounded by the
candidate count N (a parameter), so per-user pairwise work (λ-gradients) is
bounded by N² inside one list of an Arrow batch, never emitted as rows.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions.numeric import alpha_blend, number
from cadenza.functions.vectors import pair_features
from cadenza.operators import boosting as bo
from cadenza.operators.ranking import label_join, topn
from cadenza.sources.roles import with_roles

# The ranker's feature list in order.
FEATURES = [
    "als_score", "als_rank", "als_rank_inv", "item_pop_users", "item_pop_plays", "log_item_pop_users",
    "log_item_pop_plays", "cos_user_item", "l2_user_item", "absdiff_mean_user_item", "als_x_pop", "als_x_cos",
    "uf_explicit", "user_seen_items", "user_total_plays", "user_mean_plays",
]


def pair_columns(profiles: DataFrame, items: DataFrame, numerics) -> tuple[list[str], list[str]]:
    """V4: numeric item column c is paired with uf_c when both exist."""
    ucols, icols = [], []
    for c in numerics:
        if f"uf_{c}" in profiles.columns and c in items.columns:
            ucols.append(f"uf_{c}")
            icols.append(c)
    return ucols, icols


#: Item rows up to this number are broadcast.
BROADCAST_ITEMS = 200_000


def _met(items: DataFrame, cands: DataFrame) -> DataFrame:
    """The items to join to candidates: broadcast when they, or those of them that are candidates, are few; else as they are."""
    from cadenza.session import cut_table
    if items.limit(BROADCAST_ITEMS + 1).count() <= BROADCAST_ITEMS:
        return F.broadcast(items)
    met = cut_table(cands.select("item_id").distinct())
    few = met.limit(BROADCAST_ITEMS + 1).count() <= BROADCAST_ITEMS
    kept = items.join(F.broadcast(met), "item_id", "left_semi") if few else items
    return F.broadcast(kept) if few and kept.limit(BROADCAST_ITEMS + 1).count() <= BROADCAST_ITEMS else items


def rerank_rows(cands: DataFrame, profiles: DataFrame, items: DataFrame, activity: DataFrame, numerics,
                truth: DataFrame | None = None) -> DataFrame:
    """J5 + J17 + V3 + N5–N7 (+ J6 when ``truth`` is given): one row per candidate
    with the 16 features. Missing values become 0 (N14). Columns carry their roles (S10): group, item, label, feature."""
    ucols, icols = pair_columns(profiles, items, numerics)
    # users' columns are joined as one table by hash, so that candidates lying by user stay in place and are not sorted
    users = profiles.join(activity, "user_id", "full")
    df = cands.join(_met(items, cands), "item_id", "left").join(users.hint("shuffle_hash"), "user_id", "left")
    base = ["als_score", "als_rank", "item_pop_users", "item_pop_plays", "user_seen_items", "user_total_plays",
            "user_mean_plays", "uf_explicit", *ucols, *icols]
    df = df.withColumns({c: number(df, c) if c in df.columns else F.lit(0.0) for c in base})
    df = df.withColumns(pair_features(ucols, icols))
    df = df.withColumns({
        "als_rank_inv": F.lit(1.0) / (F.lit(1.0) + F.col("als_rank")),
        "log_item_pop_users": F.log1p("item_pop_users"),
        "log_item_pop_plays": F.log1p("item_pop_plays"),
    })
    df = df.withColumns({"als_x_pop": F.col("als_score") * F.col("log_item_pop_plays"),
                         "als_x_cos": F.col("als_score") * F.col("cos_user_item")})
    if truth is not None:
        df = label_join(df, truth)
    keep = ["user_id", "item_id"] + (["label"] if truth is not None else []) + FEATURES
    marks = {"group": "user_id", "item": "item_id", "feature": FEATURES} | ({"label": "label"} if truth is not None else {})
    return with_roles(df.select(*keep), **marks)


def lambda_gradients(rows: DataFrame, score_col: str = "score", label_col: str = "label",
                     sigma: float = 1.0) -> DataFrame:
    """M4 (λ step): per user, LambdaRank gradient and hessian of every row under the
    current scores. Pairs (i, j) with l_i > l_j contribute
    ρ = 1 / (1 + exp(σ(s_i − s_j))), Δ = |2^l_i − 2^l_j|·|d_i − d_j| / maxDCG with
    d = 1/log2(1 + position) (positions by score desc, item asc):
    g_i −= σρΔ, g_j += σρΔ, h_i, h_j += σ²ρ(1 − ρ)Δ."""
    from cadenza.session import ship_package
    ship_package()
    # a user's list in one row, ordered by item (nulls last); Arrow batches hold many users
    cell = F.struct(F.col("item_id").isNull().alias("none"), F.col("item_id").alias("item"), F.col(score_col).cast("double").alias("score"),
                    F.col(label_col).cast("double").alias("label"))
    lists = rows.groupBy("user_id").agg(F.sort_array(F.collect_list(cell)).alias("rows"))
    names = ["user_id", "item_id", "grad", "hess"]

    def score(batches):
        for b in batches:
            offsets = b.column("rows").offsets.to_numpy()
            start = 0
            while start < b.num_rows:
                # whole users of about BLOCK_ROWS rows
                stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + bo.BLOCK_ROWS, "right")) - 1)
                part = b.slice(start, stop - start)
                n = np.diff(offsets[start:stop + 1]).astype(np.int64)
                cells = part.column("rows").flatten()
                s, lab = (cells.field(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("score", "label"))
                of = np.repeat(np.arange(len(n)), n)
                g, h = bo.lambdas(bo.Lists(n, np.cumsum(n) - n, of, np.zeros(len(n), bool), lab), s, sigma)
                yield pa.RecordBatch.from_arrays([part.column("user_id").take(pa.array(of)), cells.field("item"), pa.array(g, pa.float64()), pa.array(h, pa.float64())], names)
                start = stop

    types = dict(rows.dtypes)
    return lists.mapInArrow(score, f"user_id {types['user_id']}, item_id {types['item_id']}, grad double, hess double")


def held_out(user_col: str):
    """Whether a user is one of the fifth whose labels only decide when training stops."""
    return F.pmod(F.xxhash64(user_col), F.lit(5)) == 0


def fit_pointwise(train: DataFrame, features=FEATURES, seed: int = 42, max_iter: int = 20, max_depth: int = 5):
    """A pointwise gradient-boosted classifier as a PipelineModel (S12 — the
    assembler carries the feature list)."""
    from cadenza.session import cut_lineage
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(labelCol="label", featuresCol="features", maxIter=max_iter, maxDepth=max_depth, seed=seed)
    # the booster passes over its input many times: materialise the feature rows once
    data = cut_lineage(train.withColumn("label", F.col("label").cast("double")))
    return Pipeline(stages=[va, gbt]).fit(data)


class LambdaMART:
    """Boosting with λ-gradients (see ``boosting``). Each round grows a tree of at most ``leaves`` leaves (and 2^depth, if ``depth`` is
    given) on a sample of rows and features, with Newton leaf values −Σg/(Σh + l2) times lr. With a validation table the mean NDCG@k
    is measured every round, training stops after ``patience`` rounds without a better one, and prediction uses the best round's trees.
    Users of the two tables are lists of their own."""

    def __init__(self, features=FEATURES, rounds: int = 2000, depth: int | None = None, lr: float = 0.05, seed: int = 42, min_leaf: int = 50, l2: float = 1.0,
                 rows_share: float = 0.9, features_share: float = 0.9, patience: int = 100, k: int = 10, leaves: int = 31):
        self.params = {"rounds": rounds, "depth": depth, "lr": lr, "seed": seed, "min_leaf": min_leaf, "l2": l2,
                       "rows_share": rows_share, "features_share": features_share, "patience": patience, "k": k, "leaves": leaves}
        self.features = list(features)
        self.trees = bo.Trees()
        self.history: list[float] = []
        self.best = 0

    def fit(self, rows: DataFrame, valid: DataFrame | None = None) -> "LambdaMART":
        from cadenza.session import cut_table, ship_package
        ship_package()
        p = dict(self.params)
        depth = p.pop("depth")
        if depth is not None:
            p["leaves"] = min(p["leaves"], 2 ** depth)
        wanted = ["user_id", "item_id", "label", *self.features]
        data = rows.select(*wanted, F.lit(False).alias("__held"))
        if valid is not None:
            data = data.unionByName(valid.select(*wanted, F.lit(True).alias("__held")))
        data = cut_table(data)  # quantiles and blocks each read the rows once
        cuts = bo.cut_points(data.where(~F.col("__held")), self.features)
        stored = cut_table(bo.blocks(data, self.features, lambda x: bo.bin_ids(x, cuts)))
        self.trees, self.history, self.best = bo.train(stored, cuts, bo.Ranker(**p))
        return self

    def predict(self, rows: DataFrame, out_col: str = "ranker_score") -> DataFrame:
        """M5: the rows with the score of the best round's trees, evaluated all together for a batch of rows."""
        from cadenza.session import ship_package
        ship_package()
        rows = rows.drop(out_col)
        flat, features = rows.sparkSession.sparkContext.broadcast(self.trees.first(self.best).arrays()), self.features
        d = rows.withColumns({f"__{i}": F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for i, f in enumerate(features)})
        keep = len(rows.columns)

        def score(batches):
            for b in batches:
                x = bo.matrix(pa.RecordBatch.from_arrays(b.columns[keep:], features), features)
                yield pa.RecordBatch.from_arrays([*b.columns[:keep], pa.array(flat.value.scores(x), pa.float64())], [*b.schema.names[:keep], out_col])

        return d.mapInArrow(score, T.StructType([*rows.schema.fields, T.StructField(out_col, T.DoubleType())]))

    def importance(self, spark) -> DataFrame:
        """M6: per feature the total gain and the number of its splits in the trees in use, largest gain first."""
        t = self.trees.first(self.best).table
        per = t[t["feature"] >= 0].groupby("feature")["gain"].agg(["sum", "count"])
        rows = [(f, float(per["sum"].get(i, 0.0)), int(per["count"].get(i, 0))) for i, f in enumerate(self.features)]
        return spark.createDataFrame(rows, "feature string, gain double, split long").orderBy(F.col("gain").desc(), F.col("feature").asc())

    def save(self, spark, path: str) -> None:
        """The trees' nodes as a table, and one row with parameters, features and the best round."""
        state = {"params": self.params, "features": self.features, "history": self.history, "best": self.best}
        nodes = self.trees.table.reset_index(names="node")
        nodes = spark.createDataFrame(nodes, f"node long, {bo.Trees.COLUMNS}") if len(nodes) else spark.createDataFrame([], f"node long, {bo.Trees.COLUMNS}")
        nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/state")

    @classmethod
    def load(cls, spark, path: str) -> "LambdaMART":
        state = json.loads(spark.read.text(f"{path}/state").first()[0])
        m = cls(state["features"], **state["params"])
        m.history, m.best = state["history"], state["best"]
        m.trees = bo.Trees(spark.read.parquet(f"{path}/nodes").orderBy("node").toPandas().drop(columns="node"))
        return m


def feature_importance(model, features=FEATURES) -> DataFrame:
    """M6: gain-based importances of the last pipeline stage joined to the names,
    largest first (split counts are not exposed by MLlib)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return (spark.createDataFrame(list(zip(list(features), [float(x) for x in imp])), "feature string, gain double")
                 .orderBy(F.col("gain").desc(), F.col("feature").asc()))


def blend_topk(scored: DataFrame, alpha: float, k: int) -> DataFrame:
    """N10 + W8: final = α·ranker + (1−α)·als, top-k per user (rank 0-based)."""
    b = scored.withColumn("final_score", alpha_blend("ranker_score", "als_score", alpha))
    return topn(b, "final_score", k).select("user_id", "item_id", "final_score", "ranker_score", "als_score", "rank")


def save_ranker(model, path: str) -> None:
    """The PipelineModel carries the assembler, hence the feature list."""
    model.write().overwrite().save(path)


def load_ranker(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
