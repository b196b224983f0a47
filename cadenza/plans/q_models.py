"""Registered queries: ALS, the rerank feature table, λ-gradients, rankers."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cadenza.operators import als as al
from cadenza.operators import interactions as it
from cadenza.operators import pairwise as pw
from cadenza.operators import popularity as pop
from cadenza.operators import profiles as pf
from cadenza.operators import ranking as rk
from cadenza.operators import rerank as rr
from cadenza.plans import q_interactions as qi
from cadenza.plans import q_profiles as qp
from cadenza.plans.registry import query, rounded
from cadenza.plans.stages import Run
from cadenza.session import cut_table
from cadenza.sources import standins as st

RR_N = 200
ALPHA = 0.5
ALS_RANK, ALS_ITERS, ALS_ALPHA, ALS_REG = 64, 20, 10.0, 0.05


def R6(expr: str) -> str:
    """SQL twin of the Spark rounding; + 0.0 folds a negative zero."""
    return f"(round({expr}, 6) + 0.0)"


# ---------------------------------------------------------------- shared Spark inputs
def _inputs(spark, d):
    """The splits, written once, and the training pairs."""
    splits = cut_table(it.split_exact(st.interactions(spark, d), qi.VAL, qi.TEST, qi.SEED))
    return splits, it.split_of(splits, "train")


def rerank_candidates(spark, d, n=RR_N):
    splits, train = _inputs(spark, d)
    prior = pop.pop_prior(train, splits, "plays").withColumnRenamed("prior", "score")
    c = rk.topn_unseen_by_item_score(splits.select("user_id"), train, prior, n)
    return c.select("user_id", "item_id", F.col("score").alias("als_score"), F.col("rank").alias("als_rank")), splits


def rerank_table(spark, d, split="val", n=RR_N):
    cands, splits = rerank_candidates(spark, d, n)
    train = it.split_of(splits, "train")
    feats = pf.item_features(st.items(spark, d).withColumnRenamed("explicit_text", "explicit"), qp.NUM, qp.CAT, qp.GEN)
    profiles = pf.user_profiles(train, feats, qp.NUM, qp.CAT, qp.GEN)
    items = pop.item_popularity(train, feats.select("item_id", *qp.NUM), unique=True)
    activity = pop.user_activity(train, unique=True)
    return rr.rerank_rows(cands, profiles, items, activity, qp.NUM, it.split_of(splits, split))


# ---------------------------------------------------------------- SQL twins
_CAND = (f"{qi.I}, {qi.SPLIT}, {qi._sql_prior('plays')}, "
         "C AS (SELECT U.user_id, PR.item_id, PR.prior FROM (SELECT DISTINCT user_id FROM I) U, PR "
         "WHERE NOT EXISTS (SELECT 1 FROM TR WHERE TR.user_id = U.user_id AND TR.item_id = PR.item_id)), "
         "RK AS (SELECT user_id, item_id, prior, row_number() OVER (PARTITION BY user_id ORDER BY prior DESC, item_id) - 1 "
         f"AS rank FROM C), CAND AS (SELECT user_id, item_id, prior AS als_score, CAST(rank AS DOUBLE) AS als_rank "
         f"FROM RK WHERE rank < {RR_N})")
_RR = (f"{_CAND}, {qp._ITEMF}, {qp._DF}, {qp._NUMP}, "
       "IP AS (SELECT item_id, count(DISTINCT user_id) AS item_pop_users, sum(plays) AS item_pop_plays FROM TR GROUP BY item_id), "
       "ACT AS (SELECT user_id, count(DISTINCT item_id) AS user_seen_items, sum(plays) AS user_total_plays, "
       "avg(plays) AS user_mean_plays FROM TR GROUP BY user_id), "
       "J AS (SELECT CAND.user_id, CAND.item_id, als_score, als_rank, "
       "coalesce(CAST(IP.item_pop_users AS DOUBLE), 0.0) AS item_pop_users, coalesce(IP.item_pop_plays, 0.0) AS item_pop_plays, "
       "coalesce(CAST(ACT.user_seen_items AS DOUBLE), 0.0) AS user_seen_items, coalesce(ACT.user_total_plays, 0.0) AS user_total_plays, "
       "coalesce(ACT.user_mean_plays, 0.0) AS user_mean_plays, coalesce(NP.uf_explicit, 0.0) AS uf_explicit, "
       "coalesce(NP.uf_size, 0.0) AS us, coalesce(NP.uf_price_cents, 0.0) AS up, coalesce(IF_.size, 0.0) AS vs, "
       "coalesce(IF_.price_cents, 0.0) AS vp FROM CAND LEFT JOIN NP USING (user_id) LEFT JOIN IF_ USING (item_id) "
       "LEFT JOIN IP USING (item_id) LEFT JOIN ACT USING (user_id)), "
       "FE AS (SELECT *, 1.0 / (1.0 + als_rank) AS als_rank_inv, ln(1 + item_pop_users) AS log_item_pop_users, "
       "ln(1 + item_pop_plays) AS log_item_pop_plays, "
       "CASE WHEN sqrt(us * us + up * up) > 0 AND sqrt(vs * vs + vp * vp) > 0 THEN (us * vs + up * vp) / "
       "(sqrt(us * us + up * up) * sqrt(vs * vs + vp * vp)) ELSE 0.0 END AS cos_user_item, "
       "sqrt((us - vs) * (us - vs) + (up - vp) * (up - vp)) AS l2_user_item, "
       "(abs(us - vs) + abs(up - vp)) / 2.0 AS absdiff_mean_user_item FROM J), "
       "FX AS (SELECT *, als_score * log_item_pop_plays AS als_x_pop, als_score * cos_user_item AS als_x_cos FROM FE), "
       "VA AS (SELECT user_id, item_id FROM S WHERE split = 'val'), "
       "RR AS MATERIALIZED (SELECT FX.*, CAST(CASE WHEN VA.item_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS label "
       "FROM FX LEFT JOIN VA USING (user_id, item_id))")


def _feat_select(cols) -> str:
    return ", ".join(R6(c) + f" AS {c}" for c in cols)


DERIVED = ["als_rank_inv", "log_item_pop_users", "log_item_pop_plays", "als_x_pop"]
PAIRS = ["cos_user_item", "l2_user_item", "absdiff_mean_user_item"]


@query("derived_features", sql=f"WITH {_RR} SELECT user_id, item_id, {_feat_select(DERIVED)} FROM RR")
def q_derived_features(spark, d):
    return rounded(rerank_table(spark, d).select("user_id", "item_id", *DERIVED), *DERIVED)


@query("pair_features", sql=f"WITH {_RR} SELECT user_id, item_id, {_feat_select(PAIRS)} FROM RR")
def q_pair_features(spark, d):
    return rounded(rerank_table(spark, d).select("user_id", "item_id", *PAIRS), *PAIRS)


@query("rerank_dataset", sql=f"WITH {_RR} SELECT user_id, item_id, label, {_feat_select(rr.FEATURES)} FROM RR")
def q_rerank_dataset(spark, d):
    return rounded(rerank_table(spark, d), *rr.FEATURES)


@query("label_rows", sql=f"WITH {_RR} SELECT label, count(*) AS n FROM RR GROUP BY label")
def q_label_rows(spark, d):
    return rerank_table(spark, d).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("lambda_gradients", sql=(
    f"WITH {_RR}, D AS (SELECT user_id, item_id, als_score AS score, label, 1.0 / log2(1 + row_number() OVER "
    "(PARTITION BY user_id ORDER BY als_score DESC, item_id)) AS d FROM RR), "
    "MX AS (SELECT user_id, sum((pow(2.0, label) - 1.0) / log2(1 + ipos)) AS mx FROM (SELECT user_id, label, "
    "row_number() OVER (PARTITION BY user_id ORDER BY label DESC, item_id) AS ipos FROM RR) GROUP BY user_id), "
    "PP AS (SELECT a.user_id, a.item_id AS i, b.item_id AS j, 1.0 / (1.0 + exp(a.score - b.score)) AS rho, "
    "abs(pow(2.0, a.label) - pow(2.0, b.label)) * abs(a.d - b.d) / mx AS delta FROM (SELECT * FROM D WHERE label > 0) a JOIN D b "
    "ON a.user_id = b.user_id AND a.label > b.label JOIN MX ON MX.user_id = a.user_id WHERE mx > 0), "
    "G AS (SELECT user_id, item_id, sum(g) AS g, sum(h) AS h FROM (SELECT user_id, i AS item_id, -rho * delta AS g, "
    "rho * (1 - rho) * delta AS h FROM PP UNION ALL SELECT user_id, j, rho * delta, rho * (1 - rho) * delta FROM PP) "
    "GROUP BY user_id, item_id) "
    f"SELECT D.user_id, D.item_id, {R6('coalesce(g, 0.0)')} AS grad, {R6('coalesce(h, 0.0)')} AS hess "
    "FROM D LEFT JOIN G USING (user_id, item_id)"))
def q_lambda_gradients(spark, d):
    rows = rerank_table(spark, d).withColumnRenamed("als_score", "score")
    return rounded(rr.lambda_gradients(rows, "score", "label"), "grad", "hess")


#: Weights at which ``pairwise_gradient`` evaluates the pairwise loss: -1/4, 0, 1/4 in turn.
STEP_AT = [(k % 3 - 1) / 4 for k in range(len(rr.FEATURES))]
_Z = [f"CASE WHEN sd_{f} > 0 THEN (RR.{f} - av_{f}) / sd_{f} ELSE 0.0 END" for f in rr.FEATURES]


@query("pairwise_gradient", sql=(
    f"WITH {_RR}, STATS AS (SELECT {', '.join(f'avg({f}) AS av_{f}, stddev_pop({f}) AS sd_{f}' for f in rr.FEATURES)} FROM RR), "
    f"ZS AS MATERIALIZED (SELECT user_id, item_id, label, {', '.join(f'{z} AS z_{f}' for z, f in zip(_Z, rr.FEATURES, strict=True))}, "
    "1.0 / log2(1 + row_number() OVER (PARTITION BY user_id ORDER BY RR.als_score DESC, item_id)) AS d FROM RR, STATS), "
    f"SC AS MATERIALIZED (SELECT *, {' + '.join(f'{w} * z_{f}' for w, f in zip(STEP_AT, rr.FEATURES, strict=True))} AS s FROM ZS), "
    "MX AS (SELECT user_id, sum((pow(2.0, label) - 1.0) / log2(1 + ipos)) AS mx FROM (SELECT user_id, label, "
    "row_number() OVER (PARTITION BY user_id ORDER BY label DESC, item_id) AS ipos FROM RR) GROUP BY user_id), "
    "PP AS (SELECT a.user_id, a.item_id AS i, b.item_id AS j, 1.0 / (1.0 + exp(a.s - b.s)) AS rho, "
    "abs(pow(2.0, a.label) - pow(2.0, b.label)) * abs(a.d - b.d) / mx AS w FROM (SELECT * FROM SC WHERE label > 0) a JOIN SC b "
    "ON a.user_id = b.user_id AND a.label > b.label JOIN MX ON MX.user_id = a.user_id), "
    "G AS (SELECT user_id, item_id, sum(c) AS c FROM (SELECT user_id, i AS item_id, -rho * w AS c FROM PP UNION ALL "
    "SELECT user_id, j, rho * w FROM PP) GROUP BY user_id, item_id), MASS AS (SELECT sum(w) AS m FROM PP) "
    + " UNION ALL ".join(f"SELECT '{f}' AS feature, {R6(f'sum(c * z_{f}) / max(m)')} AS gradient FROM SC JOIN G USING (user_id, item_id), MASS" for f in rr.FEATURES)))
def q_pairwise_gradient(spark, d):
    """One step's gradient of the pairwise logistic loss, weighted by the change of NDCG in the list by als_score."""
    objective = pw.Objective(rerank_table(spark, d), rr.FEATURES, "als_score", l2=0.0)
    _, gradient = objective(np.array(STEP_AT))
    objective.blocks.unpersist()
    return rounded(spark.createDataFrame([(f, float(g)) for f, g in zip(rr.FEATURES, gradient, strict=True)], "feature string, gradient double"), "gradient")


# ---------------------------------------------------------------- models (rows-only checks)
def _als_model(spark, d, with_splits=False):
    splits, train = _inputs(spark, d)
    al.check_int_ids(train, "user_id", "item_id")
    w = it.bm25_weight(train, splits).withColumnRenamed("weight", "plays")
    model = al.fit_als(w, "plays", ALS_RANK, ALS_REG, ALS_ALPHA, ALS_ITERS, qi.SEED)
    return (model, train, splits) if with_splits else (model, train)


@query("als_factors")
def q_als_factors(spark, d):
    model, _ = _als_model(spark, d)
    u, i = al.factor_tables(model)
    return u.withColumn("kind", F.lit("user")).unionByName(i.withColumn("kind", F.lit("item")))


@query("als_candidates")
def q_als_candidates(spark, d):
    model, train, splits = _als_model(spark, d, with_splits=True)
    popular = pop.pop_prior(train, splits, "plays").withColumnRenamed("prior", "score")
    return al.als_candidates(model, splits.select("user_id"), train, qi.K, cosine=True, popular=popular)


def _pointwise(spark, d):
    return rr.fit_pointwise(rerank_table(spark, d, "val"), seed=qi.SEED)


def _lambdamart(spark, d):
    """Trained on the labels of val, split by user; NDCG@k of the held-out users decides when to stop."""
    rows = rerank_table(spark, d, "val")
    held = rr.held_out("user_id")
    return rr.LambdaMART(seed=qi.SEED, k=qi.K).fit(rows.where(~held), rows.where(held))


def _fitted(spark, d):
    """The ranker of a data set, fitted once: a stage whose fingerprint is that of the tables and the defaults."""
    run = Run(spark)
    for name in ("orders", "lineitem", "part"):
        run.source(name, f"{d}/{name}.parquet")
    params = {**rr.LambdaMART().params, "seed": qi.SEED, "k": qi.K, "candidates": RR_N}
    return run.once("popularity_ranker", list(run.marks), params, lambda path: _lambdamart(spark, d).save(spark, path), lambda path: rr.LambdaMART.load(spark, path))


@query("rerank_fit_pointwise")
def q_rerank_fit_pointwise(spark, d):
    pred = _pointwise(spark, d).transform(rerank_table(spark, d, "test"))
    return pred.select("user_id", "item_id", vector_to_array("probability")[1].alias("ranker_score"))


@query("rerank_fit_pairwise")
def q_rerank_fit_pairwise(spark, d):
    """Trained on the labels of val to the minimum of the loss, scored on the candidates with the labels of test."""
    model = pw.PairwiseRanker(rr.FEATURES).fit(rerank_table(spark, d, "val"))
    return model.predict(rerank_table(spark, d, "test")).select("user_id", "item_id", "label", "ranker_score")


@query("rerank_fit_lambdamart")
def q_rerank_fit_lambdamart(spark, d):
    return _fitted(spark, d).predict(rerank_table(spark, d, "test")).select("user_id", "item_id", "label", "ranker_score")


@query("rerank_scores")
def q_rerank_scores(spark, d):
    return rr.blend_topk(_fitted(spark, d).predict(rerank_table(spark, d, "test")), ALPHA, qi.K)


@query("feature_importance")
def q_feature_importance(spark, d):
    return _fitted(spark, d).importance(spark)


@query("two_stage_metrics")
def q_two_stage_metrics(spark, d):
    """ALS candidates, features, ranker, blend and evaluation as one flow."""
    from cadenza.plans.pipeline import two_stage
    return two_stage(spark, d)


@query("als_eval_summary")
def q_als_eval_summary(spark, d):
    """ALS candidates (cosine, unseen) scored against val and test, split family."""
    from cadenza.operators import evaluate as ev
    model, train, splits = _als_model(spark, d, with_splits=True)
    popular = pop.pop_prior(train, splits, "plays").withColumnRenamed("prior", "score")
    ranked = al.als_candidates(model, splits.select("user_id"), train, qi.K, cosine=True, popular=popular)
    out = None
    for name in ("val", "test"):
        s = ev.summarize(ev.per_user_split(ranked, it.split_of(splits, name), qi.K), qi.K, "split")
        s = s.withColumn("eval_split", F.lit(name))
        out = s if out is None else out.unionByName(s)
    return rounded(out, "precision_at_k", "map_at_k", "ndcg_at_k")
