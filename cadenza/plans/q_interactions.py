"""Registered queries: interactions, ids, core, splits, weighting, popularity,
candidates and the popularity recommender's evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import evaluate as ev
from cadenza.operators import interactions as it
from cadenza.operators import popularity as pop
from cadenza.operators import ranking as rk
from cadenza.plans.registry import query, rounded
from cadenza.sources import standins as st
from cadenza.sources.tables import read_interactions

# Fixed parameters of the registered queries (pipeline defaults).
SEED, VAL, TEST = 42, 0.1, 0.1
CORE_USER_MIN, CORE_ITEM_MIN = 20, 20
MIN_PLAYS = 30
TOPN, K = 200, 10

I = f"I AS ({st.SQL_I})"
HASH = "('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|' || CAST(item_id AS VARCHAR) || '|{s}'), 1, 8))::BIGINT"


def _sql_split_exact(src: str = "I") -> str:
    h = HASH.format(s=SEED)
    return (f"H AS (SELECT *, {h} AS h FROM {src}), "
            "R AS (SELECT *, row_number() OVER (ORDER BY h, user_id, item_id) - 1 AS r, count(*) OVER () AS n FROM H), "
            f"Z AS (SELECT *, CAST(round_even(CAST(n AS DOUBLE) * {VAL}, 0) AS BIGINT) AS nva, "
            f"CAST(round_even(CAST(n AS DOUBLE) * {TEST}, 0) AS BIGINT) AS nte FROM R), "
            "S AS (SELECT user_id, item_id, plays, CASE WHEN r < n - nva - nte THEN 'train' "
            "WHEN r < n - nte THEN 'val' ELSE 'test' END AS split FROM Z), "
            "TR AS (SELECT user_id, item_id, plays FROM S WHERE split = 'train')")


SPLIT = _sql_split_exact()


def _splits(spark, d):
    return it.split_exact(st.interactions(spark, d), VAL, TEST, SEED)


def _train(spark, d):
    return it.split_of(_splits(spark, d), "train")


@query("interactions_from_orders", sql=f"WITH {I} SELECT * FROM I")
def q_interactions_from_orders(spark, d):
    return st.interactions(spark, d)


@query("interactions_from_events",
       sql=f"SELECT username, artist, CAST(count(*) AS DOUBLE) AS plays FROM ({st.SQL_EVENT_LOG}) "
           "WHERE username IS NOT NULL AND artist IS NOT NULL GROUP BY username, artist")
def q_interactions_from_events(spark, d):
    return read_interactions(st.event_log(spark, d))


@query("rows_per_user", sql="SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def q_rows_per_user(spark, d):
    return it.degrees(st.table(spark, d, "events", "user_id"), "user_id")


@query("log1p_plays", sql=f"WITH {I} SELECT user_id, item_id, round(ln(1 + plays), 6) AS plays FROM I")
def q_log1p_plays(spark, d):
    return rounded(it.log1p_plays(st.interactions(spark, d)), "plays")


@query("min_plays", sql=f"WITH {I} SELECT * FROM I WHERE plays >= {MIN_PLAYS}")
def q_min_plays(spark, d):
    return it.min_plays(st.interactions(spark, d), MIN_PLAYS)


def _sql_core(rounds: int = 6) -> str:
    parts = [I, "C0 AS (SELECT * FROM I)"]
    for k in range(rounds):
        parts.append(
            f"U{k} AS (SELECT * FROM C{k} WHERE user_id IN (SELECT user_id FROM C{k} GROUP BY user_id "
            f"HAVING count(*) >= {CORE_USER_MIN})), "
            f"C{k + 1} AS (SELECT * FROM U{k} WHERE item_id IN (SELECT item_id FROM U{k} GROUP BY item_id "
            f"HAVING count(*) >= {CORE_ITEM_MIN}))")
    return "WITH " + ", ".join(parts) + f" SELECT * FROM C{rounds}"


@query("pq_core", sql=_sql_core())
def q_pq_core(spark, d):
    return it.pq_core(st.interactions(spark, d), CORE_USER_MIN, CORE_ITEM_MIN)


PL_AGG = (f"PL AS (SELECT username, artist, sum(plays) AS plays FROM ({st.SQL_PLAY_LOG}) "
          "GROUP BY username, artist)")


@query("user_dim", sql=f"WITH {PL_AGG} SELECT row_number() OVER (ORDER BY username) - 1 AS user_id, username "
                       "FROM (SELECT DISTINCT username FROM PL)")
def q_user_dim(spark, d):
    users, _ = it.id_maps(read_interactions(st.play_log(spark, d)))
    return users


@query("item_dim", sql=f"WITH {PL_AGG} SELECT row_number() OVER (ORDER BY artist) - 1 AS item_id, "
                       "artist AS item_name FROM (SELECT DISTINCT artist FROM PL)")
def q_item_dim(spark, d):
    _, items = it.id_maps(read_interactions(st.play_log(spark, d)))
    return items


@query("encode_ids", sql=(
    f"WITH {PL_AGG}, UD AS (SELECT row_number() OVER (ORDER BY username) - 1 AS user_id, username "
    "FROM (SELECT DISTINCT username FROM PL)), "
    "ID AS (SELECT row_number() OVER (ORDER BY artist) - 1 AS item_id, artist FROM (SELECT DISTINCT artist FROM PL)) "
    "SELECT UD.user_id, ID.item_id, PL.plays FROM PL JOIN UD USING (username) JOIN ID USING (artist)"))
def q_encode_ids(spark, d):
    named = read_interactions(st.play_log(spark, d))
    users, items = it.id_maps(named)
    return it.encode_ids(named, users, items)


@query("split_hash", sql=(
    f"WITH {I} SELECT user_id, item_id, plays, CASE WHEN u < {1.0 - VAL - TEST!r} THEN 'train' "
    f"WHEN u < {1.0 - TEST!r} THEN 'val' ELSE 'test' END AS split "
    f"FROM (SELECT *, CAST({HASH.format(s=SEED)} AS DOUBLE) / 4294967296.0 AS u FROM I)"))
def q_split_hash(spark, d):
    return it.split_approx(st.interactions(spark, d), VAL, TEST, SEED)


@query("split_exact", sql=f"WITH {I}, {SPLIT} SELECT * FROM S")
def q_split_exact(spark, d):
    return _splits(spark, d)


@query("split_users", sql=f"WITH {I}, {SPLIT} SELECT DISTINCT user_id FROM S WHERE split = 'test'")
def q_split_users(spark, d):
    return it.split_users(_splits(spark, d), "test")


_BM25 = (
    "N AS (SELECT CAST(count(DISTINCT user_id) AS DOUBLE) AS nu FROM I), "
    "DF AS (SELECT item_id, count(*) AS df FROM TR GROUP BY item_id), "
    "UL AS (SELECT user_id, sum(plays) AS len FROM TR GROUP BY user_id), "
    "AV AS (SELECT sum(plays) / (SELECT nu FROM N) AS avglen FROM TR)")


@query("bm25_weight", sql=(
    f"WITH {I}, {SPLIT}, {_BM25} SELECT TR.user_id, TR.item_id, round(plays * ({it.BM25_K1} + 1.0) / "
    f"({it.BM25_K1} * ((1.0 - {it.BM25_B}) + {it.BM25_B} * len / avglen) + plays) * (ln(nu) - ln(1 + df)), 6) AS weight "
    "FROM TR JOIN DF USING (item_id) JOIN UL USING (user_id), N, AV"))
def q_bm25_weight(spark, d):
    inter = st.interactions(spark, d)
    splits = it.split_exact(inter, VAL, TEST, SEED)
    return rounded(it.bm25_weight(it.split_of(splits, "train"), splits), "weight")


@query("tfidf_weight", sql=(
    f"WITH {I}, {SPLIT}, {_BM25} SELECT TR.user_id, TR.item_id, round(sqrt(plays) * (ln(nu) - ln(1 + df)), 6) AS weight "
    "FROM TR JOIN DF USING (item_id), N"))
def q_tfidf_weight(spark, d):
    inter = st.interactions(spark, d)
    splits = it.split_exact(inter, VAL, TEST, SEED)
    return rounded(it.tfidf_weight(it.split_of(splits, "train"), splits), "weight")


def _sql_prior(value: str) -> str:
    return (f"PS AS (SELECT A.item_id, coalesce(s, 0.0) AS s FROM (SELECT DISTINCT item_id FROM I) A "
            f"LEFT JOIN (SELECT item_id, CAST(sum({value}) AS DOUBLE) AS s FROM TR GROUP BY item_id) B USING (item_id)), "
            "PR AS (SELECT item_id, CASE WHEN max(ln(1 + s)) OVER () > 0 THEN ln(1 + s) / max(ln(1 + s)) OVER () "
            "ELSE 0.0 END AS prior FROM PS)")


@query("pop_prior_plays", sql=f"WITH {I}, {SPLIT}, {_sql_prior('plays')} SELECT item_id, round(prior, 6) AS prior FROM PR")
def q_pop_prior_plays(spark, d):
    inter = st.interactions(spark, d)
    splits = it.split_exact(inter, VAL, TEST, SEED)
    return rounded(pop.pop_prior(it.split_of(splits, "train"), splits, "plays"), "prior")


@query("pop_prior_rows", sql=f"WITH {I}, {SPLIT}, {_sql_prior('1')} SELECT item_id, round(prior, 6) AS prior FROM PR")
def q_pop_prior_rows(spark, d):
    inter = st.interactions(spark, d)
    splits = it.split_exact(inter, VAL, TEST, SEED)
    return rounded(pop.pop_prior(it.split_of(splits, "train"), splits, "rows"), "prior")


@query("user_activity", sql=(
    f"WITH {I}, {SPLIT} SELECT user_id, count(DISTINCT item_id) AS user_seen_items, "
    "round(sum(plays), 6) AS user_total_plays, round(avg(plays), 6) AS user_mean_plays FROM TR GROUP BY user_id"))
def q_user_activity(spark, d):
    return rounded(pop.user_activity(_train(spark, d)), "user_total_plays", "user_mean_plays")


@query("item_popularity", sql=(
    f"WITH {I}, {SPLIT} SELECT p_partkey AS item_id, coalesce(u, 0) AS item_pop_users, "
    "round(coalesce(s, 0.0), 6) AS item_pop_plays FROM part LEFT JOIN (SELECT item_id, count(DISTINCT user_id) AS u, "
    "sum(plays) AS s FROM TR GROUP BY item_id) P ON P.item_id = p_partkey"))
def q_item_popularity(spark, d):
    items = st.table(spark, d, "part", "p_partkey").withColumnRenamed("p_partkey", "item_id")
    return rounded(pop.item_popularity(_train(spark, d), items), "item_pop_plays")


def _sql_pop_topn(n: int) -> str:
    return (f"WITH {I}, {SPLIT}, {_sql_prior('plays')}, "
            "C AS (SELECT U.user_id, PR.item_id, PR.prior FROM (SELECT DISTINCT user_id FROM I) U, PR "
            "WHERE NOT EXISTS (SELECT 1 FROM TR WHERE TR.user_id = U.user_id AND TR.item_id = PR.item_id)), "
            "RK AS (SELECT user_id, item_id, prior, row_number() OVER (PARTITION BY user_id ORDER BY prior DESC, item_id) - 1 "
            f"AS rank FROM C) SELECT user_id, item_id, round(prior, 6) AS score, rank FROM RK WHERE rank < {n}")


def pop_candidates(spark, d, n):
    splits = it.split_exact(st.interactions(spark, d), VAL, TEST, SEED)  # checkpointed: reused below
    train = it.split_of(splits, "train")
    prior = pop.pop_prior(train, splits, "plays").withColumnRenamed("prior", "score")
    return rk.topn_unseen_by_item_score(splits.select("user_id"), train, prior, n)


@query("unseen_candidates", sql=_sql_pop_topn(K))
def q_unseen_candidates(spark, d):
    return rounded(pop_candidates(spark, d, K), "score")


@query("candidates_topn", sql=_sql_pop_topn(TOPN))
def q_candidates_topn(spark, d):
    return rounded(pop_candidates(spark, d, TOPN), "score")


_TE = "TE AS (SELECT user_id, item_id FROM S WHERE split = 'test')"


@query("label_join", sql=(
    _sql_pop_topn(K).replace(" SELECT user_id, item_id, round(prior, 6) AS score, rank FROM RK WHERE",
                             f", {_TE}, Q AS (SELECT * FROM RK WHERE") +
    f") SELECT Q.user_id, Q.item_id, round(Q.prior, 6) AS score, Q.rank, "
    "CAST(CASE WHEN TE.item_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS label FROM Q LEFT JOIN TE USING (user_id, item_id)"))
def q_label_join(spark, d):
    test = it.split_of(_splits(spark, d), "test")
    return rk.label_join(rounded(pop_candidates(spark, d, K), "score"), test)


# ---------------------------------------------------------------- ranking metrics on labelled documents
RD = f"R AS ({st.SQL_RANKED_DOCS})"
_SPLIT_FAMILY = (
    "RK AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY {order}) AS pos FROM R), "
    "T AS (SELECT DISTINCT user_id, item_id FROM R WHERE label = 1), "
    "P AS (SELECT user_id, count(*) AS p FROM T GROUP BY user_id), "
    f"TOPK AS (SELECT RK.user_id, RK.item_id, pos, CASE WHEN T.item_id IS NULL THEN 0 ELSE 1 END AS rel "
    f"FROM RK LEFT JOIN T USING (user_id, item_id) WHERE pos <= {K}), "
    "HT AS (SELECT *, sum(rel) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
    "AS hits FROM TOPK), "
    "A AS (SELECT user_id, sum(rel) AS h, sum(CASE WHEN rel > 0 THEN hits / pos END) AS ap, "
    "sum(CASE WHEN rel > 0 THEN 1.0 / log2(pos + 1) END) AS dcg FROM HT GROUP BY user_id), "
    "PU AS (SELECT P.user_id, least(p, {k}) AS m, coalesce(h, 0) AS h, coalesce(ap, 0.0) AS ap, coalesce(dcg, 0.0) AS dcg, "
    "coalesce(list_sum(list_transform(range(1, least(p, {k}) + 1), lambda r: 1.0 / log2(r + 1))), 0.0) AS idcg "
    "FROM P LEFT JOIN A USING (user_id)), "
    "M AS (SELECT user_id, CAST(h AS DOUBLE) / {k} AS precision, ap / m AS ap, "
    "CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0.0 END AS ndcg FROM PU)")
_LIST_FAMILY = (
    "D AS (SELECT user_id, item_id, label, row_number() OVER (PARTITION BY user_id ORDER BY {order}) AS pos, "
    "row_number() OVER (PARTITION BY user_id ORDER BY label DESC, item_id) AS ipos, "
    "sum(CASE WHEN label > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY {order} "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hits, count(*) OVER (PARTITION BY user_id) AS len FROM R), "
    "A2 AS (SELECT user_id, least(max(len), {k}) AS kk, "
    "sum(CASE WHEN pos <= least(len, {k}) AND label > 0 THEN 1 ELSE 0 END) AS h, "
    "sum(CASE WHEN pos <= least(len, {k}) AND label > 0 THEN hits / pos ELSE 0.0 END) AS ap, "
    "sum(CASE WHEN label > 0 THEN 1 ELSE 0 END) AS npos, "
    "sum(CASE WHEN pos <= least(len, {k}) THEN (pow(2.0, label) - 1.0) / log2(pos + 1) ELSE 0.0 END) AS dcg, "
    "sum(CASE WHEN ipos <= least(len, {k}) THEN (pow(2.0, label) - 1.0) / log2(ipos + 1) ELSE 0.0 END) AS idcg "
    "FROM D GROUP BY user_id), "
    "M2 AS (SELECT user_id, CASE WHEN kk > 0 THEN CAST(h AS DOUBLE) / kk ELSE 0.0 END AS precision, "
    "ap / greatest(npos, 1) AS ap, CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0.0 END AS ndcg FROM A2)")
BY_SCORE = "score DESC, item_id"
BY_ID = "item_id"


def _split_sql(col: str) -> str:
    return (f"WITH {RD}, " + _SPLIT_FAMILY.format(order=BY_SCORE, k=K) +
            f" SELECT user_id, round({col}, 6) AS {col} FROM M")


def _list_sql(col: str) -> str:
    return (f"WITH {RD}, " + _LIST_FAMILY.format(order=BY_SCORE, k=K) +
            f" SELECT user_id, round({col}, 6) AS {col} FROM M2")


def _docs_split(spark, d, score="score"):
    r = st.ranked_docs(spark, d)
    ranked = rk.topn(r, score, K, "rank", 0)
    return ev.per_user_split(ranked, r.where("label = 1"), K)


def _docs_list(spark, d, score="score"):
    return ev.per_user_list(st.ranked_docs(spark, d), K, score)


for _m in ("precision", "ap", "ndcg"):
    _qn = {"precision": "precision", "ap": "map", "ndcg": "ndcg"}[_m]

    def _mk_split(col):
        return lambda spark, d: rounded(_docs_split(spark, d).select("user_id", col), col)

    def _mk_list(col):
        return lambda spark, d: rounded(_docs_list(spark, d).select("user_id", col), col)

    query(f"{_qn}_split", sql=_split_sql(_m))(_mk_split(_m))
    query(f"{_qn}_list", sql=_list_sql(_m))(_mk_list(_m))


def _summary_sql(order: str) -> str:
    return (f"{RD}, " + _SPLIT_FAMILY.format(order=order, k=K) + ", " + _LIST_FAMILY.format(order=order, k=K) +
            f", SUMS AS (SELECT CAST({K} AS BIGINT) AS k, 'split' AS family, count(*) AS users, "
            "coalesce(avg(precision), 0.0) AS precision_at_k, coalesce(avg(ap), 0.0) AS map_at_k, "
            "coalesce(avg(ndcg), 0.0) AS ndcg_at_k FROM M "
            f"UNION ALL SELECT CAST({K} AS BIGINT), 'list', count(*), coalesce(avg(precision), 0.0), "
            "coalesce(avg(ap), 0.0), coalesce(avg(ndcg), 0.0) FROM M2)")


@query("eval_summary", sql="WITH " + _summary_sql(BY_SCORE) +
       " SELECT k, family, users, round(precision_at_k, 6) AS precision_at_k, round(map_at_k, 6) AS map_at_k, "
       "round(ndcg_at_k, 6) AS ndcg_at_k FROM SUMS")
def q_eval_summary(spark, d):
    s = ev.summarize(_docs_split(spark, d), K, "split").unionByName(ev.summarize(_docs_list(spark, d), K, "list"))
    return rounded(s, "precision_at_k", "map_at_k", "ndcg_at_k")


def _docs_by_id(spark, d):
    return st.ranked_docs(spark, d).withColumn("score", -F.col("item_id").cast("double"))


@query("eval_delta", sql=(
    "WITH B AS (WITH " + _summary_sql(BY_ID) + " SELECT * FROM SUMS), "
    "NW AS (WITH " + _summary_sql(BY_SCORE) + " SELECT * FROM SUMS) "
    "SELECT family, round(NW.precision_at_k - B.precision_at_k, 6) AS delta_precision_at_k, "
    "round(CASE WHEN B.precision_at_k <> 0 THEN (NW.precision_at_k - B.precision_at_k) / B.precision_at_k END, 6) "
    "AS rel_precision_at_k, round(NW.map_at_k - B.map_at_k, 6) AS delta_map_at_k, "
    "round(CASE WHEN B.map_at_k <> 0 THEN (NW.map_at_k - B.map_at_k) / B.map_at_k END, 6) AS rel_map_at_k, "
    "round(NW.ndcg_at_k - B.ndcg_at_k, 6) AS delta_ndcg_at_k, "
    "round(CASE WHEN B.ndcg_at_k <> 0 THEN (NW.ndcg_at_k - B.ndcg_at_k) / B.ndcg_at_k END, 6) AS rel_ndcg_at_k "
    "FROM B JOIN NW USING (family)"))
def q_eval_delta(spark, d):
    def summ(r):
        ranked = rk.topn(r, "score", K, "rank", 0)
        return ev.summarize(ev.per_user_split(ranked, r.where("label = 1"), K), K, "split").unionByName(
            ev.summarize(ev.per_user_list(r, K, "score"), K, "list"))
    base = summ(_docs_by_id(spark, d))
    new = summ(st.ranked_docs(spark, d))
    out = ev.eval_delta(base, new)
    return rounded(out, *[c for c in out.columns if c != "family"])


@query("pop_eval_summary", sql=(
    _sql_pop_topn(K).replace(" SELECT user_id, item_id, round(prior, 6) AS score, rank FROM RK WHERE",
                             f", {_TE}, Q AS (SELECT * FROM RK WHERE") +
    "), RK2 AS (SELECT user_id, item_id, rank + 1 AS pos FROM Q), T AS (SELECT * FROM TE), "
    "P AS (SELECT user_id, count(*) AS p FROM T GROUP BY user_id), "
    "TOPK AS (SELECT RK2.user_id, RK2.item_id, pos, CASE WHEN T.item_id IS NULL THEN 0 ELSE 1 END AS rel "
    "FROM RK2 LEFT JOIN T USING (user_id, item_id)), "
    "HT AS (SELECT *, sum(rel) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
    "AS hits FROM TOPK), "
    "A AS (SELECT user_id, sum(rel) AS h, sum(CASE WHEN rel > 0 THEN hits / pos END) AS ap, "
    "sum(CASE WHEN rel > 0 THEN 1.0 / log2(pos + 1) END) AS dcg FROM HT GROUP BY user_id), "
    f"PU AS (SELECT P.user_id, least(p, {K}) AS m, coalesce(h, 0) AS h, coalesce(ap, 0.0) AS ap, "
    f"coalesce(dcg, 0.0) AS dcg, coalesce(list_sum(list_transform(range(1, least(p, {K}) + 1), "
    "lambda r: 1.0 / log2(r + 1))), 0.0) AS idcg FROM P LEFT JOIN A USING (user_id)) "
    f"SELECT CAST({K} AS BIGINT) AS k, 'split' AS family, count(*) AS users, "
    f"round(coalesce(avg(CAST(h AS DOUBLE) / {K}), 0.0), 6) AS precision_at_k, "
    "round(coalesce(avg(ap / m), 0.0), 6) AS map_at_k, "
    "round(coalesce(avg(CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0.0 END), 0.0), 6) AS ndcg_at_k FROM PU"))
def q_pop_eval_summary(spark, d):
    splits = it.split_exact(st.interactions(spark, d), VAL, TEST, SEED)
    train, test = it.split_of(splits, "train"), it.split_of(splits, "test")
    prior = pop.pop_prior(train, splits, "plays").withColumnRenamed("prior", "score")
    ranked = rk.topn_unseen_by_item_score(splits.select("user_id"), train, prior, K)
    s = ev.summarize(ev.per_user_split(ranked, test, K), K, "split")
    return rounded(s, "precision_at_k", "map_at_k", "ndcg_at_k")
