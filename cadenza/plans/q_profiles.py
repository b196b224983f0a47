"""Registered queries: user profiles, genre distribution, name-key popularity,
id maps and display names."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import profiles as pf
from cadenza.plans import q_interactions as qi
from cadenza.plans.registry import query, rounded
from cadenza.sources import standins as st
from cadenza.sources.tables import read_interactions

NUM, CAT, GEN = ["size", "price_cents"], ["explicit"], "genres_text"
K3 = pf.TOPK_GENRES

_SPLIT_PREFIX = f"{qi.I}, {qi.SPLIT}"
_ITEMF = (f"IT AS ({st.SQL_ITEMS}), "
          "BS AS (SELECT avg(CASE WHEN lower(explicit_text) IN ('true','yes','y','1','false','no','n','0') "
          "THEN 1.0 ELSE 0.0 END) AS sh FROM IT), "
          "IF_ AS (SELECT item_id, size, price_cents, CASE WHEN sh >= 0.8 THEN (CASE WHEN lower(explicit_text) IN "
          "('true','yes','y','1') THEN 1.0 ELSE 0.0 END) ELSE coalesce(TRY_CAST(explicit_text AS DOUBLE), 0.0) END "
          "AS explicit, coalesce(genres_text, '') AS genres_text FROM IT, BS)")
_DF = "DF AS (SELECT TR.user_id, TR.plays, IF_.* EXCLUDE (item_id) FROM TR LEFT JOIN IF_ USING (item_id) WHERE TR.plays > 0)"
_TOKENS = ("CASE WHEN genres_text LIKE '[%]' THEN list_filter(list_transform(string_split(regexp_replace(trim(genres_text), "
           "'^\\[|\\]$', '', 'g'), ','), lambda x: trim(regexp_replace(x, '^[ ''\"]+|[ ''\"]+$', '', 'g'))), "
           "lambda x: length(trim(x)) > 0 AND x <> 'None') ELSE list_filter(list_transform(string_split("
           "replace(genres_text, '|', ','), ','), lambda x: trim(x)), lambda x: length(x) > 0) END")
_DIST = (f"TK AS (SELECT user_id, plays, {_TOKENS} AS tok FROM DF), "
         "BAG AS (SELECT user_id, genre, sum(s) AS b FROM (SELECT user_id, plays / len(tok) AS s, unnest(tok) AS genre "
         "FROM TK WHERE len(tok) > 0) GROUP BY user_id, genre), "
         "DIST AS (SELECT user_id, genre, b / sum(b) OVER (PARTITION BY user_id) AS p FROM BAG)")
_TOPK = ("TOPK AS (SELECT user_id, " + ", ".join(
    f"max(CASE WHEN rn = {i} THEN genre END) AS user_genre_top{i}" for i in range(1, K3 + 1)) +
    " FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY p DESC, genre) AS rn FROM DIST) "
    f"WHERE rn <= {K3} GROUP BY user_id)")
_ENT = "ENT AS (SELECT user_id, -sum(p * log2(p)) AS user_genre_entropy FROM DIST WHERE p > 0 GROUP BY user_id)"
_NUMP = ("NP AS (SELECT user_id, " + ", ".join(
    f"coalesce(sum(plays * {c}) / nullif(sum(CASE WHEN {c} IS NOT NULL THEN plays END), 0.0), 0.0) AS uf_{c}"
    for c in NUM) + ", sum(plays * coalesce(explicit, 0.0)) / sum(plays) AS uf_explicit FROM DF GROUP BY user_id)")
PROFILE_SQL = f"{_SPLIT_PREFIX}, {_ITEMF}, {_DF}, {_DIST}, {_TOPK}, {_ENT}, {_NUMP}"


def _profiles(spark, d):
    feats = pf.item_features(st.items(spark, d).withColumnRenamed("explicit_text", "explicit"), NUM, CAT, GEN)
    return pf.user_profiles(qi._train(spark, d), feats, NUM, CAT, GEN)


def _df(spark, d):
    feats = pf.item_features(st.items(spark, d).withColumnRenamed("explicit_text", "explicit"), NUM, CAT, GEN)
    return pf.profile_input(qi._train(spark, d), feats, NUM, CAT, GEN)


@query("user_profiles", sql=(
    f"WITH {PROFILE_SQL} SELECT NP.user_id, round(uf_size, 6) AS uf_size, round(uf_price_cents, 6) AS uf_price_cents, "
    "round(uf_explicit, 6) AS uf_explicit, " + ", ".join(f"user_genre_top{i}" for i in range(1, K3 + 1)) +
    ", round(coalesce(user_genre_entropy, 0.0), 6) AS user_genre_entropy "
    "FROM NP LEFT JOIN TOPK USING (user_id) LEFT JOIN ENT USING (user_id)"))
def q_user_profiles(spark, d):
    return rounded(_profiles(spark, d), "uf_size", "uf_price_cents", "uf_explicit", "user_genre_entropy")


@query("user_genre_dist", sql=f"WITH {PROFILE_SQL} SELECT user_id, genre, round(p, 6) AS p FROM DIST")
def q_user_genre_dist(spark, d):
    return rounded(pf.genre_distribution(_df(spark, d), GEN), "p")


@query("user_genre_entropy", sql=f"WITH {PROFILE_SQL} SELECT user_id, round(user_genre_entropy, 6) AS user_genre_entropy FROM ENT")
def q_user_genre_entropy(spark, d):
    return rounded(pf.genre_entropy(pf.genre_distribution(_df(spark, d), GEN)), "user_genre_entropy")


@query("user_genre_topk", sql=f"WITH {PROFILE_SQL} SELECT * FROM TOPK")
def q_user_genre_topk(spark, d):
    return pf.genre_topk(pf.genre_distribution(_df(spark, d), GEN))


_WORDKEY = ("nullif(regexp_replace(regexp_replace(lower(strip_accents({c})), '[\\s\\-_]+', '', 'g'), "
            "'[^\\p{{L}}\\p{{N}}_]', '', 'g'), '')")


@query("popularity_by_name", sql=(
    f"WITH PL AS (SELECT username, artist, sum(plays) AS plays FROM ({st.SQL_PLAY_LOG}) GROUP BY username, artist), "
    f"IK AS (SELECT item_id, {_WORDKEY.format(c='item_name')} AS key FROM ({st.SQL_ITEMS})), "
    "F1 AS (SELECT * FROM IK WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY item_id) = 1) "
    f"SELECT item_id, count(DISTINCT username) AS item_pop_users, sum(plays) AS item_pop_plays "
    f"FROM (SELECT *, {_WORDKEY.format(c='artist')} AS key FROM PL) JOIN F1 USING (key) GROUP BY item_id"))
def q_popularity_by_name(spark, d):
    named = read_interactions(st.play_log(spark, d))
    return pf.popularity_by_name(named, st.items(spark, d), "word")


_BY_NAME = (f"PL AS (SELECT username, artist, sum(plays) AS plays FROM ({st.SQL_PLAY_LOG}) GROUP BY username, artist), "
            f"IK AS (SELECT item_id, {_WORDKEY.format(c='item_name')} AS key FROM ({st.SQL_ITEMS})), "
            "F1 AS (SELECT * FROM IK WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY item_id) = 1), "
            f"TR AS (SELECT username AS user_id, item_id, sum(plays) AS plays FROM (SELECT *, {_WORDKEY.format(c='artist')} AS key FROM PL) "
            "JOIN F1 USING (key) GROUP BY username, item_id)")


@query("user_profiles_by_name", sql=(
    f"WITH {_BY_NAME}, {_ITEMF}, {_DF}, {_DIST}, {_TOPK}, {_ENT}, {_NUMP} SELECT NP.user_id, round(uf_size, 6) AS uf_size, "
    "round(uf_price_cents, 6) AS uf_price_cents, round(uf_explicit, 6) AS uf_explicit, " + ", ".join(f"user_genre_top{i}" for i in range(1, K3 + 1)) +
    ", round(coalesce(user_genre_entropy, 0.0), 6) AS user_genre_entropy "
    "FROM NP LEFT JOIN TOPK USING (user_id) LEFT JOIN ENT USING (user_id)"))
def q_user_profiles_by_name(spark, d):
    """Profiles of a play log that has names only."""
    items = st.items(spark, d)
    feats = pf.item_features(items.withColumnRenamed("explicit_text", "explicit"), NUM, CAT, GEN)
    pairs = pf.named_pairs(read_interactions(st.play_log(spark, d)), items, "word")
    return rounded(pf.user_profiles(pairs, feats, NUM, CAT, GEN), "uf_size", "uf_price_cents", "uf_explicit", "user_genre_entropy")


@query("id_map_fallback", sql=(
    f"WITH {qi.I}, M AS (SELECT p_partkey AS old_item_id, 'item-' || CAST(p_partkey AS VARCHAR) AS artist_id "
    "FROM part WHERE p_size > 25) SELECT user_id, item_id, plays, coalesce(M.artist_id, CAST(item_id AS VARCHAR)) "
    "AS item_key FROM I LEFT JOIN M ON M.old_item_id = I.item_id"))
def q_id_map_fallback(spark, d):
    p = st.table(spark, d, "part", "p_partkey", "p_size").where(F.col("p_size") > 25)
    m = p.select(F.col("p_partkey").alias("old_item_id"),
                 F.concat(F.lit("item-"), F.col("p_partkey").cast("string")).alias("artist_id"))
    return pf.map_ids(st.interactions(spark, d), m)


@query("id_to_name", sql=(f"WITH {qi.I} SELECT user_id, item_id, plays, p_name || ' ' || p_brand AS item_name "
                          "FROM I LEFT JOIN part ON p_partkey = item_id"))
def q_id_to_name(spark, d):
    return pf.attach_names(st.interactions(spark, d), st.items(spark, d))


@query("attach_names", sql=(
    qi._sql_pop_topn(qi.K).replace("SELECT user_id, item_id, round(prior, 6) AS score, rank FROM RK WHERE rank <",
                                   "SELECT RK.user_id, RK.item_id, round(prior, 6) AS score, rank, p_name || ' ' || "
                                   "p_brand AS item_name FROM RK LEFT JOIN part ON p_partkey = RK.item_id WHERE rank <")))
def q_attach_names(spark, d):
    return pf.attach_names(rounded(qi.pop_candidates(spark, d, qi.K), "score"), st.items(spark, d))
