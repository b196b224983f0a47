"""Registered queries: text keys, list parsing, null rules, the name join family
and the artist → track expansion."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cadenza.functions import numeric as nf
from cadenza.functions import text as tx
from cadenza.operators import namejoin as nj
from cadenza.operators.textjoin import contains_join
from cadenza.plans.registry import query, rounded
from cadenza.session import cut_table
from cadenza.sources import standins as st

# ---------------------------------------------------------------- the text corpus for the key functions
SQL_NAMES = (
    "SELECT 'part' AS src, p_partkey AS id, p_name || ' ' || p_brand AS name FROM part "
    "UNION ALL SELECT 'accented', p_partkey, "
    f"translate(p_name || ' ' || p_brand, '{st.ACCENT_FROM}', '{st.ACCENT_TO}') FROM part "
    "UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier "
    "UNION ALL SELECT 'customer', c_custkey, c_name FROM customer "
    "UNION ALL SELECT 'nation', CAST(n_nationkey AS BIGINT), n_name FROM nation "
    "UNION ALL SELECT 'document', doc_id, text FROM documents")


def names(spark, d):
    t = lambda n, *c: st.table(spark, d, n, *c)
    nm = F.concat_ws(" ", "p_name", "p_brand")
    parts = [
        t("part", "p_partkey", "p_name", "p_brand").select(F.lit("part").alias("src"), F.col("p_partkey").alias("id"),
                                                           nm.alias("name")),
        t("part", "p_partkey", "p_name", "p_brand").select(F.lit("accented"), "p_partkey",
                                                           F.translate(nm, st.ACCENT_FROM, st.ACCENT_TO)),
        t("supplier", "s_suppkey", "s_name").select(F.lit("supplier"), "s_suppkey", "s_name"),
        t("customer", "c_custkey", "c_name").select(F.lit("customer"), "c_custkey", "c_name"),
        t("nation", "n_nationkey", "n_name").select(F.lit("nation"), F.col("n_nationkey").cast("long"), "n_name"),
        t("documents", "doc_id", "text").select(F.lit("document"), "doc_id", "text"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _key_query(name, fn, sql_expr):
    @query(name, sql=f"SELECT src, id, {sql_expr} AS key FROM ({SQL_NAMES})")
    def q(spark, d):
        return names(spark, d).select("src", "id", fn("name").alias("key"))
    return q


_key_query("key_exact", tx.key_exact, "name")
_key_query("key_basic", tx.key_basic, f"regexp_replace(lower(name), '^{tx.BLANKS}+|{tx.BLANKS}+$', '', 'g')")
_key_query("key_loose", tx.key_loose, "regexp_replace(lower(strip_accents(name)), '[^a-z0-9]+', '', 'g')")
_key_query("normalize_alnum", tx.normalize_alnum,
           r"regexp_replace(lower(strip_accents(name)), '[^\p{L}\p{N}]', '', 'g')")
_key_query("key_word", tx.key_word,
           r"regexp_replace(regexp_replace(lower(strip_accents(name)), '[\s\-_]+', '', 'g'), '[^\p{L}\p{N}_]', '', 'g')")

# ---------------------------------------------------------------- list-as-text
SQL_LISTS = (
    f"SELECT 'genres' AS src, item_id AS id, genres_text AS s FROM ({st.SQL_ITEMS}) "
    "UNION ALL SELECT 'plain', p_partkey, replace(p_name, ' ', ', ') FROM part "
    f"UNION ALL SELECT 'artists', track_id, artists FROM ({st.SQL_PLAYLIST_TRACKS})")
_SQL_SPLIT_LIST = (
    "list_filter(list_transform(string_split(regexp_replace(trim(s), '^\\[|\\]$', '', 'g'), ','), "
    "lambda x: regexp_replace(x, '^[ ''\"]+|[ ''\"]+$', '', 'g')), lambda x: length(trim(x)) > 0 AND x <> 'None')")


def lists(spark, d):
    it = st.items(spark, d).select(F.lit("genres").alias("src"), F.col("item_id").alias("id"),
                                   F.col("genres_text").alias("s"))
    pl = st.table(spark, d, "part", "p_partkey", "p_name").select(
        F.lit("plain"), "p_partkey", F.replace("p_name", F.lit(" "), F.lit(", ")))
    tr = st.playlist_tracks(spark, d).select(F.lit("artists"), "track_id", "artists")
    return it.union(pl).union(tr)


@query("parse_list", sql=f"SELECT src, id, CAST(len(L) AS BIGINT) AS n_items, array_to_string(L, '|') AS items "
                         f"FROM (SELECT src, id, {_SQL_SPLIT_LIST} AS L FROM ({SQL_LISTS}))")
def q_parse_list(spark, d):
    return lists(spark, d).select("src", "id", tx.parse_list("s").alias("L")).select(
        "src", "id", F.size("L").cast("long").alias("n_items"), F.array_join("L", "|").alias("items"))


@query("primary_artist", sql=f"SELECT id AS track_id, CASE WHEN s LIKE '[%' THEN {_SQL_SPLIT_LIST}[1] END AS primary_artist "
                             f"FROM ({SQL_LISTS}) WHERE src = 'artists'")
def q_primary_artist(spark, d):
    return st.playlist_tracks(spark, d).select("track_id", tx.primary_item("artists").alias("primary_artist"))


SQL_GENRE_TEXT = (f"SELECT item_id AS id, genres_text AS s FROM ({st.SQL_ITEMS}) "
                  "UNION ALL SELECT -p_partkey - 1, replace(p_name, ' ', '|') || '|' || p_type FROM part")


@query("genre_tokens", sql=(
    "SELECT id, array_to_string(CASE WHEN s LIKE '[%]' THEN " + _SQL_SPLIT_LIST +
    " ELSE list_filter(list_transform(string_split(replace(s, '|', ','), ','), lambda x: trim(x)), "
    f"lambda x: length(x) > 0) END, ',') AS tokens FROM ({SQL_GENRE_TEXT})"))
def q_genre_tokens(spark, d):
    it = st.items(spark, d).select(F.col("item_id").alias("id"), F.col("genres_text").alias("s"))
    p = st.table(spark, d, "part", "p_partkey", "p_name", "p_type").select(
        (-F.col("p_partkey") - 1).alias("id"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("|")), F.lit("|"), F.col("p_type")).alias("s"))
    return it.union(p).select("id", F.array_join(tx.genre_tokens("s"), ",").alias("tokens"))


# ---------------------------------------------------------------- null rules
_KNOWN = ", ".join(f"'{v}'" for v in nf.BOOL_TRUE + nf.BOOL_FALSE)
_TRUE = ", ".join(f"'{v}'" for v in nf.BOOL_TRUE)


def _sql_bool(c: str, share: str) -> str:
    return (f"CASE WHEN {share} >= {nf.BOOL_MIN_SHARE} THEN (CASE WHEN lower({c}) IN ({_TRUE}) THEN 1.0 ELSE 0.0 END) "
            f"ELSE coalesce(TRY_CAST({c} AS DOUBLE), 0.0) END")


@query("boolize", sql=(
    "WITH B AS (SELECT d.doc_id, CAST(l.quality AS VARCHAR) AS quality, CAST(l.toxic AS VARCHAR) AS toxic, d.lang "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id), "
    f"S AS (SELECT avg(CASE WHEN lower(quality) IN ({_KNOWN}) THEN 1.0 ELSE 0.0 END) AS sq, "
    f"avg(CASE WHEN lower(lang) IN ({_KNOWN}) THEN 1.0 ELSE 0.0 END) AS sl FROM B), "
    "L AS (SELECT l.doc_id, CAST(l.toxic AS VARCHAR) AS toxic FROM labels l), "
    f"S2 AS (SELECT avg(CASE WHEN lower(toxic) IN ({_KNOWN}) THEN 1.0 ELSE 0.0 END) AS st FROM L) "
    f"SELECT B.doc_id, {_sql_bool('quality', 'sq')} AS quality, {_sql_bool('lang', 'sl')} AS lang, "
    f"CASE WHEN B.toxic IS NULL THEN NULL ELSE {_sql_bool('B.toxic', 'st')} END AS toxic FROM B, S, S2"))
def q_boolize(spark, d):
    docs = st.table(spark, d, "documents", "doc_id", "lang")
    lab = st.table(spark, d, "labels", "doc_id", "quality", "toxic")
    b = docs.join(lab, "doc_id", "left").select(
        "doc_id", F.col("quality").cast("string").alias("quality"), F.col("toxic").cast("string").alias("toxic"), "lang")
    out = nf.boolize(b.drop("toxic"), ["quality", "lang"])
    tox = nf.boolize(lab.select("doc_id", F.col("toxic").cast("string").alias("toxic")), ["toxic"])
    return out.join(tox, "doc_id", "left").select("doc_id", "quality", "lang", "toxic")


@query("safe_numeric", sql=(
    "SELECT event_id, coalesce(TRY_CAST(value AS DOUBLE), 0.0) AS value, coalesce(TRY_CAST(props AS DOUBLE), 0.0) AS props, "
    "coalesce(TRY_CAST(nullif(regexp_extract(props, '[0-9]+'), '') AS DOUBLE), 0.0) AS k, "
    "coalesce(TRY_CAST(nullif(regexp_extract(props, '[0-9]+'), '') AS BIGINT), -1) AS k_id FROM events"))
def q_safe_numeric(spark, d):
    e = st.table(spark, d, "events", "event_id", "value", "props")
    k = F.nullif(F.regexp_extract("props", "[0-9]+", 0), F.lit(""))
    return e.select("event_id", nf.safe_double("value").alias("value"), nf.safe_double("props").alias("props"),
                    nf.safe_double(k).alias("k"), nf.safe_id(k).alias("k_id"))


# ---------------------------------------------------------------- name join family
NUM = ["size", "price"]
PL = f"PL AS (SELECT username, artist, sum(plays) AS plays FROM ({st.SQL_PLAY_LOG}) GROUP BY username, artist)"
CAT_BASIC = (f"CAT AS (SELECT regexp_replace(lower(artist_name), '^\\s+|\\s+$', '', 'g') AS key, * FROM ({st.SQL_CATALOG})), "
             "CM AS (SELECT key, artist_id, avg(size) AS size, avg(price) AS price FROM CAT WHERE key <> '' "
             "GROUP BY key, artist_id)")
CAT_DEDUP = ", CM1 AS (SELECT * FROM CM QUALIFY row_number() OVER (PARTITION BY key ORDER BY price DESC, artist_id) = 1)"
PLK = "PLK AS (SELECT *, nullif(regexp_replace(lower(artist), '^\\s+|\\s+$', '', 'g'), '') AS key FROM PL)"


def _joined(spark, d, fanout):
    agg = nj.aggregate_log(st.play_log(spark, d))
    return nj.name_join(agg, st.catalog(spark, d), NUM, "basic", fanout, "price")


@query("name_join", sql=(
    f"WITH {PL}, {CAT_BASIC}, {PLK} SELECT username, artist, artist_id, sum(plays) AS plays "
    "FROM PLK JOIN CM USING (key) GROUP BY username, artist, artist_id"))
def q_name_join(spark, d):
    return nj.matched(_joined(spark, d, True), unique=True)


@query("name_join_dedup", sql=(
    f"WITH {PL}, {CAT_BASIC}{CAT_DEDUP}, {PLK} SELECT username, artist, artist_id, sum(plays) AS plays "
    "FROM PLK JOIN CM1 USING (key) GROUP BY username, artist, artist_id"))
def q_name_join_dedup(spark, d):
    return nj.matched(_joined(spark, d, False), unique=True)


@query("joined_with_features", sql=(
    f"WITH {PL}, {CAT_BASIC}{CAT_DEDUP}, {PLK}, J AS (SELECT * FROM PLK JOIN CM1 USING (key)), "
    "F AS (SELECT artist_id, avg(size) AS size, avg(price) AS price FROM J GROUP BY artist_id) "
    "SELECT username, artist, artist_id, sum(plays) AS plays, any_value(F.size) AS size, "
    "round(any_value(F.price), 6) AS price FROM J JOIN F USING (artist_id) GROUP BY username, artist, artist_id"))
def q_joined_with_features(spark, d):
    return rounded(nj.with_features(_joined(spark, d, False), NUM, unique=True), "price")


@query("unmatched_items", sql=(
    f"WITH {PL}, {CAT_BASIC}{CAT_DEDUP}, {PLK} SELECT artist, sum(plays) AS plays FROM PLK "
    "WHERE key IS NULL OR key NOT IN (SELECT key FROM CM1) GROUP BY artist"))
def q_unmatched_items(spark, d):
    return nj.unmatched(_joined(spark, d, False))


@query("representative_name", sql=(
    f"WITH {PL}, {CAT_BASIC}{CAT_DEDUP}, {PLK}, S AS (SELECT artist_id, artist, sum(plays) AS plays "
    "FROM PLK JOIN CM1 USING (key) GROUP BY artist_id, artist) "
    "SELECT artist_id, artist AS artist_name FROM S "
    "QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY plays DESC, artist) = 1"))
def q_representative_name(spark, d):
    return nj.representative_name(_joined(spark, d, False))


@query("join_coverage", sql=(
    f"WITH {PL}, {CAT_BASIC}{CAT_DEDUP}, {PLK} SELECT "
    f"(SELECT count(*) FROM ({st.SQL_PLAY_LOG})) AS log_rows, (SELECT count(*) FROM PL) AS agg_pairs, "
    "(SELECT count(*) FROM (SELECT DISTINCT username, artist, artist_id FROM PLK JOIN CM1 USING (key))) AS matched_rows, "
    "(SELECT count(DISTINCT artist) FROM PLK WHERE key IS NULL OR key NOT IN (SELECT key FROM CM1)) AS unmatched_artists"))
def q_join_coverage(spark, d):
    log = st.play_log(spark, d)
    agg = nj.aggregate_log(log)
    joined = nj.name_join(agg, st.catalog(spark, d), NUM, "basic", False, "price")
    return nj.join_coverage(log, agg, joined)


_ALNUM = r"nullif(regexp_replace(lower(strip_accents({c})), '[^\p{{L}}\p{{N}}]', '', 'g'), '')"


@query("coverage_report", sql=(
    f"WITH K AS (SELECT DISTINCT {_ALNUM.format(c='artist_name')} AS key FROM ({st.SQL_CATALOG})), "
    f"LK AS (SELECT {_ALNUM.format(c='artist')} AS key FROM ({st.SQL_PLAY_LOG})), "
    "F AS (SELECT LK.key, K.key IS NOT NULL AND LK.key IS NOT NULL AS hit FROM LK LEFT JOIN K ON LK.key = K.key), "
    "C AS (SELECT count(*) AS total_rows, CAST(sum(CAST(hit AS BIGINT)) AS BIGINT) AS mapped_rows, "
    "count(DISTINCT coalesce(key, '')) AS unique_artist_keys, count(DISTINCT CASE WHEN hit THEN key END) "
    "AS unique_artist_keys_mapped FROM F) "
    "SELECT round_even(mapped_rows * 100.0 / greatest(total_rows, 1), 2) AS row_coverage_pct, "
    "round_even(unique_artist_keys_mapped * 100.0 / greatest(unique_artist_keys, 1), 2) AS unique_artist_coverage_pct, "
    "total_rows, mapped_rows, unique_artist_keys, unique_artist_keys_mapped FROM C"))
def q_coverage_report(spark, d):
    return nj.coverage_report(st.play_log(spark, d), st.catalog(spark, d), "alnum")


# ---------------------------------------------------------------- artist → tracks
RECS = (f"RC AS (SELECT user_id, item_id, round(plays / max(plays) OVER (PARTITION BY user_id), 6) AS base_score "
        f"FROM ({st.SQL_I}))")
ITEMNAMES = f"IN_ AS (SELECT item_id, item_name FROM ({st.SQL_ITEMS}))"
TRK = f"TRK AS ({st.SQL_PLAYLIST_TRACKS})"
TRACK_COLS = "track_id, track_name, tempo, valence, popularity"
N_TRACKS = 2


def recs(spark, d):
    """Per-user scores in [0, 1]: plays / the user's max plays. The pairs lie by user, so that the max is taken where they
    are (a window, which spills what is too much for memory); without a user there is no score."""
    i = st.interactions(spark, d, by="user_id").where(F.col("user_id").isNotNull())
    mx = F.max("plays").over(Window.partitionBy("user_id"))
    return i.select("user_id", "item_id", nf.stable_round(F.col("plays") / mx).alias("base_score"))


def best_tracks_contains(spark, d, n=N_TRACKS):
    """J9 (substring): per catalog artist, the n most popular tracks whose artist
    text contains the name, case-insensitive (literal, not a regex)."""
    items = st.items(spark, d).select("item_id", "item_name")
    tr = cut_table(st.playlist_tracks(spark, d))  # read for the grams, the matches and the columns
    # items of the same name match the same tracks: the best n are found once a name, with the place of equal rows of a track
    # (an item that is there twice with one name has no match, as in contains_join)
    named = items.groupBy("item_id", F.lower("item_name").alias("name")).agg(F.count(F.lit(1)).alias("__c")).where("__c = 1").drop("__c")
    pairs = contains_join(named.select("name").distinct(), tr, "name", "name", "track_id", "artists")
    order = [F.col("popularity").desc(), F.col("track_id").asc()]
    j = pairs.join(tr.drop("artists"), "track_id")
    cut = j.withColumn("__rn", F.row_number().over(Window.partitionBy("name").orderBy(*order))).where(F.col("__rn") <= n).drop("__rn")
    cut = cut.withColumn("__copy", F.row_number().over(Window.partitionBy("name", "track_id").orderBy(*order)))
    per_item = named.join(cut, "name").drop("name").distinct()
    w = Window.partitionBy("item_id").orderBy(*order)
    best = per_item.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn", "__copy")
    return best.join(items, "item_id")


def best_tracks_exact(spark, d, n=N_TRACKS):
    """J9 (scalable equi-join): tracks exploded to their artist ids. The best tracks lie by item, so only items move to them."""
    items = st.items(spark, d).select("item_id", "item_name").hint("merge")
    tr = st.playlist_tracks(spark, d, artists=False)
    j = st.playlist_track_items(spark, d).join(tr, "track_id")
    w = Window.partitionBy("item_id").orderBy(F.col("popularity").desc(), F.col("track_id").asc())
    best = j.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")
    return best.join(items, "item_id")


def expand(spark, d, best):
    return recs(spark, d).join(best, "item_id").select(
        "user_id", "item_id", F.col("item_name").alias("artist_name"), "track_id", "track_name", "tempo", "valence",
        "popularity", "base_score")


def expand_by_user(spark, d, best):
    """``expand`` (but for track names) with the rows dealt by user: pairs meet the tracks where their items lie, and the user's max
    plays, over all pairs with and without tracks, is taken where the rows arrive."""
    i = st.interactions(spark, d, by="item_id").where(F.col("user_id").isNotNull())
    b = best.select("item_id", F.col("item_name").alias("artist_name"), "track_id", "tempo", "valence", "popularity")
    mx = F.max("plays").over(Window.partitionBy("user_id"))
    j = i.join(b, "item_id", "left").repartition("user_id").withColumn("base_score", nf.stable_round(F.col("plays") / mx))
    return j.where(F.col("track_id").isNotNull()).drop("plays")


_EXPAND_SELECT = ("SELECT RC.user_id, RC.item_id, B.item_name AS artist_name, B.track_id, B.track_name, B.tempo, "
                  "B.valence, B.popularity, RC.base_score FROM RC JOIN B USING (item_id)")


@query("track_expand_contains", sql=(
    f"WITH {RECS}, {ITEMNAMES}, {TRK}, B AS (SELECT IN_.item_id, IN_.item_name, {TRACK_COLS} FROM IN_ JOIN TRK "
    "ON contains(lower(TRK.artists), lower(IN_.item_name)) "
    f"QUALIFY row_number() OVER (PARTITION BY IN_.item_id ORDER BY popularity DESC, track_id) <= {N_TRACKS}) "
    + _EXPAND_SELECT))
def q_track_expand_contains(spark, d):
    return expand(spark, d, best_tracks_contains(spark, d))


@query("track_expand_exact", sql=(
    f"WITH {RECS}, {ITEMNAMES}, {TRK}, B AS (SELECT IN_.item_id, IN_.item_name, {TRACK_COLS} FROM IN_ "
    f"JOIN ({st.SQL_PLAYLIST_TRACK_ARTISTS}) TA ON TA.item_id = IN_.item_id JOIN TRK USING (track_id) "
    f"QUALIFY row_number() OVER (PARTITION BY IN_.item_id ORDER BY popularity DESC, track_id) <= {N_TRACKS}) "
    + _EXPAND_SELECT))
def q_track_expand_exact(spark, d):
    return expand(spark, d, best_tracks_exact(spark, d))
