"""The recommendation domain expressed over the driver tables.

Each stand-in has a DataFrame builder and the equivalent SQL (used by the
oracle). Roles:

* interactions ``I``: customers play parts — (o_custkey, l_partkey, Σ l_quantity)
* raw log without plays: ``events`` (user_id, event_type), one row per event
* item catalog: ``part`` — name = p_name + ' ' + p_brand; numerics p_size,
  p_retailprice; genre text = list literal of the p_name words
* play log with display names: lineitem ⋈ orders ⋈ part where the artist text is
  the catalog name, upper-cased or given accents by a rule on the part key
* tracks for artist vectors: ``orders`` (ordinal o_orderkey) whose artists are the
  distinct suppliers of their lines; artists = ``supplier`` with genres
  [nation, region] present only for every tenth supplier, so imputation must run
* tracks for playlists: ``orders`` whose artists are their parts (text list in line
  order), tempo / valence / popularity derived from the order
* factors: ``embeddings`` — every vector is both a user and an item
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.sources.tables import table

# ---------------------------------------------------------------- interactions
SQL_I = ("SELECT o_custkey AS user_id, l_partkey AS item_id, sum(l_quantity) AS plays "
         "FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey")


def interactions(spark: SparkSession, d: str, by: str | None = None) -> DataFrame:
    """``by``: rows are dealt by ``user_id`` or ``item_id``, so that what follows for each user or item needs no further move of them."""
    li = table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, d, "orders", "o_orderkey", "o_custkey")
    lines = li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"), "l_quantity")
    return (lines.repartition(by) if by else lines).groupBy("user_id", "item_id").agg(F.sum("l_quantity").alias("plays"))


# ---------------------------------------------------------------- event log
SQL_EVENT_LOG = "SELECT CAST(user_id AS VARCHAR) AS username, event_type AS artist FROM events"


def event_log(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events", "user_id", "event_type").select(
        F.col("user_id").cast("string").alias("username"), F.col("event_type").alias("artist"))


# ---------------------------------------------------------------- item catalog
SQL_ITEMS = ("SELECT p_partkey AS item_id, p_name || ' ' || p_brand AS item_name, "
             "CAST(p_size AS DOUBLE) AS size, p_retailprice AS price, "
             "CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS DOUBLE) AS price_cents, "
             "CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 'yes' ELSE 'no' END AS explicit_text, "
             "'[''' || replace(p_name, ' ', ''', ''') || ''']' AS genres_text, p_type "
             "FROM part")


def items(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return p.select(
        F.col("p_partkey").alias("item_id"),
        F.concat_ws(" ", "p_name", "p_brand").alias("item_name"),
        F.col("p_size").cast("double").alias("size"),
        F.col("p_retailprice").alias("price"),
        F.round(F.col("p_retailprice") * 100).cast("long").cast("double").alias("price_cents"),
        F.when(F.col("p_type").isin("SMALL", "LARGE"), "yes").otherwise("no").alias("explicit_text"),
        F.concat(F.lit("['"), F.replace("p_name", F.lit(" "), F.lit("', '")), F.lit("']")).alias("genres_text"),
        "p_type")


# ---------------------------------------------------------------- named play log
# The accent substitution applied to a third of the catalog names.
ACCENT_FROM, ACCENT_TO = "aeiou", "áéíóú"

SQL_PLAY_LOG = (
    "SELECT CAST(o_custkey AS VARCHAR) AS username, "
    "CASE l_partkey % 3 WHEN 0 THEN p_name || ' ' || p_brand "
    "WHEN 1 THEN upper(p_name || ' ' || p_brand) "
    f"ELSE translate(p_name || ' ' || p_brand, '{ACCENT_FROM}', '{ACCENT_TO}') END AS artist, "
    "l_quantity AS plays "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey")


def play_log(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, d, "orders", "o_orderkey", "o_custkey")
    p = table(spark, d, "part", "p_partkey", "p_name", "p_brand")
    name = F.concat_ws(" ", "p_name", "p_brand")
    artist = (F.when(F.col("l_partkey") % 3 == 0, name)
               .when(F.col("l_partkey") % 3 == 1, F.upper(name))
               .otherwise(F.translate(name, ACCENT_FROM, ACCENT_TO)))
    return (li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
              .select(F.col("o_custkey").cast("string").alias("username"), artist.alias("artist"),
                      F.col("l_quantity").alias("plays")))


# ---------------------------------------------------------------- catalog for the name join
SQL_CATALOG = ("SELECT p_partkey AS artist_id, p_name || ' ' || p_brand AS artist_name, "
               "CAST(p_size AS DOUBLE) AS size, p_retailprice AS price FROM part")


def catalog(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    return p.select(F.col("p_partkey").alias("artist_id"), F.concat_ws(" ", "p_name", "p_brand").alias("artist_name"),
                    F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"))


# ---------------------------------------------------------------- tracks × supplier artists
SQL_TRACK_ARTISTS = ("SELECT DISTINCT l_orderkey AS track_id, l_suppkey AS artist_id FROM lineitem")

SQL_TRACKS = (
    "SELECT o_orderkey AS track_id, o_totalprice AS price, sum(l_quantity) AS quantity, "
    "avg(l_discount) AS discount, o_orderstatus AS status, o_orderpriority AS priority "
    "FROM orders JOIN lineitem ON l_orderkey = o_orderkey "
    "GROUP BY o_orderkey, o_totalprice, o_orderstatus, o_orderpriority")

SQL_ARTISTS = (
    "SELECT s_suppkey AS artist_id, s_name AS artist_name, "
    "CASE WHEN s_suppkey % 10 = 0 THEN [n_name, r_name] ELSE [] END AS genres "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")

TRACK_NUMERICS = ["price", "quantity", "discount"]
TRACK_CATEGORIES = ["status", "priority"]


def track_artists(spark: SparkSession, d: str) -> DataFrame:
    """O7 input: one row per (track, artist)."""
    li = table(spark, d, "lineitem", "l_orderkey", "l_suppkey")
    return li.select(F.col("l_orderkey").alias("track_id"), F.col("l_suppkey").alias("artist_id")).distinct()


def tracks(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders", "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    li = table(spark, d, "lineitem", "l_orderkey", "l_quantity", "l_discount")
    agg = li.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"))
    return o.join(agg, o.o_orderkey == agg.l_orderkey).select(
        F.col("o_orderkey").alias("track_id"), F.col("o_totalprice").alias("price"), "quantity", "discount",
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))


def artists(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier", "s_suppkey", "s_name", "s_nationkey")
    n = table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = table(spark, d, "region", "r_regionkey", "r_name")
    # nation/region: fixed-size dimensions (25 / 5 rows)
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    return j.select(F.col("s_suppkey").alias("artist_id"), F.col("s_name").alias("artist_name"),
                    F.when(F.col("s_suppkey") % 10 == 0, F.array("n_name", "r_name"))
                     .otherwise(F.array().cast("array<string>")).alias("genres"))


# ---------------------------------------------------------------- tracks × part artists (playlists)
SQL_PLAYLIST_TRACKS = (
    "SELECT o_orderkey AS track_id, 'Track ' || CAST(o_orderkey AS VARCHAR) AS track_name, "
    "'[' || string_agg('''' || p_name || ' ' || p_brand || '''', ', ' ORDER BY l_linenumber, p_name || ' ' || p_brand) || ']' AS artists, "
    "60.0 + CAST(o_orderkey % 121 AS DOUBLE) AS tempo, CAST(o_orderkey % 97 AS DOUBLE) / 97.0 AS valence, "
    "o_totalprice AS popularity "
    "FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey "
    "GROUP BY o_orderkey, o_totalprice")

SQL_PLAYLIST_TRACK_ARTISTS = "SELECT DISTINCT l_orderkey AS track_id, l_partkey AS item_id FROM lineitem"


def playlist_tracks(spark: SparkSession, d: str, artists: bool = True) -> DataFrame:
    """``artists=False`` leaves their text out; the tracks are the same. Parts meet the lines by a shuffle: files are far smaller than
    their rows, so that Spark would send many names through the driver to broadcast them."""
    o = table(spark, d, "orders", "o_orderkey", "o_totalprice")
    li = table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_linenumber")
    p = table(spark, d, "part", "p_partkey", "p_name", "p_brand")
    if artists:
        lines = li.join(p.hint("shuffle_hash"), li.l_partkey == p.p_partkey).select(
            "l_orderkey", F.struct("l_linenumber", F.concat(F.lit("'"), F.concat_ws(" ", "p_name", "p_brand"),
                                                            F.lit("'")).alias("n")).alias("s"))
        names = lines.groupBy("l_orderkey").agg(
            F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["n"]), ", "),
                     F.lit("]")).alias("artists"))
    else:
        names = li.join(p.hint("shuffle_hash"), li.l_partkey == p.p_partkey, "left_semi").select("l_orderkey").distinct()
    return o.join(names, o.o_orderkey == names.l_orderkey).select(
        F.col("o_orderkey").alias("track_id"),
        F.concat(F.lit("Track "), F.col("o_orderkey").cast("string")).alias("track_name"),
        *(["artists"] if artists else []),
        (F.lit(60.0) + (F.col("o_orderkey") % 121).cast("double")).alias("tempo"),
        ((F.col("o_orderkey") % 97).cast("double") / 97.0).alias("valence"),
        F.col("o_totalprice").alias("popularity"))


def playlist_track_items(spark: SparkSession, d: str) -> DataFrame:
    """Dealt by track, so that a join with tracks needs no further move of the rows."""
    li = table(spark, d, "lineitem", "l_orderkey", "l_partkey")
    return li.select(F.col("l_orderkey").alias("track_id"), F.col("l_partkey").alias("item_id")).repartition("track_id").distinct()


# ---------------------------------------------------------------- factors
SQL_FACTORS = "SELECT vec_id AS id, embedding AS features, label FROM embeddings"


def factors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings", "vec_id", "embedding", "label").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features"), "label")


# ---------------------------------------------------------------- labelled ranking rows
SQL_RANKED_DOCS = ("SELECT d.source AS user_id, d.doc_id AS item_id, CAST(d.n_chars AS DOUBLE) AS score, "
                   "CAST(l.quality AS BIGINT) AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id")


def ranked_docs(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "source", "n_chars")
    lab = table(spark, d, "labels", "doc_id", "quality")
    return docs.join(lab, "doc_id").select(F.col("source").alias("user_id"), F.col("doc_id").alias("item_id"),
                                           F.col("n_chars").cast("double").alias("score"),
                                           F.col("quality").cast("long").alias("label"))
