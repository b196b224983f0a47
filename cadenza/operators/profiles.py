"""User profiles and item features from the training split
(A4, A5, A9, A13, A14, W4, J10–J12, J14, N1, N3, P2).

Profiles are built from the train split only and shared by training and
inference. Every part is a per-user aggregate; the genre part is bounded per
user by the genre vocabulary, never by the user's play count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.numeric import boolize, safe_double, safe_numeric
from cadenza.functions.text import genre_tokens, join_key
from cadenza.sources.roles import with_roles

TOPK_GENRES = 3


def item_features(items: DataFrame, numerics, categories, genre_col: str | None = None) -> DataFrame:
    """Catalog columns coerced: categories by the boolize rule, numerics to
    numbers with 0 for failures, genre text NULL → ''."""
    it = boolize(items, categories)
    it = safe_numeric(it, numerics)
    if genre_col:
        it = it.withColumn(genre_col, F.coalesce(F.col(genre_col), F.lit("")))
    return it


def profile_input(train: DataFrame, feats: DataFrame, numerics, categories, genre_col: str | None) -> DataFrame:
    """Train pairs ⟕ item features, plays > 0 only."""
    cols = ["item_id", *numerics, *categories] + ([genre_col] if genre_col else [])
    df = train.join(feats.select(*cols), "item_id", "left").withColumn("plays", safe_double("plays"))
    return df.where(F.col("plays") > 0)


def numeric_profile(df: DataFrame, numerics, categories) -> DataFrame:
    """A4 for numerics (null-masked plays-weighted mean, 0.0 when none), A5 for
    0/1 categories (NULL as 0). Columns are prefixed ``uf_``."""
    w = F.col("plays")
    aggs = [F.coalesce(F.sum(w * F.col(c)) / F.nullif(F.sum(F.when(F.col(c).isNotNull(), w)), F.lit(0.0)),
                       F.lit(0.0)).alias(f"uf_{c}") for c in numerics]
    aggs += [(F.sum(w * F.coalesce(F.col(c), F.lit(0.0))) / F.sum(w)).alias(f"uf_{c}") for c in categories]
    if not aggs:
        return df.select("user_id").distinct()
    return df.groupBy("user_id").agg(*aggs)


def genre_distribution(df: DataFrame, genre_col: str) -> DataFrame:
    """(user_id, genre, p): each play split equally over the item's genre
    tokens, then normalised per user to sum to 1."""
    tok = df.select("user_id", "plays", genre_tokens(genre_col).alias("__tok")).where(F.size("__tok") > 0)
    bag = (tok.select("user_id", (F.col("plays") / F.size("__tok")).alias("__s"), F.explode("__tok").alias("genre"))
              .groupBy("user_id", "genre").agg(F.sum("__s").alias("__b")))
    return bag.withColumn("p", F.col("__b") / F.sum("__b").over(Window.partitionBy("user_id"))).drop("__b")


def genre_entropy(dist: DataFrame) -> DataFrame:
    """−Σ p·log2 p per user."""
    return dist.where(F.col("p") > 0).groupBy("user_id").agg(
        (-F.sum(F.col("p") * F.log2("p"))).alias("user_genre_entropy"))


def genre_topk(dist: DataFrame, k: int = TOPK_GENRES) -> DataFrame:
    """Top-k genres per user as columns user_genre_top1..k (p desc, genre asc),
    NULL padded — a conditional-max pivot over a row_number."""
    w = Window.partitionBy("user_id").orderBy(F.col("p").desc(), F.col("genre").asc())
    r = dist.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k)
    return r.groupBy("user_id").agg(*[F.max(F.when(F.col("__rn") == i, F.col("genre"))).alias(f"user_genre_top{i}")
                                      for i in range(1, k + 1)])


def genre_summary(df: DataFrame, genre_col: str, k: int = TOPK_GENRES, parsed: bool = False) -> DataFrame:
    """A13, A14 and W4 together: per user the top-k genres and the entropy, from one aggregate over the user's genres (at most as many as
    there are genres). Values are those of ``genre_topk`` and ``genre_entropy``. ``parsed``: the column holds the tokens already."""
    tok = df.select("user_id", "plays", (F.col(genre_col) if parsed else genre_tokens(genre_col)).alias("__tok")).where(F.size("__tok") > 0)
    bag = (tok.select("user_id", (F.col("plays") / F.size("__tok")).alias("__s"), F.explode("__tok").alias("genre"))
              .groupBy("user_id", "genre").agg(F.sum("__s").alias("__b")))
    g = bag.groupBy("user_id").agg(F.sum("__b").alias("__t"), F.array_sort(F.collect_list(F.struct((-F.col("__b")).alias("o"), "genre"))).alias("__g"))
    p = F.transform("__g", lambda x: -x["o"] / F.col("__t"))
    entropy = F.aggregate(p, F.lit(0.0), lambda a, x: a - F.when(x > 0, x * F.log2(x)).otherwise(0.0))
    return g.select("user_id", *[F.get(F.col("__g"), i)["genre"].alias(f"user_genre_top{i + 1}") for i in range(k)], entropy.alias("user_genre_entropy"))


def user_profiles(train: DataFrame, feats: DataFrame, numerics, categories, genre_col: str | None,
                  k: int = TOPK_GENRES) -> DataFrame:
    """All parts keyed by user; numeric NULLs → 0.0, genre names stay NULL. Columns carry their roles.
    Genre texts are parsed once an item, not once a pair."""
    if genre_col:
        feats = feats.withColumn("__genres", genre_tokens(genre_col))
    df = profile_input(train, feats, numerics, categories, "__genres" if genre_col else None)
    out = numeric_profile(df, numerics, categories)
    if genre_col:
        out = out.join(genre_summary(df, "__genres", k, parsed=True), "user_id", "left").fillna({"user_genre_entropy": 0.0})
    out = out.fillna(0.0, [f"uf_{c}" for c in [*numerics, *categories]])
    return with_roles(out, group="user_id", profile=[c for c in out.columns if c != "user_id"])


def _ids_by_name(named: DataFrame, items: DataFrame, mode: str) -> DataFrame:
    """(artist, item_id): the names of a log that the catalog has by the normalised key, with the first row per key (smallest id).
    Keys are made once a name, not once a row."""
    it = items.select("item_id", join_key("item_name", mode).alias("__key")).where(F.col("__key").isNotNull())
    first = it.groupBy("__key").agg(F.min("item_id").alias("item_id"))  # first row per key, skew-safe
    return named.select("artist").distinct().withColumn("__key", join_key("artist", mode)).join(first, "__key").select("artist", "item_id")


def named_pairs(named: DataFrame, items: DataFrame, mode: str = "word") -> DataFrame:
    """Plays by raw names as (user_id, item_id, plays): names meet the catalog through the normalised key, the catalog
    deduplicated to the first row per key (smallest id). Unmatched names are dropped. The name-key path of ``user_profiles``."""
    j = named.join(_ids_by_name(named, items, mode), "artist")
    return j.groupBy(F.col("username").alias("user_id"), "item_id").agg(F.sum("plays").alias("plays"))


def popularity_by_name(named: DataFrame, items: DataFrame, mode: str = "word") -> DataFrame:
    """J12 + A9: raw names → catalog ids through the normalised key, the catalog
    deduplicated to the first row per key (smallest id); then distinct users and
    Σ plays per id. Unmatched names are dropped."""
    j = named.join(_ids_by_name(named, items, mode), "artist")
    return j.groupBy("item_id").agg(F.countDistinct("username").cast("long").alias("item_pop_users"),
                                    F.sum("plays").alias("item_pop_plays"))


def map_ids(inter: DataFrame, id_map: DataFrame, old: str = "old_item_id", new: str = "artist_id") -> DataFrame:
    """Item id through an optional map, falling back to the original id as text."""
    m = id_map.select(F.col(old).alias("item_id"), F.col(new).cast("string").alias("__new"))
    return (inter.join(m, "item_id", "left")
                 .withColumn("item_key", F.coalesce(F.col("__new"), F.col("item_id").cast("string"))).drop("__new"))


def attach_names(df: DataFrame, names: DataFrame, id_col: str = "item_id", name_col: str = "item_name") -> DataFrame:
    """Display names by a left join on the id."""
    return df.join(names.select(id_col, name_col), id_col, "left")
