"""Artist vectors from a track catalog.

Tracks carry numerics and categories; each track lists its artists; artists carry
genres. The reference walks the tracks in file order and lets an artist without
genres take the union of its co-artists' genres on the first track where any
co-artist already has some. Without a sequential walk:

    T(a) = -1 for artists with genres, else the earliest track t containing a
           with a co-artist b where T(b) < t;
    genres(a) = ⋃ genres(b) over b on track T(a) with T(b) < T(a).

T is the fixpoint of a monotone relaxation (values only decrease), and genres
resolve in dependency rounds. Both loops are semi-naive: a round joins what the last one has added and writes only what it adds itself,
as Parquet in the shared folder; the driver only sees whether that is empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.session import cut_table

# Fixed value: genre of an artist that stays without one.
UNKNOWN_GENRE = "<unknown>"


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def arrival_times(track_artists: DataFrame, artists: DataFrame) -> DataFrame:
    """(artist_id, t): -1 for artists with genres, the arrival track for imputed
    ones, NULL for artists that never receive genres. ``track_artists`` should be
    materialised by the caller (it is read once per round). Only artists whose time
    changed in a round take part in the next one, and only they are written; times only decrease, so it ends."""
    ta = track_artists
    ids = artists.select("artist_id").union(ta.select("artist_id")).distinct()
    changed = cut_table(artists.where(F.size("genres") > 0).select("artist_id", F.lit(-1).cast("long").alias("t")).distinct())
    times = [changed]
    while not changed.isEmpty():
        # the earliest time that a changed artist brings to its tracks
        m = ta.join(changed, "artist_id").groupBy("track_id").agg(F.min("t").alias("m")).where(F.col("m") < F.col("track_id"))
        cand = ta.join(m, "track_id").groupBy("artist_id").agg(F.min("track_id").alias("tn"))
        known = _all(times).join(cand.select("artist_id"), "artist_id", "left_semi").groupBy("artist_id").agg(F.min("t").alias("t"))
        changed = cut_table(cand.join(known, "artist_id", "left").where(F.col("t").isNull() | (F.col("tn") < F.col("t"))).select("artist_id", F.col("tn").alias("t")))
        times.append(changed)
    return ids.join(_all(times).groupBy("artist_id").agg(F.min("t").alias("t")), "artist_id", "left")


def impute_genres(track_artists: DataFrame, artists: DataFrame) -> DataFrame:
    """(artist_id, t, genres sorted) for every artist seen in the catalog or tracks;
    genres stay NULL when nothing propagates.

    Every artist arriving at track t receives the same union
    U(t) = ⋃ { genres(b) : b on t, T(b) < t }, where genres(b) is b's own when
    T(b) = −1, else U(T(b)). So the union is resolved per arrival track: its
    contributions are (track, source) pairs — at most one per track × artist row,
    never artist × co-artist pairs — and a track resolves once all its sources
    have. Genre sets are handled exploded, so a list is bounded by the genre
    vocabulary.

    Rounds are semi-naive: the sources that the last round resolved are joined to their pairs, what they bring is written once (how
    many sources a track has got, and their genres), and tracks that have got all are the next round's sources. Nothing is written again."""
    # loop-invariant inputs are written once; every round reads them back
    ta = cut_table(track_artists.select("track_id", "artist_id").distinct())
    artists = cut_table(artists.select("artist_id", "genres"))
    t = cut_table(arrival_times(ta, artists))
    arrival = t.where(F.col("t") >= 0).select(F.col("t").alias("track_id")).distinct()
    src_kind = F.when(F.col("tb") < 0, F.lit("a")).otherwise(F.lit("t"))
    src_id = F.when(F.col("tb") < 0, F.col("artist_id").cast("string")).otherwise(F.col("tb").cast("string"))
    contrib = cut_table(
        ta.join(arrival, "track_id", "left_semi")
          .join(t.select("artist_id", F.col("t").alias("tb")), "artist_id")
          .where(F.col("tb") < F.col("track_id"))
          .select("track_id", src_kind.alias("kind"), src_id.alias("sid")).distinct())
    need = cut_table(contrib.groupBy("track_id").agg(F.count(F.lit(1)).alias("need")))
    source = (artists.where(F.size("genres") > 0)
                     .select(F.lit("a").alias("kind"), F.col("artist_id").cast("string").alias("sid"),
                             F.explode("genres").alias("genre")).distinct())
    got, brought, unions = [], [], []
    while True:
        met = contrib.join(source, ["kind", "sid"])
        got.append(cut_table(met.groupBy("track_id").agg(F.countDistinct("kind", "sid").alias("n"))))
        if got[-1].isEmpty():
            break
        brought.append(cut_table(met.select("track_id", "genre").distinct()))
        have = _all(got).join(got[-1].select("track_id"), "track_id", "left_semi").groupBy("track_id").agg(F.sum("n").alias("n"))
        ready = have.join(need, "track_id").where(F.col("n") == F.col("need")).select("track_id")
        unions.append(cut_table(_all(brought).join(ready, "track_id", "left_semi").distinct()))
        source = unions[-1].select(F.lit("t").alias("kind"), F.col("track_id").cast("string").alias("sid"), "genre")
    base = artists.where(F.size("genres") > 0).select(
        "artist_id", F.array_sort(F.array_distinct("genres")).alias("g0"))
    out = t.join(base, "artist_id", "left")
    if not unions:
        return out.select("artist_id", "t", F.col("g0").alias("genres"))
    per_track = _all(unions).groupBy("track_id").agg(F.array_sort(F.collect_list("genre")).alias("ug"))
    return (out.join(per_track, out["t"] == per_track["track_id"], "left")
               .select("artist_id", "t", F.coalesce(F.col("g0"), F.col("ug")).alias("genres")))


def genres_or_unknown(imputed: DataFrame) -> DataFrame:
    """Empty or missing genres become ['<unknown>']."""
    return imputed.select("artist_id", F.when(F.coalesce(F.size("genres"), F.lit(0)) > 0, F.col("genres"))
                          .otherwise(F.array(F.lit(UNKNOWN_GENRE))).alias("genres"))


def exploded_rows(tracks: DataFrame, track_artists: DataFrame, artist_genres: DataFrame) -> DataFrame:
    """O7 + O8: one row per (track, artist, genre)."""
    return (tracks.join(track_artists.select("track_id", "artist_id").distinct(), "track_id")
                  .join(artist_genres, "artist_id")
                  .withColumn("genre", F.explode("genres")).drop("genres"))


def mode_of(df: DataFrame, keys, col: str) -> DataFrame:
    """Most frequent non-null value per group; ties → smallest value (the
    engine's own ``mode`` is not used: tie behaviour differs between engines).
    Counts per value, then the minimum of (−count, value) — two partial
    aggregations, so a huge group never sits in one task."""
    c = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("__c"))
    best = c.groupBy(*keys).agg(F.min(F.struct((-F.col("__c")).alias("n"), F.col(col).alias("v"))).alias("__b"))
    return best.select(*keys, F.col("__b.v").alias(col))


def per_genre(rows: DataFrame, numerics, categories) -> DataFrame:
    """A6–A8 + W10: per (artist, genre) numeric means, category modes (as ``mode_of``), row count n
    and share w = n / Σ n of the artist.

    The rows are read once: they are summed per combination of category values (map side first), the combinations are unpivoted to
    (category, value) counts, and one aggregate per (artist, genre) takes sums and modes from those."""
    keys, categories, numerics = ["artist_id", "genre"], list(categories), list(numerics)
    sums = [F.sum(F.col(c).cast("double")).alias(f"__s{i}") for i, c in enumerate(numerics)]
    known = [F.count(c).alias(f"__c{i}") for i, c in enumerate(numerics)]
    parts = rows.groupBy(*keys, *categories).agg(F.count(F.lit(1)).alias("__n"), *sums, *known)
    carried = ["__n", *[f"__s{i}" for i in range(len(numerics))], *[f"__c{i}" for i in range(len(numerics))]]
    # turn 0 carries the sums, turn j + 1 the values of category j
    turns = [F.struct(F.lit(0).alias("turn"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in categories], *[F.col(c).alias(c) for c in carried])]
    for j in range(len(categories)):
        turns.append(F.struct(F.lit(j + 1).alias("turn"),
                              *[(F.col(c) if i == j else F.lit(None).cast(rows.schema[c].dataType)).alias(c) for i, c in enumerate(categories)],
                              *[(F.col(c) if c == "__n" else F.lit(None).cast(parts.schema[c].dataType)).alias(c) for c in carried]))
    counts = parts.select(*keys, F.inline(F.array(*turns))).groupBy(*keys, "turn", *categories).agg(*[F.sum(c).alias(c) for c in carried])
    first = F.col("turn") == 0
    agg = counts.groupBy(*keys).agg(
        *[(F.sum(F.when(first, F.col(f"__s{i}"))) / F.nullif(F.sum(F.when(first, F.col(f"__c{i}"))), F.lit(0))).alias(c) for i, c in enumerate(numerics)],
        F.sum(F.when(first, F.col("__n"))).alias("n"),
        *[F.min(F.when((F.col("turn") == j + 1) & F.col(c).isNotNull(), F.struct((-F.col("__n")).alias("n"), F.col(c).alias("v"))))["v"].alias(c)
          for j, c in enumerate(categories)])
    return agg.withColumn("w", F.col("n") / F.sum("n").over(Window.partitionBy("artist_id")))


def _weighted(cols, wcol: str = "w") -> list:
    w = F.col(wcol)
    return [F.coalesce(F.sum(w * F.col(c)) / F.nullif(F.sum(F.when(F.col(c).isNotNull(), w)), F.lit(0.0)), F.lit(0.0)).alias(c) for c in cols]


def weighted_mean(df: DataFrame, keys, cols, wcol: str = "w") -> DataFrame:
    """A4: Σ w·x / Σ w over non-null x; 0.0 when no x is present."""
    return df.groupBy(*keys).agg(*_weighted(cols, wcol))


def artist_vectors(per_ag: DataFrame, numerics, categories, names: DataFrame | None = None, top: int = 3) -> DataFrame:
    """Weighted numerics, categories of the top-w genre row (tie → genre asc),
    and the first ``top`` genres by (w desc, genre asc) joined by commas (W3, A19): one aggregate per artist, over at most as many
    rows as there are genres."""
    row = F.struct((-F.col("w")).alias("o"), F.col("genre").alias("genre"), *[F.col(c).alias(c) for c in categories])
    g = per_ag.groupBy("artist_id").agg(*_weighted(numerics), F.array_sort(F.collect_list(row)).alias("__r"))
    out = g.select("artist_id", *numerics, *[F.col("__r")[0][c].alias(c) for c in categories],
                   F.array_join(F.transform(F.slice("__r", 1, top), lambda x: x["genre"]), ",").alias("top_genres"))
    if names is not None:
        out = out.join(names, "artist_id", "left")
    return out


def audio_by_primary(tracks: DataFrame, primary_col: str, cols) -> DataFrame:
    """Mean of the audio columns per primary artist (NULL primaries dropped)."""
    return tracks.where(F.col(primary_col).isNotNull()).groupBy(primary_col).agg(*[F.avg(c).alias(c) for c in cols])
