"""Artist → track expansion, taste similarity and playlists
(A15, N11–N13, W5–W7), for all users at once.

Scores come from the final blended list; a user's playlist is the deduplicated
best tracks by the final playlist score. Context playlists score every mode in
one pass: the (small, fixed) mode table is exploded onto each row, never joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.numeric import TEMPO_WIDTH, VALENCE_WIDTH, clip01, final_score, similarity, stable_round

PLAYLIST_LEN = 10
CONTEXT_LEN = 20

# Situation modes. Kind 'rise' scores clip((x − centre)/width);
# kind 'near' scores clip(1 − |x − centre|/width); weights are (base, tempo, valence).
CONTEXTS = {
    "workout": {"kind": "rise", "tempo": (120.0, 60.0), "valence": (0.5, 0.5), "w": (0.4, 0.4, 0.2)},
    "study": {"kind": "near", "tempo": (100.0, 40.0), "valence": (0.4, 0.4), "w": (0.6, 0.25, 0.15)},
    "walk": {"kind": "rise", "tempo": (90.0, 40.0), "valence": (0.4, 0.4), "w": (0.5, 0.3, 0.2)},
    "chill": {"kind": "near", "tempo": (80.0, 40.0), "valence": (0.35, 0.35), "w": (0.5, 0.3, 0.2)},
    "default": {"kind": "none", "w": (1.0, 0.0, 0.0)},
}


def user_taste(user_items: DataFrame, item_audio: DataFrame) -> DataFrame:
    """Unweighted mean tempo/valence over the user's matched items, which meet by a shuffle of the items."""
    j = user_items.select("user_id", "item_id").join(item_audio.hint("merge"), "item_id")
    return j.groupBy("user_id").agg(F.avg("tempo").alias("mean_tempo"), F.avg("valence").alias("mean_valence"))


def dedupe_tracks(cands: DataFrame, placed: bool = False) -> DataFrame:
    """One row per (user, track): best base_score, then popularity, then item id. Rows are
    dealt by user, so that what follows for each user (taste, playlists) needs no further move of them; ``placed``: they are already."""
    w = Window.partitionBy("user_id", "track_id").orderBy(
        F.col("base_score").desc(), F.col("popularity").desc(), F.col("item_id").asc())
    rows = cands if placed else cands.repartition("user_id")
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def score_tracks(cands: DataFrame, taste: DataFrame) -> DataFrame:
    """N11 + N12: similarity to the user's taste (0.5 when unknown) and the final score."""
    j = cands.join(taste, "user_id", "left")
    j = j.withColumn("tempo_sim", similarity("tempo", "mean_tempo", TEMPO_WIDTH))
    j = j.withColumn("valence_sim", similarity("valence", "mean_valence", VALENCE_WIDTH))
    return j.withColumn("final_playlist_score", stable_round(final_score("base_score", "tempo_sim", "valence_sim")))


def playlists(scored: DataFrame, n: int = PLAYLIST_LEN, score_col: str = "final_playlist_score") -> DataFrame:
    """Best n distinct tracks per user, rank 1-based (tie → track id)."""
    w = Window.partitionBy("user_id").orderBy(F.col(score_col).desc(), F.col("track_id").asc())
    return (scored.withColumn("rank_in_playlist", F.row_number().over(w).cast("long"))
                  .where(F.col("rank_in_playlist") <= n))


def context_score(mode: str):
    """N13 for one mode as a column expression over base/tempo/valence."""
    c = CONTEXTS.get(mode, CONTEXTS["default"])
    base = F.col("final_playlist_score")
    wb, wt, wv = c["w"]
    if c["kind"] == "none":
        return base
    (tc, tw), (vc, vw) = c["tempo"], c["valence"]
    t, v = F.col("tempo").cast("double"), F.col("valence").cast("double")
    if c["kind"] == "rise":
        tn, vn = clip01((t - tc) / tw), clip01((v - vc) / vw)
    else:
        tn, vn = clip01(F.lit(1.0) - F.abs(t - tc) / tw), clip01(F.lit(1.0) - F.abs(v - vc) / vw)
    return wb * base + wt * tn + wv * vn


def context_playlists(scored: DataFrame, modes=tuple(CONTEXTS), n: int = CONTEXT_LEN) -> DataFrame:
    """All modes × all users in one plan — rows are replicated per mode by an
    explode of the mode names, scored by a CASE over the modes, ranked per
    (mode, user)."""
    m = scored.withColumn("mode", F.explode(F.array(*[F.lit(x) for x in modes])))
    expr = None
    for x in modes:
        e = context_score(x)
        expr = F.when(F.col("mode") == x, e) if expr is None else expr.when(F.col("mode") == x, e)
    m = m.withColumn("mode_score", stable_round(expr))
    w = Window.partitionBy("mode", "user_id").orderBy(F.col("mode_score").desc(), F.col("track_id").asc())
    return m.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)
