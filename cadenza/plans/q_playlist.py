"""Registered queries: user taste, track candidates, similarity, playlists and
situation playlists (every mode for every user)."""

from __future__ import annotations


from cadenza.functions import text as tx
from cadenza.operators import artists as ar
from cadenza.operators import playlist as pl
from cadenza.plans import q_text as qt
from cadenza.plans.registry import query, rounded
from cadenza.sources import standins as st

_PRIMARY = ("CASE WHEN artists LIKE '[%' THEN list_filter(list_transform(string_split(regexp_replace(trim(artists), "
            "'^\\[|\\]$', '', 'g'), ','), lambda x: regexp_replace(x, '^[ ''\"]+|[ ''\"]+$', '', 'g')), "
            "lambda x: length(trim(x)) > 0 AND x <> 'None')[1] END")
BASE = (f"{qt.RECS}, {qt.ITEMNAMES}, {qt.TRK}, B AS (SELECT IN_.item_id, IN_.item_name, {qt.TRACK_COLS} FROM IN_ "
        f"JOIN ({st.SQL_PLAYLIST_TRACK_ARTISTS}) TA ON TA.item_id = IN_.item_id JOIN TRK USING (track_id) "
        f"QUALIFY row_number() OVER (PARTITION BY IN_.item_id ORDER BY popularity DESC, track_id) <= {qt.N_TRACKS}), "
        f"EXP AS ({qt._EXPAND_SELECT}), "
        "DD AS (SELECT * FROM EXP QUALIFY row_number() OVER (PARTITION BY user_id, track_id "
        "ORDER BY base_score DESC, popularity DESC, item_id) = 1), "
        f"AA AS (SELECT primary_artist, avg(tempo) AS tempo, avg(valence) AS valence FROM (SELECT tempo, valence, "
        f"{_PRIMARY} AS primary_artist FROM TRK) WHERE primary_artist IS NOT NULL GROUP BY primary_artist), "
        "IA AS (SELECT item_id, tempo, valence FROM IN_ JOIN AA ON AA.primary_artist = IN_.item_name), "
        f"TASTE AS (SELECT user_id, avg(tempo) AS mean_tempo, avg(valence) AS mean_valence FROM ({st.SQL_I}) "
        "JOIN IA USING (item_id) GROUP BY user_id), "
        "SC0 AS (SELECT DD.*, CASE WHEN tempo IS NULL OR mean_tempo IS NULL THEN 0.5 "
        "ELSE greatest(0.0, 1.0 - abs(tempo - mean_tempo) / 80.0) END AS tempo_sim, "
        "CASE WHEN valence IS NULL OR mean_valence IS NULL THEN 0.5 "
        "ELSE greatest(0.0, 1.0 - abs(valence - mean_valence) / 1.0) END AS valence_sim FROM DD LEFT JOIN TASTE USING (user_id)), "
        "SC AS (SELECT *, round(0.6 * base_score + 0.2 * tempo_sim + 0.2 * valence_sim, 6) AS final_playlist_score FROM SC0)")


def _taste(spark, d):
    tracks = st.playlist_tracks(spark, d).withColumn("primary_artist", tx.primary_item("artists"))
    audio = ar.audio_by_primary(tracks, "primary_artist", ["tempo", "valence"])
    items = st.items(spark, d).select("item_id", "item_name")
    item_audio = items.hint("merge").join(audio, items.item_name == audio.primary_artist)  # a name is a wide key to broadcast.select("item_id", "tempo", "valence")
    return pl.user_taste(st.interactions(spark, d, by="item_id"), item_audio)


def _deduped(spark, d):
    return pl.dedupe_tracks(qt.expand_by_user(spark, d, qt.best_tracks_exact(spark, d)), placed=True)


def _scored(spark, d):
    return pl.score_tracks(_deduped(spark, d), _taste(spark, d))


@query("user_taste", sql=f"WITH {BASE} SELECT user_id, round(mean_tempo, 6) AS mean_tempo, "
                         "round(mean_valence, 6) AS mean_valence FROM TASTE")
def q_user_taste(spark, d):
    return rounded(_taste(spark, d), "mean_tempo", "mean_valence")


@query("dedupe_tracks", sql=f"WITH {BASE} SELECT user_id, track_id, item_id, base_score, popularity FROM DD")
def q_dedupe_tracks(spark, d):
    return _deduped(spark, d).select("user_id", "track_id", "item_id", "base_score", "popularity")


@query("taste_similarity", sql=f"WITH {BASE} SELECT user_id, track_id, round(tempo_sim, 6) AS tempo_sim, "
                               "round(valence_sim, 6) AS valence_sim FROM SC")
def q_taste_similarity(spark, d):
    return rounded(_scored(spark, d).select("user_id", "track_id", "tempo_sim", "valence_sim"), "tempo_sim", "valence_sim")


@query("final_score", sql=f"WITH {BASE} SELECT user_id, track_id, round(final_playlist_score, 6) AS final_playlist_score FROM SC")
def q_final_score(spark, d):
    return rounded(_scored(spark, d).select("user_id", "track_id", "final_playlist_score"), "final_playlist_score")


@query("playlist", sql=(
    f"WITH {BASE} SELECT user_id, rank_in_playlist, track_id, artist_name, round(final_playlist_score, 6) "
    "AS final_playlist_score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY final_playlist_score DESC, "
    f"track_id) AS rank_in_playlist FROM SC) WHERE rank_in_playlist <= {pl.PLAYLIST_LEN}"))
def q_playlist(spark, d):
    p = pl.playlists(_scored(spark, d))
    return rounded(p.select("user_id", "rank_in_playlist", "track_id", "artist_name", "final_playlist_score"),
                   "final_playlist_score")


def _mode_sql(mode: str) -> str:
    c = pl.CONTEXTS[mode]
    wb, wt, wv = c["w"]
    if c["kind"] == "none":
        expr = "final_playlist_score"
    else:
        (tc, tw), (vc, vw) = c["tempo"], c["valence"]
        if c["kind"] == "rise":
            tn, vn = f"(tempo - {tc}) / {tw}", f"(valence - {vc}) / {vw}"
        else:
            tn, vn = f"1.0 - abs(tempo - {tc}) / {tw}", f"1.0 - abs(valence - {vc}) / {vw}"
        expr = (f"{wb} * final_playlist_score + {wt} * least(greatest({tn}, 0.0), 1.0) + "
                f"{wv} * least(greatest({vn}, 0.0), 1.0)")
    return (f"WITH {BASE} SELECT user_id, rank, track_id, artist_name, round(mode_score, 6) AS mode_score FROM "
            f"(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY mode_score DESC, track_id) AS rank FROM "
            f"(SELECT *, round({expr}, 6) AS mode_score FROM SC)) WHERE rank <= {pl.CONTEXT_LEN}")


def _mk(mode):
    def q(spark, d):
        out = pl.context_playlists(_scored(spark, d), (mode,))
        return rounded(out.select("user_id", "rank", "track_id", "artist_name", "mode_score"), "mode_score")
    return q


for _m in pl.CONTEXTS:
    query(f"context_playlist_{_m}", sql=_mode_sql(_m))(_mk(_m))


@query("context_playlist_all_modes", sql=" UNION ALL ".join(
    f"SELECT '{m}' AS mode, user_id, rank, track_id, mode_score FROM ({_mode_sql(m)})" for m in pl.CONTEXTS))
def q_context_playlist_all_modes(spark, d):
    """All five situations for all users in one plan in one result."""
    out = pl.context_playlists(_scored(spark, d))
    return rounded(out.select("mode", "user_id", "rank", "track_id", "mode_score"), "mode_score")
