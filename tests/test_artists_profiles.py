import pytest
from pyspark.sql import functions as F

from cadenza.operators import artists as ar
from cadenza.operators import namejoin as nj
from cadenza.operators import profiles as pf


def _catalog(spark, tracks, genres):
    ta = spark.createDataFrame([(t, a) for t, arts in tracks for a in arts], "track_id long, artist_id string")
    art = spark.createDataFrame([(a, g) for a, g in genres.items()], "artist_id string, genres array<string>")
    return ta, art


def _genres(df):
    return {r.artist_id: (r.genres or []) for r in df.collect()}


def test_imputation_follows_track_order(spark):
    ta, art = _catalog(spark, [(0, ["A", "B"]), (1, ["B", "C"])], {"A": ["rock"], "B": [], "C": []})
    assert _genres(ar.impute_genres(ta, art)) == {"A": ["rock"], "B": ["rock"], "C": ["rock"]}
    ta, art = _catalog(spark, [(0, ["B", "C"]), (1, ["A", "B"])], {"A": ["rock"], "B": [], "C": []})
    g = _genres(ar.genres_or_unknown(ar.impute_genres(ta, art)))
    assert g == {"A": ["rock"], "B": ["rock"], "C": ["<unknown>"]}


def test_imputation_matches_sequential_walk(spark):
    import random
    rnd = random.Random(3)
    for _ in range(3):
        arts = [f"a{i}" for i in range(8)]
        genres = {a: ([rnd.choice(["x", "y", "z"])] if rnd.random() < 0.3 else []) for a in arts}
        tracks = [(t, rnd.sample(arts, rnd.randint(1, 3))) for t in range(10)]
        state = {a: set(g) for a, g in genres.items()}
        for _, aids in tracks:
            u = set().union(*[state[a] for a in aids])
            if u:
                for a in aids:
                    if not state[a]:
                        state[a] = set(u)
        ta, art = _catalog(spark, tracks, genres)
        got = _genres(ar.impute_genres(ta, art))
        assert {a: sorted(v) for a, v in state.items()} == {a: sorted(got.get(a, [])) for a in arts}


def test_genre_shares_sum_to_one_and_vector_is_plain_mean(spark):
    tracks = spark.createDataFrame([(0, 1.0, "x"), (1, 3.0, "x"), (2, 5.0, "y")], "track_id long, price double, status string")
    ta = spark.createDataFrame([(0, "A"), (1, "A"), (2, "A")], "track_id long, artist_id string")
    ag = spark.createDataFrame([("A", ["rock", "pop"])], "artist_id string, genres array<string>")
    pg = ar.per_genre(ar.exploded_rows(tracks, ta, ag), ["price"], ["status"])
    assert pg.agg(F.sum("w")).first()[0] == pytest.approx(1.0)
    v = ar.artist_vectors(pg, ["price"], ["status"]).first()
    assert v.price == pytest.approx(3.0) and v.status == "x" and v.top_genres == "pop,rock"


def test_genre_profile_fixture(spark):
    train = spark.createDataFrame([(1, 10, 4.0), (1, 11, 2.0), (2, 12, 1.0)], "user_id long, item_id long, plays double")
    feats = spark.createDataFrame([(10, "rock,pop"), (11, "rock"), (12, "")], "item_id long, g string")
    df = pf.profile_input(train, feats, [], [], "g")
    dist = {(r.user_id, r.genre): r.p for r in pf.genre_distribution(df, "g").collect()}
    assert dist[(1, "rock")] == pytest.approx(0.666667, abs=1e-6) and dist[(1, "pop")] == pytest.approx(0.333333, abs=1e-6)
    prof = {r.user_id: r for r in pf.user_profiles(train, feats, [], [], "g").collect()}
    assert prof[1].user_genre_entropy == pytest.approx(0.918296, abs=1e-6)
    assert (prof[1].user_genre_top1, prof[1].user_genre_top2, prof[1].user_genre_top3) == ("rock", "pop", None)
    assert prof[2].user_genre_entropy == 0.0 and prof[2].user_genre_top1 is None


def test_name_join_fanout_vs_dedup(spark):
    log = spark.createDataFrame([("u", "Air", 5.0)], "username string, artist string, plays double")
    cat = spark.createDataFrame([(1, "air", 1.0), (2, "AIR", 2.0)], "artist_id long, artist_name string, price double")
    fan = nj.matched(nj.name_join(nj.aggregate_log(log), cat, ["price"], "basic", True))
    assert fan.count() == 2 and fan.agg(F.sum("plays")).first()[0] == 10.0
    ded = nj.matched(nj.name_join(nj.aggregate_log(log), cat, ["price"], "basic", False, "price")).collect()
    assert [(r.artist_id, r.plays) for r in ded] == [(2, 5.0)]


@pytest.mark.parametrize("fanout", [True, False])
def test_matched_unique_rows_do_not_move(spark, fanout):
    from cadenza.operators import namejoin as nj
    log = spark.createDataFrame([("u", "A b", 1.0), ("u", "A b", 2.0), ("u", "a B", 4.0), ("v", "zz", 1.0), ("v", "A b", None), (None, "A b", 1.0)], "username string, artist string, plays double")
    cat = spark.createDataFrame([(1, "a b", 5.0), (2, "A B", 6.0), (2, "A B", 6.0), (3, "x", 1.0)], "artist_id long, artist_name string, price double")
    joined = nj.name_join(nj.aggregate_log(log), cat, ["price"], "basic", fanout, "price")
    plain, fast = nj.matched(joined), nj.matched(joined, unique=True)
    assert fast.schema == plain.schema and sorted(map(str, fast.collect())) == sorted(map(str, plain.collect()))
    count = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [")
    assert count(fast) == count(plain) - 1
    a, b = (sorted(map(str, nj.with_features(joined, ["price"], unique=x).collect())) for x in (False, True))
    assert a == b


def test_deduped_tracks_lie_by_user(spark):
    from cadenza.operators import playlist as pl
    rows = [(1, 5, 7, 0.5, 1.0, 100.0, 0.5), (1, 5, 8, 0.5, 2.0, 100.0, 0.5), (2, 5, 7, 0.1, 1.0, 90.0, 0.1), (2, 6, 7, 0.1, 1.0, 90.0, 0.1)]
    cands = spark.createDataFrame(rows, "user_id long, track_id long, item_id long, base_score double, popularity double, tempo double, valence double")
    taste = spark.createDataFrame([(1, 100.0, 0.5)], "user_id long, mean_tempo double, mean_valence double")
    out = pl.dedupe_tracks(cands)
    assert sorted((r.user_id, r.track_id, r.item_id) for r in out.collect()) == [(1, 5, 8), (2, 5, 7), (2, 6, 7)]
    plan = pl.playlists(pl.score_tracks(out, taste.hint("merge")))._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(moved) == 2 and not any("track_id" in x.split("hashpartitioning(")[1].split(")")[0] for x in moved)


def test_names_are_folded_and_genres_parsed_once(spark):
    from cadenza.operators import profiles as pf
    items = spark.createDataFrame([(5, "Björk"), (4, "bjork"), (7, "Abba"), (8, None), (9, " ")], "item_id long, item_name string")
    named = spark.createDataFrame([("u", "BJÖRK", 2.0), ("u", "Bjork ", 1.0), ("v", "abba", 3.0), ("v", None, 4.0), (None, "abba", 1.0), ("v", "nobody", 5.0)],
                                  "username string, artist string, plays double")
    pairs = pf.named_pairs(named, items)
    assert {(r.user_id, r.item_id, r.plays) for r in pairs.collect()} == {("u", 4, 3.0), ("v", 7, 3.0), (None, 7, 1.0)}
    assert {(r.item_id, r.item_pop_users, r.item_pop_plays) for r in pf.popularity_by_name(named, items).collect()} == {(4, 1, 3.0), (7, 1, 4.0)}
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    # below each Python step is one text column: the catalog's names, or the log's different names
    for k, line in enumerate(lines):
        if "ArrowEvalPython" in line:
            assert "username" not in "".join(lines[k:k + 3]) and "plays" not in "".join(lines[k:k + 3])
    feats = spark.createDataFrame([(4, 1.0, 1.0, "['a', 'b']"), (7, 2.0, None, None)], "item_id long, size double, flag double, genre string")
    got = pf.user_profiles(pairs, feats, ["size"], ["flag"], "genre")
    assert {(r.user_id, r.user_genre_top1, r.user_genre_top2, r.user_genre_entropy, r.uf_size) for r in got.collect()} == {
        ("u", "a", "b", 1.0, 1.0), ("v", None, None, 0.0, 2.0), (None, None, None, 0.0, 2.0)}
    # the text is parsed below the join with the pairs, where an item is one row
    lines = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = [k for k, line in enumerate(lines) if "from_json" in line]
    joins = [k for k, line in enumerate(lines) if "Join LeftOuter" in line and "item_id" in line]
    assert at and joins and all(k > min(joins) for k in at)


def test_parts_of_playlists_are_not_broadcast(spark, tmp_path):
    """Names and keys of parts meet lines, tracks and tastes by shuffles, and not through the driver; the tracks are the same without their text."""
    from cadenza.plans import q_playlist as qp
    from cadenza.sources import standins as st
    part = [(i, f"name {i % 3}", "b", "SMALL", 1, 2.0) for i in range(6)]
    lines = [(o, (o * k) % 8, k, 1.0 + k) for o in range(10) for k in (1, 2, 3)] + [(None, 1, 1, 1.0), (3, None, 4, 1.0), (3, 1, None, 1.0)]
    tables = {"part": (part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
              "lineitem": (lines, "l_orderkey long, l_partkey long, l_linenumber long, l_quantity double"),
              "orders": ([(o, o % 4, float(o)) for o in range(12)] + [(2, 1, 5.0), (None, 1, 1.0)], "o_orderkey long, o_custkey long, o_totalprice double")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    d = str(tmp_path)
    plan = qp._scored(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and any(c in x for c in ("partkey", "item_id", "item_name"))], plan
    key = lambda r: (r["track_id"], r["popularity"])
    bare = sorted(st.playlist_tracks(spark, d, artists=False).collect(), key=key)
    assert bare == sorted(st.playlist_tracks(spark, d).drop("artists").collect(), key=key) and len(bare) == 11
