"""The store of factors, column roles, catalog ingest and the one-pass aggregates."""
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import artists as ar
from cadenza.operators import profiles as pf
from cadenza.operators.serving import Store
from cadenza.sources import catalog as ca
from cadenza.sources import roles as ro


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    rng = np.random.RandomState(2)
    u, v = rng.randn(40, 3), rng.randn(25, 3)
    users = spark.createDataFrame([(i, f"name {i // 2 * 2 if i in (6, 7) else i}", x.tolist()) for i, x in enumerate(u)], "id long, name string, features array<double>")
    items = spark.createDataFrame([(i, f"item {i}", x.tolist(), i / 25) for i, x in enumerate(v)], "id long, name string, features array<double>, prior double")
    seen = spark.createDataFrame([(i, i % 25) for i in range(40)], "user_id long, item_id long")
    path = str(tmp_path_factory.mktemp("store"))
    return Store.save(spark, path, users, items, seen, buckets=8), u, v


def test_one_user_reads_one_bucket(spark, store):
    """The plan says so (where Spark is told to show buckets in plans without joins), and the scan reads fewer rows than there are."""
    s, _, _ = store
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(auto, "false")
    try:
        for df in (s.users(7), s.seen(7), spark.table(s.tables["names"]).where("name = 'name 3'")):
            assert "SelectedBucketsCount: 1 out of 8" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(auto)
    for df in (s.users(7), s.seen(7)):
        assert len(df.collect()) == 1
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert 1 <= scan.metrics().apply("numOutputRows").value() < 20


@pytest.mark.parametrize("cosine,blend,with_seen", [(True, 0.0, False), (False, 0.4, False), (True, 0.3, True)])
def test_recommendations_by_id_and_name(spark, store, cosine, blend, with_seen):
    s, u, v = store
    again = Store.open(spark, s.path)  # as another session would
    score = u[3] @ v.T
    if cosine:
        score = score / np.linalg.norm(u[3]) / np.linalg.norm(v, axis=1)
    score = (1 - blend) * score + blend * np.arange(25) / 25
    order = [j for j in np.argsort(-score) if with_seen or j != 3][:5]
    for got in (s.recommend(5, user_id=3, cosine=cosine, blend=blend, with_seen=with_seen), again.recommend(5, username="name 3", cosine=cosine, blend=blend, with_seen=with_seen)):
        rows = sorted(got.collect(), key=lambda r: r["rank"])
        assert [(r.user_id, r.item_id, r.name) for r in rows] == [(3, int(j), f"item {j}") for j in order]
        assert np.allclose([r.score for r in rows], score[order])


def test_unknown_and_ambiguous_users_are_errors(store):
    s, _, _ = store
    for bad in ({"username": "nobody"}, {"username": "name 6"}, {"user_id": 99}, {}, {"user_id": 1, "username": "name 1"}):
        with pytest.raises(ValueError):
            s.recommend(3, **bad)


def test_roles_survive_plans_and_files(spark, tmp_path):
    from cadenza.operators import rerank as rr
    cands = spark.createDataFrame([(1, 2, 0.5, 0.0), (1, 3, 0.4, 1.0)], "user_id long, item_id long, als_score double, als_rank double")
    prof = spark.createDataFrame([(1, 0.3)], "user_id long, uf_size double")
    items = spark.createDataFrame([(2, 0.1, 4, 9.0)], "item_id long, size double, item_pop_users long, item_pop_plays double")
    act = spark.createDataFrame([(1, 2, 3.0, 1.5)], "user_id long, user_seen_items long, user_total_plays double, user_mean_plays double")
    rows = rr.rerank_rows(cands, prof, items, act, ["size"], cands.select("user_id", "item_id").limit(1))
    want = {"group": ["user_id"], "item": ["item_id"], "label": ["label"], "feature": rr.FEATURES}
    assert ro.roles(rows) == want
    rows.where("label >= 0").join(prof.select("user_id"), "user_id").write.parquet(str(tmp_path / "rows"))
    again = spark.read.parquet(str(tmp_path / "rows"))
    assert ro.roles(again) == want
    assert "als_rank" not in ro.roles(again.withColumn("als_rank", F.col("als_rank") + 1))["feature"]  # another meaning, no role
    ro.report(again, str(tmp_path / "report"), target_split="val", pairs_used={"user": ["uf_size"], "item": ["size"]})
    got = json.loads(spark.read.text(str(tmp_path / "report")).first()[0])
    assert got["feature"] == rr.FEATURES and got["notes"] == {"target_split": "val", "pairs_used": {"user": ["uf_size"], "item": ["size"]}}
    with pytest.raises(ValueError):
        ro.with_roles(prof, feature=["nothing"])


def test_file_order_and_last_rows(spark, tmp_path):
    rows = [("a", "['x', 'y']"), ("b", "['z']"), (None, "[]"), ("a", "['y', 'y']"), ("c", None), ("b", "w, v"), (None, "['q']")]
    for k in range(3):  # files by name, rows in their order
        part = rows[k * 3:k * 3 + 3]
        spark.createDataFrame([(i, *r) for i, r in enumerate(part, k * 3)], "n long, id string, artists string").coalesce(1).write.parquet(str(tmp_path / "t" / f"part={k}"))
    got = ca.with_ordinal(spark, str(tmp_path / "t"))
    assert [r.ordinal for r in got.orderBy("n").collect()] == list(range(7)) and "__row" not in got.columns
    last = ca.last_rows(got.select("id", "artists", "ordinal"), "id")
    assert sorted((r.ordinal, r.id, r.artists) for r in last.collect()) == [(0, "a", "['y', 'y']"), (1, "b", "w, v"), (2, None, "['q']"), (4, "c", None)]
    items = ca.listed(last, "artists").collect()
    assert sorted((r.ordinal, r.place, r.artist_id) for r in items) == [(0, 0, "y"), (0, 1, "y"), (1, 0, "w"), (1, 1, "v"), (2, 0, "q")]
    assert sorted(map(tuple, ca.track_artists(got, "id", "artists").collect())) == [(0, "y"), (1, "v"), (1, "w"), (2, "q")]


def walk(tracks, genres):
    """Tracks in order; artists without genres take the union of those present."""
    genres = {a: set(g) for a, g in genres.items()}
    for _, artists in sorted(tracks.items()):
        union = set().union(*[genres.get(a, set()) for a in artists])
        for a in artists:
            if union and not genres.get(a):
                genres[a] = set(union)
    return genres


def test_imputation_is_the_walk_and_writes_each_row_once(spark, monkeypatch):
    rng = random.Random(4)
    written = []
    cut = ar.cut_table
    monkeypatch.setattr(ar, "cut_table", lambda df: (lambda t: (written.append(t.count()), t)[1])(cut(df)))
    for trial in range(3):
        n = 30
        genres = {a: [f"g{a}", "x"] if rng.random() < 0.15 else [] for a in range(n)}
        tracks = {t: rng.sample(range(n), rng.randint(1, 3)) for t in range(25)}
        pairs = spark.createDataFrame([(t, a) for t, aa in tracks.items() for a in aa], "track_id long, artist_id long")
        artists = spark.createDataFrame(list(genres.items()), "artist_id long, genres array<string>")
        written.clear()
        got = {r.artist_id: set(r.genres or []) for r in ar.impute_genres(pairs, artists).collect()}
        assert got == {a: g for a, g in walk(tracks, genres).items()}
        total = sum(len(aa) for aa in tracks.values())
        assert sum(written) < 12 * (total + n)  # linear, whatever the number of rounds
    none = ar.impute_genres(pairs, artists.withColumn("genres", F.array().cast("array<string>")))
    assert all(r.genres is None and r.t is None for r in none.collect())


def test_per_genre_reads_its_rows_once(spark):
    rng = random.Random(9)
    rows = [(rng.randint(0, 3), rng.choice("gh"), rng.choice([None, 1.0, 2.5, 7.0]), rng.randint(0, 5), rng.choice(["p", "q", None]), rng.choice([3, 1, None])) for _ in range(200)]
    rows.append((9, "g", None, 2, None, None))
    df = spark.createDataFrame(rows, "artist_id long, genre string, price double, n_plays long, status string, key int")
    out = ar.per_genre(df, ["price", "n_plays"], ["status", "key"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    for r in out.collect():
        mine = [x for x in rows if x[0] == r.artist_id and x[1] == r.genre]
        price = [x[2] for x in mine if x[2] is not None]
        assert r.n == len(mine) and (r.price is None if not price else abs(r.price - sum(price) / len(price)) < 1e-9)
        assert abs(r.w - len(mine) / sum(x[0] == r.artist_id for x in rows)) < 1e-9
        for i, c in ((4, "status"), (5, "key")):
            vals = [x[i] for x in mine if x[i] is not None]
            assert r[c] == (min(set(vals), key=lambda v: (-vals.count(v), v)) if vals else None)
    vec = {r.artist_id: r for r in ar.artist_vectors(out, ["price"], ["status", "key"]).collect()}
    per = out.collect()
    for a, r in vec.items():
        mine = sorted([x for x in per if x.artist_id == a], key=lambda x: (-x.w, x.genre))
        assert (r.status, r.key) == (mine[0].status, mine[0].key) and r.top_genres == ",".join(x.genre for x in mine)
    assert ar.per_genre(df, ["price"], []).count() == out.count()


def test_genre_summary_is_the_separate_parts(spark):
    df = spark.createDataFrame([(1, 2.0, "['a', 'b']"), (1, 1.0, "b|c"), (2, 5.0, "d"), (3, 1.0, ""), (4, 1.0, "['x','y','z','w']")], "user_id long, plays double, g string")
    dist = pf.genre_distribution(df, "g")
    want = {r.user_id: r for r in pf.genre_topk(dist).join(pf.genre_entropy(dist), "user_id").collect()}
    got = {r.user_id: r for r in pf.genre_summary(df, "g").collect()}
    assert got.keys() == want.keys()
    for u, r in got.items():
        assert [r[f"user_genre_top{i}"] for i in (1, 2, 3)] == [want[u][f"user_genre_top{i}"] for i in (1, 2, 3)]
        assert abs(r.user_genre_entropy - want[u].user_genre_entropy) < 1e-9
