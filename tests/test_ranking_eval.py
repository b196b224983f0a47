import itertools

import pytest
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import functions as F

from cadenza.operators import evaluate as ev
from cadenza.operators import ranking as rk


def test_seen_items_never_returned(spark):
    seen = spark.createDataFrame([(1, i) for i in range(5)], "user_id long, item_id long")
    scores = spark.createDataFrame([(i, float(10 - i)) for i in range(8)], "item_id long, score double")
    users = spark.createDataFrame([(1,)], "user_id long")
    out = rk.topn_unseen_by_item_score(users, seen, scores, 5)
    assert sorted(r.item_id for r in out.collect()) == [5, 6, 7]


def test_ties_break_on_item_id(spark):
    df = spark.createDataFrame([(1, 7, 1.0), (1, 3, 1.0)], "user_id long, item_id long, score double")
    assert [r.item_id for r in rk.topn(df, "score", 2).orderBy("rank").collect()] == [3, 7]


def test_topn_unseen_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    items = [(i, float(rnd.randint(0, 20))) for i in range(60)]
    seen = [(u, i) for u in range(12) for i in range(60) if rnd.random() < (0.9 if u == 0 else 0.2)]
    n = 5
    exp = {}
    for u in range(12):
        s = {i for uu, i in seen if uu == u}
        ranked = sorted((i for i, _ in items if i not in s), key=lambda i: (-dict(items)[i], i))[:n]
        exp[u] = ranked
    got = rk.topn_unseen_by_item_score(
        spark.createDataFrame([(u,) for u in range(12)], "user_id long"),
        spark.createDataFrame(seen, "user_id long, item_id long"),
        spark.createDataFrame(items, "item_id long, score double"), n)
    res = {}
    for r in got.orderBy("user_id", "rank").collect():
        res.setdefault(r.user_id, []).append(r.item_id)
    assert res == exp


def _fixture(spark):
    ranked = spark.createDataFrame([(1, i, i) for i in range(5)], "user_id long, item_id long, rank long")
    truth = spark.createDataFrame([(1, 0), (1, 2), (1, 99)], "user_id long, item_id long")
    return ranked, truth


def test_split_family_fixture(spark):
    ranked, truth = _fixture(spark)
    r = ev.per_user_split(ranked, truth, 3).first()
    assert (r.precision, r.ap, r.ndcg) == pytest.approx((0.666667, 0.555556, 0.703918), abs=1e-6)


def test_list_family_fixture(spark):
    scored = spark.createDataFrame([(1, i, float(10 - i), lab) for i, lab in enumerate([1, 0, 1, 0, 0])],
                                   "user_id long, item_id long, score double, label long")
    r = ev.per_user_list(scored, 3).first()
    assert (r.precision, r.ap, r.ndcg) == pytest.approx((0.666667, 0.833333, 0.919721), abs=1e-6)


def test_list_family_short_list_and_no_positives(spark):
    scored = spark.createDataFrame([(1, 1, 2.0, 1), (1, 2, 1.0, 0), (2, 1, 1.0, 0)],
                                   "user_id long, item_id long, score double, label long")
    got = {r.user_id: r for r in ev.per_user_list(scored, 3).collect()}
    assert got[1].precision == pytest.approx(0.5)  # divides by min(K, len) = 2
    assert (got[2].precision, got[2].ap, got[2].ndcg) == (0.0, 0.0, 0.0)


def test_split_family_agrees_with_ranking_evaluator(spark):
    ranked = spark.createDataFrame([(1, 3, 0), (1, 1, 1), (1, 9, 2)], "user_id long, item_id long, rank long")
    truth = spark.createDataFrame([(1, 1), (1, 2)], "user_id long, item_id long")
    r = ev.per_user_split(ranked, truth, 10).first()
    pl = spark.createDataFrame([([3.0, 1.0, 9.0], [1.0, 2.0])], "prediction array<double>, label array<double>")
    for metric, ours in (("precisionAtK", r.precision), ("meanAveragePrecisionAtK", r.ap), ("ndcgAtK", r.ndcg)):
        theirs = RankingEvaluator(metricName=metric, k=10).evaluate(pl)
        assert ours == pytest.approx(theirs, abs=1e-9)


def test_metrics_in_unit_interval(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 11), (u + i) % 2) for u, i in itertools.product(range(5), range(8))]
    scored = spark.createDataFrame(rows, "user_id long, item_id long, score double, label long")
    for r in ev.per_user_list(scored, 5).collect():
        assert 0.0 <= r.precision <= 1.0 and 0.0 <= r.ap <= 1.0 and 0.0 <= r.ndcg <= 1.0 + 1e-12
    s = ev.summarize(ev.per_user_list(scored.where(F.lit(False)), 5), 5, "list").first()
    assert (s.users, s.precision_at_k) == (0, 0.0)


def test_lookup_user_and_dimension(spark):
    users = spark.createDataFrame([(0, "ann"), (1, "bob")], "user_id long, username string")
    assert rk.lookup_user(users, username="bob").first().user_id == 1
    with pytest.raises(ValueError):
        rk.lookup_user(users, user_id=7)
    df = spark.createDataFrame([(0,), (5,)], "user_id long")
    assert [r.user_id for r in rk.in_dimension(df, users, "user_id").collect()] == [0]


@pytest.mark.parametrize("low", [200_000, 7])
def test_topn_unseen_gaps_with_nulls_and_repeats(spark, monkeypatch, low):
    """Candidates are made from the gaps between seen ranks, without a shuffle or an anti join of candidates."""
    import random
    monkeypatch.setattr(rk, "BROADCAST_RANKS", low)
    rnd = random.Random(3)
    items = [(i, float(rnd.randint(0, 9))) for i in range(40)] + [(None, 4.0)]
    seen = [(u, i) for u in (1, 2, 3) for i in range(45) if rnd.random() < {1: 0.95, 2: 0.4, 3: 0.1}[u]]
    seen += seen[:20] + [(None, 3), (2, None), (9, 1)]
    users = [(1,), (2,), (2,), (3,), (4,), (None,)]
    n = 6
    got = rk.topn_unseen_by_item_score(spark.createDataFrame(users, "user_id long"), spark.createDataFrame(seen, "user_id long, item_id long"),
                                       spark.createDataFrame(items, "item_id long, score double"), n)
    order = sorted(items, key=lambda r: (-r[1], -1 if r[0] is None else r[0]))
    want = set()
    for u in {u for u, in users}:
        left = [r for r in order if r[0] is None or u is None or (u, r[0]) not in seen][:n]
        want |= {(u, i, s, k) for k, (i, s) in enumerate(left)}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(want) and set(rows) == want
    if low > 7:
        assert "LeftAnti" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_label_join_keeps_candidates_in_place(spark):
    cands = spark.createDataFrame([(1, 2, 0.5), (1, None, 0.4), (None, 2, 0.3), (2, 2, 0.2), (2, 2, 0.2)], "user_id long, item_id long, s double")
    truth = spark.createDataFrame([(1, 2), (1, 2), (1, None), (None, 2), (3, 2)], "user_id long, item_id long")
    out = rk.label_join(cands, truth)
    assert out.columns == ["user_id", "item_id", "s", "label"]
    assert sorted((str(r.user_id), str(r.item_id), r.label) for r in out.collect()) == [
        ("1", "2", 1), ("1", "None", 0), ("2", "2", 0), ("2", "2", 0), ("None", "2", 0)]
    by_user = rk.label_join(cands.repartition(4, "user_id"), truth)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id" in by_user and "item_id" not in "".join(x for x in by_user.splitlines() if "hashpartitioning" in x and "item_id" in x.split("hashpartitioning")[1])


def _orders(spark, path):
    """Small orders, lines and parts: user 1 has most plays of a part that isn't there, an order has no user, a user has none of the lines."""
    tables = {"orders": ("o_orderkey long, o_custkey long, o_totalprice double", [(1, 1, 50.0), (2, 1, 70.0), (3, 2, 70.0), (4, None, 90.0), (5, 3, 10.0)]),
              "lineitem": ("l_orderkey long, l_partkey long, l_linenumber int, l_quantity double",
                           [(1, 10, 1, 3.0), (1, 11, 2, 1.0), (2, 10, 1, 4.0), (2, 10, 2, 4.0), (2, 99, 3, 50.0), (3, 11, 1, 2.0), (3, 10, 2, 5.0), (4, 11, 1, 6.0), (4, None, 2, 1.0)]),
              "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                       [(10, "red", "b", "SMALL", 1, 2.0), (11, "blue", "b", "LARGE", 2, 3.0), (12, "green", "b", "SMALL", 3, 4.0)])}
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_expanded_by_user_equals_expand_and_moves_once(spark, tmp_path):
    from cadenza.operators import playlist as pl
    from cadenza.plans import q_text as qt
    d = _orders(spark, tmp_path)
    best = qt.best_tracks_exact(spark, d)
    old, new = qt.expand(spark, d, best).drop("track_name"), qt.expand_by_user(spark, d, best)
    cols = sorted(old.columns)
    assert sorted(new.columns) == cols
    want = sorted(map(tuple, old.select(cols).collect()))
    assert want and sorted(map(tuple, new.select(cols).collect())) == want
    plan = pl.dedupe_tracks(new, placed=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id") == 1
    rows = qt.recs(spark, d)
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(user_id") == 1
    # the largest number of plays is that of the part that isn't there
    assert {(r.user_id, r.item_id): r.base_score for r in rows.collect()} == {(1, 10): 0.22, (1, 11): 0.02, (1, 99): 1.0, (2, 11): 0.4, (2, 10): 1.0}


def test_track_items_meet_tracks_without_another_move(spark, tmp_path):
    from cadenza.plans import q_text as qt
    plan = qt.best_tracks_exact(spark, _orders(spark, tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(track_id") == 1
