import pytest
from pyspark.sql import functions as F

from cadenza.operators import interactions as it
from cadenza.operators import popularity as pop


def _inter(spark, n):
    return spark.createDataFrame([(i // 3, i, 1.0) for i in range(n)], "user_id long, item_id long, plays double")


@pytest.mark.parametrize("n,sizes", [(10, (8, 1, 1)), (25, (21, 2, 2))])
def test_split_exact_sizes(spark, n, sizes):
    s = it.split_exact(_inter(spark, n), 0.1, 0.1, 42)
    c = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert (c.get("train", 0), c.get("val", 0), c.get("test", 0)) == sizes
    assert s.select("user_id", "item_id").distinct().count() == n  # disjoint and covering


def test_split_ratio_error(spark):
    with pytest.raises(ValueError):
        it.split_exact(_inter(spark, 10), 0.5, 0.5)


def test_split_hash_matches_known_value(spark):
    df = spark.createDataFrame([(1, 2)], "user_id long, item_id long")
    assert df.select(it.split_hash_col(42)).first()[0] == 3408329346


def _weights_fixture(spark):
    rows = [(1, 1, 1.0), (1, 2, 1.0), (2, 1, 1.0), (3, 3, 2.0), (4, 3, 1.0)]
    return spark.createDataFrame(rows, "user_id long, item_id long, plays double")


def test_bm25_tfidf(spark):
    t = _weights_fixture(spark)
    bm = {(r.user_id, r.item_id): r.weight for r in it.bm25_weight(t).collect()}
    assert bm[(1, 1)] == pytest.approx(0.253160, abs=1e-6)
    assert bm[(3, 3)] == pytest.approx(0.361657, abs=1e-6)
    tf = {(r.user_id, r.item_id): r.weight for r in it.tfidf_weight(t).collect()}
    assert tf[(1, 1)] == pytest.approx(0.287682, abs=1e-6)


def test_pop_prior(spark):
    t = spark.createDataFrame([(1, 1, 8.0), (1, 2, 3.0), (1, 3, 0.0)], "user_id long, item_id long, plays double")
    got = {r.item_id: r.prior for r in pop.pop_prior(t).collect()}
    assert got[1] == pytest.approx(1.0) and got[2] == pytest.approx(0.630930, abs=1e-6) and got[3] == 0.0
    z = spark.createDataFrame([(1, 1, 0.0)], "user_id long, item_id long, plays double")
    assert pop.pop_prior(z).first().prior == 0.0


def test_pq_core_is_stable(spark, tmp_path):
    rows = [(u, i, 1.0) for u in range(6) for i in range(6) if (u + i) % 3 != 0] + [(9, 0, 1.0), (0, 9, 1.0)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, plays double")
    core = it.pq_core(df, 3, 3)
    again = it.pq_core(core, 3, 3)
    assert core.count() == again.count() == 24
    assert core.where(F.col("user_id") == 9).count() == 0


def test_dense_ids_follow_code_point_order(spark):
    named = spark.createDataFrame([("b", "Zed", 1.0), ("a", "Ábc", 1.0), ("a", "abc", 2.0)],
                                  "username string, artist string, plays double")
    users, items = it.id_maps(named)
    assert [r.item_name for r in items.orderBy("item_id").collect()] == sorted(["Zed", "Ábc", "abc"])
    enc = it.encode_ids(named, users, items)
    assert enc.count() == 3


def test_core_of_a_long_chain(spark):
    """Peeling a path removes its ends only, layer by layer: more rounds than any fixed number."""
    from cadenza.operators import interactions as it
    path = [(k, k, 1.0) for k in range(30)] + [(k, k + 1, 1.0) for k in range(30)]
    df = spark.createDataFrame(path, "user_id long, item_id long, plays double")
    assert it.pq_core(df, 2, 2).count() == 0


def test_split_sizes_and_order(spark):
    from cadenza.operators import interactions as it
    df = spark.createDataFrame([(u, i, 1.0) for u in range(37) for i in range(11)], "user_id long, item_id long, plays double")
    rows = it.split_exact(df, 0.1, 0.2).withColumn("h", it.split_hash_col()).collect()
    n = len(rows)
    want = [r.split for r in sorted(rows, key=lambda r: (r.h, r.user_id, r.item_id))]
    assert want == ["train"] * (n - round(n * 0.1) - round(n * 0.2)) + ["val"] * round(n * 0.1) + ["test"] * round(n * 0.2)
    assert it.split_exact(df.limit(0), 0.1, 0.2).count() == 0


def test_pq_core_rounds_are_tables(spark, monkeypatch):
    """A round is a table, not a checkpoint of rows; rows with null ids and repeated rows stay as the degrees say."""
    cut = []
    real = it.cut_table
    monkeypatch.setattr(it, "cut_table", lambda df: cut.append(df) or real(df))
    rows = [(1, 1), (1, 2), (2, 1), (2, 2), (2, 2), (3, 2), (3, 3), (None, 1), (None, 2), (4, None), (4, None)]
    core = it.pq_core(spark.createDataFrame(rows, "user_id long, item_id long"), 2, 2)
    assert len(cut) >= 3 and core.inputFiles()
    assert sorted(map(tuple, core.collect())) == [(1, 1), (1, 2), (2, 1), (2, 2), (2, 2)]
