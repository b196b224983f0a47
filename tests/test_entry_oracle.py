import duckdb
import pytest

import __spark_entry__ as E

SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
CHECK = ["interactions_from_orders", "split_exact", "bm25_weight", "unseen_candidates", "eval_summary",
         "key_loose", "name_join", "artist_vectors", "user_profiles", "cosine_topk", "rerank_dataset",
         "playlist", "track_expand_contains"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 2 and set(df.columns) >= {"precision_at_k", "map_at_k", "ndcg_at_k"}


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 95 and len(o) >= 89


@pytest.mark.parametrize("name", CHECK)
def test_matches_duckdb_on_small(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    sdf = E.queries()[name](spark, SMALL)
    srows = sorted(tuple(str(round(v, 6) + 0.0 if isinstance(v, float) else v) for _, v in sorted(r.asDict().items()))
                   for r in sdf.collect())
    rel = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    drows = sorted(tuple(str(round(float(v), 6) + 0.0 if isinstance(v, float) else v) for _, v in sorted(zip(cols, r)))
                   for r in rel.fetchall())
    assert sorted(sdf.columns) == sorted(cols)
    assert srows == drows
