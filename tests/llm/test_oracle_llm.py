"""The queries with SQL against DuckDB, and the others' contracts, on the smallest tables."""
import duckdb
import pytest

import __spark_entry__ as E

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "pages", "labels", "embeddings")


@pytest.mark.parametrize("name", ["op3_benchmark_decontamination", "op4_exact_dedup", "op8_ngram_jaccard_join", "op9_warc_revisits", "op12_centroid_clustering", "op13_merkle_manifest"])
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = E.queries()[name](spark, SMALL)
    rel = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in rel.description]
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(str, rel.fetchall()))


def test_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()


@pytest.mark.parametrize("name,columns", [("op1_pii_sanitisation", {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"}),
                                          ("op7_suffix_array_dedup", {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"}),
                                          ("op10_quality_knn", {"doc_id", "held_out", "score", "predicted"})])
def test_contract_columns(spark, name, columns):
    df = E.queries()[name](spark, SMALL)
    assert set(df.columns) >= columns and df.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
