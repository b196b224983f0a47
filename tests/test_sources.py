import os

import pytest

from cadenza.sources import tables as tb


def _csv(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_read_any_csv_cleans_headers_and_reads_parquet(spark, tmp_path):
    p = _csv(os.path.join(tmp_path, "log.csv"), " Username ,Artist,Plays\nu1,Air,3\nu1,Air,2\nu2,Björk,1\n")
    df = tb.read_any(spark, p)
    assert df.columns == ["username", "artist", "plays"]
    out = os.path.join(tmp_path, "log.parquet")
    tb.write_table(df, out)
    assert tb.read_any(spark, out).count() == 3


def test_read_interactions_three_shapes(spark, tmp_path):
    named = tb.read_any(spark, _csv(os.path.join(tmp_path, "a.csv"), "Username,Artist,Playcount\nu,A,3\nu,A,2\nv,B,1\n"))
    got = {(r.username, r.artist): r.plays for r in tb.read_interactions(named).collect()}
    assert got == {("u", "A"): 5.0, ("v", "B"): 1.0}
    raw = tb.read_any(spark, _csv(os.path.join(tmp_path, "b.csv"), "username,artist\nu,A\nu,A\n,A\n"))
    assert [(r.artist, r.plays) for r in tb.read_interactions(raw).collect()] == [("A", 2.0)]
    ids = spark.createDataFrame([(1, 2, 3.0)], "user_id long, artist_id long, plays double")
    assert tb.read_interactions(ids).columns == ["user_id", "item_id", "plays"]
    with pytest.raises(ValueError):
        tb.read_interactions(spark.createDataFrame([(1,)], "x long"))


def test_resolve_pick_require_numeric(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "ID long, Artist_Name string, tempo double")
    assert tb.resolve(df, "artist", "artist_name") == "Artist_Name"
    assert tb.resolve(df, "nope", fallback_position=1) == "Artist_Name"
    assert tb.present(df, "tempo", "valence", "ID") == ["tempo", "ID"]
    assert tb.numeric_columns(df, exclude=["ID"]) == ["tempo"]
    with pytest.raises(ValueError):
        tb.require(df, ["ID", "valence"])


def test_report_roundtrip(spark, tmp_path):
    r = spark.createDataFrame([(10, 99.5)], "total_rows long, row_coverage_pct double")
    tb.write_report(r, os.path.join(tmp_path, "coverage.json"))
    assert tb.report_dict(spark.read.json(os.path.join(tmp_path, "coverage.json"))) == {
        "row_coverage_pct": 99.5, "total_rows": 10}
