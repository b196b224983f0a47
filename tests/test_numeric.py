import pytest
from pyspark.sql import functions as F

from cadenza.functions import numeric as nf
from cadenza.operators.artists import weighted_mean


def test_boolize_whole_column_rule(spark):
    a = spark.createDataFrame([(i, v) for i, v in enumerate(["yes", "no", "True", "0", "x"])], "i int, c string")
    assert [r.c for r in nf.boolize(a, ["c"]).orderBy("i").collect()] == [1.0, 0.0, 1.0, 0.0, 0.0]
    b = spark.createDataFrame([(i, v) for i, v in enumerate(["yes", "no", "True", "x"])], "i int, c string")
    assert [r.c for r in nf.boolize(b, ["c"]).orderBy("i").collect()] == [0.0, 0.0, 0.0, 0.0]


def test_safe_numeric(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), (None,)], "c string")
    assert [r[0] for r in df.select(nf.safe_double("c")).collect()] == [1.5, 0.0, 0.0]
    assert [r[0] for r in df.select(nf.safe_id("c")).collect()] == [1, -1, -1]


def test_weighted_mean(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, None), ("a", 1.0, 4.0), ("b", 1.0, None)],
                               "artist_id string, w double, x double")
    out = {r.artist_id: r.x for r in weighted_mean(df, ["artist_id"], ["x"]).collect()}
    assert out == {"a": 3.0, "b": 0.0}


def test_similarity_and_final(spark):
    df = spark.createDataFrame([(150.0, 120.0), (300.0, 120.0), (None, 120.0)], "x double, mu double")
    got = [r[0] for r in df.select(nf.similarity("x", "mu", 80.0)).collect()]
    assert got == pytest.approx([0.625, 0.0, 0.5])
    one = spark.range(1).select(nf.final_score(F.lit(0.5), F.lit(0.625), F.lit(1.0)))
    assert one.first()[0] == pytest.approx(0.625)


def test_alpha_blend(spark):
    df = spark.createDataFrame([(2.0, 0.4)], "r double, a double")
    for alpha, exp in [(0.5, 1.2), (1.7, 2.0), (0.0, 0.4)]:
        assert df.select(nf.alpha_blend("r", "a", alpha)).first()[0] == pytest.approx(exp)


def test_ids_and_numbers_of_any_type(spark):
    df = spark.createDataFrame([("3.0", 3.0), ("nan", float("nan")), ("9223372036854775807", None)], "c string, x double")
    assert [r[0] for r in df.select(nf.safe_id("c")).collect()] == [3, -1, 9223372036854775807]
    assert [r[0] for r in df.select(nf.safe_id("x")).collect()] == [3, -1, -1]
    assert [r[0] for r in df.select(nf.safe_double("c")).collect()] == [3.0, 0.0, float(2**63)]
    assert [r.x for r in nf.safe_numeric(df, ["x", "c"]).collect()] == [3.0, 0.0, 0.0]


def test_boolize_keeps_numbers_and_booleans(spark):
    df = spark.createDataFrame([(i, v, v > 0) for i, v in enumerate([0, 1, 1, 0, 1, 0, 0, 1, 5])], "i int, c int, b boolean")
    got = nf.boolize(df, ["c", "b"]).orderBy("i").collect()
    assert [r.c for r in got] == [0, 1, 1, 0, 1, 0, 0, 1, 5] and [r.b for r in got] == [0, 1, 1, 0, 1, 0, 0, 1, 1]
