from pyspark.sql import functions as F

from cadenza.functions import text as tx


def _one(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(fn("s")).collect()]


def test_name_keys(spark):
    vals = ["Beyoncé & Co", "AC/DC", " A  B ", "Under_Score", "ﬁx²", None]
    assert _one(spark, vals, tx.normalize_alnum) == ["beyonceco", "acdc", "ab", "underscore", "fix2", ""]
    assert _one(spark, vals, tx.key_basic) == ["beyoncé & co", "ac/dc", "a  b", "under_score", "ﬁx²", None]
    assert _one(spark, vals, tx.key_loose) == ["beyonceco", "acdc", "ab", "underscore", "fix2", ""]
    assert _one(spark, vals, tx.key_word) == ["beyonceco", "acdc", "ab", "underscore", "fix2", ""]


def test_hangul_kept_by_alnum_dropped_by_loose(spark):
    alnum = _one(spark, ["뉴진스"], tx.normalize_alnum)[0]
    assert len(alnum) == 7  # decomposed jamo
    assert _one(spark, ["뉴진스"], lambda c: tx.join_key(c, "loose")) == [None]  # empty key never matches


def test_parse_list(spark):
    vals = ["['a', 'b']", "[\"children's music\", 'x']", "[]", "['it\\'s']", "a, b", None]
    got = _one(spark, vals, tx.parse_list)
    assert got == [["a", "b"], ["children's music", "x"], [], ["it's"], ["a", "b"], None]


def test_primary_and_genre_tokens(spark):
    assert _one(spark, ["['x', 'y']", "plain"], tx.primary_item) == ["x", None]
    assert _one(spark, ["['rock', ' pop ']", "rock|pop, jazz", "", None], tx.genre_tokens) == [
        ["rock", "pop"], ["rock", "pop", "jazz"], [], []]


def test_join_top(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],)], "g array<string>")
    assert df.select(tx.join_top(F.col("g"), 3)).first()[0] == "a,b,c"


def test_lists_with_none_and_tuples(spark):
    vals = ['["a, b", None]', "('a','b')", "['a', null]", "['rock', None]", "('solo',)", "[None]", "['None', \"it's\"]"]
    assert _one(spark, vals, tx.parse_list) == [["a, b"], ["a", "b"], ["a"], ["rock"], ["solo"], [], ["None", "it's"]]
    assert _one(spark, ["['rock', None]", "['a', null]"], tx.genre_tokens) == [["rock"], ["a"]]


def test_unicode_blanks_are_trimmed(spark):
    assert _one(spark, ["　Air ", "  x y \x1c"], tx.key_basic) == ["air", "x y"]


def test_decompose_in_pieces(spark):
    """A batch is decomposed in pieces: no worker holds it all as Python texts."""
    import unicodedata

    from cadenza.functions import text as tx
    assert tx.decompose.evalType == tx.F.arrow_udf(lambda x: x, "string").evalType
    texts = [None, "", "ﬁ Ångström", "áéí", "한글"] * 300
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").coalesce(1)
    got = {r.i: r.d for r in df.select("i", tx.decompose("s").alias("d")).collect()}
    assert got == {i: unicodedata.normalize("NFKD", s or "") for i, s in enumerate(texts)}
