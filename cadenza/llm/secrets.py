"""Secret scan with a random forest that removes false positives, in DataFrame functions and JVM estimators only.

Candidates are runs of at least MIN_CHARS characters of the alphabets that keys use. Features of a candidate: its length, shares of
character classes and of distinct characters, transitions between classes, how much of it a dictionary of
letter trigrams covers (the trigrams of all words of the corpus, at most 26^3), whether it looks like a path or
URL, and the neighbouring words: a word of SECRET_WORDS before it, an assignment, quotes.

The forest is trained on labelled findings (``label`` 1: a secret). ``labelled_findings`` makes them where nobody has:
positives are long hexadecimal or mixed strings that a secret word is assigned to; negatives are candidates of ordinary letters, plain
numbers, and lower-case paths. Each positive also counts once without its neighbours, so that the forest
learns what secrets look like, not only where they stand. At most LABELLED findings, by hash, train the forest.

Defined cases: null and empty texts have no candidates; null ids are compared null-safely; repeated rows give equal rows; without findings of both
labels nothing is scored (probability null, no secret); empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from cadenza.llm.common import let, placed
from cadenza.session import cut_lineage

MIN_CHARS = 16
CANDIDATE = rf"[A-Za-z0-9+/=_-]{{{MIN_CHARS},}}+"
#: Words that announce a secret.
SECRET_WORDS = ("access", "api", "apikey", "auth", "authorization", "bearer", "credential", "key", "passwd", "password", "private",
                "pwd", "secret", "token")
NEAR_CHARS = 40
LABELLED = 20_000
TREES, DEPTH, SEED = 20, 6, 17
THRESHOLD = 0.5
SHAPE = ("length", "lower", "upper", "digit", "hex", "distinct", "turns", "case_turns", "vowels", "covered", "path")
PLACE = ("secret_word", "assigned", "quoted")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, start, end, value, before, after) of every candidate, in code points."""
    text = F.coalesce(text_col, F.lit(""))
    found = let(F.struct(F.split(text, CANDIDATE, -1).alias("g"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("m")),
                lambda x: F.transform(x["m"], lambda m, i: F.struct(
                    i.alias("k"), F.length(x["g"][i]).alias("gap"), F.length(m).alias("len"), m.alias("value"),
                    F.right(x["g"][i], F.lit(NEAR_CHARS)).alias("before"), F.left(x["g"][i + 1], F.lit(NEAR_CHARS)).alias("after"))))
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), F.explode(found).alias("x")).select("id", "th", "x.*")
    return placed(d, ["id", "th"]).select("id", "th", "start", "end", "value", "before", "after")


def trigrams(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(trigram, weight): letter trigrams of all lower-case words of all documents; weight: the log of the count, relative to the most frequent one's."""
    w = docs.select(F.explode(F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(r"(?<![A-Za-z0-9])[a-z]{3,15}+(?![A-Za-z0-9])"), F.lit(0))).alias("w"))
    w = w.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    g = w.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 2), lambda i: F.substring("w", i, F.lit(3)))).alias("trigram"))
    g = cut_lineage(g.groupBy("trigram").agg(F.sum("n").alias("n")))  # at most 26^3 rows
    total = g.agg(F.max("n")).first()[0] or 1
    return g.select("trigram", (F.log1p("n") / F.log1p(F.lit(float(total)))).alias("weight"))


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


def with_features(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Candidates with the columns of SHAPE and PLACE. Values are measured once, however often they occur."""
    v = found.select("value").distinct()
    low = F.lower("value")
    g = v.select("value", F.explode(F.transform(F.sequence(F.lit(1), F.length("value") - 2), lambda i: F.substring(low, i, F.lit(3)))).alias("trigram"))
    g = g.join(F.broadcast(dictionary), "trigram", "left").groupBy("value").agg(F.avg(F.coalesce("weight", F.lit(0.0))).alias("covered"))
    value = F.col("value")
    v = g.withColumns({
        "length": F.log2(F.length("value")), "lower": _share(value, "[a-z]"), "upper": _share(value, "[A-Z]"), "digit": _share(value, "[0-9]"),
        "hex": _share(value, "[0-9a-fA-F]"), "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        "turns": _share(value, "[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"), "case_turns": _share(value, "[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "vowels": _share(value, "[aeiouAEIOU]"), "path": _share(value, "[/=_-]")})
    near = F.lower(F.col("before"))
    place = {"secret_word": near.rlike(rf"(?<![a-z])(?:{'|'.join(SECRET_WORDS)})[^a-z]*$"), "assigned": near.rlike(r"[=:]\s*[\x22\x27]?$"),
             "quoted": near.rlike(r"[\x22\x27]$") & F.col("after").rlike(r"^[\x22\x27]")}
    return found.withColumns({k: c.cast("double") for k, c in place.items()}).join(v, "value")


def labelled_findings(scored: DataFrame) -> DataFrame:
    """Findings (candidates with features) that a rule can label; each positive also without its neighbours."""
    positive = (F.col("secret_word") > 0) & (F.col("assigned") > 0) & (F.col("digit") > 0) & ((F.col("hex") == 1) | (F.col("turns") > 0.1))
    negative = (F.col("digit") == 0) & (F.col("covered") >= 0.3) | (F.col("digit") == 1) | (F.col("path") > 0) & (F.col("upper") == 0) & (F.col("digit") < 0.2)
    rows = scored.withColumn("label", F.when(positive, 1.0).when(negative & (F.col("secret_word") == 0), 0.0)).filter("label is not null")
    bare = rows.filter("label = 1").withColumns({k: F.lit(0.0) for k in PLACE})
    return rows.unionByName(bare)


def train(findings: DataFrame, labelled: int = LABELLED) -> RandomForestClassificationModel | None:
    """A forest from labelled findings with features; both labels get half of the places. None if a label is missing."""
    part = [findings.filter(F.col("label") == k).orderBy(F.xxhash64("value", "start", "id", *PLACE)).limit(labelled // 2) for k in (0.0, 1.0)]
    rows = cut_lineage(VectorAssembler(inputCols=[*SHAPE, *PLACE], outputCol="features").transform(reduce(DataFrame.unionByName, part)).select("features", "label"))
    if rows.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(rows)


def scan(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every candidate: id, start, end, value, probability, secret. ``findings``: labelled findings with the columns of SHAPE, PLACE and ``label``."""
    found = cut_lineage(with_features(candidates(docs, id_col, text_col), trigrams(docs, text_col)))
    model = train(labelled_findings(found) if findings is None else findings)
    if model is None:
        return found.select("id", "start", "end", "value", F.lit(None).cast("double").alias("probability"), F.lit(False).alias("secret"))
    x = model.transform(VectorAssembler(inputCols=[*SHAPE, *PLACE], outputCol="features").transform(found))
    p = vector_to_array("probability")[1]
    return x.select("id", "start", "end", "value", p.alias("probability"), (p >= THRESHOLD).alias("secret"))
