"""Helpers that the training-data operators share."""

from __future__ import annotations

import string
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window, functions as F

from cadenza.session import cut_lineage, ensure_checkpoint_dir

#: Explicit broadcasts hold at most so many rows; beyond that each operator shuffles instead.
BROADCAST_ROWS = 200_000
#: Keys with more than 1/HEAVY of all rows count as heavy; there are at most HEAVY of them.
HEAVY = 1000
ROWS_PER_TASK = 50_000
#: Words of the contracts: runs of ASCII letters, digits and all non-ASCII characters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words in a text that is not lower-cased.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that ``df`` does not have (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body) -> Column:
    """``body`` applied to a value that is computed once per row (a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; other letters stay. Texts of ASCII alone take the faster ``lower``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) contract words of a text; none for null."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def placed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Start and end of matches numbered ``k`` from the pieces between them (``gap`` before each, ``len``), by a running sum
    over the matches of a key; repeated rows count once."""
    rows = rows.repartition(*keys).dropDuplicates([*keys, "k"])
    w = Window.partitionBy(*keys).orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum(F.col("gap") + F.col("len")).over(w), F.lit(0)) + F.col("gap"))
    return rows.withColumn("end", F.col("start") + F.col("len"))


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a (checkpointed) table is small enough for an explicit broadcast."""
    return df.limit(limit + 1).count() <= limit


def maybe_broadcast(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if small(df) else df


def join_counted(left: DataFrame, groups: DataFrame, keys: list[str], count: str, how: str = "inner") -> DataFrame:
    """Equi-join rows with a table of one row per key, where ``count`` says how many rows of
    ``left`` the key has. Heavy keys (at most HEAVY of them, by their share of the rows) are
    broadcast, so that no task gets a hot key; the rest is a shuffle join. ``left`` is read twice."""
    total = groups.agg(F.sum(count)).first()[0] or 0
    hot = F.col(count) > total / HEAVY
    heavy, light = groups.filter(hot), groups.filter(~hot)
    a = left.join(F.broadcast(heavy), keys, "inner")
    b = left.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(light, keys, how)
    return a.unionByName(b)


def cut_table(df: DataFrame) -> DataFrame:
    """A large intermediate table written as Parquet in the shared folder, which takes less room than a checkpoint, and read again."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def swept(spark):
    """Queries run within delete the files of their shuffles as they end, not when the driver next collects garbage. For rounds of checkpoints
    and tables, which don't read a shuffle again."""
    clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(clean, None)
    spark.conf.set(clean, "true")
    try:
        yield
    finally:
        spark.conf.unset(clean) if was is None else spark.conf.set(clean, was)


def cut_sized(df: DataFrame, rows: int) -> DataFrame:
    """A checkpoint of a table of about so many rows, in partitions of ROWS_PER_TASK: rounds over small tables
    then need few tasks, whatever the session's number of shuffle partitions."""
    return cut_lineage(df.coalesce(max(1, -(-rows // ROWS_PER_TASK))))


def same(a: DataFrame, b: DataFrame, *cols: str) -> Column:
    """Null-safe equality on columns that both sides have."""
    cond = a[cols[0]].eqNullSafe(b[cols[0]])
    for c in cols[1:]:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def drop_rows(docs: DataFrame, decided: DataFrame, text_hash: Column, id_col: str, hash_col: str) -> DataFrame:
    """``docs`` without the rows that ``decided`` (id, a hash of the text, kept; a row per document) does not keep. Rows are told
    apart by id and hash; of rows that share both, as many stay as were kept."""
    h, n, k = fresh(docs, "__hash", "__n_drop", "__rank")
    gone = decided.groupBy("id", hash_col).agg(F.count(F.lit(1)).alias("rows"), F.sum((~F.col("kept")).cast("long")).alias(n)).filter(F.col(n) > 0)
    gone = cut_lineage(gone.select(F.col("id").alias(id_col), F.col(hash_col).alias(h), "rows", n))
    rows = docs.withColumn(h, text_hash)
    if gone.filter("rows > 1").isEmpty():  # ids and hashes tell the rows apart
        drop = maybe_broadcast(gone.select(id_col, h))
        return rows.join(drop, same(rows, drop, id_col, h), "left_anti").drop(h)
    rows = rows.withColumn(k, F.row_number().over(Window.partitionBy(id_col, h).orderBy(F.lit(0))))
    drop = gone.select(id_col, h, n)
    kept = rows.join(drop, same(rows, drop, id_col, h), "left").filter(rows[k] > F.coalesce(drop[n], F.lit(0)))
    return kept.select(*[rows[c] for c in docs.columns])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list: (node, label), label the smallest node reachable.

    Alternating large-star and small-star steps: each round links every node to the least node
    of its neighbourhood, which needs a logarithmic number of rounds. Minima are combined map-side, the join on a
    hub is one that AQE splits, and each round is cut by a reliable checkpoint."""
    e = cut_lineage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    mark = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    was = e.agg(*mark).first()
    rows = was[0]  # contraction replaces links, it adds none
    while True:
        # large star: neighbours above a node hang on the least of its neighbourhood
        n = e.union(e.select(F.col("v"), F.col("u")))
        m = n.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        big = n.join(m, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: a node and its smaller neighbours hang on the least of them
        big = cut_sized(big, rows)
        m = big.groupBy("u").agg(F.min("v").alias("m"))
        rest = big.join(m, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut_sized(rest.union(m.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), rows)
        now = e.agg(*mark).first()
        if was == now:
            break
        was = now
    roots = e.select("v").distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots.select("v", F.col("v")))
