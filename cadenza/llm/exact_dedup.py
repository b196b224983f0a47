"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when identical after each run of white space became one space. The first read
of the texts yields a count per (length, prefix hash), which is refined in two steps: lengths
that occur once drop out, then prefix hashes that occur once. The second read computes the
SHA-256 of the whole normalised text only for rows whose (length, prefix hash) survived. Counts
are combined map-side, and a group of copies is joined through ``join_counted``, so a group
with a third of all rows loads no single task.

Defined cases: a null text counts as empty; null ids sort last and are never preferred; fully
repeated rows are copies of each other, and exactly one of them stays; an empty table gives an
empty result; other columns are ignored (``decisions``) or kept as they are (``drop_copies``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cadenza.llm.common import drop_rows, join_counted, small
from cadenza.session import cut_lineage

PREFIX_CHARS = 256


def normalised(text: Column) -> Column:
    # a lone space stays as it is, so only other runs need replacing
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def _measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    t = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("t"))
    return t.withColumns({"len": F.length("t"), "pfx": F.xxhash64(F.substring("t", 1, PREFIX_CHARS))})


def surviving_prefixes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(len, pfx, n) of the prefix groups with more than one row, refined by length first."""
    counts = cut_lineage(_measured(docs, id_col, text_col).groupBy("len", "pfx").agg(F.count(F.lit(1)).alias("n")))
    lengths = counts.groupBy("len").agg(F.sum("n").alias("rows")).filter("rows > 1").select("len")
    return cut_lineage(counts.join(lengths, "len", "left_semi").filter("n > 1"))


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, digest (null for rows that were
    unique before the full hash, unless ``digest_all``)."""
    alive = surviving_prefixes(docs, id_col, text_col)
    rows = _measured(docs, id_col, text_col)
    marked = alive.withColumn("alive", F.lit(True))
    if small(alive):
        rows = rows.join(F.broadcast(marked.drop("n")), ["len", "pfx"], "left")
    else:
        rows = join_counted(rows, marked, ["len", "pfx"], "n", "left").drop("n")
    rows = rows.withColumn("alive", F.coalesce("alive", F.lit(False)))
    rows = cut_lineage(rows.select(
        F.monotonically_increasing_id().alias("tag"), "id", "len", "pfx", "alive",
        F.when(F.lit(True) if digest_all else F.col("alive"), F.sha2("t", 256)).alias("digest")))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("tag").alias("tag")))
    key = ["len", "pfx", "digest"]
    copies = cut_lineage(rows.filter("alive").groupBy(*key).agg(first.alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    hit = join_counted(rows.filter("alive"), copies, key, "n", "left")
    rest = rows.filter("not alive").withColumns({"first": F.lit(None).cast(copies.schema["first"].dataType), "n": F.lit(None).cast("long")})
    return hit.unionByName(rest).select(
        "id", F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("first.tag") == F.col("tag"))).alias("kept"), "digest")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    decided = decisions(docs, id_col, text_col).filter("digest is not null")
    return drop_rows(docs, decided, F.sha2(normalised(F.col(text_col)), 256), id_col, "digest")
