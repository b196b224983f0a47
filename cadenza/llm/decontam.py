"""Benchmark decontamination: windows of 10 words against a broadcast hash set.

Words are lower-cased (A-Z) contract words. Every window of WINDOW consecutive benchmark words is
hashed; an item with fewer words is one window of its own length. Each document's word windows
are hashed in one expression, exploded and joined with the broadcast set in the same stage, and
only hits leave it; each hit is verified by comparing the words themselves. The set is broadcast
only if it has at most BROADCAST_ROWS windows, else the windows are shuffled by their hash.

A document is named by its id and the hash of its text, so repeated rows get equal results and a
hot text is spread by its ids. Defined cases: a null text has no words, n_words 0, not contaminated;
null ids are compared null-safely; an item without words is never found; empty tables give no hits;
other columns are ignored (``hits``, ``report``) or kept (``decontaminate``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cadenza.llm.common import RAW_WORD, fresh, let, same, small, words
from cadenza.session import cut_lineage

WINDOW = 10


def _window_hashes(h: Column, n: int) -> Column:
    """Hashes of the windows of n word hashes (none if there are fewer words)."""
    one = F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[h[i + j] for j in range(n)]))
    return F.when(F.size(h) >= n, one).otherwise(F.expr("cast(array() as array<bigint>)"))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(width, hash, gram, items): the distinct windows and the items that hold them."""
    b = benchmark.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("w")).filter("size(w) > 0")
    b = b.withColumn("width", F.least(F.size("w"), F.lit(window)))
    g = b.select("item", "width", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - F.col("width") + 1), lambda i: F.slice("w", i, F.col("width")))).alias("gram"))
    g = g.groupBy("width", "gram").agg(F.collect_set("item").alias("items"))
    per_width = reduce(lambda acc, k: F.when(F.col("width") == k, F.xxhash64(*[F.xxhash64(F.col("gram")[j]) for j in range(k)])).otherwise(acc),
                       range(1, window + 1), F.lit(None).cast("long"))
    return cut_lineage(g.select("width", per_width.alias("hash"), "gram", "items"))


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, every: bool = False) -> DataFrame:
    """Verified occurrences: (id, th, n_words, start, end, items), positions in words, end exclusive; th is the text's hash.
    ``every``: also a row per document with null start, end and items."""
    grams = benchmark_windows(benchmark, item_col, item_text, window)
    widths = sorted(r[0] for r in grams.select("width").distinct().collect()) or [window]  # at most `window` numbers
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"),
                    let(words(F.col(text_col)), lambda w: let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.struct(
                        w.alias("w"), F.concat(*[_window_hashes(h, k) for k in widths]).alias("hs")))).alias("x"))
    ends = F.array(F.lit(None).cast("bigint")) if every else F.expr("cast(array() as array<bigint>)")
    d = d.select("id", "th", F.col("x.w").alias("w"), F.concat("x.hs", ends).alias("hs"))
    d = d.select("id", "th", "w", F.posexplode("hs").alias("at", "hash"))
    at = F.col("at")
    start, width, before = at, F.lit(widths[0]), F.lit(0)
    for shorter, k in zip(widths, widths[1:], strict=False):  # the windows of each width follow one another
        before = before + F.greatest(F.size("w") - shorter + 1, F.lit(0))
        start, width = F.when(at >= before, at - before).otherwise(start), F.when(at >= before, F.lit(k)).otherwise(width)
    at_place = {"start": start, "width": width, "n_words": F.size("w").cast("long")}
    if small(grams):
        j = d.join(F.broadcast(grams.withColumnRenamed("width", "gw")), "hash", "left") if every else d.join(F.broadcast(grams.withColumnRenamed("width", "gw")), "hash")
        j = j.filter(F.col("gw").isNotNull() | F.col("hash").isNull()).withColumns(at_place)
        j = j.filter(F.col("hash").isNull() | (F.col("width") == F.col("gw")) & (F.slice("w", F.col("start") + 1, F.col("width")) == F.col("gram")))
    else:
        d = d.withColumns(at_place)
        d = d.select("id", "th", "n_words", "hash", "start", "width", F.when(F.col("hash").isNotNull(), F.slice("w", F.col("start") + 1, F.col("width"))).alias("gram"))
        j = d.filter("hash is not null").join(grams, ["width", "hash", "gram"])
        if every:
            j = j.unionByName(d.filter("hash is null"), allowMissingColumns=True)
    start = F.when(F.col("hash").isNotNull(), F.col("start"))
    return j.select("id", "th", "n_words", start.alias("start"), (start + F.col("width")).alias("end"), "items")


def report(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """One row per document: id, n_words, n_hit (words covered), items (sorted ids as texts), contaminated. One read of the texts: the windows
    that hit and one row per document are shuffled by document."""
    h = hits(docs, benchmark, every=True, **names).repartition("id", "th")
    h = h.groupBy("id", "th", "start").agg(F.max("end").alias("end"), F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("rows"),
                                           F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    w = Window.partitionBy("id", "th").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    h = h.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(w), F.lit(0)))))
    none = F.expr("cast(array() as array<string>)")
    items = F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_set("items"))), lambda x: x.cast("string")))
    g = h.groupBy("id", "th").agg(F.max("n_words").alias("n_words"), F.sum(F.when(F.col("start").isNull(), 0).otherwise(F.col("new"))).cast("long").alias("n_hit"),
                                  F.coalesce(items, none).alias("items"), F.max(F.when(F.col("start").isNull(), F.col("rows"))).alias("rows"))
    g = g.select("id", "n_words", "n_hit", "items", (F.col("n_hit") > 0).alias("contaminated"), F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("copy"))
    return g.drop("copy")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  remove: str = "documents", **names) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove='spans'``) with the covered words cut out
    of their texts: from the first to the last character of each maximal run of hit words."""
    th, = fresh(docs, "__th")
    rows = docs.withColumn(th, F.xxhash64(text_col))
    if remove == "documents":
        found = cut_lineage(hits(docs, benchmark, id_col, text_col, **names).select(F.col("id").alias(id_col), F.col("th").alias(th)).distinct())
        found = F.broadcast(found) if small(found) else found
        return rows.join(found, same(rows, found, id_col, th), "left_anti").drop(th)
    runs, = fresh(docs, "__runs")
    h = hits(docs, benchmark, id_col, text_col, **names).select("id", "th", F.explode(F.sequence("start", F.col("end") - 1)).alias("k"))
    h = cut_lineage(h.groupBy("id", "th").agg(F.collect_set("k").alias(runs)).select(F.col("id").alias(id_col), F.col("th").alias(th), runs))
    j = rows.join(h, same(rows, h, id_col, th), "left")
    text = rows[text_col]
    parts = F.zip_with(F.split(text, RAW_WORD, -1), F.concat(F.regexp_extract_all(text, F.lit(RAW_WORD), F.lit(0)), F.array(F.lit(""))),
                       lambda gap, word: F.struct(gap.alias("gap"), word.alias("word")))
    cut = let(parts, lambda p: F.array_join(F.transform(p, lambda x, i: F.when(
        F.array_contains(runs, i), F.when(F.array_contains(runs, i - 1), F.lit("")).otherwise(x["gap"])).otherwise(F.concat(x["gap"], x["word"]))), ""))
    return j.select(*[F.when(F.col(runs).isNull(), text).otherwise(cut).alias(c) if c == text_col else rows[c].alias(c) for c in docs.columns])
