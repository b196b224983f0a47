"""Best-fit packing into sequences of several permitted lengths.

Items are documents, or for longer ones pieces of the largest permitted length and a rest, in
tokens (runs of letters and digits, and single other signs). Best fit in decreasing order needs only
how many items have each length, so a histogram of at most max(SIZES) counts is planned on the driver:
items of one length go to the open bins with the least sufficient room, and bins are ranges of
equal ones. Where no open bin has room, a new one is opened; every opening policy (prefer one of the
permitted sizes; take the least size that fits) is planned, and the plan with the least total cost,
capacity plus OVERHEAD for each sequence, after downsizing each bin to its contents, wins. The
plan (ranges, whose number depends on the permitted sizes alone) is broadcast, and each item finds its bin by its
length and its rank among the items of that length. Ranks come from windows over (length, salt)
and running offsets, so a length with a third of all items is no single task.

Defined cases: null and empty texts have no tokens and get no bin; equal items are interchangeable;
repeated rows are items of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from cadenza.session import cut_lineage

SIZES = (256, 512, 1024, 2048)
#: Cost of a sequence besides its capacity, in tokens (batch entry, padding to tiles, separators).
OVERHEAD = 32
ITEMS_PER_SALT = 20_000
#: Blanks of all scripts are no signs.
TOKEN = r"[\p{L}\p{M}\p{N}]+|[^\s\x1C-\x1F\x85\p{Z}\p{L}\p{M}\p{N}]"


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN)).cast("long")


def items(docs: DataFrame, id_col: str, tokens: Column, largest: int) -> DataFrame:
    """(id, piece, start, n): every token of every document in pieces of at most ``largest``."""
    d = docs.select(F.col(id_col).alias("id"), tokens.alias("total")).filter("total > 0")
    d = d.select("id", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / largest).cast("long"))).alias("piece"))
    start = F.col("piece") * largest
    return d.select("id", "piece", start.alias("start"), F.least(F.lit(largest).cast("long"), F.col("total") - start).alias("n"))


def best_fit(histogram: dict[int, int], sizes: tuple[int, ...], prefer: int | None) -> tuple[list[tuple], int]:
    """Best fit decreasing on counts. Returns assignments (n, rank_from, count, bin_from, per_bin, offset): item
    ``rank`` is in bin ``bin_from + (rank - rank_from) div per_bin``, slot ``mod per_bin`` from ``offset``; and the cost."""
    room: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # room left -> ranges (bin_from, bins, capacity)
    rooms: list[int] = []
    out, bins = [], 0

    def put(left, bin_from, n, cap):
        if n:
            if not room[left]:
                insort(rooms, left)
            room[left].append((bin_from, n, cap))

    for n in sorted(histogram, reverse=True):
        count, rank = histogram[n], 0
        while count:
            at = bisect_left(rooms, n)
            if at < len(rooms):
                left = rooms[at]
                bin_from, m, cap = room[left].pop()
                if not room[left]:
                    rooms.pop(at)
            else:
                cap = left = prefer if prefer and prefer >= n else min(s for s in sizes if s >= n)
                bin_from, m = bins, -(-count // (cap // n))
                bins += m
            k = left // n
            full = min(m, count // k)
            rest = min(count - full * k, k - 1) if full < m else 0
            for first, many, per in ((bin_from, full, k), (bin_from + full, 1 if rest else 0, rest)):
                if many:
                    out.append((n, rank, many * per, first, per, cap - left))
                    put(left - per * n, first, many, cap)
                    rank, count = rank + many * per, count - many * per
            put(left, bin_from + full + (1 if rest else 0), m - full - (1 if rest else 0), cap)
    cost = sum(m * (min(s for s in sizes if s >= cap - left) + OVERHEAD) for left, rs in room.items() for _, m, cap in rs)
    return out, cost


def plan(histogram: dict[int, int], sizes: tuple[int, ...] = SIZES) -> list[tuple]:
    return min((best_fit(histogram, sizes, p) for p in (None, *sizes)), key=lambda x: x[1])[0]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None,
         sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """One row per item: id, piece, start, n_tokens, bin_id, offset, used, capacity. ``tokens``: an expression for a document's
    number of tokens, if another tokeniser has counted them."""
    spark, sizes = docs.sparkSession, tuple(sorted(sizes))
    all_ = cut_lineage(items(docs, id_col, token_count(F.col(text_col)) if tokens is None else tokens, sizes[-1]))
    histogram = {r[0]: r[1] for r in all_.groupBy("n").count().collect()}  # at most sizes[-1] rows
    salts = max(1, -(-sum(histogram.values()) // ITEMS_PER_SALT))
    moves = plan(histogram, sizes)
    moves = spark.createDataFrame(pd.DataFrame(moves, columns=["n", "rank_from", "count", "bin_from", "per_bin", "offset_from"], dtype="int64"),
                                  "n long, rank_from long, count long, bin_from long, per_bin long, offset_from long")
    salted = all_.withColumn("salt", F.pmod(F.xxhash64("id", "piece"), F.lit(salts)))
    w = Window.partitionBy("n", "salt")
    ranked = salted.withColumn("k", F.row_number().over(w.orderBy("id", "piece", "start")) - 1)
    before = salted.groupBy("n", "salt").agg(F.count(F.lit(1)).alias("c"))
    before = before.withColumn("before", F.coalesce(F.sum("c").over(Window.partitionBy("n").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = ranked.join(before.select("n", "salt", "before"), ["n", "salt"]).withColumn("rank", F.col("k") + F.col("before"))
    j = ranked.join(F.broadcast(moves), (ranked["n"] == moves["n"]) & (ranked["rank"] >= moves["rank_from"]) & (ranked["rank"] < moves["rank_from"] + moves["count"]))
    nth = F.col("rank") - F.col("rank_from")
    placed = j.select("id", "piece", "start", ranked["n"].alias("n_tokens"),
                      (F.col("bin_from") + F.expr("(rank - rank_from) div per_bin")).alias("bin_id"),
                      (F.col("offset_from") + (nth % F.col("per_bin")) * ranked["n"]).alias("offset"))
    used = F.sum("n_tokens").over(Window.partitionBy("bin_id"))  # a bin holds at most sizes[-1] items
    least = F.lit(sizes[-1])
    for s in reversed(sizes[:-1]):
        least = F.when(F.col("used") <= s, F.lit(s)).otherwise(least)
    return placed.withColumn("used", used).withColumn("capacity", least.cast("long"))


def sequences(docs: DataFrame, packed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed sequences themselves: bin_id, capacity, used, doc_ids and tokens, for documents with distinct ids."""
    d = docs.select(F.col(id_col).alias("id"), F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(TOKEN), F.lit(0)).alias("t"))
    j = packed.join(d, "id").select("bin_id", "capacity", "used", F.struct("offset", "id", F.expr("slice(t, int(start) + 1, int(n_tokens))").alias("t")).alias("x"))
    g = j.groupBy("bin_id").agg(F.first("capacity").alias("capacity"), F.first("used").alias("used"), F.array_sort(F.collect_list("x")).alias("x"))
    return g.select("bin_id", "capacity", "used", F.col("x.id").alias("doc_ids"), F.flatten("x.t").alias("tokens"))
