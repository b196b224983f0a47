"""Removal of repeated byte strings by suffix arrays.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else. All strings are judged on the input.

1. Documents with equal texts are copies: every byte of a copied text of at least LENGTH bytes goes, and one of the copies
   stands for them in what follows.
2. Every window of LENGTH bytes has an anchor: the place of its least GRAM-byte hash, the leftmost of equals. Equal windows have equal
   anchors at equal offsets. Consecutive windows with the same anchor form a run (about 2/LENGTH runs a byte). Runs are shuffled
   by the anchor's hash with a hash of their bytes; a hash that occurs once is dropped. Runs with equal bytes match in
   all their windows, and one of them goes on.
3. Where a hash still has different runs, the bytes of these runs are fetched and sorted by anchor hash. Each task builds suffix
   arrays of about CHUNK_BYTES by two-stage sorting: only suffixes smaller than their successors are sorted
   directly, the others are induced by scanning the buckets; then common prefixes of neighbours are compared, and
   windows with a common prefix of LENGTH are matched. A hash with more than GROUP_RUNS different runs would be too much for one
   task: its windows are matched by 128-bit hashes in a shuffle instead.

Defined cases: a null text is empty and keeps its null id; texts shorter than LENGTH lose nothing; matches within one document count;
repeated rows are copies; null ids are compared null-safely; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from cadenza.llm.common import cut_table, drop_rows, join_counted, same, small
from cadenza.session import cut_lineage

LENGTH = 200
GRAM = 16
CHUNK_BYTES = 1 << 20
GROUP_RUNS = 4096
#: Bytes of one text that are searched for anchors at once; pieces overlap so that no window is lost.
PIECE = 1 << 20
_POS_BITS = np.uint64(21)


def _words(t: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, big-endian (zeros after the end)."""
    p = np.concatenate((t, np.zeros(8, np.uint8))).astype(np.uint64)
    out = np.zeros(len(t), np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | p[j:j + len(t)]
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _window_min(v: np.ndarray, k: int) -> np.ndarray:
    """Least value of each k consecutive ones, by prefix and suffix minima of blocks."""
    n = len(v) - k + 1
    pad = np.concatenate((v, np.full(-len(v) % k, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, k)
    pre = np.minimum.accumulate(pad, axis=1).ravel()
    suf = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suf[:n], pre[k - 1:k - 1 + n])


def runs(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the anchor, first start, last start) of the runs of a text."""
    parts = []
    for a in range(0, max(0, len(text) - length + 1), PIECE):
        t = np.frombuffer(text[a:a + PIECE + length - 1], np.uint8)
        w = _words(t)
        n = len(t) - GRAM + 1
        h = _mix(_mix(w[:n]) + w[8:8 + n] * np.uint64(0x9E3779B97F4A7C15))
        v = (h & ~((np.uint64(1) << _POS_BITS) - np.uint64(1))) | np.arange(n, dtype=np.uint64)
        at = (_window_min(v, length - GRAM + 1) & ((np.uint64(1) << _POS_BITS) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        parts.append((h[at[first]].view(np.int64), first + a, np.append(first[1:] - 1, len(at) - 1) + a))
    if not parts:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def suffix_order(t: np.ndarray, depth: int = LENGTH, need: np.ndarray | None = None) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes at least, by two-stage sorting. ``need`` marks those that are wanted; the
    result has them and the ones that they are induced from."""
    n = len(t)
    step = np.diff(t.astype(np.int16))
    decided = np.where(np.append(step != 0, True), np.arange(n), n)  # where a run of equal bytes ends
    ends = np.minimum.accumulate(decided[::-1])[::-1]
    smaller = np.append(step > 0, False)[ends]  # suffixes smaller than their successors; the last one is not
    if need is None:
        need = np.ones(n, bool)
    else:  # a larger suffix needs its successors up to the next smaller one
        at = np.flatnonzero(need)
        sure = np.minimum.accumulate(np.where(smaller, np.arange(n), n - 1)[::-1])[::-1]
        need = np.cumsum(np.bincount(at, minlength=n + 1) - np.bincount(sure[at] + 1, minlength=n + 1))[:n] > 0
    order = _direct(t, np.flatnonzero(smaller & need), depth)
    firsts = t[order]
    s_cut = np.searchsorted(firsts, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if need[-1]:
        waiting[t[-1]].append(np.array([n - 1]))  # follows the empty suffix
    out = []

    def hand_on(done):
        """Larger predecessors of sorted suffixes, in the same order, to their own buckets."""
        before = done[done > 0] - 1
        before = before[~smaller[before] & need[before]]
        if not len(before):
            return
        c = t[before]
        by = np.argsort(c, kind="stable")
        before, c = before[by], c[by]
        cuts = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
        for a, b in zip(cuts, [*cuts[1:], len(c)], strict=True):
            waiting[c[a]].append(before[a:b])

    for c in range(256):
        k = 0
        while k < len(waiting[c]):  # those that equal bytes induce in their own bucket come in turn
            part = waiting[c][k]
            out.append(part)
            hand_on(part)
            k += 1
        part = order[s_cut[c]:s_cut[c + 1]]
        if len(part):
            out.append(part)
            hand_on(part)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _direct(t: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``at`` sorted by their next ``depth`` bytes: eight, then four at a time, only where there are ties; ties of equal strings end early."""
    n, w = len(t), _words(t)
    power = np.cumprod(np.full(n + 1, 0x9E3779B97F4A7C15, np.uint64))
    prefix = np.concatenate(([np.uint64(0)], np.cumsum((t.astype(np.uint64) + np.uint64(1)) * power[1:])))
    inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    whole = (prefix[np.minimum(np.arange(n) + depth, n)] - prefix[:n]) * np.cumprod(np.full(n, inverse, np.uint64))
    order = at[np.argsort(w[at])]
    todo = np.arange(len(order))  # places whose order isn't settled
    group = np.cumsum(np.concatenate(([True], w[order][1:] != w[order][:-1]))) if len(order) else np.empty(0, np.int64)
    for r in range(8, depth, 4):
        # keep only groups that hold different strings
        cut = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.empty(0, np.int64)
        if not len(cut):
            break
        h = whole[order[todo]]
        mixed = np.maximum.reduceat(h, cut) != np.minimum.reduceat(h, cut)
        keep = np.repeat(mixed, np.diff(np.append(cut, len(group))))
        todo, group = todo[keep], group[keep]
        if not len(todo):
            break
        pos = order[todo]
        key = np.where(pos + r < n, w[np.minimum(pos + r, n - 1)], np.uint64(0)) >> np.uint64(32)
        key |= group.astype(np.uint64) << np.uint64(32)
        by = np.argsort(key)
        order[todo] = pos[by]
        key = key[by]
        group = np.cumsum(np.concatenate(([True], key[1:] != key[:-1])))
    return order


def matched_starts(fragments: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each fragment, whether the window from each of its starts also starts elsewhere in the fragments."""
    t = np.frombuffer(b"".join(fragments), np.uint8)
    sizes = np.array([len(f) for f in fragments])
    begin = np.cumsum(sizes) - sizes
    valid = np.zeros(len(t), bool)
    for b, s in zip(begin, sizes, strict=True):
        valid[b:b + s - length + 1] = True
    order = suffix_order(t, length, valid)
    order = order[valid[order]]
    w = _words(t)
    alike = np.arange(len(order) - 1)  # neighbours with a common prefix so far
    for r in [*range(0, length - 8, 8), length - 8]:
        alike = alike[w[order[alike] + r] == w[order[alike + 1] + r]]
    hit = np.zeros(len(t), bool)
    hit[order[alike]] = hit[order[alike + 1]] = True
    return [hit[b:b + s - length + 1] for b, s in zip(begin, sizes, strict=True)]


def _intervals(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _batch(rows, kinds, names):
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _all_runs(texts: DataFrame, id_type: str) -> DataFrame:
    """(h, fh, id, th, lo, hi): the runs of every text; fh is a hash of the run's bytes."""
    def run(batches):
        for b in batches:
            out, rows = [], 0
            for i in range(b.num_rows):
                t = b.column("t")[i].as_py()
                h, lo, hi = runs(t)
                if len(h):
                    fh = np.array([xxhash.xxh3_64_intdigest(t[x:y + LENGTH]) for x, y in zip(lo.tolist(), hi.tolist(), strict=True)], np.uint64).view(np.int64)
                    out.append((h, fh, np.full(len(h), i), lo, hi))
                    rows += len(h)
                if rows >= 50_000 or out and i == b.num_rows - 1:
                    h, fh, doc, lo, hi = (np.concatenate(x) for x in zip(*out, strict=True))
                    doc = pa.array(doc)
                    yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(fh), b.column("id").take(doc), b.column("th").take(doc), pa.array(lo), pa.array(hi)],
                                                     ["h", "fh", "id", "th", "lo", "hi"])
                    out, rows = [], 0

    return texts.mapInArrow(run, f"h long, fh long, id {id_type}, th long, lo long, hi long")


def _fetch(texts: DataFrame, wanted: DataFrame, id_type: str) -> DataFrame:
    """(h, k, id, th, lo, f): the bytes of the wanted runs."""
    lists = cut_table(wanted.groupBy("id", "th").agg(F.collect_list(F.struct("h", "k", "lo", "hi")).alias("x")))
    ids, some = lists.select(F.col("id").alias("id_"), F.col("th").alias("th_")), texts
    if small(ids):  # else the texts move once, in the join with the lists
        some = texts.join(F.broadcast(ids), texts["id"].eqNullSafe(F.col("id_")) & (texts["th"] == F.col("th_")), "left_semi")
    j = some.join(lists, same(some, lists, "id", "th")).select(some["id"], some["th"], "t", "x")

    def run(batches):
        for b in batches:
            rows, size = [], 0
            for r in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                for x in r["x"]:
                    rows.append((x["h"], x["k"], r["id"], r["th"], x["lo"], r["t"][x["lo"]:x["hi"] + LENGTH]))
                    size += len(rows[-1][-1])
                if size >= CHUNK_BYTES:
                    yield _batch(rows, kinds, names)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, kinds, names)

    names = ["h", "k", "id", "th", "lo", "f"]
    kinds = [pa.int64(), pa.int64(), pa.int64() if id_type == "bigint" else None, pa.int64(), pa.int64(), pa.binary()]
    return j.mapInArrow(run, f"h long, k long, id {id_type}, th long, lo long, f binary")


def _by_suffix_arrays(fragments: DataFrame, id_type: str) -> DataFrame:
    """(id, th, lo, hi): intervals of matched starts, from suffix arrays of whole groups of fragments."""
    def run(batches):
        part, size, last = [], 0, None
        for b in batches:
            for r in (r for i in range(0, b.num_rows, 256) for r in b.slice(i, 256).to_pylist()):
                if size >= CHUNK_BYTES and r["h"] != last:
                    yield from done(part)
                    part, size = [], 0
                part.append(r)
                size += len(r["f"])
                last = r["h"]
        if part:
            yield from done(part)

    def done(part):
        rows = []
        for r, hit in zip(part, matched_starts([r["f"] for r in part]), strict=True):
            rows += [(r["id"], r["th"], r["lo"] + int(x), r["lo"] + int(y)) for x, y in zip(*_intervals(hit), strict=True)]
        if rows:
            yield _batch(rows, [pa.int64() if id_type == "bigint" else None, pa.int64(), pa.int64(), pa.int64()], ["id", "th", "lo", "hi"])

    sorted_ = fragments.select("h", "id", "th", "lo", "f").repartition("h").sortWithinPartitions("h")
    return sorted_.mapInArrow(run, f"id {id_type}, th long, lo long, hi long")


def _by_windows(fragments: DataFrame, id_type: str) -> DataFrame:
    """(id, th, lo, hi) of matched starts in groups of very many fragments, by hashes of their windows."""
    def run(batches):
        for b in batches:
            for r in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                f, n = r["f"], len(r["f"]) - LENGTH + 1
                d = np.frombuffer(b"".join(hashlib.blake2b(f[i:i + LENGTH], digest_size=16).digest() for i in range(n)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()), pa.array([r["id"]] * n), pa.array(np.full(n, r["th"])),
                                                  pa.array(r["lo"] + np.arange(n))], ["w1", "w2", "id", "th", "lo"])

    rows = fragments.select("id", "th", "lo", "f").mapInArrow(run, f"w1 long, w2 long, id {id_type}, th long, lo long")
    again = rows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return join_counted(rows, cut_lineage(again), ["w1", "w2"], "n").select("id", "th", "lo", F.col("lo").alias("hi"))


def merged(lo: np.ndarray, hi: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Intervals of starts, ascending, whose windows cover the same bytes; where windows meet, intervals become one."""
    if not len(lo):
        return lo, hi
    reach = np.maximum.accumulate(hi)
    new = np.append(True, lo[1:] > reach[:-1] + length)
    return lo[new], reach[np.append(new[1:], True)]


def _merged(lists: DataFrame, id_type: str) -> DataFrame:
    """(id, th, x): sorted lists of intervals, merged."""
    def run(batches):
        for b in batches:
            x = b.column("x")
            at, v = x.offsets.to_numpy(), x.flatten()
            low, high = (v.field(c).to_numpy(zero_copy_only=False) for c in ("lo", "hi"))
            at = at - at[0]
            parts = [merged(low[p:q], high[p:q]) for p, q in zip(at[:-1], at[1:], strict=True)]
            ends = np.cumsum([0, *[len(p[0]) for p in parts]]).astype(np.int32)
            cells = pa.StructArray.from_arrays([pa.array(np.concatenate([p[k] for p in parts]) if parts else np.empty(0, np.int64), pa.int64()) for k in (0, 1)], ["lo", "hi"])
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), pa.ListArray.from_arrays(pa.array(ends), cells)], ["id", "th", "x"])

    return lists.select("id", "th", "x").mapInArrow(run, f"id {id_type}, th long, x array<struct<lo: long, hi: long>>")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(copies, intervals): the documents (id, th) whose text another row has too, and for the others the intervals
    (id, th, lo, hi) of starts of windows that start elsewhere, too."""
    id_type = docs.schema[id_col].dataType.simpleString()
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    rows = cut_table(d.select(F.monotonically_increasing_id().alias("tag"), "id", "th", F.sha2("text", 256).alias("sha")))
    texts = rows.groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.min("tag").alias("first")).filter("n > 1")
    copied = cut_lineage(join_counted(rows, cut_lineage(texts), ["sha"], "n"))
    one = drop_rows(d, copied.select("id", "th", (F.col("tag") == F.col("first")).alias("kept")), F.col("th"), "id", "th")
    one = one.select("id", "th", F.col("text").cast("binary").alias("t"))
    every = _all_runs(one, id_type).repartition("h")
    group, equal = Window.partitionBy("h"), Window.partitionBy("h", "fh")
    every = every.withColumns({"c": F.count(F.lit(1)).over(equal), "nth": F.row_number().over(equal.orderBy(F.col("id").isNull(), "id", "th", "lo"))})
    every = every.withColumns({"total": F.count(F.lit(1)).over(group), "k": F.sum((F.col("nth") == 1).cast("long")).over(group)})
    every = cut_table(every.filter("total > 1").drop("total"))
    kinds = every.filter("nth = 1")
    equal = every.filter("c > 1").select("id", "th", "lo", "hi")
    # fragments go straight to the suffix arrays' shuffle; only those of too large groups are stored
    found = equal.unionByName(_by_suffix_arrays(_fetch(one, kinds.filter((F.col("k") > 1) & (F.col("k") <= GROUP_RUNS)), id_type), id_type))
    large = kinds.filter((F.col("k") > 1) & (F.col("k") > GROUP_RUNS))
    if not large.isEmpty():
        found = found.unionByName(_by_windows(cut_table(_fetch(one, large, id_type)), id_type))
    return copied.select("id", "th"), found


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans (maximal removed runs), spans (their starts and ends in bytes), kept (the remaining bytes)."""
    copied, found = repeated(docs, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    lists = _merged(found.groupBy("id", "th").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("x")), id_type)
    copies = copied.distinct().withColumn("x", F.expr("array(named_struct('lo', cast(0 as bigint), 'hi', cast(-1 as bigint)))"))
    lists = lists.join(copied, same(lists, copied, "id", "th"), "left_anti").unionByName(copies)
    lists = cut_table(lists.withColumnsRenamed({"id": "id_", "th": "th_"}))
    few = small(lists) and (lists.agg(F.sum(F.size("x"))).first()[0] or 0) <= 1_000_000
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    d = d.select("id", F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("t"))
    j = d.join(F.broadcast(lists) if few else lists, d["id"].eqNullSafe(F.col("id_")) & (d["th"] == F.col("th_")), "left").select("id", "t", "x")

    def run(batches):
        for b in batches:
            for r in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                t, spans = r["t"], []
                for x in r["x"] or []:
                    hi = len(t) if x["hi"] < 0 else x["hi"] + LENGTH
                    if x["hi"] < 0 and len(t) < LENGTH:
                        continue
                    if spans and x["lo"] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], hi)
                    else:
                        spans.append([x["lo"], hi])
                edges = [0, *(e for s in spans for e in s), len(t)]
                kept = b"".join(t[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array([r["id"]], b.column("id").type), pa.array([len(t)], pa.int64()), pa.array([len(t) - len(kept)], pa.int64()),
                                                  pa.array([len(spans)], pa.int64()), pa.array([spans], pa.list_(pa.list_(pa.int64()))), pa.array([kept], pa.binary())],
                                                 ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    return j.mapInArrow(run, f"id {id_type}, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept binary")
