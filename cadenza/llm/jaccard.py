"""Exact Jaccard join of documents on sets of word 5-grams, as a join in a metric space.

Jaccard distance is a metric; documents at distance <= RADIUS (similarity >= 0.75) link. Documents with equal
sets are one point. The join proceeds by regions around pivots:

1. *Thinning.* The shingles themselves, ordered by hash, act as pivots: d(x, {s}) < 1 exactly when s is in x. The
   triangle inequality turns the radius into a window: two linked documents share at least l of the first
   |x| - ceil(0.75 |x|) + l shingles of x, for every l. Windows for l = |x| / SLACK are shuffled by shingle; a document
   with fewer shared shingles than that is linked with nothing and leaves.
2. *Regions.* Among the rest, shingles are ordered by how many documents hold them, rarest first. A document belongs to the regions of its
   whole window for l = 1; shingles that no other document holds need no region. Every linked pair meets in a region.
3. *Voronoi recursion.* Each region takes one document as pivot, by hash; those of more than SMALL members take PIVOTS a turn from then on, and
   also the member nearest to the earlier pivots, which is the hub of a family of copies. Each member is compared with the region's pivots
   (linear in the region), links merge into components, and a region of one component is done. A member's home is the cell of its nearest
   pivot p; it is replicated to the cell of q if d(x, q) <= d(x, p) + 2 RADIUS, since a linked document whose home is q can be no
   farther. Cells are the regions of the next turn, as long as they are worth it (TURNS_PAY, SHRINKS).
4. *Rest.* Regions of at most SMALL members compare their pairs (at most SMALL a member). Larger ones that pivots can't split, families at
   distances of about the radius, are cut into chunks of about CHUNK members by their ring, the distance to the first pivot in
   steps of RADIUS: linked documents are in the same ring or in neighbouring ones (triangle inequality). Pairs of chunks, unless
   both are in one component, are compared by sketches, an exact bound of 512 bytes a document; the few pairs left are compared on
   their sets. Pairs of chunks with more pairs left than members are compared on a spanning forest of these first, which joins most of a family,
   and then again between what is still apart; those with many left as matrices of shingles, giving a spanning forest of their links: no pairs are rows.

Distances are computed on whole sets of 64-bit shingle hashes. Components come from rounds of star contraction
(``common.components``), nothing but counts reaches the driver, and every round is checkpointed.

Defined cases: a null, empty or blank text has the empty set and links with nothing; a text of fewer than five words is one
shingle; repeated rows are copies; null ids sort last, and a component of null ids only has a null id; an empty table gives an
empty result; other columns are ignored (``components_of``) or kept (``drop_near_copies``).
"""

from __future__ import annotations

import functools
import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from cadenza.llm.common import components, cut_sized, cut_table, drop_rows, join_counted, maybe_broadcast, swept
from cadenza.session import cut_lineage

SHINGLE = 5
PERCENT = 75
SLACK = 16
RADIUS = 1 - PERCENT / 100
#: Regions of at most so many members compare their pairs; larger ones take so many pivots a turn.
SMALL, PIVOTS = 16, 2
#: Cells replace their region if they have at most so many times its members in sum, and the largest at most that share of them.
TURNS_PAY, SHRINKS = 1.5, 0.75
#: Chunks of other regions have about so many members; sketches have so many bits; pairs of chunks with more pairs a member are dense.
CHUNK, BITS, DENSE = 256, 4096, 8
#: Distances are computed in floating point; windows are widened by so much.
EPS = 1e-9
_ROWS = 100_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    found = (text or "").encode().lower().split()  # bytes: A-Z only, and the contract's white space
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    n = min(size, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for j in range(n):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + w[j:len(w) - n + 1 + j])
    return np.unique(h)


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _window(n: int, slack: int) -> int:
    return n - -(-PERCENT * n // 100) + slack


def _long_rows(make, names):
    """Record batches of about _ROWS rows from arrays that ``make`` yields."""
    def run(batches):
        parts, rows, seen = [], 0, set()
        for b in batches:
            for arrays in make(b, seen):
                parts.append(arrays)
                rows += len(arrays[0])
                if rows >= _ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names)
                    parts, rows = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names)
    return run


def _thinned(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Points (tag, id, th, n, key, sid): size and digest of each document's set; sid is a short form of the digest. And (sid) of the sets that
    share enough of their windows with other sets to have a link. Texts are read once: a document's point goes with its set's window, under a token of its own."""
    def run(batches):
        seen = set()
        for b in batches:
            sets = [shingle_set(t.as_py()) for t in b.column("text")]
            keys = [_digest(s) for s in sets]
            sids, sizes = np.frombuffer(b"".join(k[:8] for k in keys), np.int64), np.array([len(s) for s in sets], np.int64)
            tags = b.column("tag")
            p = pa.StructArray.from_arrays([tags, b.column("id"), b.column("th"), pa.array(keys, pa.binary())], ["tag", "id", "th", "key"])
            own = _mix(tags.to_numpy().astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sids), pa.array(sizes), p], ["token", "sid", "n", "p"])
            parts, rows = [], 0
            for k, s in enumerate(sets):
                if len(s) and sids[k] not in seen:  # a task ships equal sets once
                    seen.add(sids[k])
                    w = s[:_window(len(s), max(1, len(s) // SLACK))].view(np.int64)
                    parts.append((w, np.full(len(w), sids[k]), np.full(len(w), len(s))))
                    rows += len(w)
                if parts and (rows >= _ROWS or k == len(sets) - 1):
                    yield pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)), pa.nulls(rows, p.type)], ["token", "sid", "n", "p"])
                    parts, rows = [], 0

    d = docs.select(F.monotonically_increasing_id().alias("tag"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = d.mapInArrow(run, f"token long, sid long, n long, p struct<tag:long,id:{id_type},th:long,key:binary>")
    w = Window.partitionBy("token")
    rows = rows.repartition("token").withColumn("lo", F.min("sid").over(w)).withColumn("hi", F.max("sid").over(w)).filter("lo <> hi OR p IS NOT NULL")
    # tags tell the points apart; a window that several tasks shipped counts once
    rows = rows.groupBy("token", "sid", "p").agg(F.first("n").alias("n"))
    rows = cut_table(rows.groupBy("sid", "p").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n")))
    points = rows.filter("p IS NOT NULL").select("p.tag", "p.id", "p.th", "n", "p.key", "sid")
    partner = F.ceil(F.col("n") * PERCENT / 100)  # the smallest size that a linked set can have
    return points, rows.filter(F.col("p").isNull() & (F.col("c") >= F.greatest(F.lit(1), F.floor(partner / SLACK)))).select("sid")


def _sets(docs: DataFrame, points: DataFrame, thin: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cid, key, n, s): one row per distinct set that passed the thinning, with its hashes."""
    def run(batches):
        for b in batches:
            sets = [shingle_set(t.as_py()) for t in b.column("text")]
            keys = [_digest(s) for s in sets]
            for a in range(0, len(sets), 500):
                yield pa.RecordBatch.from_arrays([pa.array(keys[a:a + 500], pa.binary()), pa.array([len(s) for s in sets[a:a + 500]], pa.int64()),
                                                  pa.array([s.tobytes() for s in sets[a:a + 500]], pa.binary())], ["key", "n", "s"])

    wanted = points.filter("n > 0").join(maybe_broadcast(thin), "sid", "left_semi").groupBy("key").agg(F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("th"))).alias("x"))
    wanted = cut_lineage(wanted.select(F.col("x.id").alias("rid"), F.col("x.th").alias("rth"), "key"))
    rep = maybe_broadcast(wanted.select("rid", "rth").distinct())
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    d = d.join(rep, d["id"].eqNullSafe(rep["rid"]) & (d["th"] == rep["rth"]), "left_semi").select("text")
    s = d.mapInArrow(run, "key binary, n long, s binary")
    s = s.groupBy("key").agg(F.first("n").alias("n"), F.first("s").alias("s"))
    return cut_lineage(s.withColumn("cid", F.monotonically_increasing_id()))  # the checkpoint fixes the ids


def _regions(sets: DataFrame) -> DataFrame:
    """(token, cid, n): the regions that each set belongs to."""
    def make(b, _):
        for cid, s in zip(b.column("cid"), b.column("s"), strict=True):
            s = np.frombuffer(s.as_py(), np.int64)
            yield s, np.full(len(s), cid.as_py())

    rows = sets.select("cid", "s").mapInArrow(_long_rows(make, ["token", "cid"]), "token long, cid long").repartition("token")
    rows = rows.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter("df > 1")
    held = rows.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))
    held = held.join(sets.select("cid", "n"), "cid")
    alone = F.col("n") - F.size("t")
    window = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    held = held.withColumn("take", (window - alone).cast("int")).filter("take > 0")
    return cut_lineage(held.select("cid", "n", F.explode(F.slice("t", 1, F.col("take"))["token"]).alias("token")))


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, both, n_a, n_b) for pairs (a, b) of set ids: the size of the intersection, on whole sets. A pivot of very many
    pairs is a skewed key of a sort-merge join, which AQE splits."""
    def run(batches):
        for batch in batches:
            both = [len(np.intersect1d(np.frombuffer(x.as_py(), np.int64), np.frombuffer(y.as_py(), np.int64), assume_unique=True))
                    for x, y in zip(batch.column("s_a"), batch.column("s_b"), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "n_a", "n_b")), pa.array(both, pa.int64())], ["a", "b", "n_a", "n_b", "both"])

    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("cid").alias(side), F.col("n").alias(f"n_{side}"), F.col("s").alias(f"s_{side}")), side)
    return cut_lineage(pairs.mapInArrow(run, "a long, b long, n_a long, n_b long, both long"))


def _linked(compared: DataFrame) -> DataFrame:
    union = F.col("n_a") + F.col("n_b") - F.col("both")
    return compared.filter(100 * F.col("both") >= PERCENT * union).select("a", "b")


def _merged(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """(node, label) after more links; ``labels`` has the nodes that had links before."""
    if labels is None:
        return cut_lineage(components(edges))
    for side in ("a", "b"):  # links between components
        edges = edges.join(labels.select(F.col("node").alias(side), F.col("label").alias(f"l_{side}")), side, "left").withColumn(f"l_{side}", F.coalesce(f"l_{side}", side))
    edges = cut_lineage(edges)
    top = components(edges.select(F.col("l_a").alias("a"), F.col("l_b").alias("b"))).select(F.col("node").alias("label"), F.col("label").alias("top"))
    new = edges.select(F.col("a").alias("node"), F.col("l_a").alias("label")).union(edges.select("b", "l_b")).distinct()
    nodes = labels.union(new.join(labels, "node", "left_anti"))
    return cut_lineage(nodes.join(top, "label", "left").select("node", F.coalesce("top", "label").alias("label")))


def _similar_sizes(a, b) -> Column:
    """Linked sets are of similar sizes."""
    a, b = F.col(a), F.col(b)
    return (a * 100 >= b * PERCENT) & (b * 100 >= a * PERCENT)


def _relabelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("label", F.col("cid"))
    return members.join(labels.select(F.col("node").alias("cid"), "label"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))


def _choose(members: DataFrame, turn: int) -> DataFrame:
    """(region, pivot): PIVOTS members of each region by hash (one in turn 0), and the one nearest to the earlier pivots. One hash orders the
    members of all regions, so that regions with the same members have the same pivots, and a pair is compared once."""
    order = F.struct(F.xxhash64("cid", F.lit(turn)).alias("h"), F.col("cid").alias("cid"))
    slot = F.pmod(F.xxhash64("cid", F.lit(-1 - turn)), F.lit(PIVOTS if turn else 1))
    by = members.groupBy("region", slot.alias("slot")).agg(F.min(order)["cid"].alias("cid"), F.min(F.when(F.col("near").isNotNull(), F.struct("near", "cid"))).alias("hub"))
    g = by.groupBy("region").agg(F.collect_list("cid").alias("c"), F.min("hub")["cid"].alias("hub"))
    return g.select("region", F.explode(F.array_distinct(F.when(F.col("hub").isNull(), F.col("c")).otherwise(F.concat(F.array("hub"), "c")))).alias("pivot"))


def _spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links between numbered nodes make a spanning forest."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[rx] = ry
            out.append(k)
    return np.array(out, np.int64)


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of links between numbered nodes."""
    tree = _spanning(a, b)
    return list(zip(a[tree].tolist(), b[tree].tolist(), strict=True))


def _incidence(sets: list[np.ndarray], tokens: np.ndarray) -> np.ndarray:
    """0/1 matrix of sets x tokens (ascending)."""
    m = np.zeros((len(sets), len(tokens)), np.float32)
    for k, s in enumerate(sets):
        at = np.searchsorted(tokens, s)
        inside = at < len(tokens)
        at, s = at[inside], s[inside]
        m[k, at[tokens[at] == s]] = 1.0
    return m


def chunk_links(x: list[np.ndarray], y: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Whether each set of x links with each of y: intersections as products of incidence matrices over the shared tokens, some columns at a time."""
    shared = np.intersect1d(np.concatenate(x), np.concatenate(y)) if x and y else np.empty(0, np.int64)
    both = np.zeros((len(x), len(y)), np.float64)
    for a in range(0, len(shared), columns):
        part = shared[a:a + columns]
        both += _incidence(x, part) @ _incidence(y, part).T
    union = np.array([len(s) for s in x])[:, None] + np.array([len(s) for s in y])[None, :] - both
    return 100 * both >= PERCENT * union


def sketch(s: np.ndarray) -> bytes:
    """BITS bits, one set per shingle by its hash. A bit that only x has stands for a shingle that only x has, so the bits bound
    |x - y| and |y - x| from below."""
    bits = np.zeros(BITS, np.uint8)
    bits[(s.view(np.uint64) >> np.uint64(20)).astype(np.int64) % BITS] = 1
    return np.packbits(bits).tobytes()


def may_link(x: list[bytes], nx: np.ndarray, y: list[bytes], ny: np.ndarray) -> np.ndarray:
    """Whether sketches and sizes leave room for a link: x and y link only if they share PERCENT / (100 + PERCENT) of their sizes' sum."""
    bx, by = (np.unpackbits(np.frombuffer(b"".join(v), np.uint8).reshape(len(v), -1), axis=1).astype(np.float32) for v in (x, y))
    both = bx @ by.T
    least = -(-PERCENT * (nx[:, None] + ny[None, :]) // (100 + PERCENT))
    return (bx.sum(axis=1)[:, None] - both <= nx[:, None] - least) & (by.sum(axis=1)[None, :] - both <= ny[None, :] - least)


def _sketches(sets: DataFrame) -> DataFrame:
    """(cid, k): the sketch of each set."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("cid"), pa.array([sketch(np.frombuffer(x.as_py(), np.int64)) for x in b.column("s")], pa.binary())], ["cid", "k"])

    return cut_table(sets.select("cid", "s").mapInArrow(run, "cid long, k binary"))


PLACE = ("region", "ring", "part")


def _packed(members: DataFrame, payload: DataFrame) -> DataFrame:
    """A row per chunk: its place, its members with what ``payload`` (cid, and a binary) has of them, and the bounds of their labels."""
    what = payload.columns[1]
    m = members.join(payload, "cid")
    return cut_table(m.groupBy(*PLACE).agg(F.collect_list(F.struct("cid", "label", "n", F.col(what).alias("v"))).alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi")))


def _with_members(pairs: DataFrame, packed: DataFrame) -> DataFrame:
    for s in "xy":
        pairs = pairs.join(packed.select("region", F.col("ring").alias(f"ring_{s}"), F.col("part").alias(f"part_{s}"), F.col("m").alias(f"m_{s}")), ["region", f"ring_{s}", f"part_{s}"])
    return pairs


def _chunks_of(pairs: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, [pairs.select("region", F.col(f"ring_{s}").alias("ring"), F.col(f"part_{s}").alias("part")) for s in "xy"]).distinct()


def _left(pairs: DataFrame, packed: DataFrame, sets: DataFrame, most: int, forest: bool) -> tuple[DataFrame, DataFrame | None]:
    """(a, b): links among the pairs that sketches leave between different labels, and the pairs of chunks with more than ``most`` such pairs a
    member, if any: of these, only a spanning forest is compared, or nothing without ``forest``."""
    place = ["region", "ring_x", "part_x", "ring_y", "part_y"]

    def left(batches):
        for b in batches:
            at = [b.column(c).to_pylist() for c in place]
            for k, (mx, my) in enumerate(zip(b.column("m_x"), b.column("m_y"), strict=True)):
                (cx, lx, nx, vx), (cy, ly, ny, vy) = (_members(v) for v in (mx, my))
                i, j = np.nonzero(may_link(vx, nx, vy, ny) & (lx[:, None] != ly[None, :]))
                if len(i) > most * (len(cx) + len(cy)):
                    yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64())] * 2 + [pa.array([c[k]], pa.int64()) for c in at], ["a", "b", *place])
                    tree = _spanning(lx[i], ly[j]) if forest else np.empty(0, np.int64)
                    i, j = i[tree], j[tree]
                if len(i):
                    none = pa.nulls(len(i), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(cx[i], cy[j])), pa.array(np.maximum(cx[i], cy[j])), *[none] * 5], ["a", "b", *place])

    found = cut_table(_with_members(pairs, packed).select(*place, "m_x", "m_y").mapInArrow(left, ", ".join(f"{c} long" for c in ("a", "b", *place))))
    links = _linked(_compared(found.filter("a IS NOT NULL").select("a", "b").distinct(), sets))
    many = found.filter("a IS NULL").select(*place)
    return links, None if many.isEmpty() else many


def _grid(members: DataFrame, sets: DataFrame, sketches: DataFrame) -> DataFrame:
    """(a, b): links that connect what has links in regions that pivots can't split. ``members``: region, cid, n, label, ring, rows (of the region).

    Pairs of chunks are first compared by sketches. Where these leave at most as many pairs as there are members, the pairs are compared on
    their sets; where they leave more, a spanning forest of them is, and its links merge the labels. Then the latter pairs of chunks are compared
    once more: what is left between different labels is compared on its sets, or, where that is more than DENSE pairs a member, the pair
    of chunks is compared as a whole on its sets and gives a spanning forest."""
    chunks = F.greatest(F.lit(1), F.ceil(F.col("rows") / CHUNK)).cast("long")
    m = cut_table(members.withColumn("part", F.pmod(F.xxhash64("cid"), chunks)).select("cid", "n", "label", *PLACE))
    packed = _packed(m, sketches)
    heads = packed.select(*PLACE, "lo", "hi")
    x, y = (heads.select("region", *[F.col(c).alias(f"{c}_{s}") for c in ("ring", "part", "lo", "hi")]) for s in "xy")
    near = (F.col("ring_y") - F.col("ring_x")).between(0, 1)
    order = (F.col("ring_x") < F.col("ring_y")) | (F.col("part_x") <= F.col("part_y"))
    one = (F.col("lo_x") == F.col("hi_x")) & (F.col("lo_y") == F.col("hi_y")) & (F.col("lo_x") == F.col("lo_y"))
    pairs = x.join(y, "region").filter(near & order & ~one)  # chunks, not members: their number goes down with the square of CHUNK
    links, again = _left(pairs, packed, sets, 1, forest=True)
    if again is None:
        return links
    m = _relabelled(m.drop("label"), _merged(m.select(F.col("cid").alias("node"), "label").distinct(), links)) if not links.isEmpty() else m
    m = cut_table(m.join(_chunks_of(again), list(PLACE), "left_semi"))
    packed = _packed(m, sketches)
    more, dense = _left(again, packed, sets, DENSE, forest=False)
    links = links.unionByName(more)
    if dense is None:
        return links

    def run(batches):
        for b in batches:
            for mx, my in zip(b.column("m_x"), b.column("m_y"), strict=True):
                (cx, lx, _, vx), (cy, ly, _, vy) = (_members(v) for v in (mx, my))
                i, j = np.nonzero(chunk_links(*([np.frombuffer(s, np.int64) for s in v] for v in (vx, vy))) & (lx[:, None] != ly[None, :]))
                edges = _forest(cx[i], cy[j])
                if edges:
                    yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], ["a", "b"])

    whole = _packed(m.join(_chunks_of(dense), list(PLACE), "left_semi"), sets.select("cid", "s"))
    return links.unionByName(cut_table(_with_members(dense, whole).select("m_x", "m_y").mapInArrow(run, "a long, b long")))


def _members(v) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """A chunk's ids, labels, sizes, and what else it has of its members."""
    v = v.values
    return *(v.field(c).to_numpy(zero_copy_only=False) for c in ("cid", "label", "n")), v.field("v").to_pylist()


def labelled(sets: DataFrame) -> DataFrame:
    """(node, label) of the components of the full join, for the sets that have links."""
    home = _regions(sets)
    total = home.count()
    sketches = functools.cache(lambda: _sketches(sets))
    members = home.withColumnRenamed("token", "region").withColumn("near", F.lit(None).cast("double"))
    labels, turn = None, 0
    while True:
        members = cut_sized(_relabelled(members, labels), total)
        sizes = members.groupBy("region").agg(F.count(F.lit(1)).alias("rows"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
        sizes = cut_sized(sizes.select("region", "rows"), total)
        many = sizes
        if turn:  # small regions: all pairs of similar sizes and different components
            few = join_counted(members, sizes.filter(F.col("rows") <= SMALL), ["region"], "rows").select("region", "cid", "n", "label")
            x, y = (few.select("region", *[F.col(c).alias(f"{c}_{s}") for c in ("cid", "n", "label")]) for s in ("a", "b"))
            pairs = x.join(y, "region").filter((F.col("cid_a") < F.col("cid_b")) & (F.col("label_a") != F.col("label_b")) & _similar_sizes("n_a", "n_b"))
            pairs = cut_sized(pairs.select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b")).distinct(), SMALL * total)
            if not pairs.isEmpty():
                labels = _merged(labels, _linked(_compared(pairs, sets)))
            many = sizes.filter(F.col("rows") > SMALL)
        if many.isEmpty():
            break
        big = _relabelled(join_counted(members.drop("label"), many, ["region"], "rows"), labels)
        pivots = _choose(big, turn).join(sets.select(F.col("cid").alias("pivot"), F.col("n").alias("pn")), "pivot")
        big = cut_sized(big.join(pivots, "region"), (PIVOTS + 1) * total)
        # turn 0 only looks for links, which sets of other sizes don't have
        pairs = big.filter("cid <> pivot").filter(_similar_sizes("n", "pn") if not turn else F.lit(True))
        got = _compared(pairs.select(F.col("cid").alias("a"), F.col("pivot").alias("b")).distinct(), sets)
        links = cut_sized(_linked(got), (PIVOTS + 1) * total)
        if not links.isEmpty():
            labels = _merged(labels, links)
        d = 1 - F.col("both") / (F.col("n_a") + F.col("n_b") - F.col("both"))
        one = big.join(got.select(F.col("a").alias("cid"), F.col("b").alias("pivot"), d.alias("d")), ["cid", "pivot"], "left")
        if not turn:
            members, turn = one.select("region", "cid", "n", F.col("d").alias("near")), 1
            continue
        # cells: the nearest pivot's, and those of pivots within the window
        one = one.withColumn("d", F.when(F.col("cid") == F.col("pivot"), 0.0).otherwise(F.col("d")))
        cells = one.groupBy("region", "cid", "n", "rows").agg(
            F.min("d").alias("least"), F.coalesce(F.avg(F.when(F.col("cid") != F.col("pivot"), F.col("d"))), F.lit(1.0)).alias("near"),
            F.collect_list(F.struct("pivot", "d")).alias("p"), F.min(F.struct("pivot", "d"))["d"].alias("first"))
        cells = cells.withColumn("p", F.filter("p", lambda v: v["d"] <= F.col("least") + 2 * RADIUS + EPS))
        cells = cut_sized(_relabelled(cells, labels), total)
        shape = cells.groupBy("region").agg(F.first("rows").alias("rows"), F.sum(F.size("p")).alias("copies"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        largest = cells.select("region", F.explode("p.pivot").alias("pivot")).groupBy("region", "pivot").count().groupBy("region").agg(F.max("count").alias("largest"))
        pays = (F.col("copies") <= TURNS_PAY * F.col("rows")) & (F.col("largest") <= SHRINKS * F.col("rows"))
        shape = cut_sized(shape.filter("lo < hi").join(largest, "region").select("region", "rows", pays.alias("pays")), total)
        if shape.isEmpty():
            break
        live = join_counted(cells.drop("rows"), shape, ["region"], "rows")
        # a region without a worthwhile split is compared in chunks
        if not shape.filter("NOT pays").isEmpty():
            stuck = live.filter("NOT pays").select("region", "cid", "n", "label", F.floor(F.col("first") / (RADIUS + EPS)).alias("ring"), "rows")
            forest = _grid(stuck, sets, sketches())
            if not forest.isEmpty():
                labels = _merged(labels, forest)
        split = live.filter("pays").select(F.col("region").alias("old"), "cid", "n", "near", F.explode("p.pivot").alias("pivot"))
        members = split.select(F.xxhash64("old", "pivot", F.lit(turn)).alias("region"), "cid", "n", "near")
        if shape.filter("pays").isEmpty():
            break
        turn += 1
    return labels if labels is not None else home.select(F.col("cid").alias("node"), F.col("cid").alias("label")).limit(0)


def components_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, th (hash of the text), n_shingles, component_id (smallest id reachable by links), kept
    (whether the document is the one of its component that stays: the smallest id, first of repeated rows)."""
    with swept(docs.sparkSession):
        points, thin = _thinned(docs, id_col, text_col)
        sets = _sets(docs, points, thin, id_col, text_col)
        labels = labelled(sets)
        first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("tag").alias("tag"))).alias("first")
        classes = cut_lineage(points.filter("n > 0").groupBy("key").agg(first, F.count(F.lit(1)).alias("rows")))
        of = labels.join(sets.select(F.col("cid").alias("node"), "key"), "node").select("key", "label")
        of = cut_lineage(of.join(classes, "key"))  # every set with links, with its class
        least = of.groupBy("label").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("sets"))
        of = cut_lineage(join_counted(of.select("key", "label"), cut_lineage(least), ["label"], "sets").select("key", "least"))
        classes = classes.join(of, "key", "left").select("key", "rows", F.coalesce("least", "first").alias("first"))
        full = join_counted(points.filter("n > 0"), cut_lineage(classes), ["key"], "rows")
    full = full.select("id", "th", "n", F.col("first.id").alias("component_id"), (F.col("first.tag") == F.col("tag")).alias("kept"))
    empty = points.filter("n = 0").select("id", "th", "n", F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    return full.unionByName(empty).withColumnRenamed("n", "n_shingles")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: one of each component."""
    return drop_rows(docs, components_of(docs, id_col, text_col), F.xxhash64(text_col), id_col, "th")
