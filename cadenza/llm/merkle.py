"""A Merkle manifest of a dataset, with proofs checked by a recursive climb.

Each row is a leaf: the SHA-256 of its columns, each as ``-`` for null, else UTF-8 byte count, ``:`` and value. Per source, leaves
ascend by id; every ARITY consecutive nodes become the SHA-256 of their digests (as hex text) until one node, the
subroot, is left (a lone leaf is its own). The subroots, ordered by source (null first, bytewise), make a last tree the same way.

``manifest`` builds the trees level by level. A built level is stored as Parquet: a row per inner node with the digests of its
children and a link to its parent (tree, level, place) and its place among the parent's children. ``prove`` climbs them by recursive
SQL: each step joins every leaf's current link to its node, appends the siblings found there as a row of the proof, folds the
leaf's digest (of the tampered text, if it is) with them and goes on to the parent. Levels of up to NODES nodes in all are broadcast,
as all leaves meet there in few nodes; below, a node has few leaves, and the join is a shuffle. A proof is put together from its rows
at the end, so that a step moves rows of one size, not ever longer proofs.

Texts are read once and never shuffled: ranks come from a distributed sort of digests, and the sizes of sources are joined by
``join_counted``, so that a source with a third of all rows loads no single task. The driver sees counts and the root only.

Defined cases: null ids come first in their source and are not tampered with; rows with equal ids are ordered by digest; repeated
rows are leaves of their own; an empty table has no leaves and no root; columns other than COLUMNS don't count, whatever their names.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cadenza.llm.common import cut_table, join_counted
from cadenza.plans.ordering import global_rank
from cadenza.session import cut_lineage, ensure_checkpoint_dir

ARITY = 3
#: Levels with at most so many nodes in all are broadcast in the climb (about 120 bytes a node, so a megabyte).
NODES = 10_000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree over the subroots.
TOP = -1
NODE = "tree long, level int, place long, p_tree long, p_level int, p_place long, p_nth int, children array<binary>"


def part(value: Column) -> Column:
    v = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def text_of(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def folded(children: Column) -> Column:
    """The digest of a node from those of its children."""
    return F.unhex(F.sha2(F.array_join(F.transform(children, text_of), ""), 256))


def tampered_text(id_: Column, text: Column) -> Column:
    """The text without newlines where the CRC-32 of the id is even, else the text itself."""
    hit = F.coalesce(F.crc32(id_.cast("string")) % 2 == 0, F.lit(False))
    return F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def leaves(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, tamper=tampered_text) -> DataFrame:
    """(id, source, leaf, tampered): digests of the rows as they are and as tampered with (null where that changes nothing). ``source`` is
    empty for null, else starts with a sign, so that it orders as sources do."""
    id_, source, text = F.col(columns[0]), F.col(columns[1]), F.col(columns[-1])
    changed = tamper(id_, text)
    head = [part(F.col(c)) for c in columns[:-1]]
    return docs.select(id_.alias("id"), F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("")).alias("source"),
                       digest(*head, part(text)).alias("leaf"), F.when(changed != text, digest(*head, part(changed))).alias("tampered"))


def link(tree: Column, level: Column, place: Column, siblings: Column, trees: int) -> list[Column]:
    """Where a node of a level with so many nodes hangs: (p_tree, p_level, p_place, p_nth), nulls for the root."""
    inner, top = siblings > 1, (tree != TOP) & F.lit(trees > 1)

    def pick(a: Column, b: Column, kind: str) -> Column:
        return F.when(inner, a).when(top, b).cast(kind)

    return [pick(tree, F.lit(TOP), "long").alias("p_tree"), pick(level + 1, F.lit(1), "int").alias("p_level"),
            pick(F.floor(place / ARITY), F.floor(tree / ARITY), "long").alias("p_place"), pick(place % ARITY, tree % ARITY, "int").alias("p_nth")]


def build(level: DataFrame, path: str, trees: int) -> tuple[DataFrame, list[int]]:
    """Stores the inner nodes above a lowest level (tree, place, siblings, hash), siblings the number of nodes of the tree on the level,
    below ``path``. Returns the tops (tree, hash) and the number of nodes of each level from 1 on."""
    spark, sizes = level.sparkSession, []
    tops = [level.filter("siblings = 1").select("tree", "hash")]
    while True:
        height = len(sizes) + 1
        nodes = (level.filter("siblings > 1").groupBy("tree", F.floor(F.col("place") / ARITY).alias("up"))
                 .agg(F.array_sort(F.collect_list(F.struct("place", "hash")))["hash"].alias("children"), F.first("siblings").alias("below")))
        nodes = nodes.select("tree", F.lit(height).alias("level"), F.col("up").alias("place"), F.ceil(F.col("below") / ARITY).alias("siblings"), "children")
        nodes = nodes.select("tree", "level", "place", *link(F.col("tree"), F.col("level"), F.col("place"), F.col("siblings"), trees), "children", "siblings",
                             folded(F.col("children")).alias("hash"))
        nodes.write.parquet(f"{path}/{height}")
        level = spark.read.parquet(f"{path}/{height}")
        n = level.count()
        if not n:
            return reduce(DataFrame.unionByName, tops), sizes
        sizes.append(n)
        tops.append(level.filter("siblings = 1").select("tree", "hash"))


def manifest(docs: DataFrame, path: str, columns: tuple[str, ...] = COLUMNS, tamper=tampered_text) -> tuple[DataFrame, list, bytes | None]:
    """Builds the trees below ``path``. Returns the leaves (no, id, leaf, tampered and the link to the parent), the levels from below as
    (whether of the last tree, height, nodes, number of nodes), and the root (null without rows)."""
    spark = docs.sparkSession
    ranked = cut_table(global_rank(cut_table(leaves(docs, columns, tamper)), [F.col("source"), F.col("id").asc_nulls_first(), F.col("leaf")], "no"))
    sources = cut_lineage(ranked.groupBy("source").agg(F.count(F.lit(1)).alias("siblings"), F.min("no").alias("first")))
    trees = sources.count()
    sources = cut_lineage(global_rank(sources, ["source"], "tree"))
    rows = join_counted(ranked, sources, ["source"], "siblings")
    rows = cut_table(rows.select("no", "id", "leaf", "tampered", "tree", (F.col("no") - F.col("first")).alias("place"), "siblings"))
    tops, sizes = build(rows.select("tree", "place", "siblings", F.col("leaf").alias("hash")), f"{path}/sources", trees)
    tops = cut_lineage(tops.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(trees).cast("long").alias("siblings"), "hash"))
    last, above = build(tops, f"{path}/top", trees)
    root = last.first()
    levels = [(name == "top", k, spark.read.schema(NODE).parquet(f"{path}/{name}/{k}"), n)
              for name, ns in (("sources", sizes), ("top", above)) for k, n in enumerate(ns, 1)]
    rows = rows.select("no", "id", "leaf", "tampered", *link(F.col("tree"), F.lit(0), F.col("place"), F.col("siblings"), trees))
    return rows, levels, root and bytes(root["hash"])


#: A step of the climb: siblings left and right of the own place are the step's row of the proof; the own digest is folded with them.
CLIMB = """
WITH RECURSIVE climb(no, step, p_tree, p_level, p_place, p_nth, hash, siblings, subroot) AS (
  SELECT no, step, p_tree, p_level, p_place, p_nth, hash, CAST(NULL AS BINARY), CAST(NULL AS BINARY) FROM {start}
  UNION ALL
  SELECT c.no, c.step + 1, n.p_tree, n.p_level, n.p_place, n.p_nth,
         unhex(sha2(array_join(transform(n.children, (x, i) -> lower(hex(if(i = c.p_nth, c.hash, x)))), ''), 256)),
         aggregate(filter(n.children, (x, i) -> i <> c.p_nth), X'', (a, x) -> concat(a, x)),
         if(n.tree = -1 AND n.level = 1, n.children[c.p_nth], CAST(NULL AS BINARY))
  FROM climb c JOIN {nodes} n ON c.p_tree = n.tree AND c.p_level = n.level AND c.p_place = n.place)
SELECT * FROM climb"""


def climb(start: DataFrame, nodes: DataFrame) -> DataFrame:
    """All steps of the leaves of ``start`` (no, step, link, hash) as far as ``nodes`` go, the first ones included; to be used within ``unlimited``."""
    return start.sparkSession.sql(CLIMB, start=start, nodes=nodes)


@contextmanager
def unlimited(spark):
    """A recursive query may have a row per leaf and level, however many that are."""
    limit = "spark.sql.cteRecursionRowLimit"
    was = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        yield
    finally:
        spark.conf.unset(limit) if was is None else spark.conf.set(limit, was)


def sections(levels: list[tuple[bool, int, DataFrame, int]], limit: int = NODES) -> list[tuple[DataFrame, Column, bool]]:
    """The levels as (nodes, whether a link leads to them, whether they are broadcast) from below: as many of the last ones as have
    ``limit`` nodes in all are broadcast."""
    total, cut = 0, len(levels)
    while cut and total + levels[cut - 1][3] <= limit:
        cut -= 1
        total += levels[cut][3]
    out = []
    for some, small in ((levels[:cut], False), (levels[cut:], True)):
        if some:
            to = [(F.col("p_tree") == TOP) == F.lit(top) for top, *_ in some]
            to = reduce(Column.__or__, [t & (F.col("p_level") == height) for t, (_, height, *_) in zip(to, some, strict=True)])
            out.append((reduce(DataFrame.unionByName, [nodes for _, _, nodes, _ in some]), to, small))
    return out


def prove(rows: DataFrame, levels: list, root: bytes | None) -> DataFrame:
    """Per leaf: id, leaf, subroot, root, proof_sha256 (of the siblings' digests from below, left to right), folded_root (from the tampered
    leaf, else the leaf, and the siblings) and verified (whether that is the root)."""
    start = rows.select("no", F.lit(0).alias("step"), "p_tree", "p_level", "p_place", "p_nth", F.coalesce("tampered", "leaf").alias("hash"))
    done = [rows.select("no", F.lit(0).alias("step"), F.when(F.col("p_tree").isNull(), F.coalesce("tampered", "leaf")).alias("hash"),
                        F.lit(None).cast("binary").alias("siblings"), F.lit(None).cast("binary").alias("subroot"), "id", "leaf")]
    parts = sections(levels)
    with unlimited(rows.sparkSession):
        for k, (nodes, leads_there, small) in enumerate(parts):
            steps = climb(start, F.broadcast(nodes) if small else nodes)
            if k + 1 < len(parts):
                steps = cut_table(steps)  # read for the proofs and for where the next section starts
                start = steps.filter(F.col("p_tree").isNotNull() & ~leads_there).select("no", "step", "p_tree", "p_level", "p_place", "p_nth", "hash")
            done.append(steps.filter("siblings IS NOT NULL").select(
                "no", "step", F.when(F.col("p_tree").isNull(), F.col("hash")).alias("hash"), "siblings", "subroot",
                F.lit(None).cast(rows.schema["id"].dataType).alias("id"), F.lit(None).cast("binary").alias("leaf")))
        return cut_table(assembled(done, root))


def assembled(done: list[DataFrame], root: bytes | None) -> DataFrame:
    """A row per leaf from the rows of its steps."""
    whole = reduce(DataFrame.unionByName, done)
    path = F.array_sort(F.collect_list(F.when(F.col("siblings").isNotNull(), F.struct("step", "siblings"))))
    g = whole.groupBy("no").agg(F.max("id").alias("id"), F.max("leaf").alias("leaf"), F.max("subroot").alias("subroot"), F.max("hash").alias("hash"), path.alias("path"))
    known = F.lit(root).cast("binary")
    return g.select("id", text_of(F.col("leaf")).alias("leaf"), text_of(F.coalesce("subroot", known)).alias("subroot"), text_of(known).alias("root"),
                    F.sha2(F.array_join(F.transform("path", lambda x: text_of(x["siblings"])), ""), 256).alias("proof_sha256"),
                    text_of(F.col("hash")).alias("folded_root"), (F.col("hash") == known).alias("verified"))


def proofs(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, tamper=tampered_text) -> DataFrame:
    """``prove`` over the manifest of ``docs``, stored in the shared folder."""
    path = f"{ensure_checkpoint_dir(docs.sparkSession)}/merkle-{uuid.uuid4().hex}"
    return prove(*manifest(docs, path, columns, tamper))
