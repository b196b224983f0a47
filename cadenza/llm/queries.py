"""One registered query per training-data operator, with production parameters over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cadenza.llm import bisector, decontam, exact_dedup, jaccard, merkle, ordered_packing, packing, pii, quality, secrets, suffix, warc, windows
from cadenza.llm.common import table
from cadenza.llm.registry import ORACLES, QUERIES, query
from cadenza.session import ensure_checkpoint_dir

__all__ = ["QUERIES", "ORACLES"]

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@query("op1_pii_sanitisation")
def op1(spark, sf_dir):
    r = pii.report(table(spark, sf_dir, "documents"))
    base = pii.KINDS[:4]
    counts = [pii.count_of(F.col("spans"), name).cast("long").alias(f"n_{name}") for name in base]
    return r.select(F.col("id").alias("doc_id"), *counts, F.sha2(pii.digest(F.col("spans"), len(base)), 256).alias("base_sha256"),
                    pii.digest(F.col("spans")).alias("spans"))


@query("op2_best_fit_packing")
def op2(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op3_benchmark_decontamination", f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '{WORD}') ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '{WORD}') ws FROM benchmark),
g AS (SELECT DISTINCT item_id, n, gram FROM (SELECT item_id, least(10, len(ws)) n,
        unnest([array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') FOR i IN range(1, len(ws) - least(10, len(ws)) + 2)]) gram
      FROM b WHERE len(ws) > 0)),
p AS (SELECT doc_id, n, unnest([{{'i': i, 'g': array_to_string(ws[i:i + n - 1], ' ')}} FOR i IN range(1, len(ws) - n + 2)]) w
      FROM d, (SELECT DISTINCT n FROM g) WHERE len(ws) >= n),
h AS (SELECT doc_id, w.i AS i, p.n AS n, item_id FROM p JOIN g ON g.n = p.n AND g.gram = w.g),
c AS (SELECT doc_id, count(*) n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) k FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) n_items, string_agg(s, ',' ORDER BY s) items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) n_words, CAST(coalesce(n_hit, 0) AS BIGINT) n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) n_items, sha256(coalesce(items, '')) items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""")
def op3(spark, sf_dir):
    r = decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return r.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op4_exact_dedup", r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') t FROM documents),
g AS (SELECT *, min(doc_id) OVER (PARTITION BY t) keep_id, count(*) OVER (PARTITION BY t) group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) text_sha256 FROM g""")
def op4(spark, sf_dir):
    d = exact_dedup.decisions(table(spark, sf_dir, "documents"), digest_all=True)
    return d.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query("op5_secret_scan")
def op5(spark, sf_dir):
    r = secrets.scan(table(spark, sf_dir, "documents")).filter("secret")
    return r.select(F.col("id").alias("doc_id"), "start", "end", F.sha2("value", 256).alias("value_sha256"), "probability")


@query("op6_substring_dedup")
def op6(spark, sf_dir):
    r = windows.near_passages(table(spark, sf_dir, "documents"))
    return r.withColumnsRenamed({"id": "doc_id", "other_id": "other_doc_id"})


@query("op7_suffix_array_dedup")
def op7(spark, sf_dir):
    r = suffix.remove(table(spark, sf_dir, "documents"))
    return r.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_ngram_jaccard_join", r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest([array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ') FOR i IN range(1, len(ws) - least(5, len(ws)) + 2)]) g
      FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id x, b.doc_id y FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
r(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) component_id FROM r GROUP BY x) c USING (doc_id)""")
def op8(spark, sf_dir):
    r = jaccard.components_of(table(spark, sf_dir, "documents"))
    return r.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query("op9_warc_revisits", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) b FROM pages),
g AS (SELECT page_id, octet_length(b) n, sha256(b) d FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY d) first FROM g)
SELECT page_id, CAST(n AS BIGINT) payload_bytes, d payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END refers_to FROM m""")
def op9(spark, sf_dir):
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    r = warc.archive_pages(table(spark, sf_dir, "pages"), path)
    return r.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", F.col("original").alias("refers_to"))


@query("op10_quality_knn")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query("op11_ordered_packing")
def op11(spark, sf_dir):
    return ordered_packing.pack(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def _op12_sql(k: int = bisector.CLUSTERS, rounds: int = bisector.ROUNDS, dims: int = bisector.DIMS, scale: int = bisector.SCALE) -> str:
    """One CTE for each assignment and each move of the centroids; sums are exact in HUGEINT."""
    parts = [f"v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) q FROM embeddings "
             f"WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims})",
             f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, q) - 1 c, q FROM (SELECT q, sha256('1:' || CAST(vec_id AS VARCHAR)) h FROM v) ORDER BY h, q LIMIT {k})"]
    for r in range(rounds + 1):
        dist = "list_sum(list_transform(range(1, {0} + 1), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i])))".format(dims)
        parts.append(f"a{r} AS MATERIALIZED (SELECT vec_id, q, m.c AS c, m.d AS d FROM (SELECT v.vec_id, v.q, min({{'d': CAST({dist} AS BIGINT), 'c': c.c}}) m "
                     f"FROM v, c{r} c GROUP BY ALL))")
        if r < rounds:
            parts.append(f"s{r} AS (SELECT c, p, sum(x) s, count(*) n FROM (SELECT c, unnest(q) x, unnest(range(1, {dims} + 1)) p FROM a{r}) GROUP BY c, p)")
            parts.append(f"m{r} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) q FROM s{r} GROUP BY c)")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.q, c.q) q FROM c{r} c LEFT JOIN m{r} m USING (c))")
    return (f"WITH {', '.join(parts)} SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) cluster_inertia, "
            f"CAST(sum(d) OVER () AS BIGINT) inertia, sha256(array_to_string(c.q, ',')) centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON a.c = c.c")


@query("op12_centroid_clustering", _op12_sql())
def op12(spark, sf_dir):
    return bisector.cluster(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def _field(name: str, value: str = "") -> str:
    value = value or f"CAST({name} AS VARCHAR)"
    return f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')"


_HEAD = " || ".join(_field(c) for c in merkle.COLUMNS[:-1])


@query("op13_merkle_manifest", f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda n: list_reduce([CAST(n AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
       lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) tab),
d AS (SELECT *, xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
       lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 2 = 0 AS hit FROM documents, crc),
l AS (SELECT doc_id, source, sha256({_HEAD} || {_field("text")}) h,
       sha256({_HEAD} || CASE WHEN hit THEN {_field("text", "replace(text, chr(10), '')")} ELSE {_field("text")} END) bad FROM d),
leaf AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 s, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 pos,
       count(*) OVER (PARTITION BY source) m, row_number() OVER () no FROM l),
up(s, lvl, pos, m, h) AS (SELECT s, 0, pos, m, h FROM leaf UNION ALL
  SELECT s, lvl + 1, pos // 3, (m + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE m > 1 GROUP BY s, lvl, pos // 3, m),
sub AS MATERIALIZED (SELECT s, h, count(*) OVER () trees FROM up WHERE m = 1),
ts(lvl, pos, m, h) AS (SELECT 0, s, trees, h FROM sub UNION ALL
  SELECT lvl + 1, pos // 3, (m + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM ts WHERE m > 1 GROUP BY lvl, pos // 3, m),
n AS MATERIALIZED (SELECT st || '-' || s || '-' || lvl || '-' || pos AS key, h,
       CASE WHEN m > 1 THEN st || '-' || s || '-' || (lvl + 1) || '-' || (pos // 3) WHEN st = 0 AND trees > 1 THEN '1-0-1-' || (s // 3) END par,
       CASE WHEN m > 1 THEN pos % 3 ELSE s % 3 END nth
     FROM (SELECT 0 st, * FROM up UNION ALL SELECT 1, 0, * FROM ts WHERE lvl > 0), (SELECT max(trees) trees FROM sub)),
k AS MATERIALIZED (SELECT par, list(h ORDER BY nth) hs FROM n WHERE par IS NOT NULL GROUP BY par),
cl(no, par, nth, h, proof) AS (SELECT no, par, nth, bad, '' FROM leaf JOIN n ON key = '0-' || s || '-0-' || pos UNION ALL
  SELECT no, p.par, p.nth, sha256(array_to_string(list_transform(hs, lambda x, i: CASE WHEN i = cl.nth + 1 THEN cl.h ELSE x END), '')),
         proof || array_to_string(list_filter(hs, lambda x, i: i <> cl.nth + 1), '') FROM cl JOIN k ON k.par = cl.par JOIN n p ON p.key = cl.par)
SELECT doc_id, leaf.h AS leaf, sub.h AS subroot, root, sha256(proof) proof_sha256, cl.h AS folded_root, cl.h = root AS verified
FROM leaf JOIN sub USING (s) JOIN cl ON cl.no = leaf.no AND cl.par IS NULL, (SELECT h root FROM ts WHERE m = 1)""")
def op13(spark, sf_dir):
    return merkle.proofs(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
