"""Packing, WARC archives, the quality classifier and the pipeline."""
import hashlib
import math
import os
import random
import uuid
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cadenza.llm import decontam, exact_dedup, jaccard, packing, quality, warc
from cadenza.llm.common import table
from cadenza.llm.registry import ready

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def one_by_one(lengths, sizes, prefer):
    """Best fit decreasing, an item at a time; the bins' contents."""
    bins = []
    for n in sorted(lengths, reverse=True):
        room = [(cap - sum(b), k) for k, (cap, b) in enumerate(bins) if cap - sum(b) >= n]
        if room:
            bins[min(room)[1]][1].append(n)
        else:
            bins.append((prefer if prefer and prefer >= n else min(s for s in sizes if s >= n), [n]))
    return bins


def test_plan_is_best_fit():
    rng = random.Random(2)
    for trial in range(60):
        sizes = (16, 32, 64)
        lengths = [rng.choice([rng.randint(1, 64), 7, 30]) for _ in range(rng.randint(0, 120))]
        for prefer in (None, *sizes):
            moves, cost = packing.best_fit(Counter(lengths), sizes, prefer)
            got = {}
            for n, rank, count, first, per, offset in moves:
                for k in range(count):
                    got.setdefault(first + k // per, []).append((offset + k % per * n, n))
            want = one_by_one(lengths, sizes, prefer)
            assert len(got) == len(want) and Counter(n for b in got.values() for _, n in b) == Counter(lengths)
            if prefer == 64:  # bins of one size: which of equally full bins takes an item doesn't matter
                assert sorted(sum(n for _, n in b) for b in got.values()) == sorted(sum(b) for _, b in want)
            assert all([o for o, _ in sorted(b)] == [sum(n for _, n in sorted(b)[:i]) for i in range(len(b))] for b in got.values())
            assert cost == sum(min(s for s in sizes if s >= sum(n for _, n in b)) + packing.OVERHEAD for b in got.values())


def test_pack_places_every_token(docs, rows, none):
    got = packing.pack(docs, sizes=(64, 128, 256)).collect()
    by_bin = {}
    for r in got:
        by_bin.setdefault(r["bin_id"], []).append(r)
    for b in by_bin.values():
        b.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in b] == [sum(x["n_tokens"] for x in b[:i]) for i in range(len(b))]
        used = sum(r["n_tokens"] for r in b)
        assert all(r["used"] == used and r["capacity"] == min(s for s in (64, 128, 256) if s >= used) for r in b)
    import regex
    want = Counter()
    for i, t in rows:
        want[i] += len(regex.findall(packing.TOKEN, t or ""))
    total = Counter()
    for r in got:
        total[r["id"]] += r["n_tokens"]
    assert +total == +want and packing.pack(none).count() == 0


def test_sequences_round_trip(spark):
    docs = table(spark, SMALL, "documents")
    packed = packing.pack(docs).cache()
    seqs = packing.sequences(docs, packed).collect()
    assert all(len(r["tokens"]) == r["used"] <= r["capacity"] for r in seqs)
    assert sum(len(r["tokens"]) for r in seqs) == docs.agg(F.sum(packing.token_count(F.col("text")))).first()[0]


PAGES = [(5, "http://a/ b", "x" * 100), (2, None, "x" * 100), (2, "http://c", "x" * 100), (9, "u", "y" * 99), (8, "u", "y" * 99), (1, "u", None), (None, "u", ""),
         (None, "u\r\nWARC-Type: bad", "x" * 100), (3, "é", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\n" + "ü😀\x00" * 50), (4, "v", "z" * 300_000)]


def test_warc(spark, monkeypatch):
    monkeypatch.setattr(warc, "SEGMENT_BYTES", 2000)
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string").repartition(2)
    path = f"{ready(spark)}/warc-test-{uuid.uuid4().hex}"
    got = Counter((r["page_id"], r["payload_bytes"], r["digest"], r["record_type"], r["original"]) for r in warc.archive_pages(pages, path).collect())
    want, seen = Counter(), set()
    for i, _, h in sorted(PAGES, key=lambda p: (p[0] is None, p[0])):
        b = (h or "").encode()
        ids = [p[0] for p in PAGES if (p[2] or "").encode() == b and p[0] is not None]
        again = len(b) >= 100 and b in seen
        seen.add(b)
        want[(i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", min(ids) if again else None)] += 1
    assert got == want
    raw = warc.read_archive(spark, f"{path}/raw").collect()
    assert Counter((r["page_id"], r["payload"]) for r in raw) == Counter((i, h or "") for i, _, h in PAGES)
    data = b"".join(zlib.decompress(bytes(r["content"]), 47) for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(f"{path}/deduplicated").collect())
    stored = [block for _, head, block in warc.parse(data) if head["WARC-Type"] == "response"]
    assert sum(b"x" * 100 in s for s in stored) == 1 and sum(head["WARC-Type"] == "revisit" for _, head, _ in warc.parse(data)) == 3
    again = f"{path}/again"
    warc.resolve(spark, f"{path}/deduplicated", again)  # an archive with revisits keeps them
    assert sorted(r["record_type"] for r in warc.read_archive(spark, again, payloads=False).collect()) == ["response"] * 7 + ["revisit"] * 3


def test_warc_dates_and_text_ids(spark):
    pages = spark.createDataFrame([("b é\n1", None, "x" * 200), ("a%20", "u", "x" * 200), (None, "u", "y")], "page_id string, url string, html string")
    path = f"{ready(spark)}/warc-test-{uuid.uuid4().hex}"
    got = warc.archive_pages(pages, path).collect()
    assert sorted((r["page_id"] or "", r["record_type"], r["original"]) for r in got) == [("", "response", None), ("a%20", "response", None), ("b é\n1", "revisit", "a%20")]
    assert all(len(r["date"]) == 20 and r["date"].endswith("Z") for r in got)


def test_warc_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(pages, f"{ready(spark)}/warc-test-{uuid.uuid4().hex}").count() == 0


def test_quality_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).join(labels, "doc_id").filter(quality.held_out(F.col("doc_id"))).select("score", "quality").collect()
    good, bad = ([r["score"] for r in got if r["quality"] == k] for k in (1, 0))
    auc = sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))
    assert auc >= 0.95 and sum(a >= quality.THRESHOLD for a in good) >= 0.98 * len(good) and sum(b < quality.THRESHOLD for b in bad) >= 0.9 * len(bad)


def test_quality_learns_from_training_folds_only(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (dict(quality.score(docs, quality.fit(docs, x)).select("doc_id", "score").collect()) for x in (labels, flipped))
    assert a.keys() == b.keys() and all(math.isclose(a[k], b[k], abs_tol=1e-9) for k in a)


def test_quality_cases(docs, none, spark):
    labels = spark.createDataFrame([(7, 1), (7, 0), (9, 1), (None, 0), (14, None), (99, 0), (15, 0)], "doc_id long, quality int")
    named = docs.withColumnRenamed("score", "Score2")
    model = quality.fit(named, labels)
    got = quality.score(named, model).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(math.isclose(r["score"], model.prior) for r in got if not (r["text"] or "").strip())
    assert quality.keep_good(docs, model).columns == docs.columns
    empty = quality.fit(none, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.keep_good(none, empty).count() == 0 and all(r["s"] == 0.5 for r in quality.score(docs, empty, "s").collect())
    for df in (docs, docs.withColumnRenamed("score", "SCORE")):
        with pytest.raises(ValueError):
            quality.score(df, model)


def test_counts_do_not_depend_on_blocks(rows):
    texts = [t for _, t in rows]
    together = list(quality.text_counts(texts))
    for t, (k, n) in zip(texts, together):
        (k1, n1), = quality.text_counts([t])
        assert k.tolist() == k1.tolist() and n.tolist() == n1.tolist()


def test_pipeline(spark):
    """Each stage on what the one before kept: the same rows as the operators' decisions, and whole rows."""
    ready(spark)
    docs = table(spark, SMALL, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    packed = corpus_pipeline.run(spark, SMALL)
    base = os.path.dirname(packed.inputFiles()[0]).rpartition("/")[0]
    steps = []
    for k, name in enumerate(names[:-1]):
        rows = spark.read.parquet(f"{base}/{k}-{name}")
        assert rows.columns == docs.columns
        steps.append({r["doc_id"] for r in rows.select("doc_id").collect()})
    whole = {r["doc_id"]: r for r in docs.collect()}
    model = quality.fit(docs, table(spark, SMALL, "labels"))
    good = {r["doc_id"] for r in quality.score(docs, model).filter(f"score >= {quality.THRESHOLD}").collect()}
    assert steps[0] == good
    assert steps[1] == {r["id"] for r in exact_dedup.decisions(docs.filter(F.col("doc_id").isin(*good))).filter("kept").collect()} and len(steps[1]) <= len(good)
    assert steps[2] == {r["id"] for r in jaccard.components_of(docs.filter(F.col("doc_id").isin(*steps[1]))).filter("id = component_id").collect()}
    hit = {r["id"] for r in decontam.report(docs, table(spark, SMALL, "benchmark")).filter("contaminated").collect()}
    assert steps[3] == steps[2] - hit
    assert all(tuple(whole[r["doc_id"]]) == tuple(r) for r in rows.collect())
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {k for k in steps[3] if whole[k]["text"].strip()}
