"""Centroid clustering, the Merkle manifest and packing in order, against brute force."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import bisector, merkle
from cadenza.llm import ordered_packing as op


def nearest(v, centroids):
    d = [sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in centroids]
    return min(range(len(d)), key=lambda k: (d[k], k)), min(d)


@pytest.mark.parametrize("reach", [3, 10 ** 3, 10 ** 9, 10 ** 12])
def test_tournament_is_nearest_with_ties_to_the_smaller_number(reach):
    rng = random.Random(reach)
    centroids = np.array([[rng.randint(-reach, reach) for _ in range(4)] for _ in range(9)] + [[0] * 4] * 2, dtype=object)
    v = np.array([[rng.randint(-reach, reach) for _ in range(4)] for _ in range(200)] + [list(map(int, (a + b) // 2)) for a in centroids for b in centroids], dtype=np.int64)
    got = bisector.tournament(v, bisector.bisectors(centroids))
    assert got.tolist() == [nearest(x, centroids)[0] for x in v]
    if reach < 10 ** 9:
        assert bisector.squared(v, centroids, got).tolist() == [nearest(x, centroids)[1] for x in v]


def lloyd(rows, k, rounds, dims):
    """Rows (id, ints): the clusters by the contract."""
    start = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    c = [list(v) for _, v in start]
    for _ in range(rounds):
        near = [nearest(v, c)[0] for _, v in rows]
        for k_ in range(len(c)):
            mine = [v for (_, v), n in zip(rows, near) if n == k_]
            if mine:
                c[k_] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, *nearest(v, c)) for i, v in rows], c


def test_clusters(spark):
    rng = np.random.RandomState(3)
    good = [(i, [float(x) for x in rng.randn(4).astype(np.float32) / 3]) for i in range(120)]
    good += [good[0], good[0], (500, [0.0] * 4), (501, [0.0] * 4), (None, [1.5, -2.25, 0.0, 3.0]), (502, [10.0 ** 6, 0.0, 0.0, 0.0])]
    bad = [(900, None), (901, [1.0] * 3), (902, [1.0] * 5), (903, [1.0, None, 1.0, 1.0]), (904, [float("nan")] * 4), (905, [float("inf"), 0.0, 0.0, 0.0]), (906, [])]
    df = spark.createDataFrame([(*r, 7, "x") for r in good + bad], "vec_id long, embedding array<double>, cluster int, v string").repartition(3)
    got = bisector.cluster(df, k=6, rounds=3, dims=4).collect()
    want, centroids = lloyd([(i, [int(np.floor(64 * x)) for x in v]) for i, v in good], 6, 3, 4)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([(r["id"], r["cluster"], r["distance"]) for r in got], key=key) == sorted(want, key=key)
    for r in got:
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"]) and r["inertia"] == sum(d for *_, d in want)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()
    assert bisector.cluster(df.filter("vec_id >= 900"), k=6, dims=4).count() == 0 and len({r["cluster"] for r in bisector.cluster(df.filter("vec_id = 500"), k=6, dims=4).collect()}) == 1


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """Digest and each node's list of sibling digests."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i in range(len(paths)):
            run = at[i] // 3 * 3
            paths[i].append([(k % 3, nodes[k]) for k in range(run, min(run + 3, len(nodes))) if k != at[i]])
            paths[i][-1] = (at[i] % 3, paths[i][-1])
            at[i] //= 3
        nodes = [sha(*nodes[k:k + 3]) for k in range(0, len(nodes), 3)]
    return nodes[0] if nodes else None, paths


def brute_manifest(rows):
    def leaf(r, text):
        return sha(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (*r[:4], text)])
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4]))) for s in order}
    subs = {s: tree([leaf(r, r[4]) for r in trees[s]]) for s in order}
    root, tops = tree([subs[s][0] for s in order])
    out = []
    for n, s in enumerate(order):
        for r, path in zip(trees[s], subs[s][1]):
            bad = r[4]
            if bad is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                bad = bad.replace("\n", "")
            h, proof = leaf(r, bad), []
            for place, others in path + tops[n]:
                proof += [x for _, x in others]
                h = sha(*[x for _, x in sorted([*others, (place, h)])])
            out.append((r[0], leaf(r, r[4]), subs[s][0], root, sha(*proof), h, h == root))
    return out


def manifest_rows(sources, n):
    rng = random.Random(n)
    rows = [(rng.choice([i, i, None]), rng.choice(sources), rng.choice(["en", None]), rng.choice([i, None]),
             rng.choice([None, "", "a\nb", "é\n\U0001f600", "line", "x" * 300 + "\n"])) for i in range(n)]
    return rows + rows[:3]


@pytest.mark.parametrize("sources,n,limit", [(["a"], 40, 50_000), ([None, "", "b", "é", "Z"], 60, 50_000), ([f"s{i}" for i in range(40)], 30, 2),
                                             (["hot"] * 30 + [f"s{i}" for i in range(20)] + [None], 120, 6), (["one"], 0, 9), (["x"], 0, 0)])
def test_manifest(spark, monkeypatch, sources, n, limit):
    monkeypatch.setattr(merkle.sections, "__defaults__", (limit,))
    rows = manifest_rows(sources, n) if n else [(7, "s", None, 1, "t\nu")] * (limit > 0)
    docs = spark.createDataFrame([(*r, "x", 1, None) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, tree int, hash binary").repartition(3)
    got = [tuple(r) for r in merkle.proofs(docs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(brute_manifest(rows), key=key)


def cheapest(at, penalty, window):
    best = [0] + [None] * (len(at) - 1)
    for j in range(1, len(at)):
        options = []
        for i in range(j):
            size = at[j] - at[i]
            if size <= window:
                options.append(best[i] + (0 if size & (size - 1) == 0 else window - size) + penalty[j] + op.SEQUENCE)
        best[j] = min(options)
    return best[-1]


def test_cuts_are_the_cheapest():
    rng = random.Random(5)
    for trial in range(150):
        window = rng.choice([8, 16, 64])
        at = [0]
        for _ in range(rng.randint(1, 60)):
            at.append(at[-1] + rng.randint(1, rng.choice([3, window])))
        penalty = [0] + [rng.choice([0, 5, 30]) for _ in at[1:]]
        cost, cuts = op.best_cuts(np.array(at), np.array(penalty), window)
        assert cost == cheapest(at, penalty, window) and cuts[-1] == at[-1] and set(cuts) <= set(at)
        sizes = np.diff([0, *cuts])
        assert sizes.max() <= window
        assert cost == sum(penalty[at.index(c)] + op.SEQUENCE for c in cuts) + sum(int(p) for p in op.padded(sizes, window) - sizes)


def test_long_texts_are_tokenised_in_parts(rows):
    path = op.default_tokenizer()
    t = op._tokenizer(path)
    texts = [r[1] for r in rows] + ["Ünï's 3.14 don't . a b\n\nc  d " * 40, "a" * 3000, " ".join("Σας it's'll <|endoftext|> x" for _ in range(50))]
    want = [[*t.encode(x or "", add_special_tokens=False).ids, op.END] for x in texts]
    for chars in (20, 1 << 19):
        assert [x.tolist() for x in op.token_ids(texts, path, chars=chars)] == want


@pytest.mark.parametrize("block,per", [(1 << 20, 4 << 20), (300, 1000)])
def test_ordered_packing(docs, rows, none, monkeypatch, block, per):
    path = op.default_tokenizer()
    t = op._tokenizer(path)
    monkeypatch.setattr(op.pack_tokens, "__defaults__", (False, op.WINDOW, block))
    monkeypatch.setattr(op.ordered, "__defaults__", (per,))
    got = op.pack(docs, window=128).collect()
    texts = {}
    for i, x in rows:
        texts.setdefault(i, []).append([*t.encode(x or "", add_special_tokens=False).ids, op.END])
    for i, lists in texts.items():
        mine = sorted([r for r in got if r["id"] == i], key=lambda r: r["start"])
        assert sum(r["length"] for r in mine) == sum(map(len, lists)) and {r["doc_tokens"] for r in mine} == {len(x) for x in lists}
        for r in mine:
            assert any(r["ids_crc32"] == zlib.crc32(np.array(x[r["start"]:r["start"] + r["length"]], dtype="<u4").tobytes()) for x in lists)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append(r)
    waste = 0
    for s in by.values():
        s.sort(key=lambda r: r["offset"])
        size = sum(r["length"] for r in s)
        assert [r["offset"] for r in s] == [sum(x["length"] for x in s[:k]) for k in range(len(s))] and size <= 128
        assert {r["capacity"] for r in s} == {size if size & (size - 1) == 0 else 128}
        waste += s[0]["capacity"] - size
    assert waste < 0.05 * sum(r["length"] for r in got)
    order = [r["id"] for s in sorted(by) for r in by[s]]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert op.pack(none).count() == 0


def test_sequences_hold_the_tokens(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).cache()
    packed = op.pack(docs).cache()
    t = op._tokenizer(op.default_tokenizer())
    got = sorted(op.sequences(docs, packed).collect(), key=lambda r: r["sequence_id"])
    assert all(len(r["ids"]) <= r["capacity"] for r in got)
    stream = [i for r in docs.orderBy("doc_id").collect() for i in [*t.encode(r["text"] or "", add_special_tokens=False).ids, op.END]]
    assert [i for r in got for i in r["ids"]] == stream and sum(len(r["doc_ids"]) for r in got) == packed.count()
    assert packed.filter(F.col("length") > op.WINDOW).isEmpty()
