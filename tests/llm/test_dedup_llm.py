"""Exact dedup, suffix arrays, the Jaccard join and near passages against brute force."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cadenza.llm import common, exact_dedup, jaccard, suffix, windows


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def by_text(rows):
    g = defaultdict(list)
    for i, t in rows:
        g[norm(t)].append(i)
    return g


@pytest.mark.parametrize("limit", [common.BROADCAST_ROWS, 0])
def test_exact_decisions(docs, rows, monkeypatch, limit):
    monkeypatch.setattr(common.small, "__defaults__", (limit,))
    got = exact_dedup.decisions(docs, digest_all=True).collect()
    g = by_text(rows)
    want = Counter()
    for t, ids in g.items():
        keep = min((i for i in ids if i is not None), default=None)
        left = 1
        for i in sorted(ids, key=lambda x: (x is None, x)):
            want[(i, keep, len(ids), left == 1, hashlib.sha256(t.encode()).hexdigest())] += 1
            left = 0
    assert Counter((r["id"], r["keep_id"], r["group_size"], r["kept"], r["digest"]) for r in got) == want
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    texts = [norm(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted(g)


def test_empty_tables(none):
    assert exact_dedup.decisions(none).count() == 0 and exact_dedup.drop_copies(none).count() == 0
    assert suffix.remove(none).count() == 0
    assert jaccard.components_of(none).count() == 0 and jaccard.drop_near_copies(none).columns == none.columns
    assert windows.near_passages(none).count() == 0


def brute_bytes(texts, k):
    c = Counter(t[i:i + k] for t in texts for i in range(len(t) - k + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for i in range(len(t) - k + 1):
            if c[t[i:i + k]] > 1:
                mark[i:i + k] = b"\1" * k
        spans = sum(1 for i, m in enumerate(mark) if m and (not i or not mark[i - 1]))
        out.append((len(t), sum(mark), spans, bytes(b for b, m in zip(t, mark) if not m)))
    return out


@pytest.mark.parametrize("runs", [suffix.GROUP_RUNS, 1])
def test_suffix_removal(docs, rows, monkeypatch, runs):
    monkeypatch.setattr(suffix, "GROUP_RUNS", runs)
    got = Counter((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix.remove(docs).collect())
    want = Counter((i, *x) for (i, _), x in zip(rows, brute_bytes([(t or "").encode() for _, t in rows], suffix.LENGTH)))
    assert got == want


def test_suffix_fragments_are_not_stored(docs, monkeypatch):
    """The bytes of runs go to the suffix arrays' shuffle alone; lists are merged before they meet the texts."""
    stored = []
    for name in ("cut_table", "cut_lineage"):
        real = getattr(suffix, name, None)
        monkeypatch.setattr(suffix, name, lambda df, real=real: (stored.append(df.columns), real(df))[1], raising=False)
    assert suffix.remove(docs).count() == docs.count() and stored
    assert not any("f" in c for c in stored)
    lo, hi = suffix.merged(np.array([0, 5, 300, 700]), np.array([9, 100, 320, 800]))
    assert (lo.tolist(), hi.tolist()) == ([0, 700], [320, 800])
    assert [x.tolist() for x in suffix.merged(np.array([0, 5, 9]), np.array([50, 6, 10]))] == [[0], [50]]


def test_suffix_order_and_matches():
    rng = random.Random(3)
    for alphabet in (b"a", b"ab", bytes(range(256))):
        for n in (1, 2, 50, 300):
            b = bytes(rng.choice(alphabet) for _ in range(n))
            assert suffix.suffix_order(np.frombuffer(b, np.uint8)).tolist() == sorted(range(n), key=lambda i: b[i:])
    f = [bytes(rng.choice(b"ab") for _ in range(rng.randint(9, 40))) for _ in range(40)]
    c = Counter(x[i:i + 9] for x in f for i in range(len(x) - 8))
    assert all(hit.tolist() == [c[x[i:i + 9]] > 1 for i in range(len(x) - 8)] for x, hit in zip(f, suffix.matched_starts(f, 9)))


def shingles(t):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
    n = min(5, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
    least = {k: min((rows[i][0] for i, x in enumerate(label) if x == k and rows[i][0] is not None), default=None) for k in set(label)}
    return Counter((rows[i][0], len(sets[i]), least[label[i]]) for i in range(len(rows))), len(set(label))


def near_rows(invented):
    """Chains and a large group of near copies, and texts that share a passage."""
    rng = random.Random(5)
    rows, base = [], invented(50, 120)
    for k in range(60):
        t = list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = f"q{rng.random()}"
        rows.append((100 + k, " ".join(t)))
    for k in range(12):  # a chain: each links with the next only
        rows.append((200 + k, " ".join(f"c{i}" for i in range(6 * k, 6 * k + 60))))
    for k in range(30):
        rows.append((300 + k, " ".join(invented(60 + k, 80) + invented(51, 40))))
    return rows


def test_jaccard_components(spark, docs, rows, invented):
    more = near_rows(invented)
    all_ = docs.unionByName(spark.createDataFrame([(*r, "a", "b", None, 0.5) for r in more], docs.schema))
    got = Counter((r["id"], r["n_shingles"], r["component_id"]) for r in jaccard.components_of(all_).collect())
    want, groups = brute_components([*rows, *more])
    assert got == want
    kept = jaccard.drop_near_copies(all_)
    assert kept.columns == docs.columns and kept.count() == groups


def test_jaccard_thinning_makes_the_points(spark, invented, monkeypatch):
    """One pass over the texts gives each row's point, repeated rows too, and the sets that may link; rounds delete their shuffles' files."""
    rows = [(1, " ".join(invented(80, 60))), (1, " ".join(invented(80, 60))), (2, " ".join(invented(80, 60)) + " end"), (3, " ".join(invented(81, 60))), (4, None), (None, "a b")]
    points, thin = jaccard._thinned(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text")
    got = points.collect()
    assert sorted((r["id"] or 0, r["n"]) for r in got) == [(0, 1), (1, 56), (1, 56), (2, 57), (3, 56), (4, 0)] and len({r["tag"] for r in got}) == 6
    assert all(r["key"] == jaccard._digest(jaccard.shingle_set(dict(rows)[r["id"]])) for r in got)
    assert {r["sid"] for r in thin.collect()} == {r["sid"] for r in got if r["id"] in (1, 2)}

    clean, real, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", jaccard.labelled, []
    was = spark.conf.get(clean, None)
    monkeypatch.setattr(jaccard, "labelled", lambda sets: (seen.append(spark.conf.get(clean)), real(sets))[1])
    jaccard.components_of(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert seen == ["true"] and spark.conf.get(clean, None) == was


@pytest.mark.parametrize("small,pivots,chunk,dense", [(2, 2, 8, 8), (1, 1, 5, 0)])
def test_jaccard_recursion(spark, invented, monkeypatch, small, pivots, chunk, dense):
    """Pivots, cells and chunks of any size find the same components: a family around a hub that only links with the hub, one at distances
    about the radius, unrelated texts with common passages, and chains."""
    for name, value in (("SMALL", small), ("PIVOTS", pivots), ("CHUNK", chunk), ("DENSE", dense)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(small)
    base, rows = invented(70, 100), []
    for k in range(40):
        t = list(base)
        for _ in range(3 if k else 0):
            t[rng.randrange(len(t))] = f"h{rng.random()}"
        rows.append((k, " ".join(t)))
    for k in range(40):
        at = rng.randrange(40)
        rows.append((100 + k, " ".join(invented(71, 90)[at:at + 50])))
    for k in range(25):
        rows.append((200 + k, " ".join(invented(72, 30) + invented(300 + k, 60))))
    rows += near_rows(invented)[60:72]
    want, _ = brute_components(rows)
    got = Counter((r["id"], r["n_shingles"], r["component_id"]) for r in jaccard.components_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    assert got == want


def test_chunks_are_compared_exactly():
    rng = np.random.RandomState(3)
    x = [np.unique(rng.randint(0, 60, rng.randint(1, 50))) for _ in range(30)]
    y = [np.unique(rng.randint(0, 60, rng.randint(1, 50))) for _ in range(20)] + [s.copy() for s in x[:5]]
    for columns in (7, 4096):
        got = jaccard.chunk_links(x, y, columns)
        for i, a in enumerate(x):
            for j, b in enumerate(y):
                both = len(np.intersect1d(a, b))
                assert got[i, j] == (100 * both >= 75 * (len(a) + len(b) - both))
    size = lambda v: np.array([len(s) for s in v])
    room = jaccard.may_link([jaccard.sketch(s) for s in x], size(x), [jaccard.sketch(s) for s in y], size(y))
    assert room[got].all() and not room.all()  # sketches lose no link
    assert sorted(jaccard._forest(np.array([1, 2, 3, 1, 5]), np.array([2, 3, 1, 3, 6]))) == [(1, 2), (2, 3), (5, 6)]


def test_components_of_graphs(spark):
    e = [(1, 2), (2, 3), (4, 3), (4, 9), (9, 1), (20, 21), (30, 31), (31, 32), (33, 32), (7, 7), *((50, k) for k in range(51, 90))]
    got = {r["node"]: r["label"] for r in common.components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert {k: v for k, v in got.items() if k < 50} == {1: 1, 2: 1, 3: 1, 4: 1, 9: 1, 20: 20, 21: 20, 30: 30, 31: 30, 32: 30, 33: 30}
    assert all(v == 50 for k, v in got.items() if k >= 50)


def test_near_passages(docs, rows, spark, invented):
    shared = invented(90, 55)
    altered = [w if i % 25 else w + "x" for i, w in enumerate(invented(91, 120))]
    more = [(400, " ".join(invented(92, 70) + shared)), (401, " ".join(shared + invented(93, 70))), (402, " ".join(invented(94, 20) + shared + invented(95, 20))),
            (410, " ".join(invented(96, 60) + invented(91, 120))), (411, " ".join(altered + invented(97, 60))), (420, " ".join(invented(98, 300)))]
    all_ = docs.unionByName(spark.createDataFrame([(*r, "a", "b", None, 0.5) for r in more], docs.schema))
    got = windows.near_passages(all_).collect()
    spans = defaultdict(list)
    for r in got:
        spans[r["id"]].append((r["start_word"], r["end_word"]))
        assert r["similarity"] >= windows.SIMILARITY
    for k, at in ((400, 70), (401, 0), (402, 20)):
        assert any(a <= at and at + 55 <= b for a, b in spans[k]), (k, spans[k])
    assert 410 in spans and 411 in spans and 420 not in spans and not {3, 4, 5, 6, 11, 12} & set(spans)
    assert {7, 8, 9, 10, 13} <= set(spans)


def test_signatures_agree_inside_repeats(invented):
    a = windows.shingles(" ".join(invented(1, 80) + invented(2, 60)))
    b = windows.shingles(" ".join(invented(3, 33) + invented(2, 60) + invented(4, 50)))
    ka, kb = set(windows.signatures(a)[0].tolist()), set(windows.signatures(b)[0].tolist())
    assert len(ka & kb) >= windows.HASHES // 2
    for h in (a, b):  # every window's minima are in the run that the signatures say
        v = windows._mix(h[None, :] ^ windows._SEEDS)
        assert len(windows.signatures(h)[0]) >= windows.HASHES // 2 and v.shape[0] == windows.HASHES


def test_chunks_compare_a_forest_first(spark, invented, monkeypatch):
    """A family whose members all link is joined by about as many comparisons as it has members, not by all of its pairs."""
    texts = [invented(700, 200) for _ in range(16)]
    for k, t in enumerate(texts):
        t[5 * k] = f"edit{k}"
    rows = [(k, len(s), s.tobytes()) for k, s in enumerate(jaccard.shingle_set(" ".join(t)) for t in texts)]
    sets = spark.createDataFrame(rows, "cid long, n long, s binary").cache()
    members = sets.selectExpr("7L AS region", "cid", "n", "cid AS label", "0L AS ring", "16L AS rows")
    compared, real = [], jaccard._compared
    monkeypatch.setattr(jaccard, "_compared", lambda pairs, sets: (compared.append(pairs.count()), real(pairs, sets))[1])
    links = jaccard._grid(members, sets, jaccard._sketches(sets)).collect()
    assert {r["label"] for r in common.components(spark.createDataFrame(links)).collect()} == {0}
    assert 15 <= sum(compared) <= 2 * 16


def edited_families(invented):
    """Families of three texts: t is near base and u is near t, but u is not near base."""
    out = []
    for seed in range(500, 540):
        base = invented(seed, 200)
        t = [f"t{seed}x{i}" if i % 40 == 20 else w for i, w in enumerate(base)]
        u = [f"u{seed}x{i}" if i % 40 == 0 else w for i, w in enumerate(t)]
        out.append([" ".join(w) for w in (base, t, u)])
    return out


def test_passages_that_match_a_covered_text_only(spark, invented):
    """Every text that shares a signature with a near one is found, whatever became of the near one before; the others are the search's loss."""
    want, near = set(), set()
    for k, family in enumerate(edited_families(invented)):
        h = [windows.shingles(x) for x in family]
        keys = [set(windows.signatures(x)[0].tolist()) for x in h]
        assert windows.passages(h[1], h[0]) and windows.passages(h[2], h[1]) and not windows.passages(h[2], h[0])
        for i, j in ((0, 1), (1, 2)):
            near |= {10 * k + i, 10 * k + j}
            if keys[i] & keys[j]:
                want |= {10 * k + i, 10 * k + j}
    rows = [(10 * k + i, x) for k, f in enumerate(edited_families(invented)) for i, x in enumerate(f)]
    got = {r["id"] for r in windows.near_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and len(got) >= 0.9 * len(near)


def test_search_meets_every_text_of_a_signature(spark, monkeypatch):
    """Each open window meets all texts of its signature, also when rounds verify nothing."""
    met, real = set(), windows._verified
    monkeypatch.setattr(windows, "_verified", lambda pairs, texts: (met.update((r["a"], r["b"]) for r in pairs.collect()), real(pairs, texts))[1])
    ids = [int(x) for x in np.random.RandomState(8).randint(-2**63, 2**63 - 1, size=20)]
    texts = spark.createDataFrame([(i, f"no passage {i}") for i in ids], "th long, text string")
    spread = spark.createDataFrame([(k, i, 0) for k in (1, 2) for i in ids[10 * k - 10:10 * k + 5]], "key long, th long, lo int")
    assert windows._search(spread, texts).count() == 0
    groups = [set(ids[:15]), set(ids[10:])]
    assert met == {(a, b) for g in groups for a in g for b in g if a > b}


def test_passages_whose_parts_stand_elsewhere_too(invented):
    shared = invented(600, 60)
    edited = [w if i != 40 else "edited" for i, w in enumerate(shared)]
    a = invented(601, 50) + shared + invented(602, 50)
    n = 60 - windows.SHINGLE + 1
    for other in (shared, edited):  # the first half stands 20 words before the passage, too
        b = invented(603, 40) + shared[:30] + invented(604, 20) + other + invented(605, 40)
        x, y = windows.shingles(" ".join(a)), windows.shingles(" ".join(b))
        for got, want in ((windows.passages(x, y), (50, 50 + n, 90, 90 + n)), (windows.passages(y, x), (90, 90 + n, 50, 50 + n))):
            assert [r[:4] for r in got] == [want], got
    b = shared + invented(606, 80) + shared  # both places count
    x, y = windows.shingles(" ".join(a)), windows.shingles(" ".join(b))
    assert [r[:4] for r in windows.passages(x, y)] == [(50, 50 + n, 0, n), (50, 50 + n, 140, 140 + n)]
    same = windows.shingles(" ".join(["x"] * 300))
    assert any(r[:2] == (0, len(same)) for r in windows.passages(same, same))


def test_every_place_of_a_signature_counts(spark, invented):
    shared = invented(610, 60)
    docs = spark.createDataFrame([(1, " ".join(shared + invented(611, 80) + shared)), (2, " ".join(invented(612, 30) + shared)), (3, " ".join(shared + invented(613, 30)))], "doc_id long, text string")
    spans = defaultdict(set)
    for r in windows.near_passages(docs).collect():
        spans[r["id"]].add((r["start_word"], r["end_word"]))
    assert {(0, 60), (140, 200)} <= spans[1] and (30, 90) in spans[2] and (0, 60) in spans[3]


def test_a_line_of_many_texts_makes_no_pairs(spark, monkeypatch, invented):
    """Texts of a crowded signature meet only where they have a run of shingles in common; none of their passages is lost."""
    met, real = set(), windows._verified
    monkeypatch.setattr(windows, "_verified", lambda pairs, texts: (met.update((r["a"], r["b"]) for r in pairs.collect()), real(pairs, texts))[1])
    n = windows.CROWD + 20
    ids = [int(x) for x in np.random.RandomState(9).randint(-2**63, 2**63 - 1, size=n)]
    line, shared, other = invented(700, 13), invented(701, 60), invented(702, 55)
    more = {2: shared, 40: shared, 60: shared, 41: other, 70: other}
    rows = [(x, " ".join(invented(800 + i, 30) + line + invented(950 + i, 30) + more.get(i, []))) for i, x in enumerate(ids)]
    spread = spark.createDataFrame([(1, x, 10) for x in ids], "key long, th long, lo int")
    got = windows._search(spread, spark.createDataFrame(rows, "th long, text string")).collect()
    want = {(max(a, b), min(a, b)) for a, b in ((ids[2], ids[40]), (ids[2], ids[60]), (ids[40], ids[60]), (ids[41], ids[70]))}
    assert {(r["a"], r["b"]) for r in got} == want and met == want


def test_prints_of_a_common_run():
    rng = np.random.RandomState(4)
    for k in range(50):
        run = rng.randint(0, 2**62, size=windows.RUN).astype(np.uint64)
        a, b = (np.concatenate([rng.randint(0, 2**62, size=k).astype(np.uint64), run, rng.randint(0, 2**62, size=30).astype(np.uint64)]) for _ in range(2))
        assert set(windows.prints(a)) & set(windows.prints(b))
        assert not set(windows.prints(a)) & set(windows.prints(np.concatenate([run[:windows.PRINT - 1], b[-30:][::-1]])))
    assert not len(windows.prints(run[1:]))


def test_a_line_repeated_in_two_texts_is_verified_in_few_steps(monkeypatch, invented):
    """Runs with the same surroundings are looked at once, not once for each pair of places."""
    calls, real = [], windows._Places.passage
    monkeypatch.setattr(windows._Places, "passage", lambda *a: (calls.append(1), real(*a))[1])
    line = invented(710, 28)
    a, b = windows.shingles(" ".join(line * 60)), windows.shingles(" ".join([*line[:27], "edited"] * 60))
    assert windows.passages(a, b) == [(0, 51, 0, 23, 23 / 28), (0, 1675, 1652, 1675, 23 / 28)]
    assert 0 < len(calls) < 2000  # there are 3,540 such runs or so
