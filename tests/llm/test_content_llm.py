"""PII, decontamination and secret scans against plain Python."""
import re
from collections import Counter

import pytest

from cadenza.llm import common, decontam, pii, secrets

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.split(".")), "card": lambda: 13 <= len(d) <= 19 and luhn(d),
            "phone": lambda: 9 <= len(d) <= 15}[kind]()


def brute_pii(t):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, t or "") if passes(k, m[0])]


TRICKY = ["a@b.c_x@d.e.f", "é😀 me.you+x@host-1.example.co.uk, you@@no.no x@y", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 9.9.9.9999",
          "card 4381893557741609 4381 8935 5774 1609 4381-8935-5774-1608 0000000000000 5", "+1 (743) 555-3824. +1 +2 3 +49 (0)30 12345678-9( +12345678901234567",
          "a" * 5000 + "@" + "b" * 5000 + ".c" * 500, "1" * 5000, "1 " * 3000, "+" + "1(" * 3000, "@@@@ .... ++++", "x@y.z" * 200, "%_@-.-@a.b"]


def test_pii_spans(docs, rows, spark):
    more = [(500 + k, t) for k, t in enumerate(TRICKY)]
    all_ = docs.unionByName(spark.createDataFrame([(*r, "a", "b", None, 0.5) for r in more], docs.schema))
    spans = common.F.col("spans")
    got = pii.report(all_).select("id", pii.digest(spans, 4).alias("s"), *[pii.count_of(spans, k).alias(k) for k in PATTERNS]).collect()
    want = [(i, brute_pii(t)) for i, t in [*rows, *more]]
    assert Counter(tuple(r) for r in got) == Counter((i, ",".join(s), *(sum(x.startswith(k) for x in s) for k in PATTERNS)) for i, s in want)


def brute_near(t, start, end):
    at = [(m.start(), m.end(), re.sub("[A-Z]", lambda x: x[0].lower(), m[0])) for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t)]
    return sorted([w for _, e, w in at if e <= start][-pii.CONTEXT_WORDS:] + [w for s, _, w in at if s >= end][:pii.CONTEXT_WORDS])


def test_context_is_whole_words_past_other_matches(docs, rows, spark):
    """Eight words on either side, whatever other matches, long words or glued letters stand there."""
    card = "4381893557741609"
    more = [(500 + k, t) for k, t in enumerate(TRICKY)]
    more += [(600, f"Main Street 12 in the year 1999 paid {card} at 20 Kilimandscharo Road for 300 Euro and 15 cents more or less"),
             (601, "mails of one@x.org, two@x.org, three@x.org; four@x.org five@x.org"), (602, "w" * 250 + f" {card} " + "é" * 300 + " far Away " + "v" * 150),
             (603, f"abc{card}def one two"), (604, " ".join(["averylongwordindeedofmanysigns"] * 12) + f" {card} " + ", ".join(["anotherlongwordofthetext"] * 12)),
             (605, "call +1 (743) 555-3824 or +49 (0)30 12345678 or +1 2 now 😀 ok")]
    text = dict([*rows, *more])
    all_ = spark.createDataFrame([(i, t) for i, t in more], "doc_id long, text string")
    got = pii.base_spans(all_).collect()
    assert {r["id"] for r in got} >= {600, 601, 602, 603, 604, 605}
    for r in got:
        assert sorted(r["near"]) == brute_near(text[r["id"]], r["start"], r["end"]), (r["id"], r["start"])


def test_disclosing_terms(spark, invented):
    plain = [(k, " ".join(invented(k, 30))) for k in range(40)]
    told = [(100 + k, " ".join([*invented(100 + k, 10), "Kilimandscharo", "the", "+1 (743) 555-3824", "the", *invented(200 + k, 10)])) for k in range(5)]
    loose = [(300, "only Kilimandscharo here"), (301, "the common word the"), *[(310 + k, f"the number {k} of many") for k in range(20)]]
    docs = spark.createDataFrame([*plain, *told, *loose], "doc_id long, text string")
    found = {r["term"]: r["share"] for r in pii.disclosing_terms(docs, common.cut_lineage(pii.base_spans(docs))).collect()}
    assert "kilimandscharo" in found and "the" not in found
    spans = {r["id"]: r["spans"] for r in pii.report(docs).collect()}
    assert [tuple(x)[:3] for x in spans[300]] == [(4, 5, 19)] and spans[301] == []
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert "555" not in clean[100] and "[PHONE]" in clean[100] and "Kilimandscharo" not in clean[300] and clean[301] == "the common word the"
    assert all(clean[i] == t for i, t in plain)


def test_sanitise_and_empty(docs, none):
    out = pii.sanitise(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert pii.report(none).count() == 0 and pii.sanitise(none).count() == 0


def tokens(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_hits(text, items):
    w, hit, found = tokens(text), set(), set()
    for i, t in items:
        b = tokens(t)
        n = min(10, len(b))
        grams = {tuple(b[k:k + n]) for k in range(len(b) - n + 1)} if b else set()
        for k in range(len(w) - n + 1):
            if b and tuple(w[k:k + n]) in grams:
                hit.update(range(k, k + n))
                found.add(str(i))
    return len(w), len(hit), tuple(sorted(found))


@pytest.mark.parametrize("limit", [common.BROADCAST_ROWS, 0])
def test_decontamination(docs, rows, spark, invented, monkeypatch, limit):
    monkeypatch.setattr(common.small, "__defaults__", (limit,))
    items = [(1, " ".join(invented(2, 60)[5:30])), (2, "ONE, two!"), (3, None), (4, "..."), (10, " ".join(invented(2, 60)[5:30])), (5, "mit dem"), (6, " ".join(invented(1, 3000)[100:111]))]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, width string")
    got = Counter((r["id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in decontam.report(docs, bench).collect())
    assert got == Counter((i, *brute_hits(t, items)) for i, t in rows)
    clean = decontam.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(i for i, t in rows if not brute_hits(t, items)[1])
    cut = Counter((r["doc_id"], r["text"]) for r in decontam.decontaminate(docs, bench, remove="spans").collect())
    for i, t in rows:
        if not brute_hits(t, items)[1]:
            assert cut[(i, t)] >= 1
    assert any(i == 13 and tokens(t) == tokens(" ".join(invented(3, 40) + invented(2, 60)[:5] + invented(2, 60)[30:] + invented(4, 40))) for i, t in cut)


def test_decontamination_empty(docs, none, spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert all(not r["contaminated"] for r in decontam.report(docs, bench).collect())
    assert decontam.report(none, bench).count() == 0 and decontam.decontaminate(docs, bench).count() == docs.count()


def test_secrets(spark, docs, none, invented):
    import random
    rng = random.Random(1)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    planted = [(600 + k, f'some words here token = "{key()}" and more of them') for k in range(25)]
    bare = [(700 + k, f"a value {key()} without a word that tells") for k in range(10)]
    harmless = [(800 + k, f"thortionheaningen{'abcdefghij'[k % 10]} and 44657583828894{k:02d} in path/to/some/file/name") for k in range(60)]
    all_ = docs.unionByName(spark.createDataFrame([(*r, "a", "b", None, 0.5) for r in [*planted, *bare, *harmless]], docs.schema))
    text = dict([*planted, *bare, *harmless])
    got = [r for r in secrets.scan(all_).collect() if r["id"] in text]
    assert all(text[r["id"]][r["start"]:r["end"]] == r["value"] for r in got)
    told = {r["id"] for r in got if r["secret"]}
    assert told >= {i for i, _ in planted + bare} and not told & {i for i, _ in harmless}
    assert secrets.scan(none).count() == 0
