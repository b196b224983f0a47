"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Base spans are e-mail addresses, IP addresses, card numbers (Luhn) and phone numbers, leftmost and
non-overlapping per kind; matches that fail their check are dropped. The values found are the protected
entities. Over all documents, the terms (words without digits, of at least TERM_CHARS characters) among
the CONTEXT_WORDS words on either side of an entity are counted with it, and every such term is counted in the whole
corpus, in distinct texts, so that copies are no evidence. A term t discloses an entity e by the share
PMI(e; t) / IC(e) = log(n_et N / (n_e n_t)) / log(N / n_e) of e's information. Terms that meet an entity in at
least SUPPORT distinct texts and disclose at least GENERALISE of it become spans of kind ``term``; from REMOVE on they
are removed, below they are generalised.

Positions come from the pieces between matches: a match starts where the pieces and matches before it
end (a running sum over a document's matches), so texts of any length need no per-character work. A document
is named by its id and the hash of its text. Defined cases: a null text counts as empty; null ids are compared
null-safely; repeated rows get equal results; empty tables give empty results; other columns are ignored
(``spans``) or kept (``sanitise``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cadenza.llm.common import RAW_WORD, ascii_lower, fresh, join_counted, let, maybe_broadcast, placed, same, words
from cadenza.session import cut_lineage

KINDS = ("email", "ip", "card", "phone", "term")
#: The contract's patterns; look-behinds and possessive repeats keep long runs linear and match the same spans.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts without this sign have no match.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
TERM_CHARS = 4
CONTEXT_WORDS = 8
#: Characters beside a match that are looked at first; where they don't hold CONTEXT_WORDS whole words, the whole text is.
CONTEXT_CHARS = 200
SUPPORT = 3
GENERALISE, REMOVE = 0.8, 0.95
_WORD_CHAR = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass Luhn's check: from the right, every second one doubled, digit sums add to a multiple of 10."""
    d = F.split(F.reverse(digits), "", 20)
    doubled = F.transform(d, lambda x, i: F.when(i % 2 == 0, F.coalesce(x.try_cast("int"), F.lit(0))).otherwise(
        let(F.coalesce(x.try_cast("int"), F.lit(0)) * 2, lambda y: F.when(y > 9, y - 9).otherwise(y))))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        n = F.length(_digits(m))
        return F.when(n.between(13, 19), _luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _length(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda n, x: n + F.length(x))


def _first_words(near: Column, whole: Column, back: bool = False) -> Column:
    """The first CONTEXT_WORDS whole words from the outermost sign of a match on (reversed for the left side), without one that the match cuts.
    ``near``, the start of ``whole``, mostly has them already."""
    word, other = RAW_WORD[:-1], RAW_WORD[:-1].replace("[^", "[")
    step = f"{other}++{word}++"
    quick = F.regexp_extract(near, f"^{word}*+((?:{step}){{{CONTEXT_WORDS}}}){other}", 1)
    full = F.regexp_extract(whole, f"^{word}*+((?:{step}){{0,{CONTEXT_WORDS}}}+)", 1)
    return let(quick, lambda q: let(F.when(q != "", q).otherwise(full), lambda t: words(F.reverse(t) if back else t)))


def _matches(text: Column, kind: str) -> Column:
    """Structs (kind, k, gap, len, ok, value, near) of the matches of a kind."""
    no, pattern = KINDS.index(kind), PATTERNS[kind]

    def one(x):
        def near(i):
            start = _length(F.slice(x["g"], 1, i + 1)) + _length(F.slice(x["m"], 1, i))
            return let(start, lambda at: F.concat(_first_words(F.reverse(F.substring(text, F.greatest(at - CONTEXT_CHARS, F.lit(0)) + 1, F.least(at, F.lit(CONTEXT_CHARS)) + 1)),
                                                               F.reverse(F.substring(text, F.lit(1), at + 1)), back=True),
                                                  let(at + F.length(x["m"][i]), lambda to: _first_words(
                                                      F.substring(text, to, F.lit(CONTEXT_CHARS)), F.substring(text, to, F.length(text))))))

        return F.transform(x["m"], lambda m, i: let(_passes(kind, m), lambda ok: F.struct(
            F.lit(no).alias("kind"), i.alias("k"), F.length(x["g"][i]).alias("gap"), F.length(m).alias("len"), ok.alias("ok"),
            F.when(ok, F.lower(m) if kind in ("email", "ip") else _digits(m)).alias("value"), F.when(ok, near(i)).alias("near"))))

    found = let(F.struct(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")), one)
    return F.when(F.contains(text, F.lit(NEEDS[kind])), found) if kind in NEEDS else found


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, kind, start, end, value, near) of the personal data; near: the words around it."""
    text = F.coalesce(text_col, F.lit(""))
    none = F.expr("cast(array() as array<struct<kind:int,k:int,gap:int,len:int,ok:boolean,value:string,near:array<string>>>)")
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), F.explode(
        F.concat(*[F.coalesce(_matches(text, k), none) for k in PATTERNS])).alias("x")).select("id", "th", "x.*")
    return placed(d, ["id", "th", "kind"]).filter("ok").select("id", "th", "kind", "start", "end", "value", "near")


def disclosing_terms(docs: DataFrame, spans: DataFrame, text_col: str = "text", support: int = SUPPORT, least: float = GENERALISE) -> DataFrame:
    """(term, share): terms of the corpus that disclose an entity, with the largest share disclosed."""
    text = F.coalesce(text_col, F.lit(""))
    met = spans.select("kind", "value", "th", F.explode("near").alias("term"))
    met = met.filter(F.col("term").rlike(f"^[^0-9]{{{TERM_CHARS},}}$")).distinct()
    pairs = cut_lineage(met.groupBy("kind", "value", "term").agg(F.count(F.lit(1)).alias("n_et")).filter(F.col("n_et") >= support))
    entities = pairs.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("rows"))
    n_e = spans.select("kind", "value", "th").distinct().groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n_e"))
    pairs = join_counted(pairs, cut_lineage(n_e.join(entities, ["kind", "value"])), ["kind", "value"], "rows").drop("rows")
    n = float(docs.select(F.xxhash64(text).alias("th")).distinct().count())
    # a term is in at least as many texts as it meets entities in: where that is too many already, it can't disclose enough
    seen = met.select("term", "th").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("seen"))
    terms = pairs.groupBy("term").agg(F.count(F.lit(1)).alias("rows"))
    most = F.col("n_et") * F.pow(F.lit(n) / F.col("n_e"), F.lit(1 - least)) * (1 + 1e-9)
    pairs = cut_lineage(join_counted(pairs, cut_lineage(terms.join(seen, "term")), ["term"], "rows").drop("rows").filter(F.col("seen") <= most).drop("seen"))
    terms = cut_lineage(pairs.groupBy("term").agg(F.count(F.lit(1)).alias("rows")))
    each = docs.select(F.xxhash64(text).alias("th"), F.explode(F.array_distinct(words(F.col(text_col)))).alias("term"))
    n_t = each.join(maybe_broadcast(terms.select("term")), "term", "left_semi").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    pairs = join_counted(pairs, cut_lineage(terms.join(n_t, "term")), ["term"], "rows")
    ic = F.log(F.lit(n) / F.col("n_e"))
    share = F.when(ic > 0, F.log(F.col("n_et") * F.lit(n) / (F.col("n_e") * F.col("n_t"))) / ic)
    return pairs.groupBy("term").agg(F.max(share).alias("share")).filter(F.col("share") >= least)


def term_spans(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, start, end, share) of every occurrence of the terms in every document."""
    text = F.coalesce(text_col, F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), ascii_lower(text).alias("t"), F.explode(F.array_distinct(words(F.col(text_col)))).alias("term"))
    d = d.join(maybe_broadcast(terms), "term")
    pattern = F.concat(F.lit(rf"(?<!{_WORD_CHAR})\Q"), "term", F.lit(rf"\E(?!{_WORD_CHAR})"))
    pieces = F.transform(F.split("t", pattern, -1), lambda g: F.length(g))
    d = d.select("id", "th", "term", "share", F.length("term").alias("len"), F.posexplode(let(pieces, lambda p: F.slice(p, 1, F.size(p) - 1))).alias("k", "gap"))
    return placed(d, ["id", "th", "term"]).select("id", "th", "start", "end", "share")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, kind, start, end, share): all spans; share is null for base ones."""
    base = cut_lineage(base_spans(docs, id_col, text_col))
    terms = cut_lineage(disclosing_terms(docs, base, text_col))
    added = term_spans(docs, terms, id_col, text_col).withColumn("kind", F.lit(KINDS.index("term")))
    return base.drop("value", "near").withColumn("share", F.lit(None).cast("double")).unionByName(added)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, th, spans (sorted structs kind, start, end, share)."""
    found = spans(docs, id_col, text_col).groupBy("id", "th").agg(
        F.array_sort(F.collect_list(F.struct("kind", "start", "end", "share"))).alias("spans"))
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("th"))
    j = d.join(found, same(d, found, "id", "th"), "left")
    none = F.expr("cast(array() as array<struct<kind:int,start:bigint,end:bigint,share:double>>)")
    return j.select(d["id"], d["th"], F.coalesce("spans", none).alias("spans"))


def count_of(spans_: Column, kind: str) -> Column:
    no = KINDS.index(kind)
    return F.size(F.filter(spans_, lambda x: x["kind"] == no))


def digest(spans_: Column, kinds: int = len(KINDS)) -> Column:
    """kind:start:end of the spans of the first ``kinds`` kinds, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.filter(spans_, lambda x: x["kind"] < kinds), lambda x: F.concat_ws(
        ":", names[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))), ",")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with base spans replaced by their kind in brackets, and disclosing terms generalised to [TERM] or, from REMOVE
    on, removed. Where spans overlap, the one that starts first (then the lower kind) is replaced, and the others with it."""
    th, found = fresh(docs, "__th", "__spans")
    r = spans(docs, id_col, text_col)
    new = F.concat(F.lit("["), F.upper(F.array(*[F.lit(k) for k in KINDS])[F.col("kind")]), F.lit("]"))
    r = r.withColumn("new", F.when(F.col("share") >= REMOVE, F.lit("")).otherwise(new))
    w = Window.partitionBy("id", "th").orderBy("start", "kind", "end").rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("upto", F.coalesce(F.max("end").over(w), F.lit(0))).withColumn("new", F.when(F.col("start") < F.col("upto"), F.lit("")).otherwise(F.col("new")))
    r = r.filter(F.col("end") > F.col("upto")).withColumn("start", F.greatest("start", "upto"))
    r = r.groupBy("id", "th").agg(F.array_sort(F.collect_list(F.struct("start", "end", "new"))).alias(found))
    r = r.select(F.col("id").alias(id_col), F.col("th").alias(th), found)
    rows = docs.withColumn(th, F.xxhash64(F.coalesce(text_col, F.lit(""))))
    j = rows.join(r, same(rows, r, id_col, th), "left")
    text, s = rows[text_col], F.col(found)
    cut = F.concat(F.array_join(F.transform(s, lambda x, i: let(F.when(i == 0, F.lit(0)).otherwise(s[i - 1]["end"]), lambda a: F.concat(
        F.substring(text, (a + 1).cast("int"), (x["start"] - a).cast("int")), x["new"]))), ""),
        F.substring(text, (F.element_at(s, -1)["end"] + 1).cast("int"), F.length(text)))
    return j.select(*[F.when(s.isNull(), text).otherwise(cut).alias(c) if c == text_col else rows[c].alias(c) for c in docs.columns])
