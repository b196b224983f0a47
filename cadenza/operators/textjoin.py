"""Exact case-insensitive substring join without pairing every name with every text.

``contains_join(names, texts)`` returns the (name_id, text_id) pairs where
lower(name) occurs in lower(text) — the same set a nested-loop ``contains``
join gives, built as a q-gram index join over the different lower-case names:

1. texts' q-grams that a name has are counted (map side first); nothing else of them is kept;
2. every name picks its *rarest* q-gram (by text frequency) and its offset, one aggregate per name —
   hot grams are never the join key of a name that has a rarer one;
3. texts emit their q-grams again, equi-joined to the picked ones, and the full name is verified at position − offset. Picked grams of at most
   ``BROADCAST_NAMES`` names are broadcast, so that a text is verified where it is read; beyond that grams move without their texts, which are joined again by id;
4. different names' pairs get the ids of all names that read so. Names of white space alone match nothing,
   nor does a name that one id has twice (ids are taken to be unique; this join has always left such rows out).

Names shorter than q use their whole text as the gram (their lengths form a set of
at most q − 1 values, so the text side emits at most q grams per position).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.session import cut_table

Q = 12
#: Names up to this number, and their grams up to ten times as many, are broadcast.
BROADCAST_NAMES = 200_000


def _grams(df: DataFrame, id_col: str, text_col: str, lengths) -> DataFrame:
    """(text id, lower-case text, position, gram) of every gram of the given lengths, from one read."""
    t = df.select(F.col(id_col).alias("__tid"), F.lower(F.col(text_col)).alias("__t"))
    def at(g):
        return lambda p: F.struct(p.alias("__pos"), F.substring("__t", p, F.lit(g)).alias("__gram"))

    one = [F.transform(F.sequence(F.lit(1), F.length("__t") - g + 1), at(g)) for g in lengths]
    none = F.expr("cast(array() as array<struct<__pos: int, __gram: string>>)")
    each = F.concat(*[F.when(F.length("__t") >= g, x).otherwise(none) for g, x in zip(lengths, one, strict=True)])
    return t.select("__tid", "__t", F.explode(each).alias("__x")).select("__tid", "__t", "__x.*")


def contains_join(names: DataFrame, texts: DataFrame, name_id: str = "name_id", name_col: str = "name",
                  text_id: str = "text_id", text_col: str = "text", q: int = Q) -> DataFrame:
    ids = (names.select(F.col(name_id).alias("__nid"), F.lower(F.col(name_col)).alias("__n"))
                .where(F.length(F.trim("__n")) > 0))
    ids = ids.groupBy("__nid", "__n").agg(F.count(F.lit(1)).alias("__c")).where("__c = 1").drop("__c")
    n = cut_table(ids.select("__n").distinct().withColumn("__gl", F.least(F.length("__n"), F.lit(q))))
    # gram lengths in use: a set of at most q small integers (a bounded result)
    found = n.groupBy("__gl").agg(F.count(F.lit(1)), F.sum(F.length("__n") - F.col("__gl") + 1)).collect()
    lengths = sorted(r[0] for r in found)
    if not lengths:
        return names.select(name_id).limit(0).crossJoin(texts.select(text_id).limit(0))
    ng = (n.select("__n", "__gl", F.explode(F.sequence(F.lit(0), F.length("__n") - F.col("__gl"))).alias("__off"))
           .withColumn("__gram", F.substring("__n", F.col("__off") + 1, F.col("__gl"))))
    small = sum(r[1] for r in found) <= BROADCAST_NAMES and sum(r[2] for r in found) <= 10 * BROADCAST_NAMES

    def hinted(df):
        return F.broadcast(df) if small else df

    tg = _grams(texts, text_id, text_col, lengths)
    freq = tg.select("__gram").join(hinted(ng.select("__gram").distinct()), "__gram", "left_semi").groupBy("__gram").agg(F.count(F.lit(1)).alias("__f"))
    # the rarest gram of each name; every gram of a name must occur in a text that holds it, so a name with a gram of no text has no match
    pick = ng.join(freq, "__gram").groupBy("__n", "__gl").agg(F.min(F.struct("__f", "__off", "__gram")).alias("__b"), F.count(F.lit(1)).alias("__have"))
    pick = pick.where(F.col("__have") == F.length("__n") - F.col("__gl") + 1)
    pick = cut_table(pick.select("__n", F.col("__b.__off").alias("__off"), F.col("__b.__gram").alias("__gram")))
    at_place = F.substring("__t", F.col("__pos") - F.col("__off"), F.length("__n")) == F.col("__n")
    if small:
        hit = tg.join(F.broadcast(pick), "__gram").where(at_place)
    else:
        t = texts.select(F.col(text_id).alias("__tid"), F.lower(F.col(text_col)).alias("__t"))
        hit = tg.drop("__t").join(pick, "__gram").join(t, "__tid").where(at_place)
    return hit.select("__n", "__tid").join(ids, "__n").select(F.col("__nid").alias(name_id), F.col("__tid").alias(text_id)).distinct()
