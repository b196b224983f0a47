"""Catalog ingest (O7, S2, G2's input): tracks in file order, artists from list texts.

A file has an order that a table does not: imputation walks tracks as they stand in the file, and of rows with one id the last counts, at the place
of the first. ``with_ordinal`` numbers rows by the path of their file and their place in it, from Spark's own file metadata, without a sort;
``last_rows`` is one aggregate per id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.functions.text import parse_list


def with_ordinal(spark: SparkSession, path: str, name: str = "ordinal", **options) -> DataFrame:
    """The Parquet rows below a path with their 0-based number in file order: files by path, rows by their index in the file. Sizes of
    files come from one aggregate; offsets are running sums over a row per file."""
    df = spark.read.options(**options).parquet(path)
    at = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    sizes = at.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = F.broadcast(sizes.select("__file", before.alias("__before")))  # a row per file
    return at.join(files, "__file").withColumn(name, F.col("__before") + F.col("__row")).drop("__file", "__row", "__before")


def last_rows(rows: DataFrame, key: str, ordinal: str = "ordinal") -> DataFrame:
    """One row per key: the values of its last row (largest ordinal) at the place of its first (smallest). A null key is a key of its own."""
    rest = [c for c in rows.columns if c not in (key, ordinal)]
    last = F.max_by(F.struct(*rest), F.col(ordinal)) if rest else F.lit(None)
    g = rows.groupBy(key).agg(F.min(ordinal).alias(ordinal), last.alias("__last"))
    return g.select(key, ordinal, *[F.col("__last")[c].alias(c) for c in rest])


def listed(rows: DataFrame, list_col: str | Column, item: str = "artist_id", place: str = "place") -> DataFrame:
    """A row per item of a list text, with its 0-based place. Rows without items go (they have no artist)."""
    text = F.col(list_col) if isinstance(list_col, str) else list_col
    return rows.select("*", F.posexplode(parse_list(text)).alias(place, item))


def track_artists(rows: DataFrame, key: str, list_col: str, ordinal: str = "ordinal") -> DataFrame:
    """(track_id, artist_id): the pairs that imputation walks, tracks numbered by their place in the file."""
    lists = last_rows(rows.select(key, ordinal, list_col), key, ordinal)
    return listed(lists, list_col).select(F.col(ordinal).alias("track_id"), "artist_id").distinct()
