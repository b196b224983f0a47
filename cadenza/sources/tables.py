"""Scans, sinks and schema helpers.

Column names are resolved case-insensitively and trimmed, as the play logs and
catalogs come with inconsistent headers. Every scan goes through ``select`` so
Catalyst prunes the parquet ``ReadSchema`` and pushes filters into the scan.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Driver parquet table, optionally pruned to ``cols``."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*cols) if cols else df


def clean_columns(df: DataFrame) -> DataFrame:
    """Strip and lower-case every column name."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def read_any(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Parquet or CSV (with header) chosen by the suffix. A CSV without a schema is read as text: types never
    depend on the data, and ``functions.numeric`` turns text into numbers."""
    if path.endswith(".parquet") or os.path.isdir(path) and not path.endswith(".csv"):
        return spark.read.parquet(path)
    r = spark.read.option("header", True).option("encoding", "UTF-8")
    r = r.schema(schema) if schema is not None else r
    return clean_columns(r.csv(path))


def resolve(df: DataFrame, *aliases: str, fallback_position: int | None = None) -> str | None:
    """First existing column among ``aliases`` (case-insensitive), else the
    column at ``fallback_position``, else None."""
    lower = {c.lower(): c for c in df.columns}
    for a in aliases:
        if a.lower() in lower:
            return lower[a.lower()]
    if fallback_position is not None and fallback_position < len(df.columns):
        return df.columns[fallback_position]
    return None


def present(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted columns that a table has, in the wanted order."""
    return sorted(set(wanted).intersection(df.columns), key=wanted.index)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric columns by type, minus ids."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in ex]


def require(df: DataFrame, cols, what: str = "input") -> DataFrame:
    """Raise ``ValueError`` naming the missing columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing columns {missing}; found {df.columns}")
    return df


def read_interactions(df: DataFrame) -> DataFrame:
    """S3: accept three play-log shapes and return one row per pair.

    * (user_id, item_id|artist_id, plays)   → as is (ids)
    * (username, artist, plays|playcount)   → plays summed per (username, artist)
    * (username, artist)                    → rows counted per (username, artist)
    Null keys are dropped first, like a pandas group-by.
    """
    user = resolve(df, "user_id")
    item = resolve(df, "item_id", "artist_id")
    plays = resolve(df, "plays", "playcount")
    if user and item and plays:
        return df.select(F.col(user).alias("user_id"), F.col(item).alias("item_id"),
                         F.col(plays).cast("double").alias("plays"))
    uname = resolve(df, "username")
    aname = resolve(df, "artist")
    if not (uname and aname):
        raise ValueError(f"unsupported interaction columns: {df.columns}")
    value = F.col(plays).cast("double") if plays else F.lit(1.0)
    return (df.where(F.col(uname).isNotNull() & F.col(aname).isNotNull())
              .groupBy(F.col(uname).alias("username"), F.col(aname).alias("artist"))
              .agg(F.sum(value).alias("plays")))


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """Suffix-dispatched sink (parquet by default, CSV with header)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path.endswith(".csv"):
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A one-row report DataFrame written as JSON (one file)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def report_dict(df: DataFrame) -> dict:
    """A one-row report as a dict (the row is an aggregate, never data)."""
    row = df.limit(2).collect()
    if len(row) != 1:
        raise ValueError("a report must have exactly one row")
    return json.loads(json.dumps(row[0].asDict(recursive=True), default=str))
