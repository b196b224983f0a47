"""Column roles (S10): what a column is for, kept with the column.

A role is a key of the field's metadata. Selections, joins, filters and Parquet keep it; a column that an expression replaces loses it, as
its meaning may have changed. ``report`` writes the roles of a table as one row of JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.sources.tables import write_report

ROLE = "role"


def with_roles(df: DataFrame, **columns) -> DataFrame:
    """``df`` with roles: each argument names a role and gives its column or columns. Columns must exist."""
    of = {c: role for role, cols in columns.items() for c in ([cols] if isinstance(cols, str) else cols)}
    missing = sorted(set(of) - set(df.columns))
    if missing:
        raise ValueError(f"no columns {missing}")
    return df.select(*[F.col(c).alias(c, metadata={**df.schema[c].metadata, ROLE: of[c]}) if c in of else F.col(c) for c in df.columns])


def roles(df: DataFrame) -> dict[str, list[str]]:
    """Columns by role, in the table's order."""
    out: dict[str, list[str]] = {}
    for f in df.schema.fields:
        if ROLE in f.metadata:
            out.setdefault(f.metadata[ROLE], []).append(f.name)
    return out


def report(df: DataFrame, path: str, **notes) -> None:
    """One JSON row: the columns of each role, and notes (texts, numbers, or lists or dictionaries of texts)."""
    spark = df.sparkSession
    cells = {**{k: F.array(*[F.lit(c) for c in v]) for k, v in roles(df).items()},
             "notes": F.struct(*[_literal(v).alias(k) for k, v in notes.items()]) if notes else F.lit(None).cast("string")}
    write_report(spark.range(1).select(*[c.alias(k) for k, c in cells.items()]), path)


def _literal(v):
    if isinstance(v, dict):
        return F.struct(*[_literal(x).alias(k) for k, x in v.items()])
    return F.array(*[F.lit(x) for x in v]) if isinstance(v, list | tuple) else F.lit(v)
