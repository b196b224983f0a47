"""Global-order helpers that stay distributed.

A window without ``partitionBy`` runs in a single task. The helpers here avoid
that: a global rank comes from a range-partitioned sort plus per-partition
offsets (one small row per partition), and global scalars are one-row aggregates
attached through a broadcast of that single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.session import cut_lineage


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row of ``df``.

    ``one_row`` must be a global aggregate (exactly one row). It becomes a single
    scalar subquery (``DataFrame.scalar``): Spark runs it once and inlines the
    value as a literal — no join, no global window, no driver-side branch.
    """
    cols = one_row.columns
    s = one_row.select(F.struct(*cols).alias("__scalars")).scalar()
    return df.withColumn("__scalars", s).withColumns({c: F.col(f"__scalars.{c}") for c in cols}).drop("__scalars")


def global_rank(df: DataFrame, order_cols, rank_col: str = "grank") -> DataFrame:
    """0-based dense position of every row under a total order.

    ``order_cols`` must end in a unique key so the order (and the rank) is
    deterministic. Plan: range-partitioned sort → checkpoint (the two passes
    below must see the same partitions) → row count per partition → running
    offsets over that tiny table → rank = offset + index inside the partition.
    """
    idx_bits = 33  # monotonically_increasing_id = partition << 33 | row index
    s = (df.orderBy(*order_cols)
           .withColumn("__pid", F.spark_partition_id())
           .withColumn("__idx", F.monotonically_increasing_id()
                       - F.shiftleft(F.spark_partition_id().cast("long"), idx_bits)))
    s = cut_lineage(s)
    counts = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: a bounded table, the global window is fine here
    offs = counts.withColumn(
        "__off", F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0)).cast("long")).select("__pid", "__off")
    return (s.join(F.broadcast(offs), "__pid")
             .withColumn(rank_col, (F.col("__off") + F.col("__idx")).cast("long"))
             .drop("__pid", "__idx", "__off"))


def dense_ids(values: DataFrame, value_col: str, id_col: str) -> DataFrame:
    """Dense 0-based ids over the sorted distinct values of ``value_col``.

    UTF-8 byte order equals code-point order, so ids agree with a Python sort.
    """
    d = values.select(value_col).where(F.col(value_col).isNotNull()).distinct()
    return global_rank(d, [F.col(value_col).asc()], id_col).select(id_col, value_col)
