"""The interaction aggregation (A1) as a Structured Streaming job.

New play-log files (lineitem-shaped parquet) arrive in a folder; each micro-batch
is joined to the static order table (stream-static join) and the running
Σ plays per (user, item) is kept in Spark's state store — the same operator as
the batch ``interactions`` stand-in, maintained incrementally. The state and the
progress live under ``checkpoint_location`` (a shared folder on a cluster), so the
query survives executor and driver restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def running_interactions(spark: SparkSession, log_dir: str, orders: DataFrame, schema) -> DataFrame:
    """Streaming DataFrame of (user_id, item_id, plays) over every file seen so far."""
    lines = spark.readStream.schema(schema).parquet(log_dir).select("l_orderkey", "l_partkey", "l_quantity")
    o = orders.select("o_orderkey", "o_custkey")
    return (lines.join(o, lines.l_orderkey == o.o_orderkey)
                 .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
                 .agg(F.sum("l_quantity").alias("plays")))


def start_to_parquet(df: DataFrame, out_dir: str, checkpoint_location: str) -> StreamingQuery:
    """Each micro-batch rewrites the current totals (complete state) to parquet via
    ``foreachBatch`` — the idiom for a sink without complete mode."""
    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out_dir)
    return (df.writeStream.outputMode("complete").foreachBatch(write)
              .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start())
