import os
import tempfile

from cadenza.sources import standins as st
from cadenza.streaming import running_interactions, start_to_parquet

SMALL = "/root/testdata/sf0.001"


def test_streaming_totals_equal_batch(spark):
    scratch = tempfile.mkdtemp(prefix="cadenza-stream-", dir="/tmp")
    src = os.path.join(scratch, "log")
    li = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    # the log arrives in two files (split by order key parity), read as one stream
    li.where("l_orderkey % 2 = 0").write.parquet(os.path.join(src, "part0"))
    li.where("l_orderkey % 2 = 1").write.parquet(os.path.join(src, "part1"))
    files = os.path.join(scratch, "flat")
    spark.read.parquet(os.path.join(src, "part0"), os.path.join(src, "part1")).write.parquet(files)
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    out = os.path.join(scratch, "totals")
    q = start_to_parquet(running_interactions(spark, files, orders, li.schema), out, os.path.join(scratch, "ckpt"))
    q.awaitTermination()
    got = spark.read.parquet(out)
    exp = st.interactions(spark, SMALL)
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
