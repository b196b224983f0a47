"""Session construction and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "cadenza") -> SparkSession:
    """Local/test session. On a cluster the deployment's own session is used instead."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CADENZA_DRIVER_MEMORY", "16g"))
    )
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_PKG_DIR = os.path.dirname(os.path.abspath(__file__))


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``cadenza`` importable in the Python workers (executors): zip the
    package once per SparkContext and register it with ``addPyFile`` — what
    ``--py-files`` does at submit time. Python UDFs defined in the package are
    pickled by reference and need it on every executor."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    if getattr(sc, "_cadenza_shipped", False):
        return
    import zipfile
    out = os.path.join(tempfile.mkdtemp(prefix="cadenza-pkg-"), "cadenza.zip")
    root = os.path.dirname(_PKG_DIR)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(_PKG_DIR):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    sc._cadenza_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when it is unset (local tests)
    fall back to a fresh scratch folder."""
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not conf:
        conf = tempfile.mkdtemp(prefix="cadenza-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf)
    return conf


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_table(df: DataFrame) -> DataFrame:
    """A table written as Parquet in the shared checkpoint folder and read again: one pass, and less room than a checkpoint."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
