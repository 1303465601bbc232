"""Session helpers: build a local session for tests/bench and find shared dirs."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session should carry; the cluster may already set them.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "skein") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator of the cluster and must be a
    shared file system; we only pick our own folder when it is unset on a
    ``local[...]`` master (tests). A cluster session without it is an error:
    a machine-local folder would not survive the loss of an executor.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="skein-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "skein", name)


def _tables_dir(spark: SparkSession) -> str:
    # written intermediates of this application only (release_scratch drops them)
    return scratch_path(spark, f"tables/{spark.sparkContext.applicationId}")


def materialize(df, name: str):
    """Write ``df`` once as parquet under the shared checkpoint folder and read it
    back: later branches read the written table instead of recomputing the
    lineage, and a lost executor costs a re-read, not a recompute."""
    import uuid

    path = os.path.join(_tables_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete this application's written intermediates (call when its results
    are consumed). Goes through the Hadoop file system of the folder, so it works
    on HDFS and object stores as well as locally; other applications' tables
    and stream checkpoints are left alone."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_tables_dir(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)
