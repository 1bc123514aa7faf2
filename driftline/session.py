"""Spark session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every operator assumes: UTC wall clock (timestamps are naive local
# times, so no zone shifts), ANSI SQL, adaptive execution for runtime
# re-planning (partition coalescing, skew-join splitting, broadcast only when
# the runtime size of a side is under the threshold).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "driftline", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster, call with ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the data (roughly input
    bytes / 128 MB), which AQE coalesces further at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor shares, as named by ``spark.checkpoint.dir``.

    It is read from the session. Only a local session, where driver and
    executors are one process, may do without it: then a temporary folder is
    set. On any other master an unset folder is an error, because a
    machine-local folder would be lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="driftline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh sub-folder of the shared folder; concurrent jobs never collide."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that nothing will read again."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df, name: str = "stage", fmt: str = "parquet"):
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor never forces recomputation of the
    upstream plan) and lets later stages that read the table several times
    scan a compact file instead of re-running the plan. One job.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).load(path)
