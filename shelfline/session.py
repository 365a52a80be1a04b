"""Session construction and the one place that decides where scratch data goes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "shelfline", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library expects: UTC, ANSI, adaptive execution.

    Adaptive execution supplies the skew-join split and the partition coalescing
    that the operators rely on; joins carry no broadcast hint unless the small
    side is a literal table, so the size check stays with the planner.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        # call-site capture costs several round trips to the JVM per column expression
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder the session names.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="shelfline-")
        spark.conf.set(CHECKPOINT_CONF, base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shuffle_width(spark: SparkSession) -> int:
    """The number of shuffle partitions the session is sized for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialize(df, name: str):
    """Write ``df`` to the shared folder and read it back, so that lineage is cut
    and a lost executor costs a re-read instead of a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
