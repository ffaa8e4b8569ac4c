"""SparkSession construction and lineage helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces shuffle
# partitions at run time; skew-join splits a hot key's partition when a
# heavy user meets its one-row aggregate in a join back.
# Context settings: only at session creation.
CONTEXT_CONF = {
    "spark.ui.enabled": "false",
    # remove checkpoint files once nothing references them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# SQL settings: at creation, and again on a session that already existed.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Windows on user_id, (user_id, date) and (user_id, DateTime) share one
    # exchange on user_id instead of one exchange each.
    "spark.sql.requireAllClusterKeysForDistribution": "false",
}


def get_spark(app: str = "sessionlens", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster ``master`` stays None and the launcher decides; tests and
    the bench pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**CONTEXT_CONF, **DEFAULT_CONF}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in DEFAULT_CONF.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``. Only a local master (tests, a laptop)
    gets a private scratch folder when none is set; on a cluster a folder of
    one machine would lose data, so that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="sessionlens-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "sessionlens", f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again. For
    wide tables that are read often: a checkpoint keeps whole rows in Java's
    form, this keeps compressed columns and reads those that are asked for."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (never localCheckpoint):
    the result survives the loss of the executors that computed it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
