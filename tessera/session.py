"""SparkSession settings the library relies on.

Semantics that must not drift between runs are pinned here: ANSI casts (strict
text -> number, as the warehouse expects), a fixed session time zone (text
timestamps and date cuts), and AQE so that joins against dimensions of unknown
size are re-planned from measured shuffle sizes instead of guessed ones.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results; applied to every session we build.
SEMANTIC_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Settings that change plans only.
PLANNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A dimension is broadcast only when its *measured* shuffle output is under
    # this size (AQE re-plans a sort-merge join into a broadcast join).
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # Building a plan makes many Column calls; with DataFrame debugging on,
    # each also records its Python call site in the JVM (extra round trips).
    # Off, error messages lose that call-site context; results are unchanged.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``master`` is only for local runs and tests; on a cluster leave it None so
    the launcher's master is used.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**SEMANTIC_CONF, **PLANNING_CONF, **(extra or {})}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_semantics(spark)
    if master and master.startswith("local"):
        ensure_checkpoint_dir(spark)
    return spark


def apply_semantics(spark: SparkSession) -> None:
    """Pin the result-affecting settings on an existing session."""
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name a folder that the driver and all
    executors share. Only a local master may leave it unset; it gets a
    private scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not re.match(r"local($|\[)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def checkpointed(df):
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df, what: str = "table"):
    """Cut the lineage with a Parquet table in the shared folder; readers scan only the columns they use."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
