"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(app: str = "cartflow", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or fetch) a session: UTC, adaptive execution with skew splitting.

    Shuffle width is left to adaptive coalescing; pass
    ``**{"spark.sql.shuffle.partitions": "..."}`` to set it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only where the setting is absent and the session runs on a single machine (tests) is a
    fresh temporary folder made for it; on a cluster that is an error, as executors would
    each write to a disk of their own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if current is None:
        if not configured and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = configured or tempfile.mkdtemp(prefix="cartflow-")
        context.setCheckpointDir(current)
    return configured or current


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder name below the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialise(df, eager: bool = True):
    """Reliable checkpoint: fixes the rows and partitions of ``df`` and cuts its lineage."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager)


def without_plan(df):
    """The rows and partitions of ``df`` under a plan of one step; its lineage is kept.

    Spark lists the plans below a persisted table with every query that reads it, and the driver keeps the lists of the
    last thousand queries; so a chain of persisted tables, each made from the one before, is cut here at each.
    """
    rows = df._jdf.queryExecution().toRdd()
    return type(df)(df._jdf.sparkSession().internalCreateDataFrame(rows, df._jdf.schema(), False), df.sparkSession)
