"""Session settings the engine relies on, and the shared folder for data that outlives one job."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # Extracts carry zone-less times; one fixed zone keeps text -> timestamp stable.
    "spark.sql.session.timeZone": "UTC",
    # Unreadable text in a typed column has to stop the run, not turn into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A repeated key inside a JSON object is unusual but still JSON.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# What a shuffle partition should hold, however large the input.
SHUFFLE_BYTES = 128 * 1024 * 1024
# Stored columns are encoded and compressed; a shuffle moves rows.
STORED_RATIO = 4


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the engine's expressions assume to a session made elsewhere."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def build(app: str = "admitflow", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for name, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def fit_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Start shuffles of an input of this size with enough partitions; adaptive execution merges what stays small."""
    name = "spark.sql.shuffle.partitions"
    wanted = math.ceil(input_bytes / SHUFFLE_BYTES)
    if wanted > int(spark.conf.get(name)):
        spark.conf.set(name, str(wanted))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, may fall back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="admitflow-")
    context.setCheckpointDir(folder)
    return folder


def enable_checkpoints(spark: SparkSession) -> None:
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
