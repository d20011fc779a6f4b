"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every strata job relies on. They are runtime SQL confs, so they can
# be applied to a session someone else built (the driver's, a notebook's).
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key holding a third of the rows must not keep its partition in
    # one task: AQE splits a partition 5x the median and > 256 MB.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Broadcast what AQE has measured below 10 MB of rows. Plan statistics
    # count compressed file bytes and miss the rows that explode() makes, so
    # they decide for tables of a few hundred KB only; a wrong guess would
    # take the driver's memory with it.
    "spark.sql.autoBroadcastJoinThreshold": "256k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime defaults (idempotent) and return the session."""
    for key, value in RUNTIME_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with strata's defaults.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to
    about shuffle bytes / 128 MB; AQE coalesces the excess at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # checkpoint files of frames that are no longer referenced are removed
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; create a scratch one only when unset.

    A cluster names a shared folder in ``spark.checkpoint.dir`` and that one
    is always used. The scratch fallback exists for local tests only: on a
    cluster a machine-local folder would be seen by one machine.
    """
    existing = checkpoint_dir(spark)
    if existing:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(existing)
        return existing
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("STRATA_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint (never ``localCheckpoint``) into the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
