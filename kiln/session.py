"""Session helpers: a session builder for local runs and checkpoint-dir resolution."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every kiln job relies on: runtime re-planning (AQE) with partition
# coalescing and skew-join splitting, and UTC so timestamps render the same everywhere.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Delete checkpoint files once the checkpointed data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app_name: str = "kiln",
                  extra_conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with kiln's defaults. Cluster deployments usually
    pass their own master and size ``shuffle_partitions`` to the data volume."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring the context if needed.

    Order of preference: the folder already set on the SparkContext, then the
    session's ``spark.checkpoint.dir`` setting (the shared folder a cluster names).
    Only a local-mode session with neither gets a fresh scratch folder of its own;
    on a cluster a missing setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: point it at a shared folder of the cluster")
    scratch = tempfile.mkdtemp(prefix="kiln-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def reliable_checkpoint(df):
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Unlike a local checkpoint, the files survive the loss of the executor that
    wrote them. The physical partitioning of ``df`` is kept, so a later join on
    the same keys does not shuffle again.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
