"""Session helpers.

The library never creates its own cluster settings on top of a running
session; ``get_session`` only fills in values that are unset, so a cluster
configuration (shuffle partitions, checkpoint dir, AQE) always wins.
"""

from __future__ import annotations


import tempfile

from pyspark.sql import SparkSession

# Settings a local run needs. On a cluster these come from the deployment.
_LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "orrery") -> SparkSession:
    """Return the active session or build a local one.

    ``master`` defaults to ``local[*]``.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.master(master or "local[*]").appName(app_name)
    for key, value in _LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only on a local master (tests) is a scratch folder chosen when the setting
    is absent; on a cluster a missing setting is an error, since a folder of
    the driver's own machine would be unseen by the executors. The folder is
    registered with the SparkContext, so ``DataFrame.checkpoint`` writes there
    (a reliable checkpoint survives executor loss).
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="orrery-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df, eager: bool = True):
    """Cut a long lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
