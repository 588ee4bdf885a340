"""Session construction and the shared scratch location.

Library code never invents a machine-local folder: anything it must
materialise (lineage cuts, demo tables written by registered queries)
goes under the cluster's ``spark.checkpoint.dir``.  Only when that is
unset (unit tests, a laptop) do we set one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package assumes.  UTC keeps date arithmetic
# and the ``ingest_date`` partition stable; ANSI mode makes bad casts and
# overflowing decimals fail loudly instead of turning into NULL.
SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # AQE merges small shuffle partitions up to this size; at cluster scale
    # partitions are far larger, while small stages keep several tasks for
    # the CPU-bound window work instead of collapsing into one
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = "local[*]",
    shuffle_partitions: int | None = 8,
    app_name: str = "tickhouse",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults applied.

    ``master=None`` and ``shuffle_partitions=None`` leave both to the
    cluster (spark-submit); the defaults suit local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Falls back to a fresh temporary folder only when the setting is absent,
    which happens in unit tests and local runs, never on a configured
    cluster.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
            "spark.checkpoint.dir", None
        )
    if not root:
        if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tickhouse-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def new_scratch_dir(spark: SparkSession, name: str) -> str:
    """A unique, not yet existing folder under the scratch root."""
    return f"{scratch_root(spark)}/tickhouse/{name}-{uuid.uuid4().hex[:12]}"
