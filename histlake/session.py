"""Session settings and the shared scratch folder.

The library never picks a machine-local folder on its own: staged data goes
under ``spark.checkpoint.dir`` (a folder every executor can reach).  Only
when that setting is missing -- local runs and tests -- do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that suit the workload: partitioned parquet tables, skewed keys,
# joins whose small side is only known at run time.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast only on measured sizes: never from the planner's file-size
    # estimates, but AQE may switch a join after measuring the shuffle output
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "histlake", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with :data:`RECOMMENDED_CONF`; ``master`` only for local use."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    If the session has none, a local-mode session (a test, a laptop) gets a
    fresh temporary folder, registered so ``DataFrame.checkpoint`` works as
    well; any other master is refused.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach; "
                             "staged data never goes to a machine-local folder on a cluster")
        root = tempfile.mkdtemp(prefix="histlake-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def new_run_dir(spark: SparkSession, label: str = "run") -> str:
    """A folder of its own for one run: staged results never collide."""
    return f"{checkpoint_root(spark)}/histlake/{label}-{uuid.uuid4().hex[:12]}"
