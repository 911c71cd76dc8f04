"""Session helpers: a local session for tests and bench, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# Settings the library is designed for, on a cluster as locally.
# - AQE re-plans at run time: coalesces small shuffle partitions, splits skewed
#   join partitions, turns shuffle joins into broadcasts once a side is small.
# - Shuffle partitions start high (sized for the largest stage, ~256 MB each at
#   the target scale); AQE coalesces toward the advisory size.
# - The state of the stateful reports (`adpulse.streaming.stateful`) lives in RocksDB (off-heap, spills to local
#   disk, checkpointed incrementally) instead of executor heap maps.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "adpulse") -> SparkSession:
    """A local session with `CLUSTER_CONF`, sized for one machine (few shuffle partitions, no UI)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**CLUSTER_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions)}.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Read from `spark.checkpoint.dir`, which on a cluster names storage every
    executor sees. Only when it is unset in local mode (tests) a fresh folder
    under the system temp dir is made and set as the checkpoint dir of the
    session; on a cluster an unset value is an error, since a folder local to
    the driver is invisible to the executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext: the setting is all there is
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            raise RuntimeError("set spark.checkpoint.dir to a folder on storage shared by all executors")
        return base.rstrip("/")
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on storage shared by all executors")
        base = tempfile.mkdtemp(prefix="adpulse-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir()
    return base.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared folder (never reused, never cleared)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
