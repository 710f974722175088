"""Session set-up shared by tests, the bench and scripts.

Library operators never create sessions; they take DataFrames.  This module
only builds a session for local runs and resolves the checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is small), splits skewed join
# partitions and coalesces small shuffle partitions.  The runtime bloom
# filter prunes the big side of a selective join before the shuffle.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Delete checkpoint files once the DataFrames that wrote them are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def sized_conf(input_bytes: int, cores: int, target_split: int = 256 << 20,
               target_shuffle_block: int = 128 << 20) -> dict[str, str]:
    """Settings sized to the input so every task's data fits in memory.

    * scan splits of ``target_split`` bytes (fewer, larger tasks on big inputs;
      at least two splits per core on small ones);
    * an initial shuffle width of about one partition per
      ``target_shuffle_block`` bytes of input, never below twice the cores -
      AQE then coalesces partitions that come out small.

    At 100 TB this gives ~400k scan tasks and ~800k initial shuffle
    partitions, coalesced by AQE to ~128 MB each.
    """
    per_core = max(1, input_bytes // max(1, 2 * cores))
    split = max(4 << 20, min(target_split, per_core))
    shuffle = max(2 * cores, input_bytes // target_shuffle_block)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_shuffle_block),
    }


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local or cluster session with the scale settings above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    # Python workers must import this package (mapInArrow steps): point them
    # at its folder.  On a cluster ship it with --py-files instead.
    pkg_root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [pkg_root] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    conf["spark.executorEnv.PYTHONPATH"] = os.pathsep.join(dict.fromkeys(paths))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` (the cluster's shared folder).  Only
    when a local session has none - tests - a fresh temporary folder is set,
    so that ``DataFrame.checkpoint()`` works there too; on a cluster a missing
    setting raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's configuration applies
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: give a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table or tree in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
