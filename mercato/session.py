"""Session helpers.

Builders never create a session; they take DataFrames.  These helpers exist for
tests, the bench and the pipeline entry point.  On a cluster the session comes
from ``spark-submit`` and only ``tune`` is applied.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that every job relies on.  AQE re-plans joins at shuffle boundaries
# (broadcast when the runtime size is small, split skewed partitions of
# sort-merge joins) and coalesces small shuffle partitions.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Results must not depend on the reader's time zone.
    "spark.sql.session.timeZone": "UTC",
}


MB = 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 100_000


def scale_conf(input_bytes: int, target_partition_mb: int = 256,
               shuffle_share: float = 0.5) -> dict[str, str]:
    """Size scans and shuffles from the input volume.

    * Scan splits of ``target_partition_mb`` (columnar Parquet reads only the
      selected columns, so a split decodes far less than its byte size).
    * Shuffle partitions sized so the widest shuffle (about ``shuffle_share``
      of the input after pruning and partial aggregation) lands near
      ``target_partition_mb`` per partition; AQE starts from that number and
      coalesces small stages, and splits partitions that still come out skewed.
    * Capped at ``MAX_SHUFFLE_PARTITIONS``: beyond that every map task writes
      too many tiny blocks.  100 TB with the defaults: 100,000 initial shuffle
      partitions of ~500 MB for the widest shuffle, inside a few GB of
      executor memory per core, so sorts and aggregations spill rarely.
    """
    partitions = max(200, min(MAX_SHUFFLE_PARTITIONS,
                              int(input_bytes * shuffle_share / (target_partition_mb * MB))))
    return {
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * target_partition_mb}m",
    }


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings (and, given the input size, the sizing) to a session."""
    conf = dict(RUNTIME_CONF)
    if input_bytes:
        conf.update(scale_conf(input_bytes))
    for key, value in conf.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; leaving it unset there is an error.  Only a local-mode session (tests,
    the bench) gets a fresh scratch folder when it is unset.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # e.g. a Spark Connect session: no SparkContext handle
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage: "
                               "checkpoints and scratch tables must survive executor loss")
        configured = tempfile.mkdtemp(prefix="mercato-ckpt-")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", configured)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def parallelism(spark: SparkSession) -> int:
    """Cores the session can use at once (falls back to the shuffle width)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shuffle_width(spark: SparkSession) -> int:
    """The number of shuffle partitions the session was sized with (see ``scale_conf``)."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "mercato") -> SparkSession:
    """A local session for tests and the bench (UI off, no ports beyond Spark's own)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    shuffle_partitions = shuffle_partitions or cores
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MERCATO_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # the embedded JDBC test database would otherwise write derby.log to the cwd
        .config("spark.driver.extraJavaOptions", "-Dderby.stream.error.file=/dev/null")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    event_dir = os.environ.get("MERCATO_EVENT_LOG_DIR")
    if event_dir:  # stage/task timings for offline analysis (no UI, no server)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark
