"""Session helpers: build a session, and find the shared scratch folder.

On a cluster the shared folder is the one named by ``spark.checkpoint.dir``;
it is read from the session and never replaced.  Only when it is unset (a
bare local session, e.g. in tests) do we create one of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Local sessions handle small inputs: a small advisory size keeps every
    # core busy after AQE coalescing (scale_conf() sets 256 MB for clusters).
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # plans of hundreds of columns: no call-site lookup for every column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # HotSpot does not compile methods beyond 8000 bytes; stages of many conversions
    # then run better operator by operator than as one interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "saleslake") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            configured = None
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # A local test session: driver and executors are one process.  A fresh folder per session.
        configured = tempfile.mkdtemp(prefix="saleslake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/saleslake/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) for ``path`` through Spark's own Hadoop configuration."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of data on a cluster.

    Shuffle partitions are sized so that each holds about
    ``target_partition_bytes`` before AQE coalescing (and never fewer than
    two waves of tasks); scans split at 256 MB; AQE splits skewed shuffle
    partitions and rebalanced writes.
    """
    slots = max(1, executors * cores_per_executor)
    parts = max(2 * slots, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.task.maxFailures": "8",
    }
