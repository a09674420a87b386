"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every plan of this package is written for.
RUNTIME_CONF = {
    # Snapshot dates are calendar dates; never let a session zone move them.
    "spark.sql.session.timeZone": "UTC",
    # Re-plan at run time: size-checked broadcasts, merged small partitions, split hot join keys.  The join split is
    # forced because most joins here feed an operator with the same keys, where Spark would otherwise keep a hot
    # partition whole to save a shuffle.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # HotSpot never compiles methods above 8000 bytes of bytecode; wide cleaning projections fused into one method would
    # run interpreted.  Beyond the limit Spark splits them by operator instead, which is about three times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Joins shuffle on all of their keys (Spark's default, pinned): reusing a coarser partitioning would gather a whole
    # group, however large, in one task where these plans spread it over value ranges.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller owns."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "creditloom") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    return tune(builder.getOrCreate())


_HANDED_OUT: list[str] = []


@functools.cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="creditloom-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, on storage every executor can reach.

    The cluster names that storage in ``spark.checkpoint.dir``.  Only a local session without the setting falls
    back to the machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_root()
    folder = f"{root.rstrip('/')}/creditloom/{label}-{uuid.uuid4().hex}"
    _HANDED_OUT.append(folder)
    return folder


def clean(spark: SparkSession) -> None:
    """Delete every scratch folder handed out so far.  Results that still read one must have been written before."""
    remove(spark, *_HANDED_OUT)
    _HANDED_OUT.clear()


def remove(spark: SparkSession, *folders: str) -> None:
    """Delete scratch folders through the file system they live on."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
