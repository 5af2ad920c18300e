"""Session construction and shared-storage helpers.

Cluster jobs get their settings from the cluster; the builder here only fills
in what a local run (tests, bench) needs.  Scratch data is always written under
the shared folder named by ``spark.checkpoint.dir`` so that a lost executor can
be replaced without losing intermediate tables.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock, adaptive execution (runtime
# broadcast conversion, partition coalescing and skew splitting).  No static
# broadcast from plan *estimates*: a side is broadcast either after a proof of
# its size (operators.joins.dim_join) or by adaptive execution from the
# *measured* size of its shuffle output.  Partitioned writes keep a few files open
# instead of sorting their rows; a task with more partitions than that sorts the rest.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "contrail") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Runtime-settable SQL confs; safe to call on a session someone else built."""
    for k, v in CORE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked conf: keep the cluster's value
            pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only for local runs.

    On a cluster the folder must come from the cluster (``spark.checkpoint.dir``);
    a machine-local folder would vanish with the executor that wrote it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local_dir = tempfile.mkdtemp(prefix="contrail-ckpt-")
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir() or local_dir


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str):
    """Plans that run inside see another value of one runtime setting."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffle_width(spark: SparkSession, at_least: int):
    """Plans that run inside have that many shuffle partitions or more, so a task's share of a large input stays as it is."""
    key = "spark.sql.shuffle.partitions"
    return session_conf(spark, key, str(max(int(spark.conf.get(key)), at_least)))


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_or_none(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The Parquet table at ``path``, or None when the folder does not exist.  Every other failure is raised."""
    if not path_exists(spark, path):
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/contrail-tables/{name}-{uuid.uuid4().hex[:12]}"
