"""Session construction and the shared scratch area.

Everything that has to be written during a job (tables, checkpoints,
stream state) goes below the folder the cluster names in
``spark.checkpoint.dir``. Only when that is unset (local tests) do we pick
a fresh temporary folder ourselves.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Configuration a job wants on any cluster size. Shuffle partitions is only a
# starting point: AQE coalesces small partitions and splits skewed ones.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the planner broadcasts by its size statistics in bytes, AQE by measured bytes
    "spark.sql.autoBroadcastJoinThreshold": str(16 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MB = 1 << 20


def sizing_conf(input_bytes: int, cores: int, split_bytes: int = 256 * MB,
                shuffle_bytes: int = 128 * MB) -> dict[str, str]:
    """Partition sizing for an input of ``input_bytes`` on ``cores`` cores.

    Scan splits of ``split_bytes`` and shuffle partitions of about
    ``shuffle_bytes`` keep every task's working set well inside an executor
    core's memory share, so sorts and aggregations spill rarely. The initial
    shuffle width covers a shuffle as large as the input; AQE coalesces it to
    the advisory size when the real shuffle is smaller, and splits partitions
    over four times that size in skewed joins.
    """
    width = max(2 * cores, -(-input_bytes // shuffle_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * shuffle_bytes),
    }


def build_session(master: str | None = None, app: str = "keyflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  input_bytes: int | None = None, cores: int | None = None) -> SparkSession:
    """A session with the job's base configuration.

    Give ``input_bytes`` and ``cores`` on a cluster to size partitions for
    the data (``sizing_conf``); ``shuffle_partitions`` overrides the width.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if input_bytes and cores:
        conf.update(sizing_conf(input_bytes, cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # sessions without a local SparkContext (a remote client)
        return None


def default_parallelism(spark: SparkSession) -> int:
    """Cores of the cluster (``spark.default.parallelism`` without a context)."""
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    try:
        return int(spark.conf.get("spark.default.parallelism"))
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written intermediate tables.

    Read from the session (``spark.checkpoint.dir``); set a private temporary
    one only where the session has none, as in local tests.
    """
    sc = _context(spark)
    root = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            root = None
    if root:
        return root.rstrip("/")
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current.rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not re.match(r"local($|\[)", master or ""):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="keyflow-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir().rstrip("/")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the checkpoint root."""
    return f"{checkpoint_root(spark)}/keyflow/{name}-{uuid.uuid4().hex[:12]}"


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there, on any file system that Spark reaches."""
    fs, p = _folder(spark, path)
    return fs.exists(p)


def child_folders(spark: SparkSession, path: str, complete: bool = False) -> list[str]:
    """Names of the folders in ``path``, sorted; ``complete``: of finished writes only."""
    fs, p = _folder(spark, path)
    if not fs.exists(p):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
    return [n for n in names if not complete or path_exists(spark, f"{path}/{n}/_SUCCESS")]


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.delete(p, True)
