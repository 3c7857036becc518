"""Session construction and lineage-cut helpers."""

from __future__ import annotations

import functools
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job in the library assumes. They are applied only when the
# caller builds the session through ``build_session``; on a cluster the
# deployment supplies the same keys.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "repolens",
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    # Partition discovery of many directories: one listing task per few
    # directories, not one per directory (the default allows 10000 tasks).
    conf["spark.sql.sources.parallelPartitionDiscovery.parallelism"] = str(max(8, 2 * shuffle_partitions))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, executors_cores: int, partition_bytes: int = 256 << 20) -> dict:
    """Settings sized to the data, for cluster runs.

    Shuffle partitions start at ``input_bytes / partition_bytes`` (at least
    2x the cores so every core has work) and AQE coalesces them down to
    ``partition_bytes`` at run time, so each reducer task stays well inside
    executor memory; scan splits use the same size. A skewed partition
    (> 4x the median and > 1 GiB) is split by AQE's skew-join handling.
    For 100 TB with 256 MiB partitions that is ~400k initial partitions.
    """
    n = max(2 * executors_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        # Broadcast only what is provably small: the planner's estimate is
        # checked against this bound before a join is broadcast.
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(2 * executors_cores),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when it is unset (local tests)
    a fresh scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="repolens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its own file system; any failure to ask is raised."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def swap_partitions(spark: SparkSession, staging: str, path: str, depth: int) -> None:
    """Put each partition folder of ``staging``, ``depth`` levels down, in the place of its like in ``path`` by
    renames, and delete ``staging``. An old folder is moved aside, out of readers' sight, until the new one is
    there. One rename a rebuilt partition, whatever the rows."""
    jvm = spark.sparkContext._jvm
    target, source = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(staging)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    level = [("", source)]
    for _ in range(depth):
        level = [(f"{name}/{s.getPath().getName()}".lstrip("/"), s.getPath()) for name, p in level for s in fs.listStatus(p) if "=" in s.getPath().getName()]
    aside = jvm.org.apache.hadoop.fs.Path(source, "_replaced")
    for name, folder in level:
        place = jvm.org.apache.hadoop.fs.Path(target, name)
        old = jvm.org.apache.hadoop.fs.Path(aside, name)
        if fs.exists(place):
            fs.mkdirs(old.getParent())
            if not fs.rename(place, old):
                raise OSError(f"{place.toString()} can't be moved aside")
        else:
            fs.mkdirs(place.getParent())
        if not fs.rename(folder, place):
            raise OSError(f"{folder.toString()} can't be moved to {place.toString()}")
    fs.delete(source, True)


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A unique folder under the shared checkpoint location for written
    intermediates (never a machine-local temp folder)."""
    base = ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    import uuid

    path = f"{base}/repolens-{name}-{uuid.uuid4().hex[:12]}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


#: Folders named inside the jobs that are running, innermost last.
_OPEN: list[list[str]] = []


def own_scratch(job):
    """A job (first argument: a session, or a DataFrame of one) whose result is written when it ends: the
    intermediates that it wrote are deleted then, whether it ends well or not."""

    @functools.wraps(job)
    def run(first, *args, **kwargs):
        spark = first if isinstance(first, SparkSession) else first.sparkSession
        _OPEN.append([])
        try:
            return job(first, *args, **kwargs)
        finally:
            for path in _OPEN.pop():
                p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    return run


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder
    and return its read-back.

    Survives executor loss (unlike ``cache`` or a local checkpoint) and keeps
    the plan of downstream consumers short. Parquet rather than an RDD
    checkpoint: compressed columnar files, and every consumer reads only its
    columns, with its filters pushed into the scan.
    """
    path = shared_scratch(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
