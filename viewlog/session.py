"""Spark session settings and the shared work folder."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Shuffle partitions are left to the caller:
# AQE coalesces small shuffles and splits skewed ones at run time.
BASE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Broadcast joins only from sizes measured at run time (AQE), never from
    # plan-time estimates.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    # Partition values such as "02" must stay strings on read (AppName).
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Suggested additions for large clusters (pass as ``extra`` or spark-submit
# --conf). Partition sizes keep reducers and Arrow batches well inside
# executor memory; decommissioning migrates shuffle files off executors that
# are being lost, and speculation re-runs stragglers.
CLUSTER_CONF: dict[str, str] = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.speculation": "true",
    "spark.task.maxFailures": "8",
    # Concurrent report jobs share executors fairly (each runs in a pool of its own).
    "spark.scheduler.mode": "FAIR",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "viewlog", extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 128 * 1024 * 1024,
                           floor: int = 8) -> int:
    """Initial shuffle partition count so each reducer starts near ``target_bytes``.

    AQE coalesces small partitions afterwards, so erring high is cheap;
    erring low makes reducers spill.
    """
    return max(floor, -(-int(input_bytes) // target_bytes))


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[int | None]:
    """AQE's initial shuffle partition count from the input size, for one run.

    An explicit user setting stays in force; the session is left as it was.
    """
    if spark.conf.get(INITIAL_PARTITIONS, None):
        yield None
        return
    n = max(shuffle_partitions_for(input_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set(INITIAL_PARTITIONS, str(n))
    try:
        yield n
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must exist: a machine-local folder would vanish
    with the executor that wrote it. Only a local-mode session (tests, bench)
    gets a fresh folder under the system temp dir when it is unset.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: only the conf is visible
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        return current
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="viewlog-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Arrow batches to and from Python hold about ``size`` of rows, unless the session sets another size itself.

    Spark's default is 64 MB. A batch is held by the JVM, outside its heap and in
    buffers rounded up, and by the Python worker, in every task at once.
    """
    if spark.conf.get(BATCH_BYTES) == _DEFAULT_BATCH:
        spark.conf.set(BATCH_BYTES, size)


_DEFAULT_BATCH = "67108864b"
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once per application.

    Python functions travel to the workers as module references, so a worker
    that does not start in the repository folder needs the modules themselves.
    Nothing is sent when the package already runs from a shipped archive
    (``spark-submit --py-files``).
    """
    root = os.path.dirname(os.path.abspath(__file__))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or not os.path.isdir(root):
        return
    files = sorted(os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".py"))
    digest = hashlib.sha256()
    for f in files:
        with open(f, "rb") as src:
            digest.update(src.read())
    archive = os.path.join(tempfile.mkdtemp(prefix="viewlog-ship-"), f"viewlog-{digest.hexdigest()[:12]}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in files:
            z.write(f, os.path.join("viewlog", os.path.relpath(f, root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location for an intermediate table in the shared folder.

    It is deleted when the application ends.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/viewlog-work/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run inside delete their shuffle files when they end, not when the driver's garbage collection finds them unused."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` as a table in the shared work folder: computed once, lineage cut.

    The files survive the loss of any executor; later steps read only the
    columns they need. ``compression="none"`` suits hashes, which do not get
    smaller, and spares the codec's native buffers for every file and column.
    """
    path = work_path(df.sparkSession, name)
    with _shuffles_dropped(df.sparkSession):
        df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Deletes the files of a ``written`` table that nothing reads any more, before the application ends."""
    spark = df.sparkSession
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
