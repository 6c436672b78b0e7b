"""Session settings and the shared folder for written intermediate data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    # All bounds and dates are UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Lookups beyond the broadcast limit become sort-merge joins on route or
    # vehicle; a hot key is then split at run time even if that costs a shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Size of joined, split and rebalanced partitions, and so of the written files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}
SHUFFLE_TASK_BYTES = 256 * 1024 * 1024
FEWEST_SHUFFLE_PARTITIONS = 200
UNKNOWN_SIZE_PARTITIONS = 4000
SPLIT_SETTING = "spark.sql.files.maxPartitionBytes"
#: Bytes of files that a task reads which sorts them: trips take thirty times their size as Parquet.
SORTED_SPLIT_BYTES = 16 * 1024 * 1024


def shuffle_partitions_for(shuffled_bytes: int) -> int:
    """Partitions that keep a shuffle task near 256 MB.

    AQE joins small partitions but does not split large ones, save in skewed
    joins and rebalanced writes, so the number must suit the largest shuffle:
    the days a merge rewrites, or a batch while it is deduplicated.
    """
    return max(FEWEST_SHUFFLE_PARTITIONS, -(-shuffled_bytes // SHUFFLE_TASK_BYTES))


def build_session(app_name: str = "ridemill", shuffled_bytes: int | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; `shuffled_bytes` is the size of the largest shuffle."""
    settings = {**SESSION_SETTINGS, **extra}
    if shuffled_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(shuffled_bytes))
    elif "spark.sql.shuffle.partitions" not in settings:
        # Of a size that is not known: begin with many, AQE joins those that turn out small.
        settings.setdefault("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(UNKNOWN_SIZE_PARTITIONS))
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """What runs inside reads files in splits of SORTED_SPLIT_BYTES at most.

    Spark deals files out by the number of cores, up to 128 MB to a task, so what a task
    sorts would grow with the table.
    """
    before = spark.conf.get(SPLIT_SETTING)
    if _bytes_of(spark, before) <= SORTED_SPLIT_BYTES:
        yield
        return
    spark.conf.set(SPLIT_SETTING, str(SORTED_SPLIT_BYTES))
    try:
        yield
    finally:
        spark.conf.set(SPLIT_SETTING, before)


def _bytes_of(spark: SparkSession, setting: str) -> int:
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting))


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as `spark.checkpoint.dir` names it.

    A local session without that setting gets a temporary folder; a cluster
    session without it is refused, as executors could not see each other's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="ridemill-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def names_in(spark: SparkSession, path: str) -> dict[str, int]:
    """The entries of a folder, one level deep, with their times of change in milliseconds."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(location):
        return {}
    return {entry.getPath().getName(): entry.getModificationTime() for entry in system.listStatus(location)}


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written anew."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = location.getFileSystem(spark._jsc.hadoopConfiguration()).create(location, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_note(spark: SparkSession, path: str) -> str:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = location.getFileSystem(spark._jsc.hadoopConfiguration()).open(location)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def rename_path(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file to a name in another folder; False if the name is taken."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(target).getParent())
    return not system.exists(path(target)) and system.rename(path(source), path(target))


def require_utc(spark: SparkSession) -> None:
    """Days and bounds are those of UTC; in another zone they would shift unseen."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"the session's time zone must be UTC, not {zone}")


def delete_path(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder once and go on from the written copy."""
    spark = df.sparkSession
    root = shared_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)
