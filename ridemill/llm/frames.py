"""What the corpus operators share: the text column as bytes, words, scratch tables.

An operator selects the columns it needs by name, so extra columns of its input,
whatever they are called, never meet its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridemill.session import delete_path, scratch_path

#: Python's `bytes.split()` cuts at exactly these bytes, which the contracts call white space.
WHITE_SPACE = b" \t\n\x0b\x0c\r"
#: Setting of Spark that removes the shuffle files of an execution at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Setting of Spark: rows that go to a Python worker at once.
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of texts that go there at once: a task holds them, and what is made of them, both in the JVM and in Python.
TEXT_ROWS = 1024
#: Rows of a bucket that is ranked in one task.
BUCKET_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bodies(docs: DataFrame, *more: str) -> DataFrame:
    """`doc_id` as a long and the whole text as UTF-8 bytes, with the columns `more`."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("body"), *more)


def write_parquet(df: DataFrame, path: str) -> None:
    """Write `df` once; its shuffle files go with the end of the write, not when the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(SHUFFLE_CLEANUP)
        else:
            conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is executed inside sends at most TEXT_ROWS rows to a Python worker at once."""
    before = spark.conf.get(BATCH_SETTING)
    if 0 < int(before) <= TEXT_ROWS:
        yield
        return
    spark.conf.set(BATCH_SETTING, str(TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written once as Parquet to the shared folder and read again: lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    write_parquet(df, path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables of one operator that are removed once others have replaced them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def written(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        write_parquet(df, path)
        found = self.spark.read.schema(df.schema).parquet(path)
        self.paths[found] = path
        return found

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that nothing reads any more."""
        for table in tables:
            delete_path(self.spark, self.paths.pop(table))


class Buckets:
    """Tables stored in buckets of a key in the shared folder, under names of their own until closed.

    What groups by the key, or joins two of them by it, needs no shuffle.
    """

    def __init__(self, spark: SparkSession, key: str, count: int):
        self.spark, self.key, self.count, self.stored = spark, key, count, {}

    def store(self, rows: DataFrame) -> DataFrame:
        name, place = f"buckets_{uuid.uuid4().hex}", scratch_path(self.spark, "buckets")
        self.stored[name] = place
        rows.write.option("path", place).bucketBy(self.count, self.key).sortBy(self.key).saveAsTable(name)
        return self.spark.table(name)

    def close(self) -> None:
        for name, place in self.stored.items():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete_path(self.spark, place)


def ranked(rows: DataFrame, by: list[str], order: list[str], bucket: Column, name: str) -> DataFrame:
    """`rows` with their rank `name`, from 0, among those with equal `by`: by bucket, then by `order` inside it.

    Buckets are counted, the counts summed up, and rows numbered inside their bucket.
    """
    rows = rows.withColumn("rank_bucket", bucket)
    counts = rows.groupBy(*by, "rank_bucket").agg(F.count(F.lit(1)).alias("rank_rows"))
    before = Window.partitionBy(*by).orderBy("rank_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, "rank_bucket", F.coalesce(F.sum("rank_rows").over(before), F.lit(0)).alias("rank_start"))
    inside = F.row_number().over(Window.partitionBy(*by, "rank_bucket").orderBy(*order)) - 1
    found = rows.withColumn("rank_inside", inside).join(starts, [*by, "rank_bucket"])
    return found.withColumn(name, F.col("rank_start") + F.col("rank_inside")).drop("rank_bucket", "rank_inside", "rank_start")


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples, column by column as Python values."""
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples gathered into Arrow batches of at most `size` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def parts_of(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of fewer rows, as the words of many texts take several times their size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class Memo(dict):
    """A word's value, computed when first asked for; emptied when it holds `most` words."""

    def __init__(self, compute, most: int = 500_000):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.compute(word)
        return value
