from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from ridemill.llm import exact_dedup, frames, near_dedup, packing, substring_dedup

from . import cases


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(frames.SHUFFLE_CLEANUP, None)
    rows = spark.range(50_000).groupBy((F.col("id") % 1000).alias("key")).agg(F.sum("id").alias("n"))
    scratch = frames.Scratch(spark)
    one, other = frames.written(rows, "rows"), scratch.written(rows.withColumn("n", F.col("n") + 1), "rows")
    assert shuffle_files(spark) <= before
    assert spark.conf.get(frames.SHUFFLE_CLEANUP, None) == setting
    # Neither the tables nor what they were written from is lost.
    assert one.count() == other.count() == rows.count() == 1000


def batch_rows(spark):
    schema = pa.schema([("n", pa.int64())])
    rows = spark.range(5000).coalesce(1).mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], schema=schema) for b in batches), "n long")
    return max(r.n for r in frames.written(rows, "batches").collect())


def test_python_workers_get_few_rows_at_once(spark):
    setting = spark.conf.get(frames.BATCH_SETTING)
    assert batch_rows(spark) > frames.TEXT_ROWS
    with frames.small_batches(spark):
        assert batch_rows(spark) <= frames.TEXT_ROWS
        with frames.small_batches(spark):
            assert batch_rows(spark) <= frames.TEXT_ROWS
        assert batch_rows(spark) <= frames.TEXT_ROWS
    assert spark.conf.get(frames.BATCH_SETTING) == setting


def test_operators_that_hold_texts_take_few_at_once(spark, monkeypatch):
    held = {}

    def noted(df, label):
        held[label] = int(spark.conf.get(frames.BATCH_SETTING))
        return frames.written(df, label)

    for module in (exact_dedup, near_dedup, packing, substring_dedup):
        monkeypatch.setattr(module, "written", noted)
    docs = cases.table(spark, [(i, cases.prose(i % 3, 60)) for i in range(6)])
    for operator in (exact_dedup.exact_dedup, near_dedup.near_dedup, packing.packed, substring_dedup.cut_repeats):
        assert operator(docs).count() > 0
    for label in ("exact-rows", "exact-differing", "near-links", "pieces", "runs", "windows"):
        assert held[label] <= frames.TEXT_ROWS, label
    assert int(spark.conf.get(frames.BATCH_SETTING)) > frames.TEXT_ROWS
