"""New landing files as micro-batches, each one run of the batch jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ridemill import schema as S
from ridemill.operators.validate import classify_trips
from ridemill.plans.batch import SilverResult, run_batch
from ridemill.sinks.run_metadata import first_attempt_time
from ridemill.sources.csv_trips import read_trips_csv, stream_trips_csv
from ridemill.streaming.poison import MOST_ATTEMPTS, begin_attempt, failing_files, files_of, read_ledger, set_aside


def batch_run_id(name: str, stream_id: str, batch_id: int) -> str:
    """`stream_id` is kept in the checkpoint: the same after a restart, another with a new checkpoint."""
    return f"wap_{name}_{stream_id}_{batch_id}".replace("-", "_")


def stream_silver(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    routes: DataFrame,
    vehicles: DataFrame,
    store,
    sink,
    quarantine_root: str,
    metadata_root: str,
    name: str = "trips",
    as_of: dt.datetime | str | None = None,
    max_files: int = 50,
    archive: str | None = None,
    schema=S.RAW_TRIPS,
    null_end: str = "strict",
    on_batch: Callable[[SilverResult], None] | None = None,
) -> StreamingQuery:
    """Work off the files that have arrived, at most `max_files` at a time, then stop.

    A batch counts as done only after gold has succeeded and its branch is
    published.  One that fails is given again with the same number, so it has
    the same run id and replaces what its first attempt left.  Unless `as_of` is
    given, rows are judged by the time of their batch's first attempt.

    A batch that has failed MOST_ATTEMPTS times is looked into: files that cannot be read and
    judged are found by halving, moved to `<quarantine_root>/set_aside/<run>` and noted, and the
    others go through.  If each file can be read, the fault lies elsewhere and the batch fails again.
    """

    def handle(rows: DataFrame, batch_id: int) -> None:
        run_id = batch_run_id(name, spark.sparkContext.getLocalProperty("sql.streaming.queryId"), batch_id)
        judged_at = as_of or first_attempt_time(spark, metadata_root, run_id)
        if begin_attempt(spark, metadata_root, run_id) > MOST_ATTEMPTS:
            rows = readable_rows(rows, batch_id, run_id, judged_at)
        result = run_batch(
            rows,
            routes,
            vehicles,
            store,
            sink,
            run_id,
            judged_at,
            quarantine_root,
            metadata_root,
            null_end,
        )
        if on_batch is not None:
            on_batch(result)

    def readable_rows(rows: DataFrame, batch_id: int, run_id: str, judged_at: dt.datetime | str) -> DataFrame:
        def probe(files: list[str]) -> None:
            raw = read_trips_csv(spark, files, schema)
            classify_trips(raw, routes, vehicles, run_id, judged_at).write.format("noop").mode("overwrite").save()

        files = files_of(spark, checkpoint, batch_id)
        bad = failing_files(files, probe)
        known = read_ledger(spark, metadata_root, run_id)["set_aside"]
        if not bad and not known:
            return rows
        set_aside(spark, metadata_root, run_id, bad, f"{quarantine_root}/set_aside/{run_id}")
        left = [f for f in files if f not in {*bad, *known}]
        return read_trips_csv(spark, left, schema) if left else spark.createDataFrame([], rows.schema)

    return (
        stream_trips_csv(spark, landing, schema, max_files, archive)
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(handle)
        .start()
    )
