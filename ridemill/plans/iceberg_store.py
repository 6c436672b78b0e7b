"""The same store on Iceberg tables, for sessions that have the extension.

No Iceberg jar is part of the test environment: only the statements and calls
made here are tested, against a recording session.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import partitioning

from ridemill import schema as S
from ridemill.operators.metrics import observe_batch
from ridemill.plans.parquet_store import ACTIVE, HISTORY, MAIN, SORT

RETAIN_DAYS = 5


class IcebergTripStore:
    """Tables `<catalog>.<database>.<prefix>active` and `...history`."""

    def __init__(self, spark: SparkSession, catalog: str, database: str, prefix: str = "silver_trips_"):
        self.spark = spark
        self.catalog = catalog
        self.database = database
        self.prefix = prefix
        self.staged_days: dict[str, tuple[str | None, str | None]] = {}

    def init_tables(self, like: DataFrame) -> None:
        for name in (ACTIVE, HISTORY):
            if self.spark.catalog.tableExists(self.table(name)):
                continue
            empty = like.limit(0).writeTo(self.table(name)).using("iceberg")
            empty.tableProperty("format-version", "2").partitionedBy(partitioning.days("start_time")).create()
            self.spark.sql(f"ALTER TABLE {self.table(name)} WRITE ORDERED BY {', '.join(SORT[name])}")

    def read(self, name: str, branch: str = MAIN, days: Iterable[dt.date] | None = None) -> DataFrame:
        """The table as a branch sees it; `days` become a condition that prunes its partitions."""
        reader = self.spark.read.format("iceberg")
        if branch != MAIN:
            reader = reader.option("branch", branch)
        rows = reader.load(self.table(name))
        days = sorted(days or ())
        return rows.where(_in_days(F.col("start_time"), days[0], days[-1])) if days else rows

    def append_history(self, branch: str, rows: DataFrame) -> dict:
        """Stage the batch in place of the run's own rows.

        A branch made from a main that has the run already, as after a publish that was
        not acknowledged, would hold its rows twice if they were appended.
        """
        _refuse_main(branch)
        self._stage_branch(HISTORY, branch)
        observed, metrics = observe_batch(rows)
        observed.writeTo(self._at(HISTORY, branch)).overwrite(F.col(S.RUN_COLUMN) == branch)
        found = metrics.get
        self.staged_days[branch] = (found["start_date"], found["end_date"])
        return found

    def batch_rows(self, branch: str) -> DataFrame:
        """The run's rows of history; the days seen while staging prune the table."""
        _refuse_main(branch)
        own = self.read(HISTORY, branch).where(F.col(S.RUN_COLUMN) == branch)
        first, last = self.staged_days.get(branch, (None, None))
        if first is not None and last is not None:
            own = own.where(_in_days(F.col("start_time"), dt.date.fromisoformat(first), dt.date.fromisoformat(last)))
        return own.withColumn(S.DAY_COLUMN, F.to_date("start_time"))

    def merge_active(
        self,
        branch: str,
        source: DataFrame,
        days: list[dt.date],
        null_end: str = "strict",
        source_fits_broadcast: bool = False,
    ) -> None:
        """MERGE into the branch; the day bounds in the condition prune the target.

        Iceberg plans the join itself, so `source_fits_broadcast` only adds a hint.
        """
        self._stage_branch(ACTIVE, branch)
        rows = source.drop(S.DAY_COLUMN)
        rows = (F.broadcast(rows) if source_fits_broadcast else rows).alias("source")
        target = self._at(ACTIVE, branch)
        name = target.rsplit(".", 1)[1]
        merge = rows.mergeInto(target, _same_trip(name, min(days), max(days)))
        merge.whenMatched(_replaces(name, null_end)).updateAll().whenNotMatched().insertAll().merge()

    def publish(self, branch: str) -> None:
        if branch == MAIN:
            return
        for name in (ACTIVE, HISTORY):
            self.spark.sql(
                f"CALL {self.catalog}.system.fast_forward("
                f"table => '{self.database}.{self.prefix}{name}', branch => '{MAIN}', to => '{branch}')"
            )

    def rebase(self, branch: str) -> list[dt.date]:
        """Nothing: a branch whose main has moved on is refused by `fast_forward`."""
        return []

    def is_current(self, branch: str) -> bool:
        return True

    def versions(self, branch: str, days: Iterable[dt.date]) -> None:
        """Days have no version of their own here."""
        return None

    def table(self, name: str) -> str:
        return f"{self.catalog}.{self.database}.{self.prefix}{name}"

    def _at(self, name: str, branch: str) -> str:
        return self.table(name) if branch == MAIN else f"{self.table(name)}.branch_{branch}"

    def _stage_branch(self, name: str, branch: str) -> None:
        if branch != MAIN:
            self.spark.sql(
                f"ALTER TABLE {self.table(name)} CREATE OR REPLACE BRANCH `{branch}` RETAIN {RETAIN_DAYS} DAYS"
            )


def _same_trip(target: str, first: dt.date, last: dt.date) -> Column:
    start = F.col(f"{target}.start_time")
    same = (F.col(f"{target}.trip_id") == F.col("source.trip_id")) & (start == F.col("source.start_time"))
    return same & _in_days(start, first, last)


def _in_days(start: Column, first: dt.date, last: dt.date) -> Column:
    after = last + dt.timedelta(days=1)
    return (start >= F.lit(first.isoformat()).cast("date")) & (start < F.lit(after.isoformat()).cast("date"))


def _refuse_main(branch: str) -> None:
    """Rows of `main` are those of all such runs: a batch cannot be told from earlier ones."""
    if branch == MAIN:
        raise ValueError(f"the Iceberg store stages runs on branches; {MAIN} is not one")


def _replaces(target: str, null_end: str) -> Column:
    ends_later = F.col("source.end_time") >= F.col(f"{target}.end_time")
    if null_end == "open":
        ends_later = F.col(f"{target}.end_time").isNull() | ends_later
    completes = F.col("source.status") == S.STATUS_COMPLETED
    return ends_later & ((F.col(f"{target}.status") != S.STATUS_COMPLETED) | completes)
