from __future__ import annotations

import pytest
from pyspark.sql import DataFrameWriter

from ridemill import schema as S
from ridemill.sinks import GoldWrite, JdbcGoldSink, ParquetGoldSink
from ridemill.sinks.jdbc import create_statement, delete_statement, insert_statement

WEEKLY = "calculation_date date, route_rank int, route_id string, total_trips bigint, total_completed_trips bigint, avg_trip_duration_minutes double"


def weekly(spark, *days):
    import datetime as dt

    rows = [(dt.date.fromisoformat(d), 1, r, 1, 1, 2.0) for d, r in days]
    return spark.createDataFrame(rows, WEEKLY)


def test_files_replace_exactly_the_range(spark, tmp_path):
    sink = ParquetGoldSink(spark, str(tmp_path))
    old = weekly(spark, ("2025-01-01", "R1"), ("2025-01-02", "R1"), ("2025-01-03", "R1"), ("2025-01-04", "R1"))
    sink.replace([GoldWrite(S.GOLD_WEEKLY, old, "2025-01-01", "2025-01-04")])
    new = weekly(spark, ("2025-01-02", "R2"), ("2025-01-02", "R3"))
    for _ in range(2):
        sink.replace([GoldWrite(S.GOLD_WEEKLY, new, "2025-01-02", "2025-01-03")])
        found = sorted((str(r["calculation_date"]), r["route_id"]) for r in sink.read(S.GOLD_WEEKLY).collect())
        assert found == [("2025-01-01", "R1"), ("2025-01-02", "R2"), ("2025-01-02", "R3"), ("2025-01-04", "R1")]
    sink.replace([GoldWrite(S.GOLD_WEEKLY, new.limit(0), "2025-01-01", "2025-01-31")])
    assert sink.read(S.GOLD_WEEKLY).count() == 0


class Connection:
    """Records what a JDBC connection is asked to do; can fail at a statement."""

    def __init__(self, fail_at: str | None = None):
        self.log: list[str] = []
        self.fail_at = fail_at

    def setAutoCommit(self, on):
        self.log.append(f"autocommit {on}")

    def createStatement(self):
        return self

    def execute(self, sql):
        if self.fail_at and sql.startswith(self.fail_at):
            raise RuntimeError("refused")
        self.log.append(sql)

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def writes():
    return [GoldWrite(t, None, "2025-01-01", "2025-01-03") for t in S.GOLD_TABLES]


def test_transaction_creates_replaces_drops_and_commits():
    connection = Connection()
    JdbcGoldSink(None, "jdbc:x", {}, connect=lambda: connection).publish(writes())
    kinds = [line.split()[0] for line in connection.log]
    assert kinds == ["autocommit", *["CREATE"] * 3, *["DELETE", "INSERT"] * 3, *["DROP"] * 3, "commit", "close", "close"]
    assert connection.log[0] == "autocommit False"


@pytest.mark.parametrize("statement", ["CREATE", "DELETE", "INSERT", "DROP"])
def test_failed_statement_rolls_everything_back(statement):
    connection = Connection(statement)
    with pytest.raises(RuntimeError):
        JdbcGoldSink(None, "jdbc:x", {}, connect=lambda: connection).publish(writes())
    assert "commit" not in connection.log
    assert connection.log[-3:] == ["close", "rollback", "close"]


def test_statements():
    assert create_statement(S.GOLD_WEEKLY).endswith("PRIMARY KEY (calculation_date, route_id))")
    assert delete_statement(S.GOLD_OUTLIERS, "2025-01-01", "2025-01-03") == (
        "DELETE FROM gold_trip_outliers WHERE start_time >= CAST('2025-01-01' AS TIMESTAMP)"
        " AND start_time < CAST('2025-01-04' AS TIMESTAMP)"
    )
    assert insert_statement(S.GOLD_DAILY).endswith("FROM stage_gold_daily_ridership")
    for table in S.GOLD_TABLES:
        assert insert_statement(table).count("CAST(") == len(table.columns)


def test_rows_are_staged_before_the_transaction():
    order = []

    class Recording(JdbcGoldSink):
        def stage(self, write):
            order.append(write.table.stage_name)

        def publish(self, found):
            order.append("publish")

    Recording(None, "jdbc:x", {}).replace(writes())
    assert order == [t.stage_name for t in S.GOLD_TABLES] + ["publish"]


def test_staging_runs_the_query_in_its_own_tasks_and_writes_in_few(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, *a, **b: plans.append(self._df._jdf.queryExecution().optimizedPlan().toString()))
    JdbcGoldSink(spark, "jdbc:x", {}, max_connections=3).stage(GoldWrite(S.GOLD_WEEKLY, weekly(spark, ("2025-01-01", "R1")), "2025-01-01", "2025-01-01"))
    assert "Repartition 3, true" in plans[0]
