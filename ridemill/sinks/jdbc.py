"""Business tables in a relational database, replaced in one transaction.

Spark writes the rows to staging tables in parallel; the driver then only sends
statements, so no row passes through it.  The statements are plain SQL as
PostgreSQL takes it.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

from ridemill.functions import as_day, shift_day
from ridemill.schema import GoldTable
from ridemill.sinks.gold_files import GoldWrite


def create_statement(table: GoldTable) -> str:
    columns = [f"{name} {sql_type}" for name, sql_type in table.columns]
    columns.append(f"PRIMARY KEY ({', '.join(table.key)})")
    return f"CREATE TABLE IF NOT EXISTS {table.name} ({', '.join(columns)})"


def delete_statement(table: GoldTable, start, end) -> str:
    """Deletes the days [start, end] whole, as a half-open range."""
    kind = dict(table.columns)[table.dated_by]
    first, after = as_day(start).isoformat(), shift_day(end, 1).isoformat()
    return (
        f"DELETE FROM {table.name} WHERE {table.dated_by} >= CAST('{first}' AS {kind})"
        f" AND {table.dated_by} < CAST('{after}' AS {kind})"
    )


def insert_statement(table: GoldTable) -> str:
    names = ", ".join(table.column_names)
    casts = ", ".join(f"CAST({name} AS {sql_type})" for name, sql_type in table.columns)
    return f"INSERT INTO {table.name} ({names}) SELECT {casts} FROM {table.stage_name}"


def publish_statements(writes: list[GoldWrite]) -> list[str]:
    statements = [create_statement(w.table) for w in writes]
    for w in writes:
        statements += [delete_statement(w.table, w.start, w.end), insert_statement(w.table)]
    return statements + [f"DROP TABLE IF EXISTS {w.table.stage_name}" for w in writes]


class JdbcGoldSink:
    """`connect` opens the connection for the transaction; by default through Spark's JVM."""

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: dict[str, str],
        max_connections: int = 16,
        connect: Callable[[], Any] | None = None,
    ):
        self.spark = spark
        self.url = url
        self.properties = properties
        self.max_connections = max_connections
        self.connect = connect or self._driver_connection

    def replace(self, writes: list[GoldWrite]) -> None:
        for write in writes:
            self.stage(write)
        self.publish(writes)

    def stage(self, write: GoldWrite) -> None:
        """Write to the staging table with at most `max_connections` open at once.

        The rows are shuffled into that many tasks: without it Spark would run the whole
        query behind them in so few.
        """
        (
            write.rows.select(*write.table.column_names)
            .repartition(self.max_connections)
            .write.option("numPartitions", self.max_connections)
            .jdbc(self.url, write.table.stage_name, mode="overwrite", properties=self.properties)
        )

    def publish(self, writes: list[GoldWrite]) -> None:
        """All replacements in one transaction; on an error none of them."""
        connection = self.connect()
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            try:
                for sql in publish_statements(writes):
                    statement.execute(sql)
                connection.commit()
            finally:
                statement.close()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    def _driver_connection(self) -> Any:
        jvm = self.spark._jvm
        if "driver" in self.properties:
            jvm.java.lang.Class.forName(self.properties["driver"])
        settings = jvm.java.util.Properties()
        for name, value in self.properties.items():
            settings.setProperty(name, value)
        return jvm.java.sql.DriverManager.getConnection(self.url, settings)
