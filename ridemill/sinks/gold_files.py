"""Business tables as Parquet: all tables of a replacement change at once.

    <root>/data/<table>/generation=<g>/row_day=...   rows written by one replacement, never changed
    <root>/generations/<number>                      which generation holds each day of each table

A replacement writes its rows to a new generation, then the list of what is valid from
now on under a name of its own, and last renames that list to the next number.  The rename
is the commit: before it readers see all tables as they were, after it all as they are
to be.  A rename to a number that exists fails, so of two writers that begin from one list
the second is refused.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemill.functions import as_day
from ridemill.schema import GoldTable
from ridemill.session import delete_path, names_in, read_note, rename_path, write_note

_DAY = "row_day"
_GENERATION = "generation"
#: Lists that stay, the valid one among them: who reads by one of them still finds its files.
KEEP_GENERATIONS = 5


@dataclass(frozen=True)
class GoldWrite:
    """New rows for a table, and the date range they replace."""

    table: GoldTable
    rows: DataFrame
    start: dt.date | str
    end: dt.date | str


class ParquetGoldSink:
    """Replaces the rows of a date range in several tables, all or none.

    Rows of other days are neither read nor written.  A replacement that was cut off leaves
    files that no list names; repeating it gives the same tables.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def replace(self, writes: list[GoldWrite]) -> None:
        number, tables = self._valid()
        generation = uuid.uuid4().hex
        for write in writes:
            tables[write.table.name] = self._replaced(tables.get(write.table.name, {"days": {}}), write, generation)
        staged = f"{self.root}/staged/{generation}"
        write_note(self.spark, staged, json.dumps(tables))
        if not rename_path(self.spark, staged, f"{self.root}/generations/{number + 1:012d}"):
            raise RuntimeError("another writer has replaced the business tables meanwhile; nothing was changed")
        self._clean(tables)

    def read(self, table: GoldTable) -> DataFrame:
        """The table's rows as of now; fails if nothing was ever written to it."""
        return self.read_all([table])[0]

    def read_all(self, tables: list[GoldTable]) -> list[DataFrame]:
        """Several tables as one replacement left them: the list is read once for all of them."""
        valid = self._valid()[1]
        return [self._rows(table, valid) for table in tables]

    def _rows(self, table: GoldTable, valid: dict) -> DataFrame:
        if table.name not in valid:
            raise ValueError(f"nothing was ever written to {table.name}")
        found = valid[table.name]
        layout = T.StructType.fromJson(found["layout"])
        folder = self._data(table.name)
        paths = [f"{folder}/{_GENERATION}={g}/{_DAY}={day}" for day, g in sorted(found["days"].items())]
        if not paths:
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).parquet(*paths).select(*table.column_names)

    def _replaced(self, before: dict, write: GoldWrite, generation: str) -> dict:
        """The table's entry after the write; its rows are written on the way."""
        folder = f"{self._data(write.table.name)}/{_GENERATION}={generation}"
        dated = write.rows.withColumn(_DAY, F.to_date(write.table.dated_by))
        shaped = dated.hint("rebalance", F.col(_DAY)).sortWithinPartitions(_DAY, *write.table.key)
        shaped.write.partitionBy(_DAY).parquet(folder)
        start, end = as_day(write.start).isoformat(), as_day(write.end).isoformat()
        outside = {day: g for day, g in before["days"].items() if not start <= day <= end}
        filled = [n.split("=", 1)[1] for n in names_in(self.spark, folder) if n.startswith(f"{_DAY}=")]
        return {"layout": write.rows.schema.jsonValue(), "days": outside | dict.fromkeys(filled, generation)}

    def _valid(self) -> tuple[int, dict]:
        """The number and the content of the last list."""
        numbers = sorted(names_in(self.spark, f"{self.root}/generations"))
        return (int(numbers[-1]), json.loads(read_note(self.spark, f"{self.root}/generations/{numbers[-1]}"))) if numbers else (0, {})

    def _clean(self, valid: dict) -> None:
        """Remove old lists, and generations that no list names any more."""
        numbers = sorted(names_in(self.spark, f"{self.root}/generations"))
        kept, gone = numbers[-KEEP_GENERATIONS:], numbers[:-KEEP_GENERATIONS]
        if not gone:
            return
        lists = [json.loads(read_note(self.spark, f"{self.root}/generations/{n}")) for n in [*gone, *kept]]
        for number in gone:
            delete_path(self.spark, f"{self.root}/generations/{number}")
        for table in valid:
            old, new = ({g for one in part for g in one.get(table, {"days": {}})["days"].values()} for part in (lists[: len(gone)], lists[len(gone) :]))
            for generation in old - new:
                delete_path(self.spark, f"{self._data(table)}/{_GENERATION}={generation}")

    def _data(self, name: str) -> str:
        return f"{self.root}/data/{name}"
