"""Rejected rows as compressed JSON, one folder per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_quarantine(rows: DataFrame, root: str, run_id: str, mode: str = "append") -> str:
    """Write the rows to the run's folder.

    `mode="overwrite"` makes a repeated run leave one copy.
    """
    folder = f"{root}/{run_id}"
    # JSON repeats all names in each row: uncompressed it takes several times the batch.
    rows.write.mode(mode).option("compression", "gzip").json(folder)
    return folder


def read_quarantine(spark: SparkSession, root: str, run_id: str, schema: T.StructType) -> DataFrame:
    """The run's rows, with the raw text of corrupt lines.

    The JSON reader would take `_corrupt_record` for its own error column, so
    that is given another name.
    """
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_unreadable_json")
    return reader.json(f"{root}/{run_id}")
