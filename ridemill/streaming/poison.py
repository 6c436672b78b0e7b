"""Input that keeps failing: attempts are counted, and after some the bad files are found and set aside.

The ledger of a run is a note in the metadata folder, written before each attempt, so that
an attempt that takes the driver with it counts too.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ridemill.session import path_exists, read_note, rename_path, write_note

MOST_ATTEMPTS = 3


def read_ledger(spark: SparkSession, root: str, run_id: str) -> dict:
    """`attempts` of the run so far, and the files that were `set_aside`."""
    note = _note(root, run_id)
    return json.loads(read_note(spark, note)) if path_exists(spark, note) else {"attempts": 0, "set_aside": []}


def begin_attempt(spark: SparkSession, root: str, run_id: str) -> int:
    """The number of this attempt, from 1; it is counted whether it ends or not."""
    found = read_ledger(spark, root, run_id)
    found["attempts"] += 1
    write_note(spark, _note(root, run_id), json.dumps(found))
    return found["attempts"]


def failing_files(files: list[str], probe: Callable[[list[str]], None]) -> list[str]:
    """The files with which `probe` fails alone, found by halving: a job for each half that holds one."""
    if not files or not _fails(files, probe):
        return []
    if len(files) == 1:
        return files
    middle = len(files) // 2
    return failing_files(files[:middle], probe) + failing_files(files[middle:], probe)


def set_aside(spark: SparkSession, root: str, run_id: str, files: list[str], folder: str) -> None:
    """Note the files in the run's ledger, then move them out of the landing folder."""
    found = read_ledger(spark, root, run_id)
    found["set_aside"] = sorted({*found["set_aside"], *files})
    write_note(spark, _note(root, run_id), json.dumps(found))
    for place, file in enumerate(files):
        if path_exists(spark, file):
            rename_path(spark, file, f"{folder}/{place:03d}-{file.rsplit('/', 1)[-1]}")


def files_of(spark: SparkSession, checkpoint: str, batch_id: int) -> list[str]:
    """The files of a batch that are still where they landed, by the stream's own log in its checkpoint.

    The batch has the log's entries after the offset of the batch before, up to its own.
    """
    first, last = (_log_offset(spark, checkpoint, n) for n in (batch_id - 1, batch_id))
    entry = F.from_json("value", "path string, batchId long")
    log = spark.read.text(f"{checkpoint}/sources/0").where(F.col("value").startswith("{")).select(entry.alias("entry"))
    own = log.where((F.col("entry.batchId") > first) & (F.col("entry.batchId") <= last)).select("entry.path").distinct().collect()
    return sorted(f for f in (unquote(row["path"]) for row in own) if path_exists(spark, f))


def _log_offset(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    note = f"{checkpoint}/offsets/{batch_id}"
    return json.loads(read_note(spark, note).splitlines()[-1])["logOffset"] if path_exists(spark, note) else -1


def _fails(files: list[str], probe: Callable[[list[str]], None]) -> bool:
    try:
        probe(files)
    except (PySparkException, Py4JJavaError):
        return True
    return False


def _note(root: str, run_id: str) -> str:
    return f"{root}/attempts/{run_id}"
