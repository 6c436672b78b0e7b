"""Current and history trips as day-partitioned Parquet, with a branch per run.

    <root>/layout/<table>                 empty file with the table's columns
    <root>/main/active/start_date=...
    <root>/main/history/start_date=.../sfn_execution_id=...
    <root>/branches/<run>/<table>/...

A branch holds the rewritten days of `active` and the new rows of `history`.
Publishing copies its partitions over those of main: whole days of `active`,
and the run's own partitions of `history`, so history is never rewritten.  A publish is
not atomic over days: a note in <root>/publishing stands from before its first day to
after its last.  While it stands, the branch may hold the only whole copy of a day;
whoever stages or publishes next first finishes what the note names.

    <root>/versions/<day>      the version of the day in main's `active`
    <root>/staged/<branch>     what the branch holds: its generation, and for each day its
                               own version and the version of main that it was made from

    <root>/main/history_folded/<number>/start_date=...   history of runs that are closed, any number of them
    <root>/folded/<day>.<number>                         which of these folders holds the day: the last one
    <root>/folding/<day>                                 runs whose own partitions are being replaced by it

A run is closed when its branch has been removed.  Its partitions of history are folded
into one for each day (`fold_history`); the name in <root>/folded is the commit.

A day that another run has published since a branch was made is merged again from
the branch's batch before the branch is published (`rebase`), so runs may be staged side
by side and published in any order.  Each staging is a generation of its own.
<root>/published names for each branch the generation that was published last; a branch
is removed when that was more than RETAIN_DAYS ago, unless it has been staged again.

One writer at a time: two sessions that publish at once would finish each other's notes.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemill import schema as S
from ridemill.operators.dedupe import latest_per_trip
from ridemill.operators.merge import MERGE_KEY, merge_trips
from ridemill.operators.metrics import HASHED, fingerprint, noted_fingerprints, observe_batch, observe_fingerprints, row_hash
from ridemill.session import delete_path, names_in, path_exists, read_note, small_splits, write_note

MAIN = "main"
ACTIVE = "active"
HISTORY = "history"
PARTITIONS = {ACTIVE: [S.DAY_COLUMN], HISTORY: [S.DAY_COLUMN, S.RUN_COLUMN]}
RETAIN_DAYS = 5
#: Closed runs of a day from which on its history is folded when branches expire.
FOLD_RUNS = 16
SORT = {ACTIVE: ["trip_id"], HISTORY: ["route_id", "start_time"]}


class ParquetTripStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def init_tables(self, like: DataFrame) -> None:
        """Create both tables, empty, with the columns of `like`, unless they exist."""
        empty = _with_day(like).limit(0)
        for name in (ACTIVE, HISTORY):
            empty.write.mode("ignore").parquet(self._layout(name))
            empty.write.mode("ignore").partitionBy(*PARTITIONS[name]).parquet(self._path(name, MAIN))

    def read(self, name: str, branch: str = MAIN, days: Iterable[dt.date] | None = None) -> DataFrame:
        """The table as a branch sees it; `start_date` is kept for pruning.

        With `days` only their folders are listed and read.
        """
        wanted = None if days is None else {f"{S.DAY_COLUMN}={day.isoformat()}" for day in days}
        if name == HISTORY:
            main = self._main_history(wanted)
            if branch == MAIN:
                return main
            return main.where(F.col(S.RUN_COLUMN) != branch).unionByName(self._rows(name, self._path(name, branch), wanted))
        if branch == MAIN:
            return self._rows(name, self._path(name, MAIN), wanted)
        path = self._path(name, branch)
        own = self._rows(name, path, wanted)
        rewritten = {n for n in names_in(self.spark, path) if n.startswith(f"{S.DAY_COLUMN}=")}
        if wanted is not None:
            return self._rows(name, self._path(name, MAIN), wanted - rewritten).unionByName(own)
        days = [dt.date.fromisoformat(n.split("=", 1)[1]) for n in sorted(rewritten)]
        main = self._rows(name, self._path(name, MAIN))
        return main.where(~F.col(S.DAY_COLUMN).isin(days)).unionByName(own) if days else main

    def append_history(self, branch: str, rows: DataFrame) -> dict:
        """Stage the batch as a new generation of the branch; returns its metrics.

        What an earlier attempt staged is gone from here on.  The batch must have the columns of
        the table.  The metrics are observed above the last shuffle, in the tasks that write,
        where a lost executor cannot make rows count twice.
        """
        self.finish_publishes()
        dated, layout = _with_day(rows), self._columns(HISTORY)
        if set(dated.columns) != set(layout.names):
            raise ValueError(f"columns differ: {sorted(dated.columns)} and {sorted(layout.names)}")
        self._note_staged(branch, {"generation": uuid.uuid4().hex, "days": None})
        delete_path(self.spark, f"{self.root}/published/{branch}")
        delete_path(self.spark, self._path(ACTIVE, branch, staged=True))
        shaped = _shaped(dated.select(*[F.col(f.name).cast(f.dataType) for f in layout]), HISTORY)
        observed, metrics = observe_batch(shaped)
        observed, prints = observe_fingerprints(observed, {HISTORY: "true"})
        self._write(observed, HISTORY, self._path(HISTORY, branch, staged=True), "static")
        self._note_staged(branch, self._note(branch) | noted_fingerprints(prints, [HISTORY]))
        return metrics.get

    def batch_rows(self, branch: str) -> DataFrame:
        """The rows the branch has staged for history."""
        return self._rows(HISTORY, self._path(HISTORY, branch, staged=True))

    def merge_active(
        self,
        branch: str,
        source: DataFrame,
        days: list[dt.date],
        null_end: str = "strict",
        source_fits_broadcast: bool = False,
    ) -> None:
        """Stage the given days of `active` with the source merged in.

        `source` is the staged batch with one row per trip.  Only the days are read and rewritten;
        they must cover the source.  A small source leaves the target rows in the tasks that read
        them, already apart by day, so they are only sorted; else the join has mixed the days.
        """
        self.finish_publishes()
        staged = self._note(branch) | {"null_end": null_end, "small": source_fits_broadcast, "days": {}}
        self._merge_days(branch, staged, source, days, "static")

    def rebase(self, branch: str) -> list[dt.date]:
        """Merge the batch again into those days that main has moved on since the branch was made; returns them."""
        staged = self._staged(branch)
        now = self.main_versions(_as_days(staged["days"]))
        moved = [day for day, version in now.items() if not _made_from(staged, day, version)]
        if moved:
            source = latest_per_trip(self.batch_rows(branch)).where(F.col(S.DAY_COLUMN).isin(moved))
            self._merge_days(branch, staged, source, moved, "dynamic")
        return moved

    def is_current(self, branch: str) -> bool:
        """Whether main is, on the branch's days, still what the branch was made from."""
        staged = self._staged(branch)
        return all(_made_from(staged, day, version) for day, version in self.main_versions(_as_days(staged["days"])).items())

    def audit(self, branch: str) -> DataFrame:
        """What a branch holds against what was noted while it was written.

        table, start_date (null for the history), noted_rows, found_rows and intact: the rows' fingerprint is
        the noted one, and in `active` no trip stands twice with one start.
        """
        staged = self._staged(branch)
        noted = [(ACTIVE, day, *v["print"]) for day, v in staged["days"].items()] + [(HISTORY, None, *staged[HISTORY])]
        noted = self.spark.createDataFrame(noted, "table string, day string, noted_rows long, noted_total string, noted_xor long")
        active = self._rows(ACTIVE, self._path(ACTIVE, branch, staged=True))
        found = [_found(active, F.col(S.DAY_COLUMN), ACTIVE), _found(self.batch_rows(branch), F.lit(None), HISTORY)]
        twice = active.groupBy(S.DAY_COLUMN, *MERGE_KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        twice = twice.select(F.lit(ACTIVE).alias("table"), F.col(S.DAY_COLUMN).cast("string").alias("day")).distinct()
        twice = twice.withColumn("doubled", F.lit(True))
        same = (F.col("noted.table") == F.col("found.table")) & F.col("noted.day").eqNullSafe(F.col("found.day"))
        both = noted.alias("noted").join(found[0].unionByName(found[1]).alias("found"), same, "full_outer")
        both = both.select(
            F.coalesce("noted.table", "found.table").alias("table"),
            F.coalesce("noted.day", "found.day").alias("day"),
            F.coalesce("noted_rows", F.lit(0)).alias("noted_rows"),
            F.coalesce("found_rows", F.lit(0)).alias("found_rows"),
            ((F.col("noted_total") == F.col("found_total")) & (F.col("noted_xor") == F.col("found_xor"))).alias("alike"),
        )
        alike = (F.col("noted_rows") == F.col("found_rows")) & (F.coalesce("alike", F.lit(False)) | (F.col("found_rows") == 0))
        checked = both.join(twice, ["table", "day"], "left")
        return checked.select(
            "table", F.to_date("day").alias(S.DAY_COLUMN), "noted_rows", "found_rows", (alike & F.col("doubled").isNull()).alias("intact")
        )

    def _refuse_damaged(self, branch: str) -> None:
        damaged = self.audit(branch).where("NOT intact").collect()
        if damaged:
            places = ", ".join(f"{r['table']} {r[S.DAY_COLUMN] or ''} {r['found_rows']} of {r['noted_rows']} rows" for r in damaged)
            raise RuntimeError(f"branch {branch} is not what was staged and is not published: {places}")

    def publish(self, branch: str) -> None:
        """Copy the branch's partitions to main, file by file and without a shuffle.

        Days that main has moved on are merged again first; then the branch is read back and must be
        what was noted while it was written (`audit`).  A generation is published once:
        a repeated publish changes nothing.  Rows staged directly for `main` have no run of
        their own to replace, so their history is appended; a note of how many there were
        before tells a publish that is taken up again whether that has been done.
        """
        self.finish_publishes(but=branch)
        staged, note, done = self._staged(branch), f"{self.root}/publishing/{branch}", f"{self.root}/published/{branch}"
        if not path_exists(self.spark, note):
            if path_exists(self.spark, done) and read_note(self.spark, done) == staged["generation"]:
                return
            if self.rebase(branch):
                staged = self._staged(branch)
            self._refuse_damaged(branch)
            write_note(self.spark, note, str(self._main_history_rows()) if branch == MAIN else "")
        active = self._rows(ACTIVE, self._path(ACTIVE, branch, staged=True))
        self._write(_sorted(active, ACTIVE), ACTIVE, self._path(ACTIVE, MAIN), "dynamic")
        replaced = set(self.main_versions(_as_days(staged["days"])).values())
        for day, versions in staged["days"].items():
            write_note(self.spark, f"{self.root}/versions/{day}", versions["own"])
        self._drop_sums(replaced - {versions["own"] for versions in staged["days"].values()})
        if branch != MAIN or self._history_is_open(int(read_note(self.spark, note))):
            self._take_out(branch)
            mode = "append" if branch == MAIN else "dynamic"
            self._write(_sorted(self.batch_rows(branch), HISTORY), HISTORY, self._path(HISTORY, MAIN), mode)
        write_note(self.spark, done, staged["generation"])
        delete_path(self.spark, note)
        self.expire_branches()

    def finish_publishes(self, but: str | None = None) -> None:
        """Repeat each publish that was begun and not ended."""
        for branch in sorted(names_in(self.spark, f"{self.root}/publishing")):
            if branch != but:
                self.publish(branch)

    def expire_branches(self, now: float | None = None) -> list[str]:
        """Remove branches published more than RETAIN_DAYS ago and not staged again since; returns them."""
        limit = ((time.time() if now is None else now) - RETAIN_DAYS * 86_400) * 1000
        open_notes = names_in(self.spark, f"{self.root}/publishing")
        published = names_in(self.spark, f"{self.root}/published")
        old = sorted(b for b, changed in published.items() if changed < limit and b not in open_notes)
        gone = [b for b in old if read_note(self.spark, f"{self.root}/published/{b}") == self._generation(b)]
        touched = {day for branch in gone for day in self._note(branch)["days"] or ()}
        for branch in gone:
            for kind in ("branches", "staged", "published"):
                delete_path(self.spark, f"{self.root}/{kind}/{branch}")
        if touched:
            self.fold_history(_as_days(touched), FOLD_RUNS)
        return gone

    def fold_history(self, days: Iterable[dt.date] | None = None, least: int = 2) -> list[dt.date]:
        """Put the history of closed runs into one partition for each day that has `least` of them; returns these days.

        The run id stays in the rows, and the rows stay the same before, after and where this is cut
        off.  A run is closed when no branch of its name is staged.
        """
        self._finish_folds()
        path, staged = self._path(HISTORY, MAIN), names_in(self.spark, f"{self.root}/staged")
        wanted = None if days is None else {f"{S.DAY_COLUMN}={day.isoformat()}" for day in days}
        runs = {}
        for folder in sorted(names_in(self.spark, path)):
            if folder.startswith(f"{S.DAY_COLUMN}=") and (wanted is None or folder in wanted):
                own = [unquote(n.split("=", 1)[1]) for n in names_in(self.spark, f"{path}/{folder}") if n.startswith(f"{S.RUN_COLUMN}=")]
                closed = sorted(run for run in own if run not in staged)
                if len(closed) >= least:
                    runs[folder.split("=", 1)[1]] = closed
        if runs:
            folders = {f"{S.DAY_COLUMN}={day}" for day in runs}
            closed = self._rows(HISTORY, path, folders)
            if staged:  # these keep their partitions: they may be given again
                closed = closed.where(F.coalesce(~F.col(S.RUN_COLUMN).isin(sorted(staged)), F.lit(True)))
            self._fold(runs, self._folded_history(closed, folders))
        return _as_days(runs)

    def _fold(self, runs: dict[str, list[str]], rows: DataFrame) -> None:
        """Make `rows` the folded history of the days in `runs`, in place of the partitions of the runs named there."""
        folded = self._folded()
        number = 1 + max(folded.values(), default=0)
        path = f"{self._path(HISTORY, MAIN)}_folded/{number}"
        shaped = _shaped(rows, HISTORY)
        shaped.write.mode("overwrite").partitionBy(S.DAY_COLUMN).parquet(path)
        for day, own in runs.items():
            write_note(self.spark, f"{self.root}/folding/{day}", json.dumps({"number": number, "runs": own}))
            write_note(self.spark, f"{self.root}/folded/{day}.{number}", "")
        self._finish_folds()

    def _finish_folds(self) -> None:
        """Remove what committed folds have replaced; notes of others are dropped, nothing was changed by them."""
        folded = self._folded()
        for day in sorted(names_in(self.spark, f"{self.root}/folding")):
            found = json.loads(read_note(self.spark, f"{self.root}/folding/{day}"))
            if folded.get(day) == found["number"]:
                path = f"{self._path(HISTORY, MAIN)}/{S.DAY_COLUMN}={day}"
                for name in names_in(self.spark, path):
                    if unquote(name.split("=", 1)[-1]) in found["runs"]:
                        delete_path(self.spark, f"{path}/{name}")
            delete_path(self.spark, f"{self.root}/folding/{day}")
        for name in names_in(self.spark, f"{self.root}/folded"):
            day, number = name.split(".")
            if int(number) < folded[day]:
                delete_path(self.spark, f"{self._path(HISTORY, MAIN)}_folded/{number}/{S.DAY_COLUMN}={day}")
                delete_path(self.spark, f"{self.root}/folded/{name}")

    def _folded(self) -> dict[str, int]:
        """The folder that holds the folded history of each day."""
        found: dict[str, int] = {}
        for name in names_in(self.spark, f"{self.root}/folded"):
            day, number = name.split(".")
            found[day] = max(int(number), found.get(day, 0))
        return found

    def _main_history(self, wanted: set[str] | None) -> DataFrame:
        """The runs' own partitions, without those that are being replaced, and the folded ones."""
        rows, folded = self._rows(HISTORY, self._path(HISTORY, MAIN), wanted), self._folded()
        for day in sorted(names_in(self.spark, f"{self.root}/folding")):
            found = json.loads(read_note(self.spark, f"{self.root}/folding/{day}"))
            if folded.get(day) == found["number"] and found["runs"]:
                replaced = (F.col(S.DAY_COLUMN) == F.lit(day).cast("date")) & F.col(S.RUN_COLUMN).isin(found["runs"])
                rows = rows.where(~F.coalesce(replaced, F.lit(False)))
        return self._folded_history(rows, wanted)

    def _folded_history(self, rows: DataFrame, wanted: set[str] | None) -> DataFrame:
        """`rows` with those that are folded."""
        by_number: dict[int, set[str]] = {}
        for day, number in self._folded().items():
            folder = f"{S.DAY_COLUMN}={day}"
            if wanted is None or folder in wanted:
                by_number.setdefault(number, set()).add(folder)
        for number, folders in sorted(by_number.items()):
            rows = rows.unionByName(self._rows(HISTORY, f"{self._path(HISTORY, MAIN)}_folded/{number}", folders))
        return rows

    def _take_out(self, run: str) -> None:
        """Leave out of the folded history what a run that is given again will replace."""
        path = self._path(HISTORY, run, staged=True)
        days = {n.split("=", 1)[1] for n in names_in(self.spark, path) if n.startswith(f"{S.DAY_COLUMN}=")} & self._folded().keys()
        if run == MAIN or not days:
            return
        none = self.spark.createDataFrame([], self._columns(HISTORY))
        rows = self._folded_history(none, {f"{S.DAY_COLUMN}={day}" for day in days})
        if not rows.where(F.col(S.RUN_COLUMN) == run).isEmpty():
            self._fold({day: [] for day in sorted(days)}, rows.where(~F.col(S.RUN_COLUMN).eqNullSafe(F.lit(run))))

    def main_versions(self, days: Iterable[dt.date]) -> dict[dt.date, str]:
        """The version of each of the days in main; '' where nothing was ever published with one."""
        known = names_in(self.spark, f"{self.root}/versions")
        notes = {day: f"{self.root}/versions/{day.isoformat()}" for day in days}
        return {day: read_note(self.spark, note) if day.isoformat() in known else "" for day, note in notes.items()}

    def versions(self, branch: str, days: Iterable[dt.date]) -> dict[dt.date, str]:
        """The version of each of the days as a branch sees it.  Equal versions have equal rows; days without trips are left out."""
        days = list(days)
        own = {} if branch == MAIN else {d: v["own"] for d, v in self._staged(branch)["days"].items()}
        filled = names_in(self.spark, self._path(ACTIVE, MAIN))
        on_main = [day for day in days if day.isoformat() not in own and f"{S.DAY_COLUMN}={day.isoformat()}" in filled]
        found = self.main_versions(on_main)
        for day in [day for day, version in found.items() if not version]:
            # Written before days had versions.
            found[day] = uuid.uuid4().hex
            write_note(self.spark, f"{self.root}/versions/{day.isoformat()}", found[day])
        return found | {day: own[day.isoformat()] for day in days if day.isoformat() in own}

    @property
    def sums_root(self) -> str:
        """Where sums of days are kept, by their version."""
        return f"{self.root}/day_sums"

    def _drop_sums(self, versions: set[str]) -> None:
        """Remove what is kept of versions that main no longer has."""
        for name in names_in(self.spark, self.sums_root):
            if name.split("=")[-1].split("-")[0] in versions:
                delete_path(self.spark, f"{self.sums_root}/{name}")

    def _merge_days(self, branch: str, staged: dict, source: DataFrame, days: list[dt.date], mode: str) -> None:
        base = self.main_versions(days)
        target = self.read(ACTIVE, days=days)
        merged = merge_trips(target, source.select(*target.columns), staged["null_end"], staged["small"])
        shaped = _sorted(merged, ACTIVE) if staged["small"] else _shaped(merged, ACTIVE)
        # About a month of days at most, by the time check.
        by_day = {day.isoformat(): f"{S.DAY_COLUMN} = DATE '{day.isoformat()}'" for day in days}
        observed, prints = observe_fingerprints(shaped, by_day)
        self._write(observed, ACTIVE, self._path(ACTIVE, branch, staged=True), mode)
        # Only now: what was cut off before is not known as staged, or is merged again.
        found = noted_fingerprints(prints, by_day)
        made = {day.isoformat(): {"base": base[day], "own": uuid.uuid4().hex, "print": found[day.isoformat()]} for day in days}
        self._note_staged(branch, staged | {"days": staged["days"] | made})

    def _staged(self, branch: str) -> dict:
        """The branch's note, if it was staged to the end and with rows."""
        found = self._note(branch)
        if found["days"] is None:
            raise ValueError(f"branch {branch} has no days to publish: its batch is empty or was cut off while it was staged")
        return found

    def _note(self, branch: str) -> dict:
        note = f"{self.root}/staged/{branch}"
        if not path_exists(self.spark, note):
            raise ValueError(f"branch {branch} is not staged, or was removed after its publish")
        return json.loads(read_note(self.spark, note))

    def _generation(self, branch: str) -> str | None:
        return self._note(branch)["generation"] if path_exists(self.spark, f"{self.root}/staged/{branch}") else None

    def _note_staged(self, branch: str, found: dict) -> None:
        write_note(self.spark, f"{self.root}/staged/{branch}", json.dumps(found))

    def _main_history_rows(self) -> int:
        return self.read(HISTORY).where(F.col(S.RUN_COLUMN) == MAIN).count()

    def _history_is_open(self, before: int) -> bool:
        now, staged = self._main_history_rows(), self.batch_rows(MAIN).count()
        if now not in (before, before + staged):
            raise RuntimeError(f"history of {MAIN} has {now} rows; a publish was cut off between {before} and {before + staged}")
        return now == before and staged > 0

    def _rows(self, name: str, path: str, folders: set[str] | None = None) -> DataFrame:
        """The rows under `path`; with `folders`, only those of its folders that are named and exist."""
        layout = self._columns(name)
        paths = [path] if folders is None else [f"{path}/{f}" for f in sorted(folders & names_in(self.spark, path).keys())]
        if not paths or not path_exists(self.spark, path):
            return self.spark.createDataFrame([], layout)
        # Partition values take the layout's types, not inferred ones.
        return self.spark.read.schema(layout).option("basePath", path).parquet(*paths).select(*layout.names)

    def _columns(self, name: str) -> T.StructType:
        return self.spark.read.parquet(self._layout(name)).schema

    def _write(self, shaped: DataFrame, name: str, path: str, mode: str) -> None:
        writer = shaped.write.partitionBy(*PARTITIONS[name])
        with small_splits(self.spark):
            if mode == "append":
                writer.mode("append").parquet(path)
            else:
                writer.mode("overwrite").option("partitionOverwriteMode", mode).parquet(path)

    def _path(self, name: str, branch: str, staged: bool = False) -> str:
        if branch == MAIN and not staged:
            return f"{self.root}/main/{name}"
        return f"{self.root}/branches/{branch}/{name}"

    def _layout(self, name: str) -> str:
        return f"{self.root}/layout/{name}"


def _as_days(names: Iterable[str]) -> list[dt.date]:
    return [dt.date.fromisoformat(name) for name in sorted(names)]


def _made_from(staged: dict, day: dt.date, version: str) -> bool:
    """Whether main's version of a day is the one the branch was made from, or the branch's own."""
    found = staged["days"][day.isoformat()]
    return version in (found["base"], found["own"])


def _found(rows: DataFrame, day: Column, table: str) -> DataFrame:
    hashed = rows.select(day.cast("string").alias("day"), row_hash(rows.columns).alias(HASHED))
    found = hashed.groupBy("day").agg(*fingerprint(HASHED, "found_"))
    return found.select(F.lit(table).alias("table"), "*")


def distinct_days(rows: DataFrame) -> list[dt.date]:
    """The start dates in the rows; the accepted time range bounds them to about a month."""
    return sorted(row[0] for row in rows.select(S.DAY_COLUMN).distinct().collect())


def _with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn(S.DAY_COLUMN, F.to_date("start_time"))


def _shaped(rows: DataFrame, name: str) -> DataFrame:
    """Rows gathered by day and sorted for the table.

    The rebalance hint lets AQE split a day that holds much of the batch over
    many tasks and files, and join small ones.
    """
    return _sorted(rows.hint("rebalance", F.col(S.DAY_COLUMN)), name)


def _sorted(rows: DataFrame, name: str) -> DataFrame:
    return rows.sortWithinPartitions(*PARTITIONS[name], *SORT[name])
