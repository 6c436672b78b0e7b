from __future__ import annotations

import os
import time

import pytest
from pyspark.errors import PySparkException, StreamingQueryException

from ridemill import schema as S
from ridemill.plans import ParquetTripStore
from ridemill.plans.parquet_store import ACTIVE, HISTORY
from ridemill.sinks import ParquetGoldSink
from ridemill.streaming import batch_run_id, stream_silver
from ridemill.streaming.poison import MOST_ATTEMPTS, failing_files, read_ledger
from tests.helpers import AS_OF

HEADER = ",".join(S.RAW_TRIPS.names)


class FailingOnce(ParquetGoldSink):
    failures = 1

    def replace(self, writes):
        if self.failures:
            self.failures -= 1
            raise RuntimeError("gold is down")
        super().replace(writes)


def land(folder, name, *lines):
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def line(trip, end="2025-01-20 08:30:00", status="completed"):
    return f"{trip},v1,r1,2025-01-20 08:00:00,{end},5.5,{status},V1"


def test_run_ids_have_no_dashes():
    assert batch_run_id("line-7", "ab-1", 3) == "wap_line_7_ab_1_3"


def stream(spark, place, checkpoint, store, routes, vehicles, **more):
    done = []
    query = stream_silver(
        spark,
        str(place / "landing"),
        f"{place}/{checkpoint}",
        routes,
        vehicles,
        store,
        ParquetGoldSink(spark, f"{place}/gold"),
        f"{place}/bad",
        f"{place}/runs",
        **({"as_of": AS_OF, "on_batch": done.append} | more),
    )
    query.awaitTermination()
    return done


def test_files_older_than_the_newest_are_read(spark, tmp_path, routes, vehicles):
    landing = tmp_path / "landing"
    landing.mkdir()
    store = ParquetTripStore(spark, f"{tmp_path}/tables")
    land(landing, "1.csv", line("T1"))
    stream(spark, tmp_path, "checkpoint", store, routes, vehicles)
    land(landing, "2.csv", line("T2"))
    old = time.time() - 20 * 86_400
    os.utime(landing / "2.csv", (old, old))
    land(landing, "3.csv", line("T3"))
    stream(spark, tmp_path, "checkpoint", store, routes, vehicles)
    assert {r["trip_id"] for r in store.read(ACTIVE).collect()} == {"T1", "T2", "T3"}


def test_a_new_checkpoint_has_run_ids_of_its_own(spark, tmp_path, routes, vehicles):
    landing = tmp_path / "landing"
    landing.mkdir()
    store = ParquetTripStore(spark, f"{tmp_path}/tables")
    land(landing, "1.csv", line("T1"))
    first = stream(spark, tmp_path, "one", store, routes, vehicles)
    (landing / "1.csv").unlink()
    land(landing, "2.csv", line("T2"))
    second = stream(spark, tmp_path, "two", store, routes, vehicles)
    assert first[0].run_id != second[0].run_id
    assert {r["trip_id"] for r in store.read(HISTORY).collect()} == {"T1", "T2"}


def test_a_batch_that_is_given_again_after_its_publish_changes_nothing(spark, tmp_path, routes, vehicles):
    landing = tmp_path / "landing"
    landing.mkdir()
    store = ParquetTripStore(spark, f"{tmp_path}/tables")
    land(landing, "1.csv", line("T1"), line("T2"))
    calls = []

    def fail_once(result):
        calls.append(result.run_id)
        if len(calls) == 1:
            raise RuntimeError("lost after the publish")

    with pytest.raises(StreamingQueryException):
        stream(spark, tmp_path, "checkpoint", store, routes, vehicles, on_batch=fail_once)
    before = sorted(map(tuple, store.read(HISTORY).collect()))
    stream(spark, tmp_path, "checkpoint", store, routes, vehicles, on_batch=fail_once)
    assert len(calls) == 2 and calls[0] == calls[1]
    assert sorted(map(tuple, store.read(HISTORY).collect())) == before and len(before) == 2
    assert store.read(ACTIVE).count() == 2


def test_stream_in_batches_with_a_failed_gold_step(spark, tmp_path, routes, vehicles):
    landing = tmp_path / "landing"
    landing.mkdir()
    store = ParquetTripStore(spark, f"{tmp_path}/tables")
    sink = FailingOnce(spark, f"{tmp_path}/gold")
    done = []

    def run():
        query = stream_silver(
            spark,
            str(landing),
            f"{tmp_path}/checkpoint",
            routes,
            vehicles,
            store,
            sink,
            f"{tmp_path}/bad",
            f"{tmp_path}/runs",
            as_of=AS_OF,
            max_files=2,
            on_batch=done.append,
        )
        query.awaitTermination()

    land(landing, "1.csv", line("T1"), "broken")
    land(landing, "2.csv", line("T2", end="", status="in_progress"))
    with pytest.raises(StreamingQueryException):
        run()
    assert done == [] and store.read(ACTIVE).count() == 0

    run()
    assert [(r.run_id, r.clean_count, r.bad_counts) for r in done] == [(done[0].run_id, 2, {S.REASON_CORRUPT: 1})]
    assert store.read(ACTIVE).count() == 2 and store.read(HISTORY).count() == 2

    land(landing, "3.csv", line("T3"))
    land(landing, "4.csv", line("T1", end="2025-01-20 09:00:00"))
    land(landing, "5.csv", line("T5"))
    run()
    assert [r.run_id.rsplit("_", 1)[1] for r in done] == ["0", "1", "2"]
    assert len({r.run_id.rsplit("_", 1)[0] for r in done}) == 1
    assert sum(r.clean_count for r in done) == 5
    ends = {r["trip_id"]: str(r["end_time"]) for r in store.read(ACTIVE).collect()}
    assert ends == {
        "T1": "2025-01-20 09:00:00",
        "T2": "None",
        "T3": "2025-01-20 08:30:00",
        "T5": "2025-01-20 08:30:00",
    }
    assert store.read(HISTORY).count() == 5
    daily = sink.read(S.GOLD_DAILY).collect()
    assert [(r["total_trips"], r["trips_in_progress"]) for r in daily] == [(4, 1)]
    run()
    assert len(done) == 3


def spoil(folder, name):
    """A file whose blocks do not have the checksums noted for them: reading it fails."""
    (folder / f".{name}.crc").write_bytes(b"crc\x00\x00\x00\x02\x00" + b"\x00" * 4)


def test_a_file_that_cannot_be_read_is_set_aside_after_three_attempts(spark, tmp_path, routes, vehicles):
    landing = tmp_path / "landing"
    landing.mkdir()
    store = ParquetTripStore(spark, f"{tmp_path}/tables")
    for i in range(4):
        land(landing, f"{i}.csv", line(f"T{i}"))
    spoil(landing, "2.csv")
    for _ in range(MOST_ATTEMPTS):
        with pytest.raises(StreamingQueryException):
            stream(spark, tmp_path, "checkpoint", store, routes, vehicles)
        # Readers see nothing of a batch that failed.
        assert not (tmp_path / "tables" / "main").exists() or store.read(ACTIVE).count() == 0
    done = stream(spark, tmp_path, "checkpoint", store, routes, vehicles)
    assert [d.clean_count for d in done] == [3]
    assert {r["trip_id"] for r in store.read(ACTIVE).collect()} == {"T0", "T1", "T3"}
    ledger = read_ledger(spark, f"{tmp_path}/runs", done[0].run_id)
    assert ledger["attempts"] == MOST_ATTEMPTS + 1 and [f.rsplit("/", 1)[1] for f in ledger["set_aside"]] == ["2.csv"]
    assert not (landing / "2.csv").exists()
    assert [n for n in os.listdir(f"{tmp_path}/bad/set_aside/{done[0].run_id}") if n.endswith(".csv") and not n.startswith(".")] == ["000-2.csv"]
    land(landing, "5.csv", line("T5"))
    stream(spark, tmp_path, "checkpoint", store, routes, vehicles)
    assert store.read(ACTIVE).count() == 4


def test_a_fault_that_is_not_in_the_files_sets_none_aside(spark, tmp_path, routes, vehicles, monkeypatch):
    landing = tmp_path / "landing"
    landing.mkdir()
    store = ParquetTripStore(spark, f"{tmp_path}/tables")
    land(landing, "1.csv", line("T1"))

    def refuse(result):
        raise RuntimeError("gold is down")

    monkeypatch.setattr("ridemill.streaming.micro_batch.MOST_ATTEMPTS", 1)
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            stream(spark, tmp_path, "checkpoint", store, routes, vehicles, on_batch=refuse)
    assert (landing / "1.csv").exists()
    assert [d.clean_count for d in stream(spark, tmp_path, "checkpoint", store, routes, vehicles)] == [1]


def test_halving_finds_each_bad_file():
    asked = []

    def probe(files):
        asked.append(len(files))
        if {"c", "h"} & set(files):
            raise PySparkException("unreadable")

    assert failing_files(list("abcdefgh"), probe) == ["c", "h"]
    assert len(asked) <= 1 + 2 * 2 * 3
    assert failing_files(list("abd"), probe) == [] and failing_files([], probe) == []
