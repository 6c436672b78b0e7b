from __future__ import annotations

import itertools

import pytest

from ridemill.operators import merge_trips, replace_date_range
from tests.helpers import SILVER, plan_of, silver_row

START = "2025-01-20 08:00:00"
ENDS = {"null": None, "older": "2025-01-20 08:10:00", "same": "2025-01-20 08:20:00", "newer": "2025-01-20 08:30:00"}
STATUSES = ("completed", "in_progress", "cancelled")


def expected_winner(null_end, old_end, new_end, old_status, new_status):
    """The rule in words: newer or same end, and no step back from completed."""
    if old_end is None:
        newer = null_end == "open"
    else:
        newer = new_end is not None and new_end >= old_end
    return "new" if newer and (old_status != "completed" or new_status == "completed") else "old"


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("null_end", ["strict", "open"])
def test_truth_table(spark, null_end, small):
    cases = list(itertools.product([None, ENDS["same"]], ENDS.values(), STATUSES, STATUSES))
    old = [silver_row(f"T{i}", START, c[0], c[2], run="old") for i, c in enumerate(cases)]
    new = [silver_row(f"T{i}", START, c[1], c[3], run="new") for i, c in enumerate(cases)]
    merged = merge_trips(
        spark.createDataFrame(old, SILVER), spark.createDataFrame(new, SILVER), null_end, source_fits_broadcast=small
    )
    found = {r["trip_id"]: r["sfn_execution_id"] for r in merged.collect()}
    assert found == {f"T{i}": expected_winner(null_end, *c) for i, c in enumerate(cases)}


@pytest.mark.parametrize("small", [False, True])
def test_rows_without_match_and_other_start_times_are_kept(spark, small):
    old = [silver_row("T1", START, ENDS["same"]), silver_row("T2", START, None)]
    new = [silver_row("T1", "2025-01-20 09:00:00", None, run="new"), silver_row("T3", START, None, run="new")]
    merged = merge_trips(
        spark.createDataFrame(old, SILVER), spark.createDataFrame(new, SILVER), source_fits_broadcast=small
    )
    assert sorted((r["trip_id"], str(r["start_time"])[11:13], r["sfn_execution_id"]) for r in merged.collect()) == [
        ("T1", "08", "old"),
        ("T1", "09", "new"),
        ("T2", "08", "old"),
        ("T3", "08", "new"),
    ]


@pytest.mark.parametrize("small", [False, True])
def test_merging_twice_changes_nothing(spark, small):
    old = spark.createDataFrame([silver_row("T1", START, ENDS["same"]), silver_row("T2", START, None)], SILVER)
    new = spark.createDataFrame(
        [silver_row("T1", START, ENDS["newer"], run="new"), silver_row("T3", START, None, run="new")], SILVER
    )
    once = merge_trips(old, new, source_fits_broadcast=small)
    twice = merge_trips(once, new, source_fits_broadcast=small)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_small_source_does_not_shuffle_the_target(spark, tmp_path):
    rows = [silver_row(f"T{i}", START, ENDS["same"]) for i in range(50)]
    path = str(tmp_path / "target")
    spark.createDataFrame(rows, SILVER).write.parquet(path)
    target = spark.read.parquet(path)
    source = spark.createDataFrame([silver_row("T1", START, ENDS["newer"])], SILVER)
    plan = plan_of(merge_trips(target, source, source_fits_broadcast=True))
    kept = plan[plan.index("Union") :].split(":- ")[1]
    assert "hashpartitioning" not in kept.split("BroadcastExchange")[0]


def test_bad_arguments(spark):
    df = spark.createDataFrame([], SILVER)
    with pytest.raises(ValueError):
        merge_trips(df, df, null_end="maybe")
    with pytest.raises(ValueError):
        merge_trips(df, df.drop("status"))


def test_replace_date_range(spark):
    old = [
        silver_row("before", "2025-01-17 23:59:59", None),
        silver_row("first", "2025-01-18 00:00:00", None),
        silver_row("last", "2025-01-19 23:59:59.999999", None),
        silver_row("after", "2025-01-20 00:00:00", None),
        silver_row("undated", None, None),
    ]
    new = [silver_row("new", "2025-01-18 12:00:00", None)]
    result = replace_date_range(
        spark.createDataFrame(old, SILVER), spark.createDataFrame(new, SILVER), "start_time", "2025-01-18", "2025-01-19"
    )
    assert sorted(r["trip_id"] for r in result.collect()) == ["after", "before", "new", "undated"]
