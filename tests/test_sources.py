from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemill import schema as S
from ridemill.operators import classify_trips, quarantine_rows, reason_counts, split_clean_bad
from ridemill.sources import (
    discover_by_name,
    discover_csv_schema,
    distinct_paths,
    header_census,
    parse_trip_lines,
    read_dimension,
    read_trips_by_name,
    read_trips_csv,
)
from ridemill.sources.csv_shapes import joined_type
from tests.helpers import AS_OF, plan_of

HEADER = ",".join(S.RAW_TRIPS.names)
GOOD = "T1,v1,r1,2025-01-20 08:00:00,2025-01-20 08:30:00,5.5,completed,V1"
EXTRA = GOOD + ",surplus"
SHORT = "T3,v1,r1"
BAD_NUMBER = "T4,v1,r1,2025-01-20 08:00:00,,far,completed,V1"
QUOTED = '"T,5",v1,r1,2025-01-20 08:00:00,,1.5,"in_progress",V1'


@pytest.fixture()
def landing(tmp_path):
    folder = tmp_path / "landing" / "incoming"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("\n".join([HEADER, GOOD, EXTRA, SHORT]) + "\n")
    (folder / "b.csv").write_text("\n".join([HEADER, BAD_NUMBER, QUOTED]) + "\n")
    (folder / "notes.txt").write_text("not,a,trip\n")
    return tmp_path / "landing"


def test_lines_that_do_not_fit_are_kept_whole(spark, landing):
    rows = read_trips_csv(spark, str(landing)).collect()
    assert {r["trip_id"] for r in rows} == {"T1", "T3", "T4", "T,5"}
    assert {r[S.CORRUPT_COLUMN] for r in rows} == {None, EXTRA, SHORT, BAD_NUMBER}
    quoted = next(r for r in rows if r["trip_id"] == "T,5")
    assert quoted[S.CORRUPT_COLUMN] is None and quoted[S.LINEAGE_COLUMN].endswith("b.csv")


def test_faulty_lines_are_found_when_few_columns_are_read(spark, landing):
    """Counting by a flag must not miss lines whose fault is in a column that is not read."""
    flag = F.col(S.CORRUPT_COLUMN).isNotNull().alias("faulty")
    counts = read_trips_csv(spark, str(landing)).groupBy("status", flag).count()
    assert sum(r["count"] for r in counts.collect() if r["faulty"]) == 3


def test_the_corrupt_column_can_be_read_alone(spark, landing):
    faulty = read_trips_csv(spark, str(landing)).where(F.col(S.CORRUPT_COLUMN).isNotNull())
    assert faulty.count() == 3
    assert {r[0] for r in faulty.select(S.CORRUPT_COLUMN).collect()} == {EXTRA, SHORT, BAD_NUMBER}


def test_csv_rows_are_judged_with_their_file(spark, landing, routes, vehicles):
    classified = classify_trips(read_trips_csv(spark, str(landing)), routes, vehicles, "run_1", AS_OF)
    assert {r[0]: r[1] for r in reason_counts(classified).collect()} == {S.REASON_CORRUPT: 3}
    bad = quarantine_rows(classified).collect()
    files = sorted(r["source_file"].rsplit("/", 1)[1] for r in bad)
    assert files == ["a.csv", "a.csv", "b.csv"]
    assert EXTRA in {r[S.CORRUPT_COLUMN] for r in bad}


def test_a_path_named_twice_is_read_once(spark, landing):
    path = str(landing / "incoming" / "a.csv")
    assert len(read_trips_csv(spark, [path, path]).select("trip_id", "status").collect()) == 3


def test_distinct_paths(spark):
    paths = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "path string, n int")
    assert sorted(r[0] for r in distinct_paths(paths).collect()) == ["a", "b"]


def test_discovered_schema_trims_and_keeps_times_as_text(spark, tmp_path):
    (tmp_path / "x.csv").write_text("trip_id,start_time,distance_km,seats\n T1 ,2025-01-01 08:00:00, 1.5 , 7 \n")
    found = discover_csv_schema(spark, str(tmp_path))
    assert found.simpleString() == "struct<trip_id:string,start_time:string,distance_km:double,seats:int>"


def test_a_discovered_schema_reads_the_same_files(spark, tmp_path, routes, vehicles):
    (tmp_path / "x.csv").write_text("\n".join([f"{HEADER},driver", f"{GOOD},Ann", f"{GOOD},Ann,more"]) + "\n")
    schema = discover_csv_schema(spark, str(tmp_path))
    clean, bad = split_clean_bad(
        classify_trips(read_trips_csv(spark, str(tmp_path), schema), routes, vehicles, "run_1", AS_OF)
    )
    assert [r["driver"] for r in clean.collect()] == ["Ann"] and bad.count() == 1
    assert clean.columns == [*S.SILVER_COLUMNS, "driver"]


def test_lines_in_a_column(spark):
    lines = spark.createDataFrame([(GOOD,), (EXTRA,), (QUOTED,)], "value string")
    rows = {r["trip_id"]: r for r in parse_trip_lines(lines).where(F.col(S.CORRUPT_COLUMN).isNull()).collect()}
    assert set(rows) == {"T1", "T,5"} and rows["T1"]["distance_km"] == 5.5


def test_dimension_from_csv_parquet_and_table(spark, tmp_path, vehicles):
    (tmp_path / "routes.csv").write_text("route_id,route_name,start_location,end_location\nR001,One,A,B\nR001,One,A,B\n")
    routes = read_dimension(spark, str(tmp_path / "routes.csv"), S.DIM_ROUTES, key="route_id")
    assert [r["route_name"] for r in routes.collect()] == ["One"]
    vehicles.write.parquet(str(tmp_path / "vehicles"))
    assert read_dimension(spark, str(tmp_path / "vehicles")).count() == 2
    vehicles.createOrReplaceTempView("dim_vehicles")
    table = read_dimension(spark, "dim_vehicles")
    assert table.count() == 2
    joined = spark.range(3).select(F.concat(F.lit("V000"), F.col("id")).alias("vehicle_id")).join(table, "vehicle_id")
    assert "BroadcastHashJoin" in plan_of(joined)


def mixed(tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    names = S.RAW_TRIPS.names
    exchanged = [names[1], names[0], *names[2:]]
    long = "\n".join(GOOD.replace("T1", f"T1{i}") for i in range(3000))
    (folder / "a.csv").write_text("\n".join([HEADER, GOOD, EXTRA]) + "\n" + long + "\n")
    (folder / "b 1%.csv").write_text("\n".join([",".join(exchanged).upper(), "v1,T2,r1,2025-01-20 08:00:00,,5.5,completed,V1", SHORT]) + "\n")
    (folder / "c.csv").write_text("\n".join([HEADER + ",depot", GOOD.replace("T1", "T4") + ",D1", GOOD.replace("T1", "T5")]) + "\n")
    (folder / "d.csv").write_text("\n".join(["status, trip_id ,start_time,status", "completed,T6,2025-01-20 08:00:00,again"]) + "\n")
    (folder / "e.csv").write_text("")
    (folder / "f.csv").write_text("foreign,names\n1,2\n")
    return folder, exchanged


def test_the_census_groups_files_by_header(spark, tmp_path):
    folder, exchanged = mixed(tmp_path)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    found = {header: sorted(f.rsplit("/", 1)[1] for f in files) for header, files in header_census(spark, str(folder)).items()}
    assert found[tuple(S.RAW_TRIPS.names)] == ["a.csv"] and found[tuple(n.upper() for n in exchanged)] == ["b 1%.csv"]
    assert found[(*S.RAW_TRIPS.names, "depot")] == ["c.csv"] and found[("status", "trip_id", "start_time", "status")] == ["d.csv"]
    assert found.get((), ["e.csv"]) == ["e.csv"]
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_columns_are_matched_by_name(spark, tmp_path):
    folder, _ = mixed(tmp_path)
    rows = read_trips_by_name(spark, str(folder))
    assert rows.columns == [*S.RAW_TRIPS.names, S.CORRUPT_COLUMN, S.LINEAGE_COLUMN]
    found = {r["trip_id"]: r for r in rows.where(~F.col("trip_id").startswith("T1") & F.col(S.CORRUPT_COLUMN).isNull()).collect()}
    assert set(found) == {"T2", "T4", "T6"}
    assert found["T2"]["vehicle_id"] == "v1" and found["T4"]["distance_km"] == 5.5 and found["T4"][S.LINEAGE_COLUMN].endswith("c.csv")
    assert found["T6"]["status"] == "completed" and found["T6"]["vehicle_id"] is None
    corrupt = sorted(r[0] for r in rows.select(S.CORRUPT_COLUMN).where(f"{S.CORRUPT_COLUMN} IS NOT NULL").collect())
    assert corrupt == sorted([EXTRA, SHORT, GOOD.replace("T1", "T5")])
    assert rows.where(F.col("trip_id").startswith("T1") & F.col(S.CORRUPT_COLUMN).isNull()).count() == 3001
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.csv").write_text("")
    assert read_trips_by_name(spark, str(tmp_path / "none")).count() == 0


def test_types_are_joined_over_files(spark, tmp_path):
    for name, text in {"a": "id,n,x,when\n1,2,3,2025-01-01\n", "b": "n,id,more\n2.5,7,true\n", "c": "ID,n,x\n99999999999,1,far\n", "d": "id,more\n1,\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    found = discover_by_name(spark, str(tmp_path))
    assert {f.name: f.dataType for f in found} == {"id": T.LongType(), "n": T.DoubleType(), "x": T.StringType(), "when": T.StringType(), "more": T.StringType()} or {
        f.name: f.dataType for f in found
    } == {"id": T.LongType(), "n": T.DoubleType(), "x": T.StringType(), "when": T.StringType(), "more": T.BooleanType()}


def test_joined_types_do_not_depend_on_the_order():
    kinds = [T.NullType(), T.IntegerType(), T.LongType(), T.DecimalType(20, 0), T.DecimalType(5, 3), T.DoubleType(), T.BooleanType(), T.StringType()]
    for one in kinds:
        for other in kinds:
            assert joined_type(one, other) == joined_type(other, one)
            for third in kinds:
                assert joined_type(joined_type(one, other), third) == joined_type(one, joined_type(other, third)), (one, other, third)
    assert joined_type(T.LongType(), T.DecimalType(5, 3)) == T.DecimalType(22, 3)
    assert joined_type(T.IntegerType(), T.BooleanType()) == T.StringType()
