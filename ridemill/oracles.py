"""SQL for DuckDB with the expected result of each query, written from its meaning.

The texts share named subqueries over the driver's tables: `trips`, `routes`,
`vehicles`, `enriched`, `raw`, `judged` and `redelivered`.  Durations are whole
microseconds, summed as integers, so sums and means agree to the last bit;
deviations and scores are rounded in both engines.
"""

from __future__ import annotations

from ridemill import fixtures as X
from ridemill import schema as S

_STATUS = "CASE event_type WHEN 'view' THEN 'in_progress' WHEN 'error' THEN 'cancelled' ELSE 'completed' END"
_END = "CASE WHEN event_type <> 'view' THEN ts + to_microseconds(CAST(round(value * 6e7) AS BIGINT)) END"

_SUBQUERIES = {
    "trips": f"""
        SELECT 'T' || event_id AS trip_id,
               'R' || lpad(CAST(user_id % 27 AS VARCHAR), 3, '0') AS route_id,
               'V' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS vehicle_id,
               {_STATUS} AS status, ts AS start_time, {_END} AS end_time,
               value / 4 AS distance_km, 'run_' || strftime(ts, '%Y%m%d') AS sfn_execution_id
        FROM events""",
    "routes": """
        SELECT 'R' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS route_id, n_name AS route_name FROM nation""",
    "vehicles": """
        SELECT 'V' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS vehicle_id,
               CASE s_nationkey % 3 WHEN 0 THEN 'Bus' WHEN 1 THEN 'Subway' ELSE 'Streetcar' END AS vehicle_type,
               CAST(30 + s_suppkey % 70 AS INTEGER) AS capacity
        FROM supplier""",
    "enriched": """
        SELECT t.*, v.vehicle_type, v.capacity, CAST(t.start_time AS DATE) AS trip_date,
               datesub('microsecond', t.start_time, t.end_time) AS us,
               datesub('minute', t.start_time, t.end_time) AS minutes
        FROM trips t JOIN vehicles v USING (vehicle_id)""",
    "raw": f"""
        SELECT CASE WHEN event_id % 97 = 0 THEN '' ELSE 'T' || event_id END AS trip_id,
               CASE WHEN event_id % 89 <> 0 THEN 'R' || lpad(CAST(user_id % 27 AS VARCHAR), 3, '0') END AS route_id,
               'V' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS vehicle_id,
               {_STATUS} AS status,
               CASE WHEN event_id % 61 = 0 THEN NULL
                    WHEN event_id % 50 = 0 THEN ts - INTERVAL 40 DAY ELSE ts END AS start_time,
               {_END} AS end_time,
               CASE WHEN event_id % 41 <> 0 THEN value / 4 END AS distance_km,
               props AS note, event_id, user_id, event_id % 101 = 0 AS corrupt
        FROM events""",
    "judged": f"""
        SELECT *, CASE
            WHEN corrupt THEN '{S.REASON_CORRUPT}'
            WHEN coalesce(trip_id, '') = '' OR route_id IS NULL THEN '{S.REASON_MISSING_KEY}'
            WHEN start_time IS NULL OR start_time NOT BETWEEN
                 TIMESTAMP '{X.AS_OF}' - INTERVAL 30 DAY AND TIMESTAMP '{X.AS_OF}' + INTERVAL 1 DAY
                 THEN '{S.REASON_TEMPORAL}'
            WHEN route_id NOT IN (SELECT route_id FROM routes) THEN '{S.REASON_ROUTE}'
            WHEN vehicle_id NOT IN (SELECT vehicle_id FROM vehicles) THEN '{S.REASON_VEHICLE}'
            END AS quarantine_reason
        FROM raw""",
    "redelivered": f"""
        SELECT trip_id, route_id, vehicle_id,
               CASE WHEN n % 3 = 0 THEN 'completed' ELSE status END AS status,
               CASE WHEN status = 'completed' AND n % 4 = 1 THEN start_time + INTERVAL 1 HOUR ELSE start_time END AS start_time,
               CASE WHEN n % 7 <> 0 THEN coalesce(end_time, start_time) + to_minutes(CAST(n % 5 - 2 AS BIGINT)) END AS end_time,
               distance_km + 1 AS distance_km, '{X.BATCH_ID}' AS sfn_execution_id
        FROM (SELECT *, CAST(substr(trip_id, 2) AS BIGINT) AS n FROM trips)""",
    "enriched_again": """
        SELECT t.*, v.vehicle_type, v.capacity, CAST(t.start_time AS DATE) AS trip_date,
               datesub('microsecond', t.start_time, t.end_time) AS us,
               datesub('minute', t.start_time, t.end_time) AS minutes
        FROM redelivered t JOIN vehicles v USING (vehicle_id)""",
    "accepted_a": """
        SELECT * REPLACE ('run_a' AS sfn_execution_id) FROM trips
        WHERE route_id IN (SELECT route_id FROM routes) AND vehicle_id IN (SELECT vehicle_id FROM vehicles)""",
    "accepted_b": """
        SELECT * REPLACE ('run_b' AS sfn_execution_id) FROM redelivered
        WHERE route_id IN (SELECT route_id FROM routes) AND vehicle_id IN (SELECT vehicle_id FROM vehicles)""",
    "current_b": "{merged}",
    "enriched_b": """
        SELECT t.*, v.vehicle_type, v.capacity, CAST(t.start_time AS DATE) AS trip_date,
               datesub('microsecond', t.start_time, t.end_time) AS us,
               datesub('minute', t.start_time, t.end_time) AS minutes
        FROM current_b t JOIN vehicles v USING (vehicle_id)""",
    "lines": f"""
        SELECT 'T' || event_id AS trip_id, 'R' || lpad(CAST(user_id % 27 AS VARCHAR), 3, '0') AS route_id,
               'V' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS vehicle_id, {_STATUS} AS status,
               ts AS start_time, {_END} AS end_time, value / 4 AS distance_km, event_type = 'error' AS is_corrupt
        FROM events""",
    "judged_lines": f"""
        SELECT *, CASE
            WHEN is_corrupt THEN '{S.REASON_CORRUPT}'
            WHEN start_time > TIMESTAMP '{X.AS_OF}' + INTERVAL 1 DAY THEN '{S.REASON_TEMPORAL}'
            WHEN route_id NOT IN (SELECT route_id FROM routes) THEN '{S.REASON_ROUTE}'
            WHEN vehicle_id NOT IN (SELECT vehicle_id FROM vehicles) THEN '{S.REASON_VEHICLE}'
            END AS quarantine_reason
        FROM lines""",
    "deliveries": """
        SELECT * FROM trips
        UNION ALL BY NAME SELECT * REPLACE (distance_km * 2 AS distance_km) FROM trips
        UNION ALL BY NAME SELECT * FROM redelivered""",
}
_NEEDS = {
    "enriched": ("trips", "vehicles"),
    "judged": ("raw", "routes", "vehicles"),
    "redelivered": ("trips",),
    "enriched_again": ("redelivered", "vehicles"),
    "accepted_a": ("trips", "routes", "vehicles"),
    "accepted_b": ("redelivered", "routes", "vehicles"),
    "current_b": ("accepted_a", "accepted_b"),
    "enriched_b": ("current_b", "vehicles"),
    "judged_lines": ("lines", "routes", "vehicles"),
    "deliveries": ("trips", "redelivered"),
}


def _using(*names: str) -> str:
    """A WITH clause of the named subqueries and those they need."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, ()):
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{name} AS ({_SUBQUERIES[name]})" for name in wanted)


# Mean of whole microseconds in minutes, added up in two parts.
_MEAN_PARTS = "({seconds} + {micros} / 1e6) / 60 / {n}"
_MEAN = _MEAN_PARTS.format(seconds="sum(us // 1000000)", micros="sum(us % 1000000)", n="count(us)")
_DONE = "count(*) FILTER (WHERE status = 'completed')"
_RUNNING = "count(*) FILTER (WHERE status = 'in_progress')"
_IN_RANGE = f"trip_date BETWEEN DATE '{X.FIRST_DAY}' AND DATE '{X.LAST_DAY}'"
_GROUP = "trip_date, route_id, vehicle_type"


def _daily(mean: str, longest: str, enriched: str = "enriched", hours: str = "hours", dates: str = _IN_RANGE) -> str:
    return f"""
        SELECT {_GROUP}, count(*) AS total_trips, count(DISTINCT vehicle_id) AS unique_vehicles,
               avg(capacity) AS avg_capacity, {mean} AS avg_duration_minutes, {longest} AS max_duration_minutes,
               {_DONE} AS trips_completed, {_RUNNING} AS trips_in_progress,
               (SELECT CAST(h.hr AS INTEGER) FROM {hours} h
                WHERE h.trip_date = e.trip_date AND h.route_id = e.route_id AND h.vehicle_type = e.vehicle_type
                  AND h.place = 1) AS peak_hour
        FROM {enriched} e WHERE {dates} GROUP BY {_GROUP}"""


def _hours(enriched: str = "enriched", name: str = "hours", dates: str = _IN_RANGE) -> str:
    return f"""{name} AS (
        SELECT {_GROUP}, hour(start_time) AS hr, count(*) AS n,
               row_number() OVER (PARTITION BY {_GROUP} ORDER BY count(*) DESC, hour(start_time)) AS place
        FROM {enriched} WHERE {dates} GROUP BY {_GROUP}, hour(start_time))"""


_HOURS = _hours()
_DAILY = _daily(_MEAN, "max(us) / 6e7")

_CALENDAR = f"""calendar AS (
        SELECT CAST(d AS DATE) AS calculation_date
        FROM generate_series(DATE '{X.FIRST_DAY}', DATE '{X.LAST_CALCULATION_DAY}', INTERVAL 1 DAY) AS g(d))"""
_ROLLING = f"""rolling AS (
        SELECT calculation_date, route_id, count(*) AS total_trips, {_DONE} AS total_completed_trips,
               {_MEAN} AS avg_trip_duration_minutes
        FROM calendar JOIN enriched ON trip_date BETWEEN calculation_date - 6 AND calculation_date
        GROUP BY ALL)"""
_RANKED = """ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY calculation_date ORDER BY total_trips DESC, route_id) AS INTEGER)
               AS route_rank FROM rolling)"""
_WEEKLY = "SELECT * FROM ranked WHERE route_rank <= 10"

_FINISHED = "status = 'completed' AND end_time IS NOT NULL"
_STATS = f"""stats AS (
        SELECT route_id, vehicle_type, {_MEAN} AS mean, coalesce(stddev_samp(us / 6e7), 0) AS sd
        FROM enriched WHERE {_FINISHED} GROUP BY ALL)"""


def _scored(scope: str, length: str = "us / 6e7") -> str:
    return f"""scored AS (
        SELECT trip_id, route_id, vehicle_id, vehicle_type, start_time, end_time, distance_km,
               {length} AS duration_minutes, mean, sd, CASE WHEN sd > 0 THEN ({length} - mean) / sd ELSE 0 END AS z
        FROM enriched JOIN stats USING (route_id, vehicle_type) WHERE {_FINISHED} AND {scope})"""


def _outliers(otherwise: str) -> str:
    return f"""
        SELECT trip_id, route_id, vehicle_id, start_time, end_time, duration_minutes,
               round(mean, 6) AS avg_duration_minutes, round(sd, 6) AS stddev_duration_minutes, round(z, 6) AS z_score,
               CASE WHEN z > 3 THEN '{S.OUTLIER_DURATION}' WHEN distance_km > 80 THEN '{S.OUTLIER_DISTANCE}'
                    ELSE {otherwise} END AS outlier_reason
        FROM scored WHERE z > 3 OR distance_km > 80"""


_SILVER = f"""trip_id, route_id, vehicle_id, status, start_time, end_time, distance_km,
               TIMESTAMP '{X.AS_OF}' AS ingested_at, '{X.BATCH_ID}' AS sfn_execution_id, note"""
_CLEAN = f"SELECT {_SILVER} FROM judged WHERE quarantine_reason IS NULL"


def _merged(ends_later: str, target: str = "trips", source: str = "redelivered") -> str:
    """Target rows that stay, source rows that win, source rows without a match."""
    wins = f"({ends_later}) AND (t.status <> 'completed' OR s.status = 'completed')"
    return f"""
        SELECT t.* FROM {target} t LEFT JOIN {source} s USING (trip_id, start_time)
        WHERE s.trip_id IS NULL OR NOT coalesce({wins}, FALSE)
        UNION ALL BY NAME
        SELECT s.* FROM {source} s LEFT JOIN {target} t USING (trip_id, start_time)
        WHERE t.trip_id IS NULL OR coalesce({wins}, FALSE)"""


_STRICT = "s.end_time >= t.end_time"
_SUBQUERIES["current_b"] = _merged(_STRICT, "accepted_a", "accepted_b")
_OPEN = "t.end_time IS NULL OR s.end_time >= t.end_time"
_LINE_OK = "event_type <> 'error'"


def oracle_sql() -> dict[str, str]:
    enriched = _using("enriched")
    judged = _using("judged")
    week_from = f"start_time >= DATE '{X.AS_OF}' - 7"
    day_stats = f"""stats AS (
        SELECT route_id, vehicle_type, avg(minutes) AS mean, coalesce(stddev_samp(minutes), 0) AS sd
        FROM enriched WHERE {_FINISHED} AND trip_date BETWEEN DATE '{X.AS_OF}' - 7 AND DATE '{X.AS_OF}' GROUP BY ALL)"""
    in_run = f"sfn_execution_id = '{X.RUN_ID}'"
    on_day = f"trip_date = DATE '{X.AS_OF}'"
    kept = f"{enriched}, {_STATS}, {_scored(_IN_RANGE)}"
    rows = "trip_id, route_id, vehicle_id, status, start_time, end_time, distance_km, sfn_execution_id"
    runs = _using("accepted_a", "accepted_b")
    in_week = f"trip_date BETWEEN DATE '{X.AS_OF}' - 6 AND DATE '{X.AS_OF}'"
    # After the second run all tables describe the merged trips; outliers are those of that run.
    merged = f"{_using('enriched_b')}, enriched AS (SELECT * FROM enriched_b)"
    accepted_lines = f"""
            SELECT trip_id, route_id, vehicle_id, status, start_time, end_time, distance_km,
                   TIMESTAMP '{X.AS_OF}' AS ingested_at
            FROM judged_lines WHERE quarantine_reason IS NULL"""
    calendar = """calendar AS (
        SELECT CAST(unnest(generate_series(min(trip_date), max(trip_date) + 6, INTERVAL 1 DAY)) AS DATE) AS calculation_date
        FROM enriched)"""
    again = _daily(_MEAN, "max(us) / 6e7", "enriched_again", "hours_again", in_week)
    return {
        "daily_ridership": f"{enriched}, {_HOURS} {_DAILY}",
        "daily_ridership_minutes": f"{enriched}, {_HOURS} {_daily('avg(minutes)', 'CAST(max(minutes) AS DOUBLE)')}",
        "hourly_counts": f"{enriched}, {_HOURS} SELECT {_GROUP}, CAST(hr AS INTEGER) AS trip_hour, n AS hour_trip_count FROM hours",
        "peak_hour": f"{enriched}, {_HOURS} SELECT {_GROUP}, CAST(hr AS INTEGER) AS peak_hour FROM hours WHERE place = 1",
        "weekly_rolling_counts": f"{enriched}, {_CALENDAR}, {_ROLLING} SELECT * FROM rolling",
        "weekly_top_routes": f"{enriched}, {_CALENDAR}, {_ROLLING}, {_RANKED} {_WEEKLY}",
        "top_routes_last_week": f"""{_using('trips')}, totals AS (
            SELECT route_id, count(*) AS total_trips, {_DONE} AS total_completed_trips,
                   round(avg(datesub('minute', start_time, end_time)), 1) AS avg_trip_duration_minutes
            FROM trips WHERE {week_from} GROUP BY ALL)
            SELECT CAST(row_number() OVER (ORDER BY total_trips DESC, route_id) AS INTEGER) AS route_rank, *
            FROM totals QUALIFY route_rank <= 10""",
        "date_spine": """SELECT CAST(d AS DATE) AS calculation_date FROM (
            SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d FROM events)""",
        "trip_outliers_run": f"{enriched}, {_STATS}, {_scored(in_run)} {_outliers(repr(S.OUTLIER_NONE))}",
        "trip_outliers_dates": f"{kept} {_outliers(repr(S.OUTLIER_NONE))}",
        "trip_outliers_day": f"{enriched}, {day_stats}, {_scored(on_day, 'minutes')} {_outliers('NULL')}",
        "route_duration_stats": f"""{enriched}, {_STATS}
            SELECT route_id, vehicle_type, mean AS avg_duration_minutes, round(sd, 6) AS stddev_duration_minutes FROM stats""",
        "zscores": f"{kept} SELECT trip_id, duration_minutes, round(z, 6) AS z_score FROM scored",
        "enrich_trips": f"{enriched} SELECT {rows}, vehicle_type, capacity FROM enriched",
        "load_window": f"""{_using('trips')} SELECT * FROM trips
            WHERE CAST(start_time AS DATE) BETWEEN DATE '{X.AS_OF}' - 6 AND DATE '{X.AS_OF}' + 6""",
        "normalize_trips": f"{_using('raw')} SELECT {_SILVER} FROM raw WHERE NOT corrupt",
        "classify_reasons": f"{judged} SELECT CASE WHEN corrupt THEN NULL ELSE trip_id END AS trip_id, note, quarantine_reason FROM judged",
        "quarantine_by_reason": f"""{judged} SELECT quarantine_reason, count(*) AS bad_rows FROM judged
            WHERE quarantine_reason IS NOT NULL GROUP BY ALL""",
        "clean_trips": f"{judged} {_CLEAN}",
        "semi_routes": f"{_using('trips', 'routes')} SELECT * FROM trips WHERE route_id IN (SELECT route_id FROM routes)",
        "anti_routes": f"{_using('trips', 'routes')} SELECT * FROM trips WHERE route_id NOT IN (SELECT route_id FROM routes)",
        "anti_vehicles": f"{_using('trips', 'vehicles')} SELECT * FROM trips WHERE vehicle_id NOT IN (SELECT vehicle_id FROM vehicles)",
        "dedupe_batch": f"""{_using('deliveries')} SELECT * FROM deliveries QUALIFY row_number() OVER (
            PARTITION BY trip_id, route_id, vehicle_id, start_time, end_time
            ORDER BY status = 'completed' DESC, distance_km DESC, status, sfn_execution_id) = 1""",
        "latest_per_trip": f"""{_using('deliveries')} SELECT * FROM deliveries QUALIFY row_number() OVER (
            PARTITION BY trip_id ORDER BY status = 'completed' DESC, end_time DESC NULLS LAST,
            start_time DESC, distance_km DESC, status, sfn_execution_id) = 1""",
        "merge_strict": f"{_using('trips', 'redelivered')} {_merged(_STRICT)}",
        "merge_open": f"{_using('trips', 'redelivered')} {_merged(_OPEN)}",
        "merge_small_batch": f"{_using('trips', 'redelivered')} {_merged(_STRICT)}",
        "replace_date_range": f"""{_using('trips', 'redelivered')}
            SELECT * FROM trips WHERE CAST(start_time AS DATE) NOT BETWEEN DATE '{X.AS_OF}' - 6 AND DATE '{X.AS_OF}'
            UNION ALL BY NAME SELECT * FROM redelivered
            WHERE CAST(start_time AS DATE) BETWEEN DATE '{X.AS_OF}' - 6 AND DATE '{X.AS_OF}'""",
        "latest_daily": f"""{enriched}, {_HOURS}, daily AS ({_DAILY})
            SELECT {_GROUP}, total_trips, peak_hour FROM daily
            ORDER BY trip_date DESC, total_trips DESC, route_id, vehicle_type LIMIT 10""",
        "latest_top_routes": f"""{enriched}, {_CALENDAR}, {_ROLLING}, {_RANKED}
            SELECT calculation_date, route_rank, route_id, total_trips, avg_trip_duration_minutes FROM ranked
            WHERE route_rank <= 10 ORDER BY calculation_date DESC, route_rank LIMIT 10""",
        "worst_outliers": f"""{kept}, outliers AS ({_outliers(repr(S.OUTLIER_NONE))})
            SELECT trip_id, route_id, start_time, duration_minutes, z_score, outlier_reason FROM outliers
            ORDER BY z_score DESC, trip_id LIMIT 10""",
        "batch_metrics": f"""{judged} SELECT count(*) AS clean_count,
            strftime(min(start_time), '%Y-%m-%d') AS start_date, strftime(max(start_time), '%Y-%m-%d') AS end_date
            FROM judged WHERE quarantine_reason IS NULL""",
        "csv_scan": f"""{_using('judged_lines')}
            SELECT trip_id, quarantine_reason, is_corrupt FROM judged_lines""",
        "distinct_paths": "SELECT DISTINCT url AS path FROM pages",
        "quarantine_roundtrip": f"""{judged}
            SELECT CASE WHEN NOT corrupt THEN trip_id
                        WHEN event_id % 97 = 0 THEN '  ' ELSE ' T' || event_id || ' ' END AS trip_id,
                   note, quarantine_reason, CASE WHEN corrupt THEN event_id || ';' || note END AS _corrupt_record,
                   TIMESTAMP '{X.AS_OF}' AS quarantined_at
            FROM judged WHERE quarantine_reason IS NOT NULL""",
        "run_metadata": f"""{judged} SELECT '{X.BATCH_ID}' AS sfn_execution_id,
            strftime(min(start_time), '%Y-%m-%d') AS start_date, strftime(max(start_time), '%Y-%m-%d') AS end_date
            FROM judged WHERE quarantine_reason IS NULL""",
        "branch_read": f"{runs} {_merged(_STRICT, 'accepted_a', 'accepted_b')}",
        "branch_publish": f"{runs} SELECT * FROM accepted_a UNION ALL BY NAME SELECT * FROM accepted_b",
        "two_staged_runs": f"{runs} {_merged(_STRICT, 'accepted_a', 'accepted_b')}",
        "branch_audit": f"""{runs}, merged AS ({_merged(_STRICT, 'accepted_a', 'accepted_b')})
            SELECT 'active' AS table, CAST(start_time AS DATE) AS start_date, count(*) AS found_rows, TRUE AS intact
            FROM merged WHERE start_date IN (SELECT CAST(start_time AS DATE) FROM accepted_b) GROUP BY ALL
            UNION ALL SELECT 'history', NULL, count(*), TRUE FROM accepted_b""",
        "restaged_branch": f"{runs} SELECT * REPLACE ('run_a' AS sfn_execution_id) FROM ({_merged(_STRICT, 'accepted_a', 'accepted_b')})",
        "gold_replace": f"""{_using('enriched', 'enriched_again')}, {_HOURS},
            {_hours('enriched_again', 'hours_again', in_week)},
            daily AS ({_DAILY}), daily_again AS ({again})
            SELECT * FROM daily WHERE NOT ({in_week}) UNION ALL BY NAME SELECT * FROM daily_again""",
        "stream_batches": f"""{_using('judged_lines')}
            SELECT trip_id, route_id, vehicle_id, status, start_time, end_time, distance_km,
                   TIMESTAMP '{X.AS_OF}' AS ingested_at
            FROM judged_lines WHERE quarantine_reason IS NULL""",
        "stream_late_files": f"{_using('judged_lines')} {accepted_lines}",
        "stream_replay": f"""{_using('judged_lines')}
            SELECT kept_in, trip_id, CAST(start_time AS DATE) AS start_date, 0 AS batch
            FROM judged_lines, (VALUES ('active'), ('history')) AS t(kept_in) WHERE quarantine_reason IS NULL""",
        "run_gold_daily": f"{merged}, {_hours(dates='TRUE')} {_daily(_MEAN, 'max(us) / 6e7', dates='TRUE')}",
        "run_gold_weekly": f"{merged}, {calendar}, {_ROLLING}, {_RANKED} {_WEEKLY}",
        "run_gold_outliers": f"""{merged}, {_STATS}, {_scored("sfn_execution_id = 'run_b'")} {_outliers(repr(S.OUTLIER_NONE))}""",
        "gold_skipped": f"""SELECT '{S.REASON_ROUTE}' AS quarantine_reason, count(*) AS bad_rows,
            0 AS gold_entries, CAST(0 AS BIGINT) AS clean_rows FROM events""",
        "csv_lineage": f"SELECT 'T' || event_id AS trip_id, {_STATUS} AS folder FROM events",
        "discovered_scan": f"""{_using('lines')} SELECT trip_id, 'r' || CAST(substr(route_id, 2) AS INTEGER) AS route_id,
            distance_km, 'double' AS distance_type FROM lines WHERE NOT is_corrupt""",
        "mixed_headers_scan": f"""SELECT {', '.join(f'CASE WHEN {_LINE_OK} THEN {value} END AS {name}' for name, value in {
            'trip_id': "'T' || event_id", 'vehicle_id': "'v' || user_id", 'route_id': "'r' || (user_id % 27)", 'distance_km': 'value / 4',
            'status': _STATUS, 'vehicle_id_raw': "'V' || user_id"}.items())}, NOT ({_LINE_OK}) AS is_corrupt FROM events""",
        "dimension_scan": f"{_using('vehicles')} SELECT * FROM vehicles",
        "from_csv_corrupt": f"""SELECT 'T' || event_id AS trip_id, NOT ({_LINE_OK}) AS is_corrupt FROM events""",
    }
