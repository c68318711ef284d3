"""The same answers in plain SQL over the given tables, written independently of the operators.

Means are rounded twice: the engines add doubles in different orders, and the
first rounding removes that noise before the second one could tip over at a tie.
"""

from __future__ import annotations

_EVENT_BASE = """
event_base AS (
  SELECT event_id, user_id, value,
         CASE event_id % 3 WHEN 0 THEN 'yellow' WHEN 1 THEN 'green' ELSE 'fhv' END AS service_type,
         ts + INTERVAL 350 DAY AS pickup_datetime,
         CASE WHEN event_id % 41 = 0 THEN NULL
              WHEN event_id % 43 = 0 THEN ts + INTERVAL 350 DAY - INTERVAL 60 SECOND
              ELSE ts + INTERVAL 350 DAY + to_seconds(CAST(round(value * 60) AS BIGINT)) END AS dropoff_datetime,
         [132, 138, 1, 161, 162, 163, 237, 236, 230, 142][user_id % 10 + 1] AS pu,
         CASE WHEN event_id % 3 = 2 AND event_id % 5 = 0 THEN NULL ELSE user_id % 265 + 1 END AS do_id,
         event_id % 3 = 2 AS is_fhv
  FROM events)"""

_EVENT_RAW = """
event_raw AS (
  SELECT service_type, pickup_datetime, dropoff_datetime,
         CAST(pu AS INTEGER) AS pu_location_id, CAST(do_id AS INTEGER) AS do_location_id,
         CAST(CASE WHEN NOT is_fhv THEN user_id % 6 + 1 END AS INTEGER) AS passenger_count,
         CASE WHEN NOT is_fhv THEN value / 5 END AS trip_distance,
         CASE WHEN NOT is_fhv THEN value * 0.8 END AS fare_amount,
         CASE WHEN NOT is_fhv THEN value END AS total_amount
  FROM event_base)"""

_SHIPPED_RAW = """
shipped_start AS (
  SELECT *, l_shipdate + to_seconds((l_orderkey * 7919 + l_linenumber * 3571) % 86400) AS pickup_datetime
  FROM lineitem),
shipped_raw AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'yellow' WHEN 'N' THEN 'green' WHEN 'R' THEN 'fhv' END AS service_type,
         pickup_datetime,
         pickup_datetime + to_seconds(CAST(l_quantity * l_linenumber * 60 AS BIGINT)) AS dropoff_datetime,
         CAST(l_suppkey % 265 + 1 AS INTEGER) AS pu_location_id,
         CAST(l_partkey % 265 + 1 AS INTEGER) AS do_location_id,
         CAST(l_linenumber AS INTEGER) AS passenger_count,
         l_quantity AS trip_distance,
         l_extendedprice * (1 - l_discount) AS fare_amount,
         l_extendedprice AS total_amount
  FROM shipped_start)"""


def _trips(name: str, raw: str) -> str:
    return f"""
{name}_timed AS (
  SELECT *,
         CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
         CAST(day(pickup_datetime) AS INTEGER) AS day, CAST(hour(pickup_datetime) AS INTEGER) AS hour,
         CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS dow,
         CAST(date_diff('second', pickup_datetime, dropoff_datetime) AS DOUBLE) AS trip_duration_sec
  FROM {raw}),
{name} AS (
  SELECT *,
         trip_duration_sec IS NOT NULL AND trip_duration_sec > 0 AND trip_duration_sec <= 14400 AS valid_time,
         pu_location_id IS NOT NULL AND do_location_id IS NOT NULL AS valid_locations
  FROM {name}_timed)"""


_A = ",".join([_EVENT_BASE, _EVENT_RAW, _trips("trips", "event_raw")])
_B = ",".join([_SHIPPED_RAW, _trips("trips", "shipped_raw")])

_DEMAND = """
demand AS (
  SELECT service_type, pu_location_id AS zone_id, date_trunc('hour', pickup_datetime) AS ts_hour,
         count(*) AS pickups, avg(total_amount) AS avg_total_amount, avg(trip_distance) AS avg_trip_distance,
         quantile_disc(trip_duration_sec, 0.5) AS p50_duration,
         quantile_disc(trip_duration_sec, 0.95) AS p95_duration
  FROM trips WHERE valid_time AND valid_locations
  GROUP BY ALL)"""

_RELIABILITY = """
reliability AS (
  SELECT service_type, pu_location_id AS zone_id, hour, count(*) AS trip_count,
         avg(CASE WHEN trip_duration_sec > 2700 THEN 1 ELSE 0 END) AS share_long_trips
  FROM trips WHERE valid_time AND valid_locations
  GROUP BY ALL)"""

_MONTHLY = """
monthly AS (
  SELECT service_type, year, month, count(*) AS trips, count(DISTINCT pu_location_id) AS unique_pu_zones,
         avg(trip_duration_sec) AS avg_duration_sec, quantile_disc(trip_duration_sec, 0.95) AS p95_duration_sec
  FROM trips WHERE valid_time
  GROUP BY service_type, year, month)"""

_DEMAND_COLUMNS = """service_type, zone_id, ts_hour, pickups,
  round(round(avg_total_amount, 10), 6) AS avg_total_amount, round(round(avg_trip_distance, 10), 6) AS avg_trip_distance,
  p50_duration, p95_duration"""

_TRIP_COLUMNS = """service_type, pickup_datetime, dropoff_datetime, pu_location_id, do_location_id,
  passenger_count, round(round(trip_distance, 10), 6) AS trip_distance, round(round(fare_amount, 10), 6) AS fare_amount,
  round(round(total_amount, 10), 6) AS total_amount, year, month, day, hour, dow, trip_duration_sec,
  valid_time, valid_locations"""


def _features(source: str, partition: str, order: str, name: str = "built") -> str:
    series = f"PARTITION BY {partition} ORDER BY {order}"
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT *,
      lag(pickups, 1) OVER s AS lag_1, lag(pickups, 23) OVER s AS lag_23, lag(pickups, 24) OVER s AS lag_24,
      lag(pickups, 168) OVER s AS lag_168,
      avg(pickups) OVER ({series} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS rolling_mean_24,
      avg(pickups) OVER ({series} ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS rolling_mean_168,
      CAST(hour(ts_hour) AS INTEGER) AS hour_of_day, CAST(dayofweek(ts_hour) + 1 AS INTEGER) AS day_of_week,
      CAST(month(ts_hour) AS INTEGER) AS month_num,
      lead(pickups, 1) OVER s AS label,
      CAST(year(ts_hour) AS INTEGER) AS feat_year, CAST(month(ts_hour) AS INTEGER) AS feat_month
    FROM {source}
    WINDOW s AS ({series})) AS windows
  WHERE lag_168 IS NOT NULL AND label IS NOT NULL)"""


_BUSIEST_50 = """
busiest AS (
  SELECT * FROM demand WHERE zone_id IN (
    SELECT zone_id FROM demand GROUP BY zone_id ORDER BY sum(pickups) DESC, zone_id LIMIT 50))"""

_DENSE = """
hours AS (SELECT unnest(generate_series(TIMESTAMP '2024-12-01', TIMESTAMP '2025-01-31 23:00:00', INTERVAL 1 HOUR)) AS ts_hour),
dense AS (
  SELECT g.service_type, g.zone_id, h.ts_hour, coalesce(b.pickups, 0) AS pickups,
         b.avg_total_amount, b.avg_trip_distance, b.p50_duration, b.p95_duration
  FROM (SELECT DISTINCT service_type, zone_id FROM busiest
        WHERE ts_hour BETWEEN TIMESTAMP '2024-12-01' AND TIMESTAMP '2025-01-31 23:00:00') AS g CROSS JOIN hours AS h
  LEFT JOIN busiest AS b
    ON b.service_type = g.service_type AND b.zone_id = g.zone_id AND b.ts_hour = h.ts_hour)"""

_FEATURE_COLUMNS = f"""{_DEMAND_COLUMNS}, lag_1, lag_24, lag_168,
  round(round(rolling_mean_24, 10), 6) AS rolling_mean_24, round(round(rolling_mean_168, 10), 6) AS rolling_mean_168,
  hour_of_day, day_of_week, month_num, label, feat_year, feat_month"""

_BY_ZONE = _features("busiest", "zone_id", "ts_hour, service_type")
_BY_SERVICE_ZONE = _features("busiest", "service_type, zone_id", "ts_hour")
_DENSE_FEATURES = _features("dense", "service_type, zone_id", "ts_hour")
_TRAIN = "feat_year < 2024 OR (feat_year = 2024 AND feat_month <= 12)"
_TEST = "feat_year > 2025 OR (feat_year = 2025 AND feat_month >= 1)"

_TEST_ERRORS = f"""
errors AS (
  SELECT avg(abs(label - lag_24)) AS mae_24, sqrt(avg((label - lag_24) * (label - lag_24))) AS rmse_24,
         avg(abs(label - lag_23)) AS mae_23, sqrt(avg((label - lag_23) * (label - lag_23))) AS rmse_23
  FROM built WHERE {_TEST})"""

_SERVICES = "(SELECT unnest(['yellow', 'green', 'fhv']) AS service_type) AS s"


def _calendar(first: str, last: str, source: str = "") -> str:
    return f"""
calendar AS (
  SELECT s.service_type, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month
  FROM {_SERVICES} CROSS JOIN (
    SELECT unnest(generate_series({first}, {last}, INTERVAL 1 MONTH)) AS d {source}) AS months)"""


_SHIPPED_CALENDAR = _calendar(
    "date_trunc('month', min(pickup_datetime))::TIMESTAMP",
    "date_trunc('month', max(pickup_datetime))::TIMESTAMP",
    "FROM trips",
)

_LANDED = """
landed AS (SELECT * FROM trips WHERE service_type = 'green' AND year = 1995 AND month = 6)"""

# What the loader should see of the drifting files: no measures for fhv, no yellow fares in odd years.
_MONTH_TOTALS = """
  service_type, year, month, count(*) AS trips,
  CAST(count(*) FILTER (valid_time) AS BIGINT) AS valid_trips,
  sum(trip_duration_sec) AS duration_sec,
  CAST(sum(pu_location_id) AS BIGINT) AS pu_sum,
  CAST(sum(passenger_count) FILTER (service_type <> 'fhv') AS BIGINT) AS passengers,
  round(sum(fare_amount) FILTER (service_type = 'green' OR (service_type = 'yellow' AND year % 2 = 0)), 4) AS fares,
  round(sum(total_amount) FILTER (service_type <> 'fhv'), 4) AS amount"""


_BOXES = """
grouped AS (
  SELECT *, CASE WHEN zone_id IN (132, 138, 1) THEN 'Airport' ELSE 'Midtown' END AS zone_group
  FROM reliability WHERE zone_id IN (132, 138, 1, 161, 162, 163)),
boxes AS (
  SELECT zone_group, quantile_cont(share_long_trips, 0.25) AS q1, quantile_cont(share_long_trips, 0.5) AS "median",
         quantile_cont(share_long_trips, 0.75) AS q3
  FROM grouped GROUP BY zone_group),
beside AS (
  SELECT *, share_long_trips BETWEEN q1 - 1.5 * (q3 - q1) - 1e-9 AND q3 + 1.5 * (q3 - q1) + 1e-9 AS inside
  FROM grouped JOIN boxes USING (zone_group))"""

_DELIVERED = ",".join(
    [
        _SHIPPED_RAW,
        _trips("all_trips", "shipped_raw"),
        """
trips AS (
  SELECT * REPLACE (CASE WHEN service_type <> 'fhv' THEN total_amount END AS total_amount,
                    CASE WHEN service_type <> 'fhv' THEN trip_distance END AS trip_distance)
  FROM all_trips WHERE NOT (service_type = 'fhv' AND year = 1998))""",
    ]
)

_DENSE_TRAIN = f"""
train AS (
  SELECT *, CAST(epoch(ts_hour) // 3600 AS BIGINT) AS h FROM built WHERE {_TRAIN}),
bounds AS (SELECT min(h) AS first, max(h) AS last, (max(h) - min(h) + 1) // 4 AS block FROM train),
folds AS (
  SELECT k - 1 AS fold, first + block * k AS valid_from, CASE WHEN k = 3 THEN last + 1 ELSE first + block * (k + 1) END AS valid_before
  FROM bounds, (SELECT unnest([1, 2, 3]) AS k) AS ks)"""


def _month_columns() -> str:
    """Headers and types of each service's files, as the drifting months are written."""

    def listed(ids: str, count: str, times: str, zones: str, measures: str) -> str:
        pairs = [(c, "timestamp_ntz") for c in times.split()] + [(c, ids) for c in zones.split()]
        pairs += [(c, count if c == "passenger_count" else "double") for c in measures.split()]
        return ", ".join(f"('{c}', '{t}')" for c, t in pairs)

    zones, measures = "PULocationID DOLocationID", "passenger_count trip_distance fare_amount total_amount"
    variants = {
        "service_type = 'yellow' AND year % 2 = 0": ("bigint", "int", "tpep_pickup_datetime tpep_dropoff_datetime", zones, measures),
        "service_type = 'yellow' AND year % 2 = 1": (
            "double", "double", "Tpep_Pickup_Datetime Tpep_Dropoff_Datetime", zones, measures.replace("fare_amount ", ""),
        ),
        "service_type = 'green'": ("bigint", "int", "lpep_pickup_datetime lpep_dropoff_datetime", zones, measures),
        "service_type = 'fhv' AND year % 2 = 0": ("bigint", "int", "pickup_datetime dropOff_datetime", "PUlocationID DOlocationID", ""),
        "service_type = 'fhv' AND year % 2 = 1": ("double", "double", "Pickup_datetime DropOff_datetime", zones, ""),
    }
    return " UNION ALL ".join(
        f"SELECT DISTINCT service_type, year, month, column_name, data_type FROM trips, (VALUES {listed(*v)}) AS c(column_name, data_type) WHERE {test}"
        for test, v in variants.items()
    )


def _with(*ctes: str, select: str) -> str:
    return f"WITH {','.join(ctes)}\n{select}"


def _long_share(zones: str) -> str:
    return _with(
        _A,
        _RELIABILITY,
        select=f"""SELECT zone_id, round(round(avg(share_long_trips), 10), 6) AS avg_share_long,
  CAST(sum(trip_count) AS BIGINT) AS total_trips,
  round(round(sum(share_long_trips * trip_count) / sum(trip_count), 10), 6) AS weighted_share_long
FROM reliability WHERE zone_id IN ({zones}) GROUP BY zone_id""",
    )


def _heatmap_hours() -> str:
    return ", ".join(f"CAST(count(*) FILTER (hour = {h}) AS BIGINT) AS h{h:02d}" for h in range(24))


def all_oracles() -> dict[str, str]:
    return {
        "canonical_trips": _with(_A, select=f"SELECT {_TRIP_COLUMNS} FROM trips"),
        "silver_roundtrip": _with(_A, select=f"SELECT {_TRIP_COLUMNS} FROM trips"),
        "service_union": _with(
            _EVENT_BASE,
            select="""SELECT 'yellow' AS service_type, event_id, pickup_datetime AS tpep_pickup_datetime,
  dropoff_datetime AS tpep_dropoff_datetime, CAST(pu AS DOUBLE) AS "PULocationID",
  CAST(do_id AS DOUBLE) AS "DOLocationID", CAST(user_id % 6 + 1 AS DOUBLE) AS passenger_count,
  round(round(value / 5, 10), 6) AS trip_distance, round(round(value * 0.8, 10), 6) AS fare_amount, round(round(value, 10), 6) AS total_amount
FROM event_base WHERE service_type = 'yellow'
UNION ALL BY NAME
SELECT 'green' AS service_type, event_id, pickup_datetime AS lpep_pickup_datetime,
  dropoff_datetime AS lpep_dropoff_datetime, CAST(pu AS DOUBLE) AS "PULocationID",
  CAST(do_id AS DOUBLE) AS "DOLocationID", CAST(user_id % 6 + 1 AS DOUBLE) AS passenger_count,
  round(round(value / 5, 10), 6) AS trip_distance, round(round(value * 0.8, 10), 6) AS fare_amount, round(round(value, 10), 6) AS total_amount
FROM event_base WHERE service_type = 'green'
UNION ALL BY NAME
SELECT 'fhv' AS service_type, event_id, pickup_datetime, dropoff_datetime AS "dropOff_datetime",
  CAST(pu AS DOUBLE) AS "PULocationID", CAST(do_id AS DOUBLE) AS "DOLocationID"
FROM event_base WHERE service_type = 'fhv'""",
        ),
        "quality_flags_count": _with(
            _A,
            select="""SELECT count(*) AS total_rows,
  CAST(count(*) FILTER (valid_time AND valid_locations) AS BIGINT) AS valid_rows,
  round(round(count(*) FILTER (valid_time AND valid_locations) * 100.0 / count(*), 10), 6) AS valid_pct
FROM trips""",
        ),
        "trips_by_service": _with(
            _A, select="SELECT service_type, count(*) AS rows FROM trips GROUP BY service_type"
        ),
        "zone_profile": _with(
            _A,
            select="""SELECT service_type, count(DISTINCT pu_location_id) AS distinct_zones,
  min(pu_location_id) AS min_zone, max(pu_location_id) AS max_zone
FROM trips GROUP BY service_type""",
        ),
        "null_profile": _with(
            _A,
            select="""SELECT service_type, count(total_amount) AS non_null_total_amount,
  count(trip_distance) AS non_null_trip_distance, count(trip_duration_sec) AS non_null_duration,
  count(pu_location_id) AS non_null_pu_loc
FROM trips GROUP BY service_type""",
        ),
        "zone_hour_demand": _with(_A, _DEMAND, select=f"SELECT {_DEMAND_COLUMNS} FROM demand"),
        "zone_hour_demand_2025": _with(
            _A, _DEMAND, select=f"SELECT {_DEMAND_COLUMNS} FROM demand WHERE year(ts_hour) = 2025"
        ),
        "monthly_service_summary": _with(
            _B,
            _MONTHLY,
            select="""SELECT service_type, year, month, trips, unique_pu_zones,
  round(round(avg_duration_sec, 10), 6) AS avg_duration_sec, p95_duration_sec FROM monthly""",
        ),
        "zone_hour_reliability": _with(
            _A,
            _RELIABILITY,
            select="""SELECT service_type, zone_id, hour, trip_count,
  round(round(share_long_trips, 10), 6) AS share_long_trips FROM reliability""",
        ),
        "bench_mart_agg": _with(
            _A,
            _DEMAND,
            select="""SELECT service_type, zone_id, CAST(sum(pickups) AS BIGINT) AS total_pickups,
  round(round(avg(avg_total_amount), 10), 6) AS mean_amount
FROM demand GROUP BY service_type, zone_id""",
        ),
        "demand_heatmap": _with(
            _A,
            select="""SELECT dow, hour, count(*) AS pickups FROM trips
WHERE service_type = 'yellow' AND valid_time GROUP BY dow, hour""",
        ),
        "demand_heatmap_pivot": _with(
            _A,
            select=f"""SELECT dow, {_heatmap_hours()} FROM trips
WHERE service_type = 'yellow' AND valid_time GROUP BY dow""",
        ),
        "monthly_trend_filtered": _with(
            _B,
            _MONTHLY,
            select="""SELECT service_type, make_date(year, month, 1) AS month_date, trips,
  round(round(trips / 1e6, 10), 6) AS trips_millions
FROM monthly WHERE trips > 200""",
        ),
        "h3_airport": _long_share("132, 138, 1"),
        "h3_midtown": _long_share("161, 162, 163"),
        "zone_group_quartiles": _with(
            _A,
            _RELIABILITY,
            select="""SELECT CASE WHEN zone_id IN (132, 138, 1) THEN 'Airport' ELSE 'Midtown' END AS zone_group,
  round(round(min(share_long_trips), 10), 6) AS "min", round(round(quantile_cont(share_long_trips, 0.25), 10), 6) AS q1,
  round(round(quantile_cont(share_long_trips, 0.5), 10), 6) AS "median",
  round(round(quantile_cont(share_long_trips, 0.75), 10), 6) AS q3, round(round(max(share_long_trips), 10), 6) AS "max"
FROM reliability WHERE zone_id IN (132, 138, 1, 161, 162, 163) GROUP BY ALL""",
        ),
        "zone_group_boxes": _with(
            _A,
            _RELIABILITY,
            _BOXES,
            select="""SELECT zone_group, round(round(q1, 10), 6) AS q1, round(round("median", 10), 6) AS "median", round(round(q3, 10), 6) AS q3,
  round(round(min(share_long_trips) FILTER (inside), 10), 6) AS whisker_low,
  round(round(max(share_long_trips) FILTER (inside), 10), 6) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
FROM beside GROUP BY ALL""",
        ),
        "zone_group_outliers": _with(
            _A,
            _RELIABILITY,
            _BOXES,
            select="""SELECT zone_group, service_type, zone_id, hour, trip_count, round(round(share_long_trips, 10), 6) AS share_long_trips
FROM beside WHERE NOT inside""",
        ),
        "airport_rank_test": _with(
            _A,
            """
ranked AS (
  SELECT trip_duration_sec, pu_location_id IN (132, 138, 1) AS airport,
         rank() OVER (ORDER BY trip_duration_sec) + (count(*) OVER (PARTITION BY trip_duration_sec) - 1) / 2.0::DOUBLE AS midrank,
         count(*) OVER (PARTITION BY trip_duration_sec) AS tied
  FROM trips WHERE valid_time AND valid_locations AND pu_location_id IN (132, 138, 1, 161, 162, 163)),
sums AS (
  SELECT count(*) FILTER (airport) AS n1, count(*) FILTER (NOT airport) AS n2, sum(midrank) FILTER (airport) AS r1,
         sum(tied::DOUBLE * tied - 1) AS ties, count(*)::DOUBLE AS n
  FROM ranked),
tested AS (
  SELECT *, r1 - n1 * (n1 + 1) / 2.0::DOUBLE AS u,
         sqrt(n1::DOUBLE * n2 / 12 * (n + 1 - ties / (n * (n - 1)))) AS spread FROM sums),
scored AS (SELECT *, (u - n1::DOUBLE * n2 / 2) / spread AS z, 1 / (1 + 0.3275911 * abs((u - n1::DOUBLE * n2 / 2) / spread) / sqrt(2)) AS t FROM tested)""",
            select="""SELECT n1 AS n_first, n2 AS n_second, round(round(u, 10), 6) AS u, round(round(u / (n1::DOUBLE * n2), 10), 6) AS superiority,
  round(round(z, 10), 6) AS z, round(round((0.254829592 * t - 0.284496736 * t ** 2 + 1.421413741 * t ** 3 - 1.453152027 * t ** 4
    + 1.061405429 * t ** 5) * exp(-z * z / 2), 10), 6) AS p FROM scored""",
        ),
        "sized_subset": _with(
            _A,
            """
placed AS (
  SELECT *, ('0x' || substr(md5(concat_ws('|', service_type, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'),
           strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S'), pu_location_id, do_location_id)), 1, 6))::BIGINT AS place,
         86 + strlen(service_type) AS bytes FROM trips),
reached AS (SELECT place, sum(sum(bytes)) OVER (ORDER BY place) AS upto FROM placed GROUP BY place)""",
            select=f"""SELECT {_TRIP_COLUMNS} FROM placed
WHERE place < (SELECT coalesce(min(place), 16777216) FROM reached WHERE upto > 250000)""",
        ),
        "top_zones": _with(
            _A,
            _DEMAND,
            select="""SELECT zone_id, CAST(sum(pickups) AS BIGINT) AS total_pickups FROM demand
GROUP BY zone_id ORDER BY total_pickups DESC, zone_id LIMIT 5""",
        ),
        "subset_top_zones": _with(
            _A,
            "chosen AS (SELECT * FROM trips WHERE service_type = 'green' AND year = 2024 AND month = 12)",
            select=f"""SELECT {_TRIP_COLUMNS} FROM chosen WHERE pu_location_id IN (
  SELECT pu_location_id FROM chosen GROUP BY pu_location_id
  ORDER BY count(*) DESC, pu_location_id NULLS FIRST LIMIT 3)""",
        ),
        "month_spine": _with(
            _B, _SHIPPED_CALENDAR, select="SELECT service_type, year, month FROM calendar"
        ),
        "expected_files": _with(
            _B,
            _SHIPPED_CALENDAR,
            select="SELECT service_type, count(*) AS expected_files FROM calendar GROUP BY service_type",
        ),
        "missing_months": _with(
            _A,
            _calendar("TIMESTAMP '2022-01-01'", "TIMESTAMP '2025-11-01'"),
            select="""SELECT service_type, year, month FROM calendar AS c
WHERE NOT EXISTS (SELECT 1 FROM trips AS t
  WHERE t.service_type = c.service_type AND t.year = c.year AND t.month = c.month)""",
        ),
        "loaded_months": _with(
            _B,
            select=f"""SELECT {_MONTH_TOTALS}, count(*) AS in_source_month
FROM trips GROUP BY service_type, year, month""",
        ),
        "raw_provenance": _with(
            _B,
            select="""SELECT service_type, year AS src_year, month AS src_month, count(*) AS rows
FROM trips GROUP BY service_type, year, month""",
        ),
        "landing_report": _with(
            _B,
            _calendar("TIMESTAMP '1994-01-01'", "TIMESTAMP '2002-12-01'"),
            select="""SELECT service_type, year, month, EXISTS (SELECT 1 FROM trips AS t
  WHERE t.service_type = c.service_type AND t.year = c.year AND t.month = c.month) AS landed
FROM calendar AS c""",
        ),
        "probed_columns": _with(_B, select=_month_columns()),
        "silver_changes": _with(
            _B,
            select="""SELECT service_type, year AS src_year, month AS src_month,
  CASE WHEN service_type = 'fhv' AND year = 1998 THEN 'removed' WHEN year >= 2001 THEN 'added' ELSE 'replaced' END AS change
FROM (SELECT DISTINCT service_type, year, month FROM trips) AS months
WHERE year >= 2001 OR (service_type = 'green' AND year = 1996) OR (service_type = 'fhv' AND year = 1998)""",
        ),
        "silver_increments": _with(
            _DELIVERED,
            select=f"""SELECT {_MONTH_TOTALS}, CAST(count(*) AS BIGINT) AS manifest_rows,
  CAST(CASE WHEN year >= 2001 OR (service_type = 'green' AND year = 1996) THEN 2 ELSE 1 END AS INTEGER) AS written_in
FROM trips GROUP BY service_type, year, month""",
        ),
        "kept_demand": _with(_DELIVERED, _DEMAND, select=f"SELECT {_DEMAND_COLUMNS} FROM demand"),
        "kept_monthly_summary": _with(
            _DELIVERED,
            _MONTHLY,
            select="""SELECT service_type, year, month, trips, unique_pu_zones,
  round(round(avg_duration_sec, 10), 6) AS avg_duration_sec, p95_duration_sec FROM monthly""",
        ),
        "kept_reliability": _with(
            _DELIVERED,
            _RELIABILITY,
            select="""SELECT service_type, zone_id, hour, trip_count,
  round(round(share_long_trips, 10), 6) AS share_long_trips FROM reliability""",
        ),
        "zones_by_quarter": _with(
            _DELIVERED,
            select="""SELECT service_type, year, CAST(quarter(pickup_datetime) AS INTEGER) AS quarter,
  count(DISTINCT pu_location_id) AS unique_pu_zones
FROM trips WHERE valid_time GROUP BY ALL""",
        ),
        "sketched_durations": _with(
            _DELIVERED,
            select="""SELECT service_type, year, CAST(share AS DOUBLE) AS share, true AS within_bound
FROM (SELECT DISTINCT service_type, year FROM trips WHERE valid_time) AS years, (VALUES (0.5), (0.95)) AS s(share)""",
        ),
        "recode_proof": _with(
            _B,
            select="""SELECT service_type, year, month, rows AS rows_before, rows AS rows_after, equal, equal AS adopted
FROM (SELECT service_type, year, month, count(*) AS rows, NOT (service_type = 'green' AND year = 1997 AND month = 3) AS equal
      FROM trips GROUP BY service_type, year, month) AS months""",
        ),
        "reencoded": _with(
            _B, select=f"SELECT {_MONTH_TOTALS} FROM trips GROUP BY service_type, year, month"
        ),
        "features_top_zones": _with(
            _A,
            _DEMAND,
            select=f"""SELECT {_DEMAND_COLUMNS} FROM demand WHERE zone_id IN (
  SELECT zone_id FROM demand GROUP BY zone_id ORDER BY sum(pickups) DESC, zone_id LIMIT 5)""",
        ),
        "lag_features": _with(
            _A,
            _DEMAND,
            select="""SELECT service_type, zone_id, ts_hour, pickups, lag(pickups, 1) OVER s AS lag_1,
  lag(pickups, 24) OVER s AS lag_24, lag(pickups, 168) OVER s AS lag_168, lead(pickups, 1) OVER s AS label
FROM demand WINDOW s AS (PARTITION BY service_type, zone_id ORDER BY ts_hour)""",
        ),
        "rolling_features": _with(
            _A,
            _DEMAND,
            select="""SELECT service_type, zone_id, ts_hour,
  round(avg(pickups) OVER (PARTITION BY service_type, zone_id ORDER BY ts_hour
    ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 6) AS rolling_mean_24,
  round(avg(pickups) OVER (PARTITION BY service_type, zone_id ORDER BY ts_hour
    ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING), 6) AS rolling_mean_168
FROM demand""",
        ),
        "forecast_features": _with(
            _A, _DEMAND, _BUSIEST_50, _BY_ZONE, select=f"SELECT {_FEATURE_COLUMNS} FROM built"
        ),
        "forecast_features_by_service": _with(
            _A, _DEMAND, _BUSIEST_50, _BY_SERVICE_ZONE, select=f"SELECT {_FEATURE_COLUMNS} FROM built"
        ),
        "features_densified": _with(
            _A, _DEMAND, _BUSIEST_50, _DENSE, _DENSE_FEATURES, select=f"SELECT {_FEATURE_COLUMNS} FROM built"
        ),
        "features_by_clock": _with(
            _A,
            _DEMAND,
            _BUSIEST_50,
            _DENSE,
            _DENSE_FEATURES,
            select=f"SELECT {_FEATURE_COLUMNS} FROM built WHERE p50_duration IS NOT NULL",
        ),
        "forward_fold_sizes": _with(
            _A,
            _DEMAND,
            _BUSIEST_50,
            _DENSE,
            _DENSE_FEATURES,
            _DENSE_TRAIN,
            select="""SELECT CAST(fold AS INTEGER) AS fold, role, count(*) AS rows, min(ts_hour) AS first_hour, max(ts_hour) AS last_hour
FROM (
  SELECT fold, 'train' AS role, ts_hour FROM train JOIN folds ON h < valid_from - 168
  UNION ALL SELECT fold, 'validate', ts_hour FROM train JOIN folds ON h >= valid_from AND h < valid_before) AS sides
GROUP BY fold, role""",
        ),
        "train_split": _with(
            _A, _DEMAND, _BUSIEST_50, _BY_ZONE, select=f"SELECT {_FEATURE_COLUMNS} FROM built WHERE {_TRAIN}"
        ),
        "test_split": _with(
            _A, _DEMAND, _BUSIEST_50, _BY_ZONE, select=f"SELECT {_FEATURE_COLUMNS} FROM built WHERE {_TEST}"
        ),
        "baseline_metrics": _with(
            _A,
            _DEMAND,
            _BUSIEST_50,
            _BY_ZONE,
            _TEST_ERRORS,
            select="""SELECT 'baseline_lag24' AS model, round(round(mae_24, 10), 6) AS mae, round(round(rmse_24, 10), 6) AS rmse FROM errors
UNION ALL SELECT 'baseline_seasonal', round(round(mae_23, 10), 6), round(round(rmse_23, 10), 6) FROM errors""",
        ),
        "baseline_improvement": _with(
            _A,
            _DEMAND,
            _BUSIEST_50,
            _BY_ZONE,
            _TEST_ERRORS,
            select="SELECT round(round((rmse_24 - rmse_23) / rmse_24 * 100, 10), 6) AS rmse_improvement_pct FROM errors",
        ),
        "busiest_zone_series": _with(
            _A,
            _DEMAND,
            _BUSIEST_50,
            _BY_ZONE,
            f"tested AS (SELECT * FROM built WHERE {_TEST})",
            select="""SELECT ts_hour, service_type, zone_id, label, lag_24 AS prediction FROM tested
WHERE zone_id = (SELECT zone_id FROM tested GROUP BY zone_id ORDER BY sum(label) DESC, zone_id LIMIT 1)
ORDER BY ts_hour, service_type""",
        ),
        "subset_job": _with(
            _B,
            _LANDED,
            select=f"""SELECT {_TRIP_COLUMNS} FROM landed WHERE pu_location_id IN (
  SELECT pu_location_id FROM landed GROUP BY pu_location_id
  ORDER BY count(*) DESC, pu_location_id NULLS FIRST LIMIT 3)""",
        ),
        "subset_fallback": _with(_B, _LANDED, select=f"SELECT {_TRIP_COLUMNS} FROM landed"),
        "cv_folds": _with(
            _A,
            _DEMAND,
            _BUSIEST_50,
            _BY_ZONE,
            select=f"""SELECT CAST(('0x' || substr(md5(zone_id || '|' || strftime(ts_hour, '%Y-%m-%d %H')), 1, 8))::BIGINT % 3 AS INTEGER)
  AS fold, count(*) AS rows FROM built WHERE {_TRAIN} GROUP BY fold""",
        ),
        "gbt_scored_rows": _with(
            _A,
            _DEMAND,
            _BUSIEST_50,
            _DENSE,
            _DENSE_FEATURES,
            select=f"""SELECT service_type, zone_id, ts_hour, pickups, lag_1, lag_23, lag_24, lag_168, label
FROM built WHERE {_TEST}""",
        ),
        "gbt_replayed": _with(
            _A,
            _DEMAND,
            _BUSIEST_50,
            _DENSE,
            _DENSE_FEATURES,
            select=f"SELECT service_type, zone_id, ts_hour, true AS agrees FROM built WHERE {_TEST}",
        ),
        "gbt_sample": _with(
            _A,
            _DEMAND,
            _BUSIEST_50,
            _DENSE,
            _DENSE_FEATURES,
            select=f"""SELECT service_type, zone_id, ts_hour, label FROM built WHERE {_TEST}
ORDER BY md5(concat_ws('|', service_type, zone_id, strftime(ts_hour, '%Y-%m-%d %H'))), service_type, zone_id, ts_hour LIMIT 500""",
        ),
        "gbt_metrics_again": "SELECT 'gbt_cv' AS model, true AS mae_agrees, true AS rmse_agrees",
        "cv_grid_points": """SELECT max_depth, max_iter, true AS judged
FROM (SELECT unnest([3, 5]) AS max_depth) AS depths, (SELECT unnest([20, 50]) AS max_iter) AS rounds""",
        "importance_total": "SELECT 8::BIGINT AS features, 1.0::DOUBLE AS total, true AS none_negative",
        "dense_baselines": _with(
            _A,
            _DEMAND,
            _BUSIEST_50,
            _DENSE,
            _DENSE_FEATURES,
            _TEST_ERRORS,
            select="""SELECT 'baseline_lag24' AS model, round(mae_24, 4) AS mae, round(rmse_24, 4) AS rmse FROM errors
UNION ALL SELECT 'baseline_seasonal', round(mae_23, 4), round(rmse_23, 4) FROM errors""",
        ),
    }
