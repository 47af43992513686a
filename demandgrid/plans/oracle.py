"""SQL twins of the queries, for DuckDB over the same Parquet tables."""

from __future__ import annotations

# --- shared pieces

TRIPS = """
trips AS (
  SELECT o_orderdate AS pickup, l_shipdate AS dropoff, l_extendedprice AS amount, l_suppkey::INTEGER AS loc,
         year(o_orderdate + INTERVAL 2 DAY)::INTEGER AS y, month(o_orderdate + INTERVAL 2 DAY)::INTEGER AS m
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

FLAGGED = TRIPS + """,
limits AS (
  SELECT y, m, quantile_cont(amount, 0.999) AS lim FROM trips WHERE NOT isnan(amount) GROUP BY y, m
),
flagged AS (
  SELECT t.*,
    coalesce(dropoff > pickup AND dropoff - pickup <= INTERVAL 180 DAY, false) AS ok_duration,
    coalesce(amount > 0 AND amount <= lim, false) AS ok_amount,
    coalesce(loc NOT IN (1, 264, 265), true) AS ok_location,
    coalesce(pickup >= make_date(t.y, t.m, 1) AND pickup < make_date(t.y, t.m, 1) + INTERVAL 1 MONTH, false) AS ok_period
  FROM trips t LEFT JOIN limits l ON t.y = l.y AND t.m = l.m
),
rides AS (
  SELECT pickup AS pickup_datetime, loc AS pickup_location_id FROM flagged
  WHERE ok_duration AND ok_amount AND ok_location AND ok_period
)"""


def _counts(source: str = "SELECT ts, user_id FROM events") -> str:
    return f"""
counts AS (
  SELECT date_trunc('hour', ts) AS pickup_hour, user_id AS pickup_location_id, count(*) AS rides
  FROM ({source}) WHERE ts IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2
)"""


FILL = """,
bounds AS (SELECT min(pickup_hour) AS lo, max(pickup_hour) AS hi FROM counts),
hours AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS pickup_hour FROM bounds),
filled AS (
  SELECT h.pickup_hour, s.pickup_location_id, coalesce(c.rides, 0)::BIGINT AS rides
  FROM hours h CROSS JOIN (SELECT DISTINCT pickup_location_id FROM counts) s
  LEFT JOIN counts c ON c.pickup_hour = h.pickup_hour AND c.pickup_location_id = s.pickup_location_id
)"""

FILLED = _counts() + FILL


def _numbered(source: str = "filled") -> str:
    return f""",
num AS (
  SELECT pickup_location_id, pickup_hour, rides,
         row_number() OVER (PARTITION BY pickup_location_id ORDER BY pickup_hour) - 1 AS pos
  FROM {source}
)"""


def _windows(size: int, step: int) -> str:
    return f""",
ends AS (
  SELECT pickup_location_id, pickup_hour, rides AS target, pos - {size} AS s
  FROM num WHERE pos >= {size} AND (pos - {size}) % {step} = 0
),
lagged AS (
  SELECT e.pickup_location_id, e.pickup_hour, e.target, k.k, v.rides
  FROM ends e CROSS JOIN (SELECT unnest(range({size})) AS k) k
  JOIN num v ON v.pickup_location_id = e.pickup_location_id AND v.pos = e.s + k.k
)"""


def _summary(size: int, target: bool = True) -> str:
    return f"""
SELECT pickup_location_id, pickup_hour, count(*)::INTEGER AS n_lags,
       max(CASE WHEN k = 0 THEN rides END) AS first_lag, max(CASE WHEN k = {size} - 1 THEN rides END) AS last_lag,
       sum(rides)::BIGINT AS lag_sum, sum(rides * (k + 1))::BIGINT AS lag_checksum{', target' if target else ''}
FROM lagged GROUP BY pickup_location_id, pickup_hour, target"""


LAGS4 = "(r168 + r336 + r504 + r672) / 4.0::DOUBLE"

# Four-week mean of every hour with four weeks of history.
BACKFILL = _numbered() + f""",
weeks AS (
  SELECT *, lag(rides, 168) OVER w AS r168, lag(rides, 336) OVER w AS r336,
            lag(rides, 504) OVER w AS r504, lag(rides, 672) OVER w AS r672
  FROM num WINDOW w AS (PARTITION BY pickup_location_id ORDER BY pickup_hour)
),
mean4 AS (SELECT *, {LAGS4} AS prediction FROM weeks WHERE pos >= 672),
preds AS (
  SELECT pickup_location_id, round_even(prediction, 0)::DOUBLE AS predicted_demand, pickup_hour FROM mean4
)"""

ERRORS = FILLED + BACKFILL + """,
errs AS (
  SELECT p.pickup_location_id, p.pickup_hour, abs(p.predicted_demand - f.rides) AS absolute_error
  FROM preds p JOIN filled f ON f.pickup_location_id = p.pickup_location_id AND f.pickup_hour = p.pickup_hour
  WHERE p.pickup_hour >= TIMESTAMP '2024-01-02 21:00:00'
)"""

USER_ZONES = """
names AS (
  SELECT c_custkey AS pickup_location_id, CASE WHEN c_acctbal >= 0 THEN n_name END AS zone
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

SHOWN = FILLED + BACKFILL + "," + USER_ZONES + """,
upcoming AS (SELECT * FROM preds WHERE pickup_hour = TIMESTAMP '2024-01-30 22:00:00'),
shown AS (
  SELECT u.pickup_location_id, greatest(u.predicted_demand, 0) AS predicted_demand,
         timezone('America/New_York', timezone('UTC', u.pickup_hour)) AS pickup_hour, n.zone
  FROM upcoming u LEFT JOIN names n ON n.pickup_location_id = u.pickup_location_id
),
top AS (SELECT * FROM shown ORDER BY predicted_demand DESC, pickup_location_id, pickup_hour LIMIT 10)"""

ZONE_FILE = """
zone_file AS (
  SELECT s_suppkey::INTEGER AS pickup_location_id, CASE WHEN s_acctbal >= 0 THEN n_name END AS zone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

CANDIDATES = ERRORS + """,
candidates AS (
  SELECT c_mktsegment AS name, date_diff('hour', TIMESTAMP '2024-01-01', pickup_hour)::INTEGER AS run,
         avg(absolute_error) AS mae
  FROM errs JOIN customer ON c_custkey = pickup_location_id GROUP BY 1, 2
)"""

WITH = "WITH "
JOB = FILLED + _numbered() + _windows(672, 23)
QUANTILE_LIST = (0.0, 0.01, 0.012, 0.995, 0.999)
HOURLY = "SELECT pickup_hour, pickup_location_id, rides FROM "


def _quantiles() -> str:
    parts = []
    for measure, expr in (("total_amount", "amount"), ("duration_seconds", "date_diff('second', pickup, dropoff)::DOUBLE")):
        for p in QUANTILE_LIST:
            parts.append(
                f"SELECT '{measure}' AS measure, {p}::DOUBLE AS p, round(quantile_cont({expr}, {p}), 6) AS q FROM trips"
            )
    return WITH + TRIPS + "\n" + "\nUNION ALL\n".join(parts)


def _histogram(measure: str, column: str, source: str) -> str:
    return f"""
SELECT '{measure}' AS measure, b.bin::INTEGER AS bin, round(lo + b.bin * width, 4) AS lower,
       round(lo + (b.bin + 1) * width, 4) AS upper, coalesce(c.n, 0)::BIGINT AS rows
FROM (SELECT min({column}) AS lo, (max({column}) - min({column})) / 20 AS width FROM {source}) r
CROSS JOIN (SELECT unnest(range(20)) AS bin) b
LEFT JOIN (
  SELECT least(floor(({column} - lo) / width), 19)::INTEGER AS bin, count(*) AS n
  FROM {source}, (SELECT min({column}) AS lo, (max({column}) - min({column})) / 20 AS width FROM {source}) GROUP BY 1
) c ON c.bin = b.bin"""


def _profile() -> str:
    # Names and engine types of the orders columns.
    columns = (
        ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
        ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
    )
    return "\nUNION ALL\n".join(
        f"SELECT count(*) AS rows, {i}::INTEGER AS position, '{c}' AS column_name, '{t}' AS type, count({c}) AS non_null FROM orders"
        for i, (c, t) in enumerate(columns)
    )


def _extreme(direction: str, side: str) -> str:
    return (
        f"SELECT * FROM (SELECT event_id, ts, user_id, '{side}' AS side FROM events "
        f"ORDER BY ts {direction}, event_id {direction} LIMIT 10)"
    )


STORED = _counts() + """,
stored AS (
  SELECT pickup_hour, pickup_location_id,
         CASE WHEN pickup_hour >= TIMESTAMP '2024-01-15' THEN rides + 100 ELSE rides END AS rides
  FROM counts
)"""


LATE = "SELECT ts + INTERVAL 364 DAY AS ts, user_id FROM events WHERE ts >= TIMESTAMP '2023-12-31 10:00:00' AND ts < TIMESTAMP '2024-01-29 10:00:00'"

# The grid of a requested range; without the cells that inputs.thinned leaves out, and what is skipped for the hour after it.
RANGE_FILL = """,
filled AS (
  SELECT h.pickup_hour, s.pickup_location_id, coalesce(c.rides, 0)::BIGINT AS rides
  FROM (SELECT unnest(generate_series(TIMESTAMP '{lo}', TIMESTAMP '{hi}', INTERVAL 1 HOUR)) AS pickup_hour) h
  CROSS JOIN (SELECT DISTINCT pickup_location_id FROM counts) s
  LEFT JOIN counts c ON c.pickup_hour = h.pickup_hour AND c.pickup_location_id = s.pickup_location_id
),
kept AS (
  SELECT * FROM filled
  WHERE NOT (pickup_location_id % 10 = 3 AND pickup_hour > TIMESTAMP '{hi}' - INTERVAL 20 HOUR)
    AND NOT (pickup_location_id % 10 = 7 AND pickup_hour < TIMESTAMP '{hi}' - INTERVAL 100 HOUR)
),
skipped AS (
  SELECT pickup_location_id, count(*) AS hours, max(pickup_hour) AS last_hour FROM kept
  GROUP BY pickup_location_id HAVING count(*) < 672 OR max(pickup_hour) < TIMESTAMP '{hi}'
)"""


def _stump(runs: str, source: str = "lagged") -> str:
    """Predictions of a tree of one split for each run; ``runs`` has run, least (rows on either side) and fold (left out)."""
    return f""",
runs AS ({runs}),
train AS (SELECT r.run, r.least, l.* FROM {source} l, runs r WHERE pickup_hour < TIMESTAMP '2024-01-24' AND l.fold <> r.fold),
total AS (SELECT run, count(*) AS n, sum(target) AS s FROM train WHERE k = 0 GROUP BY run),
by_value AS (SELECT run, any_value(least) AS least, k, rides, count(*) AS n, sum(target) AS s FROM train GROUP BY run, k, rides),
sides AS (
  SELECT run, least, k, rides, sum(n) OVER w AS nl, sum(s) OVER w AS sl, lead(rides) OVER (PARTITION BY run, k ORDER BY rides) AS following
  FROM by_value WINDOW w AS (PARTITION BY run, k ORDER BY rides)
),
split AS (
  SELECT d.run, k, (rides + following) / 2.0::DOUBLE AS threshold, sl::DOUBLE / nl AS low, (s - sl)::DOUBLE / (n - nl) AS high
  FROM sides d JOIN total t ON t.run = d.run
  WHERE following IS NOT NULL AND nl >= least AND n - nl >= least
  QUALIFY row_number() OVER (PARTITION BY d.run ORDER BY sl::DOUBLE * sl / nl + (s - sl)::DOUBLE * (s - sl) / (n - nl) DESC, k, rides) = 1
),
tree AS (
  SELECT t.run, l.pickup_location_id, l.pickup_hour, l.fold, l.target,
         CASE WHEN p.run IS NULL THEN t.s::DOUBLE / t.n WHEN l.rides <= p.threshold THEN p.low ELSE p.high END AS prediction
  FROM total t LEFT JOIN split p ON p.run = t.run JOIN {source} l ON l.k = coalesce(p.k, 0)
)"""


# The lags as features 0 to 671, then the mean of those one to four weeks back, the hour, and the day of the week from Monday.
ALL_FEATURES = FILLED + _numbered() + _windows(672, 8) + """,
folded AS (
  SELECT pickup_location_id, pickup_hour, target, k::INTEGER AS k, rides::DOUBLE AS rides, 0 AS fold FROM lagged
  UNION ALL
  SELECT pickup_location_id, pickup_hour, any_value(target), 672, sum(rides) FILTER (k IN (0, 168, 336, 504)) / 4.0::DOUBLE, 0
  FROM lagged GROUP BY pickup_location_id, pickup_hour
  UNION ALL SELECT pickup_location_id, pickup_hour, target, 673, hour(pickup_hour)::DOUBLE, 0 FROM lagged WHERE k = 0
  UNION ALL SELECT pickup_location_id, pickup_hour, target, 674, (isodow(pickup_hour) - 1)::DOUBLE, 0 FROM lagged WHERE k = 0
)"""
SIX = FILLED + _numbered() + _windows(6, 24)
FOLDED = """,
folded AS (SELECT *, ((dayofyear(pickup_hour) + pickup_location_id) % 3)::INTEGER AS fold FROM lagged)"""
ONE_RUN = "SELECT 0 AS run, 1 AS least, -1 AS fold"
BEFORE, AFTER = "pickup_hour < TIMESTAMP '2024-01-24'", "pickup_hour >= TIMESTAMP '2024-01-24'"
ERROR = "avg(abs(prediction - target))"

ORACLE = {
    "q_scan_trips": WITH + TRIPS + """
SELECT pickup AS tpep_pickup_datetime, dropoff AS tpep_dropoff_datetime, amount AS total_amount, loc AS "PULocationID",
       y AS year, m AS month, date_diff('second', pickup, dropoff) AS duration_seconds FROM trips""",
    "q_load_months": WITH + FLAGGED + """
SELECT year(pickup_datetime)::INTEGER AS year, month(pickup_datetime)::INTEGER AS month, count(*) AS rides
FROM rides GROUP BY 1, 2""",
    "q_missing_months": WITH + TRIPS + """
SELECT y::INTEGER AS year, m::INTEGER AS month
FROM (SELECT unnest(range(min(y) - 1, max(y) + 2)) AS y FROM trips) CROSS JOIN (SELECT unnest(range(1, 13)) AS m)
WHERE (y, m) NOT IN (SELECT (y, m) FROM trips)""",
    "q_month_report": WITH + FLAGGED + """,
months AS (
  SELECT y, m FROM (SELECT unnest(range(min(y) - 1, max(y) + 2)) AS y FROM trips) CROSS JOIN (SELECT unnest(range(1, 13)) AS m)
)
SELECT a.y::INTEGER AS year, a.m::INTEGER AS month, CASE WHEN count(f.y) > 0 THEN 'read' ELSE 'missing' END AS status,
       CASE WHEN count(f.y) > 0 THEN count(f.y) END AS trips,
       CASE WHEN count(f.y) > 0 THEN count(*) FILTER (ok_duration AND ok_amount AND ok_location AND ok_period) END AS rides
FROM months a LEFT JOIN flagged f ON f.y = a.y AND f.m = a.m GROUP BY a.y, a.m""",
    "q_zone_dim": WITH + ZONE_FILE + "\nSELECT * FROM zone_file",
    "q_zone_enrich": WITH + _counts() + "," + USER_ZONES + """
SELECT c.pickup_hour, c.pickup_location_id, c.rides, n.zone
FROM counts c LEFT JOIN names n ON n.pickup_location_id = c.pickup_location_id""",
    "q_trip_zones": WITH + FLAGGED + "," + ZONE_FILE + """
SELECT r.pickup_location_id, count(*) AS rides, any_value(z.zone) AS zone
FROM rides r LEFT JOIN zone_file z ON z.pickup_location_id = r.pickup_location_id GROUP BY r.pickup_location_id""",
    "q_trip_filter": WITH + FLAGGED + "\nSELECT * FROM rides",
    "q_reject_report": WITH + FLAGGED + """
SELECT y AS year, m AS month, count(*) AS total_records, count(*) FILTER (ok) AS valid_records,
       count(*) FILTER (NOT ok) AS records_dropped,
       (count(*) FILTER (NOT ok)) * 100.0::DOUBLE / count(*) AS percent_dropped,
       count(*) FILTER (NOT ok_duration) AS rejected_duration, count(*) FILTER (NOT ok_amount) AS rejected_amount,
       count(*) FILTER (NOT ok_location) AS rejected_location, count(*) FILTER (NOT ok_period) AS rejected_period,
       count(*) FILTER (amount < 0) AS negative_amounts
FROM (SELECT *, ok_duration AND ok_amount AND ok_location AND ok_period AS ok FROM flagged) GROUP BY y, m""",
    "q_quantiles": _quantiles(),
    "q_describe": """
SELECT count(o_totalprice) AS count, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std,
       round(min(o_totalprice), 4) AS min, round(quantile_cont(o_totalprice, 0.25), 4) AS p25,
       round(quantile_cont(o_totalprice, 0.5), 4) AS p50, round(quantile_cont(o_totalprice, 0.75), 4) AS p75,
       round(max(o_totalprice), 4) AS max FROM orders""",
    "q_profile": _profile(),
    "q_histogram": _histogram("o_totalprice", "o_totalprice", "orders") + "\nUNION ALL\n"
    + _histogram("negative c_acctbal", "c_acctbal", "(SELECT c_acctbal FROM customer WHERE c_acctbal < 0)"),
    "q_box_stats": """
WITH q AS (
  SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
         quantile_cont(o_totalprice, 0.75) AS q3 FROM orders
), f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q)
SELECT round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3,
       round(min(o_totalprice) FILTER (o_totalprice BETWEEN low AND high), 4) AS whisker_low,
       round(max(o_totalprice) FILTER (o_totalprice BETWEEN low AND high), 4) AS whisker_high,
       count(*) FILTER (o_totalprice < low) AS outliers_low, count(*) FILTER (o_totalprice > high) AS outliers_high
FROM orders, f""",
    "q_extremes": _extreme("ASC", "first") + " UNION ALL " + _extreme("DESC", "last"),
    "q_hourly_counts": WITH + _counts() + "\n" + HOURLY + "counts",
    "q_gap_fill": WITH + FILLED + "\n" + HOURLY + "filled",
    "q_gap_fill_zones": WITH + _counts() + "," + USER_ZONES + """,
hours AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR)) AS pickup_hour),
places AS (
  SELECT pickup_location_id FROM counts
  UNION SELECT pickup_location_id FROM names
)
SELECT h.pickup_hour, p.pickup_location_id, coalesce(c.rides, 0)::BIGINT AS rides, n.zone
FROM hours h CROSS JOIN places p
LEFT JOIN counts c ON c.pickup_hour = h.pickup_hour AND c.pickup_location_id = p.pickup_location_id
LEFT JOIN names n ON n.pickup_location_id = p.pickup_location_id""",
    "q_time_shift": """
SELECT ts + INTERVAL 364 DAY AS pickup_datetime, user_id AS pickup_location_id FROM events
WHERE ts + INTERVAL 364 DAY >= TIMESTAMP '2024-12-30' AND ts + INTERVAL 364 DAY < TIMESTAMP '2025-01-28 12:30:00'""",
    "q_rows_by_month": """
SELECT date_trunc('month', l_shipdate)::TIMESTAMP AS year_month, count(*) AS rows FROM lineitem
WHERE date_trunc('month', l_shipdate) BETWEEN TIMESTAMP '1992-01-01' AND TIMESTAMP '2002-02-01' GROUP BY 1""",
    "q_window_target": WITH + JOB + _summary(672),
    "q_window_features": WITH + JOB + _summary(672, target=False),
    "q_window_latest": WITH + FILLED + """,
num AS (
  SELECT *, row_number() OVER (PARTITION BY pickup_location_id ORDER BY pickup_hour DESC) AS back FROM filled
),
lagged AS (
  SELECT pickup_location_id, max(pickup_hour) OVER (PARTITION BY pickup_location_id) + INTERVAL 1 HOUR AS pickup_hour,
         rides, 672 - back AS k, 0 AS target FROM num WHERE back <= 672
)""" + _summary(672, target=False) + " HAVING count(*) = 672",
    "q_window_single": WITH + _counts("SELECT ts, 0 AS user_id FROM events") + FILL + _numbered() + """
SELECT pickup_hour, """ + ", ".join(f"lag(rides, {12 - i}) OVER w AS feature_{i + 1}" for i in range(12)) + """,
       rides AS target FROM num WINDOW w AS (ORDER BY pickup_hour) QUALIFY row_number() OVER w > 12""",
    "q_window_wide": WITH + FILLED + _numbered() + """
SELECT """ + ", ".join(f'lag(rides, {k}) OVER w AS "rides_t-{k}"' for k in range(24, 0, -1)) + """,
       rides AS target, pickup_location_id, pickup_hour FROM num
WINDOW w AS (PARTITION BY pickup_location_id ORDER BY pickup_hour)
QUALIFY row_number() OVER w > 24 AND (row_number() OVER w - 25) % 24 = 0""",
    "q_window_unpivot": WITH + JOB + """
SELECT pickup_location_id, pickup_hour AS window_hour, pickup_hour - to_hours((672 - k)::INTEGER) AS datetime,
       rides::DOUBLE AS rides FROM lagged
UNION ALL
SELECT pickup_location_id, pickup_hour, pickup_hour, target::DOUBLE FROM ends""",
    "q_window_padded": WITH + _counts() + """,
firsts AS (
  SELECT pickup_location_id, min(pickup_hour) AS pickup_hour, arg_min(rides, pickup_hour) AS rides, count(*) AS n
  FROM counts GROUP BY 1
),
padded AS (
  SELECT pickup_location_id, pickup_hour, rides FROM counts
  UNION ALL SELECT pickup_location_id, pickup_hour, rides FROM firsts, range(65) t(i) WHERE i < 65 - n
)""" + _numbered("padded") + _windows(64, 5) + _summary(64),
    "q_short_series": WITH + _counts() + """
SELECT pickup_location_id, count(*) AS rows FROM counts GROUP BY pickup_location_id HAVING count(*) <= 64""",
    "q_backfill": WITH + FILLED + BACKFILL + "\nSELECT * FROM preds",
    "q_seasonal_mean": WITH + FILLED + BACKFILL + """
SELECT pickup_location_id, pickup_hour, prediction AS average_rides_last_4_weeks FROM mean4 WHERE (pos - 672) % 23 = 0""",
    "q_temporal_features": WITH + FILLED + """
SELECT pickup_hour, pickup_location_id, rides, hour(pickup_hour)::INTEGER AS hour,
       (isodow(pickup_hour) - 1)::INTEGER AS day_of_week FROM filled""",
    "q_time_split": WITH + FILLED + _numbered() + """
SELECT rides AS target, pickup_location_id, pickup_hour,
       CASE WHEN pickup_hour < TIMESTAMP '2024-01-20' THEN 'train' ELSE 'test' END AS split
FROM num WHERE pos >= 168 AND (pos - 168) % 23 = 0""",
    "q_tz_display": """
SELECT event_id, ts AS utc_time, timezone('America/New_York', timezone('UTC', ts)) AS new_york_time FROM events""",
    "q_clock_round": """
SELECT event_id, date_trunc('hour', ts) AS floor_hour,
       CASE WHEN ts = date_trunc('hour', ts) THEN ts ELSE date_trunc('hour', ts) + INTERVAL 1 HOUR END AS ceil_hour,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS next_hour FROM events""",
    "q_parse_ts": """
SELECT o_orderkey, try_cast(CASE WHEN o_orderkey % 7 = 0 THEN 'bad ' ELSE '' END || o_orderdate::VARCHAR AS TIMESTAMP) AS order_time
FROM orders""",
    "q_predict": WITH + FILLED + """,
num AS (
  SELECT *, row_number() OVER (PARTITION BY pickup_location_id ORDER BY pickup_hour DESC) AS back,
         count(*) OVER (PARTITION BY pickup_location_id) AS n FROM filled
)
SELECT pickup_location_id, round_even(sum(rides) / 4.0::DOUBLE, 0)::DOUBLE AS predicted_demand,
       TIMESTAMP '2024-01-31 00:00:00' AS pickup_hour
FROM num WHERE n >= 672 AND back IN (168, 336, 504, 672) GROUP BY pickup_location_id""",
    "q_mae_by_hour": WITH + ERRORS + """
SELECT pickup_hour, avg(absolute_error) AS "MAE" FROM errs GROUP BY pickup_hour""",
    "q_mae_macro": WITH + ERRORS + """
SELECT round(avg(m), 9) AS macro_mae FROM (SELECT avg(absolute_error) AS m FROM errs GROUP BY pickup_hour)""",
    "q_mae_overall": WITH + FILLED + BACKFILL + """
SELECT avg(abs(prediction - rides)) AS mae FROM mean4 WHERE (pos - 672) % 23 = 0""",
    "q_dashboard": WITH + SHOWN + "\nSELECT * FROM shown",
    "q_dashboard_zone": WITH + SHOWN + "\nSELECT * FROM shown WHERE zone = 'NATION_3'",
    "q_demand_stats": WITH + SHOWN + """
SELECT avg(predicted_demand) AS average_rides, max(predicted_demand) AS maximum_rides,
       greatest(min(predicted_demand), 0) AS minimum_rides FROM shown""",
    "q_top10": WITH + SHOWN + "\nSELECT * FROM top",
    "q_top10_history": WITH + SHOWN + """,
history AS (
  SELECT t.pickup_location_id, t.zone, f.pickup_hour AS utc, f.rides::DOUBLE AS rides
  FROM top t JOIN filled f ON f.pickup_location_id = t.pickup_location_id
  WHERE f.pickup_hour >= TIMESTAMP '2024-01-23 22:00:00' AND f.pickup_hour < TIMESTAMP '2024-01-30 22:00:00'
  UNION ALL
  SELECT pickup_location_id, zone, TIMESTAMP '2024-01-30 22:00:00', predicted_demand FROM top
)
SELECT pickup_location_id, zone, TIMESTAMP '2024-01-30 17:00:00' AS window_hour,
       timezone('America/New_York', timezone('UTC', utc)) AS datetime, rides FROM history""",
    "q_zone_options": WITH + SHOWN + """
SELECT 0 AS position, 'All Zones' AS zone UNION ALL
SELECT DISTINCT 1, zone FROM shown WHERE zone IS NOT NULL""",
    "q_zone_demand_map": WITH + SHOWN + """
SELECT n.pickup_location_id, n.zone, coalesce(u.predicted_demand, 0) AS predicted_demand
FROM names n LEFT JOIN upcoming u ON u.pickup_location_id = n.pickup_location_id""",
    "q_upsert": WITH + STORED + "\n" + HOURLY + "stored",
    "q_store_range": WITH + STORED + """
SELECT *, 'range' AS how FROM stored
WHERE pickup_hour BETWEEN TIMESTAMP '2024-01-03 05:00:00' AND TIMESTAMP '2024-01-27 17:00:00'
UNION ALL
SELECT *, 'filter' FROM stored WHERE rides >= 2 AND pickup_hour >= TIMESTAMP '2024-01-02'""",
    "q_sink_roundtrip": WITH + FLAGGED + """
SELECT *, year(pickup_datetime)::INTEGER AS year, month(pickup_datetime)::INTEGER AS month FROM rides""",
    "q_matrix_roundtrip": WITH + JOB + _summary(672),
    "q_feature_job": WITH + _counts(LATE.replace("2023-12-31", "2024-01-01"))
    + RANGE_FILL.format(lo="2024-12-30 10:00:00", hi="2025-01-27 09:00:00") + "\n" + HOURLY + "filled",
    "q_feature_job_trips": WITH + FLAGGED + ","
    + _counts("SELECT pickup_datetime + INTERVAL 364 DAY AS ts, pickup_location_id::BIGINT AS user_id FROM rides "
              "WHERE pickup_datetime >= TIMESTAMP '1997-12-15 10:00:00' AND pickup_datetime < TIMESTAMP '1998-01-12 10:00:00'")
    + RANGE_FILL.format(lo="1998-12-14 10:00:00", hi="1999-01-11 09:00:00") + "\n" + HOURLY + "filled",
    # Window and step are equal here, so each row lies in one window: the block before the target's.
    "q_dataset_job": WITH + FLAGGED + ","
    + _counts("SELECT pickup_datetime AS ts, pickup_location_id AS user_id FROM rides") + FILL + _numbered() + """,
lagged AS (
  SELECT pickup_location_id, rides, pos % 168 AS k, pos // 168 AS block,
         lead(pickup_hour, (168 - pos % 168)::INTEGER) OVER w AS pickup_hour,
         lead(rides, (168 - pos % 168)::INTEGER) OVER w AS target
  FROM num WINDOW w AS (PARTITION BY pickup_location_id ORDER BY pos)
)""" + _summary(168).replace("FROM lagged", "FROM lagged WHERE pickup_hour IS NOT NULL"),
    # The stamped hour is 10:00; the same hour one to four weeks earlier counts, whatever the row's position.
    "q_inference_job": WITH + _counts(LATE) + RANGE_FILL.format(lo="2024-12-29 10:00:00", hi="2025-01-27 09:00:00") + """,
weeks AS (SELECT TIMESTAMP '2025-01-27 10:00:00' - to_days((7 * k)::INTEGER) AS pickup_hour FROM range(1, 5) t(k))
SELECT f.pickup_location_id, round_even(sum(f.rides) / 4.0::DOUBLE, 0)::DOUBLE AS predicted_demand,
       TIMESTAMP '2025-01-27 10:00:00' AS pickup_hour
FROM filled f JOIN weeks w ON w.pickup_hour = f.pickup_hour GROUP BY f.pickup_location_id""",
    "q_inference_skipped": WITH + _counts(LATE) + RANGE_FILL.format(lo="2024-12-29 10:00:00", hi="2025-01-27 09:00:00") + """
SELECT * FROM skipped""",
    "q_monitor_job": WITH + ERRORS + """
SELECT pickup_hour, avg(absolute_error) AS "MAE" FROM errs
WHERE pickup_hour >= TIMESTAMP '2024-01-29 21:00:00' GROUP BY pickup_hour""",
    "q_latest_version": WITH + CANDIDATES + """
SELECT name, max(run) AS version, arg_max(mae, run) AS mae FROM candidates GROUP BY name""",
    "q_promote": WITH + CANDIDATES + """
SELECT name, run, mae, previous, previous IS NULL OR mae < previous AS promoted FROM (
  SELECT *, min(mae) OVER (PARTITION BY name ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous
  FROM candidates
)""",
    "q_run_log": WITH + CANDIDATES + """
SELECT 'four_week_mean' AS experiment, name AS model, '672' AS window, run::VARCHAR AS run, 'mae' AS metric, mae AS score
FROM candidates""",
    "q_train_stump": WITH + SIX + FOLDED + _stump(ONE_RUN, "folded") + f"""
SELECT round({ERROR} FILTER ({BEFORE}), 9) AS train_mae, round({ERROR} FILTER ({AFTER}), 9) AS test_mae FROM tree""",
    "q_train_calendar": WITH + ALL_FEATURES + (_stump(ONE_RUN, "folded") + f"""
SELECT round({ERROR} FILTER ({BEFORE}), 9) AS train_mae, round({ERROR} FILTER ({AFTER}), 9) AS test_mae FROM tree""").replace("2024-01-24", "2024-01-30"),
    "q_training_job": WITH + FILLED.replace("filled AS (", "whole AS (") + """,
filled AS (SELECT * FROM whole WHERE pickup_hour <= TIMESTAMP '2024-01-30 21:30:00')""" + _numbered() + _windows(6, 24)
    + FOLDED + _stump(ONE_RUN, "folded") + f"""
SELECT 'demand_next_hour' AS name, 1::INTEGER AS version, round({ERROR} FILTER ({BEFORE}), 9) AS train_mae,
       round({ERROR} FILTER ({AFTER}), 9) AS test_mae,
       'lags array<bigint>[6], target bigint, pickup_location_id bigint, pickup_hour timestamp_ntz' AS inputs, count(*) AS scored, sum(round_even(prediction, 0))::DOUBLE AS predicted
FROM tree""",
    "q_random_search": WITH + SIX + FOLDED + _stump(
        "SELECT row_number() OVER () AS run, least, fold FROM (SELECT unnest([1, 900]) AS least), (SELECT unnest([-1, 0, 1, 2]) AS fold)",
        "folded",
    ) + f""",
each AS (
  SELECT r.least, r.fold, avg(abs(t.prediction - t.target)) FILTER (t.{BEFORE} AND t.fold = r.fold) AS inner_mae,
         avg(abs(t.prediction - t.target)) FILTER (t.{AFTER} AND r.fold = -1) AS test_mae
  FROM tree t JOIN runs r ON r.run = t.run GROUP BY r.least, r.fold
),
draws AS (SELECT least, avg(inner_mae) FILTER (fold >= 0) AS mae, max(test_mae) AS test_mae FROM each GROUP BY least)
SELECT least::INTEGER AS least, round(mae, 9) AS mae, CASE WHEN mae = min(mae) OVER () THEN round(test_mae, 9) END AS test_mae FROM draws""",
    "q_window_narrow": WITH + FILLED + _numbered() + _windows(24, 24) + _summary(24),
    "q_dashboard_job": WITH + SHOWN + """,
past AS (
  SELECT t.pickup_location_id, sum(f.rides) AS rides FROM top t JOIN filled f ON f.pickup_location_id = t.pickup_location_id
  WHERE f.pickup_hour >= TIMESTAMP '2024-01-23 22:00:00' AND f.pickup_hour < TIMESTAMP '2024-01-30 22:00:00' GROUP BY 1
)
SELECT 'predictions' AS part, 'rows' AS name, count(*)::DOUBLE AS value FROM shown
UNION ALL SELECT 'zones', 'All Zones', 0
UNION ALL SELECT DISTINCT 'zones', zone, 1 FROM shown WHERE zone IS NOT NULL
UNION ALL SELECT 'stats', 'average', avg(predicted_demand) FROM shown
UNION ALL SELECT 'stats', 'maximum', max(predicted_demand) FROM shown
UNION ALL SELECT 'stats', 'minimum', greatest(min(predicted_demand), 0) FROM shown
UNION ALL SELECT 'top', pickup_location_id::VARCHAR, predicted_demand FROM top
UNION ALL SELECT 'history', t.pickup_location_id::VARCHAR, p.rides + t.predicted_demand FROM top t JOIN past p USING (pickup_location_id)""",
    "q_stream_hourly": WITH + _counts() + "\n" + HOURLY + "counts",
    "q_stream_errors": WITH + ERRORS.replace("WHERE p.pickup_hour >= TIMESTAMP '2024-01-02 21:00:00'", "") + """
SELECT e.pickup_location_id, e.pickup_hour, f.rides, p.predicted_demand, e.absolute_error
FROM errs e JOIN preds p USING (pickup_location_id, pickup_hour) JOIN filled f USING (pickup_location_id, pickup_hour)""",
    "q_stream_upsert": WITH + _counts() + "\n" + HOURLY + "counts",
    "q_stream_gap_fill": WITH + FILLED + "\n" + HOURLY + "filled",
    # Late: of a known location, in an hour that the rides of earlier parts have closed.
    "q_stream_late": WITH + FILLED + """,
e AS (
  SELECT date_trunc('hour', ts) AS h, user_id AS u,
         least(3, (ts >= '2024-01-08')::INTEGER + (ts >= '2024-01-16')::INTEGER + (ts >= '2024-01-23')::INTEGER + (event_id % 10 = 0)::INTEGER) AS k
  FROM events WHERE ts IS NOT NULL
),
clock AS (SELECT k, max(max(h)) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM e GROUP BY k),
known AS (SELECT u, min(k) AS first FROM e WHERE u IS NOT NULL GROUP BY u),
flagged AS (
  SELECT e.h, coalesce(n.first < e.k AND e.h <= c.seen - INTERVAL 3 HOUR, false) AS late
  FROM e JOIN clock c ON c.k = e.k JOIN known n ON n.u = e.u
)
SELECT hours.pickup_hour, count(*) FILTER (late = false) AS counted, count(*) FILTER (late) AS late
FROM hours LEFT JOIN flagged f ON f.h = hours.pickup_hour GROUP BY hours.pickup_hour""",
}
