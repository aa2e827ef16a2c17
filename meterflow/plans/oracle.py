"""The catalogue's queries as DuckDB SQL, written independently of the Spark plans.

Each statement gets the model's tables as common table expressions. Percentages are
rounded in whole numbers (half up on the exact quotient), energy and money are DECIMAL.
"""

from __future__ import annotations


def pct(part: str, whole: str, places: int = 2, empty: str = "0") -> str:
    """100 * part / whole, half up; operands DECIMAL with at most four places."""
    n, d = f"CAST(({part}) * 10000 AS HUGEINT)", f"CAST(({whole}) * 10000 AS HUGEINT)"
    scale = 10 ** places
    value = f"CAST((2 * {n} * {100 * scale} + {d}) // (2 * {d}) AS DOUBLE) / {scale}::DOUBLE"
    return f"CASE WHEN ({whole}) > 0 THEN {value} ELSE {empty} END"


def text(number: str, places: int) -> str:
    """A half-up rounded number of whole units (given times 10^places) as text."""
    return f"CAST(CAST({number} AS DECIMAL(18,{places})) AS VARCHAR)"


def fraction(*parts: str) -> str:
    joined = " || '|' || ".join(parts)
    return f"(('0x' || substr(md5({joined}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


LOCAL = "INTERVAL 330 MINUTE"

TIER = f"""CASE WHEN {fraction("'tier'", 'household_id')} * 1.0::DOUBLE < 0.35::DOUBLE THEN 'domestic-1'
 WHEN {fraction("'tier'", 'household_id')} * 1.0::DOUBLE < 0.8::DOUBLE THEN 'domestic-2'
 ELSE 'domestic-3' END"""
SUBSIDY = f"{fraction(chr(39) + 'subsidy' + chr(39), 'household_id')} < 0.3::DOUBLE"


def rate(day: str) -> str:
    base = "CASE billing_tier WHEN 'domestic-1' THEN 30.0::DOUBLE WHEN 'domestic-2' THEN 45.0::DOUBLE ELSE 62.0::DOUBLE END"
    drawn = fraction("'rate'", "household_id", f"strftime({day}, '%Y-%m-%d')")
    return f"round({base} * (1.0::DOUBLE + ({drawn} * 2 - 1) * 0.05::DOUBLE), 2)::DECIMAL(9,2)"


def windows(source: str, shift: str) -> str:
    return f"""
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, grid_zone, c AS total_consumption_kwh,
       s AS total_solar_kwh, {pct('s', 'c')} AS renewable_pct, m AS active_meters, updated_at, n AS readings
FROM (SELECT date_trunc('hour', "timestamp" + {shift}) - {shift} AS window_start, grid_zone,
             sum(used) AS c, sum(solar) AS s, count(DISTINCT meter_id) AS m, max(ingested_at) AS updated_at, count(*) AS n
      FROM {source} GROUP BY 1, 2)"""


def bills(usage: str, tariff: str, keys: str) -> str:
    return f"""
SELECT *, gross - subsidy AS net_amount FROM (
 SELECT *, CASE WHEN subsidy_flag THEN round(gross * 0.10::DECIMAL(3,2), 2) ELSE 0 END::DECIMAL(18,2) AS subsidy FROM (
  SELECT *, round(net_kwh * tariff_rate, 2)::DECIMAL(18,2) AS gross FROM (
   SELECT u.*, greatest(c - s, 0)::DECIMAL(18,4) AS net_kwh, tariff_rate, billing_tier, subsidy_flag
   FROM {usage} u LEFT JOIN {tariff} USING ({keys}))))"""


BILL_FIELDS = """sim_day::VARCHAR AS sim_day, household_id, grid_zone, c::DOUBLE AS total_consumption_kwh,
 s::DOUBLE AS total_solar_kwh, net_kwh::DOUBLE AS net_kwh, tariff_rate::DOUBLE AS tariff_rate, billing_tier, subsidy_flag,
 gross::DOUBLE AS gross_amount, subsidy::DOUBLE AS subsidy_amount, net_amount::DOUBLE AS net_amount"""

WINDOW_FIELDS = """window_start, window_end, grid_zone, total_consumption_kwh::DOUBLE AS total_consumption_kwh,
 total_solar_kwh::DOUBLE AS total_solar_kwh, renewable_pct, active_meters"""

LOAD = """CAST((2 * CAST(total_consumption_kwh * 10000 AS HUGEINT) * 3600 * 1000 + epoch(window_end - window_start)::HUGEINT * 10000)
 // (2 * epoch(window_end - window_start)::HUGEINT * 10000) AS DOUBLE) / 1000::DOUBLE"""

_KW = "(total_consumption_kwh::DOUBLE / 1.0::DOUBLE / active_meters)"
_KW_TEXT = text("CAST((2 * CAST(total_consumption_kwh * 10000 AS HUGEINT) * 100 + active_meters * 10000) // (2 * active_meters * 10000) AS DECIMAL(18,2)) / 100", 2)
_PCT_TEXT = text("(floor(CAST(round(renewable_pct * 100) AS BIGINT) / 10.0::DOUBLE + 0.5) / 10)", 1)


def alert_rows(source: str) -> str:
    return f"""
SELECT window_start, grid_zone, 'WARN' AS level, 'low_renewable_contribution' AS rule,
  'Low renewable contribution, ' || grid_zone || ': ' || {_PCT_TEXT} || '% (floor 15%) at '
  || strftime(window_start + {LOCAL}, '%Y-%m-%d %H:%M') || ' simulated' AS message, updated_at AS ts, 'speed-1' AS run_id
FROM {source} WHERE hour(window_start + {LOCAL}) >= 9 AND hour(window_start + {LOCAL}) < 16 AND renewable_pct < 15
UNION ALL
SELECT window_start, grid_zone, 'WARN', 'zone_overload',
  'Zone load high, ' || grid_zone || ': ' || {_KW_TEXT} || ' kW/meter across ' || active_meters || ' meters (ceiling 40.00)',
  updated_at, 'speed-1'
FROM {source} WHERE {_KW} > 40.0::DOUBLE"""


MODEL = f"""WITH
customer_zone AS (SELECT c_custkey AS user_id, r_name AS grid_zone FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
readings AS (SELECT event_id, event_type, 'M-' || user_id AS meter_id, 'H-' || user_id AS household_id, grid_zone,
  CASE WHEN event_type = 'purchase' THEN 0 ELSE value END::DECIMAL(18,4) AS used,
  CASE WHEN event_type = 'purchase' THEN value ELSE 0 END::DECIMAL(18,4) AS solar,
  ts AS "timestamp", CAST(ts + {LOCAL} AS DATE) AS sim_day,
  ts + to_minutes((event_id * 7919) % 21) AS ingested_at
  FROM events JOIN customer_zone USING (user_id)),
stored AS (SELECT * FROM readings UNION ALL
  SELECT * REPLACE (ingested_at + INTERVAL 15 MINUTE AS ingested_at) FROM readings WHERE event_type = 'error'),
uniq AS (SELECT * EXCLUDE (copy) FROM (SELECT *, row_number() OVER (PARTITION BY meter_id, "timestamp" ORDER BY ingested_at) AS copy
  FROM stored) WHERE copy = 1),
usage AS (SELECT sim_day, household_id, grid_zone, sum(used) AS c, sum(solar) AS s, count(DISTINCT meter_id) AS m
  FROM uniq GROUP BY ALL),
household AS (SELECT 'H-' || c_custkey AS household_id, c_mktsegment AS segment FROM customer),
terms AS (SELECT household_id, segment, {TIER} AS billing_tier, {SUBSIDY} AS subsidy_flag FROM household),
days AS (SELECT CAST(unnest(generate_series(min(ts + {LOCAL})::DATE, max(ts + {LOCAL})::DATE, INTERVAL 1 DAY)) AS DATE) AS sim_day FROM events),
tariff AS (SELECT sim_day, household_id, {rate('sim_day')} AS tariff_rate, billing_tier, subsidy_flag, segment FROM terms CROSS JOIN days),
bills AS ({bills('usage', '(SELECT * EXCLUDE (segment) FROM tariff)', 'sim_day, household_id')}),
stamped AS (SELECT *, 'billing-' || strftime(sim_day, '%Y%m%d') || '-' || run_no AS run_id,
  sim_day::TIMESTAMP + INTERVAL 1 DAY + to_hours(5 + run_no) AS generated_at
  FROM (SELECT *, CASE WHEN grid_zone = 'ASIA' AND day(sim_day) % 2 = 1 THEN 2 ELSE 1 END AS run_no FROM bills)),
tampered AS (SELECT * REPLACE (net_amount + CASE WHEN billing_tier = 'domestic-3' AND subsidy_flag THEN 0.05 ELSE 0 END AS net_amount) FROM bills),
windows AS ({windows('readings', LOCAL)}),
alerts AS ({alert_rows('windows')}),
latest AS (SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY grid_zone ORDER BY window_start DESC) AS place
  FROM windows WHERE window_start < (SELECT max(window_start) FROM windows)) WHERE place = 1),
newest AS (SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY grid_zone ORDER BY window_start DESC) AS place
  FROM windows) WHERE place = 1),
zone_meters AS (SELECT grid_zone, count(*) AS meters FROM customer_zone GROUP BY 1),
clock AS (SELECT max(ingested_at) AS now FROM readings),
run_rows AS (SELECT 'run-' || o_orderkey AS run_id, o_orderpriority AS component, CAST(o_orderdate AS DATE) AS sim_day,
  o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS started_at,
  o_orderdate + to_seconds((o_orderkey * 7919) % 86400) + to_seconds(trunc(o_totalprice / 60::DOUBLE)::BIGINT) AS ended_at,
  CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'FAILED' END AS own_status, o_orderkey % 500 AS n_rows,
  CASE WHEN o_totalprice > 250000 THEN 'order ' || o_orderkey END AS note FROM orders),
followed AS (SELECT *, lead(started_at) OVER w AS next_at, lead(run_id) OVER w AS next_run,
  CASE WHEN own_status IS NOT NULL THEN ended_at END AS own_end FROM run_rows
  WINDOW w AS (PARTITION BY component ORDER BY started_at, run_id)),
runs AS (SELECT run_id, component, sim_day, started_at,
  CASE WHEN own_status IS NOT NULL THEN own_status WHEN next_at IS NOT NULL THEN 'FAILED' ELSE 'RUNNING' END AS status,
  coalesce(own_end, next_at) AS finished_at, CASE WHEN own_status IS NOT NULL THEN n_rows END AS rows_written,
  CASE WHEN next_at IS NOT NULL AND (own_end IS NULL OR own_end > next_at)
   THEN coalesce(note || ' | ', '') || 'did not shut down cleanly; superseded by ' || next_run ELSE note END AS notes
  FROM followed),
damaged AS (SELECT *, CASE WHEN event_type = 'error' THEN event_id % 6 ELSE -1 END AS kind FROM readings)
"""

_LIVE = windows("stored", LOCAL)
_MIDDLE = """(SELECT min(ingested_at) + to_microseconds(datediff('microsecond', min(ingested_at), max(ingested_at)) // 2) FROM readings)"""


def ranges(range_seconds: int, step_seconds: int, counter: bool) -> str:
    """Rise of the counter samples over ranges, each range from its own samples."""
    step = step_seconds * 1_000_000
    again = "value < before" if counter else "false"
    ahead = '((first_at - ("at" - width)) / 1000000.0::DOUBLE)'
    front = f'CASE WHEN {ahead} >= gap * 1.1::DOUBLE THEN gap / 2 ELSE {ahead} END'
    if counter:
        front = f"CASE WHEN rise > 0 THEN least({front}, span * (first_value / rise)) ELSE {front} END"
    return f"""
 line AS (SELECT grid_zone, CAST("timestamp" AS DATE) AS day, time_bucket(INTERVAL 10 MINUTE, "timestamp") AS w, max("timestamp") AS "at", count(*) AS n
  FROM readings GROUP BY ALL),
 sample AS (SELECT grid_zone, datediff('microsecond', TIMESTAMP '1970-01-01', "at") AS t,
  (sum(n) OVER (PARTITION BY grid_zone, day ORDER BY w))::DOUBLE AS value FROM line),
 stepped AS (SELECT *, lag(value) OVER (PARTITION BY grid_zone ORDER BY t) AS before FROM sample),
 ranged AS (SELECT grid_zone, "at", t, value, CASE WHEN before IS NULL THEN 0 WHEN {again} THEN value ELSE value - before END AS rise,
   coalesce({again}, false)::INT AS reset, row_number() OVER (PARTITION BY grid_zone, "at" ORDER BY t) AS place
  FROM (SELECT *, unnest(range((t + {step - 1}) // {step}, (t + {step - 1}) // {step} + {range_seconds // step_seconds})) * {step} AS "at"
   FROM stepped)),
 summed AS (SELECT grid_zone, "at", count(*) AS samples, {range_seconds * 1_000_000} AS width, min(t) AS first_at, max(t) AS last_at, arg_min(value, t) AS first_value,
   coalesce(sum(rise) FILTER (WHERE place > 1), 0) AS rise, coalesce(sum(reset) FILTER (WHERE place > 1), 0)::BIGINT AS resets
  FROM ranged GROUP BY ALL HAVING count(*) > 1),
 spaced AS (SELECT *, (last_at - first_at) / 1000000.0::DOUBLE AS span, (last_at - first_at) / 1000000.0::DOUBLE / (samples - 1) AS gap, ("at" - last_at) / 1000000.0::DOUBLE AS behind FROM summed),
 risen AS (SELECT grid_zone, TIMESTAMP '1970-01-01' + to_microseconds("at") AS "at", samples, resets,
  rise * ((span + ({front}) + (CASE WHEN behind >= gap * 1.1::DOUBLE THEN gap / 2 ELSE behind END)) / span) AS increase FROM spaced)"""


_CLOSED = "window_end <= (SELECT max(\"timestamp\") FROM readings) - INTERVAL 30 MINUTE"


def _window_checks(damaged: str) -> str:
    """The three checks of windows, on damaged ones."""
    return f"""SELECT "check", windows, failed, failed = 0 AS ok FROM (
  SELECT unnest(['window_length', 'renewable_pct', 'active_meters']) AS "check", n AS windows, unnest([a, b, c]) AS failed FROM (
  SELECT count(*) AS n, count(*) FILTER (WHERE datediff('second', window_start, window_end) <> 3600) AS a,
    count(*) FILTER (WHERE total_consumption_kwh > 0 AND abs(100 * total_solar_kwh::DOUBLE / total_consumption_kwh::DOUBLE - renewable_pct) > 0.02) AS b,
    count(*) FILTER (WHERE active_meters > (SELECT count(*) FROM customer)) AS c FROM ({damaged})))"""


_Q = {
    "parse_readings": """SELECT meter_id, household_id, grid_zone, used::DOUBLE AS power_consumption_kwh,
  solar::DOUBLE AS solar_generation_kwh, "timestamp", sim_day::VARCHAR AS sim_day, ingested_at FROM damaged WHERE kind = -1""",
    "quarantine_reasons": """SELECT CASE kind WHEN 0 THEN 'payload is not a JSON object'
  WHEN 1 THEN 'power_consumption_kwh is not a number' WHEN 2 THEN 'missing grid_zone'
  WHEN 3 THEN 'power_consumption_kwh is negative' WHEN 4 THEN 'timestamp is not ISO-8601'
  WHEN 5 THEN 'missing solar_generation_kwh' END AS reason, count(*) AS records FROM damaged WHERE kind >= 0 GROUP BY 1""",
    "dedupe_readings": """SELECT meter_id, "timestamp", ingested_at, sim_day::VARCHAR AS sim_day, grid_zone,
  used::DOUBLE AS power_consumption_kwh, solar::DOUBLE AS solar_generation_kwh FROM uniq""",
    "duplicate_stats": """SELECT count(*) AS stored_rows, count(DISTINCT (meter_id, "timestamp")) AS unique_readings,
  count(*) - count(DISTINCT (meter_id, "timestamp")) AS duplicate_rows FROM stored""",
    "daily_usage": """SELECT sim_day::VARCHAR AS sim_day, household_id, grid_zone, c::DOUBLE AS total_consumption_kwh,
  s::DOUBLE AS total_solar_kwh, m AS active_meters FROM usage""",
    "zone_day_totals": f"""SELECT sim_day::VARCHAR AS sim_day, grid_zone, c::DOUBLE AS consumption_kwh, s::DOUBLE AS solar_kwh,
  active_meters, first_event, last_event, {pct('s', 'c', 1, 'NULL')} AS renewable_pct FROM (
  SELECT sim_day, grid_zone, round(sum(used), 3) AS c, round(sum(solar), 3) AS s, count(DISTINCT meter_id) AS active_meters,
    min("timestamp") AS first_event, max("timestamp") AS last_event FROM uniq GROUP BY 1, 2)""",
    "partition_counts": """SELECT sim_day::VARCHAR AS sim_day, grid_zone, count(*) AS "rows",
  count(DISTINCT meter_id) AS meters FROM uniq GROUP BY 1, 2""",
    "sample_summary": f"""SELECT grid_zone, n AS events, m AS meters, c::DOUBLE AS kwh_used, s::DOUBLE AS kwh_solar,
  {pct('s', 'c', 1)} AS renewable_pct, a AS first_event, z AS last_event,
  round((datediff('microsecond', a, z) // 1000000)::DECIMAL(18,0) / 60::DOUBLE, 1) AS span_minutes FROM (
  SELECT grid_zone, count(*) AS n, count(DISTINCT meter_id) AS m, sum(used) AS c, sum(solar) AS s,
    min("timestamp") AS a, max("timestamp") AS z FROM readings GROUP BY 1)""",
    "closed_days": f"""SELECT sim_day::VARCHAR AS sim_day, "rows", last_event, is_closed,
  (max(CASE WHEN is_closed THEN sim_day END) OVER ())::VARCHAR AS billable_day FROM (
  SELECT sim_day, count(*) AS "rows", max("timestamp") AS last_event,
    (SELECT max("timestamp") FROM readings) - INTERVAL 30 MINUTE >= sim_day::TIMESTAMP + INTERVAL 1 DAY - {LOCAL} AS is_closed
  FROM readings GROUP BY 1)""",
    "newest_day_readings": """SELECT meter_id, "timestamp", sim_day::VARCHAR AS sim_day, grid_zone,
  used::DOUBLE AS power_consumption_kwh FROM readings WHERE sim_day = (SELECT max(sim_day) FROM readings)""",
    "day_text_forms": """SELECT event_type, CASE WHEN event_type IN ('click', 'view', 'purchase')
  THEN strftime(ts, '%Y-%m-%d') END AS day, count(*) AS texts FROM events GROUP BY 1, 2""",
    "zone_windows": f"SELECT {WINDOW_FIELDS} FROM ({windows('readings', 'INTERVAL 0 MINUTE')})",
    "zone_windows_colombo": f"SELECT {WINDOW_FIELDS}, updated_at, readings FROM windows",
    "renewable_share": f"SELECT sim_day::VARCHAR AS sim_day, household_id, grid_zone, {pct('s', 'c')} AS renewable_pct FROM usage",
    "local_time_text": f"""SELECT event_id, strftime(ts + {LOCAL}, '%Y-%m-%d %H:%M') AS wall_clock,
  strftime(ts + {LOCAL}, '%Y-%m-%d %H:%M:%S') || '+05:30' AS with_offset,
  hour(ts + {LOCAL}) BETWEEN 6 AND 17 AS is_daytime FROM events""",
    "window_alignment": """SELECT time_bucket(INTERVAL 60 MINUTE, ts, INTERVAL 30 MINUTE) AS window_start, count(*) AS events
  FROM events GROUP BY 1""",
    "approx_meters": "SELECT DISTINCT sim_day::VARCHAR AS sim_day, grid_zone, true AS within_15_pct FROM uniq",
    "threshold_alerts": "SELECT * FROM alerts",
    "alert_counts": "SELECT rule, level, count(*) AS total FROM alerts GROUP BY 1, 2",
    "latest_message_by_rule": """SELECT rule, level, count(*) AS total, max(ts) AS newest,
  (array_agg(message ORDER BY ts DESC, window_start DESC, grid_zone DESC))[1] AS latest_message FROM alerts GROUP BY 1, 2""",
    "recent_alerts": """SELECT * FROM alerts WHERE grid_zone = 'ASIA' ORDER BY ts DESC, rule, grid_zone, window_start LIMIT 50""",
    "alerts_in_range": """SELECT count(*) AS alerts FROM alerts
  WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-17'""",
    "firing_count": """SELECT (count(DISTINCT rule) + (SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END
  FROM usage JOIN household USING (household_id) WHERE segment = 'MACHINERY'))::BIGINT AS firing FROM alerts""",
    "tariff_table": """SELECT sim_day::VARCHAR AS sim_day, household_id, tariff_rate::DOUBLE AS tariff_rate, billing_tier,
  subsidy_flag FROM tariff""",
    "weighted_tier": "SELECT billing_tier, subsidy_flag, count(*) AS households FROM terms GROUP BY 1, 2",
    "quota_sample": f"""SELECT segment, household_id, quota, place <= quota AS chosen FROM (
  SELECT segment, household_id, round_even(count(*) OVER (PARTITION BY segment) * CASE segment WHEN 'AUTOMOBILE' THEN 0.75::DOUBLE
    WHEN 'BUILDING' THEN 0.60::DOUBLE WHEN 'FURNITURE' THEN 0.45::DOUBLE WHEN 'HOUSEHOLD' THEN 0.30::DOUBLE ELSE 0.5::DOUBLE END, 0)::BIGINT AS quota,
    row_number() OVER (PARTITION BY segment ORDER BY {fraction("'solar'", 'household_id')}, household_id) AS place FROM household)""",
    "stable_fraction": f"""SELECT household_id, {fraction("'solar'", 'household_id')} AS solar_fraction,
  {fraction("'tier'", 'household_id')} AS tier_fraction, {fraction("'subsidy'", 'household_id')} AS subsidy_fraction FROM household""",
    "undefined_tiers": """SELECT segment FROM household EXCEPT SELECT segment FROM household WHERE segment <> 'MACHINERY'""",
    "daily_bills": f"SELECT {BILL_FIELDS} FROM bills",
    "bill_summary": """SELECT sim_day::VARCHAR AS sim_day, count(*) AS households, sum(c)::DOUBLE AS total_consumption_kwh,
  sum(s)::DOUBLE AS total_solar_kwh, sum(net_kwh)::DOUBLE AS net_kwh, sum(gross)::DOUBLE AS gross_amount,
  sum(subsidy)::DOUBLE AS subsidy_amount, sum(net_amount)::DOUBLE AS net_amount,
  count(*) FILTER (WHERE subsidy_flag) AS subsidised_households FROM bills GROUP BY 1""",
    "day_bills": """SELECT sim_day::VARCHAR AS sim_day, count(*) AS households, sum(net_kwh)::DOUBLE AS total_net_kwh,
  sum(gross)::DOUBLE AS total_gross_amount, sum(subsidy)::DOUBLE AS total_subsidy_amount,
  sum(net_amount)::DOUBLE AS total_net_amount, (SELECT count(*) FROM customer) AS households_configured,
  'LKR' AS currency FROM bills GROUP BY 1""",
    "bills_of_day": f"""SELECT {BILL_FIELDS}, run_id, generated_at FROM stamped WHERE sim_day = DATE '2024-01-15'
  ORDER BY household_id""",
    "unpriced_households": """SELECT sim_day::VARCHAR AS sim_day, household_id, grid_zone, c::DOUBLE AS total_consumption_kwh
  FROM usage JOIN household USING (household_id) WHERE segment = 'MACHINERY'""",
    "repeated_tariffs": """SELECT sim_day::VARCHAR AS sim_day, household_id, 2::BIGINT AS rate_rows FROM tariff
  WHERE segment <> 'MACHINERY'""",
    "multi_metered": """SELECT sim_day::VARCHAR AS sim_day, 'N-' || c_nationkey AS household_id, grid_zone,
  count(DISTINCT meter_id) AS active_meters FROM uniq JOIN customer ON meter_id = 'M-' || c_custkey
  GROUP BY ALL HAVING count(DISTINCT meter_id) <> 1""",
    "two_zone_households": """SELECT sim_day::VARCHAR AS sim_day, segment AS household_id, count(DISTINCT grid_zone) AS zones
  FROM usage JOIN household USING (household_id) GROUP BY 1, 2 HAVING count(DISTINCT grid_zone) > 1""",
    "partial_days": """SELECT sim_day::VARCHAR AS sim_day, count(*) AS billed, (SELECT count(*) FROM customer) AS configured
  FROM bills GROUP BY 1 HAVING count(*) <> (SELECT count(*) FROM customer)""",
    "latest_complete_window": f"SELECT {WINDOW_FIELDS}, {LOAD} AS avg_load_kw, updated_at FROM latest",
    "latest_any_window": f"SELECT {WINDOW_FIELDS}, {LOAD} AS avg_load_kw, updated_at FROM newest",
    "latest_by_time": """SELECT window_start AS "time", grid_zone, renewable_pct,
  total_consumption_kwh::DOUBLE AS total_consumption_kwh FROM latest ORDER BY 1, 2""",
    "latest_sum": "SELECT sum(active_meters)::BIGINT AS active_meters FROM latest",
    "grid_totals": f"""SELECT zone_count, c::DOUBLE AS grid_total_consumption_kwh, s::DOUBLE AS grid_total_solar_kwh, active_meters,
  {pct('s', 'c')} AS grid_renewable_pct, true AS window_complete FROM (SELECT count(*) AS zone_count, sum(total_consumption_kwh) AS c,
  sum(total_solar_kwh) AS s, sum(active_meters)::BIGINT AS active_meters FROM latest)""",
    "zone_history": f"""SELECT {WINDOW_FIELDS}, {LOAD} AS avg_load_kw, updated_at FROM windows WHERE grid_zone = 'ASIA'
  ORDER BY window_start DESC LIMIT 24""",
    "zone_series": """SELECT updated_at AS "time", grid_zone, renewable_pct, total_consumption_kwh::DOUBLE AS total_consumption_kwh
  FROM windows WHERE updated_at BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-19'""",
    "zone_status": """SELECT a.grid_zone, k.grid_zone IS NOT NULL AS is_known, coalesce(n, 0) AS windows, n IS NOT NULL AS has_rows
  FROM (SELECT r_name AS grid_zone FROM region UNION ALL SELECT n_name FROM nation) a
  LEFT JOIN zone_meters k USING (grid_zone)
  LEFT JOIN (SELECT grid_zone, count(*) AS n FROM windows GROUP BY 1) w ON w.grid_zone = a.grid_zone""",
    "simulated_clock": f"SELECT strftime(max(window_start) + {LOCAL}, '%Y-%m-%d %H:%M') AS local_window FROM windows",
    "billed_days": """SELECT sim_day::VARCHAR AS sim_day, count(*) AS households, round(sum(net_kwh), 3)::DOUBLE AS net_kwh,
  sum(net_amount)::DOUBLE AS net_amount, count(DISTINCT run_id) AS runs, max(generated_at) AS generated_at
  FROM stamped GROUP BY 1 ORDER BY 1 DESC LIMIT 14""",
    "day_list": "SELECT DISTINCT sim_day::VARCHAR AS sim_day FROM bills ORDER BY 1 DESC",
    "zone_revenue": f"""SELECT sim_day::VARCHAR AS sim_day, grid_zone, households, round(c, 2)::DOUBLE AS consumption_kwh,
  round(s, 2)::DOUBLE AS solar_kwh, {pct('s', 'c', 1, 'NULL')} AS solar_share_pct, revenue::DOUBLE AS revenue FROM (
  SELECT sim_day, grid_zone, count(*) AS households, sum(c) AS c, sum(s) AS s, sum(net_amount) AS revenue FROM bills GROUP BY 1, 2)""",
    "day_tile": """SELECT sim_day::VARCHAR AS sim_day, count(*) AS households_billed, round(sum(c), 1)::DOUBLE AS consumption_kwh,
  round(sum(s), 1)::DOUBLE AS solar_kwh, round(sum(net_kwh), 1)::DOUBLE AS net_billed_kwh, sum(subsidy)::DOUBLE AS subsidy,
  sum(net_amount)::DOUBLE AS revenue FROM bills GROUP BY 1""",
    "top_bills": """SELECT sim_day::VARCHAR AS sim_day, household_id, net_amount::DOUBLE AS net_amount FROM bills
  QUALIFY row_number() OVER (PARTITION BY bills.sim_day ORDER BY bills.net_amount DESC, household_id) <= 10""",
    "bottom_bills": f"""SELECT sim_day::VARCHAR AS sim_day, household_id, grid_zone, round(c, 2)::DOUBLE AS used_kwh,
  round(s, 2)::DOUBLE AS solar_kwh, {pct('s', 'c', 1, 'NULL')} AS solar_offset_pct, subsidy_flag,
  subsidy::DOUBLE AS subsidy_amount, net_amount::DOUBLE AS net_amount FROM bills
  QUALIFY row_number() OVER (PARTITION BY bills.sim_day ORDER BY bills.net_amount, household_id) <= 10""",
    "recent_days": """SELECT * FROM (SELECT sim_day::VARCHAR AS sim_day, sum(net_amount)::DOUBLE AS revenue,
  sum(subsidy)::DOUBLE AS subsidy FROM bills GROUP BY 1 ORDER BY 1 DESC LIMIT 14) ORDER BY 1""",
    "coverage_by_zone": """SELECT sim_day::VARCHAR AS sim_day, grid_zone, count(*) AS households,
  round(sum(c), 3)::DOUBLE AS consumption_kwh, round(sum(s), 3)::DOUBLE AS solar_kwh, round(sum(net_kwh), 3)::DOUBLE AS net_kwh,
  sum(net_amount)::DOUBLE AS net_amount, count(*) FILTER (WHERE subsidy_flag) AS subsidised FROM bills GROUP BY 1, 2""",
    "pick_subsidised": f"""SELECT {BILL_FIELDS} FROM (SELECT *, row_number() OVER (PARTITION BY sim_day
  ORDER BY (subsidy_flag AND s > 0) DESC, household_id) AS place FROM bills) WHERE place = 1""",
    "health_row": """SELECT CASE WHEN age <= 30000000 THEN 'ok' ELSE 'degraded' END AS status, age <= 30000000 AS data_fresh,
  round(age / 1000000::DOUBLE, 1) AS seconds_since_last_write, 30::BIGINT AS freshness_threshold_seconds, windows_stored,
  zones_reporting, newest_window_start, (SELECT count(*) FROM zone_meters) AS zones_configured FROM (
  SELECT count(*) AS windows_stored, count(DISTINCT grid_zone) AS zones_reporting, max(window_start) AS newest_window_start,
    datediff('microsecond', max(updated_at), (SELECT now FROM clock)) AS age FROM windows)""",
    "metric_rows": f"""SELECT 'zone_renewable_pct' AS name, grid_zone AS label, renewable_pct AS value FROM latest
  UNION ALL SELECT 'zone_consumption_kwh', grid_zone, total_consumption_kwh::DOUBLE FROM latest
  UNION ALL SELECT 'zone_solar_kwh', grid_zone, total_solar_kwh::DOUBLE FROM latest
  UNION ALL SELECT 'zone_active_meters', grid_zone, active_meters::DOUBLE FROM latest
  UNION ALL SELECT 'zone_avg_load_kw', grid_zone, {LOAD} FROM latest
  UNION ALL SELECT 'serving_lag_seconds', '', (datediff('microsecond', max(updated_at), (SELECT now FROM clock)) // 1000000)::DOUBLE FROM windows
  UNION ALL SELECT 'alerts', rule || '/' || level, count(*)::DOUBLE FROM alerts GROUP BY 1, 2
  UNION ALL SELECT 'pipeline_runs', component || '/' || status, count(*)::DOUBLE FROM runs GROUP BY 1, 2
  UNION ALL SELECT 'batch_last_duration_seconds', component, arg_max(epoch(finished_at - started_at), (finished_at, run_id))::DOUBLE
    FROM runs WHERE status = 'SUCCESS' AND component = '1-URGENT' GROUP BY 1, 2""",
    "status_bands": """SELECT 'renewable/' || grid_zone AS panel, CASE WHEN renewable_pct >= 15 THEN 'green' ELSE 'red' END AS band FROM latest
  UNION ALL SELECT 'lag', CASE WHEN s >= 60 THEN 'red' WHEN s >= 30 THEN 'orange' ELSE 'green' END FROM (
    SELECT datediff('microsecond', max(updated_at), (SELECT now FROM clock)) // 1000000 AS s FROM windows)
  UNION ALL SELECT 'alerts', CASE WHEN count(*) >= 1 THEN 'orange' ELSE 'green' END FROM alerts""",
    "table_counts": """SELECT (SELECT count(*) FROM windows) AS windows, (SELECT count(*) FROM alerts) AS alerts,
  (SELECT count(*) FROM orders) AS runs, (SELECT count(*) FROM bills) AS bills""",
    "out_of_order_events": """SELECT grid_zone, count(*) AS events, count(*) FILTER (WHERE "timestamp" < before) AS out_of_order FROM (
  SELECT grid_zone, "timestamp", lag("timestamp") OVER (PARTITION BY grid_zone ORDER BY ingested_at, event_id) AS before FROM readings) GROUP BY 1""",
    "order_check": """SELECT grid_zone, count(*) AS windows, count(*) FILTER (WHERE window_start > before) = 0 AS newest_first FROM (
  SELECT grid_zone, window_start, lag(window_start) OVER (PARTITION BY grid_zone
    ORDER BY CASE WHEN grid_zone = 'ASIA' THEN epoch(window_start) ELSE -epoch(window_start) END) AS before FROM windows) GROUP BY 1""",
    "throughput_per_minute": """SELECT date_trunc('minute', ingested_at) AS minute, count(*) AS events,
  count(*) FILTER (WHERE ingested_at > "timestamp") AS late, count(*) / 60.0::DOUBLE AS events_per_second,
  count(*) FILTER (WHERE ingested_at > "timestamp") / 60.0::DOUBLE AS late_per_second FROM readings GROUP BY 1""",
    "errors_recent": """SELECT reason, minute + to_minutes(step) AS at_minute, count(*) AS in_window FROM (
  SELECT CASE kind WHEN 0 THEN 'payload is not a JSON object' WHEN 1 THEN 'power_consumption_kwh is not a number'
    WHEN 2 THEN 'missing grid_zone' WHEN 3 THEN 'power_consumption_kwh is negative' WHEN 4 THEN 'timestamp is not ISO-8601'
    WHEN 5 THEN 'missing solar_generation_kwh' END AS reason, date_trunc('minute', ingested_at) AS minute,
    unnest(range(5)) AS step FROM damaged WHERE kind >= 0) GROUP BY 1, 2""",
    "no_data_gaps": """SELECT before AS gap_start, ingested_at AS gap_end,
  datediff('microsecond', before, ingested_at) // 1000000 AS gap_seconds FROM (
  SELECT ingested_at, lag(ingested_at) OVER (ORDER BY ingested_at) AS before FROM readings)
  WHERE datediff('microsecond', before, ingested_at) > 1200000000""",
    "no_data_gaps_by_zone": """SELECT grid_zone, before AS gap_start, ingested_at AS gap_end,
  datediff('microsecond', before, ingested_at) // 1000000 AS gap_seconds FROM (
  SELECT grid_zone, ingested_at, lag(ingested_at) OVER (PARTITION BY grid_zone ORDER BY ingested_at) AS before FROM readings)
  WHERE datediff('microsecond', before, ingested_at) > 7200000000""",
    "counter_increase": f""", {ranges(3600, 1800, True)}
  SELECT grid_zone, "at", samples, resets, increase, increase / 3600 AS per_second FROM risen""",
    "gauge_delta": f""", {ranges(14400, 3600, False)}
  SELECT grid_zone, "at", samples, increase FROM risen""",
    "meters_from_sketches": f"""SELECT sim_day::VARCHAR AS sim_day, grid_zone, c::DOUBLE AS total_consumption_kwh, s::DOUBLE AS total_solar_kwh,
  {pct('s', 'c')} AS renewable_pct, true AS within_5_pct FROM (
   SELECT sim_day, coalesce(grid_zone, 'all') AS grid_zone, sum(used) AS c, sum(solar) AS s FROM readings
   GROUP BY GROUPING SETS ((sim_day, grid_zone), (sim_day)))""",
    "live_table_compacted": f"SELECT {WINDOW_FIELDS} FROM windows",
    "stream_alerts_early": f"""SELECT window_start, grid_zone, level, rule, message, run_id FROM (
  SELECT *, row_number() OVER (PARTITION BY rule, grid_zone, window_start ORDER BY delivery) AS place FROM (
   SELECT 1 AS delivery, * FROM ({alert_rows("(" + windows(f"(SELECT * FROM readings WHERE ingested_at < {_MIDDLE})", LOCAL) + ")")})
   UNION ALL SELECT 2, a.* FROM ({alert_rows("windows")}) a WHERE EXISTS (SELECT 1 FROM readings r WHERE r.ingested_at >= {_MIDDLE}
    AND r.grid_zone = a.grid_zone AND date_trunc('hour', r."timestamp" + {LOCAL}) - {LOCAL} = a.window_start))) WHERE place = 1""",
    "billing_run_day": f"""SELECT sim_day::VARCHAR AS sim_day, household_id, grid_zone, net_amount::DOUBLE AS net_amount,
   'billing-2' AS run_id, 'SUCCESS' AS status, count(*) OVER () AS rows_written FROM bills WHERE sim_day = (
    SELECT max(sim_day) FROM readings WHERE sim_day::TIMESTAMP + INTERVAL 1 DAY - {LOCAL} <= (SELECT max("timestamp") FROM readings) - INTERVAL 30 MINUTE)""",
    "stream_late_rows": f"""SELECT {WINDOW_FIELDS} FROM ({windows(f"""(SELECT * FROM readings WHERE NOT (event_type = 'error' AND ingested_at < {_MIDDLE}
   AND date_trunc('hour', "timestamp" + {LOCAL}) - {LOCAL} + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max("timestamp")) - INTERVAL 30 MINUTE
    FROM readings WHERE event_type <> 'error' AND ingested_at < {_MIDDLE})))""", LOCAL)})""",
    "checkpoint_fit": f"""SELECT * FROM (VALUES ('own', 'steps', 'stateStoreSave, dedupeWithinWatermark', 'stateStoreSave, dedupeWithinWatermark', true),
   ('own', 'window_minutes', '60', '60', true), ('own', 'window start', '30', '30', true), ('own', 'watermark_minutes', '30', '30', true),
   ('other', 'steps', 'stateStoreSave, dedupeWithinWatermark', 'stateStoreSave', false), ('other', 'window_minutes', '60', '30', false),
   ('other', 'window start', '0', '0', true), ('other', 'watermark_minutes', '30', '45', false)) v (settings, "check", found, expected, fits)
  UNION ALL SELECT '', 'rows of stateStoreSave', count(*)::VARCHAR, NULL, NULL FROM (
   SELECT DISTINCT date_trunc('hour', "timestamp" + {LOCAL}) - {LOCAL} AS w, grid_zone, meter_id FROM readings)
   WHERE w + INTERVAL 1 HOUR > (SELECT date_trunc('milliseconds', max("timestamp")) - INTERVAL 30 MINUTE FROM readings)
  UNION ALL SELECT '', 'rows of dedupeWithinWatermark', count(*)::VARCHAR, NULL, NULL FROM (SELECT DISTINCT meter_id, "timestamp" FROM readings)
   WHERE "timestamp" + INTERVAL 30 MINUTE > (SELECT date_trunc('milliseconds', max("timestamp")) - INTERVAL 30 MINUTE FROM readings)""",
    "stream_no_data": """SELECT grid_zone, "at" AS gap_start, next AS gap_end, datediff('microsecond', "at", next) // 1000000 AS gap_seconds FROM (
  SELECT grid_zone, ingested_at AS "at", lead(ingested_at) OVER (PARTITION BY grid_zone ORDER BY ingested_at) AS next, told
  FROM readings, (SELECT max(ingested_at) - INTERVAL 5 MINUTE AS told FROM readings)
  WHERE date_trunc('minute', ingested_at) + INTERVAL 1 MINUTE <= told)
  WHERE datediff('microsecond', "at", coalesce(next, told)) > 7200000000""",
    "late_day_crossings": f"""SELECT sim_day::VARCHAR AS sim_day, count(*) AS readings,
  count(*) FILTER (WHERE CAST(ingested_at + {LOCAL} AS DATE) > sim_day) AS arrived_next_day FROM readings GROUP BY 1""",
    "run_ledger": """SELECT run_id, component, status, sim_day::VARCHAR AS sim_day, started_at, finished_at, rows_written, notes FROM runs""",
    "run_counts": "SELECT component, status, count(*) AS runs FROM runs GROUP BY 1, 2",
    "recent_runs": """SELECT run_id, component, status, sim_day::VARCHAR AS sim_day, started_at, finished_at, rows_written FROM runs
  ORDER BY started_at DESC, run_id LIMIT 15""",
    "newest_run_per_day": """SELECT sim_day::VARCHAR AS sim_day, run_id, status, rows_written,
  datediff('second', started_at, finished_at) AS seconds, times_run FROM (SELECT *, count(*) OVER (PARTITION BY sim_day) AS times_run,
  row_number() OVER (PARTITION BY sim_day ORDER BY started_at DESC, run_id DESC) AS place FROM runs WHERE component = '1-URGENT')
  WHERE place = 1""",
    "failed_runs_recent": """SELECT component, count(*) FILTER (WHERE status = 'FAILED' AND finished_at > now - INTERVAL 2 DAY
  AND finished_at <= now) AS failed FROM runs, (SELECT greatest(max(started_at), max(CASE WHEN own_status IS NOT NULL THEN ended_at END)) AS now
  FROM run_rows) GROUP BY 1""",
    "last_success_duration": """SELECT component, arg_max(datediff('second', started_at, finished_at), (finished_at, run_id)) AS seconds
  FROM runs WHERE status = 'SUCCESS' GROUP BY 1""",
    "bill_ownership": """SELECT sim_day::VARCHAR AS sim_day, owners, newest_run, newest_status, owners = 1 AS one_owner,
  owners = 1 AND owner = newest_run AS traced, owners = 1 AND owner = newest_run AND newest_status = 'SUCCESS' AS ok FROM (
  SELECT sim_day, count(DISTINCT run_id) AS owners, max(run_id) AS owner,
    'billing-' || strftime(sim_day, '%Y%m%d') || CASE WHEN day(sim_day) % 2 = 1 THEN '-2' ELSE '-1' END AS newest_run,
    CASE WHEN day(sim_day) % 10 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS newest_status FROM stamped GROUP BY sim_day)""",
    "missing_zones": "SELECT n_name AS grid_zone FROM nation EXCEPT SELECT grid_zone FROM windows",
    "unexpected_zones": "SELECT grid_zone FROM windows EXCEPT SELECT r_name FROM region WHERE r_name <> 'EUROPE'",
    "offset_counts": """SELECT grid_zone AS source, count(DISTINCT event_type) AS partitions, count(*) AS messages FROM readings GROUP BY 1""",
    "reconcile_counts": f"""SELECT source, messages, stored, messages - stored AS lag,
  {pct('stored::DECIMAL(18,4)', 'messages::DECIMAL(18,4)', 1)} AS coverage_pct,
  CASE WHEN messages - stored < 0 THEN 'store_ahead' WHEN messages - stored <= 360 THEN 'within_budget' ELSE 'behind' END AS verdict,
  messages - stored <= 360 AS ok FROM (SELECT grid_zone AS source, count(*) AS messages,
  count(*) FILTER (WHERE kind = -1) AS stored FROM damaged GROUP BY 1)""",
    "completeness": f"""SELECT grid_zone, sim_day::VARCHAR AS sim_day, stored, meters, meters * 150 AS expected,
  {pct('stored::DECIMAL(18,4)', '(meters * 150)::DECIMAL(18,4)', 1)} AS completeness_pct FROM (
  SELECT sim_day, grid_zone, count(*) AS stored FROM uniq GROUP BY 1, 2) JOIN zone_meters USING (grid_zone)""",
    "expected_rows": "SELECT grid_zone, meters, meters * 150 AS expected_rows FROM zone_meters",
    "constraint_findings": """SELECT 'not_null' AS "check", 'run_id' AS "column", 0::BIGINT AS violations
  UNION ALL SELECT 'not_null', 'component', 0 UNION ALL SELECT 'not_null', 'at', 0
  UNION ALL SELECT 'not_null', 'status', count(*) FROM orders
  UNION ALL SELECT 'domain', 'status', count(*) FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT 'domain', 'kind', 0
  UNION ALL SELECT 'primary_key', 'run_id', count(*) FROM orders WHERE o_orderstatus IN ('F', 'O')""",
    "verify_bills": """SELECT sim_day::VARCHAR AS sim_day, household_id, 'net_amount' AS field, t.net_amount::DOUBLE AS stored,
  b.net_amount::DOUBLE AS derived FROM tampered t JOIN bills b USING (sim_day, household_id)
  WHERE abs(t.net_amount - b.net_amount) > 0.01""",
    "recompute_bills": """SELECT t.sim_day::VARCHAR AS sim_day, household_id, n AS readings,
  CASE WHEN abs(t.net_amount - b.net_amount) > 0.01 THEN 1 ELSE 0 END AS fields_wrong,
  abs(t.net_amount - b.net_amount) <= 0.01 AS agrees FROM tampered t JOIN bills b USING (sim_day, household_id)
  JOIN (SELECT sim_day, household_id, count(*) AS n FROM uniq GROUP BY 1, 2) USING (sim_day, household_id)""",
    "impossible_bills": """SELECT sim_day::VARCHAR AS sim_day, count(*) AS bills,
  count(*) FILTER (WHERE net_kwh < 0 OR net_amount < 0 OR net_kwh > c) AS impossible FROM (SELECT * REPLACE (
    CASE WHEN grid_zone = 'ASIA' THEN c + net_kwh + 1 ELSE net_kwh END AS net_kwh,
    CASE WHEN subsidy_flag THEN -net_amount - 1 ELSE net_amount END AS net_amount) FROM bills) GROUP BY 1""",
    "window_checks": _window_checks("""SELECT * REPLACE (window_end + CASE WHEN grid_zone = 'ASIA' THEN INTERVAL 1 MINUTE
  ELSE INTERVAL 0 MINUTE END AS window_end) FROM windows"""),
    "window_checks_all": _window_checks("""SELECT * REPLACE (renewable_pct + CASE WHEN grid_zone = 'ASIA' THEN 1 ELSE 0 END AS renewable_pct,
  active_meters + CASE WHEN grid_zone = 'EUROPE' THEN 1000000 ELSE 0 END AS active_meters) FROM windows"""),
    "zone_freshness": """SELECT a.grid_zone, window_start, renewable_pct, active_meters,
  datediff('microsecond', updated_at, now) // 1000000 AS age_seconds, window_start IS NOT NULL AS reported,
  coalesce(datediff('microsecond', updated_at, now) // 1000000 <= 1200, false) AS ok
  FROM (SELECT r_name AS grid_zone FROM region UNION ALL SELECT n_name FROM nation) a
  LEFT JOIN newest USING (grid_zone), clock""",
    "layer_agreement": f"""SELECT sim_day::VARCHAR AS sim_day, grid_zone, round(b, 2)::DOUBLE AS batch_kwh, round(w, 2)::DOUBLE AS speed_kwh,
  coalesce(n, 0) AS windows, p AS difference_pct,
  CASE WHEN w IS NULL THEN 'no windows' WHEN p = 0 THEN 'equal' ELSE 'differs' END AS verdict FROM (
  SELECT *, CASE WHEN w IS NULL THEN NULL WHEN b = 0 THEN 0::DOUBLE ELSE sign(b - w) * CAST((2 * abs(CAST((b - w) * 10000 AS HUGEINT)) * 1000
    + CAST(b * 10000 AS HUGEINT)) // (2 * CAST(b * 10000 AS HUGEINT)) AS DOUBLE) / 10::DOUBLE END AS p FROM
  (SELECT sim_day, grid_zone, sum(c) AS b FROM bills GROUP BY 1, 2) LEFT JOIN
  (SELECT CAST(window_start + {LOCAL} AS DATE) AS sim_day, grid_zone, sum(total_consumption_kwh) AS w, count(*) AS n
   FROM ({_LIVE}) GROUP BY 1, 2) USING (sim_day, grid_zone))""",
    "latest_two_ways": """SELECT l.grid_zone, served.renewable_pct AS served_pct, l.renewable_pct AS derived_pct
  FROM latest l LEFT JOIN (SELECT grid_zone, renewable_pct + CASE WHEN grid_zone = 'ASIA' THEN 1 ELSE 0 END AS renewable_pct
    FROM latest WHERE grid_zone <> 'EUROPE') served USING (grid_zone)
  WHERE served.renewable_pct IS NULL OR abs(served.renewable_pct - l.renewable_pct) > 0.01""",
    "merge_keyed": f"""SELECT {WINDOW_FIELDS}, source FROM (
  SELECT *, 'late' AS source FROM ({windows("(SELECT * FROM stored WHERE event_type = 'error')", LOCAL)})
  UNION ALL SELECT *, 'live' FROM ({_LIVE}) l WHERE NOT EXISTS (SELECT 1 FROM readings r WHERE r.event_type = 'error'
    AND r.grid_zone = l.grid_zone AND r."timestamp" >= l.window_start AND r."timestamp" < l.window_end))""",
    "upsert_bills": """SELECT sim_day::VARCHAR AS sim_day, household_id, grid_zone, net_amount::DOUBLE AS net_amount,
  CASE WHEN day(sim_day) % 2 = 1 THEN 2 ELSE 1 END::BIGINT AS run FROM bills JOIN household USING (household_id)
  WHERE day(sim_day) % 2 = 0 OR segment <> 'MACHINERY'""",
    "csv_tariff_typed": """SELECT sim_day::VARCHAR AS sim_day, household_id, tariff_rate::DOUBLE AS tariff_rate, billing_tier,
  subsidy_flag FROM tariff""",
    "report_roundtrip": """SELECT sim_day::VARCHAR AS sim_day, count(*) AS bill_rows, count(*) AS report_rows, true AS ok
  FROM bills GROUP BY 1""",
    "store_layout": """SELECT sim_day::VARCHAR AS sim_day, grid_zone, count(*) AS "rows", true AS fits FROM stored GROUP BY 1, 2""",
    "store_summary": """SELECT count(*) AS "rows", count(DISTINCT (meter_id, "timestamp")) AS distinct_readings FROM stored""",
    "stored_day": """SELECT meter_id, "timestamp", sim_day::VARCHAR AS sim_day, grid_zone, used::DOUBLE AS power_consumption_kwh,
  solar::DOUBLE AS solar_generation_kwh FROM uniq WHERE sim_day = DATE '2024-01-15'""",
    "rates_of_day": """SELECT sim_day::VARCHAR AS sim_day, household_id, tariff_rate::DOUBLE AS tariff_rate, billing_tier,
  subsidy_flag FROM tariff WHERE sim_day = DATE '2024-01-15'""",
    "report_in_order": """SELECT sim_day::VARCHAR AS sim_day, count(*) AS "rows", true AS in_order FROM bills GROUP BY 1""",
    "usage_from_buckets": """SELECT sim_day::VARCHAR AS sim_day, household_id, grid_zone, c::DOUBLE AS total_consumption_kwh,
  s::DOUBLE AS total_solar_kwh, m AS active_meters FROM usage""",
    "layer_difference_rows": """SELECT sim_day::VARCHAR AS sim_day, grid_zone, meter_id, "timestamp", used::DOUBLE AS power_consumption_kwh,
  solar::DOUBLE AS solar_generation_kwh, ingested_at, count(*) AS more FROM (
   SELECT * FROM stored EXCEPT ALL SELECT * FROM uniq) GROUP BY ALL""",
    "windows_of_day": f"""SELECT {WINDOW_FIELDS} FROM windows WHERE CAST(window_start + {LOCAL} AS DATE) = DATE '2024-01-15'""",
    "run_findings": """SELECT 'refused' AS level, 'without a rate' AS finding, sim_day::VARCHAR AS sim_day, count(*) AS households
  FROM usage JOIN household USING (household_id) WHERE segment = 'MACHINERY' GROUP BY ALL
  UNION ALL SELECT 'warning', 'with other than one meter', sim_day::VARCHAR, count(*) FROM usage WHERE m <> 1 GROUP BY ALL""",
    "stream_raw_store": """SELECT sim_day::VARCHAR AS sim_day, grid_zone, sum(used)::DOUBLE AS total_consumption_kwh,
  sum(solar)::DOUBLE AS total_solar_kwh, count(DISTINCT meter_id) AS active_meters, count(*) AS "rows"
  FROM damaged WHERE kind = -1 GROUP BY 1, 2""",
    "stream_new_checkpoint": """SELECT sim_day::VARCHAR AS sim_day, grid_zone, sum(used)::DOUBLE AS total_consumption_kwh,
  sum(solar)::DOUBLE AS total_solar_kwh, count(DISTINCT meter_id) AS active_meters, count(*) AS "rows"
  FROM readings GROUP BY 1, 2""",
    "stream_zone_windows": f"SELECT {WINDOW_FIELDS} FROM windows",
    "stream_final_windows": f"SELECT {WINDOW_FIELDS} FROM windows WHERE {_CLOSED}",
    "stream_dedup_windows": f"SELECT {WINDOW_FIELDS} FROM ({windows('uniq', LOCAL)})",
    "stream_alerts": f"""SELECT window_start, grid_zone, level, rule, message, run_id FROM alerts
  WHERE window_start + INTERVAL 1 HOUR <= (SELECT max("timestamp") FROM readings) - INTERVAL 30 MINUTE""",
}

# Line items have their own usage, each at the rate of its own day.
_LINE = f"""{MODEL}, line_usage AS (SELECT CAST(l_shipdate AS DATE) AS sim_day, 'H-' || o_custkey AS household_id, grid_zone,
  sum(l_quantity::DECIMAL(18,4)) AS c, sum((l_quantity::DECIMAL(9,2) * l_discount::DECIMAL(9,2))::DECIMAL(18,4)) AS s
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer_zone ON user_id = o_custkey GROUP BY ALL),
line_tariff AS (SELECT sim_day, household_id, {rate('sim_day')} AS tariff_rate, billing_tier, subsidy_flag
  FROM (SELECT DISTINCT sim_day, household_id FROM line_usage) JOIN terms USING (household_id)),
line_bills AS ({bills('line_usage', 'line_tariff', 'sim_day, household_id')})
"""


def oracle() -> dict[str, str]:
    statements = {name: MODEL + sql for name, sql in _Q.items()}
    statements["lineitem_bills"] = f"{_LINE} SELECT {BILL_FIELDS} FROM line_bills"
    statements["lineitem_bill_summary"] = _LINE + _Q["bill_summary"].replace("FROM bills", "FROM line_bills")
    return statements
