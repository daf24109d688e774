"""DuckDB SQL computing each catalog key independently of Spark.

Views ``region nation customer supplier part orders lineitem events ...`` are
registered by the checker. Rounded measures use ``round`` on a DECIMAL cast,
which rounds half up on the decimal value, as Spark's ``round`` on a double
does; ``initcap`` is spelled out word by word.
"""

from __future__ import annotations


def _initcap(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({x}), ' '), "
        f"lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"
    )


def _display(x: str) -> str:
    return _initcap(f"replace({x}, '_', ' ')")


def _round(x: str, places: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38, 12)), {places}) AS DOUBLE)"


def _epoch(x: str) -> str:
    return f"CAST(floor(epoch({x})) AS BIGINT)"


Y1, Y2 = 1996, 1999

CITIES = f"""cities AS (
  SELECT n.n_name AS City, CAST(n.n_nationkey AS DOUBLE) AS Latitude,
         CAST(n.n_regionkey AS DOUBLE) AS Longitude,
         {_display('n.n_name')} AS Country, {_display('r.r_name')} AS Continent
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""

ASIA = """asia AS (SELECT DISTINCT Country FROM cities WHERE Continent = 'Asia')"""

EQ_BRONZE = f"""eq_bronze AS (
  SELECT 'order ' || CAST(o.o_orderkey AS VARCHAR) AS title,
         o.o_totalprice / 100000 AS magnitude,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN strftime(o.o_orderdate, '%-d-%-m-%Y %-H:%-M')
              ELSE strftime(o.o_orderdate, '%d-%m-%Y %H:%M') END AS date_time,
         CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS tsunami,
         CAST(floor(o.o_totalprice / 1000) AS INTEGER) AS sig,
         CAST(o.o_custkey % 700 AS VARCHAR) AS depth,
         CASE WHEN c.c_mktsegment = 'BUILDING' AND o.o_orderstatus = 'P' THEN NULL
              ELSE c.c_mktsegment || ', ' || {_display('n.n_name')} END AS location,
         {_display('r.r_name')} AS continent,
         CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE n.n_name END AS country
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey)"""

_PARSED = (
    "CASE WHEN regexp_full_match(date_time, '[0-9]{2}-[0-9]{2}-[0-9]{4} [0-9]{2}:[0-9]{2}') "
    "THEN try_strptime(date_time, '%d-%m-%Y %H:%M') END"
)

EQ_SILVER = f"""eq_silver AS (
  SELECT * FROM (
    SELECT b.title, b.magnitude, b.tsunami, b.sig, b.depth, b.location, b.continent,
           string_split(b.location, ', ')[-1] AS country, {_PARSED.replace('date_time', 'b.date_time')} AS time_stamp
    FROM eq_bronze b
    WHERE b.location IS NOT NULL AND b.continent IS NOT NULL AND b.country IS NOT NULL
      AND b.continent = 'Asia')
  WHERE time_stamp >= TIMESTAMP '{Y1}-01-01' AND time_stamp < TIMESTAMP '{Y2 + 1}-01-01')"""

# Places of the earthquakes and tsunamis, by order.
PLACES = """places AS (
  SELECT o_orderkey, (o_custkey * 37 % 14000) / 100.0::DOUBLE - 70 AS lat, (o_custkey * 91 % 36000) / 100.0::DOUBLE - 180 AS lon,
         (o_custkey * 37 % 14000) / 100.0::DOUBLE - 70 + (o_orderkey % 11 - 5) / 10.0::DOUBLE AS wave_lat,
         (o_custkey * 91 % 36000) / 100.0::DOUBLE - 180 + (o_orderkey % 7 - 3) / 5.0::DOUBLE AS wave_lon
  FROM orders)"""

TS_BRONZE = """ts_bronze AS (
  SELECT o.o_orderkey AS "Sr.no",
         CAST(year(o.o_orderdate) AS INTEGER) AS "Year",
         CAST(month(o.o_orderdate) AS INTEGER) AS "Mo",
         CAST(day(o.o_orderdate) AS INTEGER) AS "Dy",
         CASE WHEN o.o_orderstatus = 'O' THEN NULL ELSE CAST(o.o_custkey % 24 AS INTEGER) END AS "Hr",
         CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE CAST(o.o_orderkey % 60 AS INTEGER) END AS "Mn",
         CAST(NULL AS DOUBLE) AS "Sec",
         CAST(o.o_custkey % 12 AS INTEGER) AS "TsunamiNanCauseNanCode",
         replace(n.n_name, '_', 'Nan') AS "Country",
         CAST(floor(o.o_totalprice / 10000) AS INTEGER) AS "Deaths",
         CASE WHEN o.o_orderstatus = 'F' THEN NULL ELSE CAST(o.o_custkey % 7 AS INTEGER) END AS "Missing",
         CAST(o.o_orderkey % 13 AS INTEGER) AS "Injuries",
         CAST(floor(o.o_totalprice / 50000) AS INTEGER) AS "HousesNanDestroyed",
         CAST(o.o_custkey % 100 AS INTEGER) AS "HousesNanDamaged"
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

_PARTS_TS = """try_strptime(concat_ws(' ',
      concat_ws('-', CAST("Year" AS VARCHAR), lpad(CAST("Mo" AS VARCHAR), 2, '0'), lpad(CAST("Dy" AS VARCHAR), 2, '0')),
      concat_ws(':', coalesce(lpad(CAST("Hr" AS VARCHAR), 2, '0'), '00'), coalesce(lpad(CAST("Mn" AS VARCHAR), 2, '0'), '00'))),
    '%Y-%m-%d %H:%M')"""

def _norm_country(ref: str = '"Country"') -> str:
    return _initcap(f"replace({ref}, 'Nan', ' ')")


_NORM_COUNTRY = _norm_country()
_NORM_B = _norm_country('b."Country"')

TS_SILVER = f"""ts_silver AS (
  SELECT "Sr.no", "TsunamiNanCauseNanCode", "Country", "Deaths", "Missing",
         "Injuries", "HousesNanDestroyed", "HousesNanDamaged", {_PARTS_TS} AS time_stamp
  FROM ts_bronze
  WHERE "Year" BETWEEN {Y1} AND {Y2})"""

TS_ASIA = f"""ts_asia AS (
  SELECT {_norm_country('s."Country"')} AS Country, s."TsunamiNanCauseNanCode" AS TsunamiCauseCode,
         s."Deaths" AS Deaths, s."Missing" AS Missing, s."Injuries" AS Injuries,
         s."HousesNanDestroyed" AS HousesDestroyed, s."HousesNanDamaged" AS HousesDamaged,
         s.time_stamp AS "Timestamp"
  FROM ts_silver s WHERE {_norm_country('s."Country"')} IN (SELECT a.Country FROM asia a))"""

HITS = """hits AS (SELECT Country, count(*) AS hits FROM ts_asia GROUP BY Country),
top3 AS (SELECT Country, hits FROM hits ORDER BY hits DESC, Country LIMIT 3)"""

CHARGE = f"""start_req AS (
  SELECT o_orderkey AS message_id, o_custkey AS meter_start, o_orderdate AS "timestamp" FROM orders),
start_resp AS (
  SELECT l_orderkey AS message_id, 'CP-' || CAST(l_suppkey AS VARCHAR) AS charge_point_id, l_orderkey AS transaction_id
  FROM lineitem WHERE l_linenumber = 1),
stop_req AS (
  SELECT l_orderkey AS transaction_id, CAST(sum(l_quantity) * 250 AS BIGINT) AS meter_stop,
         max(l_shipdate) AS "timestamp"
  FROM lineitem GROUP BY l_orderkey),
starts AS (
  SELECT r.charge_point_id, r.transaction_id, q.meter_start, q."timestamp" AS start_timestamp
  FROM start_resp r JOIN start_req q ON r.message_id = q.message_id),
matched AS (
  SELECT s.charge_point_id, s.transaction_id, s.meter_start, p.meter_stop, s.start_timestamp,
         p."timestamp" AS stop_timestamp
  FROM stop_req p LEFT JOIN starts s ON p.transaction_id = s.transaction_id),
mv AS (
  SELECT l_orderkey AS transaction_id, l_shipdate AS "timestamp", l_quantity - 25 AS value,
         l_linenumber, l_partkey, l_suppkey
  FROM lineitem
  WHERE (CASE WHEN l_returnflag = 'R' THEN 'Energy.Active.Import.Register' ELSE 'Power.Active.Import' END)
          = 'Power.Active.Import'
    AND (CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'L1' END) IS NULL),
mv_b AS (
  SELECT *, CASE WHEN value > 0 THEN 1 ELSE 0 END AS charging,
         abs(CASE WHEN value > 0 THEN 1 ELSE 0 END
             - lag(CASE WHEN value > 0 THEN 1 ELSE 0 END, 1, 0) OVER (
               PARTITION BY transaction_id ORDER BY "timestamp", l_linenumber, l_partkey, l_suppkey)) AS boundary
  FROM mv),
mv_g AS (
  SELECT *, sum(boundary) OVER (PARTITION BY transaction_id ORDER BY "timestamp", l_linenumber, l_partkey, l_suppkey
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp
  FROM mv_b),
mv_groups AS (
  SELECT transaction_id, grp, {_epoch('max("timestamp")')} - {_epoch('min("timestamp")')} AS d
  FROM mv_g WHERE charging = 0 GROUP BY transaction_id, grp),
idle AS (
  SELECT transaction_id, {_round('sum(d) / 3600')} AS total_parking_time FROM mv_groups GROUP BY transaction_id),
records AS (
  SELECT m.charge_point_id, m.transaction_id, m.meter_start, m.meter_stop, m.start_timestamp, m.stop_timestamp,
         {_round(f"({_epoch('m.stop_timestamp')} - {_epoch('m.start_timestamp')}) / 3600")} AS total_time,
         {_round('(m.meter_stop - m.meter_start) / 1000')} AS total_energy,
         i.total_parking_time
  FROM matched m LEFT JOIN idle i ON m.transaction_id = i.transaction_id)"""

EVENTS = """ev_flags AS (
  SELECT user_id, ts, event_id, value, CASE WHEN value > 20 THEN 1 ELSE 0 END AS charging
  FROM events),
ev_b AS (
  SELECT *, abs(charging - lag(charging, 1, 0) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id)) AS boundary
  FROM ev_flags),
ev_g AS (
  SELECT *, CAST(sum(boundary) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS charging_group
  FROM ev_b)"""


_IMPACT = [
    ("Deaths", "deaths"),
    ("Missing", "missing"),
    ("Injuries", "injuries"),
    ("HousesDestroyed", "houses_destroyed"),
    ("HousesDamaged", "houses_damaged"),
]


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE_SQL: dict[str, str] = {
    "csv_typed_ingest": "SELECT * FROM orders",
    "csv_incremental_ingest": "SELECT * FROM orders",
    "parquet_scan": "SELECT * FROM orders",
    "parquet_overwrite": "SELECT * FROM orders",
    "csv_corrupt_counts": "SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderkey % 7 = 0) AS corrupt_rows FROM orders",
    "csv_quarantine": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 11 = 0 THEN 'number of fields' WHEN o_orderkey % 7 = 0 THEN 'o_totalprice is not double' END AS reason
FROM orders""",
    "parquet_partition_overwrite": "SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 2 ELSE o_totalprice END AS o_totalprice) FROM orders",
    "clustered_scan": f"""SELECT * FROM orders WHERE o_custkey BETWEEN 100 AND 400
  AND o_orderdate BETWEEN TIMESTAMP '{Y1}-01-01' AND TIMESTAMP '{Y1}-12-31'""",
    "evolving_layouts": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN year(o_orderdate) < {Y1} THEN date_trunc('day', o_orderdate)::TIMESTAMP ELSE o_orderdate END AS o_orderdate,
       CASE WHEN year(o_orderdate) >= {Y1} THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN year(o_orderdate) > {Y2} THEN 'c' END AS o_clerk FROM orders""",
    "output_manifest": "SELECT o_orderstatus, count(*) AS rows FROM orders GROUP BY o_orderstatus",
    "filter_equals": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
    "filter_year_range": f"SELECT * FROM orders WHERE year(o_orderdate) BETWEEN {Y1} AND {Y2}",
    "filter_int_range": "SELECT * FROM lineitem WHERE l_linenumber BETWEEN 2 AND 4",
    "filter_complete_rows": "SELECT * FROM events WHERE ts IS NOT NULL AND value IS NOT NULL AND props IS NOT NULL",
    "distinct_keys": _with(TS_BRONZE) + f"SELECT DISTINCT {_NORM_B} AS Country FROM ts_bronze b",
    "parse_timestamp": _with(EQ_BRONZE) + f"SELECT title, {_PARSED} AS time_stamp FROM eq_bronze",
    "timestamp_from_parts": _with(TS_BRONZE) + f'SELECT "Sr.no", {_PARTS_TS} AS time_stamp FROM ts_bronze',
    "last_token": _with(EQ_BRONZE)
    + "SELECT title, location, string_split(location, ', ')[-1] AS country FROM eq_bronze",
    "normalize_name": _with(TS_BRONZE)
    + f'SELECT b."Sr.no", {_NORM_B} AS Country FROM ts_bronze b',
    "dim_match_numeric": _with(CITIES, ASIA, EQ_BRONZE, EQ_SILVER)
    + """SELECT country AS Country, title AS Title, magnitude AS Magnitude, depth AS Depth,
       tsunami AS Tsunami, time_stamp AS "Timestamp"
FROM eq_silver WHERE country IN (SELECT Country FROM asia)""",
    "dim_match_impact": _with(CITIES, ASIA, TS_BRONZE, TS_SILVER, TS_ASIA) + "SELECT * FROM ts_asia",
    "dim_match_fanout": _with(EQ_BRONZE, EQ_SILVER)
    + f""", sup AS (
  SELECT {_display('n.n_name')} AS Country, s.s_name AS City
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
per_country AS (
  SELECT Country, count(*) AS n_cities, min(City) AS first_city, max(City) AS last_city
  FROM sup WHERE Country IS NOT NULL GROUP BY Country)
SELECT e.title, e.country, p.n_cities, p.first_city, p.last_city
FROM eq_silver e JOIN per_country p ON e.country = p.Country""",
    "group_count_ranked": _with(CITIES, ASIA, TS_BRONZE, TS_SILVER, TS_ASIA, HITS) + "SELECT * FROM hits",
    "topk": _with(CITIES, ASIA, TS_BRONZE, TS_SILVER, TS_ASIA, HITS) + "SELECT * FROM top3",
    "topk_detail": _with(CITIES, ASIA, TS_BRONZE, TS_SILVER, TS_ASIA, HITS)
    + """SELECT Country, "Timestamp", Deaths, Missing, Injuries, HousesDestroyed, HousesDamaged
FROM ts_asia WHERE Country IN (SELECT Country FROM top3)""",
    "topk_by_measure": _with(CITIES, ASIA, TS_BRONZE, TS_SILVER, TS_ASIA)
    + """, per_country AS (
  SELECT Country, count(*) AS events,
         CAST(sum(coalesce(CAST(Deaths AS BIGINT), 0)) AS BIGINT) AS deaths,
         CAST(sum(coalesce(CAST(Missing AS BIGINT), 0)) AS BIGINT) AS missing,
         CAST(sum(coalesce(CAST(Injuries AS BIGINT), 0)) AS BIGINT) AS injuries,
         CAST(sum(coalesce(CAST(HousesDestroyed AS BIGINT), 0)) AS BIGINT) AS houses_destroyed,
         CAST(sum(coalesce(CAST(HousesDamaged AS BIGINT), 0)) AS BIGINT) AS houses_damaged
  FROM ts_asia GROUP BY Country)
SELECT *, deaths + missing + injuries + houses_destroyed + houses_damaged AS impact
FROM per_country ORDER BY impact DESC, Country LIMIT 3""",
    "topk_trend": _with(CITIES, ASIA, TS_BRONZE, TS_SILVER, TS_ASIA, HITS)
    + ", yearly AS (\n  SELECT Country, CAST(year(\"Timestamp\") AS INTEGER) AS year, count(*) AS events"
    + "".join(f",\n         CAST(sum(coalesce(CAST({m} AS BIGINT), 0)) AS BIGINT) AS {n}" for m, n in _IMPACT)
    + """
  FROM ts_asia WHERE Country IN (SELECT Country FROM top3)
  GROUP BY Country, CAST(year("Timestamp") AS INTEGER))
SELECT y.*, """
    + ", ".join(f"y.{n} - p.{n} AS {n}_change" for _, n in _IMPACT)
    + "\nFROM yearly y LEFT JOIN yearly p ON p.Country = y.Country AND p.year = y.year - 1",
    "trend_break": _with(CITIES, ASIA, TS_BRONZE, TS_SILVER, TS_ASIA)
    + """, counts AS (
  SELECT Country, CAST(year("Timestamp") AS INTEGER) AS y, count(*) AS n FROM ts_asia WHERE "Timestamp" IS NOT NULL GROUP BY ALL),
span AS (SELECT Country, min(y) AS first_year, max(y) AS last_year FROM counts GROUP BY Country),
series AS (
  SELECT s.Country, s.first_year, s.last_year, g.y, coalesce(c.n, 0)::DOUBLE AS n
  FROM span s, LATERAL (SELECT CAST(unnest(range(s.first_year, s.last_year + 1)) AS INTEGER) AS y) g
  LEFT JOIN counts c ON c.Country = s.Country AND c.y = g.y),
splits AS (
  SELECT a.Country, a.y AS break_year, avg(b.n) FILTER (b.y < a.y) AS mb, avg(b.n) FILTER (b.y >= a.y) AS ma,
         sum(b.n * b.n) - count(*) FILTER (b.y < a.y) * pow(avg(b.n) FILTER (b.y < a.y), 2)
           - count(*) FILTER (b.y >= a.y) * pow(avg(b.n) FILTER (b.y >= a.y), 2) AS e
  FROM series a JOIN series b ON a.Country = b.Country WHERE a.y > a.first_year GROUP BY a.Country, a.y),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY Country ORDER BY round(e, 6), break_year) AS r FROM splits),
alone AS (SELECT Country, sum(n * n) - count(*) * pow(avg(n), 2) AS e FROM series GROUP BY Country)
SELECT s.Country, s.first_year, s.last_year, k.break_year, round(k.mb, 6) AS mean_before, round(k.ma, 6) AS mean_after,
       round(k.e, 6) AS error, round(o.e, 6) AS error_without
FROM span s JOIN alone o ON o.Country = s.Country LEFT JOIN ranked k ON k.Country = s.Country AND k.r = 1""",
    "charge_record_colocated": _with(CHARGE) + "SELECT * FROM records",
    "request_response_match": _with(CHARGE) + "SELECT * FROM starts",
    "stop_start_match": _with(CHARGE) + "SELECT * FROM matched",
    "duration_hours": _with(CHARGE)
    + "SELECT charge_point_id, transaction_id, start_timestamp, stop_timestamp, total_time FROM records",
    "unit_delta": _with(CHARGE)
    + "SELECT charge_point_id, transaction_id, meter_start, meter_stop, total_energy FROM records",
    "parking_time": _with(CHARGE) + "SELECT * FROM idle",
    "charge_record": _with(CHARGE) + "SELECT * FROM records",
    "pipeline_charge_record": _with(CHARGE) + "SELECT * FROM records",
    "lag_change_flag": _with(EVENTS) + "SELECT user_id, ts, event_id, value, charging, boundary FROM ev_b",
    "running_group_id": _with(EVENTS)
    + "SELECT user_id, ts, event_id, value, charging, boundary, charging_group FROM ev_g",
    "group_bounds": _with(EVENTS)
    + """SELECT user_id, charging_group, max(charging) AS charging, min(ts) AS "first", max(ts) AS "last",
       count(*) AS readings
FROM ev_g GROUP BY user_id, charging_group""",
    "idle_time": _with(EVENTS)
    + f""", durations AS (
  SELECT user_id, charging_group, {_epoch('max(ts)')} - {_epoch('min(ts)')} AS d
  FROM ev_g WHERE charging = 0 GROUP BY user_id, charging_group)
SELECT user_id, {_round('coalesce(sum(d), 0) / 3600')} AS idle_hours FROM durations GROUP BY user_id""",
    "pipeline_dimension": f"""SELECT s.s_name AS City, s.s_acctbal AS Latitude, CAST(s.s_suppkey AS DOUBLE) AS Longitude,
       {_display('n.n_name')} AS Country, {_display('r.r_name')} AS Continent
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE {_display('r.r_name')} = 'Asia'""",
    "pipeline_facts_text_time": _with(EQ_BRONZE, EQ_SILVER) + "SELECT * FROM eq_silver",
    "pipeline_facts_part_time": _with(TS_BRONZE, TS_SILVER) + "SELECT * FROM ts_silver",
    "pipeline_topk_impact": _with(CITIES, ASIA, TS_BRONZE, TS_SILVER, TS_ASIA, HITS)
    + """SELECT Country, "Timestamp", Deaths, Missing, Injuries, HousesDestroyed, HousesDamaged
FROM ts_asia WHERE Country IN (SELECT Country FROM top3)""",
    "pipeline_layers": _with(CITIES, ASIA, EQ_BRONZE, EQ_SILVER, TS_BRONZE, TS_SILVER, TS_ASIA, HITS)
    + """SELECT 'top_tsunami' AS dataset, Country, "Timestamp", CAST(Deaths AS DOUBLE) AS measure, CAST(NULL AS VARCHAR) AS title
FROM ts_asia WHERE Country IN (SELECT Country FROM top3)
UNION ALL
SELECT 'earthquake', country, time_stamp, magnitude, title FROM eq_silver WHERE country IN (SELECT Country FROM asia)""",
    "silver_by_year": _with(TS_BRONZE, TS_SILVER)
    + f"SELECT *, CAST(year(time_stamp) AS INTEGER) AS year FROM ts_silver WHERE year(time_stamp) = {Y1 + 1}",
    "event_correlation": _with(EQ_BRONZE)
    + f"""SELECT tsunami, count(*) AS events, {_round('avg(magnitude)', 6)} AS avg_magnitude,
       {_round('corr(magnitude, CAST(depth AS DOUBLE))', 6)} AS corr_magnitude_depth_km
FROM eq_bronze GROUP BY tsunami""",
    "interval_match": """SELECT e.user_id, count(*) AS first_events,
       CAST(sum(CASE WHEN EXISTS (
             SELECT 1 FROM events p
             WHERE p.user_id = e.user_id AND p.event_type = 'purchase'
               AND p.ts > e.ts AND p.ts <= e.ts + INTERVAL 24 HOUR) THEN 1 ELSE 0 END) AS BIGINT) AS followed
FROM events e WHERE e.event_type = 'error' GROUP BY e.user_id""",
    "quake_tsunami_match": _with(CITIES, ASIA, EQ_BRONZE, EQ_SILVER, TS_BRONZE, TS_SILVER, TS_ASIA)
    + """SELECT e.country AS Country, count(*) AS first_events,
       CAST(sum(CASE WHEN EXISTS (
             SELECT 1 FROM ts_asia t
             WHERE t.Country = e.country AND t."Timestamp" > e.time_stamp
               AND t."Timestamp" <= e.time_stamp + INTERVAL 24 HOUR) THEN 1 ELSE 0 END) AS BIGINT) AS followed
FROM eq_silver e GROUP BY e.country""",
    "quake_tsunami_near": _with(EQ_BRONZE, EQ_SILVER, TS_BRONZE, TS_SILVER, PLACES)
    + """, quakes AS (SELECT e.title, e.time_stamp AS t, p.lat, p.lon FROM eq_silver e JOIN places p ON e.title = 'order ' || p.o_orderkey),
waves AS (SELECT s.time_stamp AS t, p.wave_lat AS lat, p.wave_lon AS lon FROM ts_silver s JOIN places p ON s."Sr.no" = p.o_orderkey),
pairs AS (
  SELECT q.title, 2 * 6371.0088 * asin(least(1, sqrt(pow(sin(radians(w.lat - q.lat) / 2), 2)
         + cos(radians(q.lat)) * cos(radians(w.lat)) * pow(sin(radians(w.lon - q.lon) / 2), 2)))) AS km
  FROM quakes q JOIN waves w ON w.t > q.t AND w.t <= q.t + INTERVAL 48 HOUR),
near AS (SELECT title, count(*) AS tsunamis, min(km) AS km FROM pairs WHERE km <= 100 GROUP BY title)
SELECT q.title, coalesce(n.tsunamis, 0) AS tsunamis, round(n.km, 3) AS nearest_km FROM quakes q LEFT JOIN near n ON q.title = n.title""",
    "tsunami_last_quake": _with(EQ_BRONZE, EQ_SILVER, TS_BRONZE, TS_SILVER)
    + f""", waves AS (SELECT s."Sr.no" AS serial, {_norm_country('s."Country"')} AS country, s.time_stamp AS "at" FROM ts_silver s),
quakes AS (
  SELECT country, time_stamp, max(title) AS title, arg_max(magnitude, title) AS magnitude FROM eq_silver GROUP BY country, time_stamp)
SELECT w.serial, w.country, w."at", q.title AS quake, q.magnitude, q.time_stamp AS quake_at
FROM waves w ASOF LEFT JOIN quakes q ON w.country = q.country AND w."at" >= q.time_stamp""",
    "json_variant": """WITH lines AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity,
           CASE WHEN l_discount > 0.02 THEN l_discount END NULLS FIRST, l_partkey, l_suppkey, l_returnflag, l_linestatus) - 1 AS pos
  FROM lineitem WHERE l_orderkey % 17 <> 0)
SELECT l_orderkey, CAST(l_orderkey AS BIGINT) AS "order", CASE WHEN l_orderkey % 3 = 0 THEN 'no. ' || l_orderkey END AS note,
       CAST(pos AS INTEGER) AS lines_pos, CAST(l_linenumber AS BIGINT) AS lines_no, l_quantity AS lines_quantity,
       CASE WHEN l_discount > 0.02 THEN l_discount END AS lines_discount, l_returnflag AS lines_state_flag, l_linestatus AS lines_state_status,
       CAST(l_partkey AS BIGINT) AS lines_part, CAST(l_suppkey AS BIGINT) AS lines_supplier, false AS broken
FROM lines
UNION ALL BY NAME SELECT DISTINCT l_orderkey, true AS broken FROM lineitem WHERE l_orderkey % 17 = 0""",
    "json_explode": "SELECT l_orderkey, l_linenumber AS line FROM lineitem",
    "json_flatten": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
}
ORACLE_SQL["idle_time_incremental"] = ORACLE_SQL["idle_time"]
