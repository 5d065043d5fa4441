"""The registered queries written a second time, as plain SQL for DuckDB.

The statements are written from the meaning of each query, not generated from
the Spark plans, so that both can be compared.
"""

from __future__ import annotations

_ZONES = """
zones AS (
  SELECT CAST(CASE WHEN n_nationkey < 24 THEN n_nationkey + 1 ELSE 265 END AS BIGINT) AS locationid, r_name AS borough, n_name AS zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

_LINES = """
lines AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS fare,
         CAST(l_discount AS DECIMAL(4,2)) AS off,
         CAST(l_tax AS DECIMAL(4,2)) AS levy,
         CAST(c_nationkey + 1 AS INTEGER) AS pu,
         CAST(s_nationkey + 1 AS INTEGER) AS dz,
         CAST(epoch(l_shipdate) AS BIGINT) - CAST(epoch(o_orderdate) AS BIGINT) AS secs,
         CASE l_returnflag WHEN 'A' THEN 'yellow' WHEN 'N' THEN 'green' WHEN 'R' THEN 'fhvhv' END
           AS service
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey)"""

_LINE_TRIPS = _LINES + """,
trips AS (
  SELECT service AS service_type, o_orderdate AS pickup_datetime,
         l_shipdate AS dropoff_datetime, pu AS pu_location_id, dz AS do_location_id,
         l_quantity AS trip_distance, CAST(secs AS DOUBLE) AS trip_duration_sec,
         fare AS fare_amount, fare * off AS tip_amount,
         fare * CAST(1 - off AS DECIMAL(4,2)) * CAST(1 + levy AS DECIMAL(4,2)) AS total_amount,
         CASE WHEN service = 'fhvhv' THEN fare * CAST(0.75 AS DECIMAL(3,2)) END AS driver_pay
  FROM lines
  WHERE l_shipdate > o_orderdate AND l_quantity > 0 AND l_quantity <= 45
    AND pu BETWEEN 1 AND 25 AND dz BETWEEN 1 AND 25)"""

_EVENT_TRIPS = """
trips AS (
  SELECT CASE event_type WHEN 'click' THEN 'yellow' WHEN 'view' THEN 'green' ELSE 'fhvhv' END
           AS service_type,
         ts AS pickup_datetime,
         CAST((user_id % 5) * 6 + 1 AS INTEGER) AS pu_location_id,
         CAST(event_id % 25 + 1 AS INTEGER) AS do_location_id,
         CAST(event_id % 90 AS DOUBLE) / 2 AS trip_distance,
         CAST((event_id % 61) * 60 AS DOUBLE) AS trip_duration_sec,
         CAST(value AS DECIMAL(12,2)) AS fare_amount,
         CAST(value AS DECIMAL(12,2)) * CAST(0.10 AS DECIMAL(3,2)) AS tip_amount,
         CAST(value AS DECIMAL(12,2)) * CAST(1.10 AS DECIMAL(3,2)) AS total_amount
  FROM events)"""

_SHARED = """
  SELECT '{0}' AS service_type, o_orderdate AS pickup_datetime,
         l_shipdate AS dropoff_datetime, pu AS pu_location_id, dz AS do_location_id,
         {1} AS passenger_count, l_quantity AS trip_distance,
         CAST(secs AS DOUBLE) AS trip_duration_sec, l_extendedprice AS fare_amount,
         CAST(fare * off AS DOUBLE) AS tip_amount, CAST(0 AS DOUBLE) AS tolls_amount,
         {2} AS total_amount, CAST(0 AS DOUBLE) AS congestion_surcharge,
         {3} AS airport_fee, {4} AS payment_type, {5} AS driver_pay,
         {6} AS dispatching_base_num, {7} AS originating_base_num, {8} AS hvfhs_license_num
  FROM lines WHERE service = '{0}'"""

_NO_TEXT = ("CAST(NULL AS VARCHAR)",) * 3
_NO_DOUBLE = "CAST(NULL AS DOUBLE)"
_METERED = (
    "CAST(l_linenumber AS INTEGER)",
    "l_extendedprice + CAST(fare * levy AS DOUBLE)",
)
_ALIGNED = {
    "yellow": _SHARED.format(
        "yellow",
        *_METERED,
        "CAST(0 AS DOUBLE)",
        "CAST(l_linenumber % 6 AS INTEGER)",
        _NO_DOUBLE,
        *_NO_TEXT,
    ),
    "green": _SHARED.format(
        "green",
        *_METERED,
        _NO_DOUBLE,
        "CAST(l_linenumber % 6 AS INTEGER)",
        _NO_DOUBLE,
        *_NO_TEXT,
    ),
    "fhvhv": _SHARED.format(
        "fhvhv",
        "CAST(NULL AS INTEGER)",
        "l_extendedprice + CAST(fare * levy AS DOUBLE) + CAST(fare * off AS DOUBLE)",
        _NO_DOUBLE,
        "CAST(NULL AS INTEGER)",
        "CAST(fare * CAST(0.75 AS DECIMAL(3,2)) AS DOUBLE)",
        "'B' || CAST(l_suppkey AS VARCHAR)",
        "CASE WHEN l_linenumber <> 1 THEN 'B' || CAST(l_suppkey AS VARCHAR) END",
        "'HV' || CAST(l_partkey % 4 AS VARCHAR)",
    ),
}
_ALL_ALIGNED = _LINES + ",\naligned AS (" + "\n  UNION ALL".join(_ALIGNED.values()) + ")"

_VALID = """dropoff_datetime > pickup_datetime
    AND trip_duration_sec > 0 AND trip_duration_sec <= 86400000
    AND trip_distance > 0 AND trip_distance <= 45
    AND fare_amount >= 0 AND total_amount >= 0
    AND pu_location_id BETWEEN 1 AND 25 AND do_location_id BETWEEN 1 AND 25"""
_IN_MONTH = (
    "pickup_datetime >= TIMESTAMP '1998-05-01' AND pickup_datetime < TIMESTAMP '1998-06-01'"
)
_SILVER = _ALL_ALIGNED + f""",
silver AS (
  SELECT DISTINCT *, CAST(year(pickup_datetime) AS INTEGER) AS year,
         CAST(month(pickup_datetime) AS INTEGER) AS month
  FROM aligned WHERE {_VALID})"""

_EXACT = "CAST(sum(CAST({} AS DECIMAL(18,6))) AS DOUBLE)"
_REVENUE_OF = f"""
cells AS (
  SELECT service_type, borough, zone,
         CAST(isodow(pickup_datetime) AS INTEGER) AS jour_semaine,
         CAST(hour(pickup_datetime) AS INTEGER) AS heure,
         count(*) AS nb_courses,
         {_EXACT.format("total_amount")} AS revenu_total,
         {_EXACT.format("tip_amount")} AS tip_total,
         sum(trip_distance) AS distance_total,
         sum(trip_duration_sec) AS duree_total_sec,
         {_EXACT.format("total_amount")} / count(*) AS revenu_moyen,
         {_EXACT.format("total_amount")}
           / nullif(sum(trip_duration_sec) / CAST(60 AS DOUBLE), 0) AS revenu_par_min,
         {_EXACT.format("tip_amount")}
           / nullif({_EXACT.format("fare_amount")}, 0) * CAST(100 AS DOUBLE) AS tip_pct,
         sum(trip_distance) / count(*) AS distance_moyenne
  FROM {{}} LEFT JOIN zones ON pu_location_id = locationid
  WHERE total_amount > 0 AND trip_duration_sec > 0
  GROUP BY ALL)"""
_PUBLISHED = ",\nmart AS (SELECT * FROM cells WHERE nb_courses >= 5)"
_REVENUE_CELLS = _EVENT_TRIPS + "," + _ZONES + "," + _REVENUE_OF.format("trips")
_REVENUE = _REVENUE_CELLS + _PUBLISHED

_DEMAND_OF = """
mart AS (
  SELECT CAST(pickup_datetime AS DATE) AS date_course,
         CAST(hour(pickup_datetime) AS INTEGER) AS heure,
         CAST(isodow(pickup_datetime) AS INTEGER) AS jour_semaine,
         service_type, count(*) AS nb_courses,
         sum(trip_distance) / count(*) AS distance_moy,
         sum(trip_duration_sec) / count(*) AS duree_moy_sec,
         sum(trip_distance) / nullif(sum(trip_duration_sec) / CAST(3600 AS DOUBLE), 0)
           AS vitesse_moy_mph
  FROM {} WHERE trip_duration_sec > 0
  GROUP BY ALL HAVING count(*) >= 5)"""
_DEMAND = _EVENT_TRIPS + "," + _DEMAND_OF.format("trips")

_SERVICES_OF = f"""
base AS (
  SELECT service_type, borough, count(*) AS nb_courses,
         CAST(quantile_disc(total_amount, 0.5) AS DOUBLE) AS panier_median,
         {_EXACT.format("tip_amount")}
           / nullif({_EXACT.format("fare_amount")}, 0) * CAST(100 AS DOUBLE) AS tip_pct,
         CASE WHEN service_type = 'fhvhv' THEN {_EXACT.format("driver_pay")}
           / nullif({_EXACT.format("total_amount")}, 0) * CAST(100 AS DOUBLE) END
           AS driver_share_pct
  FROM {{}} LEFT JOIN zones ON pu_location_id = locationid
  WHERE total_amount > 0
  GROUP BY service_type, borough HAVING count(*) >= 5),
mart AS (
  SELECT service_type, borough, nb_courses,
         CAST(nb_courses AS DOUBLE) * CAST(100 AS DOUBLE)
           / CAST(sum(nb_courses) OVER (PARTITION BY borough) AS DOUBLE) AS part_marche_pct,
         panier_median, tip_pct, driver_share_pct
  FROM base)"""
_SERVICES = _LINE_TRIPS + "," + _ZONES + "," + _SERVICES_OF.format("trips")

_OD_OF = f"""
mart AS (
  SELECT p.borough AS pu_borough, d.borough AS do_borough, service_type,
         count(*) AS nb_courses, sum(trip_distance) / count(*) AS distance_moy,
         {_EXACT.format("total_amount")} / count(*) AS revenu_moy
  FROM {{}} LEFT JOIN zones p ON pu_location_id = p.locationid
          LEFT JOIN zones d ON do_location_id = d.locationid
  WHERE total_amount > 0
  GROUP BY p.borough, d.borough, service_type HAVING count(*) >= 5)"""
_OD = _LINE_TRIPS + "," + _ZONES + "," + _OD_OF.format("trips")

_MONTHS = """
months AS (
  SELECT dataset, CAST(day AS DATE) AS day, strftime(day, '%Y-%m') AS period
  FROM (SELECT DISTINCT date_trunc('month', o_orderdate) AS day FROM orders),
       (VALUES ('yellow'), ('green'), ('fhvhv')) AS d(dataset))"""
_STATE = _MONTHS + """,
state AS (
  SELECT dataset, period, 'DONE' AS bronze_status,
         CASE WHEN period = '1998-04' AND dataset = 'yellow' THEN 'skipped'
              ELSE 'ingested' END AS bronze_detail,
         CASE WHEN period < '1998-05' THEN 'DONE'
              WHEN dataset = 'green' THEN 'FAILED' ELSE 'PENDING' END AS silver_status,
         CAST(day AS TIMESTAMP) + CASE WHEN period = '1998-04' AND dataset = 'yellow'
              THEN INTERVAL 42 DAY ELSE INTERVAL 40 DAY END AS bronze_done_at,
         CASE WHEN period = '1998-04' AND dataset = 'yellow'
                THEN CAST(day AS TIMESTAMP) + INTERVAL 43 DAY
              WHEN period < '1998-05' OR dataset = 'green'
                THEN CAST(day AS TIMESTAMP) + INTERVAL 41 DAY END AS silver_done_at
  FROM months WHERE period <= '1998-05')"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def _rules(source: str) -> str:
    """The nine rules over one relation, as (rule, actual, outcome)."""
    violations = (
        ('IsComplete "service_type"', "service_type IS NOT NULL"),
        ('IsComplete "pickup_datetime"', "pickup_datetime IS NOT NULL"),
        ('IsComplete "pu_location_id"', "pu_location_id IS NOT NULL"),
        ('ColumnValues "trip_distance" > 0', "trip_distance > 0"),
        (
            'ColumnValues "trip_duration_sec" between 0 and 86400001',
            "trip_duration_sec > 0 AND trip_duration_sec < 86400001",
        ),
        ('ColumnValues "total_amount" >= 0', "total_amount >= 0"),
        (
            'ColumnValues "pu_location_id" between 0 and 26',
            "pu_location_id > 0 AND pu_location_id < 26",
        ),
    )
    lines = [
        f"SELECT 'RowCount > 0' AS rule, CAST(count(*) AS DOUBLE) AS actual, "
        f"count(*) > 0 AS ok FROM {source}"
    ]
    for label, good in violations:
        bad = f"count(*) FILTER (WHERE NOT coalesce({good}, false))"
        lines.append(
            f"SELECT '{label}', CAST({bad} AS DOUBLE), {bad} = 0 FROM {source}"
        )
    share = "CAST(count(fare_amount) AS DOUBLE) / nullif(count(*), 0)"
    lines.append(
        f"SELECT 'Completeness \"fare_amount\" > 0.95', {share}, {share} > 0.95 FROM {source}"
    )
    return "\nUNION ALL ".join(lines)


_RULE_ROWS = "SELECT rule, actual, CASE WHEN ok THEN 'Passed' ELSE 'Failed' END AS outcome"


_PREDICATES = (
    ("pickup_datetime_present", "pickup_datetime IS NOT NULL"),
    ("dropoff_datetime_present", "dropoff_datetime IS NOT NULL"),
    ("trip_distance_present", "trip_distance IS NOT NULL"),
    ("trip_duration_sec_present", "trip_duration_sec IS NOT NULL"),
    ("total_amount_present", "total_amount IS NOT NULL"),
    ("pu_location_id_present", "pu_location_id IS NOT NULL"),
    ("do_location_id_present", "do_location_id IS NOT NULL"),
    ("pickup_in_period", _IN_MONTH),
    ("chronology", "dropoff_datetime > pickup_datetime"),
    ("duration_range", "trip_duration_sec > 0 AND trip_duration_sec <= 86400000"),
    ("distance_range", "trip_distance > 0 AND trip_distance <= 45"),
    ("fare_amount_not_negative", "fare_amount >= 0"),
    ("total_amount_not_negative", "total_amount >= 0"),
    ("pu_location_id_known", "pu_location_id BETWEEN 1 AND 25"),
    ("do_location_id_known", "do_location_id BETWEEN 1 AND 25"),
)


def _rejects() -> str:
    lines = [
        "SELECT 'rows_read' AS predicate, count(*) AS nb_rows FROM aligned",
        f"SELECT 'rows_kept', count(*) FROM aligned WHERE {_VALID} AND {_IN_MONTH}",
    ]
    lines += [
        f"SELECT '{name}', count(*) FILTER (WHERE NOT coalesce({good}, false)) FROM aligned"
        for name, good in _PREDICATES
    ]
    return "\nUNION ALL ".join(lines)


def _reject_history() -> str:
    """Rows read, kept and breaking each predicate, per service and month of pickup."""
    by_month = "service_type, strftime(pickup_datetime, '%Y-%m') AS period"
    lines = [
        f"SELECT {by_month}, 'rows_read' AS predicate, count(*) AS nb_rows FROM aligned GROUP BY ALL",
        f"SELECT {by_month}, 'rows_kept', count(*) FILTER (WHERE coalesce({_VALID}, false)) FROM aligned GROUP BY ALL",
    ]
    lines += [
        f"SELECT {by_month}, '{name}', count(*) FILTER (WHERE NOT coalesce({good}, false)) FROM aligned GROUP BY ALL"
        for name, good in _PREDICATES
        if name != "pickup_in_period"
    ]
    return "\nUNION ALL ".join(lines)


_CANON = """service_type, pickup_datetime, dropoff_datetime, pu_location_id, do_location_id,
  passenger_count, trip_distance, trip_duration_sec, fare_amount, tip_amount, tolls_amount,
  total_amount, congestion_surcharge, airport_fee, payment_type, driver_pay,
  dispatching_base_num, originating_base_num, hvfhs_license_num"""

_SERVED_REVENUE = """
SELECT service_type, borough, zone, jour_semaine, heure, nb_courses, revenu_total,
       revenu_moyen, revenu_par_min, tip_pct, distance_moyenne
FROM mart {}
ORDER BY revenu_total DESC NULLS LAST, service_type NULLS LAST, borough NULLS LAST,
         zone NULLS LAST, jour_semaine NULLS LAST, heure NULLS LAST LIMIT 100"""
_SERVED_DEMAND = """
SELECT * FROM mart {}
ORDER BY date_course NULLS LAST, heure NULLS LAST, service_type NULLS LAST LIMIT 500"""
_SERVED_SERVICES = """
SELECT * FROM mart {}
ORDER BY nb_courses DESC, service_type NULLS LAST, borough NULLS LAST"""
_SERVED_OD = """
SELECT * FROM mart {}
ORDER BY nb_courses DESC, pu_borough NULLS LAST, do_borough NULLS LAST,
         service_type NULLS LAST LIMIT 200"""

_PSEUDONYM = (
    "CASE WHEN {0} IS NOT NULL THEN sha256('sample-pepper' || '§' || {0}) END AS {0}"
)

_NEXT = """
SELECT d.dataset,
       CASE WHEN candidate <= last THEN strftime(candidate, '%Y-%m') END AS period,
       CAST(CASE WHEN candidate <= last THEN year(candidate) END AS INTEGER) AS year,
       CAST(CASE WHEN candidate <= last THEN month(candidate) END AS INTEGER) AS month,
       candidate <= last AS "hasWork"
FROM (SELECT m.dataset,
             coalesce(CAST(CAST(max(s.period) || '-01' AS DATE) + INTERVAL 1 MONTH AS DATE),
                      DATE '1995-01-01') AS candidate,
             DATE '{}' AS last
      FROM (SELECT DISTINCT dataset FROM months) m
      LEFT JOIN state s ON s.dataset = m.dataset AND s.silver_status = 'DONE'
      GROUP BY m.dataset) d"""

ORACLE: dict[str, str] = {
    "align_yellow": _with(_LINES, _ALIGNED["yellow"]),
    "align_green": _with(_LINES, _ALIGNED["green"]),
    "align_fhvhv": _with(_LINES, _ALIGNED["fhvhv"]),
    "union_trips": _with(
        _ALL_ALIGNED,
        """SELECT service_type, pickup_datetime, dropoff_datetime, pu_location_id,
  do_location_id, trip_distance, trip_duration_sec, fare_amount, tip_amount, total_amount,
  driver_pay, payment_type, CAST(year(pickup_datetime) AS INTEGER) AS year,
  CAST(month(pickup_datetime) AS INTEGER) AS month FROM aligned""",
    ),
    "clean_period": _with(
        _ALL_ALIGNED, f"SELECT * FROM aligned WHERE {_VALID} AND {_IN_MONTH}"
    ),
    "clean_dedup": _with(_ALL_ALIGNED, f"SELECT DISTINCT {_CANON} FROM aligned WHERE {_VALID}"),
    "clean_rejects": _with(_ALL_ALIGNED, _rejects()),
    "pseudonyms": _with(
        _LINES + ",\naligned AS (" + _ALIGNED["fhvhv"] + ")",
        "SELECT pickup_datetime, pu_location_id, do_location_id, "
        + ", ".join(
            _PSEUDONYM.format(c)
            for c in ("dispatching_base_num", "originating_base_num", "hvfhs_license_num")
        )
        + " FROM aligned",
    ),
    "quality_rules": _with(
        _SILVER + f",\nchecked AS (SELECT * FROM silver WHERE {_IN_MONTH})",
        f"{_RULE_ROWS} FROM ({_rules('checked')})",
    ),
    "quality_before_clean": _with(_ALL_ALIGNED, f"{_RULE_ROWS} FROM ({_rules('aligned')})"),
    "quality_failures": _with(
        _ALL_ALIGNED,
        f"SELECT count(*) FILTER (WHERE NOT coalesce(ok, false)) AS nb_failed "
        f"FROM ({_rules('aligned')})",
    ),
    "silver_partitions": _with(
        _SILVER,
        """SELECT service_type, year, month, count(*) AS nb_courses,
  sum(trip_distance) AS distance_total, count(originating_base_num) AS nb_pseudonyms
FROM silver GROUP BY service_type, year, month""",
    ),
    "dynamic_overwrite": _with(
        _SILVER,
        """SELECT service_type, year, month, count(*) AS nb_courses,
  sum(trip_distance + CASE WHEN year = 1998 AND month = 5 THEN 100 ELSE 0 END)
    AS distance_total
FROM silver GROUP BY service_type, year, month""",
    ),
    "unified_view": _with(
        _SILVER,
        """SELECT service_type, year, payment_type, count(*) AS nb_courses,
  sum(trip_duration_sec) AS duree_total_sec
FROM silver GROUP BY service_type, year, payment_type""",
    ),
    "unified_branches": _with(
        _SILVER,
        """SELECT service_type, year, count(*) AS nb_courses,
  sum(trip_distance) AS distance_total FROM silver GROUP BY service_type, year""",
    ),
    "catalog_tables": _with(
        _SILVER,
        """SELECT service_type, year, month, count(*) AS nb_courses, sum(trip_distance) AS distance_total
FROM silver GROUP BY service_type, year, month""",
    ),
    "raw_schema_drift": _with(
        _LINES,
        """SELECT service AS service_type, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS nb_courses,
  CAST(sum(CASE WHEN service <> 'fhvhv' THEN l_linenumber END) AS BIGINT) AS passengers,
  count(*) FILTER (service = 'yellow') AS nb_airport_fee
FROM lines GROUP BY ALL""",
    ),
    "backfill_od_matrix": _with(_SILVER + "," + _ZONES + "," + _OD_OF.format("silver"), "SELECT * FROM mart"),
    "silver_revenue_zone_hour": _with(
        _SILVER + "," + _ZONES + "," + _REVENUE_OF.format("silver") + _PUBLISHED, "SELECT * FROM mart"
    ),
    "silver_service_comparison": _with(_SILVER + "," + _ZONES + "," + _SERVICES_OF.format("silver"), "SELECT * FROM mart"),
    "silver_demand": _with(_SILVER + "," + _DEMAND_OF.format("silver"), "SELECT * FROM mart"),
    "raw_manifest_prune": _with(
        _ALL_ALIGNED
        + """,
delivered AS (
  SELECT service, o_orderdate AS pickup, date_trunc('month', o_orderdate)
    + CASE WHEN l_quantity % 4 = 0 THEN INTERVAL 12 MONTH ELSE INTERVAL 0 MONTH END AS folder FROM lines),
files AS (SELECT service, folder, min(pickup) AS first, max(pickup) AS last FROM delivered GROUP BY ALL),
counted AS (
  SELECT service AS dataset, count(*) AS nb_files,
    count(*) FILTER (last >= TIMESTAMP '1998-05-01' AND first < TIMESTAMP '1998-06-01') AS nb_read
  FROM files GROUP BY service)""",
        f"""SELECT dataset, nb_files, nb_read, count(service_type) AS nb_courses, sum(trip_distance) AS distance_total
FROM counted LEFT JOIN (SELECT * FROM aligned WHERE {_VALID} AND {_IN_MONTH}) ON dataset = service_type
GROUP BY dataset, nb_files, nb_read""",
    ),
    "versioned_overwrite": _with(
        _SILVER,
        """SELECT service_type, year, month, count(*) AS nb_courses, sum(trip_distance) AS distance_total, 'first' AS state
FROM silver GROUP BY service_type, year, month
UNION ALL
SELECT service_type, year, month, count(*),
  sum(trip_distance + CASE WHEN year = 1998 AND month = 5 THEN 100 ELSE 0 END), 'now'
FROM silver WHERE NOT (year = 1997 AND month = 12) GROUP BY service_type, year, month""",
    ),
    "mart_republish": _with(
        _LINE_TRIPS + "," + _ZONES + "," + _OD_OF.format("trips"),
        """SELECT *, CAST(2 AS INTEGER) AS build FROM mart
UNION ALL SELECT *, CAST(1 AS INTEGER) FROM mart WHERE service_type <> 'green'""",
    ),
    "forced_files": _with(
        _SILVER,
        f"""SELECT service_type, CAST(least(3, count(*)) AS BIGINT) AS nb_files, count(*) AS nb_courses
FROM silver WHERE {_IN_MONTH} GROUP BY service_type""",
    ),
    "compacted_files": _with(
        _SILVER,
        """SELECT service_type, year, month, CAST(1 AS BIGINT) AS nb_files, count(*) AS nb_courses,
  sum(trip_distance) AS distance_total
FROM silver GROUP BY service_type, year, month""",
    ),
    "backfill_gate_by_month": _with(
        _SILVER
        + """,
months AS (
  SELECT s AS service_type, CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month
  FROM (VALUES ('yellow'), ('green'), ('fhvhv')) AS v(s), range(1997, 1999) AS a(y), range(1, 13) AS b(m)),
measured AS (
  SELECT m.service_type, m.year, m.month, count(t.service_type) AS n,
    count(t.service_type) FILTER (NOT t.trip_distance > 0) AS bad, count(t.payment_type) AS paid
  FROM months m LEFT JOIN silver t USING (service_type, year, month) GROUP BY ALL),
rules AS (
  SELECT service_type, year, month, n, 'RowCount > 0' AS rule, CAST(n AS DOUBLE) AS actual, n > 0 AS ok FROM measured
  UNION ALL SELECT service_type, year, month, n, 'ColumnValues "trip_distance" > 0', CAST(bad AS DOUBLE), bad = 0 FROM measured
  UNION ALL SELECT service_type, year, month, n, 'Completeness "payment_type" > 0.95', CAST(paid AS DOUBLE) / nullif(n, 0),
    coalesce(CAST(paid AS DOUBLE) / nullif(n, 0) > 0.95, false) FROM measured)""",
        """SELECT service_type, year, month, rule, actual, CASE WHEN ok THEN 'Passed' ELSE 'Failed' END AS outcome,
  CASE WHEN bool_and(ok) OVER (PARTITION BY service_type, year, month) THEN n END AS nb_courses
FROM rules""",
    ),
    "quality_history": _with(
        _ALL_ALIGNED + f",\nhistory AS ({_reject_history()})",
        """SELECT service_type, period, predicate, nb_rows, usual,
  CASE WHEN coalesce(nb_rows >= usual * CAST(0.9 AS DOUBLE), true) THEN 'Passed' ELSE 'Failed' END AS outcome
FROM (SELECT *, CAST(median(nb_rows) OVER (PARTITION BY service_type, predicate ORDER BY period
        ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS DOUBLE) AS usual FROM history)""",
    ),
    "land_twice": _with(
        _LINES
        + """,
sources AS (
  SELECT service AS dataset, CASE month(o_orderdate) % 2 WHEN 0 THEN '1998-04' ELSE '1998-05' END AS period,
    count(*) AS n FROM lines GROUP BY ALL),
landed AS (
  SELECT dataset, period, CASE WHEN dataset = 'green' AND period = '1998-05'
    THEN (SELECT count(*) FROM lines WHERE service = 'green' AND l_quantity <= 10) ELSE n END AS nb_rows
  FROM sources)""",
        """SELECT CAST(turn AS INTEGER) AS turn, dataset, period,
  CASE WHEN turn = 1 OR turn = 4 AND dataset = 'green' AND period = '1998-05' THEN 'ingested' ELSE 'skipped' END AS detail,
  turn = 3 AND dataset = 'green' AND period = '1998-05' AS changed, nb_rows
FROM landed, range(1, 5) AS t(turn)""",
    ),
    "pipeline_run": _with(
        _SILVER
        + """,
built AS (SELECT * FROM silver WHERE pickup_datetime >= TIMESTAMP '1998-04-01' AND pickup_datetime < TIMESTAMP '1998-07-01'),"""
        + _ZONES
        + ","
        + _OD_OF.format("built"),
        "SELECT * FROM mart",
    ),
    "zones_csv": _with(_ZONES, "SELECT * FROM zones"),
    "marts_from_config": _with(
        _LINE_TRIPS
        + ","
        + _ZONES
        + ","
        + _OD_OF.format("trips").replace("mart AS", "od AS")
        + ","
        + _SERVICES_OF.format("trips"),
        """SELECT 'od_matrix' AS mart, count(*) AS nb_cells, CAST(sum(nb_courses) AS BIGINT) AS nb_courses FROM od
UNION ALL SELECT 'service_comparison', count(*), CAST(sum(nb_courses) AS BIGINT) FROM mart""",
    ),
    "mart_revenue_zone_hour": _with(_REVENUE, "SELECT * FROM mart"),
    "mart_service_comparison": _with(_SERVICES, "SELECT * FROM mart"),
    "mart_demand": _with(_DEMAND, "SELECT * FROM mart"),
    "mart_od_matrix": _with(_OD, "SELECT * FROM mart"),
    "parts_revenue_zone_hour": _with(_REVENUE, "SELECT * FROM mart"),
    "parts_service_comparison": _with(_SERVICES, "SELECT * FROM mart"),
    "parts_demand": _with(_DEMAND, "SELECT * FROM mart"),
    "parts_od_matrix": _with(_OD, "SELECT * FROM mart"),
    "k_suppressed_cells": _with(
        _REVENUE_CELLS,
        """SELECT service_type, count(*) AS nb_cells,
  CAST(sum(nb_courses) AS BIGINT) AS nb_courses
FROM cells WHERE nb_courses < 5 GROUP BY service_type""",
    ),
    "mart_rollup": _with(
        _REVENUE,
        """SELECT service_type, borough, heure, CAST(n AS BIGINT) AS nb_courses,
  CAST(revenu AS DOUBLE) AS revenu_total, CAST(tips AS DOUBLE) AS tip_total,
  distance_total, duree_total_sec, CAST(revenu AS DOUBLE) / n AS revenu_moyen,
  CAST(revenu AS DOUBLE) / nullif(duree_total_sec / CAST(60 AS DOUBLE), 0) AS revenu_par_min,
  distance_total / n AS distance_moyenne
FROM (SELECT service_type, borough, heure, CAST(sum(nb_courses) AS DOUBLE) AS n,
             sum(CAST(revenu_total AS DECIMAL(18,4))) AS revenu,
             sum(CAST(tip_total AS DECIMAL(18,4))) AS tips,
             sum(distance_total) AS distance_total, sum(duree_total_sec) AS duree_total_sec
      FROM mart GROUP BY service_type, borough, heure)""",
    ),
    "zone_left_unmapped": _with(
        _LINE_TRIPS + "," + _ZONES,
        """SELECT service_type, borough, count(*) AS nb_courses
FROM trips LEFT JOIN zones ON pu_location_id = locationid GROUP BY service_type, borough""",
    ),
    "registry_state": _with(_STATE, "SELECT * FROM state"),
    "last_done": _with(
        _STATE,
        """SELECT dataset, max(period) FILTER (WHERE silver_status = 'DONE') AS last_done
FROM state GROUP BY dataset""",
    ),
    "next_period": _with(_STATE, _NEXT.format("1998-07-01")),
    "next_period_none": _with(_STATE, _NEXT.format("1997-07-01")),
    "next_period_gap": _with(
        _STATE,
        """SELECT d.dataset, strftime(f, '%Y-%m') AS period, CAST(year(f) AS INTEGER) AS year,
  CAST(month(f) AS INTEGER) AS month, f IS NOT NULL AS "hasWork"
FROM (SELECT dataset, (
        SELECT min(m.day) FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '1998-07-01', INTERVAL 1 MONTH)) AS day) m
        WHERE NOT EXISTS (
          SELECT 1 FROM state s WHERE s.silver_status = 'DONE' AND s.dataset = x.dataset
            AND s.period = strftime(m.day, '%Y-%m')
            AND NOT (s.dataset = 'yellow' AND s.period = '1996-03')
            AND NOT (s.dataset = 'fhvhv' AND s.period IN ('1997-11', '1997-12')))) AS f
      FROM (SELECT DISTINCT dataset FROM months) x) d""",
    ),
    "registry_compacted": _with(_STATE, "SELECT * FROM state"),
    "backlog": _with(
        _STATE,
        """SELECT d.dataset, strftime(m.day, '%Y-%m') AS period,
  CAST(year(m.day) AS INTEGER) AS year, CAST(month(m.day) AS INTEGER) AS month
FROM (SELECT DISTINCT dataset FROM months) d,
     (SELECT unnest(generate_series(DATE '1995-01-01', DATE '1998-07-01', INTERVAL 1 MONTH))
        AS day) m
WHERE NOT EXISTS (SELECT 1 FROM state s WHERE s.silver_status = 'DONE'
                  AND s.dataset = d.dataset AND s.period = strftime(m.day, '%Y-%m'))""",
    ),
    "landing_plan": _with(
        _STATE,
        """SELECT dataset, period FROM months m
WHERE NOT EXISTS (SELECT 1 FROM state s WHERE s.bronze_status = 'DONE'
                  AND s.dataset = m.dataset AND s.period = m.period)""",
    ),
    "landing_paths": _with(
        _MONTHS,
        """SELECT dataset, period, CAST(year(day) AS INTEGER) AS year,
  CAST(month(day) AS INTEGER) AS month,
  '/landing/' || dataset || '_tripdata_' || period || '.parquet' AS source_file,
  dataset || '/year=' || strftime(day, '%Y') || '/month=' || strftime(day, '%m')
    AS landing_folder
FROM months""",
    ),
    "serve_revenue": _with(_REVENUE, _SERVED_REVENUE.format("")),
    "serve_revenue_filtered": _with(
        _REVENUE, _SERVED_REVENUE.format("WHERE heure = 8 AND service_type = 'fhvhv'")
    ),
    "serve_demand": _with(_DEMAND, _SERVED_DEMAND.format("")),
    "serve_demand_filtered": _with(
        _DEMAND,
        _SERVED_DEMAND.format(
            "WHERE service_type = 'fhvhv' AND date_course = DATE '2024-01-15'"
        ),
    ),
    "serve_services": _with(_SERVICES, _SERVED_SERVICES.format("")),
    "serve_services_filtered": _with(
        _SERVICES, _SERVED_SERVICES.format("WHERE borough = 'ASIA'")
    ),
    "serve_od": _with(_OD, _SERVED_OD.format("")),
    "serve_od_filtered": _with(
        _OD, _SERVED_OD.format("WHERE pu_borough = 'EUROPE' AND service_type = 'green'")
    ),
    "check_zone_revenue": _with(
        _REVENUE,
        """SELECT zone, service_type, CAST(sum(CAST(revenu_total AS DECIMAL(18,6))) AS DOUBLE) AS revenu
FROM mart WHERE zone = 'NATION_6' GROUP BY zone, service_type""",
    ),
    "check_hours": _with(
        _REVENUE,
        """SELECT heure, count(*) AS nb_lignes, CAST(sum(nb_courses) AS BIGINT) AS courses
FROM mart WHERE zone IN ('NATION_6', 'NATION_12') GROUP BY heure""",
    ),
    "check_zones": _with(_ZONES, "SELECT * FROM zones ORDER BY locationid LIMIT 10"),
}
