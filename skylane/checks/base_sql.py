"""Shared DuckDB CTE text: the flight-shaped views and the cleaning chain.

Each oracle query is self-contained: it starts with ``WITH`` and these CTEs.
"""

FLIGHTS = """
flights AS (
  SELECT
    md5(concat_ws('|', cast(l_orderkey as varchar), cast(l_partkey as varchar), cast(l_suppkey as varchar),
        cast(l_linenumber as varchar), cast(l_quantity as varchar),
        cast(cast(round(l_extendedprice * 100) as bigint) as varchar))) AS ROW_ID,
    cast(year(l_shipdate) as integer) AS YEAR, cast(month(l_shipdate) as integer) AS MONTH,
    cast(day(l_shipdate) as integer) AS DAY,
    cast(isodow(l_shipdate) as integer) AS DAY_OF_WEEK,
    c_mktsegment AS AIRLINE,
    l_partkey AS FLIGHT_NUMBER,
    concat('T', cast(l_suppkey as varchar)) AS TAIL_NUMBER,
    concat('N', cast(s_nationkey as varchar)) AS ORIGIN_AIRPORT,
    concat('N', cast(c_nationkey as varchar)) AS DESTINATION_AIRPORT,
    (l_orderkey % 24) * 100 + (l_partkey % 60) AS SCHEDULED_DEPARTURE,
    ((l_orderkey + l_linenumber) % 24) * 100 + (l_suppkey % 60) AS SCHEDULED_ARRIVAL,
    30 + l_quantity * 8 AS SCHEDULED_TIME,
    l_extendedprice / 40 AS DISTANCE,
    cast((l_orderkey * 7 + l_partkey * 3) % 60 - 20 as double) AS DEPARTURE_DELAY,
    cast(5 + l_linenumber * 3 as double) AS TAXI_OUT,
    cast((l_orderkey % 24) * 100 + (l_suppkey % 60) as double) AS WHEELS_OFF,
    CASE WHEN l_quantity <= 2 OR (l_linenumber = 7 AND l_quantity = 50) THEN NULL
         ELSE cast((l_orderkey * 7 + l_partkey * 3) % 60 - 20 as double)
              + l_linenumber * 2 - l_discount * 100 - 10 END AS ARRIVAL_DELAY,
    CASE WHEN l_quantity = 1 THEN 1 ELSE 0 END AS CANCELLED,
    CASE WHEN l_quantity = 2 THEN 1 ELSE 0 END AS DIVERTED,
    CASE WHEN l_quantity = 1 THEN 'A' END AS CANCELLATION_REASON,
    CASE WHEN l_tax = 0.08 THEN l_tax * 100 END AS AIR_SYSTEM_DELAY,
    CASE WHEN l_tax = 0.08 THEN l_tax * 100 END AS SECURITY_DELAY,
    CASE WHEN l_tax = 0.08 THEN l_tax * 100 END AS AIRLINE_DELAY,
    CASE WHEN l_tax = 0.08 THEN l_tax * 100 END AS LATE_AIRCRAFT_DELAY,
    CASE WHEN l_tax = 0.08 THEN l_tax * 100 END AS WEATHER_DELAY,
    cast(l_orderkey % 2400 as double) AS DEPARTURE_TIME,
    cast(l_partkey % 2400 as double) AS ARRIVAL_TIME,
    cast(l_suppkey % 2400 as double) AS WHEELS_ON,
    l_quantity * 7 AS AIR_TIME,
    l_quantity * 8 AS ELAPSED_TIME,
    cast(l_linenumber as double) AS TAXI_IN
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

AIRPORTS = """
airports AS (
  SELECT
    concat('N', cast(n_nationkey as varchar)) AS IATA_CODE,
    n_name AS AIRPORT,
    CASE WHEN n_nationkey = 23 THEN NULL ELSE 20 + n_nationkey * cast(1.25 as double) END AS LATITUDE,
    CASE WHEN n_nationkey = 23 THEN NULL ELSE -150 + n_nationkey * cast(3.5 as double) END AS LONGITUDE
  FROM nation
  WHERE n_nationkey <> 24
)"""

# Cleaning chain M17 (P1 -> P2 -> F1 -> X8 -> J1 -> F2 -> P3 -> F3(1 sigma) -> F6).
CLEANED = """
eligible AS (
  SELECT f.ROW_ID, f.DAY_OF_WEEK, f.AIRLINE, f.FLIGHT_NUMBER, f.TAIL_NUMBER, f.SCHEDULED_DEPARTURE,
         f.DEPARTURE_DELAY, f.TAXI_OUT, f.WHEELS_OFF, f.SCHEDULED_TIME, f.DISTANCE, f.SCHEDULED_ARRIVAL,
         f.ARRIVAL_DELAY,
         cast(dayofyear(make_date(f.YEAR, f.MONTH, f.DAY)) as integer) AS DAY_OF_YEAR,
         o.LATITUDE AS ORIGIN_AIRPORT_LATITUDE, o.LONGITUDE AS ORIGIN_AIRPORT_LONGITUDE,
         d.LATITUDE AS DESTINATION_AIRPORT_LATITUDE, d.LONGITUDE AS DESTINATION_AIRPORT_LONGITUDE
  FROM flights f
  LEFT JOIN airports o ON f.ORIGIN_AIRPORT = o.IATA_CODE
  LEFT JOIN airports d ON f.DESTINATION_AIRPORT = d.IATA_CODE
  WHERE f.CANCELLED = 0 AND f.DIVERTED = 0
),
qbounds AS (SELECT min(ARRIVAL_DELAY) AS lo, max(ARRIVAL_DELAY) AS hi FROM eligible),
in_range AS (
  SELECT e.* EXCLUDE (TAIL_NUMBER) FROM eligible e, qbounds
  WHERE e.ARRIVAL_DELAY >= qbounds.lo AND e.ARRIVAL_DELAY <= qbounds.hi AND e.ARRIVAL_DELAY IS NOT NULL
),
sbounds AS (
  SELECT avg(ARRIVAL_DELAY) - 1 * stddev_samp(ARRIVAL_DELAY) AS lo,
         avg(ARRIVAL_DELAY) + 1 * stddev_samp(ARRIVAL_DELAY) AS hi FROM in_range
),
cleaned AS (
  SELECT r.* FROM in_range r, sbounds
  WHERE r.ARRIVAL_DELAY >= sbounds.lo AND r.ARRIVAL_DELAY <= sbounds.hi
    AND COLUMNS(*) IS NOT NULL
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


BASE = with_ctes(FLIGHTS, AIRPORTS)
CLEAN = with_ctes(FLIGHTS, AIRPORTS, CLEANED)
