"""DuckDB SQL, one statement per registered query, written independently of the
Spark code: plain window functions and brute-force joins instead of bucketed
helpers and merged moments.
"""

from __future__ import annotations

from .base_sql import AIRPORTS, CLEANED, FLIGHTS, with_ctes

KEEP = [
    "DEPARTURE_DELAY", "TAXI_OUT", "WHEELS_OFF", "ORIGIN_AIRPORT_LATITUDE", "ORIGIN_AIRPORT_LONGITUDE",
    "DESTINATION_AIRPORT_LATITUDE", "DESTINATION_AIRPORT_LONGITUDE", "DAY_OF_YEAR_SIN", "DAY_OF_YEAR_COS",
    "SCHEDULED_DEPARTURE_SIN", "SCHEDULED_ARRIVAL_SIN", "SCHEDULED_ARRIVAL_COS", "DISTANCE_NORMALIZED",
    "SCHEDULED_TIME_NORMALIZED", "FLIGHT_NUMBER_FREQ",
]
GRID = [1e-9, 1e-8, 1e-7, 1e-6, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1]


# Fixed values above: stored feature order and smoothing grid.


def fold_of(k: int = 5) -> str:
    """Contiguous ranges of the hash order: ranks from f * n // k on are in fold f or later."""
    return "(" + " + ".join(f"cast(_fr >= ({f} * _fn) // {k} as integer)" for f in range(1, k)) + ")"


def folded_cte(src: str) -> str:
    return (f"folded AS (SELECT * EXCLUDE (_fr, _fn), {fold_of()} AS FOLD FROM (SELECT *, row_number() OVER "
            f"(ORDER BY md5('42|fold|' || ROW_ID), ROW_ID) - 1 AS _fr, count(*) OVER () AS _fn FROM {src}))")


def R(x: str) -> str:
    return f"(round({x}, 6) + 0.0)"


def minutes(x: str) -> str:
    return f"(floor({x} / 100) * 60 + ((({x}) % 100) + 100) % 100)"


SQL: dict[str, str] = {}

B = with_ctes(FLIGHTS, AIRPORTS)
C = with_ctes(FLIGHTS, AIRPORTS, CLEANED)

LABELLED = """
labelled AS (SELECT * REPLACE (CASE WHEN ARRIVAL_DELAY >= 15 THEN 1 ELSE 0 END AS ARRIVAL_DELAY) FROM cleaned),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY ARRIVAL_DELAY ORDER BY md5('42|' || ROW_ID), ROW_ID) - 1 AS _r,
         count(*) OVER (PARTITION BY ARRIVAL_DELAY) AS _n
  FROM labelled),
splitted AS (SELECT * EXCLUDE (_r, _n), CASE WHEN _r < round(0.3::double * _n) THEN 1 ELSE 0 END AS IS_TEST FROM ranked),
train_raw AS (SELECT * EXCLUDE (IS_TEST) FROM splitted WHERE IS_TEST = 0),
test_raw AS (SELECT * EXCLUDE (IS_TEST) FROM splitted WHERE IS_TEST = 1)"""

L = with_ctes(FLIGHTS, AIRPORTS, CLEANED, LABELLED)


def features_cte(name: str, src: str, fit: str) -> str:
    """M16 (whitelisted columns) for rows ``src`` with statistics fitted on ``fit``."""
    return f"""
{name}_st AS (SELECT avg(DISTANCE) AS d_mu, stddev_pop(DISTANCE) AS d_sd,
                     avg(SCHEDULED_TIME) AS t_mu, stddev_pop(SCHEDULED_TIME) AS t_sd FROM {fit}),
{name}_fq AS (SELECT FLIGHT_NUMBER, count(*) / (SELECT count(FLIGHT_NUMBER) FROM {fit}) AS FLIGHT_NUMBER_FREQ
              FROM {fit} WHERE FLIGHT_NUMBER IS NOT NULL GROUP BY FLIGHT_NUMBER),
{name}_all AS (
  SELECT s.ROW_ID, s.ARRIVAL_DELAY, s.DEPARTURE_DELAY, s.TAXI_OUT, s.WHEELS_OFF,
         s.ORIGIN_AIRPORT_LATITUDE, s.ORIGIN_AIRPORT_LONGITUDE,
         s.DESTINATION_AIRPORT_LATITUDE, s.DESTINATION_AIRPORT_LONGITUDE,
         sin(2 * pi() * s.DAY_OF_YEAR / 365) AS DAY_OF_YEAR_SIN,
         cos(2 * pi() * s.DAY_OF_YEAR / 365) AS DAY_OF_YEAR_COS,
         sin(2 * pi() * {minutes('s.SCHEDULED_DEPARTURE')} / 1440) AS SCHEDULED_DEPARTURE_SIN,
         sin(2 * pi() * {minutes('s.SCHEDULED_ARRIVAL')} / 1440) AS SCHEDULED_ARRIVAL_SIN,
         cos(2 * pi() * {minutes('s.SCHEDULED_ARRIVAL')} / 1440) AS SCHEDULED_ARRIVAL_COS,
         CASE WHEN st.d_sd = 0 THEN 0.0::double ELSE (s.DISTANCE - st.d_mu) / st.d_sd END AS DISTANCE_NORMALIZED,
         CASE WHEN st.t_sd = 0 THEN 0.0::double ELSE (s.SCHEDULED_TIME - st.t_mu) / st.t_sd END AS SCHEDULED_TIME_NORMALIZED,
         fq.FLIGHT_NUMBER_FREQ,
         s.DAY_OF_WEEK, s.AIRLINE
  FROM {src} s CROSS JOIN {name}_st st LEFT JOIN {name}_fq fq ON s.FLIGHT_NUMBER = fq.FLIGHT_NUMBER),
{name} AS (SELECT ROW_ID, ARRIVAL_DELAY, {', '.join(KEEP)} FROM {name}_all WHERE COLUMNS(*) IS NOT NULL)"""


FEAT_FIT = with_ctes(FLIGHTS, AIRPORTS, CLEANED, LABELLED, features_cte("train", "train_raw", "train_raw"),
                     features_cte("test", "test_raw", "train_raw"))
FEAT_REFIT = with_ctes(FLIGHTS, AIRPORTS, CLEANED, LABELLED, features_cte("train", "train_raw", "train_raw"),
                       features_cte("test", "test_raw", "test_raw"))


def _rounded_select(src: str) -> str:
    return f"SELECT ROW_ID, ARRIVAL_DELAY, {', '.join(R(c) + ' AS ' + c for c in KEEP)} FROM {src}"


# ---- naive Bayes in SQL: per-class moments, smoothing from the overall variance
def nb_ctes(train: str, smoothing: str = "1e-5") -> str:
    mom = ", ".join(f"avg({c}) AS t_{i}, var_pop({c}) AS v_{i}" for i, c in enumerate(KEEP))
    overall = "greatest(" + ", ".join(f"var_pop({c})" for c in KEEP) + ")"
    sig = ", ".join(f"m.v_{i} + g.eps AS s_{i}" for i in range(len(KEEP)))
    return f"""
nb_m AS (SELECT ARRIVAL_DELAY AS label, count(*) AS n, {mom} FROM {train} GROUP BY ARRIVAL_DELAY),
nb_g AS (SELECT {smoothing} * {overall} AS eps, count(*) AS n_all FROM {train}),
nb_p AS (SELECT m.label, m.n::double / g.n_all AS prior, {', '.join(f'm.t_{i}' for i in range(len(KEEP)))}, {sig}
         FROM nb_m m, nb_g g)"""


def jll(alias: str, src: str = "x") -> str:
    const = f"ln({alias}.prior) - 0.5 * (" + " + ".join(f"ln(2 * pi() * {alias}.s_{i})" for i in range(len(KEEP))) + ")"
    quad = " + ".join(f"({src}.{c} - {alias}.t_{i}) * ({src}.{c} - {alias}.t_{i}) / {alias}.s_{i}" for i, c in enumerate(KEEP))
    return f"(({const}) - 0.5 * ({quad}))"


def scored_cte(name: str, src: str) -> str:
    return f"""
{name}_j AS (SELECT x.ROW_ID, x.ARRIVAL_DELAY, {jll('p0')} AS j0, {jll('p1')} AS j1
             FROM {src} x, (SELECT * FROM nb_p WHERE label = 0) p0, (SELECT * FROM nb_p WHERE label = 1) p1),
{name} AS (SELECT ROW_ID, ARRIVAL_DELAY,
                  CASE WHEN j0 - j1 > 0 THEN exp(-(j0 - j1)) / (1 + exp(-(j0 - j1))) ELSE 1 / (1 + exp(j0 - j1)) END AS PROBA,
                  CASE WHEN j1 > j0 THEN 1 ELSE 0 END AS ARGMAX
           FROM {name}_j)"""


NB = FEAT_FIT.rstrip() + ",\n" + ",\n".join(
    c.strip() for c in (nb_ctes("train"), scored_cte("s_test", "test"), scored_cte("s_train", "train"))
) + "\n"


def confusion(src: str, pred: str) -> str:
    return f"""SELECT count(*) FILTER (WHERE ARRIVAL_DELAY = 0 AND {pred} = 0) AS tn,
       count(*) FILTER (WHERE ARRIVAL_DELAY = 0 AND {pred} = 1) AS fp,
       count(*) FILTER (WHERE ARRIVAL_DELAY = 1 AND {pred} = 0) AS fn,
       count(*) FILTER (WHERE ARRIVAL_DELAY = 1 AND {pred} = 1) AS tp FROM {src}"""


def auc_sql(src: str, score: str = "PROBA") -> str:
    """Brute-force tie-aware AUC: every positive against every negative score group."""
    return f"""(SELECT sum(p.c * (SELECT coalesce(sum(n.c), 0) FROM (SELECT {score} AS s, count(*) AS c FROM {src} WHERE ARRIVAL_DELAY = 0 GROUP BY 1) n WHERE n.s < p.s)
                 + 0.5 * p.c * (SELECT coalesce(sum(n.c), 0) FROM (SELECT {score} AS s, count(*) AS c FROM {src} WHERE ARRIVAL_DELAY = 0 GROUP BY 1) n WHERE n.s = p.s))
               / ((SELECT count(*) FROM {src} WHERE ARRIVAL_DELAY = 1)::double * (SELECT count(*) FROM {src} WHERE ARRIVAL_DELAY = 0))
        FROM (SELECT {score} AS s, count(*) AS c FROM {src} WHERE ARRIVAL_DELAY = 1 GROUP BY 1) p)"""


def auc_window(src: str, score: str = "PROBA") -> str:
    return f"""(WITH g AS (SELECT {score} AS s, count(*) FILTER (WHERE ARRIVAL_DELAY = 1) AS pos,
                               count(*) FILTER (WHERE ARRIVAL_DELAY = 0) AS neg FROM {src} GROUP BY 1),
             c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
        SELECT sum(pos * (below + 0.5 * neg)) / (sum(pos)::double * sum(neg)) FROM c)"""


def metric_rows(src: str, split: str, pred: str) -> str:
    cc = confusion(src, pred)
    return f"""SELECT '{split}' AS split, m.metric, {R('m.value')} AS value FROM (
  SELECT unnest([
    {{'metric': 'Accuracy', 'value': coalesce((tp + tn)::double / nullif(tp + tn + fp + fn, 0), 0)}},
    {{'metric': 'Precision', 'value': coalesce(tp::double / nullif(tp + fp, 0), 0)}},
    {{'metric': 'Recall', 'value': coalesce(tp::double / nullif(tp + fn, 0), 0)}},
    {{'metric': 'F1-Score', 'value': coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)}},
    {{'metric': 'ROC-AUC', 'value': {auc_window(src)}}}
  ]) AS m FROM ({cc}) cc) t"""


# ------------------------------------------------------------------ clean ---

STATIC_COLS = ("ROW_ID, YEAR, MONTH, DAY, DAY_OF_WEEK, AIRLINE, FLIGHT_NUMBER, ORIGIN_AIRPORT, DESTINATION_AIRPORT, "
               "SCHEDULED_DEPARTURE, SCHEDULED_ARRIVAL, SCHEDULED_TIME, DISTANCE, DEPARTURE_DELAY, TAXI_OUT, "
               "WHEELS_OFF, ARRIVAL_DELAY, CANCELLED, DIVERTED")
SQL["drop_static_columns"] = B + f"SELECT {STATIC_COLS} FROM flights"
SQL["drop_sparse_columns"] = B + ("SELECT * EXCLUDE (CANCELLATION_REASON, AIR_SYSTEM_DELAY, SECURITY_DELAY, AIRLINE_DELAY, "
                                  "LATE_AIRCRAFT_DELAY, WEATHER_DELAY) FROM flights")
SQL["null_share"] = B + f"""SELECT column_name, {R('null_share')} AS null_share FROM (
  UNPIVOT (SELECT {', '.join(f"avg(CASE WHEN {c} IS NULL THEN 1.0::double ELSE 0.0::double END) AS {c}" for c in
   ['ROW_ID', 'YEAR', 'MONTH', 'DAY', 'DAY_OF_WEEK', 'AIRLINE', 'FLIGHT_NUMBER', 'TAIL_NUMBER', 'ORIGIN_AIRPORT',
    'DESTINATION_AIRPORT', 'SCHEDULED_DEPARTURE', 'SCHEDULED_ARRIVAL', 'SCHEDULED_TIME', 'DISTANCE',
    'DEPARTURE_DELAY', 'TAXI_OUT', 'WHEELS_OFF', 'ARRIVAL_DELAY', 'CANCELLED', 'DIVERTED', 'CANCELLATION_REASON',
    'AIR_SYSTEM_DELAY', 'SECURITY_DELAY', 'AIRLINE_DELAY', 'LATE_AIRCRAFT_DELAY', 'WEATHER_DELAY',
    'DEPARTURE_TIME', 'ARRIVAL_TIME', 'WHEELS_ON', 'AIR_TIME', 'ELAPSED_TIME', 'TAXI_IN'])} FROM flights)
  ON COLUMNS(*) INTO NAME column_name VALUE null_share)"""
SQL["completed_flights"] = B + "SELECT ROW_ID, ARRIVAL_DELAY, DISTANCE FROM flights WHERE CANCELLED = 0 AND DIVERTED = 0"
SQL["quantile_filter"] = """SELECT event_id, value FROM events,
  (SELECT quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi FROM events) b
  WHERE value >= b.lo AND value <= b.hi"""
SQL["quantile_bounds"] = f"""SELECT p, {R('q')} AS q FROM (
  SELECT unnest([0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]::double[]) AS p,
         unnest(quantile_cont(value, [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0])) AS q FROM events)"""
SQL["sigma_filter"] = """SELECT event_id, value FROM events,
  (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events) b
  WHERE value >= b.m - 3 * b.s AND value <= b.m + 3 * b.s"""
SQL["zscore_filter"] = """SELECT event_id, value FROM events,
  (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events) b
  WHERE abs((value - b.m) / b.s) < 3"""
SQL["mean_std"] = B + f"SELECT {R('avg(ARRIVAL_DELAY)')} AS mean, {R('stddev_samp(ARRIVAL_DELAY)')} AS std FROM flights"
SQL["drop_null_target"] = B + "SELECT ROW_ID, ARRIVAL_DELAY FROM flights WHERE ARRIVAL_DELAY IS NOT NULL"
COORDS = """SELECT f.ROW_ID, o.LATITUDE AS ORIGIN_AIRPORT_LATITUDE, o.LONGITUDE AS ORIGIN_AIRPORT_LONGITUDE,
       d.LATITUDE AS DESTINATION_AIRPORT_LATITUDE, d.LONGITUDE AS DESTINATION_AIRPORT_LONGITUDE
FROM flights f LEFT JOIN airports o ON f.ORIGIN_AIRPORT = o.IATA_CODE
LEFT JOIN airports d ON f.DESTINATION_AIRPORT = d.IATA_CODE"""
SQL["airport_coordinates"] = B + COORDS
SQL["drop_null_rows"] = B + f"SELECT * FROM ({COORDS}) WHERE COLUMNS(*) IS NOT NULL"
SQL["rows_dropped"] = B + f"""SELECT count(*) AS rows_before,
  count(*) FILTER (WHERE ORIGIN_AIRPORT_LATITUDE IS NOT NULL AND ORIGIN_AIRPORT_LONGITUDE IS NOT NULL
                   AND DESTINATION_AIRPORT_LATITUDE IS NOT NULL AND DESTINATION_AIRPORT_LONGITUDE IS NOT NULL) AS rows_after,
  count(*) FILTER (WHERE NOT (ORIGIN_AIRPORT_LATITUDE IS NOT NULL AND ORIGIN_AIRPORT_LONGITUDE IS NOT NULL
                   AND DESTINATION_AIRPORT_LATITUDE IS NOT NULL AND DESTINATION_AIRPORT_LONGITUDE IS NOT NULL)) AS rows_dropped
FROM ({COORDS})"""
SQL["day_of_year"] = B + "SELECT ROW_ID, cast(dayofyear(make_date(YEAR, MONTH, DAY)) as integer) AS DAY_OF_YEAR FROM flights"
SQL["clean_flights"] = C + """SELECT ROW_ID, DAY_OF_WEEK, AIRLINE, FLIGHT_NUMBER, SCHEDULED_DEPARTURE, SCHEDULED_ARRIVAL,
  SCHEDULED_TIME, DISTANCE, DEPARTURE_DELAY, TAXI_OUT, WHEELS_OFF, ARRIVAL_DELAY, DAY_OF_YEAR,
  ORIGIN_AIRPORT_LATITUDE, ORIGIN_AIRPORT_LONGITUDE, DESTINATION_AIRPORT_LATITUDE, DESTINATION_AIRPORT_LONGITUDE
FROM cleaned"""

# --------------------------------------------------------------- features ---

CLOCK = "(SELECT event_id, cast(hour(ts) * 100 + minute(ts) as integer) AS HHMM FROM events)"
MIN = minutes("HHMM")
SQL["hhmm_minutes"] = f"SELECT event_id, HHMM, cast({MIN} as bigint) AS MINUTES FROM {CLOCK}"
SQL["cyclic"] = f"""SELECT event_id, {R(f'sin(2 * pi() * {MIN} / 1440)')} AS MINUTES_SIN,
  {R(f'cos(2 * pi() * {MIN} / 1440)')} AS MINUTES_COS FROM {CLOCK}"""


def period_sql(x: str) -> str:
    return (f"CASE WHEN {x} >= 0 AND {x} < 360 THEN 'midnight' WHEN {x} >= 360 AND {x} < 720 THEN 'morning' "
            f"WHEN {x} >= 720 AND {x} < 1080 THEN 'afternoon' ELSE 'night' END")


SQL["time_period"] = f"SELECT event_id, {period_sql(MIN)} AS PERIOD, {period_sql('HHMM')} AS HHMM_PERIOD FROM {CLOCK}"
SQL["rush_hour"] = f"""SELECT event_id, CASE WHEN ({MIN} >= 360 AND {MIN} < 540) OR ({MIN} >= 1020 AND {MIN} < 1200)
  THEN 1 ELSE 0 END AS RUSH_HOUR FROM {CLOCK}"""
SQL["weekend"] = B + "SELECT ROW_ID, CASE WHEN DAY_OF_WEEK IN (6, 7) THEN 1 ELSE 0 END AS IS_WEEKEND FROM flights"
SQL["season"] = B + """SELECT ROW_ID, CASE WHEN d < 80 OR d >= 355 THEN 'winter' WHEN d < 172 THEN 'spring'
  WHEN d < 266 THEN 'summer' WHEN d < 355 THEN 'autumn' END AS SEASON
FROM (SELECT ROW_ID, dayofyear(make_date(YEAR, MONTH, DAY)) AS d FROM flights)"""
SQL["distance_bins"] = B + """SELECT ROW_ID, CASE WHEN DISTANCE > 0 AND DISTANCE <= 500 THEN 'short'
  WHEN DISTANCE > 500 AND DISTANCE <= 1000 THEN 'medium' WHEN DISTANCE > 1000 AND DISTANCE <= 2000 THEN 'long'
  WHEN DISTANCE > 2000 THEN 'very_long' END AS DISTANCE_CATEGORY FROM flights"""
SQL["standardise"] = f"""SELECT l_orderkey, l_linenumber,
  {R('CASE WHEN s.sd = 0 THEN 0.0::double ELSE (l_extendedprice - s.mu) / s.sd END')} AS PRICE_NORMALIZED
FROM lineitem, (SELECT avg(l_extendedprice) AS mu, stddev_pop(l_extendedprice) AS sd FROM lineitem) s"""
SQL["min_max"] = f"""SELECT l_orderkey, l_linenumber,
  {R('CASE WHEN s.hi = s.lo THEN 0.0::double ELSE (l_extendedprice - s.lo) / (s.hi - s.lo) END')} AS PRICE_NORMALIZED
FROM lineitem, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem) s"""
_CATEGORY_INDEX = """
cats AS (SELECT 'customer' AS "column", cast(o_custkey AS varchar) AS category, count(*) AS rows FROM orders GROUP BY 2
         UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2),
cat_index AS (SELECT "column", category, rows, row_number() OVER (PARTITION BY "column" ORDER BY category NULLS LAST) - 1 AS index FROM cats)"""
SQL["category_index"] = f"WITH {_CATEGORY_INDEX} SELECT * FROM cat_index"
SQL["category_vectors"] = f"""WITH {_CATEGORY_INDEX},
cat_n AS (SELECT "column", count(*) AS n FROM cat_index GROUP BY 1),
cat_text AS (SELECT "column", category, '(' || n || ',[' || index || '],[1.0])' AS vec FROM cat_index JOIN cat_n USING ("column"))
SELECT o_orderkey, c.vec AS customer, p.vec AS priority FROM orders
JOIN cat_text c ON c."column" = 'customer' AND c.category IS NOT DISTINCT FROM cast(o_custkey AS varchar)
JOIN cat_text p ON p."column" = 'priority' AND p.category IS NOT DISTINCT FROM o_orderpriority"""
SQL["one_hot"] = """SELECT o_orderkey AS O_ORDERKEY,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0::double ELSE 0.0::double END AS "O_ORDERPRIORITY_1-URGENT",
  CASE WHEN o_orderpriority = '2-HIGH' THEN 1.0::double ELSE 0.0::double END AS "O_ORDERPRIORITY_2-HIGH",
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1.0::double ELSE 0.0::double END AS "O_ORDERPRIORITY_3-MEDIUM",
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1.0::double ELSE 0.0::double END AS "O_ORDERPRIORITY_4-NOT SPECIFIED",
  CASE WHEN o_orderpriority = '5-LOW' THEN 1.0::double ELSE 0.0::double END AS "O_ORDERPRIORITY_5-LOW"
FROM orders"""
SQL["frequency"] = f"""SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, {R('f.fr')} AS L_PARTKEY_FREQ
FROM lineitem l LEFT JOIN (SELECT l_partkey, count(*) / (SELECT count(l_partkey) FROM lineitem) AS fr
                            FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey) f ON l.l_partkey = f.l_partkey"""
SQL["uppercase"] = "SELECT event_id AS EVENT_ID, event_type AS EVENT_TYPE, value AS VALUE FROM events"
SQL["bools_to_ints"] = """SELECT event_id, cast(value > 50 as integer) AS is_large,
  cast(event_type = 'click' as integer) AS is_click FROM events"""


SQL["narrow_types_values"] = """SELECT cast(l_orderkey AS bigint) AS l_orderkey, cast(l_partkey AS bigint) AS l_partkey,
  cast(l_linenumber AS bigint) AS l_linenumber, cast(cast(l_quantity AS float) AS double) AS l_quantity,
  cast(cast(l_discount AS float) AS double) AS l_discount, cast(l_linenumber * 20 AS bigint) AS l_wide FROM lineitem"""


def _narrow(col: str, expr: str, is_int: bool) -> str:
    if is_int:
        return (f"SELECT '{col}' AS column_name, CASE WHEN min({expr}) > -128 AND max({expr}) < 127 THEN 'tinyint' "
                f"WHEN min({expr}) > -32768 AND max({expr}) < 32767 THEN 'smallint' "
                f"WHEN min({expr}) > -2147483648 AND max({expr}) < 2147483647 THEN 'int' "
                f"ELSE (SELECT CASE WHEN typeof(any_value({expr})) = 'INTEGER' THEN 'int' ELSE 'bigint' END) END AS narrowed FROM lineitem")
    return (f"SELECT '{col}' AS column_name, CASE WHEN min({expr}) > -3.4028234663852886e38 AND max({expr}) < 3.4028234663852886e38 "
            f"THEN 'float' ELSE 'double' END AS narrowed FROM lineitem")


SQL["narrow_types"] = " UNION ALL ".join([
    _narrow("l_orderkey", "l_orderkey", True), _narrow("l_partkey", "l_partkey", True),
    _narrow("l_linenumber", "l_linenumber", True), _narrow("l_quantity", "l_quantity", False),
    _narrow("l_discount", "l_discount", False), _narrow("l_wide", "l_linenumber * 20", True),
])

SQL["features_fit_train"] = FEAT_FIT + _rounded_select("test")
SQL["features_refit"] = FEAT_REFIT + _rounded_select("test")

# ------------------------------------------------------- labels and split ---

SQL["binarise_target"] = L + "SELECT ROW_ID, ARRIVAL_DELAY FROM labelled"
SQL["class_distribution"] = L + f"""SELECT ARRIVAL_DELAY, n, {R('n * 100.0 / sum(n) OVER ()')} AS percent,
  {R('max(n) OVER ()::double / min(n) OVER ()')} AS imbalance_ratio
FROM (SELECT ARRIVAL_DELAY, count(*) AS n FROM labelled GROUP BY 1)"""
SQL["class_weights"] = f"""SELECT doc_id, l.quality, {R('w.w')} AS WEIGHT FROM labels l JOIN (
  SELECT quality, (SELECT count(*) FROM labels)::double / ((SELECT count(DISTINCT quality) FROM labels) * count(*)) AS w
  FROM labels GROUP BY quality) w ON l.quality = w.quality"""
SQL["stratified_split"] = L + "SELECT ROW_ID, ARRIVAL_DELAY, IS_TEST FROM splitted"
SQL["kfold"] = L + f"""SELECT ROW_ID, cast({fold_of()} as integer) AS FOLD
FROM (SELECT ROW_ID, row_number() OVER (ORDER BY md5('42|fold|' || ROW_ID), ROW_ID) - 1 AS _fr, count(*) OVER () AS _fn FROM train_raw)"""
SQL["row_semi"] = C + "SELECT ROW_ID, DISTANCE FROM flights WHERE ROW_ID IN (SELECT ROW_ID FROM cleaned)"

# ------------------------------------------------------------ naive Bayes ---

SQL["nb_params"] = NB + "SELECT cast(label as integer) AS label, feature, " + R("prior") + " AS prior, " + R("theta") + " AS theta, " + R("sigma") + " AS sigma FROM (" + \
    " UNION ALL ".join(f"SELECT label, '{c}' AS feature, prior, t_{i} AS theta, s_{i} AS sigma FROM nb_p" for i, c in enumerate(KEEP)) + ")"
SQL["nb_scores"] = NB + f"SELECT ROW_ID, ARRIVAL_DELAY, {R('PROBA')} AS PROBA, CASE WHEN PROBA >= 0.5 THEN 1 ELSE 0 END AS PREDICTION FROM s_test"
SQL["nb_metrics"] = NB + (
    "SELECT * FROM (" + metric_rows("s_train", "train", "ARGMAX") + ") UNION ALL SELECT * FROM ("
    + metric_rows("(SELECT *, CASE WHEN PROBA >= 0.5 THEN 1 ELSE 0 END AS PRED FROM s_test)", "test", "PRED") + ")"
)
SQL["confusion_counts"] = NB + f"""SELECT tn, fp, fn, tp, {R('coalesce(tp::double / nullif(tp + fn, 0), 0)')} AS sensitivity,
  {R('coalesce(tn::double / nullif(tn + fp, 0), 0)')} AS specificity FROM (
  {confusion("(SELECT *, CASE WHEN PROBA >= 0.5 THEN 1 ELSE 0 END AS PRED FROM s_test)", "PRED")})"""
SQL["roc_auc"] = NB + f"SELECT {R(auc_sql('s_test'))} AS roc_auc"
SQL["hard_label_auc"] = NB + f"""SELECT {R('(coalesce(tp::double / nullif(tp + fn, 0), 0) + coalesce(tn::double / nullif(tn + fp, 0), 0)) / 2')} AS hard_label_auc
FROM ({confusion("(SELECT *, CASE WHEN PROBA >= 0.5 THEN 1 ELSE 0 END AS PRED FROM s_test)", "PRED")})"""
SQL["predicted_share"] = NB + f"""SELECT count(*) FILTER (WHERE PROBA >= 0.5) AS predicted_delays, count(*) AS rows,
  {R('count(*) FILTER (WHERE PROBA >= 0.5)::double / count(*)')} AS share FROM s_test"""

ROC = """
roc_g AS (SELECT round(PROBA, 6) AS s, count(*) FILTER (WHERE ARRIVAL_DELAY = 1) AS pos,
                 count(*) FILTER (WHERE ARRIVAL_DELAY = 0) AS neg FROM s_test GROUP BY 1),
roc_c AS (SELECT s, pos, neg, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps,
                 lead(pos) OVER (ORDER BY s DESC) AS np, lead(neg) OVER (ORDER BY s DESC) AS nn,
                 row_number() OVER (ORDER BY s DESC) AS i
          FROM roc_g WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
roc_pts AS (
  SELECT 'infinity'::double AS threshold, 0.0 AS fpr, 0.0 AS tpr
  UNION ALL
  SELECT s, fps::double / (SELECT sum(neg) FROM roc_g), tps::double / (SELECT sum(pos) FROM roc_g) FROM roc_c
  WHERE i = 1 OR np IS NULL OR np <> pos OR nn <> neg)"""
NB_ROC = NB.rstrip() + ",\n" + ROC.strip() + "\n"
SQL["roc_curve"] = NB_ROC + f"SELECT threshold, {R('fpr')} AS fpr, {R('tpr')} AS tpr FROM roc_pts"
SQL["threshold_summary"] = NB_ROC + f"""SELECT avg(threshold) AS mean_threshold, {R('median(threshold)')} AS median_threshold,
  {R("avg(threshold) FILTER (WHERE threshold <> 'infinity'::double)")} AS mean_finite,
  {R("median(threshold) FILTER (WHERE threshold <> 'infinity'::double)")} AS median_finite FROM roc_pts"""


def _cv_sql(grid) -> str:
    """Brute force: for every fold, moments of the other folds, then held-out predictions."""
    mom = ", ".join(f"avg(t.{c}) AS t_{i}, var_pop(t.{c}) AS v_{i}" for i, c in enumerate(KEEP))
    overall = "greatest(" + ", ".join(f"var_pop(t.{c})" for c in KEEP) + ")"
    grid_list = ", ".join(repr(g) for g in grid)

    def j(alias):
        const = f"ln({alias}.prior) - 0.5 * (" + " + ".join(f"ln(2 * pi() * ({alias}.v_{i} + g.sm * {alias}.mv))" for i in range(len(KEEP))) + ")"
        quad = " + ".join(f"(x.{c} - {alias}.t_{i}) * (x.{c} - {alias}.t_{i}) / ({alias}.v_{i} + g.sm * {alias}.mv)" for i, c in enumerate(KEEP))
        return f"(({const}) - 0.5 * ({quad}))"

    return FEAT_FIT.rstrip() + f""",
{folded_cte('train')},
folds AS (SELECT DISTINCT FOLD AS f FROM folded),
fm AS (SELECT fo.f, t.ARRIVAL_DELAY AS label, count(*) AS n, {mom} FROM folds fo JOIN folded t ON t.FOLD <> fo.f GROUP BY fo.f, t.ARRIVAL_DELAY),
fg AS (SELECT fo.f, {overall} AS mv, count(*) AS n_all FROM folds fo JOIN folded t ON t.FOLD <> fo.f GROUP BY fo.f),
fp AS (SELECT fm.*, fm.n::double / fg.n_all AS prior, fg.mv FROM fm JOIN fg USING (f)),
grid AS (SELECT unnest([{grid_list}]::double[]) AS sm),
preds AS (SELECT g.sm, x.FOLD, x.ARRIVAL_DELAY AS y, CASE WHEN {j('p1')} > {j('p0')} THEN 1 ELSE 0 END AS p
          FROM folded x CROSS JOIN grid g
          JOIN fp p0 ON p0.f = x.FOLD AND p0.label = 0 JOIN fp p1 ON p1.f = x.FOLD AND p1.label = 1),
f1s AS (SELECT sm, FOLD, coalesce(2.0 * count(*) FILTER (WHERE y = 1 AND p = 1) /
               nullif(2 * count(*) FILTER (WHERE y = 1 AND p = 1) + count(*) FILTER (WHERE y = 0 AND p = 1)
                      + count(*) FILTER (WHERE y = 1 AND p = 0), 0), 0) AS f1 FROM preds GROUP BY sm, FOLD),
res AS (SELECT sm AS var_smoothing, avg(f1) AS cv_mean, stddev_pop(f1) AS cv_std, count(*) AS folds FROM f1s GROUP BY sm)
"""


SQL["nb_cv"] = _cv_sql([1e-5]) + f"SELECT var_smoothing, {R('cv_mean')} AS cv_mean, {R('cv_std')} AS cv_std, folds FROM res"
SQL["nb_smoothing_search"] = _cv_sql(GRID) + f"""SELECT var_smoothing, {R('cv_mean')} AS cv_mean, {R('cv_std')} AS cv_std, folds,
  cast(row_number() OVER (ORDER BY cv_mean DESC, var_smoothing ASC) as integer) AS rank FROM res"""


# ------------------------------------------------ all features (one-hot) ---
# The category domains of the test data are listed here because a dynamic PIVOT
# cannot read a CTE; the Spark side discovers them from the data.
ONE_HOT_DOMAINS = {
    "AIRLINE": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "SEASON": ["autumn", "spring", "summer", "winter"],
    "DISTANCE_CATEGORY": ["long", "medium", "short", "very_long"],
    "SCHEDULED_DEPARTURE_PERIOD": ["afternoon", "midnight", "morning", "night"],
    "SCHEDULED_ARRIVAL_PERIOD": ["afternoon", "midnight", "morning", "night"],
}
ALL_FEATURES = [
    "DEPARTURE_DELAY", "TAXI_OUT", "WHEELS_OFF", "ORIGIN_AIRPORT_LATITUDE", "ORIGIN_AIRPORT_LONGITUDE",
    "DESTINATION_AIRPORT_LATITUDE", "DESTINATION_AIRPORT_LONGITUDE", "DAY_OF_WEEK_SIN", "DAY_OF_WEEK_COS",
    "DAY_OF_YEAR_SIN", "DAY_OF_YEAR_COS", "SCHEDULED_DEPARTURE_SIN", "SCHEDULED_DEPARTURE_COS",
    "SCHEDULED_ARRIVAL_SIN", "SCHEDULED_ARRIVAL_COS", "IS_WEEKEND", "DISTANCE_NORMALIZED",
    "SCHEDULED_TIME_NORMALIZED",
] + [f"{c}_{v.upper()}" for c, vs in ONE_HOT_DOMAINS.items() for v in vs] + ["FLIGHT_NUMBER_FREQ"]


def features_all_cte(name: str, src: str, fit: str) -> str:
    """M16 with every produced column (one-hot included) for ``src``, fitted on ``fit``."""
    sd, sa = minutes("s.SCHEDULED_DEPARTURE"), minutes("s.SCHEDULED_ARRIVAL")
    season = ("CASE WHEN s.DAY_OF_YEAR < 80 OR s.DAY_OF_YEAR >= 355 THEN 'winter' WHEN s.DAY_OF_YEAR < 172 THEN 'spring' "
              "WHEN s.DAY_OF_YEAR < 266 THEN 'summer' WHEN s.DAY_OF_YEAR < 355 THEN 'autumn' END")
    dist = ("CASE WHEN s.DISTANCE > 0 AND s.DISTANCE <= 500 THEN 'short' WHEN s.DISTANCE > 500 AND s.DISTANCE <= 1000 "
            "THEN 'medium' WHEN s.DISTANCE > 1000 AND s.DISTANCE <= 2000 THEN 'long' WHEN s.DISTANCE > 2000 THEN 'very_long' END")
    cat_expr = {
        "AIRLINE": "s.AIRLINE", "SEASON": season, "DISTANCE_CATEGORY": dist,
        "SCHEDULED_DEPARTURE_PERIOD": period_sql("s.SCHEDULED_DEPARTURE"),
        "SCHEDULED_ARRIVAL_PERIOD": period_sql("s.SCHEDULED_ARRIVAL"),
    }
    onehots = ",\n         ".join(
        f"CASE WHEN ({cat_expr[c]}) = '{v}' THEN 1.0::double ELSE 0.0::double END AS {c}_{v.upper()}"
        for c, vs in ONE_HOT_DOMAINS.items() for v in vs
    )
    return f"""
{name}_st AS (SELECT avg(DISTANCE) AS d_mu, stddev_pop(DISTANCE) AS d_sd,
                     avg(SCHEDULED_TIME) AS t_mu, stddev_pop(SCHEDULED_TIME) AS t_sd FROM {fit}),
{name}_fq AS (SELECT FLIGHT_NUMBER, count(*) / (SELECT count(FLIGHT_NUMBER) FROM {fit}) AS FLIGHT_NUMBER_FREQ
              FROM {fit} WHERE FLIGHT_NUMBER IS NOT NULL GROUP BY FLIGHT_NUMBER),
{name}_all AS (
  SELECT s.ROW_ID, s.ARRIVAL_DELAY, s.DEPARTURE_DELAY, s.TAXI_OUT, s.WHEELS_OFF,
         s.ORIGIN_AIRPORT_LATITUDE, s.ORIGIN_AIRPORT_LONGITUDE,
         s.DESTINATION_AIRPORT_LATITUDE, s.DESTINATION_AIRPORT_LONGITUDE,
         sin(2 * pi() * s.DAY_OF_WEEK / 7) AS DAY_OF_WEEK_SIN, cos(2 * pi() * s.DAY_OF_WEEK / 7) AS DAY_OF_WEEK_COS,
         sin(2 * pi() * s.DAY_OF_YEAR / 365) AS DAY_OF_YEAR_SIN, cos(2 * pi() * s.DAY_OF_YEAR / 365) AS DAY_OF_YEAR_COS,
         sin(2 * pi() * {sd} / 1440) AS SCHEDULED_DEPARTURE_SIN, cos(2 * pi() * {sd} / 1440) AS SCHEDULED_DEPARTURE_COS,
         sin(2 * pi() * {sa} / 1440) AS SCHEDULED_ARRIVAL_SIN, cos(2 * pi() * {sa} / 1440) AS SCHEDULED_ARRIVAL_COS,
         CASE WHEN s.DAY_OF_WEEK IN (6, 7) THEN 1 ELSE 0 END AS IS_WEEKEND,
         CASE WHEN st.d_sd = 0 THEN 0.0::double ELSE (s.DISTANCE - st.d_mu) / st.d_sd END AS DISTANCE_NORMALIZED,
         CASE WHEN st.t_sd = 0 THEN 0.0::double ELSE (s.SCHEDULED_TIME - st.t_mu) / st.t_sd END AS SCHEDULED_TIME_NORMALIZED,
         {onehots},
         fq.FLIGHT_NUMBER_FREQ
  FROM {src} s CROSS JOIN {name}_st st LEFT JOIN {name}_fq fq ON s.FLIGHT_NUMBER = fq.FLIGHT_NUMBER),
{name} AS (SELECT * FROM {name}_all WHERE COLUMNS(*) IS NOT NULL)"""


FEAT_ALL = with_ctes(FLIGHTS, AIRPORTS, CLEANED, LABELLED, features_all_cte("ftrain", "train_raw", "train_raw"),
                     features_all_cte("ftest", "test_raw", "train_raw"))

SQL["features_all_columns"] = FEAT_ALL + "SELECT ROW_ID, ARRIVAL_DELAY, " + ", ".join(
    (R(c) if c != "IS_WEEKEND" else c) + f" AS {c}" for c in ALL_FEATURES) + " FROM ftrain"

_CORR = ", ".join(
    f"abs(CASE WHEN stddev_pop({c}) * stddev_pop(ARRIVAL_DELAY) = 0 THEN NULL "
    f"ELSE covar_pop({c}, ARRIVAL_DELAY) / (stddev_pop({c}) * stddev_pop(ARRIVAL_DELAY)) END) AS {c}"
    for c in ALL_FEATURES
)
CORR_CTE = f"""
corr_wide AS (SELECT {_CORR} FROM ftrain),
corr_long AS (UNPIVOT corr_wide ON COLUMNS(*) INTO NAME feature VALUE abs_corr),
corr_all AS (SELECT f.feature, c.abs_corr FROM (SELECT unnest({ALL_FEATURES!r}) AS feature) f LEFT JOIN corr_long c USING (feature)),
corr_ranked AS (SELECT feature, abs_corr, cast(row_number() OVER (ORDER BY round(abs_corr, 9) DESC NULLS LAST, feature) as integer) AS rank FROM corr_all),
corr_sel AS (SELECT *, CASE WHEN (SELECT count(*) FROM corr_ranked WHERE abs_corr > 0.6) > 0
                            THEN coalesce(abs_corr > 0.6, false) ELSE rank <= 15 END::integer AS selected FROM corr_ranked)"""
FEAT_CORR = FEAT_ALL.rstrip() + ",\n" + CORR_CTE.strip() + "\n"
SQL["correlation_screen"] = FEAT_CORR + f"SELECT feature, {R('abs_corr')} AS abs_corr, rank, selected FROM corr_sel"
SQL["column_profile"] = FEAT_ALL + "SELECT column_name, " + R("mn") + " AS min, " + R("mx") + " AS max FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, min({c})::double AS mn, max({c})::double AS mx FROM ftrain" for c in ALL_FEATURES) + ")"


# ---------------------------------------------------- scoring and storage ---

SQL["align_schema"] = FEAT_FIT + "SELECT ROW_ID, ARRIVAL_DELAY, " + ", ".join(
    (R(c) if c != "FLIGHT_NUMBER_FREQ" else "0.0::double") + f" AS {c}" for c in KEEP) + " FROM test"
SQL["model_roundtrip"] = SQL["nb_params"]
SQL["score_batch"] = NB + f"SELECT ROW_ID, {R('PROBA')} AS PROBA, ARGMAX AS PREDICTION FROM s_test"
SQL["roundtrip_tables"] = SQL["clean_flights"]
_E2E_CV = _cv_sql([1e-5]).rstrip() + ",\n" + ",\n".join(
    c.strip() for c in (nb_ctes("train"), scored_cte("s_test", "test"), scored_cte("s_train", "train"))) + "\n"
SQL["train_end_to_end"] = _E2E_CV + (
    "SELECT * FROM (" + metric_rows("s_train", "train", "ARGMAX") + ") UNION ALL SELECT * FROM ("
    + metric_rows("(SELECT *, CASE WHEN PROBA >= 0.5 THEN 1 ELSE 0 END AS PRED FROM s_test)", "test", "PRED") + ")"
    + f" UNION ALL SELECT 'cv', 'cv_mean', {R('cv_mean')} FROM res UNION ALL SELECT 'cv', 'cv_std', {R('cv_std')} FROM res"
    + " UNION ALL SELECT 'params', 'var_smoothing', 1e-5 UNION ALL SELECT 'params', 'threshold', 0.5"
)

# -------------------------------------------------------------- resampling ---


def _ros_sql(cols: list[str], ratio: float | None) -> str:
    target = "n_maj" if ratio is None else f"cast(floor({ratio} * n_maj) as bigint)"
    sel = ", ".join(f"{R(c)} AS {c}" for c in cols)
    return FEAT_FIT.rstrip() + f""",
cnt AS (SELECT ARRIVAL_DELAY AS y, count(*) AS n FROM train GROUP BY 1),
roles AS (SELECT (SELECT y FROM cnt ORDER BY n, y LIMIT 1) AS ymin, (SELECT n FROM cnt ORDER BY n, y LIMIT 1) AS n_min,
                 (SELECT n FROM cnt ORDER BY n DESC, y DESC LIMIT 1) AS n_maj),
mins AS (SELECT t.*, row_number() OVER (ORDER BY md5('42|' || ROW_ID), ROW_ID) - 1 AS idx
         FROM train t, roles WHERE t.ARRIVAL_DELAY = roles.ymin),
draws AS (SELECT j, cast(('0x' || substr(md5('42|ros|' || cast(j as varchar)), 1, 15)) as bigint) % roles.n_min AS idx
          FROM roles, (SELECT unnest(range((SELECT {target} - n_min FROM roles))) AS j)),
allrows AS (SELECT ROW_ID, ARRIVAL_DELAY, {', '.join(cols)} FROM train
            UNION ALL
            SELECT md5(m.ROW_ID || '|ros|' || cast(d.j as varchar)), m.ARRIVAL_DELAY, {', '.join('m.' + c for c in cols)}
            FROM draws d JOIN mins m USING (idx))
SELECT ROW_ID, ARRIVAL_DELAY, {sel} FROM allrows"""


SQL["random_oversample"] = _ros_sql(KEEP, None)
SQL["random_oversample_ratio"] = _ros_sql(KEEP, 0.3)


# ------------------------------------------------------------ SMOTE k-NN ---
_D2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in KEEP)
SQL["smote_neighbors"] = FEAT_FIT.rstrip() + f""",
mins AS (SELECT * FROM train WHERE ARRIVAL_DELAY = 1),
pairs AS (SELECT a.ROW_ID, {_D2} AS d2, b.ROW_ID AS nid FROM mins a JOIN mins b ON a.ROW_ID <> b.ROW_ID),
nn_ranked AS (SELECT ROW_ID, d2, row_number() OVER (PARTITION BY ROW_ID ORDER BY d2, nid) - 1 AS slot FROM pairs)
SELECT ROW_ID, cast(slot as integer) AS slot, {R('d2')} AS d2 FROM nn_ranked WHERE slot < 5"""


def _smote_ctes(cols: list[str], train: str, ratio: float | None) -> str:
    """``allrows``: ``train`` and its synthetic rows, neighbours by brute force; a whole-number column stays one (cut off)."""
    target = "n_maj" if ratio is None else f"cast(floor({ratio} * n_maj) as bigint)"
    tie = "md5(concat_ws(',', " + ", ".join(f"cast(cast(floor({c} * 1e6 + 0.5) as bigint) as varchar)" for c in cols) + "))"
    same = " AND ".join(f"a.{c} = b.{c}" for c in cols)
    d2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in cols)
    point = {c: f"b.{c} + d.u * (n.{c} - b.{c})" for c in cols}
    new = ", ".join((f"cast(trunc({x}) AS integer)" if c == "IS_WEEKEND" else x) + f" AS {c}" for c, x in point.items())
    digits = lambda text, n: f"cast(('0x' || substr(md5('42|{text}' || cast(j as varchar)), 1, {n})) as bigint)"
    return f"""
cnt AS (SELECT ARRIVAL_DELAY AS y, count(*) AS n FROM {train} GROUP BY 1),
roles AS (SELECT (SELECT y FROM cnt ORDER BY n, y LIMIT 1) AS ymin, (SELECT n FROM cnt ORDER BY n, y LIMIT 1) AS n_min,
                 (SELECT n FROM cnt ORDER BY n DESC, y DESC LIMIT 1) AS n_maj),
mins AS (SELECT t.*, row_number() OVER (ORDER BY md5('42|' || ROW_ID), ROW_ID) - 1 AS idx, {tie} AS tie
         FROM {train} t, roles WHERE t.ARRIVAL_DELAY = roles.ymin),
near AS (SELECT a.idx, b.idx AS nidx, row_number() OVER (PARTITION BY a.idx ORDER BY CASE WHEN {same} THEN 0 ELSE 1 END, round({d2}, 9), b.tie, b.idx) - 1 AS slot
         FROM mins a JOIN mins b ON a.idx <> b.idx),
draws AS (SELECT j, {digits('smote-base|', 15)} % roles.n_min AS idx, {digits('smote-nn|', 15)} % least(5, roles.n_min - 1) AS slot,
                 {digits('smote-u|', 8)} / 4294967296.0::double AS u
          FROM roles, (SELECT unnest(range((SELECT {target} - n_min FROM roles))) AS j)),
allrows AS (SELECT ROW_ID, ARRIVAL_DELAY, {', '.join(cols)} FROM {train}
            UNION ALL
            SELECT md5(b.ROW_ID || '|smote|' || cast(d.j as varchar)), b.ARRIVAL_DELAY, {new}
            FROM draws d JOIN mins b USING (idx) JOIN near ON near.idx = d.idx AND near.slot = d.slot JOIN mins n ON n.idx = near.nidx)"""


def _smote_sql(ratio: float | None) -> str:
    return FEAT_FIT.rstrip() + "," + _smote_ctes(KEEP, "train", ratio) + f"""
SELECT ROW_ID, ARRIVAL_DELAY, {', '.join(f"{R(c)} AS {c}" for c in KEEP)} FROM allrows"""


SQL["smote_balanced"] = _smote_sql(None)
SQL["smote_ratio"] = _smote_sql(0.3)


def _variant_sql(features: list[str], train: str = "ftrain", test: str = "ftest", name: str = "all_features",
                 extra_ctes: str = "", chosen: str | None = None) -> str:
    """``chosen`` is a table (feature, selected) whose 0/1 weighs each feature's part of the sums."""
    weight = [f"(SELECT selected FROM {chosen} WHERE feature = '{c}') * " if chosen else "" for c in features]
    n_features = f"(SELECT cast(sum(selected) AS integer) FROM {chosen})" if chosen else len(features)
    mom = ", ".join(f"avg(t.{c}) AS t_{i}, var_pop(t.{c}) AS v_{i}" for i, c in enumerate(features))
    overall = "greatest(" + ", ".join(f"{w}var_pop(t.{c})" for c, w in zip(features, weight)) + ")"
    grid_list = ", ".join(repr(g) for g in GRID)

    def j(alias, src="x", var_expr=lambda a, i: f"({a}.v_{i} + g.sm * {a}.mv)"):
        const = f"ln({alias}.prior) - 0.5 * (" + " + ".join(f"{w}ln(2 * pi() * {var_expr(alias, i)})" for i, w in enumerate(weight)) + ")"
        quad = " + ".join(f"{w}({src}.{c} - {alias}.t_{i}) * ({src}.{c} - {alias}.t_{i}) / {var_expr(alias, i)}" for i, (c, w) in enumerate(zip(features, weight)))
        return f"(({const}) - 0.5 * ({quad}))"

    return FEAT_ALL.rstrip() + ",\n" + (extra_ctes.strip() + ",\n" if extra_ctes else "") + f"""
{folded_cte(train)},
folds AS (SELECT DISTINCT FOLD AS f FROM folded),
fm AS (SELECT fo.f, t.ARRIVAL_DELAY AS label, count(*) AS n, {mom} FROM folds fo JOIN folded t ON t.FOLD <> fo.f GROUP BY fo.f, t.ARRIVAL_DELAY),
fg AS (SELECT fo.f, {overall} AS mv, count(*) AS n_all FROM folds fo JOIN folded t ON t.FOLD <> fo.f GROUP BY fo.f),
fp AS (SELECT fm.*, fm.n::double / fg.n_all AS prior, fg.mv FROM fm JOIN fg USING (f)),
grid AS (SELECT unnest([{grid_list}]::double[]) AS sm),
preds AS (SELECT g.sm, x.FOLD, x.ARRIVAL_DELAY AS y, CASE WHEN {j('p1')} > {j('p0')} THEN 1 ELSE 0 END AS p
          FROM folded x CROSS JOIN grid g
          JOIN fp p0 ON p0.f = x.FOLD AND p0.label = 0 JOIN fp p1 ON p1.f = x.FOLD AND p1.label = 1),
f1s AS (SELECT sm, FOLD, coalesce(2.0 * count(*) FILTER (WHERE y = 1 AND p = 1) /
               nullif(2 * count(*) FILTER (WHERE y = 1 AND p = 1) + count(*) FILTER (WHERE y = 0 AND p = 1)
                      + count(*) FILTER (WHERE y = 1 AND p = 0), 0), 0) AS f1 FROM preds GROUP BY sm, FOLD),
res AS (SELECT sm AS var_smoothing, avg(f1) AS cv_mean FROM f1s GROUP BY sm),
best AS (SELECT * FROM res ORDER BY cv_mean DESC, var_smoothing ASC LIMIT 1),
bm AS (SELECT t.ARRIVAL_DELAY AS label, count(*) AS n, {mom} FROM {train} t GROUP BY 1),
bg AS (SELECT {overall} AS mv, count(*) AS n_all FROM {train} t),
bp AS (SELECT bm.*, bm.n::double / bg.n_all AS prior, bg.mv, best.var_smoothing AS sm FROM bm, bg, best),
sc AS (SELECT x.ARRIVAL_DELAY AS y, {j('q0', var_expr=lambda a, i: f"({a}.v_{i} + {a}.sm * {a}.mv)")} AS j0,
              {j('q1', var_expr=lambda a, i: f"({a}.v_{i} + {a}.sm * {a}.mv)")} AS j1
       FROM {test} x, (SELECT * FROM bp WHERE label = 0) q0, (SELECT * FROM bp WHERE label = 1) q1),
scp AS (SELECT y, CASE WHEN j0 - j1 > 0 THEN exp(-(j0 - j1)) / (1 + exp(-(j0 - j1))) ELSE 1 / (1 + exp(j0 - j1)) END AS PROBA FROM sc),
sct AS (SELECT y AS ARRIVAL_DELAY, PROBA, CASE WHEN PROBA >= 0.5 THEN 1 ELSE 0 END AS PRED FROM scp),
cc AS ({confusion("sct", "PRED")})
SELECT '{name}' AS variant, (SELECT var_smoothing FROM best) AS var_smoothing, {R('(SELECT cv_mean FROM best)')} AS cv_f1,
       {n_features} AS n_features,
       {R('coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)')} AS f1,
       {R('coalesce(tp::double / nullif(tp + fn, 0), 0)')} AS recall,
       {R('coalesce(tp::double / nullif(tp + fp, 0), 0)')} AS precision,
       {R('coalesce((tp + tn)::double / nullif(tp + tn + fp + fn, 0), 0)')} AS accuracy,
       {R(auc_window('sct'))} AS roc_auc
FROM cc"""


SQL["variant_all_features"] = _variant_sql(ALL_FEATURES)
SQL["variant_correlation_screen"] = _variant_sql(ALL_FEATURES, name="correlation_screen", extra_ctes=CORR_CTE, chosen="corr_sel")
SQL["variant_smote_balanced"] = _variant_sql(ALL_FEATURES, train="allrows", name="smote_balanced",
                                             extra_ctes=_smote_ctes(ALL_FEATURES, "ftrain", None))
SQL["variant_smote_ratio"] = _variant_sql(ALL_FEATURES, train="allrows", name="smote_ratio_0.3",
                                          extra_ctes=_smote_ctes(ALL_FEATURES, "ftrain", 0.3))

# variant 6: the all-feature train split grown to balance by random oversampling
_ROS_TRAIN = f"""
rcnt AS (SELECT ARRIVAL_DELAY AS y, count(*) AS n FROM ftrain GROUP BY 1),
rroles AS (SELECT (SELECT y FROM rcnt ORDER BY n, y LIMIT 1) AS ymin, (SELECT n FROM rcnt ORDER BY n, y LIMIT 1) AS n_min,
                  (SELECT n FROM rcnt ORDER BY n DESC, y DESC LIMIT 1) AS n_maj),
rmins AS (SELECT t.*, row_number() OVER (ORDER BY md5('42|' || ROW_ID), ROW_ID) - 1 AS idx
          FROM ftrain t, rroles WHERE t.ARRIVAL_DELAY = rroles.ymin),
rdraws AS (SELECT j, cast(('0x' || substr(md5('42|ros|' || cast(j as varchar)), 1, 15)) as bigint) % rroles.n_min AS idx
           FROM rroles, (SELECT unnest(range((SELECT n_maj - n_min FROM rroles))) AS j)),
rtrain AS (SELECT ROW_ID, ARRIVAL_DELAY, {', '.join(ALL_FEATURES)} FROM ftrain
           UNION ALL
           SELECT md5(m.ROW_ID || '|ros|' || cast(d.j as varchar)), m.ARRIVAL_DELAY, {', '.join('m.' + c for c in ALL_FEATURES)}
           FROM rdraws d JOIN rmins m USING (idx))"""
SQL["variant_random_oversample"] = _variant_sql(ALL_FEATURES, train="rtrain", name="random_oversample",
                                                extra_ctes=_ROS_TRAIN)

_TWO = f"""WITH pairv AS (SELECT * FROM ({SQL['variant_all_features']}) UNION ALL SELECT * FROM ({SQL['variant_random_oversample']}))"""
SQL["rank_variants"] = _TWO + """
SELECT *, cast(row_number() OVER (ORDER BY f1 DESC, variant) as integer) AS rank FROM pairv"""
SQL["best_of_variants"] = _TWO + "".join(
    f""" {'UNION ALL' if k else ''} SELECT * FROM (SELECT '{m}' AS metric, variant AS best_variant, {m} AS value FROM pairv ORDER BY {m} DESC, f1 DESC, variant LIMIT 1)"""
    for k, m in enumerate(["f1", "roc_auc", "recall", "precision"]))


# ------------------------------------------------------- remaining outputs ---
SQL["csv_roundtrip"] = B + "SELECT ROW_ID, AIRLINE, FLIGHT_NUMBER, DISTANCE, ARRIVAL_DELAY, CANCELLATION_REASON FROM flights"
SQL["roc_curve_roundtrip"] = SQL["roc_curve"]
SQL["label_int8"] = L + "SELECT ROW_ID, cast(ARRIVAL_DELAY as tinyint) AS ARRIVAL_DELAY FROM labelled"
_METRICS = ("(SELECT * FROM (" + metric_rows("s_train", "train", "ARGMAX") + ") UNION ALL SELECT * FROM ("
            + metric_rows("(SELECT *, CASE WHEN PROBA >= 0.5 THEN 1 ELSE 0 END AS PRED FROM s_test)", "test", "PRED") + "))")
SQL["overfit_report"] = NB + f"""SELECT a.metric, a.value AS train, b.value AS test, {R('abs(a.value - b.value)')} AS diff,
  CASE WHEN abs(a.value - b.value) > 0.1 THEN 1 ELSE 0 END AS overfit
FROM {_METRICS} a JOIN {_METRICS} b ON a.metric = b.metric AND a.split = 'train' AND b.split = 'test'"""
SQL["score_first_rows"] = NB + f"""SELECT ROW_ID, {R('PROBA')} AS PROBA, CASE WHEN PROBA >= 0.5 THEN 1 ELSE 0 END AS PREDICTION
FROM s_test ORDER BY ROW_ID LIMIT 10"""

SQL["strict_drop"] = B + "SELECT ROW_ID, DISTANCE, ARRIVAL_DELAY FROM flights"
SQL["feature_label"] = ("SELECT * FROM (VALUES " + ", ".join(f"({k}, '{c}', 'feature')" for k, c in enumerate(KEEP)) + f", ({len(KEEP)}, 'ARRIVAL_DELAY', 'label')) AS t(position, column_name, role)")
SQL["feature_table_roundtrip"] = FEAT_FIT.rstrip() + f"\nSELECT ROW_ID, ARRIVAL_DELAY, {', '.join(f'{R(c)} AS {c}' for c in KEEP)} FROM train"
SQL["sql_views"] = B + "SELECT AIRLINE, count(*) AS flights, count(ARRIVAL_DELAY) AS arrived FROM flights JOIN airports ON IATA_CODE = ORIGIN_AIRPORT GROUP BY AIRLINE"

SQL["csv_by_header"] = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"
_BROKEN = "l_orderkey % 97 = 0 OR l_orderkey % 89 = 0"
SQL["csv_good_rows"] = f"""SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS qty, CAST(l_shipdate AS DATE) AS day
FROM lineitem WHERE NOT ({_BROKEN})"""
SQL["csv_quarantine"] = f"""WITH t AS (SELECT *, {_BROKEN} AS bad, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q, strftime(l_shipdate, '%Y-%m-%d') AS d FROM lineitem)
SELECT CASE WHEN l_orderkey % 89 = 0 THEN left(d, 8) || '32' ELSE d END || ',' || CASE WHEN l_orderkey % 97 = 0 THEN 'q' ELSE '' END || q
       || ',' || l_returnflag || ',' || l_linenumber || ',' || l_orderkey AS record,
       (SELECT count(*) FROM t WHERE NOT bad) AS n_rows, (SELECT count(*) FROM t WHERE bad) AS n_bad
FROM t WHERE bad"""
_SPLITS = """WITH f AS (SELECT unnest(range(45)) AS k),
c AS (SELECT l_partkey % 40 AS k, count(*) AS n FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1),
i AS (SELECT 'PART_' || lpad(CAST(f.k AS VARCHAR), 2, '0') AS feature, CAST(coalesce(c.n, 0) AS DOUBLE) AS importance FROM f LEFT JOIN c USING (k)),
r AS (SELECT feature, importance, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank FROM i)
"""
SQL["split_count_ranking"] = _SPLITS + "SELECT * FROM r"
SQL["split_count_top15"] = _SPLITS + "SELECT * FROM r WHERE rank <= 15"
SQL["cleaning_counts"] = C + """SELECT 'loaded' AS step, count(*) AS n_rows FROM flights UNION ALL SELECT 'completed', count(*) FROM eligible
UNION ALL SELECT 'in_range', count(*) FROM in_range, sbounds WHERE ARRIVAL_DELAY BETWEEN sbounds.lo AND sbounds.hi UNION ALL SELECT 'complete', count(*) FROM cleaned"""
