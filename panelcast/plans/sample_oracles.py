"""The sample queries again, as plain SQL for an independent engine."""

from __future__ import annotations

_H = """h AS (
  SELECT event_type AS city, date_trunc('hour', ts) AS time,
         avg(value) / CAST(0.97 AS DOUBLE) AS pm2_5,
         avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) / CAST(0.97 AS DOUBLE) AS pm10
  FROM events GROUP BY 1, 2)"""

_W = """w AS (
  SELECT event_type AS city, date_trunc('hour', ts + INTERVAL 30 MINUTE) AS time,
         avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) / CAST(1.94 AS DOUBLE) AS temperature,
         avg(user_id % 100) / CAST(0.97 AS DOUBLE) AS humidity,
         avg(event_id % 20) / CAST(0.97 AS DOUBLE) AS wind_speed,
         avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) / CAST(0.97 AS DOUBLE) + 900 AS pressure
  FROM events GROUP BY 1, 2)"""

_P = """p AS (
  SELECT a.city, a.date, a.pm2_5, a.pm10, b.temperature, b.humidity, b.wind_speed, b.pressure
  FROM (SELECT o_orderpriority AS city, CAST(o_orderdate AS DATE) AS date,
               avg(o_totalprice) / CAST(997 AS DOUBLE) AS pm2_5,
               max(o_totalprice) / CAST(997 AS DOUBLE) AS pm10
        FROM orders GROUP BY 1, 2) a
  JOIN (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS temperature,
               avg(l_discount) * CAST(997 AS DOUBLE) AS humidity,
               avg(l_tax) * CAST(97 AS DOUBLE) AS wind_speed,
               avg(l_extendedprice) / CAST(47 AS DOUBLE) AS pressure
        FROM lineitem GROUP BY 1) b ON a.date = b.date)"""

_DAY_MEANS = """d AS (
  SELECT h.city, CAST(h.time AS DATE) AS date, avg(pm2_5) AS pm2_5, avg(pm10) AS pm10,
         avg(temperature) AS temperature, avg(humidity) AS humidity,
         avg(wind_speed) AS wind_speed, avg(pressure) AS pressure, count(*) AS n_obs
  FROM h JOIN w ON h.city = w.city AND h.time = w.time GROUP BY 1, 2)"""


def _features(source: str) -> str:
    lags = ", ".join(f"lag(pm2_5, {n}) OVER o AS pm25_lag_{n}" for n in (1, 3, 7))
    means = ", ".join(
        f"CASE WHEN count(pm2_5) OVER w{n} = {n} THEN avg(pm2_5) OVER w{n} END AS pm25_rolling_{n}"
        for n in (3, 7)
    )
    leads = ", ".join(f"lead(pm2_5, {n}) OVER o AS target_{n}d" for n in (1, 2, 3))
    return f"""f AS (
  SELECT *, isodow(date) - 1 AS day_of_week, month(date) AS month, {lags}, {means}, {leads}
  FROM {source}
  WINDOW o AS (PARTITION BY city ORDER BY date),
         w3 AS (PARTITION BY city ORDER BY date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
         w7 AS (PARTITION BY city ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))"""


_T = """t AS (
  SELECT * FROM f WHERE target_1d IS NOT NULL AND target_2d IS NOT NULL AND target_3d IS NOT NULL
    AND pm25_lag_7 IS NOT NULL AND pm25_rolling_7 IS NOT NULL)"""

_HF = """hf AS (
  SELECT *, hour(time) AS hour, isodow(time) - 1 AS day_of_week, month(time) AS month,
         lag(pm2_5, 1) OVER o AS pm25_lag_1, lag(pm2_5, 24) OVER o AS pm25_lag_24,
         CASE WHEN count(pm2_5) OVER w3 = 3 THEN avg(pm2_5) OVER w3 END AS pm25_rolling_3,
         CASE WHEN count(pm2_5) OVER w24 = 24 THEN avg(pm2_5) OVER w24 END AS pm25_rolling_24,
         lead(pm2_5, 24) OVER o AS target_24h, lead(pm2_5, 48) OVER o AS target_48h,
         lead(pm2_5, 72) OVER o AS target_72h
  FROM h
  WINDOW o AS (PARTITION BY city ORDER BY time),
         w3 AS (PARTITION BY city ORDER BY time ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
         w24 AS (PARTITION BY city ORDER BY time ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))"""

_LATEST = """latest AS (
  SELECT * FROM f WHERE pm25_lag_7 IS NOT NULL AND pm25_rolling_7 IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY city ORDER BY date DESC) = 1)"""

_FORECAST = """fc AS (
  SELECT city, date AS as_of_date, 1 AS horizon, pm2_5 AS prediction FROM latest
  UNION ALL SELECT city, date, 2, pm25_rolling_3 FROM latest
  UNION ALL SELECT city, date, 3, pm25_rolling_7 FROM latest)"""

_PERSISTENCE = """s AS (
  SELECT city, date, target_1d AS actual, pm2_5 AS predicted FROM t
  WHERE date BETWEEN DATE '2000-07-01' AND DATE '2001-08-01')"""

_PREDICTED = "pr AS (\n" + "\n  UNION ALL ".join(
    f"SELECT {h} AS horizon, {i} AS listed, '{p}' AS model, target_{h}d AS actual, {p} AS predicted FROM t "
    "WHERE date BETWEEN DATE '2000-07-01' AND DATE '2001-08-01'"
    for h in (1, 2, 3)
    for i, p in enumerate(("pm25_lag_1", "pm25_rolling_3", "pm25_rolling_7"))
) + """),
scores AS (
  SELECT CAST(horizon AS BIGINT) AS horizon, CAST(listed AS BIGINT) AS listed, model, count(*) AS n,
         avg(abs(actual - predicted)) AS mae,
         sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
         1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*)) AS r2
  FROM pr GROUP BY 1, 2, 3)"""

_MEASURES = ("pm2_5", "pm10", "temperature", "humidity", "wind_speed", "pressure")
_FEATURES = ("pm25_lag_1", "pm25_lag_3", "pm25_lag_7", "pm25_rolling_3", "pm25_rolling_7")
_TARGETS = ("target_1d", "target_2d", "target_3d")


def _r(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def _band(value: str) -> str:
    return (
        f"CASE WHEN {value} <= 50 THEN 'Good' WHEN {value} <= 100 THEN 'Moderate' "
        f"WHEN {value} <= 150 THEN 'Unhealthy for Sensitive Groups' "
        f"WHEN {value} <= 200 THEN 'Unhealthy' WHEN {value} <= 300 THEN 'Very Unhealthy' "
        "ELSE 'Hazardous' END"
    )


def _colour(value: str) -> str:
    return (
        f"CASE WHEN {value} <= 50 THEN '#2ecc71' WHEN {value} <= 100 THEN '#f1c40f' "
        f"WHEN {value} <= 150 THEN '#e67e22' WHEN {value} <= 200 THEN '#e74c3c' "
        f"WHEN {value} <= 300 THEN '#8e44ad' ELSE '#7d3c3c' END"
    )


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_PANEL = (_P, _features("p"))
_TRAIN = (*_PANEL, _T)
_SERVE = (*_PANEL, _LATEST, _FORECAST)

_DERIVED = {
    "aqi_change_rate": "(pm25_lag_1 - pm25_lag_3) / 3",
    "volatility_7": "abs(pm25_lag_1 - pm25_rolling_7)",
    "wind_stagnation": "humidity / (wind_speed + 1)",
    "pressure_humidity": "pressure * humidity / 1000",
    "pm25_trend": "pm25_lag_1 - pm25_lag_7",
    "pm25_rolling_max_7": "greatest(pm25_lag_1, pm25_lag_3, pm25_lag_7, pm25_rolling_7)",
}
_BY_HORIZON = {
    1: ("aqi_change_rate",),
    2: tuple(_DERIVED),
    3: ("aqi_change_rate", "volatility_7", "wind_stagnation", "pressure_humidity"),
}


def _derived(names) -> str:
    return ", ".join(f"round({_DERIVED[n]}, 6) AS {n}" for n in names)


def _view(h: int) -> str:
    calendar = "CAST(day_of_week AS DOUBLE) AS day_of_week, CAST(month AS DOUBLE) AS month"
    return (
        _with(*_TRAIN)
        + f"SELECT city, date, {_r(*_MEASURES)}, {calendar}, {_r(*_FEATURES)}, "
        + f"{_derived(_BY_HORIZON[h])}, {_r(f'target_{h}d')} FROM t"
    )


_ALL_FEATURES = f"city, date, {_r(*_MEASURES)}, day_of_week, month, {_r(*_FEATURES, *_TARGETS)}"
_PANEL_COLUMNS = ("city", "date", *_MEASURES, "day_of_week", "month", *_FEATURES, *_TARGETS)
_PANEL_TYPES = {"city": "string", "date": "date", "day_of_week": "bigint", "month": "bigint"}

_LEVELS = {
    "1-URGENT": "city_1_urgent", "2-HIGH": "city_2_high", "3-MEDIUM": "city_3_medium",
    "4-NOT SPECIFIED": "city_4_not_specified", "5-LOW": "city_5_low",
}

ORACLES = {
    "parse_time": _with(_P)
    + """, x AS (SELECT city, strftime(date, '%Y-%m-%d') || 'T05:30' AS text FROM p)
SELECT city, text, CAST(text AS TIMESTAMP) AS time, CAST(CAST(text AS TIMESTAMP) AS DATE) AS date,
       hour(CAST(text AS TIMESTAMP)) AS hour FROM x""",
    "tag_and_union": _with(_H, _P)
    + f"""SELECT city, CAST(time AS DATE) AS date, {_r('pm2_5', 'pm10')}, 'hourly' AS feed,
       CAST(NULL AS DOUBLE) AS humidity FROM h
UNION ALL SELECT city, date, round(pm2_5, 6), CAST(NULL AS DOUBLE), 'daily', round(humidity, 6) FROM p""",
    "hourly_join": _with(_H, _W)
    + f"""SELECT h.city, h.time, {_r(*_MEASURES)}
FROM h JOIN w ON h.city = w.city AND h.time = w.time""",
    "daily_mean": _with(_H, _W, _DAY_MEANS)
    + f"SELECT city, date, {_r(*_MEASURES)}, n_obs FROM d",
    "daily_mean_of_feeds": _with(_H, _W, _DAY_MEANS)
    + f"SELECT city, date, {_r(*_MEASURES)}, n_obs FROM d",
    "panel_features": _with(_H, _W, _DAY_MEANS, _features("d"), _T)
    + f"SELECT n_obs, {_ALL_FEATURES} FROM t",
    "panel_features_gaps": _with(*_TRAIN) + f"SELECT {_ALL_FEATURES} FROM t",
    "panel_features_chunked": _with(*_TRAIN) + f"SELECT {_ALL_FEATURES} FROM t",
    "series_features_hourly": _with(_H, _HF)
    + "SELECT city, time, hour, day_of_week, month, "
    + _r("pm2_5", "pm10", "pm25_lag_1", "pm25_lag_24", "pm25_rolling_3", "pm25_rolling_24")
    + ", "
    + _r("target_24h", "target_48h", "target_72h")
    + " FROM hf WHERE pm25_lag_24 IS NOT NULL AND pm25_rolling_24 IS NOT NULL AND target_72h IS NOT NULL",
    "derived_features": _with(*_TRAIN) + f"SELECT city, date, {_derived(_DERIVED)} FROM t",
    "latest_per_key": _with(_P)
    + f"""SELECT city, date, {_r('pm2_5')}, date + 3 AS date_3d, strftime(date, '%Y-%m-%d') AS iso,
       strftime(date + 3, '%a, %b %d') AS short, strftime(date, '%A, %b %d') AS long
FROM p QUALIFY row_number() OVER (PARTITION BY city ORDER BY date DESC) = 1""",
    "onehot_keys": _with(_P)
    + "SELECT city, date, "
    + ", ".join(f"CAST(city = '{k}' AS DOUBLE) AS {v}" for k, v in _LEVELS.items())
    + " FROM p WHERE date BETWEEN DATE '2000-07-01' AND DATE '2001-08-01'",
    "feature_view_1d": _view(1),
    "feature_view_2d": _view(2),
    "feature_view_3d": _view(3),
    "time_split_counts": _with(*_TRAIN)
    + """SELECT CASE WHEN date <= DATE '2000-06-30' THEN 'train'
            WHEN date BETWEEN DATE '2000-07-01' AND DATE '2001-08-01' THEN 'test' END AS part,
       count(*) AS n, min(date) AS first, max(date) AS last FROM t GROUP BY 1""",
    "chronological_split": _with(_H, _HF)
    + """, m AS (SELECT * FROM hf WHERE target_24h IS NOT NULL AND target_48h IS NOT NULL
            AND target_72h IS NOT NULL),
ranked AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS i, count(*) OVER () AS n FROM m),
cut AS (SELECT min(time) AS cutoff FROM ranked WHERE i = CAST(floor(n * 0.8) AS BIGINT))
SELECT city, CASE WHEN time < cutoff THEN 'train' ELSE 'test' END AS part, count(*) AS n,
       min(time) AS first, max(time) AS last FROM m, cut GROUP BY 1, 2""",
    "expanding_folds": _with(_P)
    + """, days AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n
          FROM (SELECT DISTINCT date FROM p))
SELECT p.city, p.date,
       CAST(CASE WHEN i >= n - (n // 4) THEN 3 WHEN i >= n - 2 * (n // 4) THEN 2
                 WHEN i >= n - 3 * (n // 4) THEN 1 ELSE 0 END AS BIGINT) AS fold
FROM p JOIN days ON p.date = days.date""",
    "asof_filter": _with(_H)
    + f"""SELECT city, time, {_r('pm2_5')}, 'day_end' AS bound FROM h WHERE time < TIMESTAMP '2024-01-31'
UNION ALL SELECT city, time, round(pm2_5, 6), 'moment' FROM h
WHERE time <= TIMESTAMP '2024-01-30 12:00:00'""",
    "trailing_window": _with(_P)
    + f""", q AS (SELECT * FROM p WHERE date <= DATE '2001-07-20')
SELECT city, date, {_r(*_MEASURES)} FROM q WHERE date >= (SELECT max(date) FROM q) - 15""",
    "trailing_window_per_key": _with(_P)
    + f""", q AS (SELECT *, max(date) OVER (PARTITION BY city) AS last FROM p
            WHERE date <= DATE '2001-07-20')
SELECT city, date, {_r(*_MEASURES)} FROM q WHERE date >= last - 15""",
    "null_profile": _with(*_PANEL)
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM f" for c in _PANEL_COLUMNS
    ),
    "column_profile": _with(*_PANEL)
    + "\nUNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS \"column\", "
        f"'{_PANEL_TYPES.get(c, 'double')}' AS type, count({c}) AS non_null FROM f"
        for i, c in enumerate(_PANEL_COLUMNS)
    ),
    "describe_target": _with(*_TRAIN)
    + "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS "min",
  round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS "max" FROM t"""
        for c in ("target_1d", "target_3d", "pm10")
    ),
    "time_extent": _with(_H) + "SELECT min(time) AS first, max(time) AS last FROM h",
    "key_inventory": _with(_P) + "SELECT DISTINCT city FROM p",
    "drop_accounting": _with(*_TRAIN)
    + """SELECT (SELECT count(*) FROM f) AS rows_before, (SELECT count(*) FROM t) AS rows_after,
       (SELECT count(*) FROM f) - (SELECT count(*) FROM t) AS dropped""",
    "table_shape": _with(*_PANEL)
    + f"SELECT count(*) AS rows, CAST({len(_PANEL_COLUMNS)} AS BIGINT) AS columns FROM f",
    "first_last_rows": _with(_P)
    + f"""SELECT * FROM (SELECT city, date, {_r('pm2_5')}, 'first' AS "end" FROM p
               ORDER BY city, date LIMIT 10)
UNION ALL SELECT * FROM (SELECT city, date, {_r('pm2_5')}, 'last' AS "end" FROM p
               ORDER BY city DESC, date DESC LIMIT 10)""",
    "upsert_latest": _with(_P)
    + f"""SELECT city, date, round(CASE WHEN date >= DATE '2001-06-01' THEN pm2_5 + 1 ELSE pm2_5 END, 6)
       AS pm2_5, {_r(*_MEASURES[1:])} FROM p""",
    "incremental_refresh": _with(_H, _W, _DAY_MEANS)
    + f"""SELECT city, date, n_obs, {_r(*_MEASURES[1:])},
       round(CASE WHEN date BETWEEN DATE '2024-01-27' AND DATE '2024-01-30' THEN pm2_5 + 1
                  ELSE pm2_5 END, 6) AS pm2_5 FROM d""",
    "persistence_metrics": _with(*_TRAIN, _PERSISTENCE)
    + """SELECT count(*) AS n, round(avg(abs(actual - predicted)), 6) AS mae,
       round(sqrt(avg((actual - predicted) * (actual - predicted))), 6) AS rmse,
       round(1 - sum((actual - predicted) * (actual - predicted))
                 / (var_pop(actual) * count(*)), 6) AS r2 FROM s""",
    "persistence_key_mae": _with(*_TRAIN, _PERSISTENCE)
    + "SELECT city, round(avg(abs(actual - predicted)), 6) AS mae FROM s GROUP BY 1",
    "biggest_misses": _with(*_TRAIN, _PERSISTENCE)
    + f"""SELECT city, date, {_r('actual', 'predicted')}, round(actual - predicted, 6) AS error
FROM s ORDER BY abs(actual - predicted) DESC, city, date LIMIT 10""",
    "champion": _with(*_TRAIN, _PREDICTED)
    + f"""SELECT horizon, listed, model, n, {_r('mae', 'rmse', 'r2')} FROM scores
QUALIFY row_number() OVER (PARTITION BY horizon ORDER BY r2 DESC, listed) = 1""",
    "comparison_table": _with(*_TRAIN, _PREDICTED)
    + """SELECT horizon, listed, model, n, round_even(mae * 100, 0) / 100 AS mae,
       round_even(rmse * 100, 0) / 100 AS rmse, round_even(r2 * 100, 0) / 100 AS r2 FROM scores""",
    "signed_change": _with(*_TRAIN)
    + f""", x AS (SELECT city, date, {_DERIVED['pm25_trend']} AS v FROM t)
SELECT city, date, round(v, 6) AS pm25_trend, CASE WHEN v > 0 THEN 'raises' ELSE 'lowers' END AS direction,
       CASE WHEN v > 0 THEN '#e74c3c' ELSE '#2ecc71' END AS colour FROM x""",
    "log_target": _with(_P)
    + """SELECT city, date, round(ln(1 + pm2_5), 6) AS log_pm2_5,
       round(exp(ln(1 + pm2_5)) - 1, 6) AS pm2_5 FROM p""",
    "band_counts": _with(_P)
    + f"""SELECT {_band('pm2_5')} AS category, {_colour('pm2_5')} AS colour, pm2_5 > 150 AS hazard,
       count(*) AS n, CAST(sum(round_even(pm2_5, 0)) AS BIGINT) AS whole_sum FROM p GROUP BY 1, 2, 3""",
    "alerts": _with(*_SERVE)
    + "SELECT city, bool_or(prediction > 150) AS alert FROM fc GROUP BY 1",
    "forecast_table": _with(*_SERVE)
    + f"""SELECT city, as_of_date, CAST(horizon AS BIGINT) AS horizon,
       as_of_date + horizon AS target_date, strftime(as_of_date + horizon, '%a, %b %d') AS label,
       {_r('prediction')}, {_band('prediction')} AS category, {_colour('prediction')} AS colour,
       prediction > 150 AS alert FROM fc""",
    "key_comparison": _with(*_PANEL, _LATEST)
    + f"""SELECT city, CAST(round_even(pm2_5, 0) AS BIGINT) AS tomorrow,
       CAST(round_even(pm25_rolling_3, 0) AS BIGINT) AS in_2_days,
       CAST(round_even(pm25_rolling_7, 0) AS BIGINT) AS in_3_days, {_band('pm2_5')} AS status FROM latest""",
    "horizon_long": _with(*_PANEL, _LATEST)
    + f"""SELECT city, {_band('pm2_5')} AS status, 'Tomorrow' AS horizon,
       CAST(round_even(pm2_5, 0) AS BIGINT) AS value FROM latest
UNION ALL SELECT city, {_band('pm2_5')}, 'In 2 days', CAST(round_even(pm25_rolling_3, 0) AS BIGINT) FROM latest
UNION ALL SELECT city, {_band('pm2_5')}, 'In 3 days', CAST(round_even(pm25_rolling_7, 0) AS BIGINT) FROM latest""",
    "observed_plus_forecast": _with(*_SERVE)
    + """SELECT city, date, round(pm2_5, 6) AS value, 'Observed' AS series FROM p
WHERE date >= (SELECT max(date) FROM p) - 15
UNION ALL SELECT city, as_of_date + horizon, round(prediction, 6), 'Forecast' FROM fc""",
    "display_labels": _with(_P)
    + f"""SELECT city, strftime(date, '%Y-%m-%d') AS as_of, strftime(date, '%A, %b %d') AS today,
       printf('%.0f', pm2_5) AS pm2_5, {_band('pm2_5')} AS category,
       printf('%.1f', temperature) AS temperature, printf('%.0f', humidity) AS humidity,
       printf('%.1f', wind_speed) AS wind_speed, printf('%.0f', pressure) AS pressure FROM p""",
}


# --- least squares, solved in SQL ------------------------------------------------

_REDUNDANT = ("aqi_change_rate", "pm25_trend")
_KEYS = tuple(_LEVELS)


def _least_squares(h: int) -> str:
    """Gauss-Jordan elimination of the centred normal equations, a pivot a step."""
    derived = {n: _DERIVED[n] for n in _BY_HORIZON[h] if n not in _REDUNDANT}
    names = (*_MEASURES, "day_of_week", "month", *_FEATURES, *derived)
    plain = ", ".join((*_MEASURES, "day_of_week", "month", *_FEATURES))
    extra = "".join(f", {sql} AS {name}" for name, sql in derived.items())
    keys = ", ".join(
        f"CASE WHEN city = '{k}' THEN 1.0 WHEN city = '{_KEYS[-1]}' THEN -1.0 ELSE 0.0 END"
        for k in _KEYS[:-1]
    )
    vector = ", ".join(f"CAST({n} - m{h}.mean_{n} AS DOUBLE)" for n in names)
    size = len(names) + len(_KEYS)
    return f"""x{h} AS (SELECT city, date, {plain}{extra}, target_{h}d AS y FROM t),
m{h} AS (SELECT avg(y) AS mean_y, {", ".join(f"avg({n}) AS mean_{n}" for n in names)}
      FROM x{h} WHERE date <= DATE '2000-06-30'),
v{h} AS (SELECT [{vector}, {keys}, 1.0, y - mean_y]::DOUBLE[] AS v FROM x{h}, m{h}
      WHERE date <= DATE '2000-06-30'),
c{h} AS (SELECT i, j, sum(v[i] * v[j]) AS s FROM v{h}, range(1, {size + 1}) a(i), range(1, {size + 2}) b(j)
      GROUP BY 1, 2),
r{h} AS (SELECT i, list(s ORDER BY j) AS row FROM c{h} GROUP BY 1),
g{h}(k, g) AS (SELECT 0, list(row ORDER BY i) FROM r{h}
  UNION ALL SELECT k + 1, list_transform(g, lambda r, i: CASE WHEN i = k + 1
      THEN list_transform(r, lambda e: e / g[k + 1][k + 1])
      ELSE list_transform(r, lambda e, j: e - r[k + 1] * g[k + 1][j] / g[k + 1][k + 1]) END)
  FROM g{h} WHERE k < {size}),
b{h} AS (SELECT list_transform(g, lambda r: r[{size + 1}]) AS b FROM g{h} WHERE k = {size}),
z{h} AS (SELECT city, date, {plain}{extra} FROM latest),
q{h} AS (SELECT city, date AS as_of_date, {h} AS horizon, mean_y
      + list_dot_product([{vector}, {keys}, 1.0]::DOUBLE[], b) AS prediction FROM z{h}, m{h}, b{h}),
e{h} AS (SELECT city, date, y AS actual, mean_y
      + list_dot_product([{vector}, {keys}, 1.0]::DOUBLE[], b) AS predicted FROM x{h}, m{h}, b{h}
      WHERE date BETWEEN DATE '2000-07-01' AND DATE '2001-08-01')"""


_OLS = _with(*_TRAIN, _LATEST, *(_least_squares(h) for h in (1, 2, 3))).replace(
    "WITH", "WITH RECURSIVE", 1
)

ORACLES["linear_forecast"] = (
    _OLS
    + ", q AS ("
    + " UNION ALL ".join(f"SELECT * FROM q{h}" for h in (1, 2, 3))
    + f""")
SELECT city, as_of_date, CAST(horizon AS BIGINT) AS horizon, as_of_date + horizon AS target_date,
       round(prediction, 4) AS prediction, {_band('prediction')} AS category,
       prediction > 150 AS alert FROM q"""
)

ORACLES["linear_metrics"] = _OLS + "\nUNION ALL ".join(
    f"""SELECT CAST({h} AS BIGINT) AS horizon, 'linear' AS model, count(*) AS n,
       round(avg(abs(actual - predicted)), 5) AS mae,
       round(sqrt(avg((actual - predicted) * (actual - predicted))), 5) AS rmse,
       round(1 - sum((actual - predicted) * (actual - predicted))
                 / (var_pop(actual) * count(*)), 5) AS r2 FROM e{h}"""
    for h in (1, 2, 3)
)



def _day(days: int) -> str:
    """``pm2_5`` so many days later, or earlier; NULL if there is no such day."""
    return f"(SELECT q.pm2_5 FROM p q WHERE q.city IS NOT DISTINCT FROM p.city AND q.date = p.date + {days})"


def _mean_of_days(n: int) -> str:
    days = f"FROM p q WHERE q.city IS NOT DISTINCT FROM p.city AND q.date BETWEEN p.date - {n} AND p.date - 1"
    return f"(SELECT CASE WHEN count(q.pm2_5) = {n} THEN avg(q.pm2_5) END {days})"


_CALENDAR = "f AS (SELECT p.*, isodow(date) - 1 AS day_of_week, month(date) AS month, " + ", ".join(
    f"{sql} AS {name}"
    for name, sql in (
        *((f"pm25_lag_{n}", _day(-n)) for n in (1, 3, 7)),
        *((f"pm25_rolling_{n}", _mean_of_days(n)) for n in (3, 7)),
        *((f"target_{n}d", _day(n)) for n in (1, 2, 3)),
    )
) + " FROM p)"
ORACLES["panel_features_calendar"] = _with(_P, _CALENDAR, _T) + f"SELECT {_ALL_FEATURES} FROM t"


def _stump(name: str, source: str, y: str) -> str:
    """The best split of ``source`` by one of its two features, and the means on both sides."""
    return f"""{name} AS (
  SELECT k, cut, low, high FROM (
    SELECT k, cut, avg({y}) FILTER (side) AS low, avg({y}) FILTER (NOT side) AS high,
           count(*) FILTER (side) AS n_low, count(*) FILTER (NOT side) AS n_high
    FROM (SELECT k, cut, {source}.*, CASE k WHEN 1 THEN f1 ELSE f2 END <= cut AS side
          FROM {source}, cuts WHERE fitted AND cut IS NOT NULL) GROUP BY k, cut)
  ORDER BY n_low * low * low + n_high * high * high DESC, k, cut LIMIT 1)"""


def _by(name: str) -> str:
    return f"(SELECT CASE WHEN CASE k WHEN 1 THEN f1 ELSE f2 END <= cut THEN low ELSE high END FROM {name})"


ORACLES["stump_forecasts"] = _with(
    *_TRAIN,
    """x AS (SELECT city, date, date <= DATE '2000-06-30' AS fitted, CAST(day_of_week AS DOUBLE) AS f1,
         CAST(month AS DOUBLE) AS f2, target_1d AS y FROM t WHERE date <= DATE '2001-08-01')""",
    """cuts AS (SELECT k, (v + lead(v) OVER (PARTITION BY k ORDER BY v)) / 2 AS cut
         FROM (SELECT 1 AS k, f1 AS v FROM x WHERE fitted UNION SELECT 2, f2 FROM x WHERE fitted))""",
    _stump("one", "x", "y"),
    _stump("logged", "x", "ln(1 + y)"),
    f"x2 AS (SELECT *, 2 * (y - {_by('one')}) AS rest FROM x)",
    _stump("two", "x2", "rest"),
) + f"""SELECT city, date, round({_by('one')}, 4) AS forest, round(exp({_by('logged')}) - 1, 4) AS log_forest,
       round({_by('one')} + 0.1 * {_by('two')}, 4) AS boosted FROM x WHERE NOT fitted"""

_STUMPS = (
    """x AS (SELECT city, date, date <= DATE '2000-06-30' AS fitted, CAST(day_of_week AS DOUBLE) AS f1,
         CAST(month AS DOUBLE) AS f2, target_1d AS y FROM t WHERE date <= DATE '2001-08-01')""",
    """cuts AS (SELECT k, (v + lead(v) OVER (PARTITION BY k ORDER BY v)) / 2 AS cut
         FROM (SELECT 1 AS k, f1 AS v FROM x WHERE fitted UNION SELECT 2, f2 FROM x WHERE fitted))""",
)


def _credit(name: str, k: int) -> str:
    """What a stump on feature ``k`` says of a row, less its mean over the recent rows."""
    return f"(SELECT CASE WHEN k = {k} THEN {_by(name)} - (SELECT avg({_by(name)}) FROM recent2) ELSE 0 END FROM {name})"


ORACLES["stump_attribution"] = _with(
    *_TRAIN,
    *_STUMPS,
    _stump("one", "x", "y"),
    f"x2 AS (SELECT *, 2 * (y - {_by('one')}) AS rest FROM x)",
    _stump("two", "x2", "rest"),
    _LATEST,
    """recent AS (SELECT * FROM f WHERE pm25_lag_7 IS NOT NULL AND pm25_rolling_7 IS NOT NULL
         AND date >= (SELECT max(date) FROM f WHERE pm25_lag_7 IS NOT NULL AND pm25_rolling_7 IS NOT NULL) - 15)""",
    "recent2 AS (SELECT CAST(day_of_week AS DOUBLE) AS f1, CAST(month AS DOUBLE) AS f2 FROM recent)",
    "latest2 AS (SELECT city, date, CAST(day_of_week AS DOUBLE) AS f1, CAST(month AS DOUBLE) AS f2 FROM latest)",
) + " UNION ALL ".join(
    f"SELECT city, date, '{name}' AS feature, round({_credit('one', k)} + 0.1 * {_credit('two', k)}, 4) AS impact FROM latest2"
    for k, name in ((1, "day_of_week"), (2, "month"))
)


def _grown(number: int, source: str) -> list[str]:
    """A best-first tree of three leaves on ``source`` (f1, f2, r): the root's split, the better side's split, the leaves."""
    low = lambda k, cut: f"CASE {k} WHEN 1 THEN f1 ELSE f2 END <= {cut}"
    gain = "CAST(gl AS DOUBLE) * gl / nl + CAST(gh AS DOUBLE) * gh / nh - CAST(gl + gh AS DOUBLE) * (gl + gh) / (nl + nh)"

    def best(name: str, rows: str, extra: str = "") -> str:
        return f"""{name} AS (SELECT k, cut, {gain} AS gain{extra} FROM (
    SELECT k, cut, count(*) FILTER (side) AS nl, count(*) FILTER (NOT side) AS nh,
           CAST(coalesce(sum(r) FILTER (side), 0) AS BIGINT) AS gl, CAST(coalesce(sum(r) FILTER (NOT side), 0) AS BIGINT) AS gh
    FROM (SELECT k, cut, r, {low("k", "cut")} AS side FROM {rows}, steps WHERE fitted) GROUP BY k, cut)
  WHERE nl >= 20 AND nh >= 20 ORDER BY gain DESC, k, cut LIMIT 1)"""

    t = f"t{number}"
    return [
        best(f"{t}root", source),
        f"{t}low AS (SELECT * FROM {source} WHERE (SELECT {low('k', 'cut')} FROM {t}root))",
        f"{t}high AS (SELECT * FROM {source} WHERE NOT (SELECT {low('k', 'cut')} FROM {t}root))",
        best(f"{t}a", f"{t}low", ", 1 AS side"),
        best(f"{t}b", f"{t}high", ", 2 AS side"),
        f"{t}next AS (SELECT * FROM (SELECT * FROM {t}a UNION ALL SELECT * FROM {t}b) ORDER BY gain DESC, side LIMIT 1)",
        f"""{t}leaf AS (SELECT *, CASE WHEN side <> own THEN 0 WHEN {low("k2", "cut2")} THEN 1 ELSE 2 END AS leaf
  FROM (SELECT s.*, CASE WHEN {low("p.k", "p.cut")} THEN 1 ELSE 2 END AS own, n.side, n.k AS k2, n.cut AS cut2
        FROM {source} s, {t}root p, {t}next n))""",
        f"""{t}value AS (SELECT leaf, CAST(floor(0.1 * CAST(sum(r) AS DOUBLE) / count(*) + 0.5) AS BIGINT) AS v
  FROM {t}leaf WHERE fitted GROUP BY leaf)""",
        f"""{t}rest AS (SELECT city, date, fitted, f1, f2, r - v AS r, told + v AS told
  FROM {t}leaf l JOIN {t}value USING (leaf))""",
    ]


ORACLES["boosted_leafwise"] = _with(
    *_TRAIN,
    _STUMPS[0],
    """steps AS (SELECT k, v AS cut FROM (SELECT 1 AS k, f1 AS v, max(f1) OVER () AS m FROM x WHERE fitted
         UNION SELECT 2, f2, max(f2) OVER () FROM x WHERE fitted) WHERE v < m)""",
    "whole AS (SELECT *, CAST(floor(y * 1048576 + 0.5) AS BIGINT) AS w FROM x)",
    "base AS (SELECT CAST(floor(CAST(sum(w) AS DOUBLE) / count(*) + 0.5) AS BIGINT) AS b FROM whole WHERE fitted)",
    "s0 AS (SELECT city, date, fitted, f1, f2, w - b AS r, b AS told FROM whole, base)",
    *_grown(1, "s0"),
    *_grown(2, "t1rest"),
) + "SELECT city, date, round(told / 1048576.0::DOUBLE, 6) AS prediction FROM t2rest WHERE NOT fitted"


def _levels(h: int) -> str:
    """Running sums of the labels known by each day, of the key and of all keys."""
    return f"""SELECT CAST({h} AS BIGINT) AS horizon, city, date,
       round(CASE WHEN n > 0 THEN (s - n * als / aln) / (n + 1) ELSE 0 END, 6) AS level,
       round((ls - ln * ts / tn) / (ln + 1), 6) AS last_level
FROM (SELECT city, date, sum(known) OVER k AS s, count(known) OVER k AS n, sum(known) OVER d AS als, count(known) OVER d AS aln,
             sum(y) OVER c AS ls, count(y) OVER c AS ln, sum(y) OVER () AS ts, count(y) OVER () AS tn
      FROM (SELECT city, date, target_{h}d AS y, lag(target_{h}d, {h}) OVER (PARTITION BY city ORDER BY date) AS known
            FROM t WHERE date <= DATE '2000-06-30')
      WINDOW k AS (PARTITION BY city ORDER BY date), c AS (PARTITION BY city), d AS (ORDER BY date RANGE UNBOUNDED PRECEDING))"""


ORACLES["key_levels"] = _with(*_TRAIN) + "\nUNION ALL ".join(_levels(h) for h in (1, 2, 3))

ORACLES["linear_many_keys"] = """WITH r AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 <> 0 THEN l_partkey END AS part,
         CAST(l_quantity AS DOUBLE) AS q, CAST(l_discount AS DOUBLE) AS d, CAST(l_extendedprice AS DOUBLE) AS y
  FROM lineitem),
c AS (SELECT *, q - avg(q) OVER k AS cq, d - avg(d) OVER k AS cd, y - avg(y) OVER k AS cy, avg(y) OVER k AS my
  FROM r WINDOW k AS (PARTITION BY part)),
s AS (SELECT sum(cq * cq) AS qq, sum(cd * cd) AS dd, sum(cq * cd) AS qd, sum(cq * cy) AS qy, sum(cd * cy) AS dy FROM c),
w AS (SELECT (qy * dd - dy * qd) / (qq * dd - qd * qd) AS wq, (dy * qq - qy * qd) / (qq * dd - qd * qd) AS wd FROM s)
SELECT l_orderkey, l_linenumber, round(my + wq * cq + wd * cd, 3) AS prediction FROM c, w"""

ORACLES["registered_linear"] = ORACLES["linear_forecast"]

ORACLES["linear_errors"] = (
    _OLS
    + """SELECT 'mae' AS part, city, CAST(NULL AS DATE) AS date, round(avg(abs(actual - predicted)), 4) AS value
FROM e1 GROUP BY city
UNION ALL SELECT 'miss', city, date, round(actual - predicted, 4)
FROM (SELECT * FROM e1 ORDER BY abs(actual - predicted) DESC, city, date LIMIT 10)"""
    + "".join(
        f"\nUNION ALL SELECT '{part}', NULL, NULL, round({value}, 4) FROM x1 WHERE date <= DATE '2000-06-30'"
        for part, value in (
            ("mean", "avg(y)"), ("std", "stddev_samp(y)"), ("min", "min(y)"), ("p25", "quantile_cont(y, 0.25)"),
            ("p50", "quantile_cont(y, 0.5)"), ("p75", "quantile_cont(y, 0.75)"), ("max", "max(y)"),
        )
    )
)


def _impacts(h: int) -> str:
    """Weight times distance from the mean of the last 15 days, and the key's effect likewise."""
    derived = {n: _DERIVED[n] for n in _BY_HORIZON[h] if n not in _REDUNDANT}
    names = (*_MEASURES, "day_of_week", "month", *_FEATURES, *derived)
    sql = [derived.get(n, n) for n in names]
    level = " ".join(f"WHEN city = '{k}' THEN b[{len(names) + i}]" for i, k in enumerate(_KEYS[:-1], 1))
    rest = " + ".join(f"b[{len(names) + i}]" for i in range(1, len(_KEYS)))
    effect = f"CASE {level} ELSE -({rest}) END"
    one = f"list_value({', '.join(sql)})"
    return f"""SELECT CAST({h} AS BIGINT) AS horizon, city, date, unnest({[*names, 'city']}) AS feature,
       unnest(list_transform(list_append(list_transform(range(1, {len(names) + 1}), lambda i: b[i] * (v[i] - c[i])),
                             effect - usual), lambda x: round(x, 4))) AS impact
FROM (SELECT city, date, {one}::DOUBLE[] AS v, {effect} AS effect, b FROM latest, b{h}),
     (SELECT list_value({", ".join(f"avg({x})" for x in sql)}) AS c, avg({effect}) AS usual FROM recent, b{h})"""


ORACLES["linear_impacts"] = (
    _OLS
    + """, serving AS (SELECT * FROM f WHERE pm25_lag_7 IS NOT NULL AND pm25_rolling_7 IS NOT NULL),
recent AS (SELECT * FROM serving WHERE date >= (SELECT max(date) FROM serving) - 15)
"""
    + "\nUNION ALL ".join(_impacts(h) for h in (1, 2, 3))
)

ORACLES["shapley_gaps"] = (
    _with(*_PANEL, _LATEST)
    + f"SELECT city, CAST({len(_MEASURES) + 2 + len(_FEATURES) + len(_BY_HORIZON[3]) + 1} AS BIGINT) AS features, "
    + "CAST(0 AS DOUBLE) AS gap FROM latest"
)

ORACLES["key_history"] = _with(_P) + f"SELECT city, date, {_r('pm2_5', 'pm10')} FROM p WHERE city = '2-HIGH'"

# --- sources, sinks, streams ------------------------------------------------------

_WEATHER = _MEASURES[2:]

ORACLES.update(
    {
        "landing_check": _with(_H)
        + """, d AS (SELECT city, CAST(time AS DATE) AS day, count(*) AS n FROM h GROUP BY 1, 2)
SELECT CASE city WHEN 'click' THEN 'not readable' WHEN 'view' THEN 'no city' ELSE 'read' END AS outcome,
       count(*) AS documents,
       CAST(sum(n) FILTER (city NOT IN ('click', 'view')) AS BIGINT) AS hours FROM d GROUP BY 1""",
        "upsert_empty_first": _with(_P)
        + f"SELECT city, date, {_r(*_MEASURES)}, CAST(0 AS BIGINT) AS before FROM p",
        "upsert_new_column": _with(_P)
        + f"""SELECT city, date, {_r(*_MEASURES[:-1])},
       round(CASE WHEN date > DATE '2001-06-30' THEN pressure END, 6) AS pressure
FROM p WHERE date >= DATE '2001-06-01'""",
        "payload_air": _with(_H) + f"SELECT city, time, {_r('pm2_5', 'pm10')} FROM h",
        "payload_weather": _with(_W) + f"SELECT city, time, {_r(*_WEATHER)} FROM w",
        "payload_current": _with(_H)
        + f"""SELECT time, {_r('pm2_5', 'pm10')} FROM h
QUALIFY row_number() OVER (PARTITION BY city ORDER BY time DESC) = 1""",
        "csv_round_trip": _with(_P) + f"SELECT city, date, {_r(*_MEASURES)} FROM p",
        "merged_csv": _with(_H, _W)
        + f""", a AS (SELECT time, avg(pm2_5) AS pm2_5, avg(pm10) AS pm10 FROM h GROUP BY 1),
b AS (SELECT time, {", ".join(f"avg({m}) AS {m}" for m in _WEATHER)} FROM w GROUP BY 1)
SELECT a.time, {_r(*_MEASURES)} FROM a JOIN b ON a.time = b.time""",
        "key_locations": """SELECT n_name AS city, count(*) AS n,
       round(CAST(any_value(n_nationkey) AS DOUBLE) * 1.5, 6) AS lat,
       round(CAST(any_value(n_regionkey) AS DOUBLE) * 2.5, 6) AS lon
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
        "stored_tables": _with(_P)
        + """SELECT 'daily_measures' AS name, CAST(1 AS BIGINT) AS version, 'city,date' AS primary_key,
       'date' AS event_time, count(*) AS rows FROM p
UNION ALL SELECT 'daily_features', 2, 'city,date', 'date', count(*) FROM p""",
        "stream_refresh": _with(_H, _W, _DAY_MEANS)
        + f"SELECT city, date, {_r(*_MEASURES)}, n_obs FROM d",
        "stream_late_hours": _with(_H)
        + """, r AS (SELECT * FROM h
  UNION ALL SELECT city, time, pm2_5 + 100, pm10 + 100 FROM h
  WHERE CAST(time AS DATE) + INTERVAL 1 DAY > (SELECT max(time) - INTERVAL 3 DAY FROM h))
SELECT city, CAST(time AS DATE) AS date, round(avg(pm2_5), 6) AS pm2_5, round(avg(pm10), 6) AS pm10,
       count(*) AS n_obs FROM r GROUP BY 1, 2""",
        "stream_daily_mean": _with(_H)
        + f"""SELECT city, CAST(time AS DATE) AS date, round(avg(pm2_5), 6) AS pm2_5,
       round(avg(pm10), 6) AS pm10, count(*) AS n_obs FROM h GROUP BY 1, 2""",
    }
)

ORACLES["stored_features"] = (
    _with(*_PANEL)
    + f"SELECT {_ALL_FEATURES} FROM f WHERE pm25_lag_7 IS NOT NULL AND pm25_rolling_7 IS NOT NULL"
)
ORACLES["stored_features_step"] = ORACLES["stored_features"]
ORACLES["stored_trailing_window"] = ORACLES["trailing_window"]
ORACLES["aligned_columns"] = (
    _with(_H)
    + f"""SELECT city, time, {_r('pm2_5')}, CAST(0 AS DOUBLE) AS humidity, CAST(0 AS DOUBLE) AS pressure
FROM h"""
)


ORACLES["top_linear_impacts"] = (
    _OLS
    + """, serving AS (SELECT * FROM f WHERE pm25_lag_7 IS NOT NULL AND pm25_rolling_7 IS NOT NULL),
recent AS (SELECT * FROM serving WHERE date >= (SELECT max(date) FROM serving) - 15),
moved AS ("""
    + _impacts(1)
    + """)
SELECT city, date, CAST(11 - place AS INTEGER) AS place, feature, impact,
       CASE WHEN impact > 0 THEN 'raises' ELSE 'lowers' END AS direction,
       CASE WHEN impact > 0 THEN '#e74c3c' ELSE '#2ecc71' END AS colour
FROM (SELECT *, row_number() OVER (PARTITION BY city, date ORDER BY abs(impact) DESC, feature) AS place FROM moved)
WHERE place <= 10"""
)

ORACLES["background_rows"] = _with(*_PANEL) + """, serving AS (SELECT * FROM f WHERE pm25_lag_7 IS NOT NULL AND pm25_rolling_7 IS NOT NULL),
recent AS (SELECT * FROM serving WHERE date >= (SELECT max(date) FROM serving) - 15)
SELECT city, date FROM recent ORDER BY md5(city || '|' || CAST(date AS VARCHAR) || '|42'), city, date LIMIT 20"""

# --- one-split trees in the searches and comparisons ------------------------------


def _scored(actual: str, predicted: str) -> str:
    """R2 of one prediction."""
    return f"1 - sum(({actual} - {predicted}) * ({actual} - {predicted})) / (var_pop({actual}) * count(*))"


def _cuts_of(source: str) -> str:
    return f"""(SELECT k, (v + lead(v) OVER (PARTITION BY k ORDER BY v)) / 2 AS cut
         FROM (SELECT 1 AS k, f1 AS v FROM {source} WHERE fitted UNION SELECT 2, f2 FROM {source} WHERE fitted))"""


def _stump_of(name: str, source: str, y: str) -> list[str]:
    """A stump with cuts of its own rows."""
    stump = _stump(name, source, y).replace("cuts WHERE", f"{name}cuts WHERE")
    return [f"{name}cuts AS {_cuts_of(source)}", stump]


_FOLDED = (
    """x AS (SELECT date, CAST(day_of_week AS DOUBLE) AS f1, CAST(month AS DOUBLE) AS f2, target_1d AS y FROM t WHERE date <= DATE '2000-06-30')""",
    "days AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM x))",
    """folded AS (SELECT x.*, CASE WHEN i >= n - (n // 4) THEN 3 WHEN i >= n - 2 * (n // 4) THEN 2
         WHEN i >= n - 3 * (n // 4) THEN 1 ELSE 0 END AS fold FROM x JOIN days USING (date))""",
)


def _fold(k: int) -> list[str]:
    return [
        f"r{k} AS (SELECT *, fold < {k} AS fitted FROM folded WHERE fold <= {k})",
        *_stump_of(f"s{k}", f"r{k}", "y"),
        f"m{k} AS (SELECT avg(y) AS mean FROM r{k} WHERE fitted)",
        f"""v{k} AS (SELECT y, (SELECT mean FROM m{k}) AS p0, {_by(f's{k}')} AS p1 FROM r{k} WHERE NOT fitted)""",
    ]


ORACLES["stump_search"] = _with(*_TRAIN, *_FOLDED, *(part for k in (1, 2, 3) for part in _fold(k))) + "\nUNION ALL ".join(
    f"SELECT CAST({place} AS INTEGER) AS place, CAST({k} AS INTEGER) AS fold, round({_scored('y', f'p{place}')}, 6) AS r2 FROM v{k}"
    for place in (0, 1)
    for k in (1, 2, 3)
)

_HOURLY = (
    _H,
    _HF,
    """m AS (SELECT * FROM hf WHERE pm25_lag_24 IS NOT NULL AND pm25_rolling_24 IS NOT NULL AND target_72h IS NOT NULL)""",
    "ranked AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS i, count(*) OVER () AS n FROM m)",
    "cutoff AS (SELECT min(time) AS first_test FROM ranked WHERE i = CAST(floor(n * 0.8) AS BIGINT))",
    """x AS (SELECT time < first_test AS fitted, CAST(hour AS DOUBLE) AS f1, CAST(day_of_week AS DOUBLE) AS f2, target_24h, target_48h, target_72h FROM m, cutoff)""",
)


def _compared(actual: str, predicted: str) -> str:
    miss = f"({actual} - {predicted})"
    mae, rmse, r2 = f"avg(abs{miss})", f"sqrt(avg({miss} * {miss}))", _scored(actual, predicted)
    return ", ".join(f"round_even(({v}) * 100, 0) / 100 AS {n}" for v, n in ((mae, "mae"), (rmse, "rmse"), (r2, "r2")))


ORACLES["stump_sweep"] = _with(*_HOURLY, *_stump_of("s", "x", "target_24h")) + f"""
SELECT CAST(0 AS BIGINT) AS listed, count(*) AS n, {_compared('target_24h', 'p0')} FROM (SELECT *, (SELECT avg(target_24h) FROM x WHERE fitted) AS p0 FROM x WHERE NOT fitted)
UNION ALL SELECT 1, count(*), {_compared('target_24h', 'p1')} FROM (SELECT *, {_by('s')} AS p1 FROM x WHERE NOT fitted)"""

ORACLES["stump_horizons"] = _with(
    *_HOURLY, *(part for h in (24, 48, 72) for part in _stump_of(f"s{h}", "x", f"target_{h}h"))
) + "\nUNION ALL ".join(
    f"SELECT '{h}h' AS horizon, count(*) AS n, {_compared(f'target_{h}h', 'p')} FROM (SELECT *, {_by(f's{h}')} AS p FROM x WHERE NOT fitted)"
    for h in (24, 48, 72)
)

ORACLES["stream_repeated_hours"] = ORACLES["stream_daily_mean"]
ORACLES["linear_from_statistics"] = ORACLES["linear_forecast"]

ORACLES["trailing_of_silent_keys"] = _with(_P) + f""", q AS (SELECT *, max(date) OVER (PARTITION BY city) AS last FROM p
            WHERE city <> '5-LOW' OR date < DATE '1998-03-01')
SELECT city, date, {_r(*_MEASURES)} FROM q WHERE date >= last - 15"""

ORACLES["changed_features"] = ORACLES["stored_features"].replace(
    _P,
    _P.replace("p AS (", "p0 AS (", 1)
    + """,
p AS (SELECT * REPLACE (CASE WHEN city = '2-HIGH' AND date BETWEEN DATE '2001-03-01' AND DATE '2001-03-07'
                            THEN pm2_5 + 1 ELSE pm2_5 END AS pm2_5) FROM p0)""",
    1,
)
ORACLES["clustered_features"] = ORACLES["panel_features_gaps"]

ORACLES["sketched_profile"] = _with(_P) + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, CAST(count(*) - count({c}) AS BIGINT) AS nulls, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS "min", round(max({c}), 6) AS "max", TRUE AS near
FROM p WHERE date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'"""
    for c in ("pm2_5", "pm10")
)
