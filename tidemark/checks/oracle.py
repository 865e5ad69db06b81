"""The same queries as SQL on the given tables, for comparison by DuckDB."""

from __future__ import annotations

_OBS = """
obs AS (
  SELECT event_id, user_id AS city, value AS temperature, k AS humidity,
         CAST(k + 950 AS DOUBLE) AS pressure, CAST(k AS DOUBLE) / 4 AS wind_speed,
         CASE event_type WHEN 'click' THEN 'clear sky' WHEN 'view' THEN 'few clouds'
              WHEN 'signup' THEN 'light rain' WHEN 'error' THEN 'heavy rain'
              WHEN 'purchase' THEN 'mist' ELSE event_type END AS weather_condition,
         ts AS recorded_at, CAST(floor(epoch(ts)) AS BIGINT) AS recorded_dt, ts AS ingested_at,
         CASE WHEN event_type IN ('click', 'view') THEN 'stream' ELSE 'batch' END AS source
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""
_CLEAN = _OBS + """,
clean AS (
  SELECT *, CAST(recorded_at AS DATE) AS recorded_date FROM obs
  WHERE city IS NOT NULL AND recorded_dt IS NOT NULL
    AND temperature BETWEEN -80 AND 60 AND humidity BETWEEN 0 AND 100
)"""
_PLAIN = _CLEAN + """,
plain AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (PARTITION BY city, recorded_dt
                             ORDER BY ingested_at DESC NULLS LAST, source NULLS LAST) = 1
)"""
_ATTRS = """
attrs AS (
  SELECT c_custkey AS city, n_name AS country, CAST(c_nationkey AS DOUBLE) AS latitude,
         c_acctbal AS longitude
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""
_SILVER = _PLAIN + "," + _ATTRS + """,
silver AS (SELECT * FROM plain LEFT JOIN attrs USING (city))"""

_CENTS = "CAST(round(temperature * 100) AS BIGINT)"

_DAILY = _SILVER + f""",
daily AS (
  SELECT city, country, recorded_date,
         sum({_CENTS}) / count(temperature) / 100 AS avg_temperature,
         min(temperature) AS min_temperature, max(temperature) AS max_temperature,
         sum(humidity) / count(humidity) AS avg_humidity,
         sum(pressure) / count(pressure) AS avg_pressure,
         sum(wind_speed) / count(wind_speed) AS avg_wind_speed,
         count(*) AS measurement_count
  FROM silver GROUP BY city, country, recorded_date
),
dominant AS (
  SELECT city, recorded_date, weather_condition AS dominant_weather_condition
  FROM (SELECT city, recorded_date, weather_condition, count(*) AS n
        FROM silver GROUP BY city, recorded_date, weather_condition)
  QUALIFY row_number() OVER (PARTITION BY city, recorded_date
                             ORDER BY n DESC, weather_condition NULLS LAST) = 1
),
named AS (SELECT * FROM daily LEFT JOIN dominant USING (city, recorded_date))"""
_DIMS = """
dim_city AS (
  SELECT city, country, latitude, longitude,
         CAST(row_number() OVER (ORDER BY city) AS INTEGER) AS city_id
  FROM (SELECT * FROM silver
        QUALIFY row_number() OVER (PARTITION BY city ORDER BY recorded_dt, country) = 1)
),
dim_date AS (
  SELECT recorded_date, CAST(row_number() OVER (ORDER BY recorded_date) AS INTEGER) AS date_id,
         CAST(year(recorded_date) AS INTEGER) AS year,
         CAST(month(recorded_date) AS INTEGER) AS month,
         CAST(day(recorded_date) AS INTEGER) AS day
  FROM (SELECT DISTINCT recorded_date FROM silver)
)"""
_ROLLED = _DAILY + """,
scaled AS (SELECT *, CAST(round(avg_temperature * 10000) AS BIGINT) AS u FROM named),
rolled AS (
  SELECT * EXCLUDE (u, n, s, q), s / n / 10000 AS rolling_avg_temp,
         CASE WHEN n > 1 THEN sqrt(CAST(n * q - s * s AS DOUBLE) / (n * (n - 1))) / 10000 END
           AS temp_volatility
  FROM (SELECT *, count(u) OVER w AS n, sum(u) OVER w AS s, sum(u * u) OVER w AS q FROM scaled
        WINDOW w AS (PARTITION BY city ORDER BY recorded_date, country NULLS LAST
                     ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
)"""
_MONTHLY = _SILVER + f""",
monthly AS (
  SELECT city, country, strftime(recorded_date, '%Y-%m') AS year_month,
         sum({_CENTS}) / count(temperature) / 100 AS avg_temperature,
         min(temperature) AS min_temperature, max(temperature) AS max_temperature,
         sum(humidity) / count(humidity) AS avg_humidity,
         sum(wind_speed) / count(wind_speed) AS avg_wind_speed,
         count(*) AS total_measurements,
         count(DISTINCT CASE WHEN contains(lower(weather_condition), 'rain') THEN recorded_date END)
           AS rainy_day_count,
         count(DISTINCT CASE WHEN contains(lower(weather_condition), 'clear') THEN recorded_date END)
           AS clear_day_count
  FROM silver GROUP BY city, country, strftime(recorded_date, '%Y-%m')
)"""


def _grid(measure: str) -> str:
    unit = f"CAST(round({measure} * 100) AS BIGINT)"
    return f"round(sum({unit}) / count({measure})) / 100 AS {measure}"


_BUCKET = _PLAIN + f""",
bucket AS (
  SELECT city, date_trunc('hour', recorded_at) AS hour, {_grid('temperature')},
         {_grid('humidity')}, {_grid('pressure')}, {_grid('wind_speed')},
         first(weather_condition ORDER BY recorded_at, weather_condition) AS weather_condition
  FROM plain WHERE source = 'stream' GROUP BY city, date_trunc('hour', recorded_at)
)"""
_HOURLY = _BUCKET + """,
hourly AS (
  SELECT *, CAST(recorded_at AS DATE) AS recorded_date,
         CAST(round(temperature * 100) AS BIGINT) AS tu, CAST(round(humidity * 100) AS BIGINT) AS hu
  FROM (SELECT city, recorded_at, temperature, CAST(humidity AS DOUBLE) AS humidity, pressure,
               wind_speed, weather_condition FROM plain WHERE source = 'batch'
        UNION ALL
        SELECT city, hour, temperature, humidity, pressure, wind_speed, weather_condition
        FROM bucket)
)"""
_ORDER = (
    "PARTITION BY city ORDER BY recorded_at NULLS FIRST, temperature NULLS FIRST, "
    "humidity NULLS FIRST, pressure NULLS FIRST"
)


def _stats(day: int, week: int) -> str:
    return f"""
         count(tu) OVER d AS n, sum(tu) OVER d AS s, sum(tu * tu) OVER d AS q,
         count(tu) OVER k AS nk, sum(tu) OVER k AS sk,
         count(hu) OVER d AS nh, sum(hu) OVER d AS sh""", f"""
  WINDOW w AS ({_ORDER}), d AS ({_ORDER} ROWS BETWEEN {day} PRECEDING AND CURRENT ROW),
         k AS ({_ORDER} ROWS BETWEEN {week} PRECEDING AND CURRENT ROW)"""


_PARTS = """CAST(hour(recorded_at) AS INTEGER) AS hour,
         CAST(dayofweek(recorded_at) + 1 AS INTEGER) AS day_of_week,
         CAST(month(recorded_at) AS INTEGER) AS month"""
_STD = "CASE WHEN n > 1 THEN sqrt(CAST(n * q - s * s AS DOUBLE) / (n * (n - 1))) / 100 END"


def _units(name: str) -> str:
    """A mean in whole ten-thousandths, whose text is the same everywhere."""
    return f"CAST(round({name} * 10000) AS BIGINT)"


def _features(scale: int = 1) -> str:
    def lag(column: str, hours: int) -> str:
        return f"coalesce(lag({column}, {hours * scale}) OVER w, {column})"

    columns, windows = _stats(24 * scale, 168 * scale)
    return _HOURLY + f""",
windowed AS (
  SELECT *, {', '.join(f"{lag('temperature', h)} AS temp_lag_{h}h" for h in (1, 3, 6, 12, 24))},
         {lag('humidity', 1)} AS humid_lag_1h, {lag('pressure', 1)} AS pres_lag_1h, {columns}
  FROM hourly {windows}
),
features AS (
  SELECT city, recorded_at, recorded_date, temperature AS temp, humidity AS humid,
         pressure AS pres, wind_speed AS wind, weather_condition AS condition, {_PARTS},
         CAST(weekofyear(recorded_at) AS INTEGER) AS week_of_year,
         temp_lag_1h, temp_lag_3h, temp_lag_6h, temp_lag_12h, temp_lag_24h,
         humid_lag_1h, pres_lag_1h, coalesce(s / n / 100, temperature) AS temp_24h_ma,
         coalesce(sk / nk / 100, temperature) AS temp_168h_ma,
         coalesce(sh / nh / 100, humidity) AS humid_24h_ma, coalesce({_STD}, 0) AS temp_24h_std
  FROM windowed
)"""


_TRAIN_COLUMNS, _TRAIN_WINDOWS = _stats(24, 168)
_TRAINING = _HOURLY + f""",
labelled AS (
  SELECT * FROM (
    SELECT *, lead(temperature, 24) OVER w AS label_24h, lead(temperature, 6) OVER w AS label_6h,
           lead(temperature, 12) OVER w AS label_12h
    FROM hourly WINDOW w AS ({_ORDER}))
  WHERE label_24h IS NOT NULL
),
lagged AS (
  SELECT *, {', '.join(f"lag(temperature, {h}) OVER w AS temp_lag_{h}h" for h in (1, 3, 6, 24))},
         lag(humidity, 1) OVER w AS humid_lag_1h, {_TRAIN_COLUMNS}
  FROM labelled {_TRAIN_WINDOWS}
),
training AS (
  SELECT city, recorded_at, recorded_date, temperature, humidity, pressure, wind_speed,
         weather_condition, {_PARTS}, temp_lag_1h, temp_lag_3h, temp_lag_6h, temp_lag_24h,
         humid_lag_1h, s / n / 100 AS temp_24h_ma, sk / nk / 100 AS temp_168h_ma,
         sh / nh / 100 AS humid_24h_ma, {_STD} AS temp_24h_std, label_24h, label_6h, label_12h
  FROM lagged
)"""
_SCORED = _TRAINING + """,
forecasts AS (
  SELECT 'rule' AS algorithm, label_24h,
         round(temperature + CASE WHEN hour > 12 THEN 0.5 ELSE -0.5 END, 2) AS prediction
  FROM training
  UNION ALL
  SELECT 'persistence', label_24h, temperature FROM training
),
errors AS (
  SELECT algorithm, CAST(round(label_24h * 100) AS HUGEINT) AS y,
         CAST(round(prediction * 100) AS HUGEINT) - CAST(round(label_24h * 100) AS HUGEINT) AS e
  FROM forecasts
),
sums AS (
  SELECT algorithm, count(*) AS n, CAST(sum(abs(e)) AS DOUBLE) AS a, CAST(sum(e * e) AS DOUBLE) AS q,
         CAST(sum(y * y) AS DOUBLE) - CAST(sum(y) AS DOUBLE) * (CAST(sum(y) AS DOUBLE) / count(*)) AS v
  FROM errors GROUP BY algorithm
),
metrics AS (
  SELECT algorithm, a / n / 100 AS mae, sqrt(q / n) / 100 AS rmse, 1 - q / nullif(v, 0) AS r2
  FROM sums
)"""
_REQUESTS = """
requests AS (
  SELECT event_id, city, temperature, CAST(humidity AS DOUBLE) AS humidity, pressure, wind_speed,
         CAST(hour(recorded_at) AS INTEGER) AS hour,
         CAST(dayofweek(recorded_at) + 1 AS INTEGER) AS day_of_week,
         CAST(month(recorded_at) AS INTEGER) AS month,
         CASE WHEN weather_condition = 'mist' THEN temperature + 1 END AS temp_lag_1h
  FROM plain
)"""
_CORRECTIONS = _OBS + """,
base AS (
  SELECT city, recorded_dt, temperature, weather_condition, ingested_at, source FROM obs
  QUALIFY row_number() OVER (PARTITION BY city, recorded_dt
                             ORDER BY ingested_at DESC NULLS LAST, source NULLS LAST) = 1
),
batch AS (
  SELECT city, recorded_dt, temperature + 1 AS temperature, weather_condition,
         ingested_at + INTERVAL 1 DAY AS ingested_at, source
  FROM base WHERE weather_condition LIKE '%rain'
  UNION ALL
  SELECT city, recorded_dt + 86400 * 365, temperature, weather_condition,
         ingested_at + INTERVAL 1 DAY, source
  FROM base WHERE weather_condition = 'mist'
)"""
_UPSERTED = f"""WITH {_CORRECTIONS}
SELECT * FROM base b
WHERE NOT EXISTS (SELECT 1 FROM batch s WHERE s.city = b.city AND s.recorded_dt = b.recorded_dt)
UNION ALL SELECT * FROM batch"""


def _maxima(kind: str) -> str:
    return (
        f"(SELECT user_id AS city, date_trunc('hour', ts) AS hour, max(value) AS {kind} "
        f"FROM events WHERE event_type = '{kind}' GROUP BY user_id, date_trunc('hour', ts))"
    )


_ALIGNED = "SELECT * FROM " + " FULL JOIN ".join(
    _maxima(kind) + (" USING (city, hour)" if i else "")
    for i, kind in enumerate(("click", "view", "signup", "error", "purchase"))
)
_WIDE = " UNION ALL ".join(
    f"SELECT date_trunc('day', recorded_at) AS recorded_at, '{c}' AS city, "
    f"max(CASE WHEN weather_condition = '{c}' THEN temperature END) AS t, "
    f"max(CASE WHEN weather_condition = '{c}' THEN humidity END) AS h, "
    f"max(CASE WHEN weather_condition = '{c}' THEN pressure END) AS p "
    "FROM obs GROUP BY date_trunc('day', recorded_at)"
    for c in ("clear sky", "few clouds", "light rain", "heavy rain", "mist")
)


def _rule(name: str, condition: str, source: str, severity: str = "error") -> str:
    return (
        f"SELECT '{name}' AS rule, '{severity}' AS severity, "
        f"count(*) FILTER (WHERE {condition}) AS violations, "
        f"count(*) FILTER (WHERE {condition}) = 0 AS passed FROM {source}"
    )


def _rules(source: str, *rules: tuple[str, str]) -> str:
    return " UNION ALL ".join(_rule(name, condition, source) for name, condition in rules)


def _empty(source: str) -> str:
    return (
        f" UNION ALL SELECT 'table is empty', 'error', CAST(count(*) = 0 AS BIGINT), "
        f"count(*) > 0 FROM {source}"
    )


_NULL_CITY = ("city is null", "city IS NULL")
_NULL_TEMPERATURE = ("temperature is null", "temperature IS NULL")
_BAD_TEMPERATURE = ("temperature out of range", "temperature NOT BETWEEN -80 AND 60")
_BAD_HUMIDITY = ("humidity out of range", "humidity NOT BETWEEN 0 AND 100")
_MISSING = tuple(
    (f"{c} is missing", f"{c} IS NULL")
    for c in ("temperature", "humidity", "pressure", "wind_speed", "hour", "day_of_week", "month")
)
_BOUNDS = tuple(
    (f"{c} out of range", f"{c} NOT BETWEEN {low} AND {high}")
    for c, low, high in (("hour", 0, 23), ("day_of_week", 1, 7), ("month", 1, 12))
)
_TREND = (
    "city, CAST(recorded_date AS VARCHAR) AS recorded_date, avg_temperature, min_temperature, "
    "max_temperature, dominant_weather_condition"
)


def _stored(name: str, *rest: str) -> str:
    return f"coalesce({', '.join((f'l.{name}', *rest))}) AS {name}"


def _row_scaled() -> str:
    names = ("temperature", "humidity", "pressure", "wind_speed", "hour", "day_of_week", "month")
    values = [f"CAST({n} AS DOUBLE)" for n in names]
    mean = "(" + " + ".join(values) + ") / 7.0::DOUBLE"
    squares = " + ".join(f"({v} - m) * ({v} - m)" for v in values)
    scaled = ", ".join(f"round(({v} - m) / d, 6) AS scaled_{n}" for v, n in zip(values, names))
    return f"""WITH {_PLAIN},{_REQUESTS},
centred AS (SELECT *, {mean} AS m FROM requests),
spread AS (SELECT *, sqrt(({squares}) / 7.0::DOUBLE) + 1e-8 AS d FROM centred)
SELECT event_id, {scaled} FROM spread"""


def _scaled_features() -> str:
    scales = {"temperature": 100, "humidity": 1, "pressure": 1, "wind_speed": 100}
    sums = ", ".join(
        f"CAST(sum(CAST(round({c} * {k}) AS HUGEINT)) AS DOUBLE) / count({c}) / {k} AS m_{c}, "
        f"sqrt(CAST(count({c}) * sum(CAST(round({c} * {k}) AS HUGEINT) * CAST(round({c} * {k}) AS HUGEINT))"
        f" - sum(CAST(round({c} * {k}) AS HUGEINT)) * sum(CAST(round({c} * {k}) AS HUGEINT)) AS DOUBLE)"
        f" / (count({c}) * count({c}))) / {k} AS d_{c}"
        for c, k in scales.items()
    )
    columns = ", ".join(
        f"round(({c} - (SELECT m_{c} FROM params)) / (SELECT d_{c} FROM params), 6) AS scaled_{c}"
        for c in scales
    )
    return f"WITH {_PLAIN}, params AS (SELECT {sums} FROM plain) SELECT event_id, {columns} FROM plain"


def _filled(key: str, order: str) -> str:
    return f"""WITH {_OBS}
        SELECT event_id, city, weather_condition, recorded_at,
               coalesce(last_value(t IGNORE NULLS) OVER (
                 PARTITION BY {key} ORDER BY {order}
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS temperature
        FROM (SELECT *, CASE WHEN temperature BETWEEN -80 AND 60 THEN temperature END AS t FROM obs)"""


ORACLE: dict[str, str] = {
    "silver_clean": f"""WITH {_CLEAN}
        SELECT * EXCLUDE (source, ingested_at, recorded_date),
               CAST(recorded_date AS VARCHAR) AS recorded_date FROM clean""",
    "drop_accounting": f"""WITH {_OBS}
        SELECT count(*) AS rows_in, count(*) FILTER (WHERE ok) AS rows_kept,
               count(*) - count(*) FILTER (WHERE ok) AS rows_dropped
        FROM (SELECT temperature BETWEEN -80 AND 60 AND humidity BETWEEN 0 AND 100 AS ok FROM obs)""",
    "conform_union": f"""WITH {_OBS}
        SELECT event_id, CAST(city AS VARCHAR) AS city, temperature, CAST(NULL AS INTEGER) AS humidity,
               'stream' AS source, CAST(NULL AS INTEGER) AS visibility
        FROM obs WHERE source = 'stream'
        UNION ALL BY NAME
        SELECT event_id, CAST(city AS VARCHAR) AS city, pressure AS temperature, humidity,
               'batch' AS source, 1 AS visibility
        FROM obs WHERE source = 'batch'""",
    "json_extract": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
        json_extract_string(props, '$.missing') AS missing FROM events""",
    "unpivot_measures": """WITH lines AS (
          SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                 l_discount, l_tax FROM lineitem)
        SELECT * FROM lines UNPIVOT INCLUDE NULLS (
          amount FOR measure IN (l_quantity, l_extendedprice, l_discount, l_tax))""",
    "outer_align": _ALIGNED,
    "outer_align_joined": _ALIGNED,
    "entity_attributes": f"WITH {_ATTRS} SELECT user_id AS city, event_id, country, latitude, longitude "
    "FROM events LEFT JOIN attrs ON user_id = city",
    "dedup_latest": f"""WITH {_CORRECTIONS}
        SELECT * FROM (SELECT * FROM base UNION ALL SELECT * FROM batch)
        QUALIFY row_number() OVER (PARTITION BY city, recorded_dt
                                   ORDER BY ingested_at DESC NULLS LAST, source NULLS LAST) = 1""",
    "upsert_twice": _UPSERTED,
    "upsert_versioned": _UPSERTED,
    "upsert_out_of_order": f"""WITH {_CORRECTIONS}
        SELECT * FROM (SELECT * FROM base UNION ALL SELECT * FROM batch)
        QUALIFY row_number() OVER (PARTITION BY city, recorded_dt ORDER BY ingested_at DESC NULLS LAST,
                                   source NULLS LAST, temperature NULLS LAST, weather_condition NULLS LAST) = 1""",
    "daily_stats": f"""WITH {_DAILY} SELECT * EXCLUDE (recorded_date),
        CAST(recorded_date AS VARCHAR) AS recorded_date FROM daily""",
    "daily_dominant": f"""WITH {_DAILY} SELECT city, CAST(recorded_date AS VARCHAR) AS recorded_date,
        dominant_weather_condition FROM dominant""",
    "daily_rolling7": f"""WITH {_ROLLED} SELECT city, country,
        CAST(recorded_date AS VARCHAR) AS recorded_date, rolling_avg_temp, temp_volatility FROM rolled""",
    "daily_fact": f"""WITH {_ROLLED},{_DIMS}
        SELECT r.* EXCLUDE (recorded_date), CAST(r.recorded_date AS VARCHAR) AS recorded_date,
               c.city_id, d.date_id, d.year, d.month
        FROM rolled r LEFT JOIN dim_city c ON r.city = c.city
        LEFT JOIN dim_date d ON r.recorded_date = d.recorded_date""",
    "monthly_fact": f"WITH {_MONTHLY} SELECT * FROM monthly",
    "city_summary": f"""WITH {_SILVER},
        overall AS (
          SELECT city, country, sum({_CENTS}) / count(temperature) / 100 AS avg_temperature_overall,
                 count(DISTINCT recorded_date) AS total_days_tracked,
                 arg_min(latitude, recorded_dt) AS latitude, arg_min(longitude, recorded_dt) AS longitude
          FROM silver GROUP BY city, country
        ),
        latest AS (
          SELECT city, temperature AS latest_temperature, CAST(humidity AS DOUBLE) AS latest_humidity,
                 recorded_at AS latest_recorded_at
          FROM silver QUALIFY row_number() OVER (PARTITION BY city ORDER BY recorded_dt DESC) = 1
        ),
        dominant AS (
          SELECT city, weather_condition AS dominant_weather_overall
          FROM (SELECT city, weather_condition, count(*) AS n FROM silver GROUP BY ALL)
          QUALIFY row_number() OVER (PARTITION BY city ORDER BY n DESC, weather_condition NULLS LAST) = 1
        )
        SELECT * FROM overall LEFT JOIN latest USING (city) LEFT JOIN dominant USING (city)""",
    "dim_entity": f"WITH {_SILVER},{_DIMS} SELECT * FROM dim_city",
    "dim_date": f"""WITH {_SILVER},{_DIMS} SELECT * EXCLUDE (recorded_date),
        CAST(recorded_date AS VARCHAR) AS recorded_date FROM dim_date""",
    "dense_order_key": """SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) AS INTEGER)
        AS order_id FROM (SELECT DISTINCT o_orderkey FROM orders)""",
    "clustered_rewrite": f"""WITH {_DAILY},{_DIMS}
        SELECT c.city_id, d.date_id, r.city, r.measurement_count
        FROM daily r LEFT JOIN dim_city c ON r.city = c.city
        LEFT JOIN dim_date d ON r.recorded_date = d.recorded_date""",
    "partitioned_overwrite": f"""WITH {_DAILY} SELECT city, CAST(recorded_date AS VARCHAR) AS recorded_date,
        measurement_count, CAST(year(recorded_date) AS INTEGER) AS year,
        CAST(month(recorded_date) AS INTEGER) AS month FROM daily""",
    "bronze_files": f"""WITH {_OBS}, wide AS ({_WIDE})
        SELECT city, t - 273.15 AS temperature, h AS humidity, p AS pressure, recorded_at,
               CAST(floor(epoch(recorded_at)) AS BIGINT) AS recorded_dt FROM wide""",
    "hourly_bucket": f"WITH {_BUCKET} SELECT * EXCLUDE (hour), hour AS recorded_at FROM bucket",
    "hourly_series": f"""WITH {_HOURLY} SELECT * EXCLUDE (tu, hu, recorded_date),
        CAST(recorded_date AS VARCHAR) AS recorded_date FROM hourly""",
    "hourly_features": f"""WITH {_features()} SELECT * EXCLUDE (recorded_date),
        CAST(recorded_date AS VARCHAR) AS recorded_date FROM features""",
    "fine_grain_lags": f"""WITH {_features(12)} SELECT city, recorded_at, temp, temp_lag_1h, temp_lag_3h,
        temp_24h_ma, temp_168h_ma FROM features""",
    "split_series_lags": f"""WITH {_OBS}
        SELECT weather_condition, recorded_at, event_id, temperature,
               lag(temperature, 1) OVER w AS previous, lead(temperature, 2) OVER w AS next,
               count(*) OVER d AS frame_rows, max(temperature) OVER d AS frame_max
        FROM obs WINDOW w AS (PARTITION BY weather_condition ORDER BY recorded_at, event_id),
          d AS (PARTITION BY weather_condition ORDER BY recorded_at, event_id
                ROWS BETWEEN 24 PRECEDING AND CURRENT ROW)""",
    "daily_features": f"""WITH {_DAILY},
        scaled AS (SELECT *, CAST(round(avg_temperature * 10000) AS BIGINT) AS u FROM named),
        windowed AS (
          SELECT *, lag(avg_temperature, 1) OVER w AS prev_day_temp,
                 lag(avg_temperature, 7) OVER w AS prev_week_temp,
                 lag(avg_temperature, 14) OVER w AS prev_2week_temp,
                 count(u) OVER k AS n, sum(u) OVER k AS s, sum(u * u) OVER k AS q,
                 count(u) OVER m AS nm, sum(u) OVER m AS sm, count(*) OVER m AS days_30d_count
          FROM scaled
          WINDOW w AS (PARTITION BY city ORDER BY recorded_date, country NULLS LAST),
            k AS (PARTITION BY city ORDER BY recorded_date, country NULLS LAST
                  ROWS BETWEEN 7 PRECEDING AND CURRENT ROW),
            m AS (PARTITION BY city ORDER BY recorded_date, country NULLS LAST
                  ROWS BETWEEN 30 PRECEDING AND CURRENT ROW)
        )
        SELECT city, CAST(recorded_date AS VARCHAR) AS recorded_date, avg_temperature AS avg_temp,
               min_temperature AS min_temp, max_temperature AS max_temp, avg_humidity AS avg_humid,
               avg_pressure AS avg_pres, avg_wind_speed AS avg_wind,
               dominant_weather_condition AS condition, measurement_count,
               prev_day_temp, prev_week_temp, prev_2week_temp, s / n / 10000 AS temp_7d_ma,
               CASE WHEN n > 1 THEN sqrt(CAST(n * q - s * s AS DOUBLE) / (n * (n - 1))) / 10000 END
                 AS temp_7d_std,
               sm / nm / 10000 AS temp_30d_ma, days_30d_count
        FROM windowed""",
    "training_frame": f"""WITH {_TRAINING} SELECT * EXCLUDE (recorded_date),
        CAST(recorded_date AS VARCHAR) AS recorded_date FROM training""",
    "forward_fill": _filled("city", "recorded_at"),
    "forward_fill_split": _filled("weather_condition", "recorded_at, event_id"),
    "quality_rules": f"WITH {_OBS} "
    + _rules("obs", _NULL_CITY, _NULL_TEMPERATURE, _BAD_TEMPERATURE, _BAD_HUMIDITY),
    "quality_bronze": f"""WITH {_OBS} SELECT count(*) AS records,
        count(*) FILTER (WHERE city IS NULL) AS null_entity,
        count(*) FILTER (WHERE recorded_dt IS NULL) AS null_instant,
        max(ingested_at) AS latest_ingested FROM obs""",
    "quality_silver": f"WITH {_PLAIN} "
    + _rules("plain", _BAD_TEMPERATURE, _BAD_HUMIDITY, _NULL_CITY)
    + _empty("plain"),
    "quality_gold": f"WITH {_DAILY} "
    + _rules(
        "daily",
        ("min <= avg <= max", "min_temperature > avg_temperature OR avg_temperature > max_temperature"),
    )
    + _empty("daily"),
    "quality_requests": f"WITH {_PLAIN},{_REQUESTS} " + _rules("requests", *_MISSING, *_BOUNDS),
    "reconcile": f"""WITH {_DAILY} SELECT fact_total, detail_rows, fact_total = detail_rows AS matches
        FROM (SELECT CAST(sum(measurement_count) AS BIGINT) AS fact_total,
                     (SELECT count(*) FROM plain) AS detail_rows FROM daily)""",
    "newest_daily": f"WITH {_DAILY} SELECT {_TREND} FROM (SELECT * FROM named "
    "ORDER BY recorded_date DESC, city, country LIMIT 10)",
    "newest_months": f"""WITH {_MONTHLY} SELECT city, year_month, avg_temperature, rainy_day_count,
        clear_day_count, total_measurements FROM monthly
        ORDER BY year_month DESC, city, country LIMIT 12""",
    "trend_all": f"WITH {_DAILY} SELECT {_TREND} FROM named",
    "trend_since": f"WITH {_DAILY} SELECT {_TREND} FROM named WHERE named.recorded_date >= DATE '2024-01-15'",
    "seasonal_pattern": f"""WITH {_MONTHLY} SELECT city, year_month, avg_temperature, rainy_day_count,
        clear_day_count FROM monthly""",
    "star_year_month": f"""WITH {_DAILY},{_DIMS}
        SELECT d.year, d.month, sum(CAST(round(avg_temperature * 10000) AS BIGINT))
               / count(avg_temperature) / 10000 AS avg_temp
        FROM daily f JOIN dim_date d ON f.recorded_date = d.recorded_date
        GROUP BY d.year, d.month ORDER BY d.year DESC, d.month DESC LIMIT 12""",
    "table_profile": f"""WITH {_OBS} SELECT count(*) AS total_records, min(recorded_at) AS earliest,
        max(recorded_at) AS latest, count(DISTINCT city) AS num_cities FROM obs""",
    "rows_per_day": """SELECT CAST(day AS VARCHAR) AS day, records FROM (
        SELECT CAST(ts AS DATE) AS day, count(*) AS records FROM events
        GROUP BY CAST(ts AS DATE) ORDER BY 1 DESC LIMIT 7)""",
    "newest_rows": f"""WITH {_PLAIN} SELECT city, temperature, humidity, wind_speed, weather_condition,
        recorded_at, source FROM plain ORDER BY recorded_at DESC, city LIMIT 10""",
    "layer_counts": f"""WITH {_PLAIN}
        SELECT 'bronze_batch' AS layer, count(*) AS records FROM obs WHERE source = 'batch'
        UNION ALL SELECT 'bronze_streaming', count(*) FROM obs WHERE source = 'stream'
        UNION ALL SELECT 'silver', count(*) FROM plain""",
    "source_coverage": f"""WITH {_PLAIN} SELECT source, count(*) AS records, min(recorded_at) AS earliest,
        max(recorded_at) AS latest FROM plain GROUP BY source""",
    "year_average": f"""WITH {_MONTHLY}
        SELECT sum(CAST(round(avg_temperature * 10000) AS BIGINT)) / count(avg_temperature) / 10000
               AS avg_temperature FROM monthly WHERE year_month LIKE '2024%'""",
    "silver_row_count": f"WITH {_PLAIN} SELECT count(*) AS records FROM plain",
    "dimension_dump": f"""WITH {_SILVER},{_DIMS} SELECT * EXCLUDE (recorded_date),
        CAST(recorded_date AS VARCHAR) AS recorded_date
        FROM (SELECT * FROM dim_date ORDER BY date_id LIMIT 10)""",
    "latest_online_row": f"""WITH {_features()}
        SELECT 'feature:hourly_weather:latest:' || city AS key,
               to_json({{'temp': temp, 'humid': humid, 'pres': pres, 'wind': wind, 'condition': condition,
                 'hour': hour, 'day_of_week': day_of_week, 'month': month, 'week_of_year': week_of_year,
                 'temp_lag_1h': temp_lag_1h, 'temp_lag_3h': temp_lag_3h, 'temp_lag_6h': temp_lag_6h,
                 'temp_lag_12h': temp_lag_12h, 'temp_lag_24h': temp_lag_24h,
                 'humid_lag_1h': humid_lag_1h, 'pres_lag_1h': pres_lag_1h,
                 'temp_24h_ma': {_units('temp_24h_ma')}, 'temp_168h_ma': {_units('temp_168h_ma')},
                 'humid_24h_ma': {_units('humid_24h_ma')}, 'temp_24h_std': {_units('temp_24h_std')}}})::VARCHAR AS features,
               rtrim(rtrim(strftime(recorded_at, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') AS updated_at, city
        FROM features
        QUALIFY row_number() OVER (PARTITION BY city ORDER BY recorded_at DESC, temp NULLS LAST,
                                   humid NULLS LAST) = 1""",
    "category_codes": f"""WITH {_OBS},
        known AS (SELECT CASE WHEN weather_condition <> 'mist' THEN weather_condition END
                  AS weather_condition FROM obs),
        codes AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS code
                  FROM (SELECT DISTINCT coalesce(weather_condition, 'Unknown') AS c FROM known))
        SELECT weather_condition, CAST(code AS INTEGER) AS code, count(*) AS n
        FROM known JOIN codes ON c = coalesce(weather_condition, 'Unknown')
        GROUP BY weather_condition, code""",
    "scaled_features": _scaled_features(),
    "eval_metrics": f"WITH {_SCORED} SELECT * FROM metrics",
    "best_model": f"WITH {_SCORED} SELECT arg_max(algorithm, r2) AS algorithm, max(r2) AS r2 FROM metrics",
    "ridge_fit": f"""WITH {_TRAINING},
        sums AS (SELECT count(*) AS n, covar_pop(temperature, label_24h) AS cxy,
                        var_pop(temperature) AS vx, avg(temperature) AS mx, avg(label_24h) AS my
                 FROM training)
        SELECT n, round(cxy * n / (vx * n + 1), 6) AS coefficient,
               round(my - mx * cxy * n / (vx * n + 1), 6) AS intercept FROM sums""",
    "request_defaults": f"""WITH {_features()},{_REQUESTS},
        latest AS (
          SELECT * FROM features
          QUALIFY row_number() OVER (PARTITION BY city ORDER BY recorded_at DESC, temp NULLS LAST,
                                     humid NULLS LAST) = 1
        )
        SELECT r.* EXCLUDE (temp_lag_1h),
               coalesce(r.temp_lag_1h, l.temp_lag_1h, r.temperature, 20.0) AS temp_lag_1h,
               {_stored('temp_lag_3h', 'r.temperature')}, {_stored('temp_lag_6h', 'r.temperature')},
               {_stored('temp_lag_24h', 'r.temperature')}, {_stored('temp_24h_ma', 'r.temperature')},
               {_stored('temp_168h_ma', 'r.temperature')}, {_stored('humid_lag_1h', 'r.humidity')},
               {_stored('humid_24h_ma', 'r.humidity')}, {_stored('temp_24h_std', '2.0')},
               0 AS condition_encoded
        FROM requests r LEFT JOIN latest l ON r.city = l.city""",
    "fallback_forecast": f"""WITH {_PLAIN},{_REQUESTS},
        p AS (SELECT event_id, temperature + CASE WHEN hour > 12 THEN 0.5 ELSE -0.5 END AS p FROM requests)
        SELECT event_id, round(p, 2) AS predicted_temperature_24h, round(p - 2, 2) AS confidence_lower,
               round(p + 2, 2) AS confidence_upper, 'fallback' AS model_version FROM p""",
    "confidence_band": f"""WITH {_PLAIN},{_REQUESTS},
        p AS (SELECT event_id, temperature AS t,
                     temperature * CAST(0.8731547 AS DOUBLE) + CAST(1.5 AS DOUBLE) AS p FROM requests),
        b AS (SELECT *, CAST(1.96 AS DOUBLE) * (abs(p - t) * CAST(0.15 AS DOUBLE)) AS w FROM p)
        SELECT event_id, round(p, 2) AS predicted_temperature_24h, round(p - w, 2) AS confidence_lower,
               round(p + w, 2) AS confidence_upper FROM b""",
    "row_standardise": _row_scaled(),
    "stream_parse": f"""WITH {_OBS}
        SELECT CAST(city AS VARCHAR) AS city, source AS country, temperature, humidity, pressure, wind_speed,
               weather_condition, make_timestamp(recorded_dt * 1000000) AS recorded_at, recorded_dt FROM obs
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM events""",
    # Messages of one second carry no finer order, so the lower reading stays.
    "stream_silver": f"""WITH {_CLEAN} SELECT CAST(city AS VARCHAR) AS city, recorded_dt,
        CAST(recorded_date AS VARCHAR) AS recorded_date, temperature, humidity FROM clean
        QUALIFY row_number() OVER (PARTITION BY city, recorded_dt ORDER BY temperature, humidity) = 1""",
    "stream_hourly": f"""WITH {_CLEAN} SELECT CAST(city AS VARCHAR) AS city,
        date_trunc('hour', recorded_at) AS recorded_at, count(*) AS readings,
        max(temperature) AS max_temperature, CAST(sum(humidity) AS BIGINT) AS sum_humidity
        FROM clean GROUP BY city, date_trunc('hour', recorded_at)""",
    "newest_messages": f"""WITH {_OBS} SELECT CAST(city AS VARCHAR) AS city, temperature, humidity, wind_speed,
        make_timestamp(recorded_dt * 1000000) AS recorded_at,
        make_timestamp(recorded_dt * 1000000) AS ingested_at
        FROM obs ORDER BY recorded_dt DESC, CAST(city AS VARCHAR) LIMIT 10""",
    "stream_profile": f"""WITH {_OBS} SELECT count(*) AS total_records,
        make_timestamp(min(recorded_dt) * 1000000) AS earliest_record,
        make_timestamp(max(recorded_dt) * 1000000) AS latest_record,
        make_timestamp(max(recorded_dt) * 1000000) AS last_ingested FROM obs""",
}

ORACLE["features_after_late_day"] = ORACLE["hourly_features"]
ORACLE["training_after_late_day"] = ORACLE["training_frame"]
ORACLE["hash_split_counts"] = f"""WITH {_OBS}
    SELECT weather_condition, CAST('0x' || substr(md5('42|' || event_id), 1, 8) AS BIGINT) % 1000 < 800 AS training,
           count(*) AS n
    FROM obs GROUP BY ALL"""
ORACLE["tree_scores"] = f"""WITH {_TRAINING},
    cents AS (SELECT hour, CAST(round(label_24h * 100) AS BIGINT) AS y, label_24h FROM training),
    byhour AS (SELECT hour, count(*) AS n, sum(y) AS s FROM cents GROUP BY hour),
    sides AS (SELECT hour AS cut, CAST(sum(n) OVER w AS BIGINT) AS nl, CAST(sum(s) OVER w AS DOUBLE) AS sl,
                     CAST(sum(n) OVER () - sum(n) OVER w AS BIGINT) AS nr,
                     CAST(sum(s) OVER () - sum(s) OVER w AS DOUBLE) AS sr
              FROM byhour WINDOW w AS (ORDER BY hour)),
    best AS (SELECT cut, nl AS rows_left, nr AS rows_right, sl / nl / 100 AS mean_left, sr / nr / 100 AS mean_right
             FROM sides WHERE nr > 0 ORDER BY sl * sl / nl + sr * sr / nr DESC, cut LIMIT 1),
    mae AS (SELECT avg(abs(CASE WHEN hour <= cut THEN mean_left ELSE mean_right END - label_24h)) AS mae
            FROM cents, best)
    SELECT algorithm, cut, rows_left, rows_right, round(mean_left, 6) AS mean_left,
           round(mean_right, 6) AS mean_right, round(mae, 6) AS mae
    FROM best, mae, (VALUES ('RandomForest'), ('GradientBoosting'), ('exact')) AS t(algorithm)"""
ORACLE["model_versions"] = f"""WITH {_SCORED}
    SELECT 'weather-forecast-model' AS name, CAST(version AS INTEGER) AS version, stage, status, algorithm,
           mae, rmse, r2, 'models/' || algorithm AS path, stage <> 'Archived' AS newest_in_stage
    FROM metrics JOIN (VALUES (1, 'rule', 'Archived', 'production'), (2, 'persistence', 'Production', 'production'),
                              (3, 'rule', 'Staging', '')) AS t(version, algorithm, stage, status) USING (algorithm)"""
ORACLE["forecast_requests"] = f"""WITH {_features()},{_TRAINING.removeprefix(_HOURLY).lstrip(",")},{_REQUESTS},
    sums AS (SELECT count(*) AS n, covar_pop(temperature, label_24h) AS cxy, var_pop(temperature) AS vx,
                    avg(temperature) AS mx, avg(label_24h) AS my FROM training),
    line AS (SELECT cxy * n / (vx * n + 1) AS slope, my - mx * cxy * n / (vx * n + 1) AS base FROM sums),
    codes AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS code
              FROM (SELECT DISTINCT coalesce(weather_condition, 'Unknown') AS c FROM training)),
    latest AS (SELECT city, condition FROM features
               QUALIFY row_number() OVER (PARTITION BY city ORDER BY recorded_at DESC, temp NULLS LAST,
                                          humid NULLS LAST) = 1),
    asked AS (SELECT r.event_id, r.temperature, p.source = 'stream' AND r.hour > 21 AS refused,
                     CAST(CASE WHEN p.weather_condition = 'mist' THEN 9 WHEN l.condition IS NULL THEN 0
                          ELSE coalesce(code, (SELECT count(*) FROM codes)) END AS INTEGER) AS code
              FROM requests r JOIN plain p USING (event_id) LEFT JOIN latest l ON l.city = r.city
              LEFT JOIN codes ON c = l.condition),
    scored AS (SELECT *, slope * temperature + base AS p FROM asked, line)
    SELECT event_id, CASE WHEN NOT refused THEN round(p, 2) END AS predicted_temperature_24h,
           CASE WHEN NOT refused THEN round(p - 1.96::DOUBLE * abs(p - temperature) * 0.15::DOUBLE, 2) END AS confidence_lower,
           CASE WHEN NOT refused THEN round(p + 1.96::DOUBLE * abs(p - temperature) * 0.15::DOUBLE, 2) END AS confidence_upper,
           CASE WHEN NOT refused THEN code END AS condition_encoded,
           CASE WHEN NOT refused THEN '1' END AS model_version,
           CASE WHEN refused THEN 'hour out of range' END AS rejected_by FROM scored"""
ORACLE["distinct_estimates"] = f"""WITH {_PLAIN}
    SELECT strftime(recorded_at, '%Y-%m') AS year_month, weather_condition, count(*) AS measurements,
           count(DISTINCT city) AS exact_cities, true AS within_5_percent
    FROM plain GROUP BY ALL"""
# The late readings of the second landing are missing; those sent again in the third are there twice.
ORACLE["stream_dedup"] = f"""WITH {_OBS}
    SELECT event_id, recorded_at AS sent_at, temperature FROM obs
    UNION ALL
    SELECT event_id, recorded_at + INTERVAL 14 DAY, temperature FROM obs
    WHERE recorded_at >= '2024-01-11' AND recorded_at <= '2024-01-12 23:59:59'"""
ORACLE["bronze_incremental"] = ORACLE["bronze_files"]
ORACLE["stream_restart"] = f"""WITH {_OBS}
    SELECT CAST(city AS VARCHAR) AS city, recorded_dt, temperature, true AS stamped FROM obs
    UNION ALL SELECT NULL, NULL, NULL, true FROM events"""
ORACLE["city_file"] = """SELECT CAST(c_custkey AS VARCHAR) AS city, n_name AS country,
    CAST(c_nationkey AS DOUBLE) AS latitude, c_acctbal AS longitude
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey"""
ORACLE["entity_rows"] = f"""WITH {_CLEAN} SELECT 'one' AS asked, city, event_id FROM clean WHERE city = 7
    UNION ALL SELECT 'some', city, event_id FROM clean WHERE city IN (11, 42, 101)"""
ORACLE["stored_tables"] = f"""WITH {_OBS}
    SELECT 'checked_batch' AS name, true AS present, true AS usable, true AS listed, count(*) AS records
    FROM obs WHERE source = 'batch'
    UNION ALL SELECT 'checked_stream', true, true, true, count(*) FROM obs WHERE source = 'stream'
    UNION ALL SELECT 'checked_empty', true, false, true, 0
    UNION ALL SELECT 'checked_absent', false, false, false, NULL"""
ORACLE["layer_summary"] = f"""WITH {_PLAIN},
    layers AS (SELECT 'bronze_batch' AS layer, '' AS missing_columns, city, recorded_dt, ingested_at FROM obs WHERE source = 'batch'
               UNION ALL SELECT 'bronze_streaming', 'pressure', city, recorded_dt, ingested_at FROM obs WHERE source = 'stream'
               UNION ALL SELECT 'silver', '', city, recorded_dt, ingested_at FROM plain)
    SELECT layer, missing_columns, count(*) AS records, count(*) FILTER (city IS NULL) AS null_entity,
           count(*) FILTER (recorded_dt IS NULL) AS null_instant, count(DISTINCT city) AS cities,
           max(recorded_dt) AS newest_record, max(ingested_at) AS latest_ingested
    FROM layers GROUP BY ALL
    UNION ALL SELECT 'gold', NULL, NULL, NULL, NULL, NULL, NULL, NULL"""
