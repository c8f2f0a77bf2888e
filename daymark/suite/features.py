"""Queries for features, labels, splits and future rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymark.functions.calendar import CYCLIC_NAMES, ONEHOT_NAMES, fourier
from daymark.operators import dataset, features as ops
from daymark.operators.clean import drop_null_rows
from daymark.operators.weather import forecast_at_horizon, merge_weather
from daymark.plans.training import training_table
from daymark.schema import WEATHER
from daymark.suite import inputs as i
from daymark.suite.catalog import query, rounded, rounded_sql, with_ctes
from daymark.suite.weather import MERGED, last_known_sql

S = i.SERIES
FILLED = with_ctes(i.DAILY, i.FILLED)


def cyclic_sql(day: str) -> str:
    return f"""sin(2 * pi() * (isodow({day}) - 1) / 7) AS Day_of_week_sin, cos(2 * pi() * (isodow({day}) - 1) / 7) AS Day_of_week_cos,
      sin(2 * pi() * (month({day}) - 1) / 12) AS Month_sin, cos(2 * pi() * (month({day}) - 1) / 12) AS Month_cos,
      sin(2 * pi() * (day({day}) - 1) / 31) AS Day_of_month_sin, cos(2 * pi() * (day({day}) - 1) / 31) AS Day_of_month_cos"""


def onehot_sql(day: str) -> str:
    return ", ".join(f"CAST(isodow({day}) - 1 = {k} AS INTEGER) AS Day_of_week_{k}" for k in range(1, 7))


def weekend_sql(day: str) -> str:
    return f"CAST(isodow({day}) >= 6 AS INTEGER) AS Weekend"


def calendar_sql(day: str) -> str:
    return ", ".join([cyclic_sql(day), weekend_sql(day), onehot_sql(day)])


W = 'OVER (PARTITION BY series ORDER BY "Date"'
LAG_SQL = ", ".join(f"lag(Patients_per_day, {k}) {W}) AS patients_lag_{k}" for k in ops.LAGS)
MEAN_SQL = ", ".join(
    f"avg(Patients_per_day) {W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS patients_{n}d_avg"
    for n in ops.ROLLING_WINDOWS
)
STD_SQL = ", ".join(
    f"stddev_samp(Patients_per_day) {W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS patients_{n}d_std"
    for n in ops.ROLLING_WINDOWS
)
CHANGE_SQL = f"""lag(Patients_per_day, 1) {W}) - lag(Patients_per_day, 2) {W}) AS patients_change_1d,
  lag(Patients_per_day, 7) {W}) - lag(Patients_per_day, 14) {W}) AS patients_change_7d"""
ROW_SQL = ", ".join([MEAN_SQL, STD_SQL, LAG_SQL, CHANGE_SQL])
MEANS = [f"patients_{n}d_avg" for n in ops.ROLLING_WINDOWS]
STDS = [f"patients_{n}d_std" for n in ops.ROLLING_WINDOWS]


def _features_sql(ctes: str, source: str, columns: str) -> str:
    return f"{ctes} SELECT {source}.*, {columns} FROM {source}"


@query(
    "date_parts",
    _features_sql(
        FILLED,
        "filled",
        """CAST(isodow("Date") - 1 AS INTEGER) AS Day_of_week, CAST(month("Date") AS INTEGER) AS Month,
           CAST(day("Date") AS INTEGER) AS Day_of_month""",
    ),
)
def date_parts(spark, sf):
    return ops.add_date_parts(i.filled(spark, sf))


@query("cyclic_calendar", rounded_sql(_features_sql(FILLED, "filled", cyclic_sql('"Date"')), CYCLIC_NAMES))
def cyclic_calendar(spark, sf):
    return rounded(ops.add_cyclic_calendar(i.filled(spark, sf)))


@query("onehot_weekday", _features_sql(FILLED, "filled", onehot_sql('"Date"')))
def onehot_weekday(spark, sf):
    return ops.add_onehot_weekday(i.filled(spark, sf))


@query("weekend", _features_sql(FILLED, "filled", weekend_sql('"Date"')))
def weekend(spark, sf):
    return ops.add_weekend(i.filled(spark, sf))


@query(
    "weekend_share",
    rounded_sql(
        FILLED
        + """ SELECT series, CAST(count(*) FILTER (isodow("Date") >= 6) AS BIGINT) AS n_weekend_days,
               CAST(count(*) AS BIGINT) AS n_days,
               CAST(100 AS DOUBLE) * count(*) FILTER (isodow("Date") >= 6) / count(*) AS weekend_pct
            FROM filled GROUP BY series""",
        ["weekend_pct"],
    ),
)
def weekend_share(spark, sf):
    return rounded(ops.weekend_share(i.filled(spark, sf), S))


@query(
    "calendar_at_target",
    rounded_sql(_features_sql(FILLED, "filled", calendar_sql('("Date" + 5)')), CYCLIC_NAMES),
)
def calendar_at_target(spark, sf):
    return rounded(ops.calendar_at_target(i.filled(spark, sf), 5))


def _fourier_sql() -> tuple[str, list[str]]:
    labels = {365.25: "annual", 7.0: "weekly", 3.5: "half_week", 2.3: "short_cycle"}
    harmonics = {365.25: 3, 7.0: 2, 3.5: 1, 2.3: 1}
    parts, names = [], []
    for period, label in labels.items():
        for k in range(1, harmonics[period] + 1):
            for wave in ("sin", "cos"):
                name = f"{label}_{wave}_{k}"
                t = """("Date" - min("Date") OVER (PARTITION BY series))"""
                parts.append(f"{wave}(2 * pi() * {k} * {t} / CAST({period} AS DOUBLE)) AS {name}")
                names.append(name)
    return ", ".join(parts), names


FOURIER_SQL, FOURIER_NAMES = _fourier_sql()


@query("fourier", rounded_sql(_features_sql(FILLED, "filled", FOURIER_SQL), FOURIER_NAMES))
def fourier_query(spark, sf):
    assert list(fourier(F.lit(0))) == FOURIER_NAMES
    return rounded(ops.add_fourier(i.filled(spark, sf), series_cols=S))


@query("lag_features", _features_sql(FILLED, "filled", LAG_SQL))
def lag_features(spark, sf):
    return ops.add_lags(i.filled(spark, sf), series_cols=S)


@query(
    "lagged_rolling_avg",
    rounded_sql(
        FILLED
        + f""", weekly AS (SELECT series, "Date", Patients_per_day,
               avg(Patients_per_day) {W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS Patients_per_day_7d_avg FROM filled)
            SELECT *, {LAG_SQL}, lag(Patients_per_day_7d_avg, 7) {W}) AS patients_7d_avg_lag_7 FROM weekly""",
        ["Patients_per_day_7d_avg", "patients_7d_avg_lag_7"],
    ),
)
def lagged_rolling_avg(spark, sf):
    week = ops.series_window(S).rowsBetween(-6, 0)
    weekly = i.filled(spark, sf).withColumn("Patients_per_day_7d_avg", F.avg("Patients_per_day").over(week))
    return rounded(ops.add_lags(weekly, series_cols=S))


@query("rolling_mean", rounded_sql(_features_sql(FILLED, "filled", MEAN_SQL), MEANS))
def rolling_mean(spark, sf):
    return rounded(ops.add_rolling(i.filled(spark, sf), series_cols=S, std=False))


@query("rolling_std", rounded_sql(_features_sql(FILLED, "filled", STD_SQL), STDS))
def rolling_std(spark, sf):
    return rounded(ops.add_rolling(i.filled(spark, sf), series_cols=S, mean=False))


@query("change_features", _features_sql(FILLED, "filled", ", ".join([LAG_SQL, CHANGE_SQL])))
def change_features(spark, sf):
    return ops.add_changes(ops.add_lags(i.filled(spark, sf), series_cols=S))


@query(
    "engineer_features",
    rounded_sql(
        _features_sql(FILLED, "filled", ", ".join([calendar_sql('"Date"'), ROW_SQL])), CYCLIC_NAMES + MEANS + STDS
    ),
)
def engineer_features(spark, sf):
    return rounded(ops.engineer_features(i.filled(spark, sf), series_cols=S))


@query(
    "engineer_features_rows",
    rounded_sql(
        _features_sql(with_ctes(i.DAILY), "daily", ", ".join([calendar_sql('"Date"'), FOURIER_SQL, ROW_SQL])),
        CYCLIC_NAMES + FOURIER_NAMES + MEANS + STDS,
    ),
)
def engineer_features_rows(spark, sf):
    return rounded(ops.engineer_features(i.daily(spark, sf), include_fourier=True, series_cols=S))


HORIZON_LIST = "(SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS horizon)"
BY_HORIZON = f"""base AS (SELECT filled.*, {ROW_SQL} FROM filled),
feats AS (SELECT base.*, horizon, {calendar_sql('(base."Date" + horizon)')},
    weather.Temp_Max, weather.Temp_Min, weather.Temp_Mean, weather.Precipitation, weather.Snowfall
  FROM base CROSS JOIN {HORIZON_LIST} LEFT JOIN weather ON base."Date" + horizon = weather."Date")"""
BY_HORIZON_CTES = with_ctes(i.DAILY, i.FILLED, i.WEATHER_SQL, BY_HORIZON)
FLOATS = CYCLIC_NAMES + MEANS + STDS + WEATHER


@query("engineer_for_horizon", rounded_sql(BY_HORIZON_CTES + " SELECT * FROM feats", FLOATS))
def engineer_for_horizon(spark, sf):
    return rounded(ops.engineer_for_horizons(i.filled(spark, sf), i.weather(spark, sf), series_cols=S))


def _all_known(columns: list[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


NULLABLE = [f"patients_lag_{k}" for k in ops.LAGS] + MEANS + STDS + WEATHER
CASES = " ".join(
    f'WHEN {h} THEN lead(Patients_per_day, {h}) OVER (PARTITION BY series, horizon ORDER BY "Date")' for h in range(1, 8)
)
LABELLED = f""", kept AS (SELECT * FROM feats WHERE {_all_known(NULLABLE)}),
labelled AS (SELECT * FROM (SELECT *, CAST(CASE horizon {CASES} END AS DOUBLE) AS target FROM kept) WHERE target IS NOT NULL)"""


@query(
    "shifted_target",
    BY_HORIZON_CTES + LABELLED + ' SELECT series, "Date", horizon, Patients_per_day, target FROM labelled',
)
def shifted_target(spark, sf):
    rows = ops.engineer_for_horizons(i.filled(spark, sf), i.weather(spark, sf), series_cols=S)
    labelled = dataset.training_rows(rows, S)
    return labelled.select("series", "Date", "horizon", "Patients_per_day", "target")


@query(
    "shifted_target_single",
    FILLED
    + f""" SELECT * FROM (SELECT *, CAST(lead(Patients_per_day, 7) {W}) AS DOUBLE) AS target FROM filled)
        WHERE target IS NOT NULL""",
)
def shifted_target_single(spark, sf):
    return dataset.shifted_target(i.filled(spark, sf), 7, series_cols=S)


def split_sql(source: str, keys: str, columns: str) -> str:
    return f"""SELECT {columns},
      CASE WHEN rn <= a THEN 'train' WHEN rn <= a + b THEN 'val' WHEN rn <= a + 2 * b THEN 'calib' ELSE 'test' END AS split
      FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY "Date") AS rn,
              CAST(floor(CAST(0.6 AS DOUBLE) * count(*) OVER (PARTITION BY {keys})) AS BIGINT) AS a,
              CAST(floor(CAST(0.1 AS DOUBLE) * count(*) OVER (PARTITION BY {keys})) AS BIGINT) AS b FROM {source})"""


@query(
    "temporal_split",
    FILLED + " " + split_sql("filled", "series", 'series, "Date", Patients_per_day'),
)
def temporal_split(spark, sf):
    return dataset.temporal_split(i.filled(spark, sf), series_cols=S)


@query(
    "split_sizes",
    BY_HORIZON_CTES
    + LABELLED
    + ", parts AS ("
    + split_sql("labelled", "series, horizon", 'series, horizon, "Date"')
    + """) SELECT series, horizon, split, CAST(count(*) AS BIGINT) AS n_rows, min("Date") AS first_date,
          max("Date") AS last_date FROM parts GROUP BY 1, 2, 3""",
)
def split_sizes(spark, sf):
    rows = ops.engineer_for_horizons(i.filled(spark, sf), i.weather(spark, sf), series_cols=S)
    split = dataset.temporal_split(dataset.training_rows(rows, S), series_cols=S)
    return dataset.split_sizes(split, S)


FULL = f"""full_weather AS ({last_known_sql('merged', 'series, "Date"', 'series')}),
base AS (SELECT filled.*, {ROW_SQL} FROM filled),
feats AS (SELECT base.*, horizon, {calendar_sql('(base."Date" + horizon)')},
    w.Temp_Max, w.Temp_Min, w.Temp_Mean, w.Precipitation, w.Snowfall
  FROM base CROSS JOIN {HORIZON_LIST} LEFT JOIN full_weather w
    ON base."Date" + horizon = w."Date" AND base.series = w.series)"""


@query(
    "training_table",
    rounded_sql(
        with_ctes(i.DAILY, i.FILLED, i.WEATHER_SQL, MERGED, FULL) + LABELLED + " SELECT * FROM labelled", FLOATS
    ),
)
def training_table_query(spark, sf):
    return rounded(training_table(i.filled(spark, sf), i.weather(spark, sf), S, validate=False))


LAST_SQL = """last AS (SELECT * FROM feat QUALIFY row_number() OVER (PARTITION BY series ORDER BY "Date" DESC) = 1)"""
SPREAD = f"""future AS (SELECT last.* REPLACE (last."Date" + horizon AS "Date"), horizon FROM last CROSS JOIN {HORIZON_LIST})"""
ROWS_CTES = with_ctes(
    i.DAILY, i.FILLED, f"feat AS (SELECT filled.*, {LAG_SQL}, {MEAN_SQL} FROM filled)", LAST_SQL, SPREAD
)


@query("last_known_row", rounded_sql(ROWS_CTES + " SELECT * FROM last", MEANS))
def last_known_row(spark, sf):
    return rounded(ops.last_known_row(_state(spark, sf), S))


def _state(spark, sf):
    return ops.add_rolling(ops.add_lags(i.filled(spark, sf), series_cols=S), series_cols=S, std=False)


@query("horizon_expand", rounded_sql(ROWS_CTES + " SELECT * FROM future", MEANS))
def horizon_expand(spark, sf):
    return rounded(ops.horizon_expand(_state(spark, sf), series_cols=S))


CAL_CTES = with_ctes(
    i.DAILY,
    i.FILLED,
    f"""feat AS (SELECT filled.*, {LAG_SQL}, {calendar_sql('"Date"')} FROM filled)""",
    LAST_SQL,
    SPREAD,
)
_CAL_NAMES = ", ".join([*CYCLIC_NAMES, "Weekend", *ONEHOT_NAMES])


@query(
    "calendar_at_horizon",
    rounded_sql(
        CAL_CTES + f""" SELECT future.* EXCLUDE ({_CAL_NAMES}), {calendar_sql('future."Date"')} FROM future""",
        CYCLIC_NAMES,
    ),
)
def calendar_at_horizon(spark, sf):
    base = ops.add_weekend(ops.add_date_features(ops.add_lags(i.filled(spark, sf), series_cols=S)))
    return rounded(ops.calendar_at_horizon(ops.horizon_expand(base, series_cols=S)))


# The last known state carries weather; the forecast table covers only some days.
STATE_CTES = with_ctes(
    i.DAILY,
    i.FILLED,
    i.WEATHER_SQL,
    MERGED,
    f"feat AS ({last_known_sql('merged', 'series, \"Date\", Patients_per_day', 'series')})",
    LAST_SQL,
    SPREAD,
    """forecast AS (SELECT * FROM weather WHERE day("Date") % 2 = 0)""",
)
_CHOSEN = ", ".join(f'CASE WHEN f."Date" IS NOT NULL THEN f.{c} ELSE future.{c} END AS {c}' for c in WEATHER)


@query(
    "forecast_at_horizon",
    rounded_sql(
        STATE_CTES
        + f""" SELECT future.series, future."Date", future.Patients_per_day, future.horizon, {_CHOSEN}
            FROM future LEFT JOIN forecast f ON f."Date" = future."Date" """,
        WEATHER,
    ),
)
def forecast_query(spark, sf):
    weather = i.weather(spark, sf)
    merged = merge_weather(i.filled(spark, sf), weather, series_cols=S, validate=False)
    forecast = weather.where(F.dayofmonth("Date") % 2 == 0)
    return rounded(forecast_at_horizon(ops.horizon_expand(merged, series_cols=S), forecast))


FULL_STATE = with_ctes(
    i.DAILY,
    i.FILLED,
    i.WEATHER_SQL,
    MERGED,
    f"known AS ({last_known_sql('merged', 'series, \"Date\", Patients_per_day', 'series')})",
    f"""feat AS (SELECT * FROM (SELECT known.*, {calendar_sql('"Date"')}, {ROW_SQL} FROM known) WHERE {_all_known(NULLABLE)})""",
    LAST_SQL,
    SPREAD,
    """forecast AS (SELECT * FROM weather WHERE day("Date") % 2 = 0)""",
)


@query(
    "future_features",
    rounded_sql(
        FULL_STATE
        + f""" SELECT future.* EXCLUDE ({_CAL_NAMES}, {", ".join(WEATHER)}), {calendar_sql('future."Date"')}, {_CHOSEN}
            FROM future LEFT JOIN forecast f ON f."Date" = future."Date" """,
        CYCLIC_NAMES + MEANS + STDS + WEATHER,
    ),
)
def future_features(spark, sf):
    weather = i.weather(spark, sf)
    merged = merge_weather(i.filled(spark, sf), weather, series_cols=S, validate=False)
    features = drop_null_rows(ops.engineer_features(merged, series_cols=S))
    forecast = weather.where(F.dayofmonth("Date") % 2 == 0)
    return rounded(ops.future_features(features, forecast=forecast, series_cols=S))


@query(
    "date_ops",
    FILLED
    + """ SELECT series, "Date", "Date" + 7 AS week_ahead, CAST("Date" - DATE '1995-01-01' AS INTEGER) AS age_days,
            strftime("Date", '%Y-%m-%d') AS text_day, CAST(date_trunc('month', "Date") AS DATE) AS month_start FROM filled""",
)
def date_ops(spark, sf):
    return i.filled(spark, sf).select(
        "series",
        "Date",
        F.date_add("Date", 7).alias("week_ahead"),
        F.datediff("Date", F.lit("1995-01-01").cast("date")).alias("age_days"),
        F.date_format("Date", "yyyy-MM-dd").alias("text_day"),
        F.trunc("Date", "month").alias("month_start"),
    )
