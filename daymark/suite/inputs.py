"""How the given tables stand in for visits, weather, scores, predictions, registry and metrics.

Each input is a Spark frame and a SQL common table expression with the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.operators.clean import daily_counts
from daymark.operators.gaps import gap_fill
from daymark.schema import DATE, HORIZONS, KEY, TARGET, TIME, series_window

SERIES = ["series"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- visits: an order is a visit, reported once per line item, so most rows are repeats ----


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    joined = items.join(orders, items.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.col("o_orderpriority").alias("series"),
        F.col("o_orderkey").cast("string").alias(KEY),
        F.col("o_orderdate").alias(TIME),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )


VISITS = """visits AS (
  SELECT o_orderpriority AS series, CAST(o_orderkey AS VARCHAR) AS Surrogate_Key,
         o_orderdate AS Contact_Start, l_linenumber, l_partkey, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ONCE = """once AS (SELECT DISTINCT series, Surrogate_Key, Contact_Start FROM visits)"""


# ---- daily series: orders per day and priority ----


def order_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("series"),
        F.col("o_orderkey").cast("string").alias(KEY),
        F.col("o_orderdate").alias(TIME),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per priority, with gaps."""
    return daily_counts(order_visits(spark, sf_dir), SERIES)


DAILY = """daily AS (
  SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS "Date",
         CAST(count(*) AS BIGINT) AS Patients_per_day
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2)"""


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gap_fill(daily(spark, sf_dir), SERIES)


FILLED = """spans AS (SELECT series, min("Date") AS d0, max("Date") AS d1 FROM daily GROUP BY series),
days AS (SELECT series, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS "Date" FROM spans),
wmed AS (SELECT series, isodow("Date") AS wd, quantile_cont(Patients_per_day, 0.5) AS m FROM daily GROUP BY 1, 2),
omed AS (SELECT series, quantile_cont(Patients_per_day, 0.5) AS m FROM daily GROUP BY 1),
filled AS (
  SELECT days.series, days."Date",
         CAST(trunc(coalesce(daily.Patients_per_day, wmed.m, omed.m)) AS BIGINT) AS Patients_per_day
  FROM days
  LEFT JOIN daily ON daily.series = days.series AND daily."Date" = days."Date"
  LEFT JOIN wmed ON wmed.series = days.series AND wmed.wd = isodow(days."Date")
  LEFT JOIN omed ON omed.series = days.series)"""


# ---- weather: line items per shipping day, without every 17th day of the year ----


def _percent(column: str):
    return F.round(F.col(column) * 100).cast("int")


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather with holes to fill."""
    return weather_of_all_days(spark, sf_dir).where(F.dayofyear(DATE) % 17 != 0)


def weather_of_all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("l_shipdate")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(day.alias(DATE))
        .agg(
            F.max(_percent("l_discount")).cast("double").alias("Temp_Max"),
            F.min(_percent("l_discount")).cast("double").alias("Temp_Min"),
            F.avg(_percent("l_discount")).alias("Temp_Mean"),
            F.sum("l_quantity").alias("Precipitation"),
            F.avg(_percent("l_tax")).alias("Snowfall"),
        )
    )


WEATHER_SQL = """weather AS (
  SELECT CAST(l_shipdate AS DATE) AS "Date",
         CAST(max(CAST(round(l_discount * 100) AS INTEGER)) AS DOUBLE) AS Temp_Max,
         CAST(min(CAST(round(l_discount * 100) AS INTEGER)) AS DOUBLE) AS Temp_Min,
         avg(CAST(round(l_discount * 100) AS INTEGER)) AS Temp_Mean,
         sum(l_quantity) AS Precipitation,
         avg(CAST(round(l_tax * 100) AS INTEGER)) AS Snowfall
  FROM lineitem WHERE dayofyear(CAST(l_shipdate AS DATE)) % 17 <> 0 GROUP BY 1)"""
WEATHER_OF_ALL_DAYS_SQL = WEATHER_SQL.replace("WHERE dayofyear(CAST(l_shipdate AS DATE)) % 17 <> 0 ", "")


# ---- scores: every line item is a scored row, its line number the horizon ----


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    predicted = (F.lit(25) + (_percent("l_tax") - 4) * 2).cast("double")
    return items.select(
        F.col("l_linenumber").alias("horizon"),
        F.col("l_quantity").alias("actual"),
        predicted.alias("predicted"),
        (predicted - 15 - _percent("l_discount")).alias("lower_bound"),
        (predicted + 15 + _percent("l_discount")).alias("upper_bound"),
    )


SCORES = """scores AS (
  SELECT l_linenumber AS horizon, l_quantity AS actual,
         CAST(25 + (CAST(round(l_tax * 100) AS INTEGER) - 4) * 2 AS DOUBLE) AS predicted,
         CAST(25 + (CAST(round(l_tax * 100) AS INTEGER) - 4) * 2 - 15 - CAST(round(l_discount * 100) AS INTEGER) AS DOUBLE) AS lower_bound,
         CAST(25 + (CAST(round(l_tax * 100) AS INTEGER) - 4) * 2 + 15 + CAST(round(l_discount * 100) AS INTEGER) AS DOUBLE) AS upper_bound
  FROM lineitem)"""


# ---- predictions: each series day, predicted 1 to 7 days before by its count a week earlier ----


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = daily(spark, sf_dir).withColumn("_week", F.lag(TARGET, 7).over(series_window(SERIES)))
    point = F.col("_week") + (F.col("horizon") - 4) * 0.5
    reach = F.lit(1.0) + F.col("horizon") * 0.5
    return (
        days.where(F.col("_week").isNotNull())
        .withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in HORIZONS])))
        .select(
            "series",
            F.date_sub(DATE, F.col("horizon")).cast("timestamp_ntz").alias("prediction_timestamp"),
            F.col(DATE).alias("prediction_date"),
            "horizon",
            F.concat(F.lit("v"), F.col("horizon").cast("string")).alias("model_version"),
            point.cast("double").alias("point_prediction"),
            (point - reach).cast("double").alias("lower_bound"),
            (point + reach).cast("double").alias("upper_bound"),
        )
    )


PREDICTIONS = """weekly AS (
  SELECT series, "Date", lag(Patients_per_day, 7) OVER (PARTITION BY series ORDER BY "Date") AS wk FROM daily),
predictions AS (
  SELECT series, CAST("Date" - horizon AS TIMESTAMP) AS prediction_timestamp, "Date" AS prediction_date, horizon,
         'v' || CAST(horizon AS VARCHAR) AS model_version,
         CAST(wk + (horizon - 4) * 0.5 AS DOUBLE) AS point_prediction,
         CAST(wk + (horizon - 4) * 0.5 - 1 - horizon * 0.5 AS DOUBLE) AS lower_bound,
         CAST(wk + (horizon - 4) * 0.5 + 1 + horizon * 0.5 AS DOUBLE) AS upper_bound
  FROM weekly, (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS horizon) WHERE wk IS NOT NULL)"""


def actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily(spark, sf_dir).select(
        "series", F.col(DATE).alias("date"), F.col(TARGET).alias("patient_count")
    )


ACTUALS = """actuals AS (SELECT series, "Date" AS date, Patients_per_day AS patient_count FROM daily)"""


# ---- registry: an order is a model version of its priority ----


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.floor("o_totalprice").cast("bigint").cast("string")
    key = F.col("o_orderkey")
    tags = (
        F.when(key % 3 == 0, F.create_map(F.lit("mae"), price))
        .when(key % 3 == 1, F.create_map(F.lit("mae"), F.lit(""), F.lit("test_mae"), price))
        .otherwise(F.create_map(F.lit("owner"), F.lit("batch")))
    )
    stage = (
        F.when(F.col("o_orderstatus") == "P", "Production")
        .when(F.col("o_orderstatus") == "F", "Staging")
        .otherwise("None")
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("daily_forecast_"), "o_orderpriority").alias("model_name"),
        (key + 1).alias("version"),
        stage.alias("stage"),
        tags.alias("tags"),
        F.lit(None).cast("string").alias("description"),
        F.concat(F.lit("models/"), key.cast("string")).alias("path"),
    )


REGISTRY = """registry AS (
  SELECT 'daily_forecast_' || o_orderpriority AS model_name, o_orderkey + 1 AS version,
         CASE o_orderstatus WHEN 'P' THEN 'Production' WHEN 'F' THEN 'Staging' ELSE 'None' END AS stage,
         CASE WHEN o_orderkey % 3 IN (0, 1) THEN CAST(floor(o_totalprice) AS DOUBLE) END AS mae_tag,
         CAST(NULL AS VARCHAR) AS description, 'models/' || CAST(o_orderkey AS VARCHAR) AS path
  FROM orders),
live AS (
  SELECT model_name, max(version) AS version, max_by(mae_tag, version) AS mae_tag, max_by(path, version) AS path
  FROM (SELECT model_name, version, coalesce(mae_tag, CAST('nan' AS DOUBLE)) AS mae_tag, path FROM registry WHERE stage = 'Production')
  GROUP BY model_name)"""

# Model names of the registry by position, the last one unknown to it.
MODEL_NAMES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NEW"]


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate models: one per customer, for one of six model names."""
    names = F.array(*[F.lit(f"daily_forecast_{n}") for n in MODEL_NAMES])
    return table(spark, sf_dir, "customer").select(
        F.element_at(names, F.col("c_nationkey") % 6 + 1).alias("model_name"),
        F.col("c_custkey").alias("candidate"),
        (F.col("c_acctbal") / 300).alias("mae"),
    )


_NAMES_SQL = ", ".join(f"'daily_forecast_{n}'" for n in MODEL_NAMES)
CANDIDATES = f"""candidates AS (
  SELECT [{_NAMES_SQL}][c_nationkey % 6 + 1] AS model_name, c_custkey AS candidate, c_acctbal / 300 AS mae
  FROM customer)"""


# ---- run metrics: an event is a metric row ----


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    metric = (
        F.when(kind == "view", "model_mae_by_horizon")
        .when(kind == "click", "model_rmse_by_horizon")
        .when(kind == "signup", "training_duration_seconds")
        .when(kind == "purchase", "training_count_total")
        .otherwise("flow_run_status")
    )
    user = F.col("user_id")
    horizon = F.when(kind != "error", (user % 7 + 1).cast("string"))
    datasets = F.array(F.lit("train"), F.lit("val"), F.lit("test"))
    dataset = F.when(kind.isin("view", "click"), F.element_at(datasets, (user % 3 + 1).cast("int")))
    status = F.when(kind == "purchase", F.when(F.col("event_id") % 10 < 2, "failure").otherwise("success"))
    flow = F.when(kind == "error", F.when(user % 2 == 0, "training_flow").otherwise("prediction_flow"))
    value = (
        F.when(kind == "purchase", F.lit(1.0))
        .when(kind == "error", (F.col("value") > 20).cast("double"))
        .when(kind == "signup", F.col("value") * 20)
        .otherwise(F.col("value"))
    )
    pairs = F.array(
        F.struct(F.lit("horizon").alias("key"), horizon.alias("value")),
        F.struct(F.lit("dataset").alias("key"), dataset.alias("value")),
        F.struct(F.lit("status").alias("key"), status.alias("value")),
        F.struct(F.lit("flow_name").alias("key"), flow.alias("value")),
    )
    labels = F.map_from_entries(F.filter(pairs, lambda p: p.value.isNotNull()))
    return table(spark, sf_dir, "events").select(
        "ts", metric.alias("metric"), labels.alias("labels"), value.alias("value")
    )


RUN_METRICS = """run_metrics AS (
  SELECT ts,
         CASE event_type WHEN 'view' THEN 'model_mae_by_horizon' WHEN 'click' THEN 'model_rmse_by_horizon'
              WHEN 'signup' THEN 'training_duration_seconds' WHEN 'purchase' THEN 'training_count_total'
              ELSE 'flow_run_status' END AS metric,
         CASE WHEN event_type <> 'error' THEN CAST(user_id % 7 + 1 AS VARCHAR) END AS horizon,
         CASE WHEN event_type IN ('view', 'click') THEN ['train', 'val', 'test'][user_id % 3 + 1] END AS dataset,
         CASE WHEN event_type = 'purchase' THEN CASE WHEN event_id % 10 < 2 THEN 'failure' ELSE 'success' END END AS status,
         CASE WHEN event_type = 'error' THEN CASE WHEN user_id % 2 = 0 THEN 'training_flow' ELSE 'prediction_flow' END END AS flow_name,
         CASE WHEN event_type = 'purchase' THEN CAST(1.0 AS DOUBLE)
              WHEN event_type = 'error' THEN CASE WHEN value > 20 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END
              WHEN event_type = 'signup' THEN value * 20 ELSE value END AS value
  FROM events)"""


# ---- weather payloads: one record with parallel arrays per return flag and month ----


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text payloads keyed by location; every 17th day of the year lacks its values."""
    items = table(spark, sf_dir, "lineitem")
    day = F.to_date("l_shipdate")
    known = F.dayofyear(F.col("day")) % 17 != 0
    numbers = (
        items.groupBy(F.col("l_returnflag").alias("location"), day.alias("day"))
        .agg(
            F.max(_percent("l_discount")).cast("double").alias("temperature_2m_max"),
            F.min(_percent("l_discount")).cast("double").alias("temperature_2m_min"),
            F.avg(_percent("l_discount")).alias("temperature_2m_mean"),
            F.sum("l_quantity").alias("precipitation_sum"),
            F.avg(_percent("l_tax")).alias("snowfall_sum"),
        )
    )
    fields = [c for c in numbers.columns if c not in ("location", "day")]
    holed = numbers.withColumns({c: F.when(known, F.col(c)) for c in fields})
    record = F.struct("day", *fields)
    monthly = holed.groupBy("location", F.trunc("day", "month").alias("month")).agg(
        F.array_sort(F.collect_list(record)).alias("r")  # at most 31 days
    )
    arrays = [F.transform("r", lambda x: x.day.cast("string")).alias("time")]
    arrays += [F.col(f"r.{c}").alias(c) for c in fields]
    body = F.to_json(F.struct(F.struct(*arrays).alias("daily")), {"ignoreNullFields": "false"})
    return monthly.select("location", body.alias("payload"))


PAYLOAD_DAYS = """numbers AS (
  SELECT l_returnflag AS location, CAST(l_shipdate AS DATE) AS "Date",
         CAST(max(CAST(round(l_discount * 100) AS INTEGER)) AS DOUBLE) AS Temp_Max,
         CAST(min(CAST(round(l_discount * 100) AS INTEGER)) AS DOUBLE) AS Temp_Min,
         avg(CAST(round(l_discount * 100) AS INTEGER)) AS Temp_Mean,
         sum(l_quantity) AS Precipitation,
         avg(CAST(round(l_tax * 100) AS INTEGER)) AS Snowfall
  FROM lineitem GROUP BY 1, 2),
payload AS (
  SELECT location, "Date",
         CASE WHEN dayofyear("Date") % 17 <> 0 THEN Temp_Max END AS Temp_Max,
         CASE WHEN dayofyear("Date") % 17 <> 0 THEN Temp_Min END AS Temp_Min,
         CASE WHEN dayofyear("Date") % 17 <> 0 THEN Temp_Mean END AS Temp_Mean,
         CASE WHEN dayofyear("Date") % 17 <> 0 THEN Precipitation END AS Precipitation,
         CASE WHEN dayofyear("Date") % 17 <> 0 THEN Snowfall END AS Snowfall
  FROM numbers)"""


# ---- printed tuples: an event is a line, some of them damaged ----


def tuple_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, key = F.col("ts"), F.col("event_id")
    kind = key % 10
    micros = F.date_format(ts, "SSSSSS").cast("int")
    month = F.when(kind == 2, F.lit(2)).otherwise(F.month(ts))
    day = F.when(kind == 2, F.lit(30)).otherwise(F.dayofmonth(ts))
    moment = F.concat_ws(", ", F.year(ts), month, day, F.hour(ts), F.minute(ts), F.second(ts).cast("int"))
    moment = F.when(kind == 3, moment).otherwise(F.concat(moment, F.lit(", "), micros))
    head = F.when(kind == 1, F.lit("('x'")).otherwise(F.concat(F.lit("("), key))
    line = F.concat(
        head,
        F.lit(", datetime.datetime("),
        moment,
        F.lit("), '"),
        F.col("event_type"),
        F.lit("', datetime.datetime(2030, 1, 1, 0, 0), '9')"),
    )
    damaged = F.when(kind == 0, F.lit(")")).when(kind == 4, F.lit("  ")).otherwise(line)
    return table(spark, sf_dir, "events").select(damaged.alias("value"))
