"""Queries for forecast tracking and run metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymark.operators import monitor
from daymark.plans.tracking import track_performance
from daymark.suite import inputs as i
from daymark.suite.catalog import query, rounded, rounded_sql, with_ctes

S = i.SERIES
COMPARED = """compared AS (SELECT p.*, a.patient_count, abs(p.point_prediction - a.patient_count) AS absolute_error
  FROM predictions p JOIN actuals a ON a.date = p.prediction_date AND a.series = p.series)"""
FRAME = """OVER (PARTITION BY series, horizon ORDER BY prediction_date, prediction_timestamp
  ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""
ROLLING = f"""rolling AS (SELECT series, prediction_date AS date, prediction_timestamp, horizon,
    avg(absolute_error) {FRAME} AS rolling_mae, CAST(count(absolute_error) {FRAME} AS BIGINT) AS n_predictions FROM compared)"""
LATEST = """latest AS (SELECT * FROM rolling QUALIFY row_number() OVER (PARTITION BY series, horizon
    ORDER BY date DESC, prediction_timestamp DESC) = 1)"""
TRACK = with_ctes(i.DAILY, i.PREDICTIONS, i.ACTUALS, COMPARED, ROLLING, LATEST)


def _compared(spark, sf):
    return monitor.predictions_vs_actuals(i.predictions(spark, sf), i.actuals(spark, sf), S)


@query("predictions_vs_actuals", f"{TRACK} SELECT * FROM compared")
def predictions_vs_actuals(spark, sf):
    return _compared(spark, sf)


@query(
    "point_mae_by_horizon",
    rounded_sql(f"{TRACK} SELECT series, horizon, avg(absolute_error) AS mae FROM compared GROUP BY 1, 2", ["mae"]),
)
def point_mae_by_horizon(spark, sf):
    return rounded(monitor.point_mae_by_horizon(_compared(spark, sf), S))


@query("rolling_mae", rounded_sql(f"{TRACK} SELECT * FROM rolling", ["rolling_mae"]))
def rolling_mae(spark, sf):
    return rounded(monitor.rolling_mae(_compared(spark, sf), series_cols=S))


@query("latest_per_group", rounded_sql(f"{TRACK} SELECT * FROM latest", ["rolling_mae"]))
def latest_per_group(spark, sf):
    rolled = monitor.rolling_mae(_compared(spark, sf), series_cols=S)
    return rounded(monitor.latest_per_group(rolled, [*S, "horizon"]))


# The baseline of a series and horizon is half its overall error, so that alerts occur.
BASELINE = "baseline AS (SELECT series, horizon, avg(absolute_error) * 0.8 AS baseline_mae FROM compared GROUP BY 1, 2)"
ALERTS = """alerts AS (SELECT l.series, l.horizon, l.rolling_mae AS current_mae, b.baseline_mae,
    b.baseline_mae * 1.2 AS threshold_mae, (l.rolling_mae - b.baseline_mae) / b.baseline_mae * 100 AS degradation_percentage,
    l.prediction_timestamp AS "timestamp"
  FROM latest l JOIN baseline b USING (series, horizon) WHERE l.rolling_mae > b.baseline_mae * 1.2)"""
ALERT_CTES = with_ctes(i.DAILY, i.PREDICTIONS, i.ACTUALS, COMPARED, ROLLING, LATEST, BASELINE, ALERTS)
ALERT_NUMBERS = ["current_mae", "baseline_mae", "threshold_mae", "degradation_percentage"]


def _baselines(spark, sf):
    return _compared(spark, sf).groupBy("series", "horizon").agg(
        (F.avg("absolute_error") * 0.8).alias("baseline_mae")
    )


def _report(spark, sf):
    return track_performance(
        i.predictions(spark, sf), i.actuals(spark, sf), _baselines(spark, sf), series_cols=S
    )


@query("degradation_alerts", rounded_sql(f"{ALERT_CTES} SELECT * FROM alerts", ALERT_NUMBERS))
def degradation_alerts(spark, sf):
    return rounded(_report(spark, sf)["alerts"])


@query(
    "track_performance",
    rounded_sql(
        f"""{ALERT_CTES} SELECT l.series, l.horizon, p.mae, l.rolling_mae, l.n_predictions, l.prediction_timestamp AS "timestamp"
        FROM (SELECT series, horizon, avg(absolute_error) AS mae FROM compared GROUP BY 1, 2) p
        JOIN latest l USING (series, horizon)""",
        ["mae", "rolling_mae"],
    ),
)
def track(spark, sf):
    return rounded(_report(spark, sf)["log"])


@query(
    "tracking_status",
    f"""{ALERT_CTES} SELECT CAST(count(*) AS BIGINT) AS n_alerts,
      CASE WHEN count(*) > 0 THEN 'degraded' ELSE 'healthy' END AS status,
      (SELECT CAST(count(*) AS BIGINT) FROM compared) AS n_predictions_evaluated FROM alerts""",
)
def tracking_status(spark, sf):
    return _report(spark, sf)["status"]


# ---- run metrics ----

RUNS = with_ctes(i.RUN_METRICS)


@query(
    "current_metric",
    rounded_sql(
        f"""{RUNS} SELECT metric, horizon, arg_max(value, (ts, value)) * 100 AS value, max(ts) AS ts FROM run_metrics
        WHERE metric = 'model_mae_by_horizon' AND dataset = 'test' GROUP BY 1, 2""",
        ["value"],
    ),
)
def current_metric(spark, sf):
    rows = monitor.pick(i.run_metrics(spark, sf), "model_mae_by_horizon", dataset="test")
    return rounded(monitor.current_metric(rows, ["horizon"], scale=100.0))


@query(
    "duration_quantile",
    rounded_sql(
        f"""{RUNS} SELECT metric, horizon, CAST(count(value) AS BIGINT) AS n, quantile_cont(value, 0.5) AS p50,
             quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99
          FROM run_metrics WHERE metric = 'training_duration_seconds' GROUP BY 1, 2""",
        ["p50", "p95", "p99"],
    ),
)
def duration_quantile(spark, sf):
    rows = monitor.pick(i.run_metrics(spark, sf), "training_duration_seconds")
    return rounded(monitor.duration_quantiles(rows, labels=["horizon"]))


EDGES = monitor.BUCKETS["training_duration_seconds"]


def _bucket_sql(q: float, name: str) -> str:
    parts = []
    for k, edge in enumerate(EDGES):
        below = f"le{k - 1}" if k else "0"
        start = EDGES[k - 1] if k else 0
        parts.append(
            f"""WHEN le{k} >= CAST({q} AS DOUBLE) * n THEN {start} + CAST({edge - start} AS DOUBLE) *
                coalesce((CAST({q} AS DOUBLE) * n - {below}) / nullif(le{k} - {below}, 0), 0)"""
        )
    return f"CASE {' '.join(parts)} ELSE {EDGES[-1]} END AS {name}"


_LE = ", ".join(f"CAST(count(*) FILTER (value <= {e}) AS DOUBLE) AS le{k}" for k, e in enumerate(EDGES))


@query(
    "duration_quantile_buckets",
    rounded_sql(
        f"""{RUNS}, c AS (SELECT metric, horizon, CAST(count(value) AS BIGINT) AS n, {_LE} FROM run_metrics
              WHERE metric = 'training_duration_seconds' GROUP BY 1, 2)
          SELECT metric, horizon, n, {_bucket_sql(0.5, 'p50')}, {_bucket_sql(0.95, 'p95')}, {_bucket_sql(0.99, 'p99')} FROM c""",
        ["p50", "p95", "p99"],
    ),
)
def duration_quantile_buckets(spark, sf):
    rows = monitor.pick(i.run_metrics(spark, sf), "training_duration_seconds")
    return rounded(monitor.bucketed_quantiles(rows, EDGES, labels=["horizon"]))


@query(
    "counter_rate",
    rounded_sql(
        f"""{RUNS} SELECT metric, status, date_trunc('hour', ts) AS window_start, sum(value) / 3600 * 60 AS rate
          FROM run_metrics WHERE metric = 'training_count_total' GROUP BY 1, 2, 3""",
        ["rate"],
    ),
)
def counter_rate(spark, sf):
    rows = monitor.pick(i.run_metrics(spark, sf), "training_count_total")
    return rounded(monitor.counter_rate(rows, per=60.0, labels=["status"]))


@query(
    "counter_rate_sliding",
    rounded_sql(
        f"""{RUNS} SELECT metric, status, window_start, sum(value) / 86400 * 60 AS rate FROM
            (SELECT metric, status, value, unnest([to_timestamp(floor(epoch(ts) / 21600) * 21600 - k * 21600)::TIMESTAMP
              FOR k IN range(4)]) AS window_start FROM run_metrics WHERE metric = 'training_count_total')
          GROUP BY 1, 2, 3""",
        ["rate"],
    ),
)
def counter_rate_sliding(spark, sf):
    """Rates a minute over days that begin every six hours."""
    rows = monitor.pick(i.run_metrics(spark, sf), "training_count_total")
    return rounded(monitor.counter_rate(rows, "1 day", per=60.0, labels=["status"], slide="6 hours"))


@query(
    "success_rate",
    rounded_sql(
        f"""{RUNS} SELECT metric, horizon, sum(CASE WHEN status = 'success' THEN value ELSE 0 END) / sum(value) * 100 AS success_pct
          FROM run_metrics WHERE metric = 'training_count_total' GROUP BY 1, 2""",
        ["success_pct"],
    ),
)
def success_rate(spark, sf):
    rows = monitor.pick(i.run_metrics(spark, sf), "training_count_total")
    return rounded(monitor.success_rate(rows, ["metric", "horizon"], ["horizon"]))


@query(
    "counter_totals",
    f"""{RUNS} SELECT metric, horizon, status, sum(value) AS total FROM run_metrics
        WHERE metric = 'training_count_total' GROUP BY 1, 2, 3""",
)
def counter_totals(spark, sf):
    rows = monitor.pick(i.run_metrics(spark, sf), "training_count_total")
    return monitor.counter_totals(rows, ["horizon", "status"])


@query(
    "last_run",
    f"""{RUNS} SELECT metric, flow_name, max(ts) AS last_ts, arg_max(value, (ts, value)) AS last_value
        FROM run_metrics WHERE metric = 'flow_run_status' GROUP BY 1, 2""",
)
def last_run(spark, sf):
    rows = monitor.pick(i.run_metrics(spark, sf), "flow_run_status")
    return monitor.last_run(rows, ["flow_name"])


def _grid_sql() -> str:
    def cell(value):
        return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"

    rows = [(m, h, d, None) for m in monitor.PERFORMANCE_GAUGES for h in range(1, 8) for d in monitor.DATASETS]
    rows += [(m, h, None, None) for m in monitor.HORIZON_GAUGES for h in range(1, 8)]
    rows += [("flow_run_status", None, None, f) for f in monitor.FLOWS]
    rows.append(("last_prediction_timestamp", None, None, None))
    values = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return f"grid(metric, horizon, dataset, flow_name) AS (VALUES {values})"


@query(
    "metric_defaults",
    rounded_sql(
        with_ctes(i.RUN_METRICS, _grid_sql())
        + """, known AS (SELECT metric, horizon, dataset, flow_name, arg_max(value, (ts, value)) AS v FROM run_metrics GROUP BY ALL)
          SELECT g.metric, g.horizon, g.dataset, g.flow_name, coalesce(k.v, 0) AS value
          FROM grid g LEFT JOIN known k ON g.metric = k.metric AND g.horizon IS NOT DISTINCT FROM k.horizon
            AND g.dataset IS NOT DISTINCT FROM k.dataset AND g.flow_name IS NOT DISTINCT FROM k.flow_name""",
        ["value"],
    ),
)
def metric_defaults(spark, sf):
    return rounded(monitor.metric_defaults(i.run_metrics(spark, sf)))
