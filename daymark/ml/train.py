"""Training: hyperparameter search by successive halving, all horizons over one binned matrix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.ml.boosting import Booster, Matrix, absolute_errors, binned, booster, grow
from daymark.ml.model import ForecastModel, residual_quantiles, score_by_horizon
from daymark.ml.params import DEFAULT_PARAMS, QUANTILES, checked_params, trials
from daymark.operators.dataset import shifted_target, temporal_split
from daymark.operators.evaluate import conformal_calibration, evaluate
from daymark.operators.features import select_features
from daymark.schema import HORIZON, HORIZONS, LABEL, SPLIT, TARGET
from daymark.session import cut_lineage

#: Trees of every trial before the first comparison; each further one follows at twice as many.
FIRST_TREES = 16


@dataclass
class TrainedHorizon:
    model: ForecastModel
    metadata: dict[str, Any]


def successive_halving(
    matrix: Matrix, groups: Sequence[int], table: Sequence[Mapping[str, Any]]
) -> tuple[dict[int, list[dict[str, Any]]], dict[int, Booster]]:
    """The trials of each group with their validation errors, best first, and the best model of each.

    All trials of all groups grow together. After 16, 32, 64... trees those with the larger error in
    their group stop; the others go on from where they are, until the ones left have all their trees. `stopped_by`
    is the largest error of those that went on when a trial stopped, whatever they came to later.
    A trial whose parameters are impossible is kept with its message and sorts last.
    """
    results = {g: [{"trial": i, "params": dict(p), "val_mae": None, "error": None, "n_trees": 0, "stopped_by": None} for i, p in enumerate(table)] for g in groups}
    alive: dict[int, list[tuple[int, Booster]]] = {g: [] for g in groups}
    for g in groups:
        for i, params in enumerate(table):
            try:
                alive[g].append((i, booster(matrix, f"{g} {i}", g, params)))
            except ValueError as error:
                results[g][i]["error"] = str(error)
    aim = FIRST_TREES if any(len(own) > 1 for own in alive.values()) else max(p for p in [1, *(m.params["n_estimators"] for own in alive.values() for _, m in own)])
    while True:
        models = [m for own in alive.values() for _, m in own]
        rounds = {m.name: min(aim, m.params["n_estimators"]) for m in models}
        going = [m for m in models if len(m.trees.parts) < rounds[m.name]]
        grow(matrix, going, rounds)
        found = absolute_errors(matrix, going) if going else {}
        for g, own in alive.items():
            for i, m in own:
                results[g][i].update(val_mae=found.get(m.name, results[g][i]["val_mae"]), n_trees=len(m.trees.parts))
            own.sort(key=lambda x: (_last(results[g][x[0]]["val_mae"]), x[0]))
            if any(len(m.trees.parts) < m.params["n_estimators"] for _, m in own):
                stay = (len(own) + 1) // 2
                for i, _ in own[stay:]:
                    results[g][i]["stopped_by"] = results[g][own[stay - 1][0]]["val_mae"]
                del own[stay:]
        if all(len(m.trees.parts) >= m.params["n_estimators"] for own in alive.values() for _, m in own):
            break
        aim *= 2
    for g, rows in results.items():
        finalists = {i for i, _ in alive[g]}
        rows.sort(key=lambda r: (r["error"] is not None, r["trial"] not in finalists, _last(r["val_mae"]), r["trial"]))
    return results, {g: own[0][1] for g, own in alive.items() if own}


def _last(error: float | None) -> tuple[bool, float]:
    return error is None, error or 0.0


def hyperparameter_search(
    train: DataFrame,
    val: DataFrame,
    features: Sequence[str],
    horizon: int,
    table: Sequence[Mapping[str, Any]],
) -> list[dict[str, Any]]:
    """Trials of one horizon, best first; see successive_halving."""
    rows = train.select(*features, LABEL).withColumn(SPLIT, F.lit("train")).unionByName(val.select(*features, LABEL).withColumn(SPLIT, F.lit("val")))
    matrix = binned(rows.withColumn(HORIZON, F.lit(horizon)), features, LABEL, HORIZON, SPLIT)
    return successive_halving(matrix, [horizon], table)[0][horizon]


def search_all(
    split: DataFrame, features: Sequence[str], table: Sequence[Mapping[str, Any]], horizons: Sequence[int] = HORIZONS
) -> dict[int, list[dict[str, Any]]]:
    """Trials of all horizons of split rows, best first."""
    matrix = binned(split.where(F.col(SPLIT).isin("train", "val")), features, LABEL, HORIZON, SPLIT)
    return successive_halving(matrix, list(horizons), table)[0]


def train_horizon(rows: DataFrame, horizon: int, n_trials: int = 300, series_cols: Sequence[str] = (), **options: Any) -> TrainedHorizon:
    """Train one horizon; see train_all."""
    return train_all(rows, [horizon], n_trials, series_cols, **options)[horizon]


def _labelled(rows: DataFrame, horizons: Sequence[int], series_cols: Sequence[str], target_col: str) -> DataFrame:
    """Labelled rows of the horizons, from rows that may lack the horizon or the label."""
    if HORIZON not in rows.columns:
        if LABEL in rows.columns:
            parts = [rows.withColumn(HORIZON, F.lit(h)) for h in horizons]
        else:
            parts = [shifted_target(rows, h, target_col, series_cols).withColumn(HORIZON, F.lit(h)) for h in horizons]
        return reduce(DataFrame.unionByName, parts)
    if LABEL not in rows.columns:
        rows = shifted_target(rows, None, target_col, series_cols)
    return rows.where(F.col(HORIZON).isin(list(horizons)))


def train_all(
    rows: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    n_trials: int = 300,
    series_cols: Sequence[str] = (),
    target_col: str = TARGET,
    features: Sequence[str] | None = None,
    bounds: str = "quantile",
    quantile_rounds: int | None = None,
    table: Sequence[Mapping[str, Any]] | None = None,
) -> dict[int, TrainedHorizon]:
    """Label, split, search, fit bounds and evaluate on the test part, all horizons together.

    The model of the best trial, grown on the training part, is the point model. `bounds` is `quantile` (boosted, with the
    best parameters) or `residual` (quantiles of calibration residuals). `table` gives the trials; by
    default `n_trials` random ones, and none means the defaults.
    """
    horizons = list(horizons)
    rows = _labelled(rows, horizons, series_cols, target_col)
    features = list(features or select_features(rows.drop(HORIZON), series_cols, target_col))
    split = cut_lineage(temporal_split(rows, series_cols=series_cols).select(HORIZON, *features, LABEL, SPLIT))
    quantiles = QUANTILES if bounds == "quantile" else ()
    matrix = binned(split, features, LABEL, HORIZON, SPLIT, quantiles=quantiles)
    chosen = list(trials(n_trials) if table is None else table) or [dict(DEFAULT_PARAMS)]
    found, best = successive_halving(matrix, horizons, chosen)
    for h in horizons:
        if h not in best:
            raise RuntimeError(f"every trial failed, the first with: {found[h][0]['error']}")
    models = {h: ForecastModel(features, h, best[h].trees) for h in horizons}
    if bounds == "quantile":
        sides = [booster(matrix, f"{h} {a}", h, found[h][0]["params"], a) for h in horizons for a in quantiles]
        grow(matrix, sides, {m.name: quantile_rounds or m.params["n_estimators"] for m in sides})
        for h in horizons:
            models[h].lower, models[h].upper = (m.trees for m in sides if m.group == h)
    else:
        calib = score_by_horizon(split.where(F.col(SPLIT) == "calib"), models)
        offsets = {r[HORIZON]: (r.low, r.high) for r in residual_quantiles(calib, by=[HORIZON]).collect()}
        if any(h not in offsets or offsets[h][0] is None for h in horizons):
            raise ValueError("no calibration rows")
        for h in horizons:
            models[h].offsets = offsets[h]
    return {h: TrainedHorizon(models[h], about) for h, about in _metadata(split, models, found, features, table, n_trials).items()}


def _metadata(split: DataFrame, models, found, features, table, n_trials) -> dict[int, dict[str, Any]]:
    """Errors on the test part, calibration, sizes and parameters of every horizon."""
    names = ("train", "val", "calib", "test")
    scored = score_by_horizon(split.where(F.col(SPLIT).isin("test", "calib")), models)
    scored = cut_lineage(scored.withColumnsRenamed({LABEL: "actual", "point_prediction": "predicted"}).select(HORIZON, SPLIT, "actual", "predicted", "lower_bound", "upper_bound"))
    metrics = {r[HORIZON]: r for r in evaluate(scored.where(F.col(SPLIT) == "test"), [HORIZON]).collect()}
    factors = {r[HORIZON]: r.correction_factor for r in conformal_calibration(scored.where(F.col(SPLIT) == "calib"), [HORIZON]).collect()}
    sizes = {(r[HORIZON], r[SPLIT]): r["count"] for r in split.groupBy(HORIZON, SPLIT).count().collect()}
    out = {}
    for h in models:
        best, row = found[h][0], metrics.get(h)
        out[h] = {
            "horizon": h,
            "n_trials": n_trials if table is None else len(table),
            "best_params": best["params"],
            "best_val_mae": best["val_mae"],
            **{f"test_{k}": row[k] if row else None for k in ("mae", "rmse", "coverage", "interval_width")},
            "correction_factor": factors.get(h),
            **{f"n_{name}": sizes.get((h, name), 0) for name in names},
            "n_features": len(features),
            "feature_names": features,
        }
    return out
