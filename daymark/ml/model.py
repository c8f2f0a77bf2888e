"""Forecast models: boosted trees for the point, boosted quantile trees or residual quantiles for the bounds."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.functions.errors import clamp_bounds
from daymark.functions.quantiles import exact_quantiles
from daymark.ml import boosting
from daymark.ml.boosting import Trees
from daymark.ml.params import QUANTILES
from daymark.schema import HORIZON, LABEL
from daymark.session import ship

#: The tree models of a forecast model and the columns they fill.
PARTS = {"point": "point_prediction", "lower": "lower_bound", "upper": "upper_bound"}


def add_scores(df: DataFrame, features: Sequence[str], named: Mapping[str, Trees]) -> DataFrame:
    """Add the scores of tree models as columns, by column name; a missing feature counts as the smallest value."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(dict(named))

    @F.pandas_udf(", ".join(f"`{name}` double" for name in named))
    def score(*columns: pd.Series) -> pd.DataFrame:
        x = np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns])
        return pd.DataFrame({name: trees.scores(x) for name, trees in shared.value.items()})

    scored = df.withColumn("_scores", score(*[F.col(f"`{f}`").cast("double") for f in features]))
    return scored.withColumns({name: F.col("_scores")[name] for name in named}).drop("_scores")


@dataclass
class ForecastModel:
    """Point model and optional bounds for one horizon."""

    features: list[str]
    horizon: int
    point: Trees | None = None
    lower: Trees | None = None
    upper: Trees | None = None
    offsets: tuple[float, float] | None = None

    def _grown(self, train: DataFrame, params, label: str, rounds: int | None, alphas: Sequence[float | None]) -> list[Trees]:
        matrix = boosting.binned(train, self.features, label, quantiles=[a for a in alphas if a is not None])
        models = [boosting.booster(matrix, f"model {i}", 0, params, a) for i, a in enumerate(alphas)]
        boosting.grow(matrix, models, {m.name: rounds or m.params["n_estimators"] for m in models})
        return [m.trees for m in models]

    def fit_point(
        self, train: DataFrame, params: Mapping[str, Any] | None = None, label: str = LABEL
    ) -> ForecastModel:
        """Boosted trees with squared loss over all series together."""
        (self.point,) = self._grown(train, params, label, None, [None])
        return self

    def fit_quantiles(
        self,
        train: DataFrame,
        params: Mapping[str, Any] | None = None,
        quantiles: tuple[float, float] = QUANTILES,
        rounds: int | None = None,
        label: str = LABEL,
    ) -> ForecastModel:
        """Boosted quantile trees for both bounds, with the parameters of the point model; `rounds` replaces their number."""
        self.lower, self.upper = self._grown(train, params, label, rounds, quantiles)
        return self

    def fit_residual_bounds(
        self, calib: DataFrame, quantiles: tuple[float, float] = QUANTILES, label: str = LABEL
    ) -> ForecastModel:
        """The cheap bounds: point plus residual quantiles of the calibration rows."""
        found = residual_quantiles(self.predict(calib), quantiles, label).first()
        if found is None or found.low is None:
            raise ValueError("no calibration rows")
        self.offsets = (float(found.low), float(found.high))
        return self

    def trees(self) -> dict[str, Trees]:
        """The fitted tree models by name."""
        return {name: getattr(self, name) for name in PARTS if getattr(self, name) is not None}

    def predict(self, df: DataFrame, return_intervals: bool = False) -> DataFrame:
        """Add point_prediction and, if asked and fitted, bounds that never cross it."""
        if self.point is None:
            raise ValueError("fit the point model first")
        named = {PARTS["point"]: self.point}
        if return_intervals and self.lower is not None and self.upper is not None:
            scored = add_scores(df, self.features, named | {"lower_bound": self.lower, "upper_bound": self.upper})
            return scored.withColumns(clamp_bounds("point_prediction", "lower_bound", "upper_bound"))
        scored = add_scores(df, self.features, named)
        if return_intervals and self.offsets is not None:
            moved = {b: F.col("point_prediction") + F.lit(o) for b, o in zip(("lower_bound", "upper_bound"), self.offsets)}
            scored = scored.withColumns(moved).withColumns(clamp_bounds("point_prediction", "lower_bound", "upper_bound"))
        return scored

    def feature_importance(self, spark: SparkSession, top_n: int = 20) -> DataFrame:
        """Features by falling share in the gain of the point model."""
        if self.point is None:
            raise ValueError("fit the point model first")
        weights = self.point.importance(len(self.features)).tolist()
        table = spark.createDataFrame(list(zip(self.features, weights)), "feature string, importance double")
        return table.orderBy(F.desc("importance"), "feature").limit(top_n)

    def save(self, spark: SparkSession, path: str) -> str:
        """Write the model as JSON: a row for its description and one for each tree model."""
        if self.point is None:
            raise ValueError("fit the point model first")
        rows = [("description", json.dumps({"features": self.features, "horizon": self.horizon, "offsets": self.offsets}))]
        rows += [(name, json.dumps(trees.to_lists())) for name, trees in self.trees().items()]
        spark.createDataFrame(rows, "part string, value string").coalesce(1).write.mode("overwrite").parquet(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForecastModel:
        try:
            parts = {r.part: json.loads(r.value) for r in spark.read.parquet(path).collect()}
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error.getCondition()):
                raise
            raise FileNotFoundError(path) from error
        about = parts.pop("description")
        offsets = tuple(about["offsets"]) if about["offsets"] else None
        return cls(about["features"], about["horizon"], offsets=offsets, **{n: Trees.from_lists(t) for n, t in parts.items()})


def residual_quantiles(scored: DataFrame, quantiles: tuple[float, float] = QUANTILES, label: str = LABEL, by: Sequence[str] = ()) -> DataFrame:
    """low and high quantile of the residuals of scored rows."""
    residuals = scored.select(*by, (F.col(label) - F.col("point_prediction")).alias("_residual"))
    wanted = {"low": ("_residual", quantiles[0]), "high": ("_residual", quantiles[1])}
    return exact_quantiles(residuals, wanted, by, few_groups=list(by) == [HORIZON])


def score_by_horizon(df: DataFrame, models: Mapping[int, ForecastModel]) -> DataFrame:
    """Score each row with the model of its horizon, in one pass; rows without a model are left out.

    A table without rows of some horizon (a short frame) gives those of its last horizon to that model.
    Bounds that a model lacks are the point.
    """
    if not models:
        raise ValueError("no models")
    if any(m.point is None for m in models.values()):
        raise ValueError("fit the point model first")
    ship(df.sparkSession)
    kind = df.schema[HORIZON].dataType
    present = sorted(r[HORIZON] for r in df.select(HORIZON).distinct().collect() if r[HORIZON] is not None)  # one row for each horizon
    rows = df.where(F.col(HORIZON).isin(sorted(models)))
    for missing in sorted(set(models) - set(present)) if present else ():
        rows = rows.unionByName(df.where(F.col(HORIZON) == present[-1]).withColumn(HORIZON, F.lit(missing).cast(kind)))
    features = list(dict.fromkeys(f for m in models.values() for f in m.features))
    at = {f: i for i, f in enumerate(features)}
    plans = {h: ([at[f] for f in m.features], m.trees(), m.offsets) for h, m in models.items()}
    shared = df.sparkSession.sparkContext.broadcast(plans)

    @F.pandas_udf("point_prediction double, lower_bound double, upper_bound double")
    def score(horizon: pd.Series, *columns: pd.Series) -> pd.DataFrame:
        x = np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns])
        own, out = horizon.to_numpy(), np.full((len(horizon), 3), np.nan)
        for h in np.unique(own):
            columns_of, trees, offsets = shared.value[int(h)]
            mine = own == h
            part = x[mine][:, columns_of]
            point = trees["point"].scores(part)
            low, high = (trees[n].scores(part) if n in trees else point for n in ("lower", "upper"))
            if offsets is not None and "lower" not in trees:
                low, high = point + offsets[0], point + offsets[1]
            out[mine] = np.column_stack([point, np.minimum(low, point), np.maximum(high, point)])
        return pd.DataFrame(out, columns=list(PARTS.values()))

    scored = rows.withColumn("_scores", score(F.col(HORIZON), *[F.col(f"`{f}`").cast("double") for f in features]))
    return scored.withColumns({name: F.col("_scores")[name] for name in PARTS.values()}).drop("_scores")
