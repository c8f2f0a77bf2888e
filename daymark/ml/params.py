"""Hyperparameters: defaults, search space, checks."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping
from typing import Any

# Default hyperparameters.
DEFAULT_PARAMS = {
    "n_estimators": 100,
    "max_depth": 6,
    "num_leaves": 31,
    "learning_rate": 0.1,
    "min_child_samples": 20,
    "subsample": 0.8,
    "colsample_bytree": 0.8,
    "random_state": 42,
    "n_jobs": -1,
}
# Search space as (kind, low, high, step); a log range has no step.
SEARCH_SPACE = {
    "n_estimators": ("int", 50, 500, 10),
    "max_depth": ("int", 3, 12, 1),
    "num_leaves": ("int", 20, 200, 10),
    "learning_rate": ("log", 0.001, 0.3, None),
    "min_child_samples": ("int", 5, 100, 5),
    "subsample": ("float", 0.5, 1.0, 0.05),
    "colsample_bytree": ("float", 0.5, 1.0, 0.05),
    "reg_alpha": ("float", 0.0, 10.0, 0.1),
    "reg_lambda": ("float", 0.0, 10.0, 0.1),
    "min_child_weight": ("log", 0.001, 10.0, None),
}
QUANTILES = (0.025, 0.975)
MAX_BINS = 255
#: Accepted and recorded; Spark decides how many tasks run.
WITHOUT_EFFECT = ("n_jobs",)
#: Deepest tree that may be asked for.
MAX_DEPTH = 30


def checked_params(params: Mapping[str, Any] | None = None) -> dict[str, Any]:
    """The defaults with `params` on top, as numbers; ValueError for values no tree can be grown with."""
    merged = {"reg_alpha": 0.0, "reg_lambda": 0.0, "min_child_weight": 0.0, **DEFAULT_PARAMS, **(params or {})}
    whole = ("n_estimators", "max_depth", "num_leaves", "min_child_samples", "random_state")
    out = {k: int(v) if k in whole else float(v) for k, v in merged.items() if k not in WITHOUT_EFFECT}
    faults = [k for k in ("n_estimators", "num_leaves", "learning_rate") if out[k] <= 0]
    faults += [k for k in ("subsample", "colsample_bytree") if not 0 < out[k] <= 1]
    faults += [k for k in ("reg_alpha", "reg_lambda", "min_child_weight", "min_child_samples", "random_state") if out[k] < 0]
    if not 1 <= out["max_depth"] <= MAX_DEPTH:
        faults.append("max_depth")
    if faults:
        raise ValueError(f"values out of range: {sorted(faults)}")
    return out


def trials(n: int, seed: int = 42, space: Mapping[str, tuple] = SEARCH_SPACE) -> list[dict[str, Any]]:
    """A reproducible table of random hyperparameter sets."""
    rng = random.Random(seed)
    table = []
    for _ in range(n):
        row = {}
        for name, (kind, low, high, step) in space.items():
            if kind == "log":
                row[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
            else:
                value = low + step * rng.randint(0, round((high - low) / step))
                row[name] = int(value) if kind == "int" else round(value, 6)
        table.append(row)
    return table
