"""Reshaping between nested records, wide rows and (name, value) rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.schema import HORIZON


def struct_leaves(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of all non-struct fields."""
    paths: list[tuple[str, ...]] = []
    for field in schema:
        path = (*prefix, field.name)
        if isinstance(field.dataType, T.StructType):
            paths.extend(struct_leaves(field.dataType, path))
        else:
            paths.append(path)
    return paths


def flatten_params(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct columns become flat columns with joined names."""
    selected = []
    for path in struct_leaves(df.schema):
        quoted = ".".join(f"`{name}`" for name in path)
        selected.append(F.col(quoted).alias(sep.join(path)))
    return df.select(*selected)


def flatten_mapping(params: Mapping[str, Any], sep: str = ".") -> dict[str, Any]:
    """The same for a small Python mapping of run parameters."""
    flat: dict[str, Any] = {}
    pending = [("", params)]
    while pending:
        prefix, mapping = pending.pop(0)
        for name, value in mapping.items():
            if isinstance(value, Mapping):
                pending.append((f"{prefix}{name}{sep}", value))
            else:
                flat[f"{prefix}{name}"] = value
    return flat


def metric_rows(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every scalar column becomes a (metric, value) row with a text value; nested columns are skipped."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    scalars = [
        f.name for f in df.schema if f.name not in keys and not isinstance(f.dataType, nested)
    ]
    text = df.select(*keys, *[F.col(f"`{c}`").cast("string").alias(c) for c in scalars])
    return text.unpivot(list(keys), scalars, "metric", "value")


def zip_explode(df: DataFrame, arrays: Mapping[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    """Parallel arrays become rows, one column per array."""
    zipped = F.arrays_zip(*[array.alias(name) for name, array in arrays.items()])
    rows = df.select(*keep, F.explode(zipped).alias("_z"))
    fields = rows.schema["_z"].dataType.fieldNames()
    return rows.select(
        *keep, *[F.col("_z").getField(f).alias(name) for f, name in zip(fields, arrays)]
    )


def union_horizons(parts: Mapping[int, DataFrame]) -> DataFrame:
    """One table of the tables of single horizons, with the horizon of each as a column.

    Columns go by name; one that a table lacks is NULL there. Repeated rows stay.
    """
    if not parts:
        raise ValueError("no horizons")
    named = [df.drop(HORIZON).withColumn(HORIZON, F.lit(int(h))) for h, df in sorted(parts.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
