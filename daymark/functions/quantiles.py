"""Exact quantiles for groups of any size, and quantiles from histogram buckets.

`percentile` keeps every distinct value of a group in one task. That is right for daily
tables, where the calendar bounds a group, and wrong for raw rows. `exact_quantiles` gives
the same linearly interpolated numbers in two passes: a sketch brackets each wanted quantile
between two values, then rows outside the brackets are only counted (map-side) while the few
values inside are ranked. Brackets of large groups are broadcast, so that rows are never dealt by
the keys of a large group; groups of few rows need no brackets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.schema import join_keys

#: Groups of more rows are bracketed, the values of others all ranked. A table has at most one such group for so many rows.
LARGE_GROUP = 100_000


def exact_quantiles(
    df: DataFrame,
    wanted: Mapping[str, tuple[str, float]],
    by: Sequence[str] = (),
    carry: Mapping[str, Column] | None = None,
    accuracy: int = 20_000,
    few_groups: bool = False,
    large_group: int = LARGE_GROUP,
) -> DataFrame:
    """One row per group: the keys, `carry` aggregates, and the wanted quantiles.

    `wanted` gives a column and a probability for each result name. `carry` are further
    aggregates of the rows, computed in the first pass.

    The sketch is off by at most `n / accuracy` ranks and each bracket is four times as wide
    on both sides, so it always holds the wanted ranks, and at most about 10/accuracy of the
    rows. Values next to a bracket are kept as well, for groups too small for that margin.
    `few_groups` says that the number of groups is bounded by definition (horizons, say); the
    brackets are then broadcast. Otherwise only those of groups with more than `large_group` rows are.
    """
    by = list(by)
    carry = dict(carry or {})
    keys = by or ["_all"]
    source = df if by else df.withColumn("_all", F.lit(0))
    all_large = few_groups or not by
    columns = list(dict.fromkeys(column for column, _ in wanted.values()))
    probs = {c: [p for column, p in wanted.values() if column == c] for c in columns}

    # First pass: brackets and further aggregates, one small row per group.
    margin = 4 / accuracy
    sketches = []
    for c in columns:
        edges = [F.lit(q) for p in probs[c] for q in (max(0.0, p - margin), min(1.0, p + margin))]
        sketch = F.percentile_approx(F.col(c).cast("double"), F.array(*edges), F.lit(accuracy))
        sketches.append(sketch.alias(f"_edges_{c}"))
    carried = [column.alias(name) for name, column in carry.items()]
    groups = source.groupBy(*keys).agg(*sketches, F.count("*").alias("_rows"), *(carried if all_large else []))

    # Second pass: rows outside the brackets collapse into one row per stretch, map-side.
    values = [F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in columns]
    rows = source.select(*keys, F.inline(F.array(*values)))
    large = groups if all_large else groups.where(F.col("_rows") > large_group)
    marked = join_keys(rows, F.broadcast(large), keys, "left")
    v = F.col("_v")
    inside, passed = F.lit(False), F.lit(None).cast("double")
    for c in columns:
        mine = F.col("_c") == c
        cuts = F.col(f"_edges_{c}")
        for i in range(len(probs[c])):
            low, high = cuts[2 * i], cuts[2 * i + 1]
            inside = inside | F.coalesce(mine & v.between(low, high), F.lit(False))
            passed = F.greatest(passed, F.when(mine & (v > high), high))
    counted = (
        marked.withColumn("_inside", F.when(F.col("_rows").isNull(), v.isNotNull()).otherwise(inside))
        .groupBy(*keys, "_c", "_inside", F.when(F.col("_inside"), v).otherwise(passed).alias("_place"))
        .agg(
            F.count("_v").alias("_n"),
            F.min("_v").alias("_min"),
            F.max("_v").alias("_max"),
            *[F.first(name).alias(name) for name in carry if all_large],
        )
    )

    # Rows of a group here: the values inside its brackets and one row per stretch between, or all its values.
    whole = Window.partitionBy(*keys, "_c")
    along = whole.orderBy(F.asc_nulls_first("_place"), F.desc("_inside"))
    ranked = counted.withColumns(
        {
            "_end": F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, 0)),
            "_total": F.sum("_n").over(whole),
        }
    ).withColumn("_start", F.col("_end") - F.col("_n"))
    found = []
    for name, (c, p) in wanted.items():
        position = F.lit(float(p)) * (F.col("_total") - 1)
        mine = F.col("_c") == c
        found.append(F.max(F.when(mine, position)).alias(f"_at_{name}"))
        for part, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = mine & (F.col("_start") <= rank) & (rank < F.col("_end"))
            found.append(F.max(F.when(here, _at(rank))).alias(f"_{part}_{name}"))
    picked = ranked.groupBy(*keys).agg(*found, *[F.first(name).alias(name) for name in carry if all_large])
    if carry and not all_large:
        picked = join_keys(picked, source.groupBy(*keys).agg(*carried), keys)
    quantiles = []
    for name in wanted:
        low, high, position = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), F.col(f"_at_{name}")
        quantiles.append((low + (position - F.floor(position)) * (high - low)).alias(name))
    return picked.select(*by, *carry, *quantiles)


def _at(rank: Column) -> Column:
    """The value at a rank: any inside a bracket, the first or last of a stretch outside."""
    unexpected = F.raise_error(F.lit("quantile outside its bracket")).cast("double")
    return (
        F.when(F.col("_inside") | (rank == F.col("_start")), F.col("_min"))
        .when(rank == F.col("_end") - 1, F.col("_max"))
        .otherwise(unexpected)
    )


def histogram_quantile(
    df: DataFrame,
    value: str,
    edges: Sequence[float],
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Quantiles estimated from cumulative bucket counts, linear within a bucket.

    The first bucket starts at 0; a rank beyond the last finite edge gives that edge. One
    aggregation with a counter per edge, so the cost does not depend on group sizes.
    """
    names = list(names) if names else [f"p{round(p * 100):02d}" for p in probs]
    edges = [float(e) for e in edges]
    counters = [F.count_if(F.col(value) <= F.lit(e)).alias(f"_le{i}") for i, e in enumerate(edges)]
    counted = df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), *counters)
    estimates = []
    for p, name in zip(probs, names):
        rank = F.lit(float(p)) * F.col("n")
        estimate = F.lit(edges[-1])
        for i in reversed(range(len(edges))):
            below = F.col(f"_le{i - 1}") if i else F.lit(0)
            start = edges[i - 1] if i else 0.0
            share = F.try_divide(rank - below, F.col(f"_le{i}") - below)
            inside = F.lit(start) + F.lit(edges[i] - start) * F.coalesce(share, F.lit(0.0))
            estimate = F.when(F.col(f"_le{i}") >= rank, inside).otherwise(estimate)
        estimates.append(estimate.alias(name))
    return counted.select(*by, "n", *estimates)
