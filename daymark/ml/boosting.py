"""Boosted regression trees for many models at once, over one binned matrix.

Features become bin numbers once, by quantile edges, and rows are stored in blocks of bounded size by
group (a horizon) and part. A level of the current tree of every model is then one Spark job: each
block sums the gradients and counts of its rows by model, node, feature and bin, the sums of the blocks
meet by model, and the best split of each node comes out of them. Gradients are summed as integers,
so the sums, and with them the trees, do not depend on the order or the number of the blocks.

A group that fits into one block needs no meeting: its sums are the block's, so the levels of its
trees, and several trees, follow one another inside one task. Both ways use the same sums and splits
and give the same trees.

Quantile models fit their trees to the side on which a label lies of its score; a leaf then takes the quantile of
the residuals in it, from summaries that the blocks send after the last level.
"""

from __future__ import annotations

import io
import pickle
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.ml.params import MAX_BINS, checked_params
from daymark.session import cut_lineage, ship

#: Rows of a block at most, on average where rows repeat.
BLOCK_ROWS = 16_384
#: Trees between two writes of the scores, where a group has several blocks.
STORED_TREES = 10
#: Trees of a model that one task grows before its state is written.
TASK_TREES = 50
#: Values of a residual summary.
SUMMARY = 1024
#: Accuracy of the sketches for edges and start values.
SKETCH_ACCURACY = 10_000
#: Gradients are integers of this share of the largest residual at the start.
_UNITS = float(1 << 20)


@dataclass
class Trees:
    """Additive trees: a start value and, per tree, nodes in arrays (feature -1 marks a leaf)."""

    start: float
    parts: list[dict[str, np.ndarray]] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Scores of rows of raw features, one column each; a missing value goes left."""
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for tree in self.parts:
            total += tree["value"][_leaves(tree, "threshold", lambda f: x[rows, f], len(x))]
        return total

    def importance(self, features: int) -> np.ndarray:
        """Share of each feature in the gain of all splits."""
        gains = np.zeros(features)
        for tree in self.parts:
            inner = tree["feature"] >= 0
            np.add.at(gains, tree["feature"][inner], tree["gain"][inner])
        return gains / gains.sum() if gains.sum() > 0 else gains

    def to_lists(self) -> dict[str, Any]:
        return {"start": self.start, "trees": [{k: v.tolist() for k, v in t.items()} for t in self.parts]}

    @classmethod
    def from_lists(cls, saved: Mapping[str, Any]) -> Trees:
        return cls(saved["start"], [{k: np.array(v, _KINDS[k]) for k, v in t.items()} for t in saved["trees"]])


_KINDS = {"feature": np.int32, "bin": np.int32, "threshold": np.float64, "left": np.int32, "right": np.int32, "value": np.float64, "gain": np.float64}


def _leaves(tree: Mapping[str, np.ndarray], limit: str, values, n: int) -> np.ndarray:
    """The leaf of each of n rows; values(f) gives each row's value of its own feature f. Missing values go left."""
    node = np.zeros(n, np.int32)
    while True:
        own = tree["feature"][node]
        if not (own >= 0).any():
            return node
        right = values(np.maximum(own, 0)) > tree[limit][node]
        node = np.where(own >= 0, np.where(right, tree["right"][node], tree["left"][node]), node)


@dataclass
class Booster:
    """A model that is being grown: its group, loss (None: squared, else the quantile) and parameters."""

    name: str
    group: int
    params: dict[str, Any]
    alpha: float | None = None
    trees: Trees | None = None
    unit: float = 1.0

    def gradients(self, label: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Integers (as doubles) whose sums are exact."""
        if self.alpha is None:
            return np.rint((label - score) * self.unit)
        return np.where(label > score, np.rint(self.alpha * _UNITS), np.rint((self.alpha - 1) * _UNITS))

    def per_unit(self) -> float:
        return self.unit if self.alpha is None else _UNITS


class Block:
    """Rows of one block: bins by feature, labels, and hashes that decide on their sampling."""

    def __init__(self, bins: bytes, label: bytes, keys: bytes):
        self.label, self.keys = np.frombuffer(label, np.float64), np.frombuffer(keys, np.uint64)
        self.bins = np.frombuffer(bins, np.uint8).reshape(-1, len(self.label))

    def score(self, model: Booster, since: int = 0, score: np.ndarray | None = None) -> np.ndarray:
        """Scores of the model's trees from number `since` on, on top of given ones."""
        score = np.full(len(self.label), model.trees.start) if score is None else score.copy()
        for tree in model.trees.parts[since:]:
            score += tree["value"][self.leaves(tree)]
        return score

    def leaves(self, tree: Mapping[str, np.ndarray]) -> np.ndarray:
        rows = np.arange(len(self.label))
        return _leaves(tree, "bin", lambda f: self.bins[f, rows], len(rows))

    def sampled(self, model: Booster, number: int) -> np.ndarray:
        share = model.params["subsample"]
        if share >= 1:
            return np.ones(len(self.label), bool)
        # Mixer of the public splitmix generator: fixed values.
        salt = (model.params["random_state"] * 0xD1B54A32D192ED03 + (number + 1) * 0x9E3779B97F4A7C15) & (1 << 64) - 1
        h = self.keys ^ np.uint64(salt)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53) < share


def columns_of(model: Booster, number: int, features: int) -> np.ndarray:
    """The features that tree `number` may use."""
    share = model.params["colsample_bytree"]
    if share >= 1:
        return np.arange(features)
    draw = np.random.default_rng([model.params["random_state"], number])
    return np.sort(draw.permutation(features)[: max(1, round(share * features))])


class Growing:
    """A tree under construction; `open` are the nodes of its newest level."""

    def __init__(self, model: Booster, number: int, widths: Sequence[int]):
        self.model, self.number = model, number
        self.columns = columns_of(model, number, len(widths))
        #: The bins of the tree's features lie one behind the other.
        self.ends = np.cumsum([widths[f] for f in self.columns])
        self.begins = self.ends - [widths[f] for f in self.columns]
        self.open, self.depth = [0], 0
        self.nodes = {k: [] for k in ("feature", "bin", "left", "right", "sum", "count", "gain")}
        self._node(None, None)

    def _node(self, total: float | None, count: float | None) -> int:
        for key, value in (("feature", -1), ("bin", 0), ("left", -1), ("right", -1), ("sum", total), ("count", count), ("gain", 0.0)):
            self.nodes[key].append(value)
        return len(self.nodes["feature"]) - 1

    def shape(self) -> dict[str, np.ndarray]:
        return {k: np.array(self.nodes[k], _KINDS[k]) for k in ("feature", "bin", "left", "right")}

    def sums(self, block: Block, gradients: np.ndarray, sampled: np.ndarray, nodes: Sequence[int] | None = None) -> np.ndarray:
        """Gradients and counts of the sampled rows by node (the open ones, if none are named) and bin of each feature."""
        nodes, width = self.open if nodes is None else nodes, int(self.ends[-1])
        at = np.full(len(self.nodes["feature"]), -1, np.int64)
        at[nodes] = np.arange(len(nodes))
        place = at[block.leaves(self.shape())]
        rows = np.flatnonzero(sampled & (place >= 0))
        place, weights = place[rows] * width, gradients[rows]
        keys = (block.bins[np.ix_(self.columns, rows)] + self.begins[:, None] + place).ravel()
        size = len(nodes) * width
        out = np.stack([np.bincount(keys, np.tile(weights, len(self.columns)), size), np.bincount(keys, minlength=size)])
        return out.reshape(2, len(nodes), width)

    def sums_below(self, block: Block, gradients: np.ndarray, sampled: np.ndarray, above: np.ndarray, parents: Sequence[int]) -> np.ndarray:
        """sums from those of the level above: only the smaller one of two siblings is read, the other is what is left."""
        parent = {child: (i, p) for i, p in enumerate(parents) for child in (self.nodes["left"][p], self.nodes["right"][p]) if child >= 0}
        size = self.nodes["count"]
        smaller = {p: min((self.nodes["left"][p], self.nodes["right"][p]), key=lambda n: (size[n], n)) for _, p in map(parent.__getitem__, self.open)}
        read = sorted(smaller.values())
        found = self.sums(block, gradients, sampled, read)
        where = {n: i for i, n in enumerate(read)}
        out = np.empty((2, len(self.open), found.shape[2]))
        for i, node in enumerate(self.open):
            j, p = parent[node]
            own = found[:, where[smaller[p]]]
            out[:, i] = own if node == smaller[p] else above[:, j] - own
        return out

    def best_splits(self, sums: np.ndarray) -> list[tuple]:
        """For each open node (gain, feature, bin, sum and count at the left, of the node)."""
        p, unit = self.model.params, self.model.per_unit()
        total, count = (x[:, : self.ends[0]].sum(axis=1) for x in sums)
        # Every row lies in one bin of each feature, so each feature before adds the node's total.
        before = np.repeat(np.arange(len(self.ends)), self.ends - self.begins)
        gl, nl = (np.cumsum(x, axis=1) - before * t[:, None] for x, t in zip(sums, (total, count)))
        gr, nr = total[:, None] - gl, count[:, None] - nl
        l1, l2 = p["reg_alpha"] * unit, p["reg_lambda"]
        worth = lambda g, n: np.maximum(np.abs(g) - l1, 0.0) ** 2 / np.maximum(n + l2, 1e-9)
        least = max(p["min_child_samples"], p["min_child_weight"], 1)
        gain = worth(gl, nl) + worth(gr, nr) - worth(total, count)[:, None]
        gain[(nl < least) | (nr < least)] = 0.0
        out = []
        for i, b in enumerate(gain.argmax(axis=1).tolist()):
            c = int(before[b])
            row = float(gain[i, b]) / unit**2, int(self.columns[c]), int(b - self.begins[c])
            out.append((*row, float(gl[i, b]), float(nl[i, b]), float(total[i]), float(count[i])))
        return out

    def split(self, found: Sequence[tuple]) -> bool:
        """Take the splits that gain most, as far as leaves are left; True if a further level may follow."""
        p = self.model.params
        for node, row in zip(self.open, found, strict=True):
            self.nodes["sum"][node], self.nodes["count"][node] = row[5], row[6]
        leaves = self.nodes["feature"].count(-1)
        order = sorted((i for i, row in enumerate(found) if row[0] > 1e-12), key=lambda i: (-found[i][0], i))
        chosen = sorted(order[: max(0, p["num_leaves"] - leaves)])
        following = []
        for i in chosen:
            gain, feature, where, gl, nl, total, count = found[i]
            node = self.open[i]
            left, right = self._node(gl, nl), self._node(total - gl, count - nl)
            for key, value in (("feature", feature), ("bin", where), ("left", left), ("right", right), ("gain", gain)):
                self.nodes[key][node] = value
            following += [left, right]
        self.depth += 1
        self.open = [n for n in following if self.nodes["count"][n] >= 2 * max(p["min_child_samples"], 1)]
        return bool(self.open) and self.depth < p["max_depth"] and self.nodes["feature"].count(-1) < p["num_leaves"]

    def summaries(self, block: Block, residuals: np.ndarray, sampled: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Residuals of the sampled rows by leaf, summed up."""
        leaf = block.leaves(self.shape())
        return {int(n): summary(residuals[sampled & (leaf == n)]) for n in np.unique(leaf[sampled])}

    def finished(self, edges: Sequence[np.ndarray], quantiles: Mapping[int, float] | None = None) -> dict[str, np.ndarray]:
        """The tree with its thresholds and leaf values, scaled by the learning rate."""
        p, unit = self.model.params, self.model.per_unit()
        tree = self.shape()
        inner = tree["feature"] >= 0
        tree["threshold"] = np.array([edges[f][b] if f >= 0 and b < len(edges[f]) else np.inf for f, b in zip(tree["feature"], tree["bin"])])
        value = np.zeros(len(inner))
        for n in np.flatnonzero(~inner).tolist():
            if quantiles is not None:
                value[n] = quantiles.get(n, 0.0)
            elif self.nodes["count"][n]:
                g = self.nodes["sum"][n] / unit
                value[n] = np.sign(g) * max(abs(g) - p["reg_alpha"], 0.0) / max(self.nodes["count"][n] + p["reg_lambda"], 1e-9)
        tree["value"] = p["learning_rate"] * value
        tree["gain"] = np.array(self.nodes["gain"], np.float64)
        return tree


def summary(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Values with weights in order; more than SUMMARY of them are joined by equal shares of the weight."""
    order = np.argsort(values, kind="stable")
    values = values[order]
    weights = np.ones(len(values)) if weights is None else weights[order]
    if len(values) <= SUMMARY:
        return values, weights
    total = np.cumsum(weights)
    wanted = (np.arange(SUMMARY) + 0.5) / SUMMARY * total[-1]
    return values[np.searchsorted(total, wanted)], np.full(SUMMARY, total[-1] / SUMMARY)


def quantile_of(parts: Sequence[tuple[np.ndarray, np.ndarray]], alpha: float) -> float:
    values, weights = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((weights, values))
    total = np.cumsum(weights[order])
    return float(values[order][min(np.searchsorted(total, alpha * total[-1]), len(values) - 1)])


# The matrix.


@dataclass
class Matrix:
    """Stored blocks of binned rows with the edges of the bins; `single` groups have one block for training."""

    blocks: DataFrame
    features: list[str]
    edges: list[np.ndarray]
    starts: dict[int, dict[str, float]]
    single: set[int]


BLOCKS = "grp int, part string, block bigint, bins binary, label binary, keys binary"


def binned(rows: DataFrame, features: Sequence[str], label: str, group: str | None = None, part: str | None = None, train: str = "train", quantiles: Sequence[float] = ()) -> Matrix:
    """Bin the labelled rows and store them by group and part.

    Edges and start values (mean and `quantiles` of the label) come from the rows of the part `train`.
    """
    ship(rows.sparkSession)
    features = list(features)
    plain = rows.select(
        (F.col(group) if group else F.lit(0)).cast("int").alias("grp"),
        (F.col(part) if part else F.lit(train)).alias("part"),
        *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)],
        F.col(label).cast("double").alias("label"),
    ).where("label IS NOT NULL")
    names = [f"f{i}" for i in range(len(features))]
    plain = cut_lineage(plain.withColumn("key", F.xxhash64(*names, "label")))
    learned = plain.where(F.col("part") == train)
    probs = F.array(*[F.lit(i / MAX_BINS) for i in range(1, MAX_BINS)])
    found = learned.agg(*[F.percentile_approx(n, probs, F.lit(SKETCH_ACCURACY)).alias(n) for n in names]).first()
    edges = [np.unique(np.array([v for v in found[n] or [] if v == v], np.float64)) for n in names]
    facts = [F.count("*").alias("n"), F.round(F.avg("label"), 9).alias("mean"), F.min("label").alias("low"), F.max("label").alias("high")]
    facts += [F.percentile_approx("label", F.lit(float(a)), F.lit(SKETCH_ACCURACY)).alias(f"q{i}") for i, a in enumerate(quantiles)]
    starts = {r["grp"]: r.asDict() for r in learned.groupBy("grp").agg(*facts).collect()}  # one row for each group
    if not starts:
        raise ValueError("no labelled rows to fit on")
    for own in starts.values():
        own.update({f"quantile {a}": own[f"q{i}"] for i, a in enumerate(quantiles)})
    counts = plain.groupBy("grp", "part").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("bigint").alias("blocks"))
    dealt = plain.join(F.broadcast(counts), ["grp", "part"]).withColumn("block", F.pmod("key", "blocks")).drop("blocks")

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["key", "label", *names])
        bins = np.stack([np.searchsorted(e, np.nan_to_num(frame[n].to_numpy(np.float64), nan=-np.inf)) for n, e in zip(names, edges)]) if names else np.empty((0, len(frame)))
        first = frame.iloc[0]
        return pd.DataFrame(
            {
                "grp": [first["grp"]],
                "part": [first["part"]],
                "block": [first["block"]],
                "bins": [bins.astype(np.uint8).tobytes()],
                "label": [frame["label"].to_numpy(np.float64).tobytes()],
                "keys": [frame["key"].to_numpy(np.int64).tobytes()],
            }
        )

    blocks = cut_lineage(dealt.groupBy("grp", "part", "block").applyInPandas(pack, BLOCKS))
    return Matrix(blocks, features, edges, starts, {g for g, own in starts.items() if own["n"] <= BLOCK_ROWS})


def booster(matrix: Matrix, name: str, group: int, params: Mapping[str, Any] | None = None, alpha: float | None = None) -> Booster:
    """A model without trees, at its start value."""
    if group not in matrix.starts:
        raise ValueError(f"no labelled rows to fit on for {group}")
    own = matrix.starts[group]
    start = own["mean"] if alpha is None else own[f"quantile {alpha}"]
    spread = max(abs(own["high"] - start), abs(own["low"] - start))
    return Booster(name, group, checked_params(params), alpha, Trees(float(start)), _UNITS / spread if spread > 0 else 1.0)


# Growth.


def grow(matrix: Matrix, models: Sequence[Booster], rounds: Mapping[str, int]) -> None:
    """Grow every model to so many trees (fewer are never cut off)."""
    pending = [m for m in models if len(m.trees.parts) < rounds[m.name]]
    _grow_in_tasks(matrix, [m for m in pending if m.group in matrix.single], rounds)
    _grow_by_levels(matrix, [m for m in pending if m.group not in matrix.single], rounds)


def widths_of(edges: Sequence[np.ndarray]) -> list[int]:
    """Bins of each feature."""
    return [len(e) + 1 for e in edges]


def _next_tree(block: Block, model: Booster, score: np.ndarray, edges: Sequence[np.ndarray]) -> dict[str, np.ndarray]:
    """The next tree of a model whose rows are all in one block."""
    number = len(model.trees.parts)
    growing, sampled = Growing(model, number, widths_of(edges)), block.sampled(model, number)
    gradients = model.gradients(block.label, score)
    sums = growing.sums(block, gradients, sampled)
    while True:
        parents = growing.open
        if not growing.split(growing.best_splits(sums)):
            break
        sums = growing.sums_below(block, gradients, sampled, sums, parents)
    quantiles = None
    if model.alpha is not None:
        found = growing.summaries(block, block.label - score, sampled)
        quantiles = {n: quantile_of([s], model.alpha) for n, s in found.items()}
    return growing.finished(edges, quantiles)


def _grow_in_tasks(matrix: Matrix, models: Sequence[Booster], rounds: Mapping[str, int]) -> None:
    """One task for each model of a group with one block; TASK_TREES trees in a job."""
    spark = matrix.blocks.sparkSession
    pending = list(models)
    while pending:
        shared = spark.sparkContext.broadcast((pending, matrix.edges))
        numbers = [(i, m.group) for i, m in enumerate(pending)]
        asked = spark.createDataFrame(numbers, "number int, grp int").join(matrix.blocks.where("part = 'train'"), "grp")
        ends = {m.name: min(rounds[m.name], len(m.trees.parts) + TASK_TREES) for m in pending}

        def work(batches: Iterator[pa.RecordBatch], shared=shared, ends=ends) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    models, edges = shared.value
                    model, block = models[row["number"]], Block(row["bins"], row["label"], row["keys"])
                    score, fresh = block.score(model), len(model.trees.parts)
                    while len(model.trees.parts) < ends[model.name]:
                        tree = _next_tree(block, model, score, edges)
                        model.trees.parts.append(tree)
                        score += tree["value"][block.leaves(tree)]
                    added = pickle.dumps(model.trees.parts[fresh:])
                    del model.trees.parts[fresh:]
                    yield pa.RecordBatch.from_pydict({"number": pa.array([row["number"]], pa.int32()), "trees": pa.array([added], pa.binary())})

        dealt = asked.repartitionByRange(len(pending), "number")
        # The trees of a model are bounded by its parameters, whatever the rows.
        for row in dealt.mapInArrow(work, "number int, trees binary").collect():
            pending[row["number"]].trees.parts += pickle.loads(row["trees"])
        shared.unpersist()
        pending = [m for m in pending if len(m.trees.parts) < rounds[m.name]]


def _saved(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, array, allow_pickle=False)
    return out.getvalue()


def _grow_by_levels(matrix: Matrix, models: Sequence[Booster], rounds: Mapping[str, int]) -> None:
    """One job for each level of the current trees of all models, over all blocks."""
    if not models:
        return
    spark = matrix.blocks.sparkSession
    blocks = matrix.blocks.where("part = 'train'").withColumn("scores", F.lit(None).cast("binary"))
    names = {m.name for m in models}
    blocks = blocks.where(F.col("grp").isin(sorted({m.group for m in models})))
    done = {n: 0 for n in names}
    pending, since = list(models), 0

    def scored(row: dict[str, Any], own: Sequence[Booster], done: Mapping[str, int]) -> tuple[Block, dict[str, np.ndarray]]:
        block = Block(row["bins"], row["label"], row["keys"])
        base = pickle.loads(row["scores"]) if row["scores"] else {}
        return block, {m.name: block.score(m, done[m.name], base.get(m.name)) for m in own}

    while pending:
        growing = [Growing(m, len(m.trees.parts), widths_of(matrix.edges)) for m in pending]
        active = list(growing)
        while active:
            found = _level(spark, blocks, active, done, scored)
            active = [g for g in active if g.split(found[g.model.name])]
        quantiles = _leaf_quantiles(spark, blocks, [g for g in growing if g.model.alpha is not None], done, scored)
        for g in growing:
            own = None if g.model.alpha is None else quantiles.get(g.model.name, {})
            g.model.trees.parts.append(g.finished(matrix.edges, own))
        pending, since = [m for m in pending if len(m.trees.parts) < rounds[m.name]], since + 1
        if pending and since % STORED_TREES == 0:
            blocks = cut_lineage(_rescored(spark, blocks, pending, dict(done), scored))
            done.update({m.name: len(m.trees.parts) for m in pending})


def _by_group(models: Sequence[Any], group) -> dict[int, list[Any]]:
    out: dict[int, list[Any]] = {}
    for m in models:
        out.setdefault(group(m), []).append(m)
    return out


def _level(spark, blocks: DataFrame, active: Sequence[Growing], done: Mapping[str, int], scored) -> dict[str, list[tuple]]:
    """Best splits of the open nodes of all models."""
    shared = spark.sparkContext.broadcast((_by_group(active, lambda g: g.model.group), dict(done)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, done = shared.value
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                own = groups.get(row["grp"], [])
                block, scores = scored(row, [g.model for g in own], done)
                for g in own:
                    score = scores[g.model.name]
                    sums = g.sums(block, g.model.gradients(block.label, score), block.sampled(g.model, g.number))
                    if g.model.name in total:
                        total[g.model.name] += sums
                    else:
                        total[g.model.name] = sums
        for name, sums in total.items():
            yield pa.RecordBatch.from_pydict({"name": [name], "sums": pa.array([_saved(sums)], pa.binary())})

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        name = frame["name"].iat[0]
        g = next(g for own in shared.value[0].values() for g in own if g.model.name == name)
        sums = sum(np.load(io.BytesIO(s)) for s in frame["sums"])
        return pd.DataFrame({"name": [name], "found": [pickle.dumps(g.best_splits(sums))]})

    partial = blocks.mapInArrow(add, "name string, sums binary")
    rows = partial.groupBy("name").applyInPandas(choose, "name string, found binary").collect()  # a few numbers for each node
    shared.unpersist()
    return {r["name"]: pickle.loads(r["found"]) for r in rows}


def _leaf_quantiles(spark, blocks: DataFrame, growing: Sequence[Growing], done: Mapping[str, int], scored) -> dict[str, dict[int, float]]:
    """Quantile of the residuals of each leaf, from the summaries of all blocks."""
    if not growing:
        return {}
    shared = spark.sparkContext.broadcast((_by_group(growing, lambda g: g.model.group), dict(done)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, done = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                own = groups.get(row["grp"], [])
                block, scores = scored(row, [g.model for g in own], done)
                found = {g.model.name: g.summaries(block, block.label - scores[g.model.name], block.sampled(g.model, g.number)) for g in own}
                if found:
                    yield pa.RecordBatch.from_pydict({"name": list(found), "parts": pa.array([pickle.dumps(x) for x in found.values()], pa.binary())})

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        name, leaves = frame["name"].iat[0], {}
        alpha = next(g.model.alpha for own in shared.value[0].values() for g in own if g.model.name == name)
        for part in frame["parts"]:
            for leaf, values in pickle.loads(part).items():
                leaves.setdefault(leaf, []).append(values)
        return pd.DataFrame({"name": [name], "found": [pickle.dumps({n: quantile_of(parts, alpha) for n, parts in leaves.items()})]})

    partial = blocks.mapInArrow(add, "name string, parts binary")
    rows = partial.groupBy("name").applyInPandas(choose, "name string, found binary").collect()  # one number for each leaf
    shared.unpersist()
    return {r["name"]: pickle.loads(r["found"]) for r in rows}


def _rescored(spark, blocks: DataFrame, models: Sequence[Booster], done: Mapping[str, int], scored) -> DataFrame:
    """The blocks with the scores of all trees so far."""
    shared = spark.sparkContext.broadcast((_by_group(models, lambda m: m.group), done))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, done = shared.value
        for batch in batches:
            at = batch.schema.get_field_index("scores")
            for i, row in enumerate(batch.to_pylist()):
                _, scores = scored(row, groups.get(row["grp"], []), done)
                yield batch.slice(i, 1).set_column(at, "scores", pa.array([pickle.dumps(scores)], pa.binary()))

    return blocks.mapInArrow(add, blocks.schema)


def absolute_errors(matrix: Matrix, models: Sequence[Booster], part: str = "val") -> dict[str, float]:
    """Mean absolute error of each model on the rows of its group in a part."""
    spark = matrix.blocks.sparkSession
    shared = spark.sparkContext.broadcast(_by_group(models, lambda m: m.group))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, own = Block(row["bins"], row["label"], row["keys"]), shared.value.get(row["grp"], [])
                errors = [float(np.abs(block.label - block.score(m)).sum()) for m in own]
                yield pa.RecordBatch.from_pydict(
                    {"name": pa.array([m.name for m in own], pa.string()), "total": pa.array(errors, pa.float64()), "n": pa.array([len(block.label)] * len(own), pa.int64())}
                )

    found = matrix.blocks.where(F.col("part") == part).mapInArrow(add, "name string, total double, n bigint")
    rows = found.groupBy("name").agg((F.sum("total") / F.sum("n")).alias("mae")).collect()  # one row for each model
    shared.unpersist()
    return {r["name"]: r["mae"] for r in rows}
