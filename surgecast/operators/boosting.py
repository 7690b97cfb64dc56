"""ML5 second-order gradient boosting by histograms.

Features are cut once into bins at their quantiles. A tree grows level by level:
every task adds up the gradients and Hessians of its rows by node, feature and
bin; the sums of a (node, feature) meet in one place, which finds the best cut;
the driver gets one candidate a node and feature and keeps the best one of each
node. So what is shuffled and collected depends on nodes, features and bins, not
on rows. Rows keep their prediction so far; it is written anew every few trees.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgecast.session import materialize

#: Trees between two writings of the rows' predictions.
REWRITE = 16


@dataclass(frozen=True)
class BoostSettings:
    """The reference's rounds, depth and rate; the regularisation of the published method.

    ``l1`` and ``l2`` shrink leaf values, ``gamma`` is the least gain of a cut,
    ``min_weight`` the least Hessian (weight of rows) of a child; each tree sees a
    share ``rows`` of the rows, picked by hash, and ``columns`` of the features."""

    rounds: int = 80
    depth: int = 6
    eta: float = 0.15
    l1: float = 0.0
    l2: float = 1.0
    gamma: float = 0.0
    min_weight: float = 1.0
    rows: float = 1.0
    columns: float = 1.0
    seed: int = 42
    base: float = 0.5
    bins: int = 64


# ---- fixed values (the reference's two boosted models) ------------------------
FIRST_MODEL = BoostSettings(rounds=80, depth=6, eta=0.15, l1=1.05, l2=0.1, rows=0.9, columns=0.5)
SECOND_MODEL = BoostSettings(rounds=45, depth=6, eta=0.15, l1=0.55, l2=1.0, rows=0.7, columns=0.9)


def _pull(g: np.ndarray, l1: float) -> np.ndarray:
    """Gradient sum drawn towards 0 by ``l1``."""
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def leaf_value(g: float, h: float, s: BoostSettings) -> float:
    return float(-s.eta * _pull(np.float64(g), s.l1) / (h + s.l2)) if h + s.l2 > 0 else 0.0


def best_cut(hist: np.ndarray, s: BoostSettings) -> tuple[float, int, float, float, float, float]:
    """(gain, last bin on the left, its gradient and Hessian, the node's) of the best
    cut of a bins x 2 histogram; a gain of -inf where no cut is allowed. Of equal
    gains the first bin counts."""
    left = np.cumsum(hist, axis=0)
    total = left[-1]
    g, h = left[:-1, 0], left[:-1, 1]
    rg, rh = total[0] - g, total[1] - h
    with np.errstate(divide="ignore", invalid="ignore"):
        score = lambda g, h: np.where(h + s.l2 > 0, _pull(g, s.l1) ** 2 / (h + s.l2), 0.0)
        gain = (score(g, h) + score(rg, rh) - score(total[0], total[1])) / 2 - s.gamma
    gain = np.where((h >= s.min_weight) & (rh >= s.min_weight), gain, -np.inf)
    if not len(gain):
        return -np.inf, -1, 0.0, 0.0, float(total[0]), float(total[1])
    at = int(np.argmax(gain))
    return float(gain[at]), at, float(g[at]), float(h[at]), float(total[0]), float(total[1])


@dataclass
class Tree:
    """Nodes of one tree: cut feature (-1: leaf), last bin on the left, left child, value.
    The right child follows the left one."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, values: tuple[float, float]) -> int:
        first = len(self.feature)
        self.feature[node], self.cut[node], self.left[node] = feature, cut, first
        self.feature += [-1, -1]
        self.cut += [0, 0]
        self.left += [0, 0]
        self.value += values
        return first

    def node_of(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of each row of bins."""
        feature, cut, left = np.array(self.feature), np.array(self.cut), np.array(self.left)
        node = np.zeros(len(bins), np.int64)
        live = np.flatnonzero(feature[node] >= 0)
        while len(live):
            at = node[live]
            node[live] = left[at] + (bins[live, feature[at]] > cut[at])
            live = live[feature[node[live]] >= 0]
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.node_of(bins)]


@dataclass
class Boosted:
    """A fitted model: features, their bin edges, trees."""

    features: list[str]
    edges: list[np.ndarray]
    settings: BoostSettings
    trees: list[Tree] = field(default_factory=list)

    def bins_of(self, x: np.ndarray) -> np.ndarray:
        """Bin of each value: 0 for missing ones, else one more than the edges below it."""
        out = np.zeros(x.shape, np.uint8)
        for j, e in enumerate(self.edges):
            out[:, j] = np.where(np.isnan(x[:, j]), 0, 1 + np.searchsorted(e, x[:, j], "left"))
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins_of(x)
        return self.settings.base + sum((t.predict(bins) for t in self.trees), np.zeros(len(x)))


def _matrix(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Columns as doubles, nulls as NaN."""
    cols = [batch.column(batch.schema.names.index(c)).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in names]
    return np.stack(cols, 1) if cols else np.zeros((batch.num_rows, 0))


def _sampled(h: np.ndarray, tree: int, s: BoostSettings) -> np.ndarray:
    """Whether a tree sees each row, by the row's hash."""
    if s.rows >= 1:
        return np.ones(len(h), bool)
    x = h.view(np.uint64) ^ np.uint64((s.seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(s.rows * (1 << 64)))


def _columns(n: int, tree: int, s: BoostSettings) -> np.ndarray:
    """The features a tree sees."""
    k = max(1, int(s.columns * n))
    return np.arange(n) if k >= n else np.sort(np.random.default_rng([s.seed, tree]).choice(n, k, replace=False))


def fit(df: DataFrame, features: Sequence[str], settings: BoostSettings = BoostSettings(), label: str = "y", weight: str | None = None, key: Sequence[str] = ()) -> Boosted:
    """Fit squared-error trees to the rows of ``df`` that have a label.

    ``key`` names columns that tell rows apart when trees see a share of them
    (default: all features and the label, so that equal rows go together). Missing feature values have a bin of their own, below all others; a null or
    negative weight counts as 0. No rows are an error. Sums of doubles depend on
    the order of tasks in the last digits only.
    """
    feats, s = list(features), settings
    if not 2 <= s.bins <= 255:
        raise ValueError("bins must be 2 to 255")
    w = F.coalesce(F.greatest(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0)) if weight else F.lit(1.0)
    own = F.xxhash64(*[F.col(f"`{c}`") for c in (key or [*feats, label])])
    src = df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("_y"), w.alias("_w"), own.alias("_h"), *[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(feats)])
    probs = [i / (s.bins - 1) for i in range(1, s.bins - 1)]
    row = src.agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(F.nanvl(f"_{i}", F.lit(None)), probs, 10_000).alias(f"q{i}") for i in range(len(feats))]).first()
    if not row["n"]:
        raise ValueError("no rows to fit")
    model = Boosted(feats, [np.unique(np.array(row[f"q{i}"] or [], float)) for i in range(len(feats))], s)
    names = [f"_{i}" for i in range(len(feats))]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = model.bins_of(_matrix(b, names))
            base = pa.array(np.full(b.num_rows, s.base))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), base, pa.array([r.tobytes() for r in bins], pa.binary()), b.column(2)], names=["y", "w", "f", "bins", "h"])

    rows = materialize(src.mapInArrow(cut, "y double, w double, f double, bins binary, h long"))
    held: list[Tree] = []  # trees that aren't in the rows' predictions yet
    for i in range(s.rounds):
        tree = _grow(rows, held, len(feats), i, s)
        model.trees.append(tree)
        held.append(tree)
        if len(tree.feature) == 1 and not tree.value[0] and s.rows >= 1 and s.columns >= 1:
            break  # nothing is left to learn: later trees would be empty, too
        if len(held) == REWRITE and len(model.trees) < s.rounds:
            rows, held = materialize(rows.mapInArrow(_advance(held, len(feats)), rows.schema)), []
    return model


def _bins(batch: pa.RecordBatch, n: int) -> np.ndarray:
    data = b"".join(batch.column(3).to_pylist())
    return np.frombuffer(data, np.uint8).reshape(batch.num_rows, n)


def _advance(trees: list[Tree], n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = _bins(b, n)
            f = b.column(2).to_numpy() + sum(t.predict(bins) for t in trees)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(f), b.column(3), b.column(4)], names=b.schema.names)

    return run


def _grow(rows: DataFrame, held: list[Tree], n: int, number: int, s: BoostSettings) -> Tree:
    """One tree, a job a level."""
    tree, open_nodes = Tree(), [0]
    held, seen = list(held), _columns(n, number, s)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(len(tree.feature), -1)
        place[open_nodes] = np.arange(len(open_nodes))
        hist = np.zeros((len(open_nodes), n, s.bins + 1, 2))
        for b in batches:
            bins = _bins(b, n)
            y, w, f = (b.column(i).to_numpy() for i in range(3))
            g = w * (f + sum(t.predict(bins) for t in held) - y)
            at = place[tree.node_of(bins)]
            use = np.flatnonzero((at >= 0) & _sampled(b.column(4).to_numpy(), number, s))
            for j in seen:
                cell = at[use] * (s.bins + 1) + bins[use, j]
                for k, v in enumerate((g, w)):
                    hist[:, j, :, k] += np.bincount(cell, v[use], len(open_nodes) * (s.bins + 1)).reshape(len(open_nodes), -1)
        full = hist[..., 1].any(axis=2)
        node, feature = np.nonzero(full)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node.astype(np.int32)), pa.array(feature.astype(np.int32)), pa.array([hist[i, j].tobytes() for i, j in zip(node, feature)], pa.binary())],
            names=["node", "feature", "hist"])

    def best(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(h, float) for h in table.column("hist").to_pylist()).reshape(-1, 2)
        cut = best_cut(total, s)
        cols = {"node": table.column("node")[:1], "feature": table.column("feature")[:1]}
        kinds = [pa.float64(), pa.int32()] + [pa.float64()] * 4
        return pa.table(cols | {k: pa.array([v], t) for k, v, t in zip(("gain", "cut", "lg", "lh", "g", "h"), cut, kinds)})

    for level in range(max(s.depth, 1)):
        if not open_nodes:
            break
        found = rows.mapInArrow(sums, "node int, feature int, hist binary").groupBy("node", "feature")
        got = found.applyInArrow(best, "node int, feature int, gain double, cut int, lg double, lh double, g double, h double").collect()
        by_node: dict[int, list] = {}
        for r in got:
            by_node.setdefault(r.node, []).append(r)
        after = []
        for i, node in enumerate(open_nodes):
            offers = by_node.get(i, [])
            if not level and offers:
                tree.value[0] = leaf_value(offers[0].g, offers[0].h, s)
            top = max(offers, key=lambda r: (r.gain, -r.feature), default=None)
            if top is not None and top.gain > 1e-12 and level < s.depth:
                sides = leaf_value(top.lg, top.lh, s), leaf_value(top.g - top.lg, top.h - top.lh, s)
                first = tree.split(node, top.feature, top.cut, sides)
                after += [first, first + 1]
        open_nodes = after
    return tree


def score(df: DataFrame, model: Boosted, out: str = "prediction") -> DataFrame:
    """Predictions of every row of ``df``; other columns pass through. The model is
    bounded (rounds x 2^depth nodes) and is shipped once."""
    kept = [f for f in df.schema.fields if f.name != out]
    names = [f"_f{i}" for i in range(len(model.features))]
    src = df.select(*[F.col(f"`{f.name}`").alias(f"_c{i}") for i, f in enumerate(kept)],  # by place: names may hold dots
                    *[F.col(f"`{c}`").cast("double").alias(n) for n, c in zip(names, model.features)])
    schema = T.StructType([*kept, T.StructField(out, T.DoubleType())])
    bc = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = pa.array(bc.value.predict(_matrix(b, names)))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], got], names=schema.names)

    return src.mapInArrow(run, schema)


def to_table(df_session, model: Boosted) -> DataFrame:
    """The model as rows (kind, tree, node, feature, cut, left, value): edges and nodes, bounded."""
    rows = [("edge", 0, i, j, 0, 0, float(e)) for j, es in enumerate(model.edges) for i, e in enumerate(es)]
    rows += [("node", t, i, *x) for t, tree in enumerate(model.trees) for i, x in enumerate(zip(tree.feature, tree.cut, tree.left, map(float, tree.value)))]
    rows += [("name:" + c, 0, 0, j, 0, 0, 0.0) for j, c in enumerate(model.features)]
    rows.append(("base", 0, 0, 0, 0, 0, model.settings.base))
    return df_session.createDataFrame(rows, "kind string, tree int, node int, feature int, cut int, left int, value double")


def from_table(table: DataFrame) -> Boosted:
    """The model that ``to_table`` made, for scoring."""
    names: dict[int, str] = {}
    edges: dict[int, list] = {}
    nodes: dict[int, list] = {}
    base = 0.0
    for r in table.orderBy("kind", "tree", "node").collect():
        if r.kind == "edge":
            edges.setdefault(r.feature, []).append(r.value)
        elif r.kind == "node":
            nodes.setdefault(r.tree, []).append(r)
        elif r.kind == "base":
            base = r.value
        else:
            names[r.feature] = r.kind.removeprefix("name:")
    model = Boosted([names[j] for j in range(len(names))], [np.array(sorted(edges.get(j, []))) for j in range(len(names))], BoostSettings(base=base))
    for t in sorted(nodes):
        model.trees.append(Tree(*[[r[c] for r in nodes[t]] for c in ("feature", "cut", "left", "value")]))
    return model
