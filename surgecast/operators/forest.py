"""ML9 random cut forest with displacement scores.

A tree halves its sample by random cuts, each through a dimension chosen in
proportion to its range. A point's score is its expected collusive displacement:
were it inserted, a cut through the box widened by it would part it from a
node's points with a probability known from the widening alone; parted there, it
displaces them, and the score takes the largest ratio of a sibling's size to
that of the subtree with the point, here or further up. The score is the mean
over all places where the point could end up, so no random insertion is needed,
and then over the trees.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values (the reference's forest) -----------------------------------
RCF_TREES = 70
RCF_SAMPLES = 512

#: A leaf has dim -1 and its (equal) points' place; inner nodes have no place.
TREE_SCHEMA = "tree_id int, node int, dim int, cut double, left int, right int, size int, place array<double>"
#: Rows scored at a time; bounds a task's arrays to rows x features.
SCORE_ROWS = 2048


def build_tree(x: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Nodes (dim, cut, left, right, size, place) of a random cut tree, parents first,
    grown until points are alone or equal."""
    nodes: list[tuple] = [()]
    todo = [(0, np.arange(len(x)))]
    while todo:
        me, idx = todo.pop()
        pts = x[idx]
        lo, hi = pts.min(axis=0), pts.max(axis=0)
        span = hi - lo
        if span.sum() <= 0:
            nodes[me] = (-1, 0.0, -1, -1, len(idx), pts[0])
            continue
        dim = int(rng.choice(len(span), p=span / span.sum()))
        cut = min(float(rng.uniform(lo[dim], hi[dim])), float(np.nextafter(hi[dim], lo[dim])))
        low = pts[:, dim] <= cut
        left, right = len(nodes), len(nodes) + 1
        nodes += [(), ()]
        nodes[me] = (dim, cut, left, right, len(idx), None)
        todo += [(right, idx[~low]), (left, idx[low])]
    return nodes


class Tree:
    """A tree's nodes as arrays, with the box of each node's points."""

    def __init__(self, dim, cut, left, right, size, lo: np.ndarray, hi: np.ndarray):
        """``lo`` and ``hi``: the leaves' places, anything in the other rows."""
        self.dim, self.cut, self.left, self.right, self.size = dim, cut, left, right, size
        self.lo, self.hi = lo.copy(), hi.copy()
        for i in np.flatnonzero(dim >= 0)[::-1].tolist():  # children come after their parents
            self.lo[i] = np.minimum(self.lo[left[i]], self.lo[right[i]])
            self.hi[i] = np.maximum(self.hi[left[i]], self.hi[right[i]])

    def displacement(self, x: np.ndarray) -> np.ndarray:
        """Expected collusive displacement of each row of ``x``, were it inserted."""
        m = len(x)
        node = np.zeros(m, np.int64)
        stays = np.ones(m)  # probability that the point gets this far down
        above = np.zeros(m)  # largest ratio among the node's ancestors
        score = np.zeros(m)
        live = np.arange(m)
        while len(live):
            at, p = node[live], x[live]
            lo, hi = self.lo[at], self.hi[at]
            wider = (np.maximum(lo - p, 0) + np.maximum(p - hi, 0)).sum(1)
            whole = wider + (hi - lo).sum(1)
            parted = np.divide(wider, whole, out=np.zeros(len(live)), where=whole > 0)
            size = self.size[at].astype(float)
            score[live] += stays[live] * parted * np.maximum(size, above[live])
            stays[live] *= 1 - parted
            leaf = self.dim[at] < 0
            ends = live[leaf]  # equal to the leaf's points: counted with them
            score[ends] += stays[ends] * above[ends]
            live, at, p, size = live[~leaf], at[~leaf], p[~leaf], size[~leaf]
            low = p[np.arange(len(live)), self.dim[at]] <= self.cut[at]
            child = np.where(low, self.left[at], self.right[at])
            inside = self.size[child]
            above[live] = np.maximum(above[live], (size - inside) / (inside + 1))
            node[live] = child
        return score


def sample_limit(n: int, sample_size: int) -> int | None:
    """Signed 64-bit hashes below this are offered to a tree: about twice the
    sample, never fewer than 64 expected. None: all rows."""
    wanted = max(2 * sample_size, sample_size + 64)
    return None if wanted >= n else (wanted * (1 << 64)) // n - (1 << 63)


def rcf_fit(train: DataFrame, features: Sequence[str], *, key: Sequence[str] | None = None, n_trees: int = RCF_TREES,
            sample_size: int = RCF_SAMPLES, seed: int = 7) -> DataFrame:
    """ML9 fit: each tree takes the ``sample_size`` rows of smallest hash of
    (row key, tree), of those a 64-bit hash limit offers it, and is grown in its
    own group. ``key`` names the columns that tell rows apart (default: the
    features, which makes equal rows come together). The model is a small table
    (trees x nodes), bounded by n_trees x 2 x sample_size rows. No rows to train
    on are an error."""
    feats = list(features)
    n = train.count()
    if not n:
        raise ValueError("no rows to grow a forest from")
    limit = sample_limit(n, sample_size)
    row = F.xxhash64(*[F.col(c) for c in (key or feats)], F.lit(seed))
    own = lambda i: F.xxhash64(row, i)
    offers = F.transform(F.array(*[F.lit(i) for i in range(n_trees)]), lambda i: F.struct(i.alias("tree_id"), own(i).alias("_h")))
    if limit is not None:
        offers = F.filter(offers, lambda o: o["_h"] < limit)
    picked = train.select(*feats, F.explode(offers).alias("o")).select(*feats, "o.*")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tid = int(pdf["tree_id"].iloc[0])
        pdf = pdf.sort_values(["_h", *feats], kind="mergesort")  # independent of partitioning
        x = pdf[feats].to_numpy(dtype=float)[:sample_size]
        nodes = build_tree(x, np.random.default_rng(seed * 1000 + tid))
        rows = [(tid, i, *n[:5], None if n[5] is None else n[5].tolist()) for i, n in enumerate(nodes)]
        return pd.DataFrame(rows, columns=["tree_id", "node", "dim", "cut", "left", "right", "size", "place"])

    return picked.groupBy("tree_id").applyInPandas(build, TREE_SCHEMA)


def _arrays(rows: list, n_features: int) -> list[tuple[np.ndarray, ...]]:
    """Each tree's columns, the leaves' places in rows of their nodes."""
    trees: dict[int, list] = {}
    for r in rows:
        trees.setdefault(r.tree_id, []).append(r)
    out = []
    for nodes in trees.values():
        place = np.zeros((len(nodes), n_features))
        for i, r in enumerate(nodes):
            if r.place is not None:
                place[i] = r.place
        out.append(tuple(np.array([r[c] for r in nodes]) for c in ("dim", "cut", "left", "right", "size")) + (place,))
    return out


def rcf_score(df: DataFrame, trees: DataFrame, features: Sequence[str], out: str = "score") -> DataFrame:
    """ML9 score: mean expected displacement over the trees, larger for outliers.

    The forest is bounded (trees x sample x features numbers) and is shipped once
    as a broadcast variable; scoring is Arrow-batched, a tree's boxes at a time."""
    feats = list(features)
    rows = trees.orderBy("tree_id", "node").collect()  # bounded: n_trees x 2 x sample_size
    if not rows:
        raise ValueError("the forest has no trees")
    bc = df.sparkSession.sparkContext.broadcast(_arrays(rows, len(feats)))
    schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T.DoubleType())])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = [Tree(*t[:5], t[5], t[5]) for t in bc.value]
        for pdf in batches:
            x = pdf[feats].to_numpy(dtype=float)
            s = np.zeros(len(x))
            for a in range(0, len(x), SCORE_ROWS):
                for tree in forest:
                    s[a : a + SCORE_ROWS] += tree.displacement(x[a : a + SCORE_ROWS])
            yield pdf.drop(columns=[out], errors="ignore").assign(**{out: s / len(forest)})

    return df.mapInPandas(score, schema)
