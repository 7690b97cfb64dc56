"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into 1, 4, then 16 segments; each keeps its mean and the norm
of its deviation from it. For two vectors, means give the inner product of the
segments' flat parts, and the product of the deviation norms is the most that
the rest can add (Cauchy-Schwarz): an upper bound of the score, which is a
lower bound of the distance. Bounds go from coarse to fine; pairs under the
k-th best exact score known so far fall out, and the survivors are computed
exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surgecast.session import ship_package

SCALE, K, EVERY = 1024, 10, 100
SEGMENTS = (1, 4, 16)
#: Candidates of one group: within these bounds, a hundredth of all, so that
#: the copies of the queries stay no more than the candidates.
GROUP_MIN, GROUP_MAX = 4096, 65536
#: Queries that meet a group at a time, and pairs computed at a time.
QUERIES, PIECE = 128, 1 << 14


def segment_stats(x: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows' segment means times the root of the length, and deviation norms."""
    cuts = np.linspace(0, x.shape[1], min(m, x.shape[1]) + 1).astype(int)
    size = np.diff(cuts)
    mean = np.add.reduceat(x, cuts[:-1], axis=1) / size
    dev = x - np.repeat(mean, size, axis=1)
    return mean * np.sqrt(size), np.sqrt(np.add.reduceat(dev * dev, cuts[:-1], axis=1))


def upper_bounds(q: tuple[np.ndarray, np.ndarray], c: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Upper bounds of all queries' scores with all candidates, rounding included."""
    out = np.hstack(q) @ np.hstack(c).T
    size = np.sqrt((q[0] ** 2 + q[1] ** 2).sum(1))[:, None] * np.sqrt((c[0] ** 2 + c[1] ** 2).sum(1))
    return out + 1e-9 * size + 1e-6


class Group:
    """Candidates of a group with their statistics."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.levels = [segment_stats(x, m) for m in SEGMENTS] if x.shape[1] else []
        self.most = float(np.abs(x).max()) if x.size else 0.0

    def exact(self, q: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """Scores of pairs (row of q, candidate), in pieces of bounded size; of
        many pairs, by one product of the matrices."""
        if float(np.abs(q).max() if q.size else 0) * self.most * max(1, q.shape[1]) >= 2**53:
            exact = [sum(int(a) * int(b) for a, b in zip(q[r], self.x[c])) for r, c in zip(rows, cols)]
            return np.array(exact, np.int64)
        if len(rows) > len(q) * len(self.x) // 32:
            return (q @ self.x.T)[rows, cols].astype(np.int64)
        out = np.empty(len(rows), np.int64)
        for i in range(0, len(rows), PIECE):
            out[i : i + PIECE] = np.einsum("nd,nd->n", q[rows[i : i + PIECE]], self.x[cols[i : i + PIECE]])
        return out

    def search(self, qid: np.ndarray, q: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(query, candidate, score) of each query's best k here."""
        n = len(self.ids)
        alive = qid[:, None] != self.ids[None, :]
        floor = np.full(len(q), -np.inf)
        for stats, m in zip(self.levels, SEGMENTS):
            bound = np.where(alive, upper_bounds(segment_stats(q, m), stats), -np.inf)
            if n > k:  # exact scores of the most promising raise the floor
                top = np.argpartition(-bound, k - 1, axis=1)[:, :k]
                rows = np.repeat(np.arange(len(q)), k)
                got = np.where(alive[rows, top.ravel()], self.exact(q, rows, top.ravel()).astype(float), -np.inf)
                floor = np.maximum(floor, got.reshape(len(q), k).min(1))
            alive &= bound >= floor[:, None]
        rows, cols = np.nonzero(alive)
        score = self.exact(q, rows, cols)
        order = np.lexsort((self.ids[cols], -score, rows))
        rows, cols, score = rows[order], cols[order], score[order]
        first = np.searchsorted(rows, rows)
        best = np.arange(len(rows)) - first < k
        return list(zip(qid[rows[best]].tolist(), self.ids[cols[best]].tolist(), score[best].tolist()))


def _search(k: int, block: int = QUERIES):
    kinds = [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vecs, group = None, [], [], None
        for b in batches:
            g, dim, kind, vid = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            flat = b.column(4).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(np.r_[0, dim])
            cuts = np.flatnonzero((np.diff(g) != 0) | (np.diff(dim) != 0) | (np.diff(kind) != 0)) + 1
            for a, z in zip(np.r_[0, cuts], np.r_[cuts, len(g)]):
                if a == z:
                    continue
                x = flat[ends[a] : ends[z]].reshape(z - a, dim[a])
                if (g[a], dim[a]) != key:
                    key, ids, vecs, group = (g[a], dim[a]), [], [], None
                if kind[a] == 0:
                    ids.append(vid[a:z])
                    vecs.append(x)
                    continue
                if not ids:
                    continue
                if group is None:
                    group = Group(np.concatenate(ids), np.concatenate(vecs))
                for i in range(0, z - a, block):
                    rows = group.search(vid[a + i : min(a + i + block, z)], x[i : i + block], k)
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], names=[n for n, _ in kinds])

    return run


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """Best ``k`` rows for each row of ``vectors`` (vec_id, embedding) whose vec_id is
    divisible by ``every``: query_id, rank, vec_id, score.

    Components become floor(scale * x). Null vectors, vectors with a null or
    non-finite component, and rows without a vec_id take no part; vectors of
    different lengths aren't compared. A row's own vec_id is no candidate, also
    where it is repeated; a repeated row is a candidate each time, and a
    repeated query is answered once, by its largest vector. Ties go to the
    smaller vec_id. Scores over 64 bits are an error. An empty table gives an
    empty result.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    x = F.col("x")
    ok = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    rows = vectors.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda v: F.floor(scale * v.cast("double")).cast("double")).alias("x"))
    n = rows.count()
    groups = max(1, -(-n // min(max(n // 100, GROUP_MIN), GROUP_MAX)))
    cand = rows.select(F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("int").alias("g"), F.lit(0).alias("kind"), "vec_id", "x")
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.max("x").alias("x"))
    query = asked.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(1).alias("kind"), "vec_id", "x")
    both = cand.unionByName(query).select("g", F.size(x).alias("dim"), "kind", "vec_id", "x")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = both.repartition(parts, "g").sortWithinPartitions("g", "dim", "kind")
    best = dealt.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
