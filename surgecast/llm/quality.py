"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= j | x) = sigmoid(t_j - w.x) with one weight vector over hashed text
features and ordered thresholds t_0 < t_1 < ... The expected grade ranks
documents; the tail probability P(grade >= g) selects them.

Features of a text, as hashed presence: its words, the first bytes of its
words (for stems), its words' shapes (letters
by case, digits, marks; repeats collapsed), and coarse measures of the whole
text (share of distinct words, of immediate repeats, capitals and marks).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgecast.llm import words
from surgecast.session import ship_package

#: Hash buckets, rows the model is fitted on at most, and passes over them.
BUCKETS, TRAIN_ROWS, STEPS = 1 << 18, 10_000, 150
#: A feature gets a weight if its chi-square with some grade is at least this.
CHI_SQUARE = 15
RATE, RIDGE = 0.05, 1e-6
#: Bytes of the beginnings of words that are features.
STEMS = (4, 5, 7)

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91] = ord("A")
_SHAPE[97:123] = ord("a")
_SHAPE[48:58] = ord("0")
_SHAPE[128:] = ord("a")


def _level(share: np.ndarray) -> np.ndarray:
    """Coarse steps of a share, finer near 0."""
    return np.searchsorted([0.001, 0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9], share)


def features(col: pa.Array, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Sorted distinct feature numbers of each whole text (null, empty: the measures only)."""
    buf, off = words.utf8(col)
    for a, z in words.chunks(off):
        part, o = buf[off[a] : off[z]], off[a : z + 1] - off[a]
        h, ptr, starts, ends = words.word_hashes(part, o, words.ALNUM)
        stems = words.span_hashes(words.LOWER[part], starts, *[np.minimum(ends, starts + k) for k in STEMS])
        shape = _SHAPE[part]
        keep = np.ones(len(shape), bool)
        keep[1:] = (shape[1:] != shape[:-1]) | words.NOT_SPACE[shape[1:]] & (shape[1:] != ord("A")) & (shape[1:] != ord("a")) & (shape[1:] != ord("0"))
        keep[o[:-1][o[:-1] < len(shape)]] = True
        kept = np.concatenate([[0], np.cumsum(keep)])[o]
        g, gptr, _, _ = words.word_hashes(shape[keep], kept, words.NOT_SPACE, lower=False)
        same = np.concatenate([[False], h[1:] == h[:-1]])
        cap = np.concatenate([[0], np.cumsum(shape == ord("A"))])[o]
        low = np.concatenate([[0], np.cumsum(shape == ord("a"))])[o]
        mark = np.concatenate([[0], np.cumsum((shape > 32) & (shape < 48) | (shape == 124))])[o]
        for i in range(z - a):
            s, e = ptr[i], ptr[i + 1]
            w = np.unique(h[s:e])
            n, size = max(1, e - s), max(1, o[i + 1] - o[i])
            shares = [len(w) / n, same[s + 1 : e].sum() / n, (cap[i + 1] - cap[i]) / max(1, cap[i + 1] - cap[i] + low[i + 1] - low[i]), (mark[i + 1] - mark[i]) / size, min(1, n / 1000)]
            level = _level(np.array(shares)) + 32 * np.arange(len(shares))
            level = words.mix(level.astype(np.uint64) + np.uint64(1 << 40))
            shapes = words.mix(np.unique(g[gptr[i] : gptr[i + 1]]) + np.uint64(1))
            begins = [words.mix(np.unique(x[s:e]) + np.uint64(2 + k)) for k, x in enumerate(stems)]
            yield np.unique((np.concatenate([w, *begins, shapes, level]) % np.uint64(buckets)).astype(np.int32))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Ordinal:
    """Shared weights and ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """P(grade = j) in columns."""
        below = sigmoid(self.thresholds[None, :] - score[:, None])
        full = np.hstack([np.zeros((len(score), 1)), below, np.ones((len(score), 1))])
        return np.diff(full, axis=1)


def chi_square(counts: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Per feature, the largest chi-square of its presence with one grade against
    the others. ``counts``: texts of each grade (rows) with the feature."""
    n, out = texts.sum(), np.zeros(counts.shape[1])
    having = counts.sum(0)
    for g in range(len(texts)):
        a = counts[g].astype(float)
        b, c = having - a, texts[g] - a
        d = n - texts[g] - b
        bottom = (a + b) * (c + d) * (a + c) * (b + d)
        out = np.maximum(out, np.where(bottom > 0, n * (a * d - b * c) ** 2 / np.maximum(bottom, 1), 0))
    return out


def fit(rows: list[np.ndarray], grade: np.ndarray, grades: int, buckets: int = BUCKETS, steps: int = STEPS) -> Ordinal:
    """Maximum likelihood with a small ridge, by full-batch Adam."""
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    own = np.repeat(grade, [len(r) for r in rows])
    used = np.flatnonzero(chi_square(np.stack([np.bincount(flat[own == g], minlength=buckets) for g in range(grades)]), np.bincount(grade, minlength=grades)) >= min(CHI_SQUARE, len(rows) / 20))
    column = np.full(buckets, -1)
    column[used] = np.arange(len(used))
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = column[flat]
    owner, col = owner[col >= 0], col[col >= 0]
    weight = np.full(len(rows), 1 / max(1, len(rows)))
    w = np.zeros(len(used))
    cut = np.r_[0.0, np.full(grades - 2, 0.5)]  # first threshold, then logs of the steps up to the next
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, cut)]
    hot = np.eye(grades)[grade]
    for step in range(1, steps + 1):
        score = np.bincount(owner, w[col], minlength=len(rows))
        t = np.cumsum(np.r_[cut[0], np.exp(cut[1:])])
        below = sigmoid(t[None, :] - score[:, None])
        slope = below * (1 - below)
        full = np.hstack([np.zeros((len(rows), 1)), below, np.ones((len(rows), 1))])
        p = np.maximum((np.diff(full, axis=1) * hot).sum(1), 1e-9)
        edge = np.hstack([np.zeros((len(rows), 1)), slope, np.zeros((len(rows), 1))])
        upper, lower = (edge[:, 1:] * hot).sum(1), (edge[:, :-1] * hot).sum(1)
        g_score = weight * (upper - lower) / p  # of the negative log-likelihood
        g_t = -(weight / p)[:, None] * slope * (hot[:, :-1] - hot[:, 1:])
        g_t = g_t.sum(0)
        rest = np.cumsum(g_t[::-1])[::-1]
        g_cut = np.r_[rest[0], rest[1:] * np.exp(cut[1:])]
        g_w = np.bincount(col, g_score[owner], minlength=len(used)) + RIDGE * w
        for x, g, (m, v) in zip((w, cut), (g_w, g_cut), state):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(buckets, np.float64)
    weights[used] = w
    return Ordinal(weights, np.cumsum(np.r_[cut[0], np.exp(cut[1:])]))


def grade_of(quality: Column, toxic: Column) -> Column:
    """Graded rating from the labels: 0 toxic, 1 low quality, 2 good; null if unrated."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)


def train(docs: DataFrame, ratings: DataFrame, grades: int = 3, rows: int = TRAIN_ROWS) -> Ordinal:
    """Fit on at most ``rows`` rated documents, those of the smallest hash of doc_id.

    ``ratings`` has doc_id and grade (0 to grades - 1; null and other values
    are passed over). Without rated documents, all weights are 0.
    """
    ship_package(docs.sparkSession)
    rated = ratings.where(F.col("grade").between(0, grades - 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("grade").cast("int").alias("grade"))
    few = rated.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [x.tobytes() for x in features(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.binary())], names=["grade", "cols"])

    sample = docs.select("doc_id", "text").join(few, "doc_id").select("grade", "text").mapInArrow(run, "grade int, cols binary").toPandas()
    sample = sample.sort_values(["grade", "cols"])  # the order rows come in doesn't matter
    if not len(sample):
        return Ordinal(np.zeros(BUCKETS), np.arange(grades - 1, dtype=float))
    return fit([np.frombuffer(x, np.int32) for x in sample["cols"]], sample["grade"].to_numpy(np.int64), grades)


def score(docs: DataFrame, model: Ordinal, tail_grade: int, least: float = 0.5) -> DataFrame:
    """Add expected_grade, tail_prob (P(grade >= tail_grade)) and keep (tail_prob >= least).

    Null and empty texts are scored by their empty measures alone; whole texts
    count; repeated rows get equal scores; other columns pass through, columns
    of the three names are replaced; an empty table stays empty.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    mine = ("expected_grade", "tail_prob", "keep")
    base = docs.drop(*mine)
    out = T.StructType([*base.schema, T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_prob", T.DoubleType()), T.StructField("keep", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            total = np.array([m.weights[x].sum() for x in features(b.column(b.schema.names.index("text")))], np.float64)
            p = m.probabilities(total)
            tail = p[:, tail_grade:].sum(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p @ np.arange(p.shape[1])), pa.array(tail), pa.array(tail >= least)], names=out.names)

    return base.mapInArrow(run, out)
