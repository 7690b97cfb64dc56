"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads each word of a text (a run of ASCII letters, lower-cased, and
non-ASCII bytes; longer runs in pieces of PIECE bytes) from both ends and
labels every byte position with language probabilities; a document's
probabilities are the mean over all its positions. A word's labels depend on
its bytes alone, so a batch runs the network once per distinct word.

Training is numpy backpropagation through time (Adam) on words of a bounded
sample of labelled documents.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgecast.llm import words
from surgecast.session import ship_package

HIDDEN, PIECE = 16, 24
#: Training: about this many documents a language, at most this many distinct
#: words a language, and the passes over them.
DOCS_A_LANG, WORDS_A_LANG, EPOCHS, BATCH, RATE = 600, 12_000, 6, 256, 0.01
UNKNOWN = "und"
CHUNK = 2 << 20
#: Words of one length that go through the network together.
WORDS_AT_ONCE = 1024
#: Languages are output classes of the network, so there are few; more labels are an error.
MAX_LANGS = 1000

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_ANY_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Network:
    """For each direction d: byte inputs e[d] (256, 3h), recurrent u[d] (h, 3h);
    output weights o (2h, langs) and bias. Gates: update, reset, candidate."""

    langs: list[str]
    e: np.ndarray
    u: np.ndarray
    o: np.ndarray
    c: np.ndarray

    @staticmethod
    def new(langs: list[str], hidden: int, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        f = lambda *s: rng.normal(0, 1, s).astype(np.float32)
        return Network(langs, 0.5 * f(2, 256, 3 * hidden), f(2, hidden, 3 * hidden) / np.sqrt(hidden).astype(np.float32), f(2 * hidden, len(langs)) / np.sqrt(2 * hidden).astype(np.float32), np.zeros(len(langs), np.float32))

    def states(self, x: np.ndarray, keep: bool = False):
        """Hidden states (positions, words, 2h) of words of one length (words, length)."""
        n, length = x.shape
        h = self.u.shape[1]
        out = np.empty((length, n, 2 * h), np.float32)
        tape: list[list] = [[], []]
        for d in (0, 1):
            s = np.zeros((n, h), np.float32)
            for t in range(length) if d == 0 else range(length - 1, -1, -1):
                inp = self.e[d][x[:, t]]
                zr = inp[:, : 2 * h] + s @ self.u[d][:, : 2 * h]
                zr = 0.5 + 0.5 * np.tanh(0.5 * zr)
                z, r = zr[:, :h], zr[:, h:]
                rs = r * s
                a = np.tanh(inp[:, 2 * h :] + rs @ self.u[d][:, 2 * h :])
                new = s + z * (a - s)
                if keep:
                    tape[d].append((t, s, z, r, a))
                s = new
                out[t, :, d * h : (d + 1) * h] = s
        return (out, tape) if keep else out

    def labels(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (positions, words, langs)."""
        p = self.states(x) @ self.o + self.c
        p -= p.max(-1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(-1, keepdims=True)
        return p

    def gradients(self, x: np.ndarray, goal: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy over positions, with one goal distribution a word."""
        hs, tape = self.states(x, keep=True)
        length, n, _ = hs.shape
        h = self.u.shape[1]
        p = hs @ self.o + self.c
        p = np.exp(p - p.max(-1, keepdims=True))
        p /= p.sum(-1, keepdims=True)
        dy = (p * goal.sum(-1)[None, :, None] - goal[None]) / np.float32(length * n)
        go = np.einsum("tnh,tnl->hl", hs, dy)
        gc = dy.sum((0, 1))
        dh = dy @ self.o.T
        ge, gu = np.zeros_like(self.e), np.zeros_like(self.u)
        for d in (0, 1):
            back = np.zeros((n, h), np.float32)
            for t, s, z, r, a in reversed(tape[d]):
                g = dh[t][:, d * h : (d + 1) * h] + back
                da = g * z * (1 - a * a)
                dz = g * (a - s) * z * (1 - z)
                drs = da @ self.u[d][:, 2 * h :].T
                dr = drs * s * r * (1 - r)
                gates = np.hstack([dz, dr])
                back = g * (1 - z) + drs * r + gates @ self.u[d][:, : 2 * h].T
                gu[d][:, : 2 * h] += s.T @ gates
                gu[d][:, 2 * h :] += (r * s).T @ da
                np.add.at(ge[d], x[:, t], np.hstack([gates, da]))
        return [ge, gu, go, gc]


def fit(langs: list[str], samples: list[tuple[bytes, np.ndarray]], hidden: int = HIDDEN, epochs: int = EPOCHS, rate: float = RATE) -> Network:
    """Adam over batches of words of one length; ``samples`` are words with
    the share of each language."""
    net = Network.new(langs, hidden)
    params = [net.e, net.u, net.o, net.c]
    first, second = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
    rng, step = np.random.default_rng(11), 0
    by_length: dict[int, list[int]] = {}
    for i, (w, _) in enumerate(samples):
        by_length.setdefault(len(w), []).append(i)
    for epoch in range(epochs):
        batches = []
        for length in sorted(by_length):
            order = rng.permutation(by_length[length])
            batches += [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        for k in rng.permutation(len(batches)):
            own = batches[k]
            x = np.frombuffer(b"".join(samples[i][0] for i in own), np.uint8).reshape(len(own), -1)
            got = net.gradients(x, np.stack([samples[i][1] for i in own]).astype(np.float32))
            step += 1
            pace = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            for p, g, m, v in zip(params, got, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= np.float32(pace) * m / (np.sqrt(v) + np.float32(1e-8))
    return net


def pieces(part: np.ndarray, off: np.ndarray):
    """Words of the texts, cut into pieces: (lower-cased bytes, start, length, first piece of each text)."""
    low = words.LOWER[part]
    starts, ends = words.word_spans(low, off, _LETTER)
    n = -(-(ends - starts) // PIECE)
    first = np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(starts, n) + PIECE * (np.arange(len(first)) - first)
    size = np.minimum(np.repeat(ends, n) - at, PIECE)
    return low, at, size, np.searchsorted(at, off)


def predict(net: Network, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Mean probabilities (texts, langs) over all positions, and their number."""
    buf, off = words.utf8(col)
    total, count = np.zeros((len(off) - 1, len(net.langs))), np.zeros(len(off) - 1, np.int64)
    for a, z in words.chunks(off, CHUNK):
        low, at, size, ptr = pieces(buf[off[a] : off[z]], off[a : z + 1] - off[a])
        if not len(at):
            continue
        votes = np.empty((len(at), len(net.langs)))
        for length in np.unique(size):
            rows = np.flatnonzero(size == length)
            flat = low[at[rows][:, None] + np.arange(length)]
            one, back = np.unique(np.ascontiguousarray(flat).view(f"S{length}" if not (flat == 0).any() else f"V{length}").ravel(), return_inverse=True)
            x = np.frombuffer(one.tobytes(), np.uint8).reshape(len(one), length)
            got = np.concatenate([net.labels(x[i : i + WORDS_AT_ONCE]).sum(0) for i in range(0, len(x), WORDS_AT_ONCE)])
            votes[rows] = got[back]
        sums = np.cumsum(votes, 0, out=votes)
        upto = np.where(ptr[:, None] > 0, sums[ptr - 1], 0.0)
        total[a:z] = upto[1:] - upto[:-1]
        sizes = np.concatenate([[0], np.cumsum(size)])
        count[a:z] = sizes[ptr[1:]] - sizes[ptr[:-1]]
    return total / np.maximum(1, count)[:, None], count


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5 (null id: no)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        buf, off = words.utf8(b.column(1))
        langs = b.column(0).to_pylist()
        for a, z in words.chunks(off):
            low, at, size, ptr = pieces(buf[off[a] : off[z]], off[a : z + 1] - off[a])
            rows = {}
            for i in range(z - a):
                for j in range(ptr[i], ptr[i + 1]):
                    key = (langs[a + i], low[at[j] : at[j] + size[j]].tobytes())
                    rows[key] = rows.get(key, 0) + 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.string()), pa.array([w for _, w in rows], pa.binary()), pa.array(list(rows.values()), pa.int64())], names=["lang", "word", "n"])


def train(docs: DataFrame, docs_a_lang: int = DOCS_A_LANG, words_a_lang: int = WORDS_A_LANG) -> Network | None:
    """Fit on a bounded sample of rows that aren't held out and have a lang.

    The sample is, for each language, the rows whose hash of doc_id is below
    the share that gives about ``docs_a_lang`` rows, and of their words the
    ``words_a_lang`` of smallest hash. Rows of one doc_id, and those without,
    are in it or out of it together. None if there is no such row; more than
    ``MAX_LANGS`` languages are an error.
    """
    ship_package(docs.sparkSession)
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count("*").alias("rows"))
    langs = sorted(r["lang"] for r in sizes.select("lang").limit(MAX_LANGS + 1).collect())
    if not langs:
        return None
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} values of lang")
    hashed = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    few = rows.join(F.broadcast(sizes), "lang").where(hashed < docs_a_lang / F.col("rows")).select("lang", "text")
    found = few.mapInArrow(words.frugal(_words), "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    limit = words_a_lang * len(langs)
    per_word = found.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))  # a row a language at most
    got = per_word.orderBy(F.xxhash64("word"), "word").limit(limit).collect()
    totals = np.zeros(len(langs))
    at = {x: i for i, x in enumerate(langs)}
    counts = np.zeros((len(got), len(langs)))
    for i, r in enumerate(got):
        for lang, n in r["by"].items():
            counts[i, at[lang]] = n
    totals = np.maximum(1, counts.sum(0))
    share = counts / totals  # languages weigh alike
    goal = share / share.sum(1, keepdims=True)
    weight = np.minimum(4, 1 + np.log1p(counts.sum(1)))
    return fit(langs, [(bytes(r["word"]), g * w) for r, g, w in zip(got, goal, weight)])


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """Add lang_pred and score (its pooled probability) to every row of ``docs``.

    The text alone decides. ``und`` with score 0 for null texts, texts without
    a letter, and without a network. Whole texts are read; repeated rows get
    equal answers; other columns pass through, columns of the two names are
    replaced; an empty table stays empty.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(net)
    base = docs.drop("lang_pred", "score")
    out = T.StructType([*base.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            col = b.column(b.schema.names.index("text"))
            if m is None:
                lang, best = [UNKNOWN] * len(b), np.zeros(len(b))
            else:
                p, n = predict(m, col)
                best, top = p.max(1), p.argmax(1)
                lang = [m.langs[i] if k and _has_letter(t) else UNKNOWN for i, k, t in zip(top, n, col)]
                best = np.clip(np.where([x != UNKNOWN for x in lang], best, 0.0), 0, 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(best)], names=out.names)

    return base.mapInArrow(words.frugal(run), out)


def _has_letter(text: pa.StringScalar) -> bool:
    return bool(text.is_valid and _ANY_LETTER.search(text.as_py()))


def crc_held_out(doc_id: int) -> bool:
    """The hold-out rule in Python, for tests."""
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
