"""Collocations against a brute-force count in plain Python."""

import random
import re
from collections import Counter

import pytest

from surgecast.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, support=30, longest=4, top=2000, covered=80):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i : i + k])] += 1
    often = {key: a for key, a in f.items() if a >= support and len(key[1]) > 1}
    big = Counter()
    for (lang, p), a in often.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                big[lang, p[i : i + m]] = max(big[lang, p[i : i + m]], a)
    out = {}
    for (lang, p), a in often.items():
        if big[lang, p] and 100 * big[lang, p] >= covered * a:
            continue
        score, _, left, right = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    rows = []
    for lang, got in out.items():
        for rank, (s, a, p, left, right) in enumerate(sorted(got)[:top], 1):
            rows.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(rows)


def texts(seed, n):
    rnd = random.Random(seed)
    vocab = ["Alpha", "beta", "GAMMA", "é", "Éa", "x", "it's", "d-e", "1", " y"]
    joins = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b", "! ", "?", ":"]
    weights = [10, 8, 6, 4, 3, 2, 2, 1, 1, 1]
    for _ in range(n):
        text = "".join(rnd.choices(vocab, weights)[0] + rnd.choice(joins) for _ in range(rnd.randint(0, 40)))
        yield text, rnd.choice(["en", "en", "en", "de", None, "und", ""])


def got(spark, rows, **how):
    df = spark.createDataFrame(rows, "text string, lang string")
    return sorted(tuple(r) for r in collocations.collocations(df, **how).collect())


@pytest.mark.parametrize("seed,support,shards", [(1, 30, 4), (2, 5, 1), (3, 2, 7)])
def test_against_brute_force(spark, seed, support, shards):
    rows = [*texts(seed, 300), (None, "en"), ("", None), (" .. ", "fr")]
    assert got(spark, rows, support=support, shards=shards, chunk_words=500) == brute(rows, support)


def test_hot_copies_ties_and_a_long_text(spark):
    rows = [("same words in a row again.", "en")] * 40 + [("a b a b a b c " * 3000, "en"), ("p q. r s. " * 30, "de")]
    want = brute(rows)
    assert got(spark, rows) == want
    assert [r[2] for r in want if r[0] == "de"] == ["p q", "r s"]


def test_top_and_longest(spark):
    rows = list(texts(9, 200))
    assert got(spark, rows, support=3, top=5, longest=2) == brute(rows, 3, 2, 5)
    assert got(spark, rows, support=3, longest=3, covered=50) == brute(rows, 3, 3, covered=50)


def test_empty_and_clashing_columns(spark):
    kind = "text string, lang string, n int, a int, k int, shard string, phrase string"
    assert collocations.collocations(spark.createDataFrame([], kind)).count() == 0
    rows = [("u v", "en", 1, 2, 3, "s", "p")] * 30
    out = collocations.collocations(spark.createDataFrame(rows, kind)).collect()
    assert [tuple(r) for r in out] == [("en", 1, "u v", 30, 30, 30, 60, 1000000)]


def test_bitmap_has_no_false_negatives(spark):
    rnd = random.Random(5)
    rows = [(rnd.getrandbits(63), rnd.getrandbits(63)) for _ in range(2000)]
    bits = collocations.bitmap_of(spark.createDataFrame(rows, "g long, phrase long"), "g", 1 << 16).value
    import numpy as np

    assert all(collocations.contains(bits, np.array([p], np.uint64), g)[0] for g, p in rows)
    strangers = collocations.contains(bits, np.array([rnd.getrandbits(63) for _ in range(5000)], np.uint64), 7)
    assert strangers.mean() < 0.05
