"""Joins, dedup and search against brute force on small tables with ties, copies,
nulls, empty and long texts."""

import hashlib
import itertools
import random
import re
import time
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from surgecast import session
from surgecast.llm import components, decontaminate, jaccard_join, line_dedup, topk_search, words


def lower(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def expected_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        k = len(sets[a] & sets[b])
        if k and 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k):
            root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(x for x in (least.get(find(i)), d) if x is not None) if (d, least.get(find(i))) != (None, None) else None
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def near_copies(rng, n_groups, size, words=60):
    out = []
    for _ in range(n_groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(words)] = f"e{rng.randrange(3000)}"
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("large", [2, 32])
def test_similar_components(spark, monkeypatch, large):
    monkeypatch.setattr(jaccard_join, "LARGE", large)
    rng = random.Random(large)
    common = " ".join(f"c{i}" for i in range(30))
    texts = near_copies(rng, 3, 25) + [common + " " + " ".join(f"u{rng.randrange(9999)}" for _ in range(40)) for _ in range(40)]
    texts += [None, "", "  \n ", "Two Words", "two words", "one", "a b c d e", "A B C D E", "a a a a a a a a", "é è ê ë ē ĕ", " ".join(f"long{i}" for i in range(30_000))]
    rows = [(1000 + i, t) for i, t in enumerate(texts)] + [(5, texts[0]), (5, texts[0]), (None, texts[1]), (None, "nobody else has this text here")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, node string").repartition(3)
    got = jaccard_join.similar_components(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == expected_components(rows)


def test_similar_components_of_no_rows(spark):
    assert jaccard_join.similar_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_shingle_sets_of_many_texts_take_little_memory():
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["ab", "cde", "Fgh", "ij", "klmno"]) for _ in range(600)) for _ in range(800)]
    col = pa.array([*texts, None, "", " ".join(texts[:200])])  # the last is longer than a chunk
    alone = [next(words.shingle_sets(pa.array([x], pa.string()), 5)) for x in texts[:20]]
    words.shingle_sets(col.slice(0, 1), 5)
    tracemalloc.start()
    try:
        got = []
        for i, s in enumerate(words.shingle_sets(col.slice(0, 800), 5)):
            if i < 20:
                got.append(s.copy())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert all(np.array_equal(a, b) for a, b in zip(alone, got, strict=True))
    assert peak < 16e6, peak
    sizes = [len(s) for s in words.shingle_sets(col, 5)]
    assert sizes[800:802] == [0, 0] and sizes[802] == len(shingles(col[802].as_py()))


def test_join_tasks_give_memory_back_between_batches(monkeypatch):
    done = []
    monkeypatch.setattr(words, "release", lambda: done.append(1))
    run = words.frugal(lambda batches: (b for b in batches))
    assert list(run(iter([1, 2, 3]))) == [1, 2, 3]
    assert len(done) == 3


def test_block_join_alone_finds_the_rest(spark, monkeypatch):
    """A chain: each text links to the next only, so a pivot reaches few."""
    monkeypatch.setattr(jaccard_join, "LARGE", 2)
    monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    words = [f"w{i}" for i in range(140)]
    rows = [(i, " ".join(words[2 * i : 2 * i + 60])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.similar_components(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == expected_components(rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (7, 7), (200, 100), (50, 60)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 200: 100, 50: 50, 60: 50}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("small", [0, session.SMALL_ROWS])
def test_components_of_random_edges(spark, monkeypatch, seed, small):
    monkeypatch.setattr(session, "SMALL_ROWS", small)
    monkeypatch.setattr(components, "SMALL_ROWS", small)
    rng = random.Random(seed)
    edges = [(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(40 + 15 * seed)] + [(None, 3), (4, None), (None, None)]
    got = sorted(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    low = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    for _ in low:
        for a, b in edges:
            if a in low and b in low:
                low[a] = low[b] = min(low[a], low[b])
    assert got == sorted(low.items())


@pytest.mark.parametrize("small", [0, session.SMALL_ROWS])
def test_similar_components_by_few_and_by_many_rows(spark, monkeypatch, small):
    monkeypatch.setattr(session, "SMALL_ROWS", small)
    monkeypatch.setattr(components, "SMALL_ROWS", small)
    monkeypatch.setattr(jaccard_join, "LARGE", 4)
    rng = random.Random(8)
    rows = [(i // 2 if i % 9 else None, t) for i, t in enumerate([*near_copies(rng, 3, 12), None, "", "one", "One"])]
    got = jaccard_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == expected_components(rows)


def test_rounds_on_few_edges_dont_take_a_task_for_each_shuffle_partition(spark):
    """Else a hundred exchanges of a few rows leave tens of thousands of tiny files and records of tasks."""
    sc, partitions = spark.sparkContext, 40
    held = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    sc.setJobGroup("rounds", "components of few edges")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = dict(map(tuple, components.components(spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long")).collect()))
        tracker = sc.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("rounds") for s in tracker.getJobInfo(j).stageIds}
        tasks = sum(i.numTasks for i in map(tracker.getStageInfo, stages) if i)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == dict.fromkeys(range(31), 0)
    assert tasks < 8 * partitions, tasks


def test_steps_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    before = files()
    option = spark.conf.get(session.FREE_SHUFFLES, None)
    df = spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 10).alias("k")).count()
    out = session.step(df)
    for _ in range(40):
        if not files() - before:
            break
        time.sleep(0.25)
    assert not files() - before
    assert spark.conf.get(session.FREE_SHUFFLES, None) == option
    assert sorted(map(tuple, out.collect())) == [(k, 100) for k in range(10)]


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def expected_contamination(docs, items):
    wins = defaultdict(set)
    for i, t in items:
        w = WORDS.findall(lower(t or ""))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            wins[tuple(w[k : k + n])].add(str(i))
    out = []
    for d, t in docs:
        w, hit, ids = WORDS.findall(lower(t or "")), set(), set()
        for n in {len(k) for k in wins}:
            for k in range(len(w) - n + 1):
                if found := wins.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    ids |= found
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_contamination(spark):
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefg")  # few words: many ties among k-grams
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 12, 13, 14, 20, 40])))) for i in range(25)] + [(90, None), (91, ""), (92, "--- !!!"), (3, "a b a b a b a b a b a b a b a")]
    docs = [(i, " ".join(word() for _ in range(rng.randrange(120)))) for i in range(40)]
    docs += [(50 + i, " ".join(["x"] * 30) + "\n" + (t or "").upper() + "! " + " ".join(["y"] * 300)) for i, (_, t) in enumerate(items)]
    docs += [(100, None), (101, ""), (102, "é,è"), (0, docs[0][1]), (None, docs[1][1])]
    df = spark.createDataFrame([(d, t, "z") for d, t in docs], "doc_id long, text string, n_hit string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(df, bench).drop("row_id").collect()
    assert sorted(map(tuple, got), key=str) == expected_contamination(docs, items)
    assert decontaminate.contamination(df.limit(0), bench).count() == 0
    assert decontaminate.contamination(df, bench.limit(0)).where("contaminated").count() == 0


def test_every_shared_span_is_selected():
    rng = np.random.default_rng(5)
    for _ in range(50):
        h = rng.integers(0, 4, 60).astype(np.uint64)
        ptr = np.array([0, 30, 60])
        h[35:48] = h[5:18]
        text, start, fp, win = decontaminate.windows(h, ptr, 13, 7)
        a, b = (text == 0) & (start == 5), (text == 1) & (start == 35)
        assert fp[a] == fp[b] and win[a] == win[b]


def test_dedup_lines(spark):
    rng = random.Random(2)
    long = [f"Line number {i} " + "x" * 40 for i in range(12)]
    rows = [(i, "\n".join(rng.choice([*long, "short", "", long[0].upper(), "  " + long[1] + "\t", "é" * 39, "é" * 40]) for _ in range(rng.randrange(9)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "\n\n"), (3, long[2]), (None, long[0]), (None, long[3] + "\nmine"), (99, long[5] + "\n" + long[5])]
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    rank = lambda d: -1 if d is None else d
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                held[key(x)].add(rank(d))
    expected = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 40 and len(held[key(x)]) >= 5 and max(held[key(x)]) != rank(d))]
        expected.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, kept int").repartition(4)
    for batches, fanout in ((1, 2), (4, 2), (7, 3)):
        got = line_dedup.dedup_lines(df, batches=batches, fanout=fanout)
        assert got.columns == ["doc_id", "text", "n_lines", "n_dropped", "kept"]
        assert sorted(map(tuple, got.drop("text").collect()), key=str) == sorted(expected, key=str)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_top_k(spark):
    rng = random.Random(4)
    vec = lambda: [float(np.float32(rng.gauss(0, 0.2))) for _ in range(20)]
    rows = [(i, vec()) for i in range(700)] + [(1000 + i, vec()) for i in range(3)]
    same = vec()
    rows += [(2000 + i, same) for i in range(15)] + [(3000, None), (3001, [float("nan")] * 20), (3002, [None, *same[1:]]), (3100, [float("inf"), *same[1:]]), (4000, [1.0, 2.0]), (None, same), (200, same)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = defaultdict(list)
    for r in topk_search.top_k(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    good = [(i, np.floor(1024 * np.array(x)).astype(int)) for i, x in rows if i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x)]
    for q in {i for i, _ in good if i % 100 == 0}:
        x = max(tuple(v) for i, v in good if i == q)
        scores = sorted(((int(np.dot(x, v)), i) for i, v in good if i != q and len(v) == len(x)), key=lambda s: (-s[0], s[1]))
        assert got.pop(q, []) == [(i, s) for s, i in scores[:10]]
    assert not got
    assert topk_search.top_k(df.limit(0)).count() == 0


def test_bounds_are_bounds():
    rng = np.random.default_rng(1)
    q, c = np.floor(rng.normal(0, 300, (20, 37))), np.floor(rng.normal(50, 300, (30, 37)))
    exact, last = q @ c.T, None
    for m in topk_search.SEGMENTS:
        bound = topk_search.upper_bounds(topk_search.segment_stats(q, m), topk_search.segment_stats(c, m))
        assert (bound >= exact).all()
        assert last is None or bound.sum() <= last
        last = bound.sum()
