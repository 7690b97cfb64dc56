"""Exact Jaccard similarity join of documents, as a metric-space join.

Jaccard distance on sets of word shingles is a metric, so a document within
``radius`` of another lies within ``radius`` of it in its distance to any
pivot. The join works on distinct sets (nodes):

1. Count the shingles of all documents, and keep two bounded maps of them:
   which may occur twice, and which are frequent. They only define an order of
   shingles (rare first); any order gives the same result.
2. Outer regions: a document belongs to the regions of the first shingles of
   its set in that order, as many as the overlap bound of linked sets asks
   for. Each shingle is the pivot of its region, and the further memberships
   are the replicas a window of linked distance needs: any two linked sets
   share at least ``need`` regions.
3. Small regions propose pairs; a pair in fewer regions than ``need`` cannot
   be linked. Regions over ``large`` members take their smallest member as
   pivot document, and distances to it are computed.
4. Members within ``radius`` of a pivot are linked to it, hence to each other
   in one component, and need no comparison among themselves. The rest of
   each region recurs with a new pivot out of the rest; what is left is joined
   exactly in blocks, and the triangle inequality on the distances to the
   pivot passes over pairs that cannot be linked.

Components of the links come from star operations. No pair list of a group is
made, and no hot group meets in one task: members are dealt over salted keys
and blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgecast.llm import words
from surgecast.llm.components import components
from surgecast.session import packed, ship_package, step

#: Links: PERCENT_A * intersection >= PERCENT_B * union.
SHINGLE, PERCENT = 5, 80
#: Regions over this many members are joined through pivot documents.
LARGE = 32
#: Frequent shingles: in more documents than this; doubled until at most MAX_HOT are.
HOT, MAX_HOT = 32, 1 << 21
#: Bits of the map of repeated shingles: 8 a shingle, but never more than this (16 MB).
MAX_BITS = 1 << 27
#: Bits of the map that one row brings to the driver.
MAP_PIECE = 1 << 20
#: Members of one salted group, and rows of one block.
GROUP, BLOCK = 500, 512
#: Pivot documents a region gets before its rest is joined in blocks.
ROUNDS = 2
#: Classes' copies are dealt over this many keys.
SALTS = 32
#: Sets a task remembers to pass over copies.
SEEN = 100_000


def set_id(s: np.ndarray) -> int:
    """64-bit id of a set of hashes. Two different sets get one id with a
    chance of 2**-64; among 1e9 distinct sets, 3 % that any two do."""
    with np.errstate(over="ignore"):
        x = words.mix(s ^ np.uint64(0xA24BAED4963EE407)).sum(dtype=np.uint64) + np.uint64(len(s)) * words.NGRAM
    return int(words.mix(np.array([x], np.uint64)).view(np.int64)[0])


def overlap(n: int, percent: int = PERCENT) -> int:
    """Fewest common elements of a set of size n with any linked set."""
    return -(-percent * n // 100)


def need(n: int) -> int:
    """Regions that a set of size n shares with any linked set that is no smaller in this number."""
    return max(1, n // 16)


def linked(common, a, b, percent: int = PERCENT):
    return 100 * common >= percent * (a + b - common)


@dataclass
class Order:
    """Order of shingles: those never repeated, then the infrequent, then the frequent, each by hash."""

    bits: np.ndarray
    shift: int
    hot: np.ndarray

    def maybe_repeated(self, s: np.ndarray) -> np.ndarray:
        at = s >> np.uint64(self.shift)
        return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0

    def prefix(self, s: np.ndarray, percent: int) -> np.ndarray:
        """Of the first shingles of a set, those that may occur in other sets."""
        n = len(s)
        first = n - overlap(n, percent) + need(n)
        rep = self.maybe_repeated(s)
        first -= n - int(rep.sum())
        if first <= 0:
            return s[:0]
        s = s[rep]
        key = s >> np.uint64(8)
        at = np.minimum(np.searchsorted(self.hot, key), max(len(self.hot) - 1, 0))
        hot = self.hot[at] == key if len(self.hot) else np.zeros(len(s), bool)
        return s[np.argsort(hot, kind="stable")][:first]


def _new_sets(col: pa.Array, k: int, seen: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(id, set) of texts with words, but for copies this task remembers."""
    for s in words.shingle_sets(col, k):
        if len(s):
            i = set_id(s)
            if i not in seen:
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(i)
                yield i, s


def nodes(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, n, node) of every row; node is null for an empty set."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(len(s), set_id(s) if len(s) else None) for s in words.shingle_sets(b.column(1), k)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in got], pa.int64()), pa.array([x for _, x in got], pa.int64())], names=["doc_id", "n", "node"])

    return docs.select("doc_id", "text").mapInArrow(words.frugal(run), f"doc_id {kind}, n long, node long")


def shingle_counts(docs: DataFrame, k: int) -> DataFrame:
    """(key, n) of shingles that occur more than once; key is the upper 56 bits.

    Tasks pack hashes by range into binary rows, so the shuffle moves 6 bytes a
    shingle; each range is then counted on its own.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    log = max(8, (4 * parts - 1).bit_length())
    ranges = 1 << log

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            _, off = words.utf8(b.column(0))
            for a, z in words.chunks(off, 2 * words.CHUNK_BYTES):
                sets = [s for _, s in _new_sets(b.column(0).slice(a, z - a), k, seen)]
                if not sets:
                    continue
                s = np.concatenate(sets)
                del sets
                s.sort()
                ends = np.searchsorted(s >> np.uint64(64 - log), np.arange(ranges + 1, dtype=np.uint64))
                low = np.ascontiguousarray(s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 1:7])  # the range tells the highest byte
                blobs = [low[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(ranges), pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(part: int, blobs: list[bytes]) -> pa.RecordBatch:
            raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
            full = np.zeros((len(raw), 8), np.uint8)
            full[:, :6] = raw
            full[:, 6] = part >> (log - 8)
            key, n = np.unique(full.view("<u8").ravel(), return_counts=True)
            many = n > 1
            return pa.RecordBatch.from_arrays([pa.array(key[many].astype(np.int64)), pa.array(n[many].astype(np.int64))], names=["key", "n"])

        at, held = None, []
        for b in batches:
            for p, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if p != at and held:
                    yield done(at, held)
                    held = []
                at = p
                held.append(blob)
        if held:
            yield done(at, held)

    packed = docs.select("text").mapInArrow(words.frugal(cut), "part int, blob binary").where(F.length("blob") > 0)
    return packed.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(words.frugal(count), "key long, n long")


def shingle_order(docs: DataFrame, k: int = SHINGLE) -> Order:
    """The order, from the counts of all documents' shingles; its maps have a fixed bound."""
    counts = step(shingle_counts(docs, k))
    steps = [HOT << i for i in range(24)]
    sizes = counts.agg(F.count("*"), *[F.count(F.when(F.col("n") > h, 1)) for h in steps]).first()
    bits = 1 << 20
    while bits < 8 * sizes[0] and bits < MAX_BITS:
        bits *= 2
    shift = 64 - (bits.bit_length() - 1)
    least = next(h for h, n in zip(steps, sizes[1:]) if n <= MAX_HOT)
    piece = min(bits, MAP_PIECE)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, np.ndarray] = {}
        hot: list[np.ndarray] = []
        for b in batches:
            key, n = b.column(0).to_numpy().astype(np.uint64), b.column(1).to_numpy()
            hot.append(key[n > least])
            at = (key >> np.uint64(shift - 8)).astype(np.int64)
            for c in np.unique(at // piece).tolist():
                own = maps.setdefault(c, np.zeros(piece, bool))
                own[at[at // piece == c] % piece] = True
        rows = [(c, np.packbits(m, bitorder="little").tobytes()) for c, m in maps.items()]
        rows += [(-1, h.tobytes()) for h in hot if len(h)]
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=["piece", "bytes"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.repartition(parts, F.shiftrightunsigned("key", shift - 8 + piece.bit_length() - 1))
    out, hot = np.zeros(bits // 8, np.uint8), [np.zeros(0, np.uint64)]
    for r in dealt.mapInArrow(words.frugal(pack), "piece int, bytes binary").collect():  # MAX_BITS and MAX_HOT bound it
        if r["piece"] < 0:
            hot.append(np.frombuffer(bytes(r["bytes"]), np.uint64))
        else:
            out[r["piece"] * piece // 8 : (r["piece"] + 1) * piece // 8] |= np.frombuffer(bytes(r["bytes"]), np.uint8)
    return Order(out.view(np.uint64), shift, np.sort(np.concatenate(hot)))


def memberships(docs: DataFrame, order, k: int, percent: int) -> DataFrame:
    """(s, node): the outer regions of each set; once for each copy that tasks don't remember."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        rank = order.value
        for b in batches:
            _, off = words.utf8(b.column(0))
            for a, z in words.chunks(off):
                got = [(i, rank.prefix(s, percent)) for i, s in _new_sets(b.column(0).slice(a, z - a), k, seen)]
                got = [(i, s) for i, s in got if len(s)]
                if got:
                    node = np.repeat(np.array([i for i, _ in got], np.int64), [len(s) for _, s in got])
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([s for _, s in got]).view(np.int64)), pa.array(node)], names=["s", "node"])

    return docs.select("text").mapInArrow(words.frugal(run), "s long, node long").distinct()


def _measure(k: int):
    """Sets that follow their pivot's text in a group: common elements and sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, at = np.zeros(0, np.uint64), None
        for b in batches:
            p, kind, x = (b.column(i).to_pylist() for i in (0, 2, 3))
            out = []
            for i, s in enumerate(words.shingle_sets(b.column(4), k)):
                if kind[i] == 0:
                    pivot, at = s, p[i]
                    continue
                if at != p[i]:
                    raise ValueError("a member came without its pivot")
                j = np.searchsorted(pivot, s)
                j[j == len(pivot)] = 0
                out.append((p[i], x[i], int((pivot[j] == s).sum()), len(pivot), len(s)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["p", "x", "common", "n_p", "n_x"])

    return run


def measure(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(p, x, common, n_p, n_x) of distinct pairs. Each pivot's text meets its
    members' texts as a stream; large groups are dealt over salted keys."""
    size = pairs.groupBy("p").agg(F.ceil(F.count("*") / GROUP).alias("salts"))
    salted = pairs.join(size, "p").select("p", F.pmod(F.xxhash64("x"), F.col("salts")).cast("int").alias("salt"), "x")
    salts = size.select("p", F.explode(F.sequence(F.lit(0), F.col("salts").cast("int") - 1)).alias("salt"))
    rows = salts.withColumn("x", F.col("p")).withColumn("kind", F.lit(0)).unionByName(salted.withColumn("kind", F.lit(1)))
    full = rows.join(texts.withColumnRenamed("node", "x"), "x").select("p", "salt", "kind", "x", "text")
    return full.repartition("p", "salt").sortWithinPartitions("p", "salt", "kind").mapInArrow(words.frugal(_measure(k)), "p long, x long, common long, n_p long, n_x long")


def _block_links(k: int, percent: int):
    """Links between actives (kind 0) and the members that follow them in a
    block, one for each two components joined."""
    names = ["u", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, act, index = None, [], None
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.setdefault(c, c) != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(7)]
            out = []
            for i, s in enumerate(words.shingle_sets(b.column(7), k)):
                p, ai, bj, kind, x, comp, d = (c[i] for c in cols)
                if (p, ai, bj) != key:
                    key, act, index = (p, ai, bj), [], None
                    root = {}
                if kind == 0:
                    act.append((x, comp, d, s))
                    continue
                if not act:
                    continue
                if index is None:
                    flat = np.concatenate([a[3] for a in act])
                    owner = np.repeat(np.arange(len(act)), [len(a[3]) for a in act])
                    order = np.argsort(flat, kind="stable")
                    sizes = np.array([len(a[3]) for a in act])
                    index = (flat[order], owner[order], sizes, np.array([a[2] for a in act]))
                flat, owner, sizes, dist = index
                lo, hi = np.searchsorted(flat, s), np.searchsorted(flat, s, "right")
                n = hi - lo
                hits = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                common = np.bincount(owner[hits], minlength=len(act))
                near = np.abs(dist - d) <= 1 - percent / 100 + 1e-9  # triangle inequality at the pivot
                for j in np.flatnonzero(near & linked(common, sizes, len(s), percent)).tolist():
                    u, v = find(act[j][1]), find(comp)
                    if u != v:
                        root[max(u, v)] = min(u, v)
                        out.append((act[j][0], x))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

    return run


def block_links(rest: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links inside regions between actives and all members.

    ``rest``: (p, x, comp, d, active). Blocks of actives meet blocks of
    members under a key of their own, so no task holds a region.
    """
    size = rest.groupBy("p").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nb"), F.ceil(F.sum(F.col("active").cast("int")) / BLOCK).cast("int").alias("na")).where("na > 0")
    full = rest.join(size, "p").join(texts.withColumnRenamed("node", "x"), "x")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    mine = lambda n: F.pmod(F.xxhash64("x"), F.col(n)).cast("int")
    cols = ["p", "ai", "bj", "kind", "x", "comp", "d", "text"]
    act = full.where("active").withColumns({"kind": F.lit(0), "ai": mine("na"), "bj": F.explode(upto("nb"))}).select(*cols)
    mem = full.withColumns({"kind": F.lit(1), "bj": mine("nb"), "ai": F.explode(upto("na"))}).select(*cols)
    rows = act.unionByName(mem).repartition("p", "ai", "bj").sortWithinPartitions("p", "ai", "bj", "kind")
    return rows.mapInArrow(words.frugal(_block_links(k, percent)), "u long, v long")


def links(docs: DataFrame, base: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(node, comp) of nodes joined by their first pivot, and (u, v): links that
    join the rest.

    ``base``: the ``nodes`` of ``docs``.
    """
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(shingle_order(docs, k))
    member = step(memberships(docs, order, k, percent))
    region = member.groupBy("s").agg(F.count("*").alias("size")).where("size > 1")
    member = step(member.join(region, "s"))
    sizes = base.where("node is not null").groupBy("node").agg(F.max("n").alias("n"), F.min("doc_id").alias("doc_id"))

    small = member.where(F.col("size") <= LARGE).select("s", "node")
    pairs = small.withColumnRenamed("node", "a").join(small.withColumnRenamed("node", "b"), "s").where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    n = sizes.select("node", "n")
    pairs = pairs.join(n.toDF("a", "na"), "a").join(n.toDF("b", "nb"), "b")
    least = F.greatest(F.lit(1), F.floor(F.least("na", "nb") / 16))
    fits = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    pairs = packed(step(pairs.where((F.col("shared") >= least) & fits).select("a", "b")))
    star = packed(step(_pivots(member.where(F.col("size") > LARGE).select("s", "node"))))

    used = pairs.select("a").union(pairs.select("b")).union(star.select("p")).union(star.select("x")).distinct().toDF("node")
    used = used.join(sizes, "node")
    texts = step(_texts(docs, used, k))

    first = pairs.groupBy(F.col("b").alias("x")).agg(F.min("a").alias("p")).select("p", "x")
    near = packed(step(measure(first.union(star).distinct(), texts, k)))
    is_link = linked(F.col("common"), F.col("n_p"), F.col("n_x"), percent)
    found = near.where(is_link).select(F.col("p").alias("u"), F.col("x").alias("v"))
    comp = packed(step(components(found)))

    def label(df: DataFrame, c: str) -> DataFrame:
        out = df.join(comp.toDF(c, f"{c}_comp0"), c, "left")
        return out.withColumn(f"{c}_comp", F.coalesce(f"{c}_comp0", c)).drop(f"{c}_comp0")

    # rest of the small regions
    rest = label(label(pairs.join(first.toDF("a", "b"), ["a", "b"], "left_anti"), "a"), "b").where("a_comp != b_comp")
    rest = packed(step(rest.select(F.col("a").alias("p"), F.col("b").alias("x"))))
    late = measure(rest, texts, k)
    found = late.where(is_link).select(F.col("p").alias("u"), F.col("x").alias("v"))

    # rest of the large regions: members with their distance to the pivot
    dist = 1 - F.col("common") / (F.col("n_p") + F.col("n_x") - F.col("common"))
    large = star.join(near, ["p", "x"]).select("p", "x", dist.alias("d"))
    large = large.union(star.select("p", F.col("p").alias("x"), F.lit(0.0)).distinct())
    large = label(label(large, "x"), "p").select("p", "x", "d", F.col("x_comp").alias("comp"), (F.col("x_comp") != F.col("p_comp")).alias("active"))
    large = packed(step(large))
    for _ in range(ROUNDS - 1):
        # a new pivot out of the rest of each region takes what it reaches
        pivot = large.where("active").groupBy("p").agg(F.min("x").alias("q"))
        reach = packed(step(large.join(pivot, "p").where("x != q").select("p", "q", "x")))
        more = packed(step(measure(reach.select(F.col("q").alias("p"), "x").distinct(), texts, k).where(is_link).select(F.col("p").alias("q"), "x")))
        found = found.union(more)
        joins = large.join(reach.join(more, ["q", "x"]).select("p", "x", F.lit(True).alias("hit")), ["p", "x"], "left").join(pivot, "p", "left")
        joins = joins.withColumn("hit", F.coalesce("hit", F.col("x") == F.col("q"), F.lit(False)))
        # components of this region that the new pivot joins to its own
        reached = packed(step(joins.where("hit").select("p", "comp", "active").distinct()))
        both = reached.groupBy("p").agg(F.min("active").alias("all_active")).where("not all_active").select("p", F.lit(True).alias("joined"))
        done = reached.where("active").join(both, "p").select("p", "comp", "joined")
        large = large.join(done, ["p", "comp"], "left").select("p", "x", "d", "comp", (F.col("active") & F.col("joined").isNull()).alias("active"))
        large = packed(step(large))
    return comp, packed(step(found.union(block_links(large, texts, k, percent))))


def _pivots(large: DataFrame) -> DataFrame:
    """(p, x): the members of large regions under their pivot document.

    A region's pivot is the member in most large regions. Regions whose members
    also stand under a higher pivot go to it, so overlapping regions of one
    cluster become one; any such mapping of whole regions keeps each two
    members of a region together.
    """
    degree = large.groupBy("node").agg(F.count("*").alias("deg"))
    ranked = step(large.join(degree, "node").select("s", "node", F.struct("deg", "node").alias("rank")))
    own = ranked.groupBy("s").agg(F.max("rank").alias("top"))
    best = ranked.join(own, "s").groupBy("node").agg(F.max("top").alias("top"))
    shared = large.join(best, "node").groupBy("s").agg(F.max("top").alias("top"))
    return large.join(shared, "s").select(F.col("top.node").alias("p"), F.col("node").alias("x")).where("p != x").distinct()


def _texts(docs: DataFrame, used: DataFrame, k: int) -> DataFrame:
    """(node, text), one text for each node in ``used`` (node, doc_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [set_id(s) if len(s) else None for s in words.shingle_sets(b.column(1), k)]
            same = pa.array([i == n for i, n in zip(ids, b.column(0).to_pylist())])
            yield b.filter(same)

    ids = used.select("node", F.col("doc_id").alias("id"))
    full = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("id"))).select("node", "text")
    return full.mapInArrow(words.frugal(run), "node long, text string").dropDuplicates(["node"])


def similar_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Components of near-copies among all rows of ``docs`` (doc_id, text).

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable by
    links, itself included), class_size (rows with the same set). Null, empty
    and blank texts have no shingles and no links; repeated rows and copies
    are one class; rows with a null doc_id take part, and give a null
    component_id only where no row of the component has an id. Texts of any
    length are taken whole. An empty table gives an empty result; other
    columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    base = step(nodes(docs, k))
    first, found = links(docs, base, k, percent)
    for end in ("u", "v"):  # the rest of the links, between components
        found = found.join(first.toDF(end, "c"), end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
    last = packed(step(components(found.select("u", "v")))).toDF("comp", "last")
    classes = base.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"), F.count("*").alias("class_size"))
    named = classes.join(first, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = named.join(last, "comp", "left").withColumn("comp", F.coalesce("last", "comp")).drop("last")
    low = named.groupBy("comp").agg(F.min("low").alias("component_id"), F.count("*").alias("members"))
    named = named.join(low, "comp").where((F.col("class_size") > 1) | (F.col("members") > 1))
    named = named.select("node", "component_id", "class_size", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    out = base.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(named, ["node", "salt"], "left")
    own = F.when(F.col("class_size").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))
