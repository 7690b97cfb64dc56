"""Repair of conversation structure by Knuth's lightest-derivation agenda.

A repaired conversation's roles read ``(s?(ua)+)?`` (initials of system, user,
assistant). The items deduced are (i, q): rows i and later can be edited so
that the rest of a legal conversation follows from state q of that pattern. A
deduction has an item and one edit as antecedents: the edit of row i - 1, or an
inserted row. Its value is (cost, rows used, audit), the audit being the edits'
letters; putting an edit in front never gives a smaller value and keeps the
order of the values, so the functions are superior and each item's value is
final when the agenda pops it. The run ends when the goal, (0, start), pops.

For one item, edits of different letters lead to different tails and each
letter to one tail only, so at equal cost the first letter decides which audit
comes first, and the agenda holds letters instead of whole audits.

A conversation's answer (its audit, its repaired text in order) is one value,
so its rows meet in one task, in order. That task keeps 16 bytes of a distinct
row (for duplicates) and a few bytes a row; texts over ``HELD_BYTES`` wait in
the task's scratch file.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgecast.session import ship_package

#: Costs of the edits, and of leaving a truncated row in place.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Letters of the edits, in ASCII order.
LETTERS = "DIKR"
D, I, K, R = range(4)  # noqa: E741
#: States: start, after system, after user, after assistant; where each role leads.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
#: The role that an edited or inserted row gets in each state.
NEXT = ("u", "u", "a", "u")
#: (state before, state after) by role.
BACK = {r: [(q, z) for (q, x), z in STEP.items() if x == r] for r in "sua"}
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: Kinds of rows.
FINE, CUT_OFF, MUST_GO = range(3)
HELD_BYTES = 1 << 24
SPACE = " \t\n\x0b\x0c\r"


def lightest(initials: str, kinds: bytes) -> tuple[int, list[tuple[int, str]]]:
    """Cost and edits (letter, role given or "") of the cheapest repair, the
    ASCII-least audit of equals. ``kinds`` has the kind of each row."""
    n = len(initials)
    into: dict[int, dict[str, list[int]]] = {q: {r: [a for a, z in BACK[r] if z == q] for r in "sua"} for q in range(4)}
    given = {q: into[q]["u"] + into[q]["a"] for q in range(4)}
    span, last = 4 * (n + 1), 4 * n
    best = bytearray(b"\xff") * span
    # priority: cost, rows used, letter, item
    agenda = [last, last + 3]
    while True:
        value, item = divmod(heapq.heappop(agenda), span)
        if best[item] != 0xFF:
            continue
        value, letter = divmod(value, 4)
        best[item] = letter
        if item == 0:
            break
        cost, used = divmod(value, n + 1)
        i, q = divmod(item, 4)
        for a in given[q]:
            heapq.heappush(agenda, (((cost + INSERT) * (n + 1) + used) * 4 + I) * span + 4 * i + a)
        if i:
            row, kind = 4 * i - 4, kinds[i - 1]
            heapq.heappush(agenda, (((cost + DELETE) * (n + 1) + used + 1) * 4 + D) * span + row + q)
            if kind != MUST_GO:
                cost += TRUNCATED * (kind == CUT_OFF)
                for a in into[q].get(initials[i - 1], ()):
                    heapq.heappush(agenda, ((cost * (n + 1) + used + 1) * 4 + K) * span + row + a)
                for a in given[q]:
                    heapq.heappush(agenda, (((cost + REROLE) * (n + 1) + used + 1) * 4 + R) * span + row + a)
    total = value // (n + 1)
    edits, i, q = [], 0, 0
    while i < n or q not in (0, 3) or best[4 * i + q] == I:
        letter = best[4 * i + q]
        role = NEXT[q] if letter in (I, R) else ""
        edits.append((letter, role))
        if letter != D:
            q = STEP[q, role or initials[i]]
        i += letter != I
    return total, edits


class Texts:
    """Rows' roles and texts in order; over ``HELD_BYTES`` they wait in a file."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, str]] = []
        self.size, self.file = 0, None

    def add(self, role: str, text: str) -> None:
        self.rows.append((role, text))
        self.size += len(role) + len(text)
        if self.size > HELD_BYTES:
            self.file = self.file or tempfile.TemporaryFile()
            for pair in self.rows:
                for x in map(str.encode, pair):
                    self.file.write(len(x).to_bytes(8, "little") + x)
            self.rows, self.size = [], 0

    def __iter__(self) -> Iterator[tuple[str, str]]:
        if self.file is not None:
            self.file.seek(0)

            def read() -> str:
                return self.file.read(int.from_bytes(head, "little")).decode()

            while head := self.file.read(8):
                role = read()
                head = self.file.read(8)
                yield role, read()
            self.file.close()
        yield from self.rows


@dataclass
class Conversation:
    """What is known of a conversation while its rows come in order."""

    conv_id: int | None
    texts: Texts = field(default_factory=Texts)
    initials: list[str] = field(default_factory=list)
    kinds: bytearray = field(default_factory=bytearray)
    seen: set[bytes] = field(default_factory=set)
    faults: dict[str, int] = field(default_factory=lambda: {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0})
    turns: list[int] | None = None  # smallest, largest, how many different ones

    def add(self, turn: int | None, role: str, text: str, blank: bool, cut: bool) -> None:
        mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        kind, fault = FINE, ""
        if blank:
            kind, fault = MUST_GO, "blank"
        elif mark in self.seen:
            kind, fault = MUST_GO, "duplicate"
        elif cut:
            kind, fault = CUT_OFF, "truncated"
        if fault:
            self.faults[fault] += 1
        self.seen.add(mark)
        x = role[:1]
        if self.initials and self.initials[-1] + x not in LEGAL:
            self.faults["illegal"] += 1
        self.initials.append(x)
        self.kinds.append(kind)
        self.texts.add(role, text)
        if turn is not None:
            if self.turns is None:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = [turn, self.turns[2] + 1]

    @property
    def gaps(self) -> int:
        return self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0

    def repair(self) -> tuple[int, list[tuple[int, str]]]:
        return lightest([x if x in "sua" else "" for x in self.initials], self.kinds)

    def edited(self, edits: list[tuple[int, str]]) -> Iterator[tuple[int, str, str]]:
        """Each edit's letter with its row's role and text afterwards."""
        rows = iter(self.texts)
        for letter, given in edits:
            role, text = ("", "") if letter == I else next(rows)
            yield letter, NAMES.get(given, role), text


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    now = None
    for b in batches:
        for conv_id, turn, role, text, copies, blank, cut in zip(*(c.to_pylist() for c in b.columns)):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now
                now = Conversation(conv_id)
            for _ in range(copies):
                now.add(turn, role, text, blank, cut)
    if now is not None:
        yield now


def _in_order(turns: DataFrame) -> DataFrame:
    """A conversation's rows together and in order, with their blanks and ends judged."""
    copies = F.col("copies").cast("int") if "copies" in turns.columns else F.lit(1)
    src = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), copies.alias("copies"))
    bare = F.btrim("text", F.lit(SPACE))
    src = src.withColumns({"blank": bare == "", "cut": ~F.right(bare, F.lit(1)).isin(".", "!", "?")})
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return src.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def repair(turns: DataFrame) -> DataFrame:
    """The cheapest legal form of each conversation, one row an edit: conv_id,
    seq (from 0), edit (K, R, D or I), role and text after it; deleted rows are
    in it with their own role and text.

    ``turns`` has conv_id, turn, role, text, and maybe copies (how often the row
    stands there; 0: not at all, but its conversation exists); other columns
    aren't read. A null role or text is one space, a null conv_id a conversation
    of its own. Rows go by turn, nulls first; those of one turn by role and
    text. An empty table gives no rows.
    """
    ship_package(turns.sparkSession)
    names = ["conv_id", "seq", "edit", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        for c in _conversations(batches):
            for seq, (letter, role, text) in enumerate(c.edited(c.repair()[1])):
                rows.append((c.conv_id, seq, LETTERS[letter], role, text))
                size += 64 + len(text)
                if size > 1 << 20:
                    yield _batch(rows, kinds, names)
                    rows, size = [], 0
        yield _batch(rows, kinds, names)

    return _in_order(turns).mapInArrow(run, "conv_id long, seq long, edit string, role string, text string")


def report(turns: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, gaps (turns missing between the first and
    the last one), blank, duplicate, truncated, illegal (rows of each fault;
    neighbours whose roles can't follow each other), cost and audit of the repair,
    repaired_sha256 of the repaired ``role:text`` lines. Rows as in ``repair``;
    without rows zeros, an empty audit and the hash of nothing."""
    ship_package(turns.sparkSession)
    counts = ["blank", "duplicate", "truncated", "illegal"]
    names = ["conv_id", "gaps", *counts, "cost", "audit", "repaired_sha256"]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for c in _conversations(batches):
            cost, edits = c.repair()
            audit = "".join(LETTERS[letter] for letter, _ in edits)
            digest, glue = hashlib.sha256(), b""
            for letter, role, text in c.edited(edits):
                if letter != D:
                    digest.update(glue + f"{role}:{text}".encode())
                    glue = b"\n"
            rows.append((c.conv_id, c.gaps, *(c.faults[k] for k in counts), cost, audit, digest.hexdigest()))
            size += 100 + len(audit)
            if size > 1 << 20:
                yield _batch(rows, kinds, names)
                rows, size = [], 0
        yield _batch(rows, kinds, names)

    return _in_order(turns).mapInArrow(run, ", ".join(f"{n} {'long' if k == pa.int64() else 'string'}" for n, k in zip(names, kinds)))


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)


def damage(turns: DataFrame) -> DataFrame:
    """Faults put in by crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties its
    text, 2 takes its ``[.!?]`` away, 3 repeats it, 4 makes its role user; nulls are
    one space. Dropped rows stay with ``copies`` 0, so that no conversation is lost."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    src = turns.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    return src.withColumn("kind", kind).select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    )
