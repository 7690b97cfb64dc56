"""SentencePiece (BPE) encoding by a prefix table, and decoding.

A merge-type vocabulary gives each prefix of a text one encoding, so each
prefix has a unique last token. ``PieceCodec`` finds, for each end position,
the pieces ending there with an Aho-Corasick automaton and keeps the one whose
pair with the last token of the remaining prefix is compatible: encoding both
joined gives both again. The ids are recovered backwards from the table.

A text may be cut between two characters that stand side by side in no piece,
without changing its encoding. Pieces hold the space mark only in front and no
new line, so a text is cut before runs of the mark and around new lines, and
words are cut from the punctuation that the vocabulary never joins to letters.
The encodings of short parts are kept in a table of bounded size per worker.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from surgecast.llm import words
from surgecast.session import ship_package

MARK = "▁"
#: Parts and pairs kept per worker (about 260 and 130 bytes each, the parts in two
#: generations), and the longest part that is kept.
KEPT_PARTS, KEPT_PAIRS, KEPT_CHARS = 100_000, 200_000, 48


class PieceDecoder:
    """Texts of a SentencePiece model's ids."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        kinds = (sp.is_unknown, sp.is_control, sp.is_byte, sp.is_unused)
        plain = {i: sp.id_to_piece(i) for i in range(n) if not any(k(i) for k in kinds)}
        self.bytes_of = np.empty(n, object)
        for i in range(n):
            self.bytes_of[i] = plain[i].replace(MARK, " ").encode() if i in plain else b""
        self.is_byte = np.zeros(n, bool)
        for i in range(n):
            if sp.is_byte(i):
                self.bytes_of[i], self.is_byte[i] = bytes([int(sp.id_to_piece(i)[3:5], 16)]), True
        self.bytes_of[sp.unk_id()] = " ⁇ ".encode()
        self.dummy = np.array([plain.get(i, "").startswith(MARK) for i in range(n)])

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; control ids have none, and bytes that are no UTF-8 give
        one replacement character each."""
        ids = np.asarray(ids, np.int64)
        raw = b"".join(self.bytes_of[ids].tolist())
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            text = self._decode_runs(ids)
        shown = np.flatnonzero(np.array([bool(x) for x in self.bytes_of[ids[:8]]]))
        first = ids[shown[0]] if len(shown) else -1
        return text[1:] if first >= 0 and self.dummy[first] else text

    def _decode_runs(self, ids: np.ndarray) -> str:
        out, run = [], b""

        def flush(run: bytes) -> str:
            text = ""
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        text += run[:n].decode("utf-8")
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    text, n = text + "�", 1
                run = run[n:]
            return text

        for i in ids.tolist():
            if self.is_byte[i]:
                run += self.bytes_of[i]
                continue
            out += [flush(run), self.bytes_of[i].decode("utf-8")]
            run = b""
        return "".join([*out, flush(run)])


class PieceCodec(PieceDecoder):
    """Encoder and decoder of one BPE SentencePiece model."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        super().__init__(path)
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.eos = sp.eos_id()
        kinds = (sp.is_unknown, sp.is_control, sp.is_byte, sp.is_unused)
        self.byte_id = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        plain = {i: sp.id_to_piece(i) for i in range(n) if not any(k(i) for k in kinds)}
        ids = {p: i for i, p in plain.items()}
        order = sorted((i for i, p in plain.items() if len(p) > 1), key=lambda i: (-sp.get_score(i), i))
        lost = {c for i in order for c in plain[i]} - ids.keys()
        inner = [p for p in plain.values() if MARK in p.lstrip(MARK)]
        if lost or inner or any("\n" in p for p in plain.values()) or len(self.byte_id) != 256:
            raise ValueError("not a BPE model with byte fallback, all single characters and the space mark in front only")
        self.rank = {i: -1 for i in plain}
        self.rank.update({i: r for r, i in enumerate(order)})
        self.split: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for p, i in ids.items():  # every pair of pieces that joins to a piece
            for k in range(1, len(p)):
                a, b = ids.get(p[:k]), ids.get(p[k:])
                if a is not None and b is not None:
                    self.joined[a, b] = i
        self.auto = ahocorasick.Automaton()
        for p, i in ids.items():
            if self._reachable(p, i, ids):
                self.auto.add_word(p, (len(p), i))
        self.auto.make_automaton()
        self.checked: dict[int, bool] = {}
        self.pairs = n
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cut = self._cuts(plain.values())

    @staticmethod
    def _cuts(pieces: Iterable[str]) -> re.Pattern:
        """Pattern of the parts: words, and runs of marks that stand beside a letter in no piece."""
        letter = "[A-Za-zÀ-ÖØ-öø-ÿ]"
        joined = {m for p in pieces for a, b in zip(p, p[1:]) for m, x in ((a, b), (b, a)) if re.match(letter, x)}
        marks = "".join(re.escape(m) for m in string.punctuation if m not in joined)
        whole = f"{MARK}*[^{MARK}\n]+|{MARK}+|\n"
        if not marks:
            return re.compile(whole)
        return re.compile(f"{MARK}*{letter}++(?=[{marks}{MARK}\n]|\\Z)|{MARK}*[{marks}]++(?=[{MARK}\n]|{letter}|\\Z)|{whole}")

    def _reachable(self, piece: str, goal: int, ids: dict[str, int]) -> bool:
        """Merges alone lead from the piece's characters to it; notes the last merge."""
        seq = [ids[c] for c in piece]
        while len(seq) > 1:
            ranked = [(self.rank[j], k) for k in range(len(seq) - 1) if (j := self.joined.get((seq[k], seq[k + 1]))) is not None]
            if not ranked:
                return False
            k = min(ranked)[1]
            if len(seq) == 2:
                self.split[goal] = (seq[0], seq[1])
            seq[k : k + 2] = [self.joined[seq[k], seq[k + 1]]]
        return seq == [goal]

    def compatible(self, a: int, b: int) -> bool:
        """Whether a joined with b is encoded as (a, b): undo the merges of both
        from the latest on; no pair across the border may merge earlier."""
        left, right, before, ok = a, b, 1 << 60, True
        while True:
            j = self.joined.get((left, right))
            if j is not None and self.rank[j] < before:
                ok = False
                break
            x, y = self.rank[left], self.rank[right]
            if x < 0 and y < 0:
                break
            if x > y:
                before, left = x, self.split[left][1]
            else:  # at equal ranks the left merge comes first, so one across the border would, too
                before, right = y + 1, self.split[right][0]
        if len(self.checked) >= KEPT_PAIRS:
            self.checked.clear()
        self.checked[a * self.pairs + b] = ok
        return ok

    def _part(self, part: str) -> list[int]:
        """Ids of a part, from its prefix table."""
        n = len(part)
        last = [-1] * (n + 1)  # last token of each prefix; -1: a character in no piece
        size = [1] * (n + 1)
        known, pairs = self.checked.get, self.pairs
        for at, (length, i) in self.auto.iter(part):  # by end, the longest piece first
            e = at + 1
            if last[e] < 0:
                before = last[e - length]
                if before >= 0:
                    ok = known(before * pairs + i)
                    if not (self.compatible(before, i) if ok is None else ok):
                        continue
                last[e], size[e] = i, length
        out: list[int] = []
        e = n
        while e:
            if last[e] < 0:
                out.extend(self.byte_id[b] for b in reversed(part[e - 1].encode("utf-8")))
            else:
                out.append(last[e])
            e -= size[e]
        return out[::-1]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, as uint32, without an end id."""
        if not text:
            return np.zeros(0, np.uint32)
        parts = self.cut.findall(MARK + text.replace(" ", MARK))
        out = list(map(self.parts.get, parts))
        if None in out:
            kept, older = self.parts, self.older
            for i in [i for i, x in enumerate(out) if x is None]:
                p = parts[i]
                x = kept.get(p) or older.get(p)
                if x is None:
                    x = np.array(self._part(p), np.uint32).tobytes()
                if len(p) <= KEPT_CHARS:
                    if len(kept) >= KEPT_PARTS:  # what isn't used again soon goes with the older ones
                        self.older, self.parts = kept, {}
                        kept, older = self.parts, self.older
                    kept[p] = x
                out[i] = x
        return np.frombuffer(b"".join(out), np.uint32)


_tools: dict[tuple[type, str], PieceDecoder] = {}


def codec(path: str, kind: type = PieceCodec) -> PieceCodec:
    """The worker's codec (or only decoder) of a model file."""
    if (kind, path) not in _tools:
        _tools[kind, path] = kind(path)
    return _tools[kind, path]


def _with(batch: pa.RecordBatch, names: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    cols = dict(zip(batch.schema.names, batch.columns)) | new
    return pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)


def tokenize(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", end_id: bool = True, decoded: str | None = None) -> DataFrame:
    """Add column ``ids`` (array of int) with the encoding of whole texts and, if
    named, ``decoded`` with the text that these ids give back.

    Both in one pass, so a task needs one worker and one set of tables. Null and
    empty texts have the end id only. Rows are handled one by one, so repeated
    rows stay and an empty table stays empty; other columns pass through, and
    columns named ``ids`` or ``decoded`` are replaced.
    """
    ship_package(docs.sparkSession)
    out = docs.drop(ids, *([decoded] if decoded else [])).schema.add(ids, T.ArrayType(T.IntegerType()))
    if decoded:
        out = out.add(decoded, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        tail = np.array([tool.eos] if end_id else [], np.uint32)
        for b in batches:
            col = b.column(b.schema.names.index(text))
            _, off = words.utf8(col)
            for a, z in words.chunks(off):
                got = [np.concatenate([tool.encode(x or ""), tail]) for x in col.slice(a, z - a).to_pylist()]
                ends = np.cumsum([0, *map(len, got)]).astype(np.int32)
                new = {ids: pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(got).astype(np.int32)))}
                if decoded:
                    new[decoded] = pa.array([tool.decode(x) for x in got], pa.string())
                yield _with(b.slice(a, z - a), out.names, new)

    return docs.mapInArrow(words.frugal(run), out)


def detokenize(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add column ``text`` with the text of the ids (null: empty).

    Row by row: repeated rows stay, an empty table stays empty, other columns
    pass through, and a column named ``text`` is replaced.
    """
    ship_package(docs.sparkSession)
    out = docs.drop(text).schema.add(text, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, PieceDecoder)
        for b in batches:
            col = b.column(b.schema.names.index(ids))
            ends = np.cumsum([0, *[len(x) if x.is_valid else 0 for x in col]])
            flat = col.flatten().to_numpy(zero_copy_only=False)
            for a, z in words.chunks(ends, words.CHUNK_BYTES // 4):
                got = [tool.decode(flat[ends[i] : ends[i + 1]]) for i in range(a, z)]
                yield _with(b.slice(a, z - a), out.names, {text: pa.array(got, pa.string())})

    return docs.mapInArrow(run, out)
