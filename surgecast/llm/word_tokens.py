"""The tokenizers library over batches of texts, with a table of words.

The vocabulary drops white space and lowers case, so the ids of a text are those
of its parts between spaces and new lines, joined. A part of plain ASCII and
Latin-1 letters (no apostrophe, no special token) falls into words: runs of
letters, single digits, runs of other marks. These words, and all other parts
as wholes, are the units.
numpy finds the units of a megabyte of text at a time and looks them up by
their bytes (up to 24 of them as three numbers, compared exactly; longer ones
in a dict); only units that aren't in the table go to the library.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from surgecast.llm import words

#: Bytes of text, and units, handled at a time.
SEGMENT, UNITS = 1 << 20, 1 << 16
#: Slots and entries of the table, and ids it holds; it starts anew when full.
SLOTS, ENTRIES, STORED = 1 << 20, 1 << 19, 1 << 22
KEPT_PARTS, KEPT_CHARS = 50_000, 64
SPACE, LETTER, DIGIT, OTHER, ODD = range(5)

#: Kind of each byte; ODD: not ASCII (Latin-1 letters are found apart), not printable, or an apostrophe.
KIND = np.full(256, ODD, np.uint8)
KIND[33:127] = OTHER
KIND[ord("0") : ord("9") + 1] = DIGIT
KIND[ord("a") : ord("z") + 1] = LETTER
KIND[ord("A") : ord("Z") + 1] = LETTER
KIND[[32, 10]] = SPACE
KIND[ord("'")] = ODD
#: Keeps the first 0 to 8 bytes of a little-endian number.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
SPREAD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _latin(buf: np.ndarray) -> np.ndarray:
    """First bytes of the Latin-1 letters (U+00C0 to U+00FF but for the signs × and ÷)."""
    at = np.flatnonzero(buf[:-1] == 0xC3)
    second = buf[at + 1]
    return at[(second != 0x97) & (second != 0xB7)]


def _lower(buf: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters in lower case; ß has none."""
    low = words.LOWER[buf]
    second = _latin(buf) + 1
    low[second[buf[second] < 0x9F]] += 32
    return low


class WordTokenizer:
    """Ids of texts, equal to the library's.

    The library's model encodes new words in one call, in which ids of word
    ends tell them apart; other ASCII parts are cut into words (WORD) first.
    Other new parts go through the whole tokenizer in one call, set apart by a
    digit 0, which is a word of its own; those that hold a 0 or may hold a
    special token are encoded alone.
    """

    #: The vocabulary's words, in lower-case ASCII.
    WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ a-z0-9]+")
    END = "</w>"

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tool, self.words = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.words.normalizer = None
        self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tool.get_vocab()
        self.border = vocab.get("0" + self.END)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(self.END)]] = True
        self.parts: dict[str, bytes] = {}
        self.clear()
        marks = [chr(c) for c in (*range(33, 127), *range(0xC0, 0x100))]
        probe = " ".join([a + b for a in marks for b in marks] + ["a0b", "é0 é", "we're I'LL ''s it'd've"])
        if self.border is None or self(probe).tolist() != self._ids([probe])[0].tolist():
            raise ValueError("not a vocabulary of lower-case words that makes each digit a word of its own")
        self.clear()

    def clear(self) -> None:
        """Forget all units."""
        self.slot = np.full(SLOTS, -1, np.int32)
        self.key = np.zeros((4, ENTRIES), np.uint64)  # three numbers, length
        self.at = np.zeros(ENTRIES + 1, np.int64)  # where the ids of each entry begin
        self.long: dict[bytes, int] = {}
        self.store = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.parts.clear()

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tool.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    @staticmethod
    def _cut(names: list[str], ids: np.ndarray, stops: np.ndarray, gap: int) -> dict[str, bytes]:
        """Bytes of the ids of each name: up to its stop, then ``gap`` ids are passed over."""
        if len(stops) != len(names):
            raise ValueError("parts can't be told apart in their joint encoding")
        raw, to = ids.tobytes(), (4 * stops).tolist()
        return {n: raw[a:b] for n, a, b in zip(names, [0, *[x + 4 * gap for x in to]], to)}

    def _encode(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of each part, as bytes."""
        ascii_, other, alone = [], [], []
        for p in parts:
            if "<|" in p:
                alone.append(p)
            elif p.isascii() and p.isprintable():
                ascii_.append(p)
            else:
                (alone if "0" in p else other).append(p)
        got = {p: x.tobytes() for p, x in zip(alone, self._ids(alone))}
        if other:
            ids = self._ids([" 0 ".join(other)])[0]
            got |= self._cut(other, ids, np.append(np.flatnonzero(ids == self.border), len(ids)), 1)
        cut = [self.WORD.findall(p.lower()) for p in ascii_]
        if len(self.parts) >= KEPT_PARTS:
            self.parts.clear()
        new = list({w for ws in cut for w in ws}.difference(self.parts))
        known = {}
        if new:
            ids, stops = self._words(" ".join(new))
            known = self._cut(new, ids, stops, 0)
        table = self.parts
        for p, ws in zip(ascii_, cut):
            got[p] = b"".join([known[w] if w in known else table[w] for w in ws])
        table.update((w, x) for w, x in known.items() if len(w) <= KEPT_CHARS)
        return got

    def _words(self, joined: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lower-case words between spaces, and where each word's ids stop."""
        ids = np.array(self.words.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
        return ids, np.flatnonzero(self.ends[ids]) + 1

    @staticmethod
    def _numbers(buf: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The first 24 bytes of each unit as three numbers, and its length."""
        room = np.concatenate([buf, np.zeros(32, np.uint8)])
        eight = np.ndarray(len(room) - 7, "<u8", room, strides=(1,))
        out = np.empty((4, len(starts)), np.uint64)
        for i in range(3):
            have = np.clip(size - 8 * i, 0, 8)
            out[i] = eight[np.where(have > 0, starts + 8 * i, 0)] & FIRST[have]
        out[3] = size
        return out

    @staticmethod
    def _hash(key: np.ndarray) -> np.ndarray:
        return words.mix(key[0] * SPREAD[0] + key[1] * SPREAD[1] + key[2] * SPREAD[2] + key[3])

    def _find(self, key: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Entry of each unit, -1 for those not in the table."""
        place = (h & np.uint64(SLOTS - 1)).astype(np.int64)
        out = self.slot[place]
        left = np.flatnonzero(out >= 0)
        while len(left):
            same = np.ones(len(left), bool)
            for row, of in zip(self.key, key):
                same &= row[out[left]] == of[left]
            left = left[~same]
            place[left] = (place[left] + 1) & (SLOTS - 1)
            out[left] = self.slot[place[left]]
            left = left[out[left] >= 0]
        return out

    def _add(self, ids: np.ndarray, size: np.ndarray) -> int:
        """The first of the new entries, which have ``size`` of the ids each."""
        first, e = int(self.at[self.used]), self.used
        while first + len(ids) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros(len(self.store), np.uint32)])
        self.store[first : first + len(ids)] = ids
        self.at[e + 1 : e + 1 + len(size)] = first + np.cumsum(size)
        self.used += len(size)
        return e

    def _place(self, key: np.ndarray, h: np.ndarray, entry: np.ndarray) -> None:
        """Make different units that aren't in the table findable."""
        self.key[:, entry] = key
        place, left = (h & np.uint64(SLOTS - 1)).astype(np.int64), np.arange(len(entry))
        while len(left):
            free = left[self.slot[place[left]] < 0]
            self.slot[place[free]] = entry[free]  # of several at one place, one stays
            left = left[self.slot[place[left]] != entry[left]]
            place[left] = (place[left] + 1) & (SLOTS - 1)

    def _learn_words(self, low: np.ndarray, s: np.ndarray, size: np.ndarray, key: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Put the words that begin at ``s`` into the table; their entries."""
        _, first, which = np.unique(h, return_index=True, return_inverse=True)
        if (key != key[:, first][:, which]).any():  # two words of one hash: exact, if slow
            _, first, which = np.unique(key.T, axis=0, return_index=True, return_inverse=True)
            which = which.ravel()
        n = size[first] + 1
        to = np.cumsum(n)
        joined = low[np.minimum(np.arange(int(to[-1])) + np.repeat(s[first] - (to - n), n), len(low) - 1)]
        joined[to - 1] = 32
        ids, stops = self._words(joined[:-1].tobytes().decode("utf-8"))
        if len(stops) != len(first):
            raise ValueError("words can't be told apart in their joint encoding")
        entry = self._add(ids, np.diff(stops, prepend=0)) + np.arange(len(first))
        self._place(key[:, first], h[first], entry)
        return entry[which]

    def _learn_parts(self, names: list[bytes]) -> dict[bytes, int]:
        """Put other units into the table or, if long, into the dict; their entries."""
        new = [n for n in dict.fromkeys(names) if n not in self.long]
        entries = {}
        if new:
            shown = [n.decode("utf-8") for n in new]
            got = self._encode(shown)
            raw = [got[x] for x in shown]
            e = self._add(np.frombuffer(b"".join(raw), np.uint32), np.array([len(x) // 4 for x in raw]))
            entries = {n: e + i for i, n in enumerate(new)}
            short = [n for n in new if len(n) <= 24 and b"<|" not in n]
            self.long.update((n, i) for n, i in entries.items() if len(n) > 24 or b"<|" in n)
            if short:
                length = np.array([len(n) for n in short])
                key = self._numbers(np.frombuffer(b"".join(short), np.uint8), np.cumsum(length) - length, length)
                self._place(key, self._hash(key), np.array([entries[n] for n in short]))
        return {n: entries[n] if n in entries else self.long[n] for n in names}

    def _units(self, buf: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each unit, which are whole parts, and which may hold a special token."""
        kind = KIND[buf]
        latin = _latin(buf)
        kind[latin] = kind[latin + 1] = LETTER
        mark = np.flatnonzero(buf[:-1] == 60)
        mark = mark[buf[mark + 1] == 124]  # <|
        kind[mark] = ODD
        full = kind != SPACE
        part = full.copy()
        part[1:] &= ~full[:-1]
        part[borders] = full[borders]
        number = np.cumsum(part, dtype=np.int32)
        strange = np.zeros(int(number[-1]) + 1, bool)
        strange[number[kind == ODD]] = True
        start = np.empty(len(buf), bool)
        start[0] = True
        start[1:] = kind[1:] != kind[:-1]
        start |= kind == DIGIT
        start &= ~strange[number]
        start &= full
        start |= part
        last = full.copy()
        last[:-1] &= start[1:] | ~full[1:]
        starts, ends = np.flatnonzero(start), np.flatnonzero(last) + 1
        special = np.zeros(len(strange), bool)
        special[number[mark]] = True
        own = number[starts]
        return starts, ends, strange[own], special[own]

    def _segment(self, buf: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a segment, the units' starts, and the ids before each unit and at the end."""
        low = _lower(buf)
        starts, ends, whole, special = self._units(buf, borders)
        flat, counts = [], []
        for a in range(0, len(starts), UNITS):
            s, e, odd = starts[a : a + UNITS], ends[a : a + UNITS], special[a : a + UNITS]
            if self.used + len(s) > ENTRIES or self.at[self.used] > STORED:
                self.clear()
            size = e - s
            long = odd | (size > 24)
            key = self._numbers(low, s, size)
            h = self._hash(key)
            entry = self._find(key, h)
            entry[long] = -1
            slow = long | whole[a : a + UNITS]
            new = np.flatnonzero((entry < 0) & ~slow)
            if len(new):
                entry[new] = self._learn_words(low, s[new], size[new], key[:, new], h[new])
            new = np.flatnonzero((entry < 0) & slow)
            if len(new):
                name = [(buf if o else low)[x:y].tobytes() for x, y, o in zip(s[new], e[new], odd[new])]
                found = self._learn_parts(name)
                entry[new] = [found[x] for x in name]
            n = self.at[entry + 1] - self.at[entry]
            to = np.cumsum(n)
            flat.append(self.store[np.arange(int(to[-1])) + np.repeat(self.at[entry] - (to - n), n)])
            counts.append(n)
        none = np.zeros(0, np.int64)
        before = np.concatenate([[0], np.cumsum(np.concatenate([none, *counts]))])
        return np.concatenate([np.zeros(0, np.uint32), *flat]), starts, before

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: none), and where each text's begin, with the end of the last."""
        buf, off = words.utf8(texts)
        ends, out, total, a = np.zeros(len(off), np.int64), [np.zeros(0, np.uint32)], 0, 0
        while a < len(buf):
            z = self._border(buf, off, a + SEGMENT)
            lo, hi = np.searchsorted(off, [a, z], "right")
            inside = off[lo:hi] - a
            ids, starts, before = self._segment(buf[a:z], inside[inside < z - a])
            ends[lo:hi] = total + before[np.searchsorted(starts, inside)]
            out.append(ids)
            total += len(ids)
            a = z
        return np.concatenate(out), ends

    @staticmethod
    def _border(buf: np.ndarray, off: np.ndarray, z: int) -> int:
        """The first place from ``z`` on where no part is cut."""
        if z >= len(buf):
            return len(buf)
        stop = int(off[np.searchsorted(off, z)])
        while z < stop:
            space = np.flatnonzero(KIND[buf[z - 1 : min(stop, z + 65_536) - 1]] == SPACE)
            if len(space):
                return z + int(space[0])
            z += 65_536
        return stop

    def __call__(self, text: str) -> np.ndarray:
        return self.batch(pa.array([text], pa.large_string()))[0]


_tools: dict[str, WordTokenizer] = {}


def tool_of(path: str) -> WordTokenizer:
    """The worker's tokenizer of a file."""
    if path not in _tools:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _tools[path] = WordTokenizer(path)
    return _tools[path]
