"""Byte-level BPE ids of whole texts, by splitting in arrays and remembering the ids of pieces.

The splitter reproduces the public byte-level pattern
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
over an array of character classes; BPE works inside each piece, so ids of pieces, taken from the tokenizers library's
model and kept in a bounded memory by a 128-bit hash, join to the ids of the text.
"""

from __future__ import annotations

import json
import os
import unicodedata
from functools import lru_cache
from itertools import chain
from operator import attrgetter

import numpy as np
import xxhash

from quarry.llm.common import chunks, mix

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: The characters of the pattern's white space, and its contractions.
WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Characters that the splitter is shown at once, and pieces that are learned at once: tokenizers takes some hundred
#: bytes for each, and what it frees stays with the process.
PROBE_CHARS, LEARN_PIECES = 1 << 14, 1 << 12


@lru_cache(maxsize=2)
def classes(path: str) -> np.ndarray:
    """Class of each code point, as the tokenizer's own splitter sees it: runs of one class in Python's tables are tried
    on the splitter, each after a character that is surely of that class, and where a run falls apart (their Unicode
    versions differ) its characters are tried one by one. Long runs are cut, and no call sees more than `PROBE_CHARS`
    characters and a run."""
    out = np.full(0x110000, OTHER, np.uint8)
    for i in range(0, 0x110000, PROBE_CHARS):
        own = out[i : i + PROBE_CHARS]
        kinds = np.frombuffer("".join(map(unicodedata.category, map(chr, range(i, i + len(own))))).encode(), np.uint8)[::2]  # "Lu", "Nd"
        own[kinds == ord("L")], own[kinds == ord("N")] = LETTER, NUMBER
    out[list(WHITE)] = SPACE
    leads = {LETTER: "a", NUMBER: "1", OTHER: "!", SPACE: "!"}
    edges = sorted({*(np.flatnonzero(out[1:] != out[:-1]) + 1).tolist(), *range(0, 0x110000, PROBE_CHARS), 0xD800, 0xE000, 0x110000})
    runs = [(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True) if not 0xD800 <= a < 0xE000]  # no surrogates
    split = _tokenizer(path).pre_tokenizer.pre_tokenize_str

    def whole(tries: list[str]) -> list[bool]:
        """Whether each string, on a line of its own, stays in one piece."""
        out: list[bool] = []
        for i, j in chunks(tries, PROBE_CHARS):  # type: ignore[arg-type]
            have = {spot for _, spot in split("\n" + "\n".join(tries[i:j]))}
            begin = np.cumsum([1, *(len(t) + 1 for t in tries[i:j])])[:-1].tolist()
            out += [(a, a + len(t)) in have for a, t in zip(begin, tries[i:j], strict=True)]
        return out

    text = lambda a, b: "".join(map(chr, range(a, b)))
    sure = whole([leads[int(out[a])] + text(a, b) for a, b in runs])
    odd = [i for (a, b), ok in zip(runs, sure, strict=True) if not ok for i in range(a, b)]
    out[odd] = SPACE
    for kind in (LETTER, NUMBER, OTHER):
        out[np.array(odd, np.int64)[whole([leads[kind] + chr(i) for i in odd])]] = kind
    return out


def cuts(text: str, begins: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Start of every piece of texts that are joined to one, each beginning at its place in `begins`; `kinds` are the
    classes of code points."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(code)
    kind = kinds[code]
    start = np.ones(n, bool)
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start[begins] = True
    white = kind == SPACE
    last = np.zeros(n, bool)  # white space right before something else
    np.logical_and(white[:-1], ~white[1:], out=last[:-1])
    last[begins[1:] - 1] = False
    start |= last
    start[np.flatnonzero(last & (code == 32)) + 1] = False  # a blank goes with what follows
    marks = np.flatnonzero((code == 39) & start)
    marks = marks[marks + 1 < n]
    if len(marks):
        own = np.zeros(n, bool)
        own[begins] = True
        for i in marks[(kind[marks + 1] == LETTER) & ~own[marks + 1]].tolist():
            for c in CONTRACTIONS:
                if text.startswith(c, i + 1):
                    start[i + 1] = False
                    if i + 1 + len(c) < n:
                        start[i + 1 + len(c)] = True
                    break
    return np.flatnonzero(start)


#: Bytes of a piece, from the lowest, that lie in its last eight.
TAIL = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)
#: Pieces of more bytes than this are hashed one by one.
HASH_BYTES = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)


def hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each piece; a piece is known by both together. Eight bytes are mixed in at a time; where there are
    no more, the first hash tells pieces of one length apart for sure."""
    at8 = np.ndarray((len(data),), "<u8", data + bytes(8), strides=(1,))  # the eight bytes from each place on
    size = ends - starts
    with np.errstate(over="ignore"):
        part = at8[starts] & TAIL[np.minimum(size, 8)]
        plus = part + size.astype(np.uint64) * _ODD
        one, two = mix(plus), mix(plus * _ODD ^ part)
        todo = np.flatnonzero((size > 8) & (size <= HASH_BYTES))
        at, left = starts[todo] + 8, size[todo] - 8
        while len(todo):
            part = at8[at] & TAIL[np.minimum(left, 8)]
            one[todo], two[todo] = mix(one[todo] ^ part), mix(two[todo] * _ODD + part)
            more = left > 8
            todo, at, left = todo[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > HASH_BYTES).tolist():
        both = xxhash.xxh3_128_intdigest(data[int(starts[i]) : int(ends[i])])
        one[i], two[i] = both >> 64, both & 0xFFFFFFFFFFFFFFFF
    return one, two


def byte_letters() -> np.ndarray:
    """The character by which the byte-level splitter tells each byte: itself where it can be seen, else one past 255."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = np.zeros(256, np.uint16)
    out[seen] = seen
    out[out == 0] = 256 + np.arange(256 - len(seen))
    return out


LETTERS = byte_letters()


@lru_cache(maxsize=2)
def _tokenizer(path: str):  # noqa: ANN202
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism here
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return own


def _plain(path: str) -> bool:
    """Whether the file splits by the public pattern, into bytes, with nothing done or taken out before."""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    split = said.get("pre_tokenizer") or {}
    if not all(t.get("special") for t in said.get("added_tokens") or []) or said.get("truncation") or said.get("padding"):
        return False
    return said.get("normalizer") is None and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)


#: What is remembered of a piece: two hashes, its ids' place in the pool and number, and in how many calls it was seen.
FIELDS = {"key": np.uint64, "check": np.uint64, "begin": np.int64, "count": np.int64, "uses": np.int32}


class Encoder:
    """ids of texts, as uint32 arrays. Remembers at most about `most` pieces: past that, those seen again.

    Known pieces lie in arrays with room to grow, so learning some moves no others, and are found by open addressing:
    `slots` has a piece's number at its key or, where others came before, at the next free place. Number 0 is none."""

    def __init__(self, path: str, most: int = 800_000) -> None:
        self.own, self.most = _tokenizer(path), most
        self.kinds = classes(path) if _plain(path) else None
        self.tokenize = self.own.model.tokenize
        for name, kind in FIELDS.items():
            setattr(self, name, np.zeros(1, kind))
        self.pool = np.zeros(0, np.uint32)
        self._keep(np.zeros(0, np.int64))

    def _ids(self, which: np.ndarray) -> np.ndarray:
        """The ids of pieces, one after another."""
        n = self.count[which]
        ends = np.cumsum(n)
        return self.pool[np.repeat(self.begin[which] - (ends - n), n) + np.arange(ends[-1] if len(n) else 0)]

    def _keep(self, which: np.ndarray) -> None:
        """Only these of the known pieces."""
        ids, room = self._ids(which), max(self.most + (self.most >> 2), len(which)) + 1
        self.begin[which] = np.cumsum(self.count[which]) - self.count[which]
        self.uses[which] = 0
        for name, kind in FIELDS.items():
            fresh = np.zeros(room, kind)
            fresh[1 : len(which) + 1] = getattr(self, name)[which]
            setattr(self, name, fresh)
        self.pool = np.zeros(max(4 * room, len(ids)), np.uint32)
        self.pool[: len(ids)] = ids
        self.known, self.ids = len(which) + 1, len(ids)
        self._place()

    def _place(self) -> None:
        """A table at most half full of all known pieces."""
        self.slots = np.zeros(1 << (2 * max(self.most, self.known)).bit_length(), np.int32)
        self._insert(np.arange(1, self.known, dtype=np.int32))

    def _insert(self, which: np.ndarray) -> None:
        last = len(self.slots) - 1
        spot = (self.key[which] & np.uint64(last)).astype(np.int64)
        while len(which):
            free = self.slots[spot] == 0
            self.slots[spot[free]] = which[free]
            rest = self.slots[spot] != which
            which, spot = which[rest], (spot[rest] + 1) & last

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Number of the piece of each key, 0 where it is unknown."""
        last = len(self.slots) - 1
        spot = (keys & np.uint64(last)).astype(np.int64)
        out = self.slots[spot]
        todo = np.flatnonzero((self.key[out] != keys) & (out != 0))
        spot = spot[todo]
        while len(todo):
            spot = (spot + 1) & last
            at = self.slots[spot]
            out[todo] = at
            on = (self.key[at] != keys[todo]) & (at != 0)
            todo, spot = todo[on], spot[on]
        return out

    def _forget(self) -> None:
        """Keep the pieces seen in more calls than the median."""
        uses = self.uses[1 : self.known]
        self._keep(np.flatnonzero(uses > np.sort(uses)[len(uses) // 2]) + 1)

    def _learn(self, keys: np.ndarray, checks: np.ndarray, pieces: list[str]) -> None:
        """Pieces in the splitter's letters, each told by the tokenizer's model."""
        for i in range(0, len(pieces), LEARN_PIECES):
            found = list(map(self.tokenize, pieces[i : i + LEARN_PIECES]))
            count = np.fromiter(map(len, found), np.int64, len(found))
            total = int(count.sum())
            ids = np.fromiter(map(attrgetter("id"), chain.from_iterable(found)), np.uint32, total)
            a, b = self.known, self.known + len(found)
            if b > len(self.key):
                for name, kind in FIELDS.items():
                    setattr(self, name, np.append(getattr(self, name), np.zeros(b, kind)))
            if self.ids + total > len(self.pool):
                self.pool = np.append(self.pool, np.zeros(self.ids + total, np.uint32))
            self.pool[self.ids : self.ids + total] = ids
            self.key[a:b], self.check[a:b] = keys[i : i + len(found)], checks[i : i + len(found)]
            self.begin[a:b], self.count[a:b] = self.ids + np.cumsum(count) - count, count
            self.known, self.ids = b, self.ids + total
            if 2 * b > len(self.slots):
                self._place()
            else:
                self._insert(np.arange(a, b, dtype=np.int32))

    def _plainly(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [np.array(e.ids, np.uint32) for e in self.own.encode_batch(texts, add_special_tokens=False)]
        return np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each text has."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = (np.cumsum(size) - size)[size > 0]
        if not len(begins):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        if self.kinds is None:
            return self._plainly(texts)
        text = "".join(texts)
        if self.known > self.most:
            self._forget()
        starts = first = cuts(text, begins, self.kinds)
        data = text.encode("utf-8", "surrogatepass")
        if len(data) > len(text):
            starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)[starts]
        ends = np.append(starts[1:], len(data))
        keys, checks = hashes(data, starts, ends)
        at = self._find(keys)
        todo = np.flatnonzero(at == 0)
        if len(todo):
            new = todo[np.unique(keys[todo], return_index=True)[1]]
            letters = LETTERS[np.frombuffer(data, np.uint8)].tobytes().decode("utf-16-le")
            self._learn(keys[new], checks[new], [letters[i:j] for i, j in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            at[todo] = self._find(keys[todo])
        if (self.check[at] != checks).any():  # two pieces with one key
            return self._plainly(texts)
        self.uses[at] += 1
        counts = np.zeros(len(texts), np.int64)
        counts[size > 0] = np.add.reduceat(self.count[at], np.searchsorted(first, begins))
        return self._ids(at), counts


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for each worker process, so what it has learned serves its later tasks."""
    return Encoder(path)
