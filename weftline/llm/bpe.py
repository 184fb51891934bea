"""Byte-level BPE encoding and decoding with contiguous rank arrays.

A word is held as the array of its parts and, beside it, the array of the ranks
of neighbouring parts' merges. The smallest rank, the leftmost of equals, is
merged by deleting the boundary there and looking up the two ranks beside it,
until no pair has one. Short words go through this together as the rows of one
matrix. Words are cached with their ids up to a bound.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Table, flat, gathered, named, slices

#: Fixed: the pattern that cuts text into words before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SHORT, _NONE, _ROWS = 64, np.int32(1 << 30), 4096
_LETTER, _NUMBER, _SPACE, _OTHER = range(4)
#: Fixed: what the pattern takes after an apostrophe.
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def byte_symbols() -> dict[str, int]:
    """The printable character that vocabulary files write for each byte: itself, or one from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each code point that the pattern goes by."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    out = np.full(0x110000, _OTHER, np.uint8)
    for kind, of in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        out[np.frombuffer("".join(regex.findall(of, every)).encode("utf-32-le"), "<u4")] = kind
    return out


def cut(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The first places of the words of the pattern, in texts that lie one after the other in ``points``; each word goes on to the next one's."""
    n = len(points)
    kind = _classes()[points]
    space = kind == _SPACE
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    begins = np.zeros(n + 3, bool)
    # Where the class changes, but for one blank before what is not space; the last space of several stands alone or with what follows.
    begins[1:n] = (kind[1:] != kind[:-1]) & ~((points[:-1] == 32) & ~space[1:])
    begins[1 : n - 1] |= space[1:-1] & ~space[2:] & ~first[2:-1]
    begins[: n + 1] |= first
    for at in np.flatnonzero((points == 39) & np.r_[True, (kind[:-1] != _OTHER) & (points[:-1] != 32)] | (points == 39) & first[:-1]).tolist():
        for tail in _CONTRACTIONS:
            to = at + 1 + len(tail)
            if to <= n and points[at + 1 : to].tolist() == [*map(ord, tail)] and not first[at + 1 : to].any():
                begins[at + 1 : to] = False
                begins[to] = True
                break
    return np.flatnonzero(begins[:n])


class Codec:
    """Encodes and decodes as the vocabulary file at ``path`` says. ``codec`` keeps one in each worker process."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols, vocab = byte_symbols(), spec["model"]["vocab"]
        as_bytes = lambda token: bytes(symbols[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        token: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for content, i in vocab.items():
            token[i] = as_bytes(content)
        for content, i in self.special.items():
            token[i] = content.encode()
        self.token, self.decimal = _Strings(token), _Strings([b"%d," % i for i in range(len(token))])
        self.byte = np.zeros(256, np.int32)
        for c, b in symbols.items():
            self.byte[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right, self.merged = (np.array(x, np.int32) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs), strict=True))
        self._place(left.astype(np.int64) << 32 | right)
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = Table(self._of_words)

    def _place(self, keys: np.ndarray) -> None:
        """Puts each pair's rank in one of a few neighbouring slots of an open table, so that ranks are looked up for whole arrays."""
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.slots, self.deep = np.uint64(64 - bits), np.full((1 << bits) + 64, -1, np.int64), 1
        self.ranks = np.full(len(self.slots), _NONE, np.int32)
        todo = np.arange(len(keys))
        for step in range(64):
            if not len(todo):
                break
            self.deep, at = step + 1, self._slot(keys[todo]) + step
            free = self.slots[at] == -1
            _, one = np.unique(at[free], return_index=True)
            self.slots[at[free][one]], self.ranks[at[free][one]] = keys[todo[free][one]], todo[free][one]
            todo = np.setdiff1d(todo, todo[free][one], assume_unique=True)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each merge, or what is above all ranks; parts below 0 are no parts."""
        key = left.astype(np.int64) << 32 | right
        at = self._slot(key)
        out = np.where(self.slots[at] == key, self.ranks[at], _NONE)
        for step in range(1, self.deep):
            on = self.slots[at + step] == key
            if on.any():
                out[on] = self.ranks[at[on] + step]
        out[(left < 0) | (right < 0)] = _NONE
        return out

    def _together(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of short words that are about equally long."""
        width = max(map(len, words))
        raw = np.frombuffer(b"".join(w.ljust(width + 2, b"\0") for w in words), np.uint8).reshape(len(words), width + 2)
        size = np.fromiter(map(len, words), np.int64, len(words))
        parts = np.where(np.arange(width + 2) < size[:, None], self.byte[raw], -1).astype(np.int32)
        ranks = np.full(parts.shape, _NONE, np.int32)
        ranks[:, :-1] = self._ranks(parts[:, :-1], parts[:, 1:])
        live, column, out = np.arange(len(words)), np.arange(width + 2), [np.empty(0, np.int32)] * len(words)
        while len(live):
            row = np.arange(len(live))
            at = ranks.argmin(axis=1)
            best = ranks[row, at]
            over = best == _NONE
            if over.any():
                for i, p in zip(live[over].tolist(), parts[over], strict=True):
                    out[i] = p[p >= 0]
                live, parts, ranks, at, best = live[~over], parts[~over], ranks[~over], at[~over], best[~over]
                if not len(live):
                    break
                row = np.arange(len(live))
            parts[row, at] = self.merged[best]
            shift = np.minimum(column + (column > at[:, None]), width + 1)
            parts, ranks = np.take_along_axis(parts, shift, 1), np.take_along_axis(ranks, shift, 1)
            ranks[row, at] = self._ranks(parts[row, at], parts[row, at + 1])
            before = at > 0
            r, a = row[before], at[before]
            ranks[r, a - 1] = self._ranks(parts[r, a - 1], parts[r, a])
        return out

    def _rank(self, left: int, right: int) -> int | None:
        key = left << 32 | right
        at = (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> int(self.shift)
        for i in range(at, at + self.deep):
            if self.slots[i] == key:
                return int(self.ranks[i])
        return None

    def _long(self, word: bytes) -> np.ndarray:
        """Ids of a long word: a heap of candidate merges over linked parts, so the time stays near linear."""
        whole = self.byte[np.frombuffer(word, np.uint8)]
        ranks, part, n = self._ranks(whole[:-1], whole[1:]).tolist(), whole.tolist(), len(whole)
        after, before, dead = [*range(1, n), -1], [-1, *range(n - 1)], [False] * n
        get = self._rank
        heap = [(r, i, part[i], part[i + 1]) for i, r in enumerate(ranks) if r != _NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if dead[i] or j < 0 or part[i] != a or part[j] != b:
                continue
            part[i], dead[j], after[i] = int(self.merged[r]), True, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := get(part[x], part[y])) is not None:
                    heapq.heappush(heap, (r, x, part[x], part[y]))
        return np.array([p for p, d in zip(part, dead, strict=True) if not d], "<i4")

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words that the pattern has cut."""
        out: list = [None] * len(words)
        by_size = sorted(range(len(words)), key=lambda i: len(words[i]))
        short = [i for i in by_size if len(words[i]) <= _SHORT]
        for at in range(0, len(short), _ROWS):
            some = short[at : at + _ROWS]
            for i, ids in zip(some, self._together([words[i] for i in some]), strict=True):
                out[i] = ids
        for i in by_size[len(short) :]:
            out[i] = self._long(words[i])
        return out

    def _of_words(self, words: list[str]) -> list[np.ndarray]:
        out = self.encode_words([w.encode() for w in words])
        for i, w in enumerate(words):
            if w in self.special:
                out[i] = np.array([self.special[w]], np.int32)
        return out

    def encode_flat(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of UTF-8 texts that lie one after the other in ``data``, and the bounds of each text's.

        Strings of special tokens become those tokens.
        """
        before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
        text = data.tobytes().decode("utf-8", "replace")
        points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
        sides, special = before, ()
        if self.split is not None and self.split.search(text):
            found = [before]
            for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
                found += [np.array([a + x.start(), a + x.end()]) for x in self.split.finditer(text[a:b])]
            sides = np.unique(np.concatenate(found))
            special = zip(sides[:-1].tolist(), sides[1:].tolist(), strict=True)
        starts = cut(points, sides) if len(points) else np.zeros(0, np.int64)
        for a, b in special:
            if text[a:b] in self.special:
                starts = np.concatenate([starts[: np.searchsorted(starts, a) + 1], starts[np.searchsorted(starts, b) :]])
        ends = np.append(starts[1:], len(points)) if len(starts) else starts
        ids, sizes = self.words.over(named(points, starts, ends), lambda some: [text[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist(), strict=True)])
        return ids, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[np.searchsorted(starts, before)]

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """Each text's ids, as little-endian unsigned 32-bit integers and as decimals joined by commas. None is an empty text."""
        ids, bounds = self.encode_flat(*flat(pa.array(texts, pa.string())))
        return list(zip(([ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]), self.decimals(ids, bounds), strict=True))

    def decimals(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The ids of each text as decimals joined by commas."""
        return [x[:-1] for x in self.decimal.joined(ids, bounds)]

    def decode(self, ids: bytes) -> str:
        """The text of little-endian unsigned 32-bit ids; bytes that are no UTF-8 become replacement characters."""
        return self.decode_flat(np.frombuffer(ids, "<u4"), np.array([0, len(ids) // 4]))[0].decode()

    def decode_flat(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The UTF-8 of each text whose ids lie within ``bounds``; bytes that are no UTF-8 become replacement characters."""
        return [x.decode("utf-8", "replace").encode() for x in self.token.joined(ids, bounds)]


class _Strings:
    """Byte strings by number."""

    def __init__(self, some: list[bytes]):
        self.flat, self.size = np.frombuffer(b"".join(some), np.uint8), np.fromiter(map(len, some), np.int64, len(some))
        self.at = np.cumsum(self.size) - self.size

    def joined(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The strings of the numbers between each two bounds, joined."""
        size = self.size[ids]
        text = gathered(self.flat, self.at[ids], size).tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[bounds].tolist()
        return [text[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


@functools.lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    """The codec of a worker process, with what it has cached."""
    return Codec(path)


def _over(docs: DataFrame, text_col: str, kinds: str, make) -> DataFrame:
    """``docs`` with the columns that ``make`` gives for a list of texts; columns of those names are replaced."""
    names = [k.split()[0] for k in kinds.split(",")]
    kept = docs.select(*[c for c in docs.columns if c not in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for batch in slices(batches, "__wl_text"):
            made = call(batch.column("__wl_text"))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*batch.schema.names[:-1], *names])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields), kinds])
    return kept.withColumn("__wl_text", docs[text_col]).mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids``, a binary of little-endian unsigned 32-bit ids, for each row; null and empty texts have no ids."""

    def make():
        made = codec(path)

        def call(texts):
            ids, bounds = made.encode_flat(*flat(texts))
            return pa.array(np.diff(bounds), pa.int64()), pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())

        return call

    return _over(docs, text_col, "n_tokens long, ids binary", make)


def decode(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of ``ids``; null ids give null."""

    def make():
        made = codec(path)
        return lambda ids: [pa.array([None if i is None else made.decode(i) for i in ids.to_pylist()], pa.string())]

    return _over(rows, ids_col, "decoded string", make)


def digest(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for each row: encoded, and decoded from the ids, in one pass."""

    def make():
        made = codec(path)
        digests = lambda some: pa.array([hashlib.sha256(x).hexdigest() for x in some], pa.string())

        def call(texts):
            ids, bounds = made.encode_flat(*flat(texts))
            return pa.array(np.diff(bounds), pa.int64()), digests(made.decimals(ids, bounds)), digests(made.decode_flat(ids, bounds))

        return call

    return _over(docs.select("doc_id", "text"), "text", "n_tokens long, ids_sha256 string, decoded_sha256 string", make).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
