"""Bytes-level helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Lower-cases A-Z, keeps 0-9, a-z and all non-ASCII bytes, and blanks the rest.
WORD_TABLE = bytes((i + 32) if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))
#: Lower-cases A-Z and blanks tab to carriage return.
SHINGLE_TABLE = bytes((i + 32) if 65 <= i <= 90 else 32 if 9 <= i <= 13 else i for i in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased. None has no words."""
    return text.translate(WORD_TABLE).split() if text else []


def blobs(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` has about ``limit`` bytes in each, one row at least."""
    for batch in batches:
        at = 0
        if not batch.num_rows:
            continue
        text = batch.column(column)
        sizes = np.nan_to_num(np.asarray(pc.binary_length(text).to_numpy(zero_copy_only=False), dtype=float))
        ends = np.cumsum(sizes)
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0.0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``keys``; what a table ends with is carried on."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        change[0] = last is not None and last != tuple(c[0] for c in columns)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = np.flatnonzero(change)
        last = tuple(c[-1] for c in columns)
        if len(cuts):
            held.append(batch.slice(0, cuts[-1]))
            if sum(x.num_rows for x in held):
                yield pa.Table.from_batches([x for x in held if x.num_rows])
            held = [batch.slice(cuts[-1])]
        else:
            held.append(batch)
    if sum(x.num_rows for x in held):
        yield pa.Table.from_batches(held)


_SEED = np.random.default_rng(20240229)
#: A random value for each byte, and the powers of a random odd number, low and high, that give any power as a product of two.
_OF_BYTE = _SEED.integers(0, 1 << 64, 256, np.uint64)
BASE = int(_SEED.integers(0, 1 << 63)) << 1 | 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, one text after the other, and the bounds of each; nulls are empty."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    _, ends, data = column.buffers()
    bounds = np.frombuffer(ends, "<i8" if large else "<i4")[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def powers(base: int, n: int) -> np.ndarray:
    """The powers 0 to ``n - 1`` of ``base``, modulo 2**64."""
    low = np.full(1024, base, np.uint64)
    low[0] = 1
    np.cumprod(low, out=low)
    high = np.full(-(-n // 1024), pow(base, 1024, 1 << 64), np.uint64)
    high[:1] = 1
    np.cumprod(high, out=high)
    return np.multiply.outer(high, low).ravel()[:n]


def named(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit names of the stretches of ``values``: sums of a random value a byte times a power for its place, from running totals."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((_OF_BYTE[values] if values.dtype == np.uint8 else scattered(values)) * powers(BASE, len(values)), out=total[1:])
    h = (total[ends] - total[starts]) * powers(pow(BASE, -1, 1 << 64), len(values) + 1)[starts]
    h ^= (ends - starts).astype(np.uint64) * _MIX
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def scattered(values: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number."""
    h = (values.astype(np.uint64) + np.uint64(1)) * _MIX
    h ^= h >> np.uint64(31)
    return h * np.uint64(0x94D049BB133111EB)


def gathered(flat_: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``flat_`` from each ``at`` over each ``size``, one after the other."""
    size = size.astype(np.int64)
    ends = np.cumsum(size)
    index = np.arange(ends[-1] if len(ends) else 0)
    index += np.repeat(at - (ends - size), size)
    return flat_[index]


class Table:
    """Sequences of numbers by 64-bit name, in arrays of about ``limit`` bytes; those used longest ago go first.

    ``make`` gives the sequences of some keys. What one call asks for is held
    beside the limit until the next call.
    """

    def __init__(self, make, limit: int = 24 << 20):
        self.make, self.limit, self.clock = make, limit, 0
        self.names, self.at, self.size, self.used = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def _bytes(self) -> int:
        return self.flat.nbytes + 24 * len(self.names)

    def _forget(self) -> None:
        """Keeps what was used last, up to half of the limit."""
        order = np.argsort(-self.used, kind="stable")
        keep = np.sort(order[np.cumsum(4 * self.size[order].astype(np.int64) + 24) <= self.limit // 2])
        self.flat = gathered(self.flat, self.at[keep], self.size[keep])
        self.names, self.size, self.used = self.names[keep], self.size[keep], self.used[keep]
        self.at = np.cumsum(self.size, dtype=np.int64) - self.size

    def of(self, names: np.ndarray, keys) -> tuple[np.ndarray, np.ndarray]:
        """Where the sequences of distinct ``names`` begin in ``flat``, and how long they are; ``keys`` gives what is missing at some places of ``names``."""
        self.clock += 1
        if self._bytes() > self.limit:
            self._forget()
        where = np.minimum(np.searchsorted(self.names, names), max(0, len(self.names) - 1))
        missing = np.flatnonzero(self.names[where] != names) if len(self.names) else np.arange(len(names))
        if len(missing):
            made = self.make(keys(missing))
            size = np.fromiter(map(len, made), np.int32, len(made))
            at = len(self.flat) + np.cumsum(size, dtype=np.int64) - size
            self.flat = np.concatenate([self.flat, *made]).astype(np.uint32, copy=False)
            order = np.argsort(names[missing], kind="stable")
            place = np.searchsorted(self.names, names[missing][order])
            self.names = np.insert(self.names, place, names[missing][order])
            self.at, self.size = np.insert(self.at, place, at[order]), np.insert(self.size, place, size[order])
            self.used = np.insert(self.used, place, self.clock)
            where = np.searchsorted(self.names, names)
        self.used[where] = self.clock
        return self.at[where], self.size[where]

    def over(self, names: np.ndarray, keys) -> tuple[np.ndarray, np.ndarray]:
        """The sequences of ``names``, which may repeat, one after the other, and how long each is; ``keys`` gives what is missing at some places of ``names``."""
        if not len(names):
            return np.zeros(0, np.uint32), np.zeros(0, np.int32)
        coded = pc.dictionary_encode(pa.array(names))
        which = coded.indices.to_numpy()
        first = np.empty(len(coded.dictionary), np.int64)
        first[which[::-1]] = np.arange(len(names) - 1, -1, -1)
        at, size = self.of(coded.dictionary.to_numpy(), lambda missing: keys(first[missing]))
        return gathered(self.flat, at[which], size[which]), size[which]
