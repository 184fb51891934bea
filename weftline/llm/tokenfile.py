"""Token files of directly addressable codes.

The ids of many documents lie one after the other. Each id is cut into chunks
of eight bits. Level 0 has the lowest chunk of every id and a bitmap that says
which ids go on; level 1 has the next chunk of those, and so on. A directory of
the ones before each 512 bits turns a place at one level into the place at the
next, so any token, or run of tokens, is read without decoding what lies around
it. A file has its documents' ids and starts, so it stands alone.
"""

from __future__ import annotations

import bisect
import functools
import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import width, written
from .text import Table, flat, named, slices

#: Tokens after which a file ends with the document that passes them.
FILE_TOKENS = 1 << 20
#: Ranges of ids for each shuffle partition, rows sampled for each range, and rows sampled at most.
_RANGES, _SAMPLED, _MOST = 4, 20, 1_000_000
_MAGIC, _BLOCK = b"WLDAC01\n", 512
_LOWER = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], np.uint8)
#: 0 white space, 1 letters, 2 digits, 3 punctuation; 4 is all that a cut may not touch.
_CLASS = np.array([0 if i in b"\t\n\v\f\r " else 4 if i >= 127 or i < 32 or chr(i) == "'" else 1 if chr(i).isalpha() else 2 if chr(i).isdigit() else 3 for i in range(256)], np.uint8)
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def pack(ids: np.ndarray, starts: np.ndarray, names: list[int | None]) -> bytes:
    """A file of the ids, unsigned and below 2**32, of documents that begin at ``starts``, which ends with the number of ids."""
    out = [_MAGIC, struct.pack("<QQ", len(names), len(ids)), np.asarray(starts, "<u8").tobytes()]
    out += [np.array([n or 0 for n in names], "<i8").tobytes(), np.packbits([n is None for n in names], bitorder="little").tobytes()]
    rest, levels = np.asarray(ids, np.uint32), []
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        blocks = np.add.reduceat(_ONES[bits], np.arange(0, len(bits), _BLOCK // 8), dtype=np.int64) if len(bits) else np.empty(0, np.int64)
        levels.append(struct.pack("<Q", len(rest)) + (rest & 255).astype(np.uint8).tobytes() + bits.tobytes() + np.concatenate([[0], np.cumsum(blocks)]).astype("<u8").tobytes())
        rest = rest[more] >> 8
        if not len(rest):
            break
    return b"".join([*out, struct.pack("<B", len(levels)), *levels])


class TokenFile:
    """Reads a file from bytes or from a memory map."""

    def __init__(self, data):
        view = memoryview(data)
        if bytes(view[:8]) != _MAGIC:
            raise ValueError("not a token file")
        self.n_docs, self.n_tokens = struct.unpack_from("<QQ", view, 8)
        at = 24

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(view, kind, n, at)
            at += got.nbytes
            return got

        self.starts, names = take("<u8", self.n_docs + 1), take("<i8", self.n_docs)
        none = np.unpackbits(take("u1", -(-self.n_docs // 8)), bitorder="little")
        self.names = [None if x else int(n) for n, x in zip(names, none, strict=False)]
        self.levels = []
        for _ in range(take("u1", 1)[0]):
            n = int(take("<u8", 1)[0])
            chunks, bits = take("u1", n), take("u1", -(-n // 8))
            self.levels.append((chunks, bits, take("<u8", -(-n // _BLOCK) + 1)))

    @staticmethod
    def _rank(level, i: int) -> int:
        """Ones before bit ``i``."""
        _, bits, directory = level
        block = i // _BLOCK
        a = block * _BLOCK // 8
        n = int(directory[block]) + int(_ONES[bits[a : i // 8]].sum())
        return n + (int(_ONES[bits[i // 8] & ((1 << i % 8) - 1)]) if i % 8 else 0)

    def token(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = shift = 0
        for level in self.levels:
            value |= int(level[0][i]) << shift
            if not level[1][i // 8] >> (i % 8) & 1:
                break
            i, shift = self._rank(level, i), shift + 8
        return value

    def tokens(self, a: int, b: int) -> np.ndarray:
        """The ids from place ``a`` to before ``b``."""
        out, where, shift = np.zeros(b - a, np.uint32), np.arange(b - a), 0
        for level in self.levels:
            if a == b:
                break
            out[where] |= level[0][a:b].astype(np.uint32) << np.uint32(shift)
            more = np.unpackbits(level[1][a // 8 : -(-b // 8)], bitorder="little")[a % 8 :][: b - a].astype(bool)
            where, shift = where[more], shift + 8
            a = self._rank(level, a)
            b = a + len(where)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.tokens(int(self.starts[k]), int(self.starts[k + 1]))


class Encoder:
    """Ids of whole texts from a tokenizer that never joins across white space and ignores case, with the ids of words cached.

    Texts are cut at ASCII white space, between ASCII letters, digits and
    punctuation but for apostrophes, and between ASCII digits, as the tokenizer
    itself would; A-Z are lower-cased. A text that may hold a special token is
    cut at white space alone, and lower-cased by the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words = Table(self._library)

    def _library(self, some: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]

    def encode_flat(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that lie one after the other in ``data``, and the bounds of each text's."""
        lowered, plain = _LOWER[data], np.ones(len(data), bool)
        if b"<|" in data.tobytes():
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if b"<|" in data[a:b].tobytes():
                    lowered[a:b], plain[a:b] = data[a:b], False
        kind = _CLASS[data]
        full = kind != 0
        begins, ends = full.copy(), full.copy()
        inner = full[1:] & full[:-1] & ~((kind[1:] != kind[:-1]) & (kind[1:] < 4) & (kind[:-1] < 4) & plain[1:] | (kind[1:] == 2) & (kind[:-1] == 2) & plain[1:])
        begins[1:] &= ~inner
        ends[:-1] &= ~inner
        sides = bounds[:-1][bounds[:-1] < bounds[1:]]
        begins[sides] = full[sides]
        ends[sides[1:] - 1] = full[sides[1:] - 1]
        starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        text = lowered.tobytes()
        ids, sizes = self.words.over(named(lowered, starts, stops), lambda some: [text[a:b].decode("utf-8", "replace") for a, b in zip(starts[some].tolist(), stops[some].tolist(), strict=True)])
        return ids, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[np.searchsorted(starts, bounds)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers. None is an empty text."""
        ids, bounds = self.encode_flat(*flat(pa.array(texts, pa.string())))
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of a worker process, with what it has cached."""
    return Encoder(path)


def _edges(rows: DataFrame, parts: int) -> list[tuple]:
    """At most ``parts - 1`` keys ``(not null, id, tie)`` that cut the rows into ranges of about the same size, from a sample by hash of some rows a part."""
    every = max(1, rows.count() // (parts * _SAMPLED))
    chosen = rows.filter(F.pmod(F.xxhash64("id", "tie"), F.lit(every)) == 0).select("id", "tie").limit(_MOST)
    keys = sorted(_key(r["id"], r["tie"]) for r in chosen.collect())
    return sorted({keys[i * len(keys) // parts] for i in range(1, parts)}) if keys else []


def _key(name: int | None, tie: int) -> tuple:
    return name is not None, name or 0, tie


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str) -> DataFrame:
    """``(part, id, tie, ids)`` of each row: its range of ids, its id, a hash of its text, its token ids, in two bytes each if all of the vocabulary fit and else in four."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    edges = docs.sparkSession.sparkContext.broadcast(_edges(rows, width(docs.sparkSession) * _RANGES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, cuts = encoder(path), edges.value
        kind = _kind(made.tokenizer.get_vocab_size())
        for batch in slices(batches, "text"):
            ids, bounds = made.encode_flat(*flat(batch.column("text")))
            parts = [bisect.bisect_right(cuts, _key(*k)) for k in zip(batch.column("id").to_pylist(), batch.column("tie").to_pylist(), strict=True)]
            column = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((bounds * np.dtype(kind).itemsize).astype("<i4").tobytes()), pa.py_buffer(ids.astype(kind).tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), batch.column("id"), batch.column("tie"), column], ["part", "id", "tie", "ids"])

    return rows.mapInArrow(run, "part int, id long, tie long, ids binary")


def _kind(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def write_tokens(docs: DataFrame, path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token files of ``docs`` in ascending order of id, nulls first and equal ids by a hash of the text, as ``(part, seq, n_tokens, file)``.

    Ids are cast to long. Each document ends with ``end_id``; null and empty
    texts have it alone. Repeated rows are repeated in the files, and an empty
    table has none. The order of ``(part, seq)`` is the order of the files. They
    are written in the shared folder, a file of the format in each row. Texts
    are encoded where they are read; only ids move.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, part = None, None
        names, held, sizes, seq, total = [], [], [], 0, 0

        def file() -> pa.RecordBatch:
            data = pack(np.concatenate(held), np.concatenate([[0], np.cumsum(sizes)]), names)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([total], pa.int64()), pa.array([data], pa.binary())], ["part", "seq", "n_tokens", "file"])

        for batch in batches:
            kind = kind or _kind(encoder(path).tokenizer.get_vocab_size())
            for own, name, ids in zip(*(batch.column(c).to_pylist() for c in ("part", "id", "ids")), strict=True):
                if names and (total >= FILE_TOKENS or own != part):
                    yield file()
                    names, held, sizes, seq, total = [], [], [], seq + 1, 0
                seq, part = (seq if own == part else 0), own
                ids = np.frombuffer(ids, kind)
                names.append(name)
                held += [ids.astype(np.uint32), np.array([end_id], np.uint32)]
                sizes.append(len(ids) + 1)
                total += len(ids) + 1
        if names:
            yield file()

    dealt = _encoded(docs, path, id_col, text_col).repartition(width(docs.sparkSession), "part").sortWithinPartitions("part", "id", "tie")
    return written(dealt.select("part", "id", "ids").mapInArrow(run, "part int, seq int, n_tokens long, file binary"), "tokens")


def bases(files: DataFrame) -> DataFrame:
    """``(part, seq, base)``: the ids in all files before each; sums over parts first, so only one row a part meets in one task."""
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    own = Window.partitionBy("part").orderBy("seq")
    inside = files.select("part", "seq", (F.sum("n_tokens").over(own) - F.col("n_tokens")).alias("inside"))
    return inside.join(before, "part").select("part", "seq", (F.col("before") + F.col("inside")).alias("base"))


def read_documents(files: DataFrame) -> DataFrame:
    """``(part, seq, id, start, n_tokens, ids)`` of each document of the files; ``start`` counts from the file's first id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, data in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "file")), strict=True):
                file = TokenFile(data)
                n = file.n_docs
                starts = file.starts.astype(np.int64)
                ids = file.tokens(0, file.n_tokens).astype("<u4").tobytes()
                column = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((starts * 4).astype("<i4").tobytes()), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), pa.array(file.names, pa.int64()), pa.array(starts[:-1]), pa.array(np.diff(starts)), column], ["part", "seq", "id", "start", "n_tokens", "ids"])

    return files.select("part", "seq", "file").mapInArrow(run, "part int, seq int, id long, start long, n_tokens long, ids binary")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files."""
    files = write_tokens(docs.select("doc_id", "text"), path)
    read = read_documents(files).select("part", "seq", "id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return read.join(bases(files), ["part", "seq"]).select(F.col("id").alias("doc_id"), (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
