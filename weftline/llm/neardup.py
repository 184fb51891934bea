"""Near-duplicates by the Jaccard similarity of word shingles: SimHash by pigeonring, then prefix filtering for the rest.

SimHash fingerprints of the sets of shingles are linked by the chains of
``simhash``, and what they link is checked on the whole sets. Fingerprints of
near sets may differ in more bits than chains can look for, so links between
what is not joined by then are found by prefixes, and checked alike. If two sets have a Jaccard similarity of ``t`` or more, their first
``n - ceil(t * n) + 1`` shingles in any one order share a shingle; the order is
by hash, with shingles known to be common last. Documents that meet in such a
shingle are pruned by their sizes and by the places of the shingle in both,
then by sketches: a bit for each class of hashes, set where a set has an odd
number of them. A shingle that only one of two sets has changes one bit, so
sketches differ in no more bits than the sets in shingles. Only what is left is
read again and checked on the whole sets. No step estimates, so no pair is
missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import scratch, width, written
from . import simhash
from .linededup import bits_of, maybe
from .text import SHINGLE_TABLE, blobs, slices, whole_groups

#: Words of a shingle, and the similarity in hundredths from which documents are near-duplicates.
SIZE, LEAST = 5, 80
_PAIRWISE, _BLOCK, _CLASSES = 24, 1024, 64
#: Documents that common shingles are learnt from, how many of them have one, and how many of these are broadcast at most. They only order shingles.
_SAMPLE, _COMMON, _MOST = 8_000, 3, 1 << 16


def shingles(text: bytes | None, size: int = SIZE) -> np.ndarray:
    """The sorted distinct hashes of a text's ``size``-word shingles; a shorter text is one shingle, and one without words has none."""
    found = text.translate(SHINGLE_TABLE).split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    line, one = b" ".join(found), xxhash.xxh3_64_intdigest
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = [0, *ends[:-size].tolist()]
    ends = (ends[size - 1 :] - 1).tolist() if len(found) > size else [len(line)]
    return np.unique(np.fromiter((one(line[a:b]) for a, b in zip(starts, ends, strict=True)), np.uint64, len(ends)))


def _overlap(n: np.ndarray, m: np.ndarray, least: int) -> np.ndarray:
    """The shingles that sets of these sizes share if they are near-duplicates."""
    return -(-least * (n.astype(np.int64) + m) // (100 + least))


def _sketch(s: np.ndarray) -> bytes:
    """The odd classes of a set; as many classes as the next power of two from its size, eight at least."""
    n = 1 << max(3, (len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(n - 1)).astype(np.int64), minlength=n).astype(np.uint8) & 1, bitorder="little").tobytes()


def _folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch of ``size`` bytes, a power of two, from a longer one."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint8).reshape(-1, size), axis=0)


def _common(docs: DataFrame, size: int, text_col: str) -> np.ndarray:
    """Sorted hashes of shingles that several documents of a sample have."""
    texts = docs.select(F.col(text_col).cast("binary").alias("text")).filter("text IS NOT NULL").withColumn("p", F.xxhash64("text"))
    every = max(1, -(-docs.count() // _SAMPLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [shingles(t, size) for t in blobs(batch.column("text"))]
            s, c = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.array(c)], ["s", "c"])

    counts = texts.filter(F.pmod("p", F.lit(every)) == 0).dropDuplicates(["p"]).select("text").mapInArrow(run, "s long, c long").groupBy("s").agg(F.sum("c").alias("c"))
    top = counts.filter(F.col("c") >= _COMMON).orderBy(F.desc("c"), "s").limit(_MOST).collect()
    return np.sort(np.array([r["s"] for r in top], np.int64).view(np.uint64))


def _prefixes(docs: DataFrame, common: np.ndarray, size: int, least: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, tie, h, n, fp, sketch, keys)`` for each row: the hash, size, fingerprint and sketch of its set, and the set's prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = shared.value
        for batch in slices(batches, "text"):
            hs, ns, fps, sketches, keys = [], [], [], [], []
            for text in blobs(batch.column("text")):
                s = shingles(text, size)
                hs.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63))
                ns.append(len(s))
                fps.append(simhash.majority((s[at : at + 65536] for at in range(0, len(s), 65536)), len(s)))
                sketches.append(_sketch(s))
                if len(s) and len(last):
                    s = s[np.argsort(last[np.minimum(np.searchsorted(last, s), len(last) - 1)] == s, kind="stable")]
                keys.append(s[: len(s) + 1 + -least * len(s) // 100 if len(s) else 0].view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(k) for k in keys])], pa.int32()), pa.array(np.concatenate(keys)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("tie"), pa.array(hs, pa.int64()), pa.array(ns, pa.int32()), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(sketches, pa.binary()), lists], ["id", "tie", "h", "n", "fp", "sketch", "keys"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "id long, tie long, h long, n int, fp long, sketch binary, keys array<long>")


def _gather(least: int):
    """From rows sorted by key to ``(g, h)``: sets that may be near each other, under the smallest hash of those that meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["key"]):
            key, h, n, at = (table.column(c).to_numpy() for c in ("key", "h", "n", "at"))
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            size = np.repeat(sizes, sizes)
            found: list[np.ndarray] = []
            small = np.flatnonzero((size > 1) & (size <= _PAIRWISE))
            k, hs, ns, places = key[small], h[small], n[small], at[small]
            for d in range(1, min(_PAIRWISE, len(k))):
                i = np.flatnonzero(k[d:] == k[:-d])
                if not len(i):
                    break
                # In the first shingle that two sets share nothing before it counts, so near ones pass there.
                rest = np.minimum(ns[i] - places[i], ns[i + d] - places[i + d])
                i = i[rest >= _overlap(ns[i], ns[i + d], least)]
                g = np.minimum(hs[i], hs[i + d])
                found += [np.stack([g, hs[i]]), np.stack([g, hs[i + d]])]
            for lo, count in zip(starts[sizes > _PAIRWISE], sizes[sizes > _PAIRWISE], strict=True):
                order = lo + np.argsort(n[lo : lo + count], kind="stable")
                m = n[order].astype(np.int64)
                # Sizes too far apart for neighbours in order are so for all across them.
                for part in np.split(order, np.flatnonzero(100 * m[:-1] < least * m[1:]) + 1):
                    if len(part) > 1:
                        found.append(np.stack([np.full(len(part), h[part].min()), h[part]]))
            if found:
                g, h = np.unique(np.concatenate(found, axis=1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(h)], ["g", "h"])

    return run


def _sift(least: int):
    """From rows of ``(g, x, y)`` to ``(g, h)``: what sketches do not hold apart, under the smallest hash of those they join, if it is not all of one class ``c``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(slices(batches, "sketch"), ["g", "x", "y"]):
            g, x, y, b, h, c, n = (table.column(name).to_numpy() for name in ("g", "x", "y", "b", "h", "c", "n"))
            n, sketches = n.astype(np.int64), table.column("sketch").to_pylist()
            cut = [0, *(np.flatnonzero((g[1:] != g[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1).tolist(), len(g)]
            gs, hs = [], []
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                order = lo + np.argsort(n[lo:hi], kind="stable")
                m, blocks = n[order], b[order]
                classes, root = np.unique(c[order], return_inverse=True)
                joined = np.arange(len(classes))
                # Sizes up to what each set can be near to; all are folded to the sketch of the smallest.
                last = np.searchsorted(m, 100 * m // least, side="right")
                size, flat = 0, None
                for i in range(hi - lo - 1):
                    if last[i] <= i + 1:
                        continue
                    if size != len(sketches[order[i]]):
                        size = len(sketches[order[i]])
                        flat = np.stack([_folded(sketches[j], size) for j in order[i : last[min(len(m) - 1, np.searchsorted(m, 8 * size, side="right") - 1)]]])
                        base = i
                    rest = np.flatnonzero(root[i + 1 : last[i]] != root[i]) + i + 1
                    if x[lo] != y[lo]:
                        rest = rest[blocks[rest] != blocks[i]]
                    apart = m[rest] + m[i] - 2 * _overlap(m[rest], m[i : i + 1], least)
                    rest = rest[np.bitwise_count(flat[rest - base] ^ flat[i - base]).sum(1, dtype=np.int64) <= apart]
                    if len(rest):
                        old = np.unique(root[rest])
                        joined[np.isin(joined, old)] = root[i]
                        root[np.isin(root, old)] = root[i]
                for r in np.flatnonzero(np.bincount(joined, minlength=1) > 1):
                    members = h[order[root == r]]
                    gs.append(np.full(len(members), members.min()))
                    hs.append(members)
            if gs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(gs)), pa.array(np.concatenate(hs))], ["g", "h"])

    return run


def _verify(size: int, least: int):
    """Links within each group, as few as join what is near each other and of different classes ``c``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(slices(batches, "text"), ["g", "x", "y"]):
            g, x, y, b, h, c = (table.column(name).to_numpy() for name in ("g", "x", "y", "b", "h", "c"))
            texts = table.column("text")
            cut = [0, *(np.flatnonzero((g[1:] != g[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1).tolist(), len(g)]
            us, vs = [], []
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                sets = [shingles(t, size) for t in texts.slice(lo, hi - lo).to_pylist()]
                n = np.array([len(s) for s in sets], np.int64)
                classes = np.stack([np.bincount((s % np.uint64(_CLASSES)).astype(np.int64), minlength=_CLASSES) for s in sets]).astype(np.int32)
                root = np.unique(c[lo:hi], return_inverse=True)[1]
                for i in range(hi - lo - 1):
                    rest = np.flatnonzero(root[i + 1 :] != root[i]) + i + 1
                    if x[lo] != y[lo]:
                        rest = rest[b[lo + rest] != b[lo + i]]
                    rest = rest[100 * np.minimum(n[rest], n[i]) >= least * np.maximum(n[rest], n[i])]
                    # Each shingle in one set alone is a difference of one in its class.
                    apart = n[rest] + n[i] - 2 * _overlap(n[rest], n[i : i + 1], least)
                    rest = rest[np.abs(classes[rest] - classes[i]).sum(1) <= apart]
                    for j in rest.tolist():
                        if root[i] != root[j]:
                            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                            if 100 * shared >= least * (n[i] + n[j] - shared):
                                root[root == root[j]] = root[i]
                                us.append(h[lo + i])
                                vs.append(h[lo + j])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return run


def _texts(docs: DataFrame, rows: DataFrame, wanted: DataFrame, text_col: str) -> DataFrame:
    """``(h, text)`` of the wanted ``h``, one text of each, read from ``docs`` again."""
    ties = written(rows.join(wanted, "h", "left_semi").groupBy("h").agg(F.min("tie").alias("tie")), "near-ties")
    bits = docs.sparkSession.sparkContext.broadcast(bits_of(ties, "tie"))

    @F.pandas_udf("boolean")
    def held(tie: pd.Series) -> pd.Series:
        return pd.Series(maybe(bits.value, tie.to_numpy()))

    texts = docs.select(F.xxhash64(text_col).alias("tie"), F.col(text_col).cast("binary").alias("text")).filter(held("tie"))
    return texts.join(ties, "tie").dropDuplicates(["h"]).select("h", "text")


def _dealt(met: DataFrame, rows: DataFrame, label: str) -> DataFrame:
    """The columns of ``rows`` for each ``(g, h)``, sorted by ``(g, x, y)``: large sets are dealt out as pairs of blocks."""
    # Written, so that both sides of the next join are plain scans and Spark can split a large set.
    blocks = written(met.groupBy("g").count().select("g", F.ceil(F.col("count") / _BLOCK).cast("int").alias("k")), label)
    blocked = met.join(blocks, "g").withColumn("b", F.pmod(F.xxhash64("h"), F.col("k")).cast("int"))
    blocked = blocked.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select("g", F.least("b", "o").alias("x"), F.greatest("b", "o").alias("y"), "b", "h")
    return blocked.join(rows, "h").repartition(width(met.sparkSession), "g", "x", "y").sortWithinPartitions("g", "x", "y", "h")


def _checked(docs: DataFrame, rows: DataFrame, met: DataFrame, joined: DataFrame | None, size: int, least: int, text_col: str) -> DataFrame:
    """``(u, v)``: links within the sets ``(g, h)`` that join all near ones there which are not ``joined`` (``node, component``) yet."""
    named = F.col("h").alias("c") if joined is None else F.coalesce("component", "h").alias("c")
    in_class = lambda df: df.select("*", named) if joined is None else df.join(joined.withColumnRenamed("node", "h"), "h", "left").select(*df.columns, named)
    sketches = rows.join(met.select("h").distinct(), "h", "left_semi").groupBy("h").agg(F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"))
    placed = _dealt(met, written(in_class(sketches), "near-sketches"), "near-blocks").select("g", "x", "y", "b", "h", "c", "n", "sketch")
    sets = written(placed.mapInArrow(_sift(least), "g long, h long").distinct(), "near-sets")
    texts = written(in_class(_texts(docs, rows.select("h", "tie"), sets.select("h").distinct(), text_col)), "near-texts")
    placed = _dealt(sets, texts, "near-blocks").select("g", "x", "y", "b", "h", "c", "text")
    return placed.mapInArrow(_verify(size, least), "u long, v long")


def links(docs: DataFrame, rows: DataFrame, size: int = SIZE, least: int = LEAST, text_col: str = "text") -> DataFrame:
    """``(u, v)``: links between hashes of distinct sets that join exactly what all pairs of near ones join."""
    distinct = rows.filter("n > 0").groupBy("h").agg(F.any_value("fp").alias("fp"))
    distinct = written(distinct, "near-prints")
    rings = connected_components(simhash.links(distinct.select("fp").distinct()))
    alike = distinct.join(rings.withColumnRenamed("node", "fp"), "fp", "left").select(F.coalesce("component", "fp").alias("g"), "h")
    alike = written(alike.join(alike.groupBy("g").count().filter("count > 1").select("g"), "g", "left_semi"), "near-alike")
    first = written(_checked(docs, rows, alike, None, size, least, text_col), "near-first")
    joined = connected_components(first)
    sets = rows.filter("n > 0").groupBy("h").agg(F.any_value("n").alias("n"), F.any_value("keys").alias("keys"))
    dealt = sets.select("h", "n", F.posexplode("keys").alias("at", "key")).repartition(width(docs.sparkSession), "key").sortWithinPartitions("key")
    met = written(dealt.select("key", "h", "n", "at").mapInArrow(_gather(least), "g long, h long").distinct(), "near-met")
    return first.unionByName(_checked(docs, rows, met, joined, size, least, text_col))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, least: int = LEAST) -> DataFrame:
    """``(id, tie, root)`` for each row of ``docs``; rows of a component of near-duplicates have the same ``root``.

    Sets are named by 64 bits of hash. Texts without words are duplicates of each other.
    """
    rows = written(_prefixes(docs, _common(docs, size, text_col), size, least, id_col, text_col), "near-prefixes")
    found = connected_components(links(docs, rows, size, least, text_col))
    return rows.select("id", "tie", "h").join(found.withColumnRenamed("node", "h"), "h", "left").select("id", "tie", F.coalesce("component", "h").alias("root"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id (nulls last), then the smallest text hash; one of identical rows."""
    spark = docs.sparkSession
    with scratch(spark):
        found = written(near_duplicates(docs, id_col, text_col, size, least), "near-roots")
        best = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tie")).alias("b"), F.count("*").alias("n")).filter("n > 1")
        first = F.col("id").eqNullSafe(F.col("b.id")) & (F.col("tie") == F.col("b.tie"))
        shared = found.join(best, "root").select("id", "tie", first.alias("first")).distinct()
        shared = written(shared, "near-shared", keep=True)
        bits = spark.sparkContext.broadcast(bits_of(shared, "tie"))

    @F.pandas_udf("boolean")
    def sharing(tie: pd.Series) -> pd.Series:
        return pd.Series(maybe(bits.value, tie.to_numpy()))

    # Only rows that may share a root are moved; those that surely have their own stay where they are.
    tied = docs.withColumn("__wl_tie", F.xxhash64(text_col))
    maybe_shared = sharing("__wl_tie")
    named = shared.select(F.col("id").alias("__wl_id"), F.col("tie").alias("__wl_t"), F.col("first").alias("__wl_first"))
    moved = tied.filter(maybe_shared).join(named, (F.col("__wl_tie") == F.col("__wl_t")) & F.col(id_col).cast("long").eqNullSafe(F.col("__wl_id")), "left")
    moved = moved.filter(F.coalesce("__wl_first", F.lit(True))).dropDuplicates([id_col, "__wl_tie"])
    return tied.filter(~maybe_shared).select(*docs.columns).unionByName(moved.select(*docs.columns))
