"""SimHash near-duplicates by pigeonring filtering.

A fingerprint's 64 bits form a ring of four segments. If two fingerprints
differ in at most ``t`` bits, some segment starts a chain whose first ``k``
segments differ in at most ``floor(k * t / 4)`` bits together, for each
``k`` of 1 to 4. With ``t = 3`` the chain's first segment is equal and its
second differs in at most one bit, so both segments together, with one bit of
the second flipped up or not, are an exact join key; the rest of the chain and
then the whole distance are checked where the rows of a key meet.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import width, written
from .text import SHINGLE_TABLE, blobs, slices, whole_groups

BITS, SEGMENTS, MAX_DISTANCE = 64, 4, 3
_PAIRWISE = 24


def majority(parts: Iterable[np.ndarray], n: int) -> int:
    """The bits that are set in more than half of ``n`` hashes, given in parts."""
    counts = np.zeros(BITS, np.int64)
    for hashes in parts:
        counts += np.unpackbits(hashes.astype(">u8", copy=False).view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprint(text: bytes | None, size: int = 3) -> int:
    """The SimHash of a text's ``size``-word shingles, repeats included; 0 without words.

    A bit is 1 if it is set in more than half of the shingles' XXH64 hashes.
    """
    found = text.translate(SHINGLE_TABLE).split() if text else []
    if not found:
        return 0
    if len(found) <= size:
        return xxhash.xxh64_intdigest(b" ".join(found), 42)
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = [0, *ends[:-size].tolist()]
    one = xxhash.xxh64_intdigest
    n = len(starts)
    ends = (ends[size - 1 :] - 1).tolist()
    return majority((np.fromiter((one(line[a:b], 42) for a, b in zip(starts[at : at + 65536], ends[at : at + 65536], strict=True)), ">u8", min(65536, n - at)) for at in range(0, n, 65536)), n)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(id, tie, fp)`` for each row: its id, a hash of its text, its fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fps = np.fromiter((fingerprint(t, size) for t in blobs(batch.column("text"))), np.uint64, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("tie"), pa.array(fps)], ["id", "tie", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "id long, tie long, fp long")


def _rotated(fp: np.ndarray, segment: int) -> np.ndarray:
    shift = np.uint64(16 * segment)
    return fp if not segment else (fp << shift) | (fp >> (np.uint64(64) - shift))


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint's keys: for each start of a chain its first two segments, as they are and with one bit of the second raised."""
    flips = np.uint64(1) << np.arange(16, dtype=np.uint64)
    for batch in batches:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        keys, owners = [], []
        for s in range(SEGMENTS):
            top = _rotated(fp, s) >> np.uint64(32)
            where, bit = np.nonzero((top[:, None] & flips) == 0)
            tag = np.uint64(s << 32)
            keys += [top | tag, (top[where] | flips[bit]) | tag]
            owners += [fp, fp[where]]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners).view(np.int64))], ["key", "fp"])


def _near(a: np.ndarray, b: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Whether the chain from each pair's segment keeps its budgets and the whole distance holds."""
    x = a ^ b
    shift = (segment * np.uint64(16)) & np.uint64(63)
    x = (x << shift) | (x >> ((np.uint64(64) - shift) & np.uint64(63)))
    keep = np.bitwise_count(x >> np.uint64(32)) <= 1
    keep &= np.bitwise_count(x >> np.uint64(16)) <= 2
    return keep & (np.bitwise_count(x) <= MAX_DISTANCE)


def _forest(fp: np.ndarray, exact: np.ndarray, segment: np.uint64) -> list[tuple[int, int]]:
    """Edges that join what is linked in one key's rows, one fewer than each linked set has members."""
    order = np.argsort(~exact, kind="stable")
    fp, hubs = fp[order], int(exact.sum())
    todo, edges = np.arange(len(fp)), []
    while len(todo) and todo[0] < hubs:
        front, todo = todo[:1], todo[1:]
        root = fp[front[0]]
        while len(front) and len(todo):
            reached = np.zeros(len(todo), bool)
            # Two rows meet here only if one of them has the key unflipped.
            step = max(1, (1 << 20) // len(todo))
            for at in range(0, len(front), step):
                part = front[at : at + step]
                near = _near(fp[part][:, None], fp[todo][None, :], segment) & ((part < hubs)[:, None] | (todo < hubs)[None, :])
                reached |= near.any(0)
            edges += [(root, x) for x in fp[todo[reached]]]
            front, todo = todo[reached], todo[~reached]
    return edges


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between rows of a key; large keys give spanning forests, never all pairs."""
    for table in whole_groups(batches, ["key"]):
        key, fp = (table.column(c).to_numpy().view(np.uint64) for c in ("key", "fp"))
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        size = np.repeat(sizes, sizes)
        keep = size > 1
        key, fp, size = key[keep], fp[keep], size[keep]
        segment = key >> np.uint64(32)
        shift = (segment * np.uint64(16)) & np.uint64(63)
        top = ((fp << shift) | (fp >> ((np.uint64(64) - shift) & np.uint64(63)))) >> np.uint64(32)
        exact = top == (key & np.uint64(0xFFFFFFFF))
        us, vs = [], []
        small = np.flatnonzero(size <= _PAIRWISE)
        k, f, e, s = key[small], fp[small], exact[small], segment[small]
        for d in range(1, min(_PAIRWISE, len(k))):
            at = np.flatnonzero((k[d:] == k[:-d]) & (e[d:] | e[:-d]))
            if not len(at) and not (k[d:] == k[:-d]).any():
                break
            at = at[_near(f[at], f[at + d], s[at])]
            us.append(f[at])
            vs.append(f[at + d])
        big = np.flatnonzero(size > _PAIRWISE)
        at = 0
        while at < len(big):
            i, n = big[at], size[big[at]]
            edges = _forest(fp[i : i + n], exact[i : i + n], segment[i])
            us.append(np.array([a for a, _ in edges], np.uint64))
            vs.append(np.array([b for _, b in edges], np.uint64))
            at += n
        if us:
            u, v = np.concatenate(us), np.concatenate(vs)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])


def links(distinct: DataFrame, fp_col: str = "fp") -> DataFrame:
    """Edges ``(u, v)`` between distinct fingerprints that join exactly what links of at most 3 bits join."""
    keys = distinct.select(F.col(fp_col).alias("fp")).mapInArrow(_probe, "key long, fp long")
    dealt = keys.repartition(max(width(distinct.sparkSession), 1), "key").sortWithinPartitions("key")
    return dealt.mapInArrow(_meet, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(id, tie, fp, root, component_id)`` for each row of ``docs``.

    ``root`` is a fingerprint that names the component, also where ids are not unique.

    ``component_id`` is the smallest id that links reach from the row, itself
    included. Null and empty texts have fingerprint 0 and are linked like any
    other; a null id is ignored as a minimum, so a component that has only null
    ids has a null id. Repeated rows are returned as often as they occur.
    """
    rows = written(fingerprints(docs, id_col, text_col, size), "simhash")
    distinct = written(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "simhash-distinct")
    found = connected_components(links(distinct))
    joined = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "n", "least", F.coalesce("component", "fp").alias("root"), F.col("component").isNotNull().alias("linked"))
    roots = joined.filter("linked").groupBy("root").agg(F.min("least").alias("component_id"))
    many = joined.filter("linked").select("fp", "root").join(roots, "root").select("fp", "root", "component_id")
    many = many.unionByName(joined.filter("NOT linked AND n > 1").select("fp", F.col("fp").alias("root"), F.col("least").alias("component_id")))
    return rows.join(many.withColumn("grouped", F.lit(True)), "fp", "left").select("id", "tie", "fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id (nulls last), then the smallest text hash; one of identical rows."""
    found = near_duplicates(docs, id_col, text_col)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tie")).alias("b")).select(F.col("b.id").alias("__wl_id"), F.col("b.tie").alias("__wl_tie"))
    kept = docs.withColumn("__wl_tie2", F.xxhash64(text_col)).join(best, F.col(id_col).cast("long").eqNullSafe(F.col("__wl_id")) & (F.col("__wl_tie2") == F.col("__wl_tie")), "left_semi")
    return kept.dropDuplicates([id_col, "__wl_tie2"]).drop("__wl_tie2")


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs``."""
    found = near_duplicates(docs.select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
