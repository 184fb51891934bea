"""Approximate nearest neighbours by multiprobe p-stable hashing.

Unit vectors are hashed by ``floor((a . v + b) / w)`` with Gaussian ``a``, some
such values to a table's bucket. A query visits, in each table, the buckets
with the smallest sums of squared distances from its values to the boundaries
that lead there: the order of estimated success. The candidates of all tables
are ranked by the exact cosine of the original vectors.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import width, written
from .text import whole_groups

#: Vectors that the parameters are fitted on at most, chosen by a hash of the id, and queries among them.
SAMPLE, SAMPLE_QUERIES = 20_000, 256
#: Share of true neighbours in the sample that probing must reach; vectors of a bucket that one task compares at once.
TARGET, TOGETHER = 0.97, 256
_BLOCK = 4096


@dataclass
class Hashing:
    """Directions, offsets and width of the tables, and the probes in each."""

    a: np.ndarray
    b: np.ndarray
    w: float
    probes: int

    @property
    def k(self) -> int:
        return self.b.shape[1]

    def values(self, unit: np.ndarray, table: int) -> np.ndarray:
        return (unit @ self.a[table] + self.b[table]) / self.w

    @staticmethod
    def name(cells: np.ndarray) -> np.ndarray:
        """A 64-bit name of each bucket, from its whole-number values."""
        h = np.zeros(cells.shape[:-1], np.uint64)
        for j in range(cells.shape[-1]):
            h = (h ^ cells[..., j].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        return h.view(np.int64)

    def costs(self, values: np.ndarray) -> np.ndarray:
        """For each row and each way to move every value by -1, 0 or 1, the sum of squared distances to the boundaries crossed."""
        part = values - np.floor(values)
        one = np.stack([part**2, np.zeros_like(part), (1 - part) ** 2], axis=-1)
        total = one[:, 0]
        for j in range(1, self.k):
            total = (total[:, :, None] + one[:, j][:, None, :]).reshape(len(values), -1)
        return total

    def visits(self, values: np.ndarray) -> np.ndarray:
        """The names of the buckets that each row visits, in order of success."""
        total = self.costs(values)
        n = min(self.probes, total.shape[1])
        best = np.argpartition(total, n - 1, axis=1)[:, :n]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(total, best, 1), axis=1, kind="stable"), 1)
        moves = np.array(list(itertools.product((-1, 0, 1), repeat=self.k)))
        return self.name(np.floor(values)[:, None, :].astype(np.int64) + moves[best])


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(sample: np.ndarray, n: int, tables: int = 6, w: float = 1.5, nearest: int = 5, target: float = TARGET, seed: int = 42) -> Hashing:
    """Hashing whose probes reach ``target`` of the sample's true neighbours.

    Values a table grow with the logarithm of ``n``, 9 at most, and are taken
    away again while even all probes miss the target. Neighbours in more rows
    than the sample are closer, so the target holds for those the more.
    """
    unit = _unit(sample)
    queries = unit[: min(SAMPLE_QUERIES, len(unit))]
    near = queries @ unit.T
    near[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    true = np.argsort(-near, axis=1, kind="stable")[:, : min(nearest, len(unit) - 1)]
    for k in range(max(2, min(9, round(np.log2(max(n, 2)) / 2.6))), 0, -1):
        rng = np.random.default_rng(seed)
        made = Hashing(rng.standard_normal((tables, unit.shape[1], k)), rng.uniform(0, w, (tables, k)), w, 1)
        needed = np.full(true.shape, np.iinfo(np.int64).max)
        for t in range(tables):
            values = made.values(unit, t)
            cells = np.floor(values).astype(np.int64)
            q = values[: len(queries)]
            total = np.sort(made.costs(q), axis=1)
            move = cells[true] - cells[: len(queries), None, :]
            part = (q - np.floor(q))[:, None, :]
            cost = np.where(move < 0, part**2, np.where(move > 0, (1 - part) ** 2, 0)).sum(-1)
            for i in range(len(queries)):
                rank = np.searchsorted(total[i], cost[i], side="right")
                needed[i] = np.minimum(needed[i], np.where((np.abs(move[i]) <= 1).all(-1), rank, np.iinfo(np.int64).max))
        reach = np.sort(needed.ravel())
        probes = reach[min(len(reach) - 1, int(np.ceil(target * len(reach))))] if len(reach) else 1
        if probes <= 3**k or k == 1:
            made.probes = int(min(probes, 3**k))
            return made
    raise AssertionError


def valid(vector: Column) -> Column:
    """Whether a vector takes part: not null, not empty, without null, NaN or infinite components, and not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def _best(held: dict[int, list], query: int, ids: np.ndarray, scores: np.ndarray, nearest: int) -> None:
    """Keeps the ``nearest`` of what is held for a query and of what is new, ties to smaller ids, each id once."""
    if len(ids) > nearest:
        edge = np.partition(scores, -nearest)[-nearest]
        ids, scores = ids[scores >= edge], scores[scores >= edge]
    merged = {(-s, i) for s, i in zip(scores.tolist(), ids.tolist(), strict=True)}.union(held.get(query, ()))
    held[query] = sorted(merged)[:nearest]


def _rows(held: dict[int, list]) -> pa.RecordBatch:
    flat = [(q, i, -s) for q, best in held.items() for s, i in best]
    kinds = pa.int64(), pa.int64(), pa.float64()
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in flat], k) for c, k in enumerate(kinds)], ["query_id", "vec_id", "score"])


def cosine(queries: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.einsum("ij,kj->ik", queries, others) / np.linalg.norm(queries, axis=1)[:, None] / np.linalg.norm(others, axis=1)


def search(vectors: DataFrame, is_query: Column, nearest: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = 6, target: float = TARGET) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query the ``nearest`` candidates found, by cosine and then by smaller id.

    Candidates are all rows but those with the query's own id. Vectors that are
    null, zero, or hold null or non-finite components take no part, nor do rows
    with a null id. Only vectors of one length have a cosine. The commonest
    length, and each of more than ``SAMPLE`` vectors, is hashed on its own;
    queries of the others are compared with all of their length. Ids name
    vectors: of rows with the same id and vector one counts. A query for which
    the probes find too few candidates is compared with all rows. An empty table
    gives none.
    """
    spark = vectors.sparkSession
    plain = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("asks"))
    plain = plain.filter(F.col("id").isNotNull() & valid(F.col("v")))
    sizes = plain.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").collect()
    hashed = [r for i, r in enumerate(sizes) if not i or r["count"] > SAMPLE]
    found = [_hashed(plain.filter(F.size("v") == r["d"]), r["count"], nearest, tables, target) for r in hashed]
    if len(hashed) < len(sizes):
        rest = plain.filter(~F.size("v").isin([r["d"] for r in hashed]))
        found += [written(_scan(rest, block, nearest), "scanned") for block in _blocks(rest.filter("asks").select("id", "v"))]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return whole.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def _hashed(plain: DataFrame, n: int, nearest: int, tables: int, target: float) -> DataFrame:
    """``(query_id, vec_id, score)``: each task's best candidates of the queries among ``n`` vectors of one length."""
    spark = plain.sparkSession
    sample = plain.select("v", F.xxhash64("id").alias("h"), "id").orderBy("h", "id").limit(SAMPLE).toPandas()["v"]
    made = fit(np.stack(sample.to_numpy()), n, tables, nearest=nearest, target=target)
    sent = spark.sparkContext.broadcast(made)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                x = np.asarray(batch.column("v").flatten()).reshape(batch.num_rows, -1)
                ids, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "asks"))
                unit, raw = _unit(x), np.array([r.tobytes() for r in x.astype("<f8")], object)
                asks = np.array([bool(a) for a in asks])
                parts = []
                for t in range(len(made.b)):
                    values = made.values(unit, t)
                    parts.append((np.full(len(ids), t), made.name(np.floor(values).astype(np.int64)), np.ones(len(ids), np.int32), np.arange(len(ids))))
                    if asks.any():
                        visits = made.visits(values[asks])
                        who = np.repeat(np.flatnonzero(asks), visits.shape[1])
                        parts.append((np.full(len(who), t), visits.ravel(), np.zeros(len(who), np.int32), who))
                table, bucket, kind, who = (np.concatenate(c) for c in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(table.astype(np.int32)), pa.array(bucket), pa.array(kind), pa.array(ids[who]), pa.array(raw[who].tolist(), pa.binary())], ["t", "bucket", "kind", "id", "v"])

    placed = plain.mapInArrow(place, "t int, bucket long, kind int, id long, v binary")
    counts = written(placed.filter("kind = 1").groupBy("t", "bucket").agg(F.ceil(F.count("*") / TOGETHER).cast("int").alias("k")), "buckets")
    stored = placed.filter("kind = 1").join(counts.filter("k > 1"), ["t", "bucket"], "left").withColumn("salt", F.pmod(F.xxhash64("id"), F.coalesce("k", F.lit(1))).cast("int"))
    asked = placed.filter("kind = 0").join(counts, ["t", "bucket"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = stored.drop("k").unionByName(asked.drop("k"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for table in whole_groups(batches, ["t", "bucket", "salt"]):
            t, bucket, salt, kind, ids = (table.column(c).to_numpy() for c in ("t", "bucket", "salt", "kind", "id"))
            raw = table.column("v")
            cut = [0, *(np.flatnonzero((t[1:] != t[:-1]) | (bucket[1:] != bucket[:-1]) | (salt[1:] != salt[:-1])) + 1).tolist(), len(t)]
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                mid = lo + int((kind[lo:hi] == 0).sum())
                if mid == lo or mid == hi:
                    continue
                others, names = _matrix(raw.slice(mid, hi - mid)), ids[mid:hi]
                for at in range(lo, mid, _BLOCK):
                    to = min(at + _BLOCK, mid)
                    for q, row in zip(ids[at:to].tolist(), cosine(_matrix(raw.slice(at, to - at)), others), strict=True):
                        other = names != q
                        _best(held, q, names[other], row[other], nearest)
                if len(held) > 100_000:
                    yield _rows(held)
                    held = {}
        yield _rows(held)

    dealt = rows.repartition(width(spark), "t", "bucket", "salt").sortWithinPartitions("t", "bucket", "salt", "kind", "id")
    found = written(dealt.mapInArrow(meet, "query_id long, vec_id long, score double").distinct(), "candidates")
    enough = min(nearest, n - 1)
    short = plain.filter("asks").select("id", "v").join(found.groupBy(F.col("query_id").alias("id")).agg(F.count_distinct("vec_id").alias("c")).filter(F.col("c") >= enough), "id", "left_anti")
    for block in _blocks(short):
        found = found.unionByName(written(_scan(plain, block, nearest), "scanned"))
    return found


def _blocks(rows: DataFrame) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Ids and vectors by length, in blocks of bounded size."""
    held: dict[int, list] = {}
    n = 0
    for row in rows.toLocalIterator():
        held.setdefault(len(row["v"]), []).append((row["id"], row["v"]))
        n += 1
        if n >= _BLOCK:
            yield {d: (np.array([i for i, _ in x]), np.array([v for _, v in x])) for d, x in held.items()}
            held, n = {}, 0
    if held:
        yield {d: (np.array([i for i, _ in x]), np.array([v for _, v in x])) for d, x in held.items()}


def _scan(plain: DataFrame, block: dict[int, tuple[np.ndarray, np.ndarray]], nearest: int) -> DataFrame:
    """A block of queries against all rows of their length."""
    sent = plain.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            sizes = pc.list_value_length(batch.column("v")).to_numpy()
            for d in np.intersect1d(sizes, list(sent.value)).tolist():
                queries, x = sent.value[d]
                some = batch.take(pa.array(np.flatnonzero(sizes == d)))
                names = some.column("id").to_numpy()
                for q, row in zip(queries.tolist(), cosine(x, np.asarray(some.column("v").flatten()).reshape(-1, d)), strict=True):
                    _best(held, q, names[names != q], row[names != q], nearest)
        yield _rows(held)

    return plain.select("id", "v").mapInArrow(run, "query_id long, vec_id long, score double")


def digest(vectors: DataFrame) -> DataFrame:
    """The 5 nearest found of each row whose ``vec_id`` is divisible by 50."""
    return search(vectors, F.col("vec_id") % 50 == 0)
