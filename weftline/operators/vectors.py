"""Vector operators: top-k search, a bucket index, pairs over a threshold, bands."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .components import connected_components

#: Rows of a block that one task compares with another; queries that are broadcast at once; vectors that are compared with all by broadcasts at most.
_BLOCK, _QUERIES, _SCANNED = 2048, 4096, 4096
#: Blocks that vectors are dealt out in at most, before blocks have as many rows as a task holds; rows that are compared with others at once.
_DEALT, _HELD, _TILE = 16, 1 << 16, (512, 2048)
#: Share of the pairs over a threshold that the index is laid out to meet. Nothing here reads the index: pairs and neighbours are exact.
RECALL = 0.9999


def index_score(cosine: Column) -> Column:
    """The score that cosine indexes report: half of one plus the cosine."""
    return (F.lit(1.0) + cosine) / 2


def dimensions(vectors: DataFrame, vector: str) -> DataFrame:
    return vectors.groupBy(F.size(vector).cast("long").alias("dim")).agg(F.count("*").alias("vectors"))


def _unit(some: pd.Series) -> np.ndarray:
    x = np.stack(some.to_numpy()).astype(np.float64)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _plain(vectors: DataFrame, key: str, vector: str, by: list[str]) -> DataFrame:
    wide = F.col(vector) if dict(vectors.dtypes)[vector] == "array<float>" else F.col(vector).cast("array<double>")
    return vectors.filter(F.col(vector).isNotNull()).select(F.col(key).alias("key"), wide.alias("v"), *by)


def layout(n: int, least: float, recall: float = RECALL) -> tuple[int, int]:
    """Tables and bits a table of an index of ``n`` vectors: buckets of about half a block, and tables enough that pairs of cosine ``least`` meet with probability ``recall``.

    Up to four blocks of vectors have one bucket, and then all pairs meet.
    """
    if n <= 4 * _BLOCK:
        return 1, 0
    bits = max(1, int(np.log2(n / (_BLOCK / 2))))
    alike = max(0.5, 1 - float(np.arccos(np.clip(least, -1, 1))) / np.pi)
    return max(1, int(np.ceil(np.log(1 - recall) / np.log1p(-(alike**bits))))), bits


def buckets(vector: Column, tables: int, bits: int, seed: int = 7) -> Column:
    """A vector's bucket in each table: the signs of its products with random directions."""
    if not bits:
        return F.array(*[F.lit(0)] * tables)

    @F.pandas_udf("array<int>")
    def placed(some: pd.Series) -> pd.Series:
        out: list = [None] * len(some)
        sizes = some.map(len).to_numpy()
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            planes = np.random.default_rng([seed, int(size)]).standard_normal((int(size), tables * bits))
            signs = (np.stack(some.to_numpy()[at]).astype(np.float64) @ planes > 0).reshape(len(at), tables, bits)
            for i, row in zip(at, signs @ (1 << np.arange(bits)), strict=True):
                out[i] = row.astype(np.int32)
        return pd.Series(out)

    return placed(vector)


def index(vectors: DataFrame, key: str, vector: str, least: float, by: list[str] | None = None) -> DataFrame:
    """``(key, v, *by, d, t, bucket)``: each vector in its bucket of each table; only vectors of the same length meet."""
    tables, bits = layout(vectors.count(), least)
    base = _plain(vectors, key, vector, by or []).withColumn("d", F.size("v"))
    return base.select("*", F.posexplode(buckets(F.col("v"), tables, bits)).alias("t", "bucket"))


def search(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int, least: float = -1.0) -> DataFrame:
    """``(a, b, cosine, rank)``: each query's ``k`` nearest vectors with another key, exactly, ties to smaller keys.

    Queries are broadcast in blocks of bounded size. Vectors stay where they
    are, and a task sends its best ``k`` for each query of a block.
    """
    kind, base, found = dict(vectors.dtypes)[key], _plain(vectors, key, vector, []), None
    for block in _in_blocks(_plain(queries, key, vector, [])):
        sent = vectors.sparkSession.sparkContext.broadcast(block)

        def run(parts: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            ka, p = sent.value
            held = [(np.zeros(0), np.zeros(0, ka.dtype)) for _ in ka]
            for part in parts:
                part = part[part["v"].map(len).to_numpy() == p.shape[1]]
                if not len(part):
                    continue
                kb, s = part["key"].to_numpy(), p @ _unit(part["v"]).T
                for i in range(len(ka)):
                    good = np.flatnonzero((s[i] >= least) & (kb != ka[i]))
                    scores, keys = np.r_[held[i][0], s[i, good]], np.r_[held[i][1], kb[good]]
                    best = np.lexsort((keys, -scores))[:k]
                    held[i] = scores[best], keys[best]
            sizes = [len(x) for x, _ in held]
            yield pd.DataFrame({"a": np.repeat(ka, sizes), "b": np.concatenate([x for _, x in held]).astype(ka.dtype), "cosine": np.concatenate([x for x, _ in held])})

        part = base.mapInPandas(run, f"a {kind}, b {kind}, cosine double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return vectors.sparkSession.createDataFrame([], f"a {kind}, b {kind}, cosine double, rank int")
    best = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _in_blocks(rows: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and unit vectors of one length, in blocks of bounded size."""
    held: dict[int, list] = {}
    for row in rows.toLocalIterator():
        some = held.setdefault(len(row["v"]), [])
        some.append((row["key"], row["v"]))
        if len(some) >= _QUERIES:
            yield _keys(some), _unit(pd.Series([b for _, b in some]))
            some.clear()
    for some in held.values():
        if some:
            yield _keys(some), _unit(pd.Series([b for _, b in some]))


def _keys(some: list) -> np.ndarray:
    """Keys of pairs; strings stay objects, as arrays of strings are as wide as their longest."""
    return np.array([a for a, _ in some], object if isinstance(some[0][0], str) else None)


def nearest(vectors: DataFrame, key: str, vector: str, k: int = 10, least: float = -1.0, queries: DataFrame | None = None) -> DataFrame:
    """``(a, b, cosine, rank)``: the ``k`` nearest others, with at least cosine ``least``, of each vector or of ``queries``; ties to smaller keys.

    ``queries``, and up to ``_SCANNED`` vectors, are broadcast; more vectors
    meet in cells, each of which sends the best ``k`` of its rows.
    """
    if queries is not None or vectors.count() <= _SCANNED:
        return search(vectors, vectors if queries is None else queries, key, vector, k, least)

    def compare(x: _Rows, y: _Rows) -> tuple:
        there, back = _top(x, y, k, least), _top(y, x, k, least) if x is not y else ()
        return tuple(map(np.concatenate, zip(there, back, strict=True))) if back else there

    found = _in_cells(vectors, key, vector, [], compare)
    best = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


class _Rows:
    """Vectors of one length with their keys: unit vectors in single precision to find pairs with, and the numbers by position to check them with."""

    def __init__(self, keys: np.ndarray, v: np.ndarray, group: np.ndarray | None = None):
        self.keys, self.group = keys, group
        self.by_position = np.ascontiguousarray(v.T, dtype=np.float64)
        self.squares = np.zeros(len(v))
        for row in self.by_position:
            self.squares += row * row
        self.unit = (v / np.maximum(np.sqrt(self.squares), 1e-300)[:, None]).astype(np.float32)
        #: What products in single precision may be off.
        self.margin = (v.shape[1] + 8) * 2.0**-23

    def cosines(self, i: np.ndarray, other: _Rows, j: np.ndarray) -> np.ndarray:
        """Cosines of rows ``i`` with rows ``j`` of ``other``, summed by position: the same for the same vectors, wherever they stand."""
        total = np.zeros(len(i))
        for p, q in zip(self.by_position, other.by_position, strict=True):
            total += p[i] * q[j]
        norm = np.sqrt(self.squares[i] * other.squares[j])
        return np.clip(np.divide(total, norm, out=np.zeros(len(i)), where=norm > 0), -1, 1)


def _met(x: _Rows, y: _Rows, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of ``x`` and of ``y``, and their cosines in single precision, of pairs that may reach ``least``, tile by tile; within one set a pair comes once."""
    for at in range(0, len(x.keys), _TILE[0]):
        for to in range(at if x is y else 0, len(y.keys), _TILE[1]):
            s = x.unit[at : at + _TILE[0]] @ y.unit[to : to + _TILE[1]].T
            i, j = np.nonzero(s >= np.float32(least - x.margin))
            s, i, j = s[i, j], i + at, j + to
            good = i < j if x is y else slice(None)
            yield i[good], j[good], s[good]


def _over(x: _Rows, y: _Rows, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of pairs that do reach ``least``; only those near it are computed again."""
    for i, j, s in _met(x, y, least):
        good = s >= least + x.margin
        near = np.flatnonzero(~good)
        good[near] = x.cosines(i[near], y, j[near]) >= least
        yield i[good], j[good]


def _top(x: _Rows, y: _Rows, k: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(a, b, cosine)``: of each row of ``x`` the ``k`` nearest of ``y`` with another key, exactly, ties to smaller keys."""
    out = []
    rank = np.argsort(np.argsort(y.keys, kind="stable"), kind="stable")
    for at in range(0, len(x.keys), _TILE[0]):
        part = x.unit[at : at + _TILE[0]]
        floor = np.full((len(part), 1), least - x.margin, np.float32)
        held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for to in range(0, len(y.keys), _TILE[1]):
            i, j = np.nonzero(part @ y.unit[to : to + _TILE[1]].T >= floor)
            j = j + to
            other = x.keys[at + i] != y.keys[j]
            i, j = i[other], j[other]
            cosine = x.cosines(at + i, y, j)
            good = cosine >= least
            i, j, cosine = (np.concatenate(both) for both in zip(held, (i[good], j[good], cosine[good]), strict=True))
            order = np.lexsort((rank[j], -cosine, i))
            i, j, cosine = i[order], j[order], cosine[order]
            first = np.searchsorted(i, np.arange(len(part)))
            place = np.arange(len(i)) - first[i]
            last = place == k - 1
            floor[i[last], 0] = np.maximum(floor[i[last], 0], cosine[last] - x.margin)
            held = i[place < k], j[place < k], cosine[place < k]
        out.append((x.keys[at + held[0]], y.keys[held[1]], held[2]))
    return tuple(map(np.concatenate, zip(*out, strict=True))) if out else (x.keys, y.keys[:0], np.zeros(0))


def _in_cells(vectors: DataFrame, key: str, vector: str, by: list[str], compare, schema: str | None = None, group: str | None = None) -> DataFrame:
    """What ``compare(x, y)`` makes of each two blocks of vectors of the same ``by`` and length; all pairs meet, each in one cell. ``x`` is ``y`` where a block meets itself.

    A vector moves once for each block, and blocks are at most ``_DEALT`` in
    number until they have ``_HELD`` rows, so what moves grows with the vectors
    up to a million, and a task's memory has a bound at any size.
    """
    kind = dict(vectors.dtypes)[key]
    ways = [*by, "d"]
    base = _plain(vectors, key, vector, [*by, *[group] * (group is not None)]).withColumn("d", F.size("v")).filter("d > 0")
    for c in by:
        base = base.filter(F.col(c).isNotNull())
    n = F.count("*")
    blocks = F.greatest(F.least(F.ceil(n / _BLOCK), F.lit(_DEALT)), F.ceil(n / _HELD)).cast("int").alias("k")
    sizes = base.groupBy(*ways).agg(blocks).filter("k > 1").select(*[F.col(c).alias(f"__wl_{c}") for c in ways], "k")
    # One row for each ``_BLOCK`` vectors at most.
    rows = base.join(F.broadcast(sizes), [F.col(c) == F.col(f"__wl_{c}") for c in ways], "left").withColumn("k", F.coalesce("k", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("key"), F.col("k")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.select("key", "v", *ways, *[group] * (group is not None), "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    schema = schema or f"a {kind}, b {kind}, cosine double"
    types = to_arrow_schema(StructType.fromDDL(schema))

    def run(part: pa.Table) -> pa.Table:
        flat = part["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        v, keys, own = flat.reshape(part.num_rows, -1), part["key"].to_numpy(), part["own"].to_numpy()
        names = part[group].to_numpy() if group else None
        x, y = (_Rows(keys[at], v[at], names[at] if group else None) for at in (np.flatnonzero(own == part[c][0].as_py()) for c in ("x", "y")))
        made = compare(x, x if part["x"][0] == part["y"][0] else y)
        return pa.table([pa.array(c, f.type) for c, f in zip(made, types, strict=True)], types)

    return rows.groupBy(*ways, "x", "y").applyInArrow(run, schema)


def _ordered(x: _Rows, i: np.ndarray, y: _Rows, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of pairs, the smaller first, and which pairs have two different keys."""
    a, b = x.keys[i], y.keys[j]
    turn = (a > b).astype(bool)
    return np.where(turn, b, a), np.where(turn, a, b), (a != b).astype(bool)


def similar_pairs(vectors: DataFrame, key: str, vector: str, least: float, by: list[str] | None = None) -> DataFrame:
    """``(a, b, cosine)`` of all pairs ``a < b`` with at least cosine ``least``, those of the same ``by`` alone."""

    def compare(x: _Rows, y: _Rows) -> tuple:
        out = []
        for i, j, _ in _met(x, y, least):
            cosine = x.cosines(i, y, j)
            a, b, differ = _ordered(x, i, y, j)
            good = (cosine >= least) & differ
            out.append((a[good], b[good], cosine[good]))
        return tuple(map(np.concatenate, zip(*out, strict=True))) if out else (x.keys[:0], y.keys[:0], np.zeros(0))

    return _in_cells(vectors, key, vector, by or [], compare)


def bands(pairs: DataFrame, certain: float = 0.92, uncertain: float = 0.75) -> DataFrame:
    """``pairs`` with ``band``: certain, uncertain or apart."""
    return pairs.withColumn("band", F.when(F.col("cosine") >= certain, "certain").when(F.col("cosine") >= uncertain, "uncertain").otherwise("apart"))


def _joined(component: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Makes the components, each named by its smallest row, of rows ``i`` and ``j`` one."""
    while True:
        a, b = component[i], component[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(component, np.maximum(a, b), np.minimum(a, b))
        while (component != (up := component[component])).any():
            component[:] = up


def similar_components(vectors: DataFrame, key: str, vector: str, least: float, by: list[str] | None = None, allowed=None) -> DataFrame:
    """``(key, cluster)`` of every vector: its component under pairs of at least ``least``; ``allowed`` may take pairs ``(a, b, cosine)`` out, as a guard of antonyms does.

    Without ``allowed`` a cell sends a forest of its rows, not their pairs.
    """
    kind = dict(vectors.dtypes)[key]

    def forest(x: _Rows, y: _Rows) -> tuple:
        keys = x.keys if x is y else np.concatenate([x.keys, y.keys])
        component, after = np.arange(len(keys)), 0 if x is y else len(x.keys)
        for i, j in _over(x, y, least):
            _joined(component, i, j + after)
        linked = np.flatnonzero(component != np.arange(len(keys)))
        return keys[linked], keys[component[linked]]

    pairs = allowed(similar_pairs(vectors, key, vector, least, by)) if allowed else _in_cells(vectors, key, vector, by or [], forest, f"a {kind}, b {kind}")
    found = connected_components(pairs, "a", "b")
    return vectors.select(key).join(found.withColumnRenamed("node", key), key, "left").select(key, F.coalesce("component", key).alias("cluster"))


def nearest_groups(vectors: DataFrame, key: str, vector: str, group: str, least: float) -> DataFrame:
    """``(a, b, cosine)``: the largest cosine, of at least ``least``, of vectors of two different groups ``a < b``; rows without a group are left out.

    A cell sends one row for two groups, not their pairs.
    """
    kind = dict(vectors.dtypes)[group]

    def compare(x: _Rows, y: _Rows) -> tuple:
        names = np.unique(np.concatenate([x.group, y.group]))
        of_x, of_y = np.searchsorted(names, x.group), np.searchsorted(names, y.group)
        best = np.zeros(0, np.int64), np.zeros(0)
        for i, j, s in _met(x, y, least):
            g, h = of_x[i], of_y[j]
            pair, at = np.unique(np.minimum(g, h) * len(names) + np.maximum(g, h), return_inverse=True)
            most = np.full(len(pair), -2.0)
            np.maximum.at(most, at, s)
            # Only what may be the largest of two groups is computed again.
            near = np.flatnonzero((s >= most[at] - 2 * x.margin) & (g != h) & (x.keys[i] != y.keys[j]))
            cosine = x.cosines(i[near], y, j[near])
            best = np.concatenate([best[0], pair[at[near]][cosine >= least]]), np.concatenate([best[1], cosine[cosine >= least]])
            order = np.lexsort((-best[1], best[0]))
            first = order[np.flatnonzero(np.diff(best[0][order], prepend=-1))]
            best = best[0][first], best[1][first]
        return names[best[0] // max(1, len(names))], names[best[0] % max(1, len(names))], best[1]

    found = _in_cells(vectors.filter(F.col(group).isNotNull()), key, vector, [], compare, f"a {kind}, b {kind}, cosine double", group)
    return found.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
