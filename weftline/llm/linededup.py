"""Line dedup by a segment-partition edit join.

Lines within ``t`` edits of each other share, if one is split into ``t + 1``
segments, one segment as a substring of the other at a place that their lengths
fix to a few starts. Each distinct line is indexed by its segments and probes
with those substrings; rows that meet are pruned by counts of characters and
then verified with a banded bit-parallel edit distance. Classes are connected
components of the verified links and exact repeats; the first occurrence of a
class stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import scratch, width, written
from .text import BASE, blobs, gathered, powers, scattered, slices, whole_groups

#: Edits within which two lines are one, and the characters that a line needs, spaces at its ends not counted, to take part.
MAX_EDITS, MIN_CHARS = 2, 30
_SEEN, _PAIRWISE, _BLOCK, _FILTER_BITS = 150_000, 24, 2048, 1 << 26
#: Bytes of lines that are worked on as one array, and above which a line is worked on alone and its segments are hashed one by one.
_SLICE, _LONG = 1 << 18, 1 << 16
#: Where in a sketch the count of each class is.
_LANES = np.uint64(1) << (np.arange(8, dtype=np.uint64) * np.uint64(8))


def within(a: str, b: str, limit: int) -> bool:
    """Whether the edit distance of ``a`` and ``b`` is at most ``limit``.

    What the texts share at their ends is stripped; the rest goes column by
    column through a band of ``2 * limit + 1`` rows, kept as vertical
    differences in two bit vectors that slide down by one row a column.
    """
    if abs(len(a) - len(b)) > limit:
        return False
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    lo = 0
    while lo < len(a) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < len(a) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo : len(a) - hi], b[lo : len(b) - hi]
    if not a:
        return len(b) <= limit
    rows, full = len(a), (1 << (2 * limit + 1)) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << (i + limit)
    # Bit k of column j stands for row j - limit + k; the score is that of the band's lowest row, or of the last row once the band has reached it.
    vp, vn, score = (full >> limit) << limit, 0, min(limit, rows)
    for j, c in enumerate(b):
        x = where.get(c, 0) >> j & full
        d0 = ((((x & vp) + vp) ^ vp) | x | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        low = j + limit + 1
        if low <= rows:
            score += not d0 >> (2 * limit) & 1
        else:
            bit = rows - (j + 1) + limit
            score += (hp >> bit & 1) - (hn >> bit & 1)
        vp = (hn | ~((d0 >> 1) | hp)) & full
        vn = (d0 >> 1) & hp
    return score <= limit


def _segments(n: int, limit: int) -> list[tuple[int, int]]:
    """Start and length of the ``limit + 1`` segments of a line of ``n`` characters, the longer ones last."""
    short, longer = divmod(n, limit + 1)
    out, at = [], 0
    for i in range(limit + 1):
        size = short + (i >= limit + 1 - longer)
        out.append((at, size))
        at += size
    return out


def _plan(n: int, limit: int) -> list[tuple[int, int, int, int, bool]]:
    """``(length, segment, start, end, probing)`` of all that a line of ``n`` characters indexes and probes; lines probe those that are not longer."""
    out = [(n, i, p, p + size, False) for i, (p, size) in enumerate(_segments(n, limit))]
    for other in range(max(n - limit, limit + 1), n + 1):
        gap = n - other
        for i, (p, size) in enumerate(_segments(other, limit)):
            first = max(0, p - i, p + gap - (limit - i))
            last = min(n - size, p + i, p + gap + (limit - i))
            out += [(other, i, q, q + size, True) for q in range(first, last + 1) if not (other == n and q == p)]
    return out


def _blocks(lines: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Which lines, their characters one after the other, and the bounds of each: ASCII as bytes, others as code points; long lines alone."""

    def block(some: list[int], plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if plain:
            found = [lines[i] for i in some]
            points = np.frombuffer(b"".join(found), np.uint8)
        else:
            found = [lines[i].decode("utf-8", "surrogatepass") for i in some]
            points = np.frombuffer("".join(found).encode("utf-32-le", "surrogatepass"), "<u4")
        return np.array(some), points, np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))])

    for plain in (True, False):
        some, size = [], 0
        for i, line in enumerate(lines):
            if line.isascii() is not plain:
                continue
            if len(line) > _LONG:
                yield block([i], plain)
                continue
            some.append(i)
            size += len(line)
            if size >= _SLICE:
                yield block(some, plain)
                some, size = [], 0
        if some:
            yield block(some, plain)


def _sketches(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Counts modulo 256 of each line's characters in eight classes, packed; an edit changes at most two of them, by one."""
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(_LANES[points & 7], out=total[1:])
    # Differences of the totals are counts over stretches in which none can pass 255.
    parts = -(-np.diff(bounds) // 255)
    first = np.cumsum(parts) - parts
    starts = np.repeat(bounds[:-1] - 255 * first, parts) + 255 * np.arange(parts.sum())
    counts = np.diff(total[np.append(starts, bounds[-1])]).view(np.uint8).reshape(-1, 8)
    return np.add.reduceat(counts, first, axis=0, dtype=np.uint8).view(np.int64).ravel()


class _Keys:
    """The keys of lines, by running totals of a random value a character times a power for its place."""

    def __init__(self, limit: int):
        self.limit, self.number = limit, {}
        self.at, self.size, self.rows = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 5), np.int64)
        self.value, self.power, self.inverse = scattered(np.arange(1 << 16)), powers(BASE, 2 * _SLICE), powers(pow(BASE, -1, 1 << 64), 2 * _SLICE)

    def _planned(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``_plan`` for each line, one after the other, as rows of a seed, whether to hash alone, start, end and whether it probes; and each row's line."""
        lengths, which = np.unique(sizes, return_inverse=True)
        if new := [n for n in lengths.tolist() if n not in self.number]:
            made = [np.array([(other * 64 + i, other > _LONG, a, b, probing) for other, i, a, b, probing in _plan(n, self.limit)], np.int64) for n in new]
            size = np.fromiter(map(len, made), np.int64, len(made))
            self.number.update(zip(new, range(len(self.size), len(self.size) + len(new)), strict=True))
            self.at = np.concatenate([self.at, len(self.rows) + np.cumsum(size) - size])
            rows = np.concatenate(made)
            rows[:, 0] = scattered(rows[:, 0]).view(np.int64)
            self.size, self.rows = np.concatenate([self.size, size]), np.concatenate([self.rows, rows])
        plan = np.array([self.number[n] for n in lengths.tolist()], np.int64)[which]
        return gathered(self.rows, self.at[plan], self.size[plan]), np.repeat(np.arange(len(sizes)), self.size[plan])

    def __call__(self, points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(key, line, probing)`` for the lines of a block; keys do not depend on what else is in it."""
        rows, line = self._planned(np.diff(bounds))
        seed, alone, a, b, probing = rows.T
        a, b = bounds[line] + a, bounds[line] + b
        if not alone.all():
            total = np.zeros(len(points) + 1, np.uint64)
            values = self.value[points] if points.dtype == np.uint8 or points.max() < len(self.value) else scattered(points)
            np.cumsum(values * self.power[: len(points)], out=total[1:])
            key = (total[b] - total[a]) * self.inverse[a]
        else:
            key = np.zeros(len(rows), np.uint64)
        # Segments of long lines, by the length of the line that is indexed: those that probe for it know it too.
        for i in np.flatnonzero(alone).tolist():
            key[i] = xxhash.xxh3_64_intdigest(points[a[i] : b[i]].astype("<u4").tobytes())
        return key.view(np.int64) ^ seed, line, probing


def eligible(text: bytes | None, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """The numbers and stripped contents of the lines that take part."""
    for number, line in enumerate(text.split(b"\n") if text else ()):
        line = line.strip()
        if len(line) >= min_chars and (len(line) >= 4 * min_chars or line.isascii() or len(line.decode("utf-8", "replace")) >= min_chars):
            yield number, line


def _name(line: bytes) -> int:
    """A line's hash without its lowest bit, which marks rows that probe."""
    return (xxhash.xxh3_64_intdigest(line) >> 1 << 1) - (1 << 63)


def _located(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).cast("binary").alias("text"))


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, tie, line, h, s)``: where each eligible line is, its hash, its sketch. Needs an integer id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            rows, numbers, lines = [], [], []
            for row, text in enumerate(blobs(batch.column("text"))):
                for number, line in eligible(text, min_chars):
                    rows.append(row)
                    numbers.append(number)
                    lines.append(line)
            s = np.zeros(len(lines), np.int64)
            for some, points, bounds in _blocks(lines):
                s[some] = _sketches(points, bounds)
            take = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(take), batch.column("tie").take(take), pa.array(numbers, pa.int32()), pa.array(map(_name, lines), pa.int64()), pa.array(s)], ["id", "tie", "line", "h", "s"])

    return _located(docs, id_col, text_col).withColumn("id", F.col("id").cast("long")).mapInArrow(run, "id long, tie long, line int, h long, s long")


def _keys(docs: DataFrame, limit: int, min_chars: int, text_col: str) -> DataFrame:
    """``(key, h, s)`` of each line that a task has not seen of late; odd ``h`` probe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, seen = _Keys(limit), set()
        for batch in slices(batches, "text", _SLICE):
            names, lines = [], []
            for text in blobs(batch.column("text")):
                for _, line in eligible(text, min_chars):
                    h = _name(line)
                    if h in seen:
                        continue
                    if len(seen) > _SEEN:
                        seen.clear()
                    seen.add(h)
                    names.append(h)
                    lines.append(line)
            h = np.array(names, np.int64)
            for some, points, bounds in _blocks(lines):
                key, line, probing = keys(points, bounds)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(h[some][line] + probing), pa.array(_sketches(points, bounds)[line])], ["key", "h", "s"])

    return docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "key long, h long, s long")


def _alike(a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Whether sketches differ by at most what ``limit`` edits can do."""
    x = a.reshape(*a.shape, 1).view(np.uint8).astype(np.int16) - b.reshape(*b.shape, 1).view(np.uint8).astype(np.int16)
    x = np.abs((x + 128) % 256 - 128)
    return x.sum(-1) <= 2 * limit


def _gather(limit: int):
    """From rows sorted by key to ``(g, h, s)``: lines that may be within the limit, under the smallest hash of their set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["key"]):
            key, h, s = (table.column(c).to_numpy() for c in ("key", "h", "s"))
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            size = np.repeat(sizes, sizes)
            keep = size > 1
            key, h, s, size = key[keep], h[keep], s[keep], size[keep]
            probing, h = (h & 1).astype(bool), h & ~np.int64(1)
            found: list[np.ndarray] = []
            small = np.flatnonzero(size <= _PAIRWISE)
            k, hs, ss, p = key[small], h[small], s[small], probing[small]
            for d in range(1, min(_PAIRWISE, len(k))):
                same = k[d:] == k[:-d]
                if not same.any():
                    break
                at = np.flatnonzero(same & ~(p[d:] & p[:-d]) & ((hs[d:] != hs[:-d]) | (ss[d:] != ss[:-d])))
                at = at[_alike(ss[at], ss[at + d], limit)]
                g = np.minimum(hs[at], hs[at + d])
                found += [np.stack([g, hs[at], ss[at]]), np.stack([g, hs[at + d], ss[at + d]])]
            big, at = np.flatnonzero(size > _PAIRWISE), 0
            while at < len(big):
                i, n = big[at], size[big[at]]
                found += _sets(h[i : i + n], s[i : i + n], ~probing[i : i + n], limit)
                at += n
            if found:
                g, h, s = np.unique(np.concatenate(found, axis=1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(h), pa.array(s)], ["g", "h", "s"])

    return run


def _sets(h: np.ndarray, s: np.ndarray, indexed: np.ndarray, limit: int) -> list[np.ndarray]:
    """The connected sets, of two lines or more, under sketches of one key's rows that are alike."""
    lines, inverse = np.unique(np.stack([h, s]), axis=1, return_inverse=True)
    hub = np.zeros(lines.shape[1], bool)
    np.logical_or.at(hub, inverse.ravel(), indexed)
    order = np.argsort(~hub, kind="stable")
    h, s, hub, out = lines[0][order], np.ascontiguousarray(lines[1][order]), hub[order], []
    todo = np.arange(len(h))
    while len(todo) > 1 and hub[todo[0]]:
        front, todo, members = todo[:1], todo[1:], [todo[:1]]
        while len(front) and len(todo):
            reached = np.zeros(len(todo), bool)
            step = max(1, (1 << 17) // len(todo))
            for at in range(0, len(front), step):
                part = front[at : at + step]
                reached |= (_alike(s[part][:, None], s[todo][None, :], limit) & (hub[part][:, None] | hub[todo][None, :])).any(0)
            front, todo = todo[reached], todo[~reached]
            members.append(front)
        all_ = np.concatenate(members)
        if len(all_) > 1:
            out.append(np.stack([np.full(len(all_), h[all_].min()), h[all_], s[all_]]))
    return out


def bits_of(df: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size of the values of a long column, for skipping rows that surely have none of them."""
    at = F.pmod(F.col(column), F.lit(_FILTER_BITS)) + 1
    rows = df.select(at.alias("p")).groupBy(F.expr("bitmap_bucket_number(p)").alias("b")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("m")).collect()
    out = np.zeros(_FILTER_BITS, bool)
    for row in rows:
        bits = np.unpackbits(np.frombuffer(row["m"], np.uint8), bitorder="little")
        at = (row["b"] - 1) * len(bits)
        out[at : at + len(bits)] = bits[: len(out) - at]
    return np.packbits(out, bitorder="little")


def maybe(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values % _FILTER_BITS
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _texts(docs: DataFrame, wanted: DataFrame, min_chars: int, text_col: str) -> DataFrame:
    """``(h, s, line)`` of the wanted ``(h, s)``, read from ``docs`` again."""
    bits = docs.sparkSession.sparkContext.broadcast(bits_of(wanted, "h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            found = [(_name(line), line) for text in blobs(batch.column("text")) for _, line in eligible(text, min_chars)]
            hit = maybe(bits.value, np.array([h for h, _ in found], np.int64)) if found else []
            rows = {h: line for (h, line), x in zip(found, hit, strict=True) if x and h not in seen}
            if len(seen) > _SEEN:
                seen.clear()
            seen.update(rows)
            lines, s = list(rows.values()), np.zeros(len(rows), np.int64)
            for some, points, bounds in _blocks(lines):
                s[some] = _sketches(points, bounds)
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int64()), pa.array(s), pa.array(lines, pa.binary())], ["h", "s", "line"])

    lines = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "h long, s long, line binary")
    return lines.join(wanted, ["h", "s"], "left_semi").groupBy("h", "s").agg(F.min("line").alias("line"))


def _node(h: str, s: str) -> Column:
    return F.unhex(F.concat(F.lpad(F.hex(h), 16, "0"), F.lpad(F.hex(s), 16, "0")))


def _verify(limit: int):
    """Links within each group, as few as join what is within the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["g", "x", "y"]):
            g, x, y, b = (table.column(c).to_numpy() for c in ("g", "x", "y", "b"))
            nodes = table.column("node").to_pylist()
            sketch = table.column("s").to_numpy()
            lines = [t.decode("utf-8", "surrogatepass") for t in table.column("line").to_pylist()]
            cut = [0, *(np.flatnonzero((g[1:] != g[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1).tolist(), len(g)]
            us, vs = [], []
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                root = list(range(hi - lo))

                def find(i: int, root=root) -> int:
                    while root[i] != i:
                        root[i] = root[root[i]]
                        i = root[i]
                    return i

                for i in range(lo, hi - 1):
                    rest = np.arange(i + 1, hi)
                    if x[lo] != y[lo]:
                        rest = rest[b[rest] != b[i]]
                    rest = rest[_alike(np.full(len(rest), sketch[i]), sketch[rest], limit)]
                    for j in rest.tolist():
                        p, q = find(i - lo), find(j - lo)
                        if p != q and within(lines[i], lines[j], limit):
                            root[max(p, q)] = min(p, q)
                            us.append(nodes[i])
                            vs.append(nodes[j])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], ["u", "v"])

    return run


def similar_lines(docs: DataFrame, limit: int = MAX_EDITS, min_chars: int = MIN_CHARS, text_col: str = "text") -> DataFrame:
    """``(u, v)``: links between distinct lines within ``limit`` edits that join exactly what all such links join.

    Lines are named by the 16 bytes of hash and sketch. Sets of lines too large
    for one task are dealt out as pairs of blocks.
    """
    if min_chars <= limit:
        raise ValueError("lines need more characters than edits")
    n = width(docs.sparkSession)
    dealt = _keys(docs, limit, min_chars, text_col).repartition(n, "key").sortWithinPartitions("key")
    sets = written(dealt.mapInArrow(_gather(limit), "g long, h long, s long").distinct(), "line-sets")
    texts = _texts(docs, sets.select("h", "s").distinct(), min_chars, text_col)
    blocks = sets.groupBy("g").count().select("g", F.ceil(F.col("count") / _BLOCK).cast("int").alias("k"))
    rows = sets.join(texts, ["h", "s"]).join(blocks, "g").withColumn("b", F.pmod(F.xxhash64("h", "s"), F.col("k")).cast("int"))
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select("g", F.least("b", "o").alias("x"), F.greatest("b", "o").alias("y"), "b", "s", _node("h", "s").alias("node"), "line")
    return rows.repartition(n, "g", "x", "y").sortWithinPartitions("g", "x", "y", "node").mapInArrow(_verify(limit), "u binary, v binary")


def removals(docs: DataFrame, limit: int = MAX_EDITS, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, tie, lines)``: the numbers of the lines to drop from each row that loses any."""
    found = written(occurrences(docs, min_chars, id_col, text_col), "lines")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("tie"), F.col("line"))).alias("first")
    distinct = written(found.groupBy("h", "s").agg(first, F.count("*").alias("n")), "lines-distinct")
    classes = connected_components(similar_lines(docs, limit, min_chars, text_col))
    near = distinct.withColumn("node", _node("h", "s")).join(classes, "node").select("h", "s", "component", "first")
    best = near.groupBy("component").agg(F.min("first").alias("first"))
    near = near.drop("first").join(best, "component").select("h", "s", "first", F.lit(True).alias("near"))
    keep = distinct.join(near.select("h", "s", F.col("first").alias("best"), "near"), ["h", "s"], "left").filter("n > 1 OR near").select("h", "s", F.coalesce("best", "first").alias("first"))
    # Written, so that both sides of the next join are plain scans and Spark can split a line that has a large share of all places.
    keep = written(keep, "lines-kept")
    gone = found.join(keep, ["h", "s"]).filter(~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("tie") == F.col("first.tie")) & (F.col("line") == F.col("first.line"))))
    return gone.groupBy("id", "tie").agg(F.collect_set("line").alias("lines"))


def _without(text: Column, lines: Column) -> Column:
    """A text without the lines of these numbers."""
    parts = F.get(F.transform(F.array(F.split(text, "\n")), lambda x: F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), lines), lambda i: F.get(x, i))), F.lit(0))
    return F.array_join(parts, "\n")


def dedup_lines(docs: DataFrame, limit: int = MAX_EDITS, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with the repeated lines taken out of ``text``, and ``n_lines_removed`` (replaced where it exists).

    Of the lines within ``limit`` edits of each other, directly or over other
    lines, the first stays: by id (nulls last), then by a hash of the text, then
    by place. Lines of fewer than ``min_chars`` characters stay. Null and empty
    texts are returned as they are. Rows with the same id and text are one
    document: each loses the same lines.
    """
    with scratch(docs.sparkSession):
        gone = written(removals(docs, limit, min_chars, id_col, text_col), "lines-gone", keep=True)
    bits = docs.sparkSession.sparkContext.broadcast(bits_of(gone, "tie"))

    @F.pandas_udf("boolean")
    def losing(tie: pd.Series) -> pd.Series:
        return pd.Series(maybe(bits.value, tie.to_numpy()))

    kept_columns = [c for c in docs.columns if c != "n_lines_removed"]
    tied = docs.withColumn("__wl_tie", F.xxhash64(text_col))
    maybe_losing = losing("__wl_tie")
    touched = tied.filter(maybe_losing).join(gone.select(F.col("id").alias("__wl_id"), F.col("tie").alias("__wl_t"), F.col("lines").alias("__wl_lines")), (F.col("__wl_tie") == F.col("__wl_t")) & F.col(id_col).cast("long").eqNullSafe(F.col("__wl_id")), "left")
    touched = touched.withColumn(text_col, F.when(F.col("__wl_lines").isNotNull(), _without(F.col(text_col), F.col("__wl_lines"))).otherwise(F.col(text_col)))
    touched = touched.select(*kept_columns, F.coalesce(F.size("__wl_lines"), F.lit(0)).alias("n_lines_removed"))
    return tied.filter(~maybe_losing).select(*kept_columns, F.lit(0).alias("n_lines_removed")).unionByName(touched)


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, text_sha256`` for each row: lines before, lines gone, and the hash of what stays (null text: null)."""
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).alias("n_lines")
    sized = docs.select("doc_id", "text", lines)
    return dedup_lines(sized).select("doc_id", F.col("n_lines").cast("long"), F.col("n_lines_removed").cast("long").alias("n_removed"), F.sha2("text", 256).alias("text_sha256"))
