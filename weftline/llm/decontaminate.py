"""Benchmark decontamination with a distributed positional inverted index.

The index is a table of segments. A segment holds the postings of some whole
documents, so phrases are found within it alone and nothing is shuffled; what
all segments share are the term frequencies, which an aggregation over them
gives. A phrase is looked up from its rarest term: the places of the other
terms, less their offsets in the phrase, are intersected with its places in
ascending order of frequency.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .text import blobs, slices, words

#: Words of a window; words of a segment, which ends with the document that passes them; words of the items searched at once.
WINDOW, SEGMENT_WORDS, BLOCK_WORDS = 10, 1 << 18, 200_000
_INDEX = "segment string, id array<long>, tie array<long>, start array<int>, n array<int>, term array<binary>, at binary, place binary"


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The segments of ``docs``: ids, a hash of each text, each document's first place and length, and each term's places.

    Places count words over the segment, with a gap of one between documents.
    Null and empty texts are documents without words.
    """

    def pack(ids: list, ties: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        n = np.array([len(t) for t in texts], np.int64)
        start = np.concatenate([[0], np.cumsum(n + 1)[:-1]])
        flat = [w for t in texts for w in t]
        terms = sorted(set(flat))
        number = dict(zip(terms, range(len(terms)), strict=True))
        which = np.fromiter(map(number.__getitem__, flat), np.int32, len(flat))
        place = (np.arange(len(flat)) + np.repeat(np.arange(len(n)), n)).astype(np.int32)
        order = np.argsort(which, kind="stable")
        at = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(terms)))]).astype("<i4")
        one = [uuid.uuid4().hex], [ids], [ties], [start.astype(np.int32)], [n.astype(np.int32)], [terms], [at.tobytes()], [place[order].astype("<i4").tobytes()]
        kinds = pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.binary(), pa.binary()
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(one, kinds, strict=True)], ["segment", "id", "tie", "start", "n", "term", "at", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ties, texts, total = [], [], [], 0
        for batch in slices(batches, "text"):
            for i, tie, text in zip(batch.column("id").to_pylist(), batch.column("tie").to_pylist(), blobs(batch.column("text")), strict=True):
                found = words(text)
                ids.append(i)
                ties.append(tie)
                texts.append(found)
                total += len(found) + 1
                if total >= SEGMENT_WORDS:
                    yield pack(ids, ties, texts)
                    ids, ties, texts, total = [], [], [], 0
        if ids:
            yield pack(ids, ties, texts)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).cast("binary").alias("text"))
    return written(rows.mapInArrow(run, _INDEX), "postings")


@dataclass
class Phrases:
    """Distinct windows of some items, by their length, with the items that have each."""

    size: int = WINDOW
    terms: dict[bytes, int] = field(default_factory=dict)
    windows: dict[tuple[int, ...], list[str]] = field(default_factory=dict)
    n_words: int = 0

    def add(self, item: str, text: bytes | None) -> None:
        found = words(text)
        self.n_words += len(found)
        numbers = [self.terms.setdefault(w, len(self.terms)) for w in found]
        for at in range(max(1, len(numbers) - self.size + 1) if numbers else 0):
            owners = self.windows.setdefault(tuple(numbers[at : at + self.size]), [])
            if not owners or owners[-1] != item:
                owners.append(item)


def _known(terms: pa.Array, known: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where a segment's terms are among the known ones: places in the segment, and places in ``known``."""
    at = pc.index_in(terms, value_set=known)
    has = at.is_valid().to_numpy(zero_copy_only=False)
    return np.flatnonzero(has), at.drop_null().to_numpy().astype(np.int64)


def _frequencies(index: DataFrame, phrases: Phrases) -> np.ndarray:
    """How often each of the phrases' terms occurs in all segments."""
    terms = index.sparkSession.sparkContext.broadcast(pa.array(list(phrases.terms), pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms.value
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for found, at in zip(batch.column("term"), batch.column("at"), strict=True):
                i, k = _known(found.values, known)
                total[k] += np.diff(np.frombuffer(at.as_py(), "<i4"))[i]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "n"])

    out = np.zeros(len(phrases.terms), np.int64)
    for row in index.select("term", "at").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row["term"]] = row["n"]
    return out


def _intersect(places: list[np.ndarray], offsets: list[int], slop: int) -> np.ndarray:
    """First and last place of each match, from the rarest list on: ``places[k]`` less ``offsets[k]`` lies within ``slop`` of the first's."""
    base = places[0] - offsets[0]
    low, high = places[0], places[0]
    for p, o in zip(places[1:], offsets[1:], strict=True):
        if not len(base):
            break
        want = base + o
        right = np.minimum(np.searchsorted(p, want), len(p) - 1)
        left = np.maximum(right - 1, 0)
        got = np.where(np.abs(p[left] - want) < np.abs(p[right] - want), p[left], p[right])
        keep = np.abs(got - want) <= slop
        base, low, high = base[keep], np.minimum(low[keep], got[keep]), np.maximum(high[keep], got[keep])
    return np.stack([low, high], axis=1)[: len(base)]


def _search(index: DataFrame, phrases: Phrases, slop: int) -> DataFrame:
    counts = _frequencies(index, phrases)
    by_size: dict[int, list] = {}
    for window, owners in phrases.windows.items():
        if all(counts[t] for t in window):
            by_size.setdefault(len(window), []).append((window, owners))
    plans = []
    for group in by_size.values():
        ids = np.array([w for w, _ in group], np.int32)
        plans.append((ids, np.argsort(counts[ids], axis=1, kind="stable").astype(np.int32), [o for _, o in group]))
    sent = index.sparkSession.sparkContext.broadcast((pa.array(list(phrases.terms), pa.binary()), plans))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, plans = sent.value
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda c: batch.column(c)[row]  # noqa: B023,E731
                at, place = (np.frombuffer(get(c).as_py(), "<i4") for c in ("at", "place"))
                lists: dict[int, np.ndarray] = {}
                has = np.zeros(len(known), bool)
                for i, k in zip(*(x.tolist() for x in _known(get("term").values, known)), strict=True):
                    lists[k] = place[at[i] : at[i + 1]]
                    has[k] = True
                start, n = (get(c).values.to_numpy().astype(np.int64) for c in ("start", "n"))
                spans: dict[int, set] = {}
                items: dict[int, set] = {}
                for ids, order, owners in plans:
                    for w in np.flatnonzero(has[ids].all(axis=1)):
                        offsets = order[w].tolist()
                        match = _intersect([lists[ids[w, o]].astype(np.int64) for o in offsets], offsets, slop)
                        doc = np.searchsorted(start, match[:, 0], side="right") - 1
                        for d, (a, b) in zip(doc.tolist(), match.tolist(), strict=True):
                            if b < start[d] + n[d]:
                                spans.setdefault(d, set()).add((a - int(start[d]), b + 1 - int(start[d])))
                                items.setdefault(d, set()).update(owners[w])
                docs = len(start)
                kinds = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
                joined = [_merged(spans.get(d, ())) for d in range(docs)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([get("segment").as_py()] * docs), pa.array(np.arange(docs), pa.int32()), get("id").values, get("tie").values, pa.array(n), pa.array(joined, kinds), pa.array([sorted(items.get(d, ())) for d in range(docs)], pa.list_(pa.string()))],
                    ["segment", "ord", "id", "tie", "n_words", "spans", "items"],
                )

    return index.mapInArrow(run, "segment string, ord int, id long, tie long, n_words long, spans array<struct<a:int,b:int>>, items array<string>")


def _merged(spans) -> list[dict]:
    out: list[dict] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]["b"]:
            out[-1]["b"] = max(b, out[-1]["b"])
        else:
            out.append({"a": a, "b": b})
    return out


def find_items(index: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = 0, item_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(segment, ord, id, tie, n_words, spans, items)`` for each indexed document.

    ``spans`` are the stretches of words, ``a`` to before ``b``, inside any
    occurrence of a window of ``size`` consecutive words of an item; an item of
    fewer words is one window. With ``slop`` a word may be that far from its
    place in the window. ``items`` are the ids, as strings and sorted, of the
    items with an occurring window. Items with a null id or without words have
    none. Items are searched in blocks of about ``block_words`` words, so what is
    sent to the executors is bounded.
    """
    found, phrases = [], Phrases(size)
    rows = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text")).filter("item IS NOT NULL AND text IS NOT NULL")
    for row in rows.toLocalIterator():
        phrases.add(row["item"], bytes(row["text"]))
        if phrases.n_words >= block_words:
            found.append(_search(index, phrases, slop))
            phrases = Phrases(size)
    if phrases.n_words or not found:
        found.append(_search(index, phrases, slop))
    if len(found) == 1:
        return found[0]
    out = written(found[0], "hits")
    for more in found[1:]:
        out = out.unionByName(written(more, "hits"))
    merge = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    return out.groupBy("segment", "ord", "id", "tie", "n_words").agg(merge("spans").alias("spans"), merge("items").alias("items"))


def _hit_words(spans: str):
    """Words in sorted, possibly overlapping spans."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    step = lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], acc["end"]))).alias("n"), F.greatest(acc["end"], x["b"]).alias("end"))
    return F.aggregate(F.col(spans), zero, step, lambda acc: acc["n"])


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item. Rows with the same id and text go or stay together."""
    found = find_items(build_index(docs, id_col, text_col), items, **options)
    bad = found.filter(F.size("spans") > 0).select(F.col("id").alias("__wl_id"), F.col("tie").alias("__wl_tie")).distinct()
    tied = docs.withColumn("__wl_text", F.xxhash64(text_col))
    return tied.join(bad, (F.col("__wl_text") == F.col("__wl_tie")) & F.col(id_col).cast("long").eqNullSafe(F.col("__wl_id")), "left_anti").drop("__wl_text")


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for each row of ``docs``."""
    found = find_items(build_index(docs.select("doc_id", "text")), items)
    hit = _hit_words("spans").cast("long")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
