"""Language identification by Bayesian evidence fusion.

The likelihood of a text under each language is that of its letter trigrams.
From it alone every row gets a first posterior. Grouped sums of those over all
rows give how languages are declared in markup, and priors for hosts, smoothed
towards their domain, its address suffix and the whole. A second pass fuses
text, declaration and prior; a row's own share is taken out of the sums first.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .text import blobs

#: Documents that the trigram model is fitted on at most, chosen by a hash of their id.
SAMPLE = 20_000
#: Slots that trigrams are hashed to; added to each count; weight of the level above in a prior; what a text's trigrams count for, as they overlap.
SLOTS, ADDED, STRENGTH, TEMPER = 1 << 16, 0.5, 4.0, 1 / 3
_LETTERS = bytes((i + 32) if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 128 else 32 for i in range(256))
_HIDDEN = re.compile(r"<(script|style|nav|noscript|template)\b.*?</\1\s*>|<!--.*?-->", re.S | re.I)
_TAG = re.compile(r"<[^>]*>")


def slots(text: bytes | None) -> np.ndarray:
    """Hashed byte trigrams of the letters of a text, A-Z lower-cased; blanks stand for all else, and trigrams of two blanks side by side are left out."""
    if not text:
        return np.empty(0, np.int64)
    b = np.frombuffer(b" " + text.translate(_LETTERS) + b" ", np.uint8).astype(np.uint32)
    blank = b == 32
    keep = ~((blank[:-2] & blank[1:-1]) | (blank[1:-1] & blank[2:]))
    h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
    h *= np.uint32(0x27D4EB2F)
    return (h[keep] >> np.uint32(16)).astype(np.int64)


def visible(page: bytes | None) -> bytes:
    """The text of a page without scripts, styles, navigation, comments and tags."""
    if not page:
        return b""
    return entities.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page.decode("utf-8", "replace")))).encode("utf-8", "replace")


@dataclass
class Model:
    """Languages in order, and the logarithm of each slot's probability under each."""

    languages: list[str]
    table: np.ndarray

    def log_likelihood(self, text: bytes | None) -> list[float]:
        """Tempered log-likelihoods, less the largest; all 0 for a text without letters."""
        got = slots(text)
        total = np.zeros(len(self.languages))
        for at in range(0, len(got), 1 << 16):
            total += self.table[got[at : at + (1 << 16)]].sum(0, dtype=np.float64)
        return (TEMPER * (total - total.max())).tolist() if len(total) else []


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trigram counts by language, over at most ``sample`` documents with a language and an id."""
    rows = docs.select(F.col(id_col).alias("id"), F.lower(F.col(lang_col)).alias("lang"), F.col(text_col).cast("binary").alias("text")).filter("id IS NOT NULL AND lang IS NOT NULL")
    chosen = rows.select("id", F.xxhash64("id").alias("h")).orderBy("h", "id").limit(sample).select("id").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), blobs(batch.column("text")), strict=True):
                held.setdefault(lang, np.zeros(SLOTS, np.int64))
                held[lang] += np.bincount(slots(text), minlength=SLOTS)
        for lang, counts in held.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(counts[some])], ["lang", "slot", "n"])

    counted = rows.join(F.broadcast(chosen), "id", "left_semi").select("lang", "text").mapInArrow(count, "lang string, slot long, n long")
    whole = counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(whole["lang"].unique())
    table = np.full((SLOTS, len(languages)), ADDED)
    for j, lang in enumerate(languages):
        part = whole[whole["lang"] == lang]
        table[part["slot"].to_numpy(), j] += part["n"].to_numpy()
    return Model(languages, np.log(table / table.sum(0)).astype(np.float32) if languages else table)


def evidence_of_pages(pages: DataFrame) -> DataFrame:
    """``(row, content, html, declared, host, domain, suffix)`` of web pages: ``page_id``, the markup, and what it and the address say."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return pages.select(
        F.col("page_id").cast("long").alias("row"), F.col("html").cast("binary").alias("content"), F.lit(True).alias("markup"),
        F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})""", 1)).alias("declared"),
        host.alias("host"), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"), F.regexp_extract(host, r"\.([^.]+)$", 1).alias("suffix"),
    )


def evidence_of_documents(docs: DataFrame) -> DataFrame:
    """The same of plain documents: ``source`` is the host, and nothing is declared."""
    return docs.select(
        F.col("doc_id").cast("long").alias("row"), F.col("text").cast("binary").alias("content"), F.lit(False).alias("markup"), F.lit("").alias("declared"),
        F.lower(F.coalesce("source", F.lit(""))).alias("host"), F.lit("").alias("domain"), F.lit("").alias("suffix"),
    )


def _posterior(logs: Column) -> Column:
    """Probabilities from log weights."""
    shifted = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, y: a + y))


def identify(evidence: DataFrame, model: Model) -> DataFrame:
    """``(row, lang, confidence, text_lang, declared, host)`` for each row of evidence.

    Ties go to the language that comes first in the alphabet. A row without
    letters is decided by its declaration and its host alone; so is one with a
    null content. Null rows' ids stay null, repeated rows count and are returned
    as often as they occur, and no rows give none. Missing declarations say
    nothing. Null addresses share the empty host. Without any
    fitted language ``lang`` is null.
    """
    names, sent = model.languages, evidence.sparkSession.sparkContext.broadcast(model)
    if not names:
        return evidence.select("row", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("text_lang"), "declared", "host")
    levels = ["host", "domain", "suffix"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            made = [model.log_likelihood(visible(c) if m else c) for c, m in zip(batch.column("content").to_pylist(), batch.column("markup").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *(batch.column(c) for c in ("declared", *levels)), pa.array(made, pa.list_(pa.float64()))], ["row", "declared", *levels, "text"])

    read = evidence.select("row", "content", "markup", "declared", *levels).mapInArrow(run, "row long, declared string, host string, domain string, suffix string, text array<double>")
    first = written(read.withColumn("p", _posterior(F.col("text"))), "evidence")
    each = [F.sum(F.col("p")[j]).alias(f"n{j}") for j in range(len(names))]
    vector = F.array(*[F.col(f"n{j}") for j in range(len(names))])
    sums = {level: first.groupBy(*levels[i:]).agg(*each).select(*levels[i:], vector.alias(f"at_{level}")) for i, level in enumerate(levels)}
    whole = [x or 0.0 for x in first.groupBy().agg(*each).select(vector).first()[0]]
    said = first.groupBy("declared").agg(*each).select("declared", vector.alias("at_declared"))

    # Hosts with their domain's and suffix's sums: as many rows as there are hosts, each far smaller than a page.
    known = sums["host"].join(sums["domain"], levels[1:]).join(sums["suffix"], levels[2:])
    joined = first.join(known, levels).join(said, "declared")
    # What is declared how often, given the language; kinds of declarations are those that occur.
    kinds = F.lit(float(said.count()))
    less = lambda n, p: F.greatest(n - p, F.lit(0.0))
    everywhere = F.array(*[F.lit(float(x)) for x in whole])
    joined = joined.withColumn("prior", F.transform(everywhere, lambda x: (x + F.lit(1.0)) / F.lit(float(sum(whole) + len(names)))))
    for level in reversed(levels):
        joined = joined.withColumn("mine", F.zip_with(f"at_{level}", "p", less)).withColumn("total", F.aggregate("mine", F.lit(0.0), lambda a, x: a + x))
        joined = joined.withColumn("prior", F.zip_with("mine", "prior", lambda n, q: (n + F.lit(STRENGTH) * q) / (F.col("total") + F.lit(STRENGTH))))
    says = F.zip_with(
        F.zip_with("at_declared", "p", less),
        F.zip_with(everywhere, F.col("p"), less),
        lambda n, all_: F.log((n + F.lit(ADDED)) / (all_ + F.lit(ADDED) * kinds)),
    )
    silent = F.array(*[F.lit(0.0)] * len(names))
    fused = joined.withColumn("said", F.when(F.col("declared") == "", silent).otherwise(says))
    fused = fused.withColumn("after", _posterior(F.zip_with(F.zip_with("text", "said", lambda a, b: a + b), F.transform("prior", lambda x: F.log(x)), lambda a, b: a + b)))
    array = F.array(*map(F.lit, names))
    top = lambda c: F.element_at(array, F.array_position(F.col(c), F.array_max(c)).cast("int"))
    return fused.select("row", top("after").alias("lang"), F.array_max("after").alias("confidence"), F.when(F.array_min("text") < 0, top("p")).alias("text_lang"), "declared", "host")


def digest(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Each page and each document with its language: ``page_id`` or ``doc_id``, the other null."""
    model = fit(docs)
    of_pages, of_docs = identify(evidence_of_pages(pages), model), identify(evidence_of_documents(docs), model)
    long, columns = F.lit(None).cast("long"), ["lang", "confidence", "text_lang"]
    return of_pages.select(long.alias("doc_id"), F.col("row").alias("page_id"), *columns).unionByName(of_docs.select(F.col("row").alias("doc_id"), long.alias("page_id"), *columns))
