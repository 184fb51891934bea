"""Chunking: sections by headings, table-safe segments, splitting, links."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

TABLE_LINE = r"^\s*\|.*\|\s*$"
# Words of which a configuration table's header has one.
PARAMETER_HEADER = r"(?i)(SWS Item|ECUC Param|Parameter Name|Multiplicity|Type|Range|Description)"


def numbered_lines(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``(keys, n, line)``, lines numbered from 0."""
    return df.select(*keys, F.posexplode(tx.lines(F.col(text))).alias("n", "line"))


def islands(rows: DataFrame, keys: list[str], order: str, flag: Column) -> DataFrame:
    """``rows`` with ``flag`` and ``island``: runs of rows with the same flag, numbered from 0 within ``keys``."""
    w = Window.partitionBy(*keys).orderBy(order)
    marked = rows.withColumn("flag", flag)
    starts = F.when(F.lag("flag").over(w) == F.col("flag"), 0).otherwise(1)
    return marked.withColumn("starts", starts).withColumn("island", F.sum("starts").over(w) - 1).drop("starts")


def table_segments(df: DataFrame, keys: list[str], text: str, is_table: str = TABLE_LINE) -> DataFrame:
    """``(keys, island, is_table, first, size, segment)``: runs of table lines, which are never split, and runs of others."""
    runs = islands(numbered_lines(df, keys, text), keys, "n", F.col("line").rlike(is_table))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n")
    return runs.groupBy(*keys, "island", F.col("flag").alias("is_table")).agg(F.min("n").alias("first"), F.count("*").alias("size"), whole.alias("segment"))


def heading_sections(df: DataFrame, keys: list[str], text: str, heading: str = r"^(#{1,5})\s+(.*)$", levels: int = 5) -> DataFrame:
    """``(keys, section, h1..h5, body)``: a section begins with each heading, keeps its line, and carries the headings above; deeper ones are reset."""
    w = Window.partitionBy(*keys).orderBy("n")
    rows = numbered_lines(df, keys, text).withColumn("level", F.length(F.regexp_extract("line", heading, 1))).withColumn("title", tx.strip(F.regexp_extract("line", heading, 2)))
    rows = rows.withColumn("section", F.sum((F.col("level") > 0).cast("int")).over(w))
    for k in range(1, levels + 1):
        mark = F.when(F.col("level") == k, F.col("title")).when((F.col("level") > 0) & (F.col("level") < k), "")
        rows = rows.withColumn(f"h{k}", F.nullif(F.last(mark, ignorenulls=True).over(w), F.lit("")))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n")
    heads = [F.max_by(f"h{k}", "n").alias(f"h{k}") for k in range(1, levels + 1)]
    return rows.groupBy(*keys, "section").agg(*heads, body.alias("body"))


def fixed_stride(df: DataFrame, keys: list[str], text: str, size: int = 3024, overlap: int = 512) -> DataFrame:
    """``(keys, chunk_index, chunk)``: pieces of ``size`` characters, each ``overlap`` into the next; the last ends with the text."""
    step = size - overlap
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - size) / step)).cast("int")
    out = df.select(*keys, text, F.explode(F.sequence(F.lit(0), last)).alias("chunk_index"))
    return out.select(*keys, "chunk_index", F.substring(F.col(text), F.col("chunk_index") * step + 1, F.lit(size)).alias("chunk"))


def split_text(text: str, size: int = 3024, overlap: int = 512, separators: tuple[str, ...] = ("\n\n", "\n", ". ", " ", "")) -> list[str]:
    """Pieces of at most ``size`` characters, cut at the coarsest separator that does, joined again up to the size with up to ``overlap`` characters shared."""
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    sep, finer = separators[at], separators[at + 1 :]
    parts = list(text) if sep == "" else text.split(sep)
    out: list[str] = []
    held: list[str] = []

    def length(some: list[str]) -> int:
        return sum(map(len, some)) + len(sep) * max(0, len(some) - 1)

    def flush() -> None:
        if (joined := sep.join(held).strip()):
            out.append(joined)

    for part in parts:
        if len(part) > size and finer:
            flush()
            held = []
            out += split_text(part, size, overlap, finer)
            continue
        if held and length([*held, part]) > size:
            flush()
            while held and (length(held) > overlap or length([*held, part]) > size):
                held.pop(0)
        held.append(part)
    flush()
    return out


def recursive_chunks(df: DataFrame, keys: list[str], text: str, size: int = 3024, overlap: int = 512, keep_whole: int = 1200) -> DataFrame:
    """``(keys, chunk_index, chunk)``: a text of up to ``keep_whole`` estimated tokens stays whole, others are split recursively."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            cut = [[t] if max(1, len(t) // 4) <= keep_whole else split_text(t, size, overlap) for t in part.pop("chunk").fillna("")]
            part["chunk"] = cut
            part["chunk_index"] = [list(range(len(c))) for c in cut]
            yield part.explode(["chunk", "chunk_index"]).dropna(subset=["chunk_index"]).astype({"chunk_index": "int32"})[[*keys, "chunk_index", "chunk"]]

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema), "chunk_index int", "chunk string"])
    return df.select(*keys, F.col(text).alias("chunk")).mapInPandas(run, schema)


def chunk_links(chunks: DataFrame, file: str, order: list[str], chunk_id: str) -> DataFrame:
    """``chunks`` with ``prev_chunk_id`` and ``next_chunk_id`` within their file."""
    w = Window.partitionBy(file).orderBy(*order)
    return chunks.withColumn("prev_chunk_id", F.lag(chunk_id).over(w)).withColumn("next_chunk_id", F.lead(chunk_id).over(w))


def cells(line: Column, separator: str = "|") -> Column:
    """The stripped cells of a table line; one separator at either end is not a cell's."""
    bare = F.regexp_replace(tx.strip(line), r"^\|+|\|+$", "")
    return F.transform(F.split(bare, "\\" + separator), tx.strip)


def config_parameters(df: DataFrame, keys: list[str], text: str, header: str = PARAMETER_HEADER) -> DataFrame:
    """``(keys, island, n, name, type, multiplicity, range, description)`` of the rows of configuration tables.

    A table is a run of table and blank lines that begins with a table line in
    which ``header`` is found; columns go by words in the header, in order of
    preference. Rules and rows without a name are left out.
    """
    runs = islands(numbered_lines(df, keys, text), keys, "n", F.col("line").rlike(TABLE_LINE) | (tx.strip(F.col("line")) == ""))
    solid = runs.filter(F.col("flag") & ~F.col("line").rlike(r"^[\s|:-]*$"))
    w = Window.partitionBy(*keys, "island").orderBy("n")
    # The table begins at the first line of the run that reads like a header.
    begun = solid.withColumn("is_head", F.col("line").rlike(header)).withColumn("start", F.min(F.when(F.col("is_head"), F.col("n"))).over(Window.partitionBy(*keys, "island"))).filter(F.col("n") >= F.col("start"))
    rows = begun.withColumn("head", F.transform(F.first(cells(F.col("line"))).over(w), F.lower)).withColumn("cells", cells(F.col("line"))).filter((F.col("n") > F.col("start")) & (F.size("cells") >= 2))

    def column(*names: str) -> Column:
        where = [F.array_position(F.transform("head", _contains(name)), True).cast("int") for name in names]
        return F.coalesce(*[F.when((at > 0) & (at <= F.size("cells")), F.get("cells", at - 1)) for at in where], F.lit(""))

    return rows.select(
        *keys, "island", "n", column("name", "parameter", "sws item").alias("name"), column("type", "category").alias("type"),
        column("multiplicity", "mult").alias("multiplicity"), column("range", "value").alias("range"), column("description", "desc").alias("description"),
    ).filter("name <> ''")


def _contains(name: str):
    return lambda h: h.contains(name)


def without_tables(df: DataFrame, keys: list[str], text: str, header: str = PARAMETER_HEADER) -> DataFrame:
    """``(keys, text)`` without the configuration tables."""
    runs = islands(numbered_lines(df, keys, text), keys, "n", F.col("line").rlike(TABLE_LINE) | (tx.strip(F.col("line")) == ""))
    head = F.col("flag") & F.col("line").rlike(TABLE_LINE) & F.col("line").rlike(header)
    begun = runs.withColumn("start", F.min(F.when(head, F.col("n"))).over(Window.partitionBy(*keys, "island")))
    kept = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("start").isNull() | (F.col("n") < F.col("start")), F.struct("n", "line")))), lambda x: x["line"]), "\n")
    return begun.groupBy(*keys).agg(kept.alias(text))


def context_windows(hits: DataFrame, keys: list[str], start: str, size: str, length: str, window: int = 450, gap: int = 80) -> DataFrame:
    """``(keys, first, last)``: stretches of ``window`` characters round each hit, those up to ``gap`` apart as one; ``start`` counts from 0."""
    spans = hits.select(*keys, F.greatest(F.lit(0), F.col(start) - window).alias("a"), F.least(F.col(length), F.col(start) + F.col(size) + window).alias("b")).distinct()
    before = Window.partitionBy(*keys).orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    begun = spans.withColumn("new", (F.coalesce(F.col("a") > F.max("b").over(before) + gap, F.lit(True))).cast("int"))
    grouped = begun.withColumn("run", F.sum("new").over(Window.partitionBy(*keys).orderBy("a", "b")))
    return grouped.groupBy(*keys, "run").agg(F.min("a").alias("first"), F.max("b").alias("last")).drop("run")


def excerpts(pages: DataFrame, keys: list[str], text: str, at: str, size: int, window: int = 450, gap: int = 80, budget: int = 3500, fallback: int = 2500) -> DataFrame:
    """``(keys, excerpt)``: the stretches round the places ``at``, an array, joined by ``...`` up to ``budget`` characters; without a place the first ``fallback`` characters."""
    c = F.col(text)
    merged = F.aggregate(
        F.array_sort(F.transform(at, lambda x: F.struct(F.greatest(F.lit(0), x - window).alias("a"), F.least(F.length(c), x + size + window).alias("b")))),
        F.array().cast("array<struct<a:int,b:int>>"),
        lambda out, x: F.when((F.size(out) > 0) & (x["a"] <= F.element_at(out, -1)["b"] + gap), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(F.element_at(out, -1)["a"].alias("a"), F.greatest(F.element_at(out, -1)["b"], x["b"]).alias("b"))))).otherwise(F.concat(out, F.array(F.struct(x["a"].alias("a"), x["b"].alias("b"))))),
    )
    joined = F.array_join(F.transform(merged, lambda x: F.substr(c, x["a"] + 1, x["b"] - x["a"])), "\n...\n")
    return pages.select(*keys, F.when(F.coalesce(F.size(at), F.lit(0)) > 0, F.substring(joined, 1, budget)).otherwise(F.substring(text, 1, fallback)).alias("excerpt"))
