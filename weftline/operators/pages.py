"""Page cleaning: filters, lines that repeat, boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import written
from . import vectors


def first_excerpts(pages: DataFrame, file: str, page: str, text: str, size: int = 400) -> DataFrame:
    """``(file, page, excerpt)``: the beginning of each file's first page."""
    first = F.min_by(F.struct(F.col(page).alias("page"), F.substring(text, 1, size).alias("excerpt")), page)
    return pages.groupBy(file).agg(first.alias("first")).select(file, F.col("first.page").alias(page), F.col("first.excerpt").alias("excerpt"))


def drop_reasons(pages: DataFrame, text: str, content_type: Column | None = None, blank: int = 80) -> DataFrame:
    """``pages`` with ``reason``: no_type, near_blank or kept."""
    case = F.when(F.length(tx.strip(F.col(text))) < blank, "near_blank").otherwise("kept")
    if content_type is not None:
        case = F.when(content_type.isNull(), "no_type").otherwise(case)
    return pages.withColumn("reason", case)


def repeated_lines(pages: DataFrame, file: str, text: str, share: float = 0.40) -> DataFrame:
    """``(file, line, pages)``: stripped lines on at least ``max(2, floor(share * pages))`` pages of a file; a line counts once a page."""
    counts = pages.groupBy(file).agg(F.count("*").alias("n"))
    each = pages.select(file, F.explode(F.array_distinct(F.transform(tx.lines(F.col(text)), tx.strip))).alias("line")).filter("line <> ''")
    seen = each.groupBy(file, "line").agg(F.count("*").alias("pages")).filter("pages >= 2")
    return seen.join(counts, file).filter(F.col("pages") >= F.greatest(F.lit(2), F.floor(F.col("n") * share))).select(file, "line", "pages")


def strip_repeated_lines(pages: DataFrame, file: str, text: str, share: float = 0.40) -> DataFrame:
    """``pages`` without those lines in ``text``, the others in order.

    A file has at most its mean number of lines a page over ``share`` of them,
    so its list stays small however many pages it has.
    """
    lists = repeated_lines(pages, file, text, share).groupBy(file).agg(F.collect_set("line").alias("__wl_gone"))
    gone = F.coalesce("__wl_gone", F.array().cast("array<string>"))
    kept = F.filter(tx.lines(F.col(text)), lambda x: ~F.array_contains(gone, tx.strip(x)))
    joined = pages.join(lists, file, "left").withColumn(text, F.when(F.col("__wl_gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")))
    return joined.select(*pages.columns)


def edge_pages(pages: DataFrame, file: str, page: str, each: int = 3) -> DataFrame:
    """The first and last ``each`` pages of each file: the ones that may be boilerplate."""
    up, down = Window.partitionBy(file).orderBy(F.asc(page)), Window.partitionBy(file).orderBy(F.desc(page))
    first, last = (pages.withColumn("__wl_at", F.row_number().over(w)).filter(F.col("__wl_at") <= each).drop("__wl_at") for w in (up, down))
    return first.unionByName(last).dropDuplicates([file, page])


def greedy_duplicates(candidates: DataFrame, file: str, key: str, vector: str, threshold: float = 0.95, rounds: int = 200) -> DataFrame:
    """``(key, kept)`` of candidates in order of ``key``: one goes if its cosine with an earlier kept one of another file reaches ``threshold``.

    Only pairs over the threshold are looked at. In each round those of which
    all earlier partners have gone are kept, and those with a kept earlier
    partner go; the rest waits. That is the sequential result, in as many rounds
    as the longest chain of partners has members. Rows without a vector are kept.
    """
    files = candidates.select(F.col(key).alias("k"), F.col(file).alias("f"))
    pairs = vectors.similar_pairs(candidates, key, vector, threshold).join(files.toDF("a", "fa"), "a").join(files.toDF("b", "fb"), "b").filter("fa <> fb").select("a", "b")
    pairs = written(pairs, "pairs")
    open_, gone = written(pairs.select(F.col("b").alias("n")).distinct(), "open"), None
    for _ in range(rounds):
        if open_.isEmpty():
            break
        waits = pairs.join(open_.toDF("a"), "a", "left_semi").select(F.col("b").alias("n")).distinct()
        lost = open_.toDF("a") if gone is None else open_.toDF("a").unionByName(gone.toDF("a"))
        hit = pairs.join(lost, "a", "left_anti").select(F.col("b").alias("n")).distinct()
        now = written(open_.join(hit, "n", "left_semi"), "gone")
        kept = open_.join(hit, "n", "left_anti").join(waits, "n", "left_anti")
        gone = written(now if gone is None else gone.unionByName(now), "gone")
        open_ = written(open_.join(now, "n", "left_anti").join(kept, "n", "left_anti"), "open")
    else:
        raise RuntimeError(f"candidates still wait for each other after {rounds} rounds")
    if gone is None:
        return candidates.select(key, F.lit(True).alias("kept"))
    return candidates.select(key).join(gone.select(F.col("n").alias(key), F.lit(False).alias("kept")), key, "left").select(key, F.coalesce("kept", F.lit(True)).alias("kept"))


def boilerplate(pages: DataFrame, file: str, page: str, text: str, embed, each: int = 3, size: int = 500, threshold: float = 0.95, least_pages: int = 10, least_candidates: int = 4) -> DataFrame:
    """``(file, page)`` of edge pages that go as near-duplicates of an earlier file's: of the first ``size`` characters, as ``embed`` makes vectors of them.

    Nothing goes from fewer than ``least_pages`` pages or ``least_candidates`` candidates.
    """
    edge = edge_pages(pages.select(file, page, F.substring(text, 1, size).alias("t")), file, page, each)
    if pages.limit(least_pages).count() < least_pages or edge.limit(least_candidates).count() < least_candidates:
        return edge.select(file, page).filter("false")
    named = written(edge.select(file, page, F.concat_ws("\x1f", file, F.format_string("%012d", F.col(page).cast("long"))).alias("k"), embed(F.col("t")).alias("v")), "edge-pages")
    return named.join(greedy_duplicates(named, file, "k", "v", threshold).filter("NOT kept"), "k", "left_semi").select(file, page)
