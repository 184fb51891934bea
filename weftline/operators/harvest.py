"""From pages to an identifier inventory and cross-references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids as idf


def mentions(pages: DataFrame, file: str, page: str, text: str, pattern: str = idf.PATTERN, group: int = 1) -> DataFrame:
    """``(file, page, pos, id)``: each page's distinct ids, in order of first sight."""
    return pages.select(file, page, F.posexplode(idf.find_ids(F.col(text), pattern, group)).alias("pos", "id"))


def inventory(found: DataFrame, modules: DataFrame, file: str, page: str, separator: str = "_") -> DataFrame:
    """``(id, id_type, module, first_file, first_page, occurrences, places)``: attributes by the first occurrence in order of file and page; ``places`` has each distinct file and page, in order.

    ``modules`` has ``(file, module)``; files without one are of module Unknown.
    """
    typed = found.join(modules.select(file, "module"), file, "left").withColumn("module", F.coalesce("module", F.lit("Unknown")))
    first = F.min(F.struct(F.col(file).alias("file"), F.col(page).alias("page"), "module")).alias("first")
    places = F.array_sort(F.collect_set(F.struct(F.col(file).alias("file"), F.col(page).alias("page")))).alias("places")
    out = typed.groupBy("id").agg(first, F.count("*").alias("occurrences"), places)
    return out.select("id", idf.id_type(F.col("id"), separator).alias("id_type"), idf.id_module(F.col("id"), F.col("first.module"), separator).alias("module"), F.col("first.file").alias("first_file"), F.col("first.page").alias("first_page"), "occurrences", "places")


def cooccurring(found: DataFrame, file: str, page: str, most: int = 15) -> DataFrame:
    """``(file, page, from_id, to_id)``: pairs, in order of sight, of the ids of a page that has at most ``most``.

    A page's ids come together as one array of bounded length, so pairs are made within a row.
    """
    packed = found.groupBy(file, page).agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("x")).filter(F.size("x") <= most)
    pairs = F.flatten(F.transform("x", lambda a, i: F.transform(F.slice("x", i + 2, F.size("x")), lambda b: F.struct(a["id"].alias("from_id"), b["id"].alias("to_id")))))
    return packed.select(file, page, F.explode(pairs).alias("p")).select(file, page, "p.from_id", "p.to_id")


def resolve_references(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs whose ends are both in the inventory ``known (id, module)``, once each, with ``cross_module``."""
    a, b = (known.select(F.col("id").alias(f"{e}_id"), F.col("module").alias(f"{e}_module")) for e in ("from", "to"))
    both = pairs.select("from_id", "to_id").distinct().join(a, "from_id").join(b, "to_id")
    return both.select("from_id", "to_id", (F.col("from_module") != F.col("to_module")).alias("cross_module"))


def first_chunks(found: DataFrame, file: str, page: str) -> DataFrame:
    """``(id, file, page)`` of the first place of each id."""
    return found.groupBy("id").agg(F.min(F.struct(F.col(file).alias("file"), F.col(page).alias("page"))).alias("f")).select("id", F.col("f.file").alias(file), F.col("f.page").alias(page))


def mention_edges(found: DataFrame, known: DataFrame, page: str) -> DataFrame:
    """``(src, dst)``: from chunks to the ids that are nodes."""
    return found.join(known.select("id"), "id", "left_semi").select(F.col(page).alias("src"), F.col("id").alias("dst")).distinct()
