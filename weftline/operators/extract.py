"""Rules that stand where a model may: entities from a list of names, glossary terms, relations, cross-references, chunk fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import once
from ..session import pieces, table_bytes, written

#: Words of the longest name that a list of names is looked up with.
LONGEST = 4
#: Bytes of a list of names, as stored, that is broadcast.
_LIST = 4 << 20
NAME_WORD = r"[\p{L}\p{N}_]+"
TERM = r"(?m)^\s*[*#-]*\s*\**([\p{Lu}][\p{L}\p{N} _/-]{1,60}?)\**\s*(?::|[–—]|\s-)\s+(\S.{9,})$"
STRUCTURAL = ("glossary", "bibliography", "requirement_chunk", "constraint_chunk")


def word_runs(text: Column, longest: int = LONGEST) -> Column:
    """The distinct runs of one to ``longest`` words of a text, in lower case, blanks between words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(NAME_WORD), F.lit(0))

    def of(w: Column, n: int) -> Column:
        return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " ")))

    def runs(w: Column) -> Column:
        return F.array_distinct(F.flatten(F.array_compact(F.array(*[of(w, n) for n in range(1, longest + 1)]))))

    return once(words, runs)


def gazetteer(texts: DataFrame, key: str, text: str, names: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``(key, name, label)``: the names of ``names (name, label)`` that a text has as whole words, in any case.

    Texts give their word runs, and an equi-join finds those that are names: the
    list may be of any size, and is broadcast up to ``_LIST`` bytes. A name of
    more than ``longest`` words is never found.
    """
    known = names.select("name", "label", F.array_join(F.regexp_extract_all(F.lower("name"), F.lit(NAME_WORD), F.lit(0)), " ").alias("run")).filter("run <> ''")
    known = written(known.distinct(), "names")
    runs = texts.select(key, F.explode(word_runs(F.col(text), longest)).alias("run"))
    # Runs are many more than their texts' size lets Spark think, so they are never the side to broadcast.
    met = runs.join(F.broadcast(known), "run") if table_bytes(known) <= _LIST else runs.hint("merge").join(known, "run")
    # Dealt out by text before repeats are dropped, so no task holds those of many texts.
    return met.select(key, "name", "label").repartition(pieces(texts.select(key, text)), key).distinct()


def glossary_terms(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``(keys, term, definition)`` of the lines of a glossary that say ``Term: definition``, or so with a dash."""
    terms, said = (F.regexp_extract_all(text, F.lit(TERM), F.lit(g)) for g in (1, 2))
    pairs = F.zip_with(terms, said, lambda a, b: F.struct(F.trim(a).alias("term"), F.trim(b).alias("definition")))
    return texts.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.term", "p.definition")


def validate_references(pairs: DataFrame, pages: DataFrame, file: str, page: str, text: str) -> DataFrame:
    """``pairs (file, page, from_id, to_id)`` whose ids stand in one line of the page; where a page is missing its pairs are kept."""
    lines = pages.select(file, page, F.split(F.replace(F.col(text), F.lit("\r"), F.lit("")), "\n").alias("__wl_lines"))
    joined = pairs.join(lines, [file, page], "left")
    together = F.exists("__wl_lines", lambda x: F.contains(x, F.col("from_id")) & F.contains(x, F.col("to_id")))
    return joined.filter(F.coalesce(together, F.lit(True))).select(*pairs.columns)


def validate_relations(relations: DataFrame, texts: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``relations (key, src_name, dst_name, ...)`` of which both names occur in their text, and the rest; a relation without a text is kept."""
    joined = relations.join(texts.select(key, F.lower(text).alias("__wl_text")), key, "left")
    both = F.coalesce(F.contains(F.col("__wl_text"), F.lower("src_name")) & F.contains(F.col("__wl_text"), F.lower("dst_name")), F.lit(True))
    return joined.filter(both).select(*relations.columns), joined.filter(~both).select(*relations.columns)


def revalidated(rows: DataFrame, kind: Column, check, keys: list[str]) -> DataFrame:
    """``rows`` of which those of a ``kind`` are replaced by what ``check`` makes of them; the others, by key, stay."""
    checked = rows.filter(kind)
    return rows.join(checked.select(*keys), keys, "left_anti").unionByName(check(checked))


def cooccurring_names(found: DataFrame, key: str, most: int = 15) -> DataFrame:
    """``(key, src_name, dst_name)``: pairs of names found in one text that has at most ``most``, in order of the alphabet."""
    packed = found.groupBy(key).agg(F.array_sort(F.collect_set("name")).alias("x")).filter(F.size("x").between(2, most))
    pairs = F.flatten(F.transform("x", lambda a, i: F.transform(F.slice("x", i + 2, F.size("x")), lambda b: F.struct(a.alias("src_name"), b.alias("dst_name")))))
    return packed.select(key, F.explode(pairs).alias("p")).select(key, "p.src_name", "p.dst_name")


def enrich(chunks: DataFrame, text: str, kind: str, least: int = 30, size: int = 200) -> DataFrame:
    """``chunks`` with ``summary``, ``normative``, ``topic`` and ``enriched_type``: the first sentence, the strongest word of obligation, the first heading or words.

    Texts of ``least`` characters or fewer get nulls; summaries and topics have
    ``size`` characters at most; a structural class is never overwritten.
    """
    c, long = F.col(text), F.length(text) > least
    sentence = F.regexp_extract(F.trim(F.regexp_replace(c, r"\s+", " ")), r"^(.+?[.!?])(?:\s|$)", 1)
    summary = F.substring(F.when(sentence != "", sentence).otherwise(F.trim(F.regexp_replace(c, r"\s+", " "))), 1, size)
    force = F.when(c.rlike(r"(?i)\b(shall|must)\b"), "SHALL").when(c.rlike(r"(?i)\bshould\b"), "SHOULD").when(c.rlike(r"(?i)\bmay\b"), "MAY")
    heading = F.regexp_extract(c, r"(?m)^#{1,6}\s+(.+)$", 1)
    topic = F.substring(F.when(heading != "", heading).otherwise(F.array_join(F.slice(F.regexp_extract_all(c, F.lit(NAME_WORD), F.lit(0)), 1, 6), " ")), 1, size)
    guess = F.when(force.isNotNull(), "requirement_chunk").when(c.rlike(r"(?i)\b(figure|example|note|rationale|background)\b"), "explanatory_chunk").otherwise(F.col(kind))
    return chunks.withColumns({
        "summary": F.when(long, summary), "normative": F.when(long, force), "topic": F.when(long, topic),
        "enriched_type": F.when(F.col(kind).isin(*STRUCTURAL) | ~long, F.col(kind)).otherwise(guess),
    })


def batches(pairs: DataFrame, by: list[str], size: int = 30) -> DataFrame:
    """``(by, batch, items)``: the rows of each group in order, ``size`` to a batch, as a model is asked about them."""
    rest = [c for c in pairs.columns if c not in by]
    listed = F.array_sort(F.collect_list(F.struct(*rest)))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("x") - 1) / size).cast("int")), lambda i: F.slice("x", i * size + 1, size))
    return pairs.groupBy(*by).agg(listed.alias("x")).select(*by, F.posexplode(cut).alias("batch", "items"))
