"""Column expressions over page and chunk texts; all stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\v\f\r"

# What page classification looks for.
LEGAL_PHRASES = (
    "no part of this work may be reproduced",
    "published by autosar",
    "autosar e.v.",
    "use is subject to autosar",
    "this specification and the material",
)
TOC_HEADING = r"(?im)^#{1,4}\s*(table of contents|contents|index)\s*$"
TOC_LINE = r"^(.+\.{3,}\s*\d+\s*|.+\t\d+\s*)$"
DATE = r"(?i)\b\d{4}-\d{2}-\d{2}\b|\b\d{2}/\d{4}\b|\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?\s+\d{4}\b|\b\d{4}\b"
VERSION = r"(?i)\bv\d+\.\d+\b|\bRev\.?\s*\d+\b|\bIssue\s+\d+\b|\bR\d{2}-\d{2}\b"
GLOSSARY_HEADING = r"(?im)^#{1,4}\s*(glossary|abbreviations|acronyms|terms and definitions)\s*$"
BIBLIOGRAPHY_HEADING = r"(?im)^#{1,4}\s*(bibliography|references|normative references|informative references)\s*$"
CAPTION = r"(?i)^(Figure|Fig\.|Table|Exhibit|Appendix|Annex)\s+[\d\.]+"
OBLIGATION_WORDS = ("shall", "should", "may", "must")
EXPLANATION_WORDS = ("figure", "example", "note:", "rationale", "background")
WORD = r"[\p{L}\p{N}_]+"


def once(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` of a value that is computed once for a row, however often ``make`` uses it."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def strip(c: Column) -> Column:
    """Without white space at both ends, in time that follows the length."""
    return F.btrim(c, F.lit(SPACES))


def lines(c: Column) -> Column:
    """Lines that end with LF, CR LF or CR."""
    return F.split(F.when(c.contains("\r"), F.translate(F.replace(c, F.lit("\r\n"), F.lit("\n")), "\r", "\n")).otherwise(c), "\n")


def strip_inline_noise(c: Column) -> Column:
    """Without "N of M" counters and notes of omitted pictures; at most one empty line in a row."""
    c = F.regexp_replace(c, r"\b\d{1,4}\s+of\s+\d{1,4}\b\s*\n?", "")
    c = F.regexp_replace(c, r"(?i)==>.*?(?:omitted|intentionally omitted).*?<==\s*\n?", "")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def normalize_whitespace(c: Column) -> Column:
    """At most one empty line in a row, no blanks at the ends of lines or of the text."""
    return strip(F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r"(?m)[ \t]+$", ""))


def inline_clean(c: Column) -> Column:
    """Without lines that are only a page number, a table rule or a confidentiality notice, and with ``<br>`` as a blank."""
    noise = r"(?i)^\s*(page\s+)?\d{1,4}\s*$|^\s*\|?[\s:|-]*-{3,}[\s:|-]*\|?\s*$|^\s*[-– ]*confidential[-– ]*\s*$"
    kept = F.filter(lines(c), lambda x: ~x.rlike(noise))
    return F.regexp_replace(F.array_join(kept, "\n"), r"(?i)<br\s*/?>", " ")


def token_estimate(c: Column) -> Column:
    """A token for each four characters, one at least."""
    return F.greatest(F.lit(1), F.floor(F.length(c) / 4)).cast("bigint")


def page_class(c: Column, blank: int = 80, toc_ratio: float = 0.50, revision_ratio: float = 0.40, diagram: int = 200) -> Column:
    """The first class that fits: near_blank, legal_boilerplate, toc_heading, toc_content, revision_history, diagram, glossary, bibliography, content.

    Lines are cut once. A table of contents has dots or a tab in its lines, a
    date or version a digit, a heading a hash: only what has those is matched.
    """
    some = F.filter(F.transform(lines(c), strip), lambda x: x != "")
    share = lambda found, hit: F.when(F.size(found) > 0, F.size(F.filter(found, hit)) / F.size(found))
    toc = lambda x: (x.contains("...") | x.contains("\t")) & x.rlike(TOC_LINE)
    dated = lambda x: x.rlike("[0-9]") & x.rlike(f"(?:{DATE})|(?:{VERSION})")

    def by_lines(found: Column) -> Column:
        return F.when(share(found, toc) >= toc_ratio, "toc_content").when(share(found, dated) >= revision_ratio, "revision_history")

    legal = once(F.lower(c), lambda low: F.array_contains(F.array(*[low.contains(p) for p in LEGAL_PHRASES]), True))
    size, headed = F.length(strip(c)), c.contains("#")
    return (
        F.when(size < blank, "near_blank")
        .when(legal, "legal_boilerplate")
        .when(headed & c.rlike(TOC_HEADING), "toc_heading")
        .otherwise(
            F.coalesce(
                once(some, by_lines),
                F.when(size < diagram, "diagram").when(headed & c.rlike(GLOSSARY_HEADING), "glossary").when(headed & c.rlike(BIBLIOGRAPHY_HEADING), "bibliography").otherwise("content"),
            )
        )
    )


def drop_orphan_captions(c: Column, longest: int = 40) -> Column:
    """Without short caption lines that have blank lines, or nothing, on both sides."""

    def over(both: Column) -> Column:
        all_, bare = both["lines"], both["bare"]
        blank = lambda i: F.element_at(bare, i) == ""

        def keep(x: Column, i: Column) -> Column:
            caption = once(F.element_at(bare, i + 1), lambda y: (F.length(y) <= longest) & y.rlike(CAPTION))
            alone = ((i == 0) | blank(F.greatest(i, F.lit(1)))) & ((i == F.size(all_) - 1) | blank(F.least(i + 2, F.size(all_))))
            return ~(caption & alone)

        return F.array_join(F.filter(all_, keep), "\n")

    return once(once(lines(c), lambda all_: F.struct(all_.alias("lines"), F.transform(all_, strip).alias("bare"))), over)


def embedding(c: Column, size: int = 64) -> Column:
    """A stand-in for a model's vector: counts of words by a hash, of length 1. Null for a text without words."""
    slot = lambda w: F.conv(F.substring(F.md5(w), 1, 4), 16, 10).cast("int") % size
    slots = F.transform(F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0)), slot)
    counts = once(slots, lambda some: F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.size(F.filter(some, lambda x: x == i)).cast("double")))
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    return once(F.struct(counts.alias("v")), lambda d: once(norm(d["v"]), lambda n: F.when(n > 0, F.transform(d["v"], lambda x: x / n))))


def quality_reason(c: Column, min_tokens: int = 40, min_unique: float = 0.30, min_body: int = 30) -> Column:
    """Why a chunk fails the quality gate (few_tokens, repetitive, only_headings), or pass."""

    def reason(c: Column) -> Column:
        words = F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))
        repetitive = once(words, lambda found: (F.size(found) > 0) & (F.size(F.array_distinct(found)) / F.size(found) < min_unique))
        body = F.when(c.contains("#") | c.contains("\r"), F.array_join(F.filter(lines(c), lambda x: ~x.startswith("#")), "\n")).otherwise(c)
        return F.when(token_estimate(c) < min_tokens, "few_tokens").when(repetitive, "repetitive").when(F.length(strip(body)) < min_body, "only_headings").otherwise("pass")

    return once(c, reason)


def chunk_class(c: Column, ids: Column, page_class: Column, constraint_first: bool = False) -> Column:
    """The first class that fits; substrings count, not words. A constraint's marker is an id too, so it has a class of its own only with ``constraint_first``."""
    has = lambda some: F.lower(c).rlike("|".join(some))
    constraint = c.rlike(r"\[constr_\d{4}\]")
    case = F.when(page_class == "glossary", "glossary").when(page_class == "bibliography", "bibliography")
    if constraint_first:
        case = case.when(constraint, "constraint_chunk")
    return case.when(F.size(ids) > 0, "requirement_chunk").when(constraint, "constraint_chunk").when(has(OBLIGATION_WORDS), "requirement_chunk").when(has(EXPLANATION_WORDS), "explanatory_chunk").otherwise("general_chunk")


def safe_node_id(label: Column, name: Column) -> Column:
    """``label_name``, lower case, blanks as underscores, nothing but ``a-z0-9_``, 60 characters of the name."""
    name = F.regexp_replace(F.regexp_replace(F.lower(name), r"\s+", "_"), r"[^a-z0-9_]", "")
    return F.concat(F.lower(label), F.lit("_"), F.substring(name, 1, 60))


def chunk_id(stem: Column, page: Column, index: Column, path: Column | None = None) -> Column:
    """``stem[_hash]_pNNNN_cNNN``; a path sets apart files of the same stem."""
    head = F.substring(F.regexp_replace(stem, r"[^A-Za-z0-9_]", "_"), 1, 60)
    if path is not None:
        head = F.concat(head, F.lit("_"), F.substring(F.md5(path), 1, 6))
    return F.concat(head, F.format_string("_p%04d_c%03d", page.cast("int"), index.cast("int")))


def clean_body(c: Column) -> Column:
    """A body that a model gave: no quotes around it, white space collapsed; null for words that mean nothing."""
    c = strip(F.regexp_replace(F.regexp_replace(c, r"\s+", " "), r"""^["'\s]+|["'\s]+$""", ""))
    return F.when(~F.lower(c).isin("", "null", "none", "n/a", "unknown"), c)


def parse_noisy_json(c: Column) -> Column:
    """The JSON text in a model's answer: without fences, from the first bracket to the last of its kind, where it parses; else null."""
    bare = strip(F.regexp_replace(c, r"(?m)^\s*```[a-zA-Z]*\s*$|```(?:json)?", ""))
    block = F.regexp_extract(bare, r"(?s)(\{.*\}|\[.*\])", 1)
    valid = lambda x: F.try_parse_json(x).isNotNull()
    return F.when((bare != "") & valid(bare), bare).when((block != "") & valid(block), block)
