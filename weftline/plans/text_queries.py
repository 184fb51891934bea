"""Queries over page texts: ``documents.source`` is the file and ``doc_id`` the page."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import chunks, pages
from .catalog import query

LINES = "regexp_split_to_array(text, '\\r\\n|\\n|\\r')"
STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')".format
LICENCE = ("license", "licence", "copyright", "all rights reserved")
REPEATED = f"""
    pages AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    each AS (SELECT DISTINCT source, doc_id, {STRIP('line')} AS line FROM (SELECT source, doc_id, unnest({LINES}) AS line FROM documents)),
    rep AS (SELECT e.source, e.line, count(*) AS pages FROM each e JOIN pages p USING (source) WHERE e.line <> ''
            GROUP BY e.source, e.line, p.n HAVING count(*) >= greatest(2, CAST(floor(p.n * 0.10) AS BIGINT)))"""
STRIPPED = f"""WITH {REPEATED}, gone AS (SELECT source, list(line) AS lines FROM rep GROUP BY source),
    done AS (SELECT d.doc_id, d.source, array_to_string([x FOR x IN {LINES.replace('text', 'd.text')} IF NOT list_contains(coalesce(g.lines, []), {STRIP('x')})], chr(10)) AS text
             FROM documents d LEFT JOIN gone g USING (source))"""
WORDS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')"
BODY = f"array_to_string([x FOR x IN {LINES} IF NOT starts_with(x, '#')], chr(10))"
GATE = f"""CASE WHEN greatest(1, length(text) // 4) < 40 THEN 'few_tokens'
    WHEN len({WORDS}) > 0 AND len(list_distinct({WORDS})) / len({WORDS}) < 0.30 THEN 'repetitive'
    WHEN length({STRIP(BODY)}) < 30 THEN 'only_headings' ELSE 'pass' END"""


@query("SELECT doc_id, source, lang, n_chars, CAST(length(text) AS BIGINT) AS char_count FROM documents")
def scan_documents(t):
    return t.documents.select("doc_id", "source", "lang", "n_chars", F.length("text").cast("long").alias("char_count"))


@query("SELECT source, min(doc_id) AS doc_id, arg_min(substr(text, 1, 400), doc_id) AS excerpt FROM documents GROUP BY source")
def first_page_excerpt(t):
    return pages.first_excerpts(t.documents, "source", "doc_id", "text")


REASON = f"CASE WHEN length({STRIP('text')}) < 80 THEN 'near_blank' ELSE 'kept' END"


@query(f"SELECT doc_id, source, {REASON} AS reason FROM documents")
def page_filter(t):
    return pages.drop_reasons(t.texts("doc_id", "source", "text"), "text").select("doc_id", "source", "reason")


@query(f"SELECT source, {REASON} AS reason, count(*) AS pages FROM documents GROUP BY ALL")
def drop_counts(t):
    return pages.drop_reasons(t.texts("source", "text"), "text").groupBy("source", "reason").agg(F.count("*").alias("pages"))


def _share(pattern: str) -> str:
    some = f"[{STRIP('x')} FOR x IN {LINES} IF {STRIP('x')} <> '']"
    return f"(len([y FOR y IN {some} IF regexp_matches(y, '{pattern}')]) / len({some}))"


CLASS = f"""CASE WHEN length({STRIP('text')}) < 80 THEN 'near_blank'
    WHEN {' OR '.join(f"contains(lower(text), '{p}')" for p in tx.LEGAL_PHRASES)} THEN 'legal_boilerplate'
    WHEN regexp_matches(text, '{tx.TOC_HEADING}') THEN 'toc_heading'
    WHEN {_share(tx.TOC_LINE)} >= 0.50 THEN 'toc_content'
    WHEN {_share(f'(?:{tx.DATE})|(?:{tx.VERSION})')} >= 0.40 THEN 'revision_history'
    WHEN length({STRIP('text')}) < 200 THEN 'diagram'
    WHEN regexp_matches(text, '{tx.GLOSSARY_HEADING}') THEN 'glossary'
    WHEN regexp_matches(text, '{tx.BIBLIOGRAPHY_HEADING}') THEN 'bibliography' ELSE 'content' END"""


@query(f"SELECT doc_id, {CLASS} AS page_class FROM documents")
def page_classify(t):
    return t.texts("doc_id", "text").select("doc_id", tx.page_class(F.col("text")).alias("page_class"))


@query(f"SELECT page_class, count(*) AS pages FROM (SELECT {CLASS} AS page_class FROM documents) GROUP BY 1")
def page_class_counts(t):
    return t.texts("text").select(tx.page_class(F.col("text")).alias("page_class")).groupBy("page_class").agg(F.count("*").alias("pages"))


@query(f"""SELECT doc_id, CAST(n - 1 AS BIGINT) AS line_no, line FROM (SELECT doc_id, unnest({LINES}) AS line, generate_subscripts({LINES}, 1) AS n FROM documents)
    WHERE regexp_matches(lower(line), '{"|".join(LICENCE)}')""")
def license_lines(t):
    return chunks.numbered_lines(t.texts("doc_id", "text"), ["doc_id"], "text").filter(F.lower("line").rlike("|".join(LICENCE))).select("doc_id", F.col("n").cast("long").alias("line_no"), "line")


@query(f"WITH {REPEATED} SELECT source, line, pages FROM rep")
def repeated_lines(t):
    return pages.repeated_lines(t.texts("source", "text"), "source", "text", 0.10)


@query(STRIPPED + " SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, md5(text) AS digest FROM done")
def strip_repeated_lines(t):
    return pages.strip_repeated_lines(t.texts("doc_id", "source", "text"), "source", "text", 0.10).select("doc_id", F.length("text").cast("long").alias("chars"), F.md5("text").alias("digest"))


@query(STRIPPED + f", gated AS (SELECT source, {GATE} AS gate, greatest(1, length(text) // 4) AS tokens FROM done) SELECT source, count(*) AS pages, CAST(sum(tokens) AS BIGINT) AS tokens FROM gated WHERE gate = 'pass' GROUP BY source")
def quality_by_source(t):
    clean = pages.strip_repeated_lines(t.texts("doc_id", "source", "text"), "source", "text", 0.10)
    return clean.filter(tx.quality_reason(F.col("text")) == "pass").groupBy("source").agg(F.count("*").alias("pages"), F.sum(tx.token_estimate(F.col("text"))).alias("tokens"))


def _noise(c: str) -> str:
    c = f"regexp_replace({c}, '\\b\\d{{1,4}}\\s+of\\s+\\d{{1,4}}\\b\\s*\\n?', '', 'g')"
    c = f"regexp_replace({c}, '(?i)==>.*?(?:omitted|intentionally omitted).*?<==\\s*\\n?', '', 'g')"
    return STRIP(f"regexp_replace({c}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


@query(f"SELECT doc_id, CAST(length(x) AS BIGINT) AS chars, md5(x) AS digest FROM (SELECT doc_id, {_noise('text')} AS x FROM documents)")
def strip_inline_noise(t):
    return t.texts("doc_id", "text").select("doc_id", tx.strip_inline_noise(F.col("text")).alias("x")).select("doc_id", F.length("x").cast("long").alias("chars"), F.md5("x").alias("digest"))


@query(f"""SELECT doc_id, CAST(length(x) AS BIGINT) AS chars, md5(x) AS digest FROM (SELECT doc_id,
    {STRIP("regexp_replace(regexp_replace(text, chr(10) || '{3,}', chr(10) || chr(10), 'g'), '(?m)[ " + chr(92) + "t]+$', '', 'g')")} AS x FROM documents)""")
def normalize_whitespace(t):
    return t.texts("doc_id", "text").select("doc_id", tx.normalize_whitespace(F.col("text")).alias("x")).select("doc_id", F.length("x").cast("long").alias("chars"), F.md5("x").alias("digest"))


INLINE_NOISE = r"(?i)^\s*(page\s+)?\d{1,4}\s*$|^\s*\|?[\s:|-]*-{3,}[\s:|-]*\|?\s*$|^\s*[-– ]*confidential[-– ]*\s*$"


@query(f"""SELECT doc_id, md5(regexp_replace(array_to_string([x FOR x IN {LINES} IF NOT regexp_matches(x, '{INLINE_NOISE}')], chr(10)), '(?i)<br\\s*/?>', ' ', 'g')) AS digest FROM documents""")
def inline_clean(t):
    return t.texts("doc_id", "text").select("doc_id", F.md5(tx.inline_clean(F.col("text"))).alias("digest"))


@query(f"""WITH l AS (SELECT doc_id, unnest({LINES}) AS line, generate_subscripts({LINES}, 1) AS n FROM documents),
    w AS (SELECT *, coalesce({STRIP('lag(line) OVER p')}, '') AS before, coalesce({STRIP('lead(line) OVER p')}, '') AS after FROM l WINDOW p AS (PARTITION BY doc_id ORDER BY n))
    SELECT doc_id, md5(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT (length({STRIP('line')}) <= 40 AND regexp_matches({STRIP('line')}, '{tx.CAPTION}') AND before = '' AND after = '')), '')) AS digest
    FROM w GROUP BY doc_id""")
def orphan_captions(t):
    return t.texts("doc_id", "text").select("doc_id", F.md5(tx.drop_orphan_captions(F.col("text"))).alias("digest"))


@query("SELECT doc_id, CAST(greatest(1, length(text) // 4) AS BIGINT) AS tokens FROM documents")
def token_estimate(t):
    return t.documents.select("doc_id", tx.token_estimate(F.col("text")).alias("tokens"))


@query(f"SELECT doc_id, {GATE} AS gate FROM documents")
def quality_gate(t):
    return t.texts("doc_id", "text").select("doc_id", tx.quality_reason(F.col("text")).alias("gate"))


MAILS = "list_distinct(regexp_extract_all(text, '\\d+@mail\\d'))"
CHUNK_CLASS = f"""CASE WHEN page_class = 'glossary' THEN 'glossary' WHEN page_class = 'bibliography' THEN 'bibliography' WHEN len({MAILS}) > 0 THEN 'requirement_chunk'
    WHEN regexp_matches(text, '\\[constr_\\d{{4}}\\]') THEN 'constraint_chunk' WHEN regexp_matches(lower(text), '{"|".join(tx.OBLIGATION_WORDS)}') THEN 'requirement_chunk'
    WHEN regexp_matches(lower(text), '{"|".join(tx.EXPLANATION_WORDS)}') THEN 'explanatory_chunk' ELSE 'general_chunk' END"""


def _chunk_class():
    return tx.chunk_class(F.col("text"), F.regexp_extract_all("text", F.lit(r"\d+@mail\d"), F.lit(0)), tx.page_class(F.col("text"))).alias("chunk_class")


@query(f"SELECT doc_id, {CHUNK_CLASS} AS chunk_class FROM (SELECT *, {CLASS} AS page_class FROM documents)")
def chunk_classify(t):
    return t.texts("doc_id", "text").select("doc_id", _chunk_class())


@query(f"SELECT chunk_class, count(*) AS chunks FROM (SELECT {CHUNK_CLASS} AS chunk_class FROM (SELECT *, {CLASS} AS page_class FROM documents)) GROUP BY 1")
def chunk_type_counts(t):
    return t.texts("text").select(_chunk_class()).groupBy("chunk_class").agg(F.count("*").alias("chunks"))


STRIDE = """SELECT doc_id, source, CAST(i AS BIGINT) AS chunk_index, substr(text, CAST(i AS BIGINT) * 2512 + 1, 3024) AS chunk FROM (
    SELECT doc_id, source, text, unnest(generate_series(0, greatest(0, CAST(ceil((length(text) - 3024) / 2512) AS BIGINT)))) AS i FROM documents)"""
CHUNK_ID = "concat(source, '_', substr(md5(lang), 1, 6), '_p', lpad(CAST(doc_id AS VARCHAR), CAST(greatest(4, length(CAST(doc_id AS VARCHAR))) AS INT), '0'), '_c', lpad(CAST(chunk_index AS VARCHAR), CAST(greatest(3, length(CAST(chunk_index AS VARCHAR))) AS INT), '0'))"


@query(f"SELECT doc_id, chunk_index, CAST(length(chunk) AS BIGINT) AS chars, md5(chunk) AS digest FROM ({STRIDE})")
def fixed_stride_chunks(t):
    return chunks.fixed_stride(t.texts("doc_id", "text"), ["doc_id"], "text").select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.length("chunk").cast("long").alias("chars"), F.md5("chunk").alias("digest"))


@query(f"SELECT doc_id, chunk_index, {CHUNK_ID} AS chunk_id FROM (SELECT s.*, d.lang FROM ({STRIDE}) s JOIN (SELECT doc_id, lang FROM documents) d USING (doc_id))")
def chunk_ids(t):
    cut = chunks.fixed_stride(t.documents, ["doc_id", "source", "lang"], "text")
    return cut.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), tx.chunk_id(F.col("source"), F.col("doc_id"), F.col("chunk_index"), F.col("lang")).alias("chunk_id"))


KEPT_CHUNKS = f"SELECT source, doc_id, chunk_index, concat(source, '_p', lpad(CAST(doc_id AS VARCHAR), CAST(greatest(4, length(CAST(doc_id AS VARCHAR))) AS INT), '0'), '_c', lpad(CAST(chunk_index AS VARCHAR), 3, '0')) AS chunk_id FROM (SELECT *, chunk AS text FROM ({STRIDE})) WHERE {GATE} = 'pass'"


@query(f"SELECT chunk_id, lag(chunk_id) OVER w AS prev_chunk_id, lead(chunk_id) OVER w AS next_chunk_id FROM ({KEPT_CHUNKS}) WINDOW w AS (PARTITION BY source ORDER BY doc_id, chunk_index)")
def chunk_links(t):
    cut = chunks.fixed_stride(t.texts("doc_id", "source", "text"), ["doc_id", "source"], "text").filter(tx.quality_reason(F.col("chunk")) == "pass")
    named = cut.select("source", "doc_id", "chunk_index", tx.chunk_id(F.col("source"), F.col("doc_id"), F.col("chunk_index")).alias("chunk_id"))
    return chunks.chunk_links(named, "source", ["doc_id", "chunk_index"], "chunk_id").select("chunk_id", "prev_chunk_id", "next_chunk_id")


@query(f"""WITH l AS (SELECT doc_id, unnest({LINES}) AS line, generate_subscripts({LINES}, 1) AS n FROM documents),
    h AS (SELECT *, regexp_matches(line, '^Licensed under') AS head FROM l), s AS (SELECT *, sum(CAST(head AS INT)) OVER (PARTITION BY doc_id ORDER BY n) AS section FROM h)
    SELECT doc_id, CAST(section AS BIGINT) AS section, max(CASE WHEN head THEN {STRIP("regexp_extract(line, '^(L)icensed (.*)$', 2)")} END) AS h1, md5(string_agg(line, chr(10) ORDER BY n)) AS digest FROM s GROUP BY doc_id, section""")
def heading_sections(t):
    cut = chunks.heading_sections(t.texts("doc_id", "text"), ["doc_id"], "text", r"^(L)icensed (under.*)$", 1)
    return cut.select("doc_id", F.col("section").cast("long").alias("section"), "h1", F.md5("body").alias("digest"))


PIPED = f"""WITH l AS (SELECT doc_id, unnest({LINES}) AS line, generate_subscripts({LINES}, 1) - 1 AS n FROM documents), f AS (SELECT *, regexp_matches(line, '\\|') AS flag FROM l),
    s AS (SELECT *, CASE WHEN lag(flag) OVER w = flag THEN 0 ELSE 1 END AS new FROM f WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
    i AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY n) - 1 AS island FROM s)"""


@query(PIPED + " SELECT doc_id, CAST(island AS BIGINT) AS island, flag AS is_table, CAST(min(n) AS BIGINT) AS first, count(*) AS size, md5(string_agg(line, chr(10) ORDER BY n)) AS digest FROM i GROUP BY doc_id, island, flag")
def table_segments(t):
    cut = chunks.table_segments(t.texts("doc_id", "text"), ["doc_id"], "text", r"\|")
    return cut.select("doc_id", F.col("island").cast("long").alias("island"), "is_table", F.col("first").cast("long").alias("first"), "size", F.md5("segment").alias("digest"))


@query(PIPED + f""" SELECT doc_id, CAST(n AS BIGINT) AS n, CAST(i AS BIGINT) AS cell_no, {STRIP('cell')} AS cell FROM (
    SELECT doc_id, n, unnest(c) AS cell, generate_subscripts(c, 1) - 1 AS i FROM (SELECT doc_id, n, string_split(regexp_replace({STRIP('line')}, '^\\|+|\\|+$', '', 'g'), '|') AS c FROM i WHERE flag))""")
def pipe_tables(t):
    rows = chunks.numbered_lines(t.texts("doc_id", "text"), ["doc_id"], "text").filter(F.col("line").contains("|"))
    return rows.select("doc_id", F.col("n").cast("long").alias("n"), F.posexplode(chunks.cells(F.col("line"))).alias("i", "cell")).select("doc_id", "n", F.col("i").cast("long").alias("cell_no"), "cell")


@query("""WITH m AS (SELECT doc_id, length(text) AS len, text, unnest(list_distinct(regexp_extract_all(text, '\\d+@mail\\d'))) AS hit FROM documents),
    s AS (SELECT DISTINCT doc_id, greatest(0, strpos(text, hit) - 1 - 450) AS a, least(len, strpos(text, hit) - 1 + length(hit) + 450) AS b FROM m),
    r AS (SELECT *, CASE WHEN a > max(b) OVER (PARTITION BY doc_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 80 OR row_number() OVER (PARTITION BY doc_id ORDER BY a, b) = 1 THEN 1 ELSE 0 END AS new FROM s),
    g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY a, b) AS run FROM r) SELECT doc_id, CAST(min(a) AS BIGINT) AS first, CAST(max(b) AS BIGINT) AS last FROM g GROUP BY doc_id, run""")
def context_windows(t):
    hits = t.texts("doc_id", "text").select("doc_id", "text", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\d+@mail\d"), F.lit(0)))).alias("hit"))
    hits = hits.select("doc_id", (F.instr("text", F.col("hit")) - 1).alias("at"), F.length("hit").alias("size"), F.length("text").alias("len"))
    return chunks.context_windows(hits, ["doc_id"], "at", "size", "len").select("doc_id", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"))


EDGE = "SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS u, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS d FROM documents"


@query(f"SELECT source, doc_id, md5(substr(text, 1, 500)) AS digest FROM ({EDGE}) WHERE u <= 3 OR d <= 3")
def boilerplate_candidates(t):
    return pages.edge_pages(t.documents.select("source", "doc_id", "text"), "source", "doc_id").select("source", "doc_id", F.md5(F.substring("text", 1, 500)).alias("digest"))


@query("SELECT doc_id, source, lang, md5(text) AS digest FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def dedup_nodes(t):
    keyed = t.documents.select("doc_id", "source", "lang", F.sha2("text", 256).alias("key"), F.md5("text").alias("digest"))
    first = keyed.groupBy("key").agg(F.min_by(F.struct("doc_id", "source", "lang", "digest"), "doc_id").alias("f"))
    return first.select("f.*")


EMBED = "[CAST(len([x FOR x IN slots IF x = i]) AS DOUBLE) FOR i IN range(64)]"


@query(f"""WITH RECURSIVE edge AS (SELECT source, doc_id, source || chr(31) || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS k,
        [CAST('0x' || substr(md5(w), 1, 4) AS INT) % 64 FOR w IN regexp_extract_all(lower(substr(text, 1, 500)), '[\\p{{L}}\\p{{N}}_]+')] AS slots FROM ({EDGE}) WHERE u <= 3 OR d <= 3),
    v AS (SELECT source, doc_id, row_number() OVER (ORDER BY k) AS n, {EMBED} AS v FROM edge WHERE len(slots) > 0),
    p AS (SELECT a.n AS a, b.n AS b FROM v a JOIN v b ON a.n < b.n AND a.source <> b.source WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
    e AS (SELECT b, list(a) AS earlier FROM p GROUP BY b),
    o AS (SELECT *, row_number() OVER (ORDER BY b) AS step FROM e),
    fold AS (SELECT 0 AS step, CAST([] AS BIGINT[]) AS gone UNION ALL
        SELECT fold.step + 1, CASE WHEN len([x FOR x IN o.earlier IF NOT list_contains(fold.gone, x)]) > 0 THEN list_append(fold.gone, o.b) ELSE fold.gone END FROM fold JOIN o ON o.step = fold.step + 1)
    SELECT source, doc_id FROM v WHERE list_contains((SELECT gone FROM fold ORDER BY step DESC LIMIT 1), n)""")
def near_dup_pages(t):
    """Edge pages that repeat an earlier source's: greedy, keep first, cosine of 0.95 or more between the first 500 characters."""
    return pages.boilerplate(t.texts("source", "doc_id", "text"), "source", "doc_id", "text", tx.embedding)


@query("SELECT a.doc_id AS a, b.doc_id AS b FROM (SELECT min(doc_id) AS doc_id, text, arg_min(source, doc_id) AS source FROM documents GROUP BY text HAVING count(*) > 1) a JOIN documents b ON a.text = b.text WHERE a.source <> b.source")
def equal_pages(t):
    """Pages equal to an earlier page of another file: each meets the first of its text, never all others."""
    keyed = t.documents.select("doc_id", "source", F.sha2("text", 256).alias("key"))
    first = keyed.groupBy("key").agg(F.min(F.struct("doc_id", "source")).alias("f"), F.count("*").alias("n")).filter("n > 1")
    return keyed.join(first, "key").filter("source <> f.source").select(F.col("f.doc_id").alias("a"), F.col("doc_id").alias("b"))


@query(f"""SELECT source, doc_id, CAST(i - 1 AS BIGINT) AS at, round(x / sqrt(list_sum([y * y FOR y IN v])), 6) AS value FROM (SELECT source, doc_id, v, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM (SELECT source, doc_id, {EMBED} AS v
    FROM (SELECT source, doc_id, [CAST('0x' || substr(md5(w), 1, 4) AS INT) % 64 FOR w IN regexp_extract_all(lower(substr(text, 1, 500)), '[\\p{{L}}\\p{{N}}_]+')] AS slots FROM documents) WHERE len(slots) > 0))""")
def text_embedding(t):
    """The vectors that stand in for a model's."""
    made = t.texts("source", "doc_id", "text").select("source", "doc_id", tx.embedding(F.substring("text", 1, 500)).alias("v"))
    return made.select("source", "doc_id", F.posexplode("v").alias("at", "value")).select("source", "doc_id", F.col("at").cast("long").alias("at"), F.round("value", 6).alias("value"))
