"""Queries over answering, extraction and merging, on graphs that grow with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import extract, graph, resolve
from . import answer
from .catalog import query

LINK = """e AS (SELECT DISTINCT * FROM (SELECT 'd' || doc_id AS src, 's_' || source AS dst, 'SOURCED_FROM' AS type FROM documents UNION ALL SELECT 'd' || doc_id, 'l_' || lang, 'MENTIONS' FROM documents UNION ALL SELECT 's_' || source, 'l_' || lang, 'REFERENCES' FROM documents)),
    b AS (SELECT src AS x, dst AS y, type, src || ' ' || dst || ' ' || type AS e FROM e UNION ALL SELECT dst, src, type, src || ' ' || dst || ' ' || type FROM e WHERE src <> dst)"""


def _linked(t):
    d = t.documents.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("d"), F.concat(F.lit("s_"), "source").alias("s"), F.concat(F.lit("l_"), "lang").alias("l"), "doc_id", "source", "lang")
    none = F.lit(None).cast("string")
    nodes = d.select(F.col("d").alias("id"), F.lit("Chunk").alias("label"), F.col("d").alias("name"), none.alias("text"))
    nodes = nodes.unionByName(d.select(F.col("s").alias("id"), F.lit("Concept").alias("label"), F.col("source").alias("name"), none.alias("text")).distinct())
    nodes = nodes.unionByName(d.select(F.col("l").alias("id"), F.lit("Entity").alias("label"), F.col("lang").alias("name"), none.alias("text")).distinct())
    edges = d.select(F.col("d").alias("src"), F.col("s").alias("dst"), F.lit("SOURCED_FROM").alias("type")).unionByName(d.select(F.col("d").alias("src"), F.col("l").alias("dst"), F.lit("MENTIONS").alias("type")))
    return nodes, edges.unionByName(d.select(F.col("s").alias("src"), F.col("l").alias("dst"), F.lit("REFERENCES").alias("type"))).distinct()


@query(f"""WITH {LINK}, t1 AS (SELECT doc_id AS q, x AS seed, y AS node, [e] AS used, type AS via FROM documents JOIN b ON x = 'd' || doc_id WHERE doc_id % 97 = 0),
    t2 AS (SELECT q, seed, b.y AS node, list_append(used, e) AS used, via || ',' || type AS via FROM t1 JOIN b ON t1.node = b.x WHERE NOT list_contains(used, e)),
    t3 AS (SELECT q, seed, b.y AS node, via || ',' || type AS via FROM t2 JOIN b ON t2.node = b.x WHERE NOT list_contains(used, e)),
    a AS (SELECT q, seed, node, via, 1 AS hops FROM t1 UNION ALL SELECT q, seed, node, via, 2 FROM t2 UNION ALL SELECT q, seed, node, via, 3 FROM t3),
    r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY hops, seed, node, via) AS n FROM a WHERE starts_with(node, 's_') OR starts_with(node, 'l_'))
    SELECT q AS question_id, count(*) AS steps, count(DISTINCT node) AS nodes, CAST(sum(hops) AS BIGINT) AS hops, md5(string_agg(node || via, ' ' ORDER BY n)) AS digest FROM r WHERE n <= 300 GROUP BY q""")
def ask_expand(t):
    """Three hops from each 97th document: at most 300 steps a question."""
    nodes, edges = _linked(t)
    starts = t.documents.filter("doc_id % 97 = 0").select(F.col("doc_id").alias("question_id"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("chunk_id"))
    steps = answer.expand(nodes, edges, starts)[1]
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("hops", "seed", "node", F.concat_ws(",", "via").alias("via")))), lambda x: F.concat(x["node"], x["via"])), " ")
    return steps.groupBy("question_id").agg(F.count("*").alias("steps"), F.count_distinct("node").alias("nodes"), F.sum("hops").alias("hops"), F.md5(listed).alias("digest"))


@query("""WITH names AS (SELECT DISTINCT string_split(p_name, ' ')[1] AS run FROM part UNION SELECT DISTINCT lower(p_name) FROM part WHERE p_partkey % 7 = 0), w AS (SELECT p_partkey, string_split(lower(p_name), ' ') AS w FROM part),
    r AS (SELECT DISTINCT p_partkey, array_to_string(w[i:i + n - 1], ' ') AS run FROM (SELECT p_partkey, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM w CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS n)))
    SELECT p_partkey, run AS name FROM r JOIN names USING (run)""")
def gazetteer_mentions(t):
    names = t.part.select(F.element_at(F.split("p_name", " "), 1).alias("name")).union(t.part.filter("p_partkey % 7 = 0").select(F.lower("p_name"))).distinct().withColumn("label", F.lit("Concept"))
    return extract.gazetteer(t.part, "p_partkey", "p_name", names).select("p_partkey", "name")


GLOSS = f"""SELECT doc_id, unnest(regexp_extract_all(text, '{extract.TERM}', 1)) AS term, unnest(regexp_extract_all(text, '{extract.TERM}', 2)) AS definition FROM (SELECT doc_id, 'Term ' || source || ': ' || text AS text FROM documents)"""


@query(f"SELECT doc_id, trim(term) AS term, md5(trim(definition)) AS digest FROM ({GLOSS})")
def glossary_terms(t):
    headed = t.texts("doc_id", "source", "text").select("doc_id", F.concat(F.lit("Term "), "source", F.lit(": "), "text").alias("text"))
    return extract.glossary_terms(headed, ["doc_id"], "text").select("doc_id", "term", F.md5("definition").alias("digest"))


#: Long words stand for identifiers.
IDS = r"[a-z]{13,}"
PAIRS = f"""h AS (SELECT doc_id, list_distinct(regexp_extract_all(text, '{IDS}')) AS h FROM documents), i AS (SELECT doc_id, unnest(h) AS x FROM h WHERE len(h) <= 15), p AS (SELECT a.doc_id, a.x AS a, b.x AS b FROM i a JOIN i b ON a.doc_id = b.doc_id AND a.x < b.x)"""


def _pairs(t):
    hits = F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit(IDS), F.lit(0))))
    found = t.documents.select("source", "doc_id", hits.alias("x")).filter(F.size("x") <= 15)
    made = F.flatten(F.transform("x", lambda a, i: F.transform(F.slice("x", i + 2, F.size("x")), lambda b: F.struct(a.alias("from_id"), b.alias("to_id")))))
    return found.select("source", "doc_id", F.explode(made).alias("p")).select("source", "doc_id", "p.from_id", "p.to_id")


@query(f"""WITH {PAIRS} SELECT p.doc_id, a AS from_id, b AS to_id FROM p JOIN documents d USING (doc_id) WHERE len([x FOR x IN string_split(replace(d.text, chr(13), ''), chr(10)) IF contains(x, a) AND contains(x, b)]) > 0""")
def xref_validated(t):
    return extract.validate_references(_pairs(t), t.documents, "source", "doc_id", "text").select("doc_id", "from_id", "to_id")


@query(f"""WITH {PAIRS}, k AS (SELECT doc_id, a, b, row_number() OVER (PARTITION BY doc_id ORDER BY a, b) - 1 AS n FROM p) SELECT doc_id, CAST(n // 4 AS BIGINT) AS batch, count(*) AS items, md5(string_agg(a || b, ' ' ORDER BY n)) AS digest FROM k GROUP BY ALL""")
def reference_batches(t):
    made = extract.batches(_pairs(t).drop("source"), ["doc_id"], 4)
    return made.select("doc_id", F.col("batch").cast("long").alias("batch"), F.size("items").cast("long").alias("items"), F.md5(F.array_join(F.transform("items", lambda x: F.concat(x["from_id"], x["to_id"])), " ")).alias("digest"))


def _case() -> str:
    kinds = " ".join(f"WHEN regexp_matches(lower(text), '{words}') THEN '{name}'" for name, words in answer.CATEGORIES)
    return f"CASE {kinds} ELSE 'general' END"


@query(f"""SELECT conv_id, turn, {_case()} AS category, CASE WHEN regexp_matches(lower(text), 'across|between modules|cross-module') THEN 'cross_module' WHEN regexp_matches(lower(text), '\\b(and|then|through|via|chain)\\b') THEN 'multi_hop' ELSE 'simple' END AS complexity FROM conversations WHERE role = 'user'""")
def question_classes(t):
    return t.conversations.filter("role = 'user'").select("conv_id", "turn", answer.question_class(F.col("text")).alias("c")).select("conv_id", "turn", "c.category", "c.complexity")


FLAT = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"
SENTENCE = f"regexp_extract({FLAT}, '^(.+?[.!?])(?:\\s|$)', 1)"


@query(f"""SELECT doc_id, CASE WHEN length(text) > 30 THEN md5(substr(CASE WHEN {SENTENCE} <> '' THEN {SENTENCE} ELSE {FLAT} END, 1, 200)) END AS summary,
    CASE WHEN length(text) <= 30 THEN NULL WHEN regexp_matches(text, '(?i)\\b(shall|must)\\b') THEN 'SHALL' WHEN regexp_matches(text, '(?i)\\bshould\\b') THEN 'SHOULD' WHEN regexp_matches(text, '(?i)\\bmay\\b') THEN 'MAY' END AS normative FROM documents""")
def chunk_fields(t):
    made = extract.enrich(t.texts("doc_id", "text").withColumn("kind", F.lit("general_chunk")), "text", "kind")
    return made.select("doc_id", F.md5("summary").alias("summary"), "normative")


STORE = """n AS (SELECT 'm' || s_suppkey AS id, 'Module' AS label, NULL AS text, 1 AS c FROM supplier UNION ALL SELECT 'r' || p_partkey, 'Requirement', CASE WHEN p_size % 5 > 0 THEN p_name END, CASE WHEN p_size % 7 > 0 THEN 1 END FROM part
        UNION ALL SELECT 'c' || o_orderkey, 'Chunk', 'x', 1 FROM orders UNION ALL SELECT 'd' || c_custkey, 'Document', NULL, 1 FROM customer),
    e AS (SELECT DISTINCT 'm' || l_suppkey AS src, 'r' || l_partkey AS dst, 'HAS_REQUIREMENT' AS type FROM lineitem WHERE l_suppkey % 3 > 0 UNION ALL SELECT 'd' || o_custkey, 'c' || o_orderkey, 'HAS_CHUNK' FROM orders WHERE o_orderkey % 3 > 0
        UNION ALL SELECT DISTINCT 'c' || l_orderkey, 'm' || l_suppkey, 'SOURCED_FROM' FROM lineitem WHERE l_quantity > 20)"""


def _store(t):
    name = lambda head, c: F.concat(F.lit(head), F.col(c).cast("string"))
    nothing, one = F.lit(None).cast("string"), F.lit(1)
    nodes = t.supplier.select(name("m", "s_suppkey").alias("id"), F.lit("Module").alias("label"), nothing.alias("text"), one.alias("confidence_score"))
    nodes = nodes.unionByName(t.part.select(name("r", "p_partkey").alias("id"), F.lit("Requirement").alias("label"), F.when(F.col("p_size") % 5 > 0, F.col("p_name")).alias("text"), F.when(F.col("p_size") % 7 > 0, 1).alias("confidence_score")))
    nodes = nodes.unionByName(t.orders.select(name("c", "o_orderkey").alias("id"), F.lit("Chunk").alias("label"), F.lit("x").alias("text"), one.alias("confidence_score")))
    nodes = nodes.unionByName(t.customer.select(name("d", "c_custkey").alias("id"), F.lit("Document").alias("label"), nothing.alias("text"), one.alias("confidence_score"))).withColumn("ingested_at", F.col("confidence_score"))
    edges = t.lineitem.filter("l_suppkey % 3 > 0").select(name("m", "l_suppkey").alias("src"), name("r", "l_partkey").alias("dst"), F.lit("HAS_REQUIREMENT").alias("type"))
    edges = edges.unionByName(t.orders.filter("o_orderkey % 3 > 0").select(name("d", "o_custkey").alias("src"), name("c", "o_orderkey").alias("dst"), F.lit("HAS_CHUNK").alias("type")))
    return nodes, edges.unionByName(t.lineitem.filter("l_quantity > 20").select(name("c", "l_orderkey").alias("src"), name("m", "l_suppkey").alias("dst"), F.lit("SOURCED_FROM").alias("type")))


@query(f"""WITH {STORE} SELECT 'isolated' AS "check", count(*) AS n FROM n WHERE label <> 'Document' AND id NOT IN (SELECT src FROM e) AND id NOT IN (SELECT dst FROM e)
    UNION ALL SELECT 'requirement_without_text', count(*) FROM n WHERE label = 'Requirement' AND text IS NULL UNION ALL SELECT 'module_without_requirement', count(*) FROM n WHERE label = 'Module' AND id NOT IN (SELECT src FROM e WHERE type = 'HAS_REQUIREMENT')
    UNION ALL SELECT 'chunk_without_embedding', count(*) FROM n WHERE label = 'Chunk' UNION ALL SELECT 'chunk_without_document', count(*) FROM n WHERE label = 'Chunk' AND id NOT IN (SELECT dst FROM e WHERE type = 'HAS_CHUNK')
    UNION ALL SELECT 'requirement_without_ingested_at', count(*) FROM n WHERE label = 'Requirement' AND c IS NULL UNION ALL SELECT 'requirement_without_confidence', count(*) FROM n WHERE label = 'Requirement' AND c IS NULL
    UNION ALL SELECT 'chunk_without_module', count(*) FROM n WHERE label = 'Chunk' AND id NOT IN (SELECT src FROM e WHERE type = 'SOURCED_FROM')""")
def store_audit(t):
    return graph.full_audit(*_store(t))


@query(f"""WITH {STORE} SELECT c, m, count(*) AS paths FROM (SELECT a.src AS c, a.dst AS m, b.dst AS r FROM e a JOIN e b ON a.dst = b.src WHERE a.type = 'SOURCED_FROM' AND b.type = 'HAS_REQUIREMENT') GROUP BY ALL ORDER BY paths DESC, c, m LIMIT 100""")
def store_paths(t):
    edges = _store(t)[1].distinct()
    out = edges.filter("type = 'HAS_REQUIREMENT'").groupBy(F.col("src").alias("m")).agg(F.count("*").alias("paths"))
    return edges.filter("type = 'SOURCED_FROM'").select(F.col("src").alias("c"), F.col("dst").alias("m")).join(out, "m").select("c", "m", "paths").orderBy(F.desc("paths"), "c", "m").limit(100)


REFS = "refs AS (SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1)"


def _refs(t):
    line = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("src"))
    after = t.lineitem.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("dst"))
    return line.join(after, ["l_orderkey", "l_linenumber"]).select("src", "dst").distinct().withColumn("type", F.lit("DEPENDS_ON"))


@query(f"WITH {REFS} SELECT a.src AS a, a.dst AS b FROM refs a JOIN refs b ON a.src = b.dst AND a.dst = b.src WHERE a.src < a.dst")
def part_loops(t):
    return graph.two_way(_refs(t))


@query(f"""WITH {REFS}, und AS (SELECT src AS x, dst AS y FROM refs WHERE src <> dst UNION SELECT dst, src FROM refs WHERE src <> dst), h0 AS (SELECT p_partkey AS seed, p_partkey AS node FROM part WHERE p_partkey < 4),
    h1 AS (SELECT DISTINCT seed, y AS node FROM h0 JOIN und ON node = x EXCEPT SELECT seed, node FROM h0), h2 AS (SELECT DISTINCT seed, y AS node FROM h1 JOIN und ON node = x EXCEPT (SELECT seed, node FROM h0 UNION SELECT seed, node FROM h1))
    SELECT seed, node, hops, round(0.9 / hops, 3) AS score FROM (SELECT *, 1 AS hops FROM h1 UNION ALL SELECT *, 2 FROM h2)""")
def part_impact(t):
    return graph.impact(_refs(t), t.part.filter("p_partkey < 4").select(F.col("p_partkey").alias("id")), 2).select("seed", "node", "hops", "score")


@query("""SELECT p_brand, arg_max(p_type, p_partkey) FILTER (WHERE p_type IS NOT NULL) AS p_type, arg_max(CASE WHEN p_size % 3 > 0 THEN p_size END, p_partkey) FILTER (WHERE p_size % 3 > 0) AS p_size,
    md5((SELECT string_agg(n, ',' ORDER BY first) FROM (SELECT p_name AS n, min(p_partkey) AS first FROM part q WHERE q.p_brand = part.p_brand GROUP BY p_name))) AS aliases FROM part GROUP BY p_brand""")
def property_merge(t):
    rows = t.part.select("p_brand", "p_partkey", "p_name", "p_type", F.when(F.col("p_size") % 3 > 0, F.col("p_size")).alias("p_size"))
    return resolve.merge_properties(rows, ["p_brand"], "p_partkey", ["p_type", "p_size"], "p_name").withColumn("aliases", F.md5(F.array_join("aliases", ",")))


@query("""SELECT p_brand, p_partkey, p_name, (SELECT count(DISTINCT p_name) - 1 FROM part q WHERE q.p_brand = p.p_brand) AS aliases FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part) p WHERE n = 1""")
def override_merge(t):
    rows = t.part.select("p_brand", "p_partkey", "p_name", F.array().cast("array<string>").alias("aliases"))
    return resolve.override(rows, ["p_brand"], "p_partkey", "p_name", "aliases").withColumn("aliases", F.size("aliases").cast("long"))


@query("""WITH f AS (SELECT p_name AS alias, lower(trim(regexp_replace(p_name, '[_\\-\\s]+', ' ', 'g'))) AS form, n FROM (SELECT CASE WHEN p_size % 2 = 0 THEN p_name ELSE upper(substr(p_name, 1, 1)) || replace(substr(p_name, 2), ' ', '_') END AS p_name, count(*) AS n FROM part GROUP BY 1)),
    b AS (SELECT form, arg_min(alias, (-n, alias)) AS canonical, count(*) AS c FROM f GROUP BY form) SELECT alias, canonical FROM f JOIN b USING (form) WHERE c > 1 AND alias <> canonical""")
def spelling_names(t):
    spelled = F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.concat(F.upper(F.substring("p_name", 1, 1)), F.replace(F.substring("p_name", 2, 1 << 30), F.lit(" "), F.lit("_"))))
    return resolve.spelling_names(t.part.select(spelled.alias("name")), "name")
