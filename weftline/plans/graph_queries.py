"""Queries over harvests, vectors, entities and graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import graph, harvest, resolve, vectors
from ..session import pieces
from .catalog import query

HREF = r'href="/([^"]+)"'
HOST = r"://([^/?#]+)"
FOUND = f"""hits AS (SELECT page_id, url, list_distinct(regexp_extract_all(html, '{HREF}', 1)) AS d, regexp_extract_all(html, '{HREF}', 1) AS ids FROM pages),
    found AS (SELECT page_id, regexp_extract(url, '{HOST}', 1) AS host, id, min(i) AS pos FROM (SELECT page_id, url, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM hits) GROUP BY ALL)"""
INVENTORY = FOUND + ", inv AS (SELECT id, string_split(id, '-')[1] AS id_type, CASE WHEN len(string_split(id, '-')) > 2 THEN string_split(id, '-')[2] ELSE arg_min(host, (host, page_id)) END AS module, arg_min(host, (host, page_id)) AS first_file, arg_min(page_id, (host, page_id)) AS first_page, count(*) AS occurrences FROM found GROUP BY id)"


def _found(t):
    return harvest.mentions(t.pages.withColumn("host", F.regexp_extract("url", HOST, 1)), "host", "page_id", "html", HREF)


def _inventory(t):
    hosts = t.pages.select(F.regexp_extract("url", HOST, 1).alias("host")).distinct().withColumn("module", F.col("host"))
    return harvest.inventory(_found(t), hosts, "host", "page_id", "-")


@query(f"WITH {FOUND} SELECT host, page_id, id FROM found")
def harvest_ids(t):
    return _found(t).select("host", "page_id", "id")


@query(f"WITH {INVENTORY} SELECT * FROM inv")
def id_inventory(t):
    return _inventory(t).drop("places")


@query(f"WITH {INVENTORY} SELECT id, count(*) AS places, md5(string_agg(host || page_id, ' ' ORDER BY host, page_id)) AS digest FROM (SELECT DISTINCT id, host, page_id FROM found) GROUP BY id")
def id_places(t):
    """Each id's distinct places, in order."""
    listed = F.array_join(F.transform("places", lambda x: F.concat(x["file"], x["page"].cast("string"))), " ")
    return _inventory(t).select("id", F.size("places").cast("long").alias("places"), F.md5(listed).alias("digest"))


@query(f"WITH {INVENTORY} SELECT id_type, count(*) AS ids FROM inv GROUP BY id_type")
def id_type_counts(t):
    return _inventory(t).groupBy("id_type").agg(F.count("*").alias("ids"))


PAIRS = ", few AS (SELECT page_id FROM found GROUP BY page_id HAVING count(*) <= 15), pairs AS (SELECT a.page_id, a.id AS from_id, b.id AS to_id FROM found a JOIN found b ON a.page_id = b.page_id AND a.pos < b.pos WHERE a.page_id IN (SELECT page_id FROM few))"


@query(f"WITH {FOUND}{PAIRS} SELECT page_id, from_id, to_id FROM pairs")
def cooccurrence_pairs(t):
    return harvest.cooccurring(_found(t), "host", "page_id").select("page_id", "from_id", "to_id")


@query(f"WITH {INVENTORY}{PAIRS}, known AS (SELECT * FROM inv WHERE occurrences >= 2) SELECT p.from_id, p.to_id, a.module <> b.module AS cross_module FROM (SELECT DISTINCT from_id, to_id FROM pairs) p JOIN known a ON p.from_id = a.id JOIN known b ON p.to_id = b.id")
def xref_resolve(t):
    return harvest.resolve_references(harvest.cooccurring(_found(t), "host", "page_id"), _inventory(t).filter("occurrences >= 2"))


@query("SELECT page_id, id, body FROM (SELECT page_id, unnest(regexp_extract_all(html, '<h1>([^<]{1,20})([^<]{10,400})', 1)) AS id, unnest([trim(regexp_replace(x, '\\s+', ' ', 'g')) FOR x IN regexp_extract_all(html, '<h1>([^<]{1,20})([^<]{10,400})', 2)]) AS body FROM pages)")
def req_bodies(t):
    from ..functions.ids import bodies

    return t.pages.select("page_id", F.explode(bodies(F.col("html"), r"<h1>([^<]{1,20})([^<]{10,400})")).alias("b")).select("page_id", "b.id", "b.body")


@query(f"WITH {FOUND} SELECT id, arg_min(host, (host, page_id)) AS host, arg_min(page_id, (host, page_id)) AS page_id FROM found GROUP BY id")
def req_first_chunk(t):
    return harvest.first_chunks(_found(t), "host", "page_id")


@query(f"WITH {INVENTORY} SELECT DISTINCT f.page_id AS src, f.id AS dst FROM found f JOIN inv i USING (id) WHERE i.occurrences >= 2")
def mentions_edges(t):
    return harvest.mention_edges(_found(t), _inventory(t).filter("occurrences >= 2"), "page_id")


COS = "list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"


@query(f"SELECT * FROM (SELECT a.vec_id AS a, b.vec_id AS b, round({COS}, 6) AS cosine, round((1 + {COS}) / 2, 6) AS score, CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY {COS} DESC, b.vec_id) AS BIGINT) AS rank FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE {COS} >= 0.3) WHERE rank <= 10")
def knn_edges(t):
    found = vectors.nearest(t.embeddings, "vec_id", "embedding", 10, 0.3)
    return found.select("a", "b", F.round("cosine", 6).alias("cosine"), F.round(vectors.index_score(F.col("cosine")), 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(f"SELECT * FROM (SELECT a.vec_id AS query_id, b.vec_id, round((1 + {COS}) / 2, 6) AS score, CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY {COS} DESC, b.vec_id) AS BIGINT) AS rank FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0) WHERE rank <= 5 AND score >= 0.6")
def vector_search(t):
    found = vectors.nearest(t.embeddings, "vec_id", "embedding", 5, -1.0, t.embeddings.filter("vec_id % 100 = 0"))
    scored = found.select(F.col("a").alias("query_id"), F.col("b").alias("vec_id"), F.round(vectors.index_score(F.col("cosine")), 6).alias("score"), F.col("rank").cast("long").alias("rank"))
    return scored.filter("score >= 0.6")


@query(f"SELECT a, b, CASE WHEN c >= 0.45 THEN 'certain' WHEN c >= 0.35 THEN 'uncertain' ELSE 'apart' END AS band FROM (SELECT a.vec_id AS a, b.vec_id AS b, {COS} AS c FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id AND a.label = b.label) WHERE c >= 0.3")
def er_bands(t):
    return vectors.bands(vectors.similar_pairs(t.embeddings, "vec_id", "embedding", 0.3, ["label"]), 0.45, 0.35).select("a", "b", "band")


@query(f"""WITH RECURSIVE p AS (SELECT a.vec_id AS x, b.vec_id AS y FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND a.label = b.label WHERE {COS} >= 0.35),
    walk AS (SELECT vec_id AS n, vec_id AS m FROM embeddings UNION SELECT walk.n, p.y FROM walk JOIN p ON walk.m = p.x) SELECT n AS vec_id, min(m) AS cluster FROM walk GROUP BY n""")
def entity_clusters(t):
    return vectors.similar_components(t.embeddings, "vec_id", "embedding", 0.35, ["label"])


@query("SELECT CAST(len(embedding) AS BIGINT) AS dim, count(*) AS vectors FROM embeddings GROUP BY 1")
def embedding_dims(t):
    return vectors.dimensions(t.embeddings, "embedding")


@query(f"""WITH sim AS (SELECT a.vec_id AS a, b.vec_id AS b, {COS} AS c FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE {COS} >= 0.35)
    SELECT * FROM (SELECT least(x.source, y.source) AS concept_a, greatest(x.source, y.source) AS concept_b, round(max((1 + c) / 2), 6) AS score FROM sim JOIN documents x ON x.doc_id = a JOIN documents y ON y.doc_id = b WHERE x.source <> y.source GROUP BY 1, 2) ORDER BY score DESC, concept_a, concept_b LIMIT 30""")
def semantic_conflict_candidates(t):
    named = t.embeddings.select("vec_id", "embedding").join(t.documents.select(F.col("doc_id").alias("vec_id"), "source"), "vec_id")
    found = vectors.nearest_groups(named, "vec_id", "embedding", "source", 0.35).select(F.col("a").alias("concept_a"), F.col("b").alias("concept_b"), F.round(vectors.index_score(F.col("cosine")), 6).alias("score"))
    return found.orderBy(F.desc("score"), "concept_a", "concept_b").limit(30)


ALIAS = {"widget": "Component", "bolt": "Fastener", "ring": "Fastener"}


@query("""SELECT p_partkey, CASE WHEN contains(p_name, 'widget') THEN 'Component' WHEN contains(p_name, 'bolt') OR contains(p_name, 'ring') THEN 'Fastener' ELSE string_split(p_name, ' ')[2] END AS canonical FROM part""")
def canonical_names(t):
    names = t.spark.createDataFrame(list(ALIAS.items()), "alias string, canonical string")
    return resolve.canonical(t.part.select("p_partkey", F.element_at(F.split("p_name", " "), 2).alias("word")), names, "p_partkey", "word").select("p_partkey", "canonical")


@query("SELECT p_partkey, concat('part_', substr(regexp_replace(regexp_replace(lower(p_name || ' ' || p_brand), '\\s+', '_', 'g'), '[^a-z0-9_]', '', 'g'), 1, 60)) AS node_id FROM part")
def safe_node_id(t):
    return t.part.select("p_partkey", tx.safe_node_id(F.lit("Part"), F.concat_ws(" ", "p_name", "p_brand")).alias("node_id"))


@query("""SELECT p_brand, p_type, min(id) AS id, arg_max(p_name, (n, back)) AS name, array_to_string(list_sort(list(p_name)), ',') AS aliases, CAST(sum(n) AS BIGINT) AS members
    FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_name DESC) AS back FROM (SELECT p_brand, p_type, p_name, count(*) AS n, min(p_partkey) AS id FROM part GROUP BY ALL)) GROUP BY p_brand, p_type""")
def alias_merge(t):
    return resolve.merge_clusters(t.part, ["p_brand", "p_type"], "p_partkey", "p_name").withColumn("aliases", F.array_join("aliases", ","))


@query("""WITH t AS (SELECT DISTINCT event_type AS x FROM events) SELECT a.x AS a, b.x AS b, ((contains(a.x, 'view') AND contains(b.x, 'click')) OR (contains(a.x, 'click') AND contains(b.x, 'view'))) AS antonyms FROM t a JOIN t b ON a.x < b.x""")
def antonym_guard(t):
    kinds = t.events.select(F.col("event_type").alias("a")).distinct()
    return kinds.join(kinds.toDF("b"), F.col("a") < F.col("b")).select("a", "b", resolve.are_antonyms(F.col("a"), F.col("b"), (("view", "click"),)).alias("antonyms"))


@query("""WITH n AS (SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 'Concept_' || p_name || p_partkey // 2 ELSE p_name || p_partkey // 2 END AS name FROM part)
    SELECT a.id AS prefixed, b.id AS plain FROM n a JOIN n b ON lower(substr(a.name, 9)) = lower(b.name) WHERE starts_with(a.name, 'Concept_') AND a.id <> b.id""")
def prefix_pairs(t):
    half = F.floor(F.col("p_partkey") / 2).cast("string")
    named = t.part.select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Concept_"), "p_name", half)).otherwise(F.concat("p_name", half)).alias("name"))
    return resolve.prefix_pairs(named, "id", "name")


@query("""WITH e AS (SELECT DISTINCT c.c_nationkey AS src, s.s_nationkey AS dst FROM lineitem JOIN orders o ON l_orderkey = o_orderkey JOIN customer c ON o_custkey = c_custkey JOIN supplier s ON l_suppkey = s_suppkey),
    m AS (SELECT DISTINCT CASE WHEN src < 8 THEN src % 4 ELSE src END AS src, CASE WHEN dst < 8 THEN dst % 4 ELSE dst END AS dst FROM e) SELECT src, dst FROM m WHERE src <> dst""")
def remap_edges(t):
    chain = t.spark.createDataFrame([(i, i - 4) for i in range(4, 8)], "old int, new int")
    return resolve.remap_edges(_trade(t).select("src", "dst"), resolve.follow(chain))


@query("SELECT r_name AS label, count(*) AS nodes FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def label_counts(t):
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("r_name").alias("label")).agg(F.count("*").alias("nodes"))


@query("SELECT l_returnflag AS type, count(*) AS edges, count(DISTINCT l_suppkey) AS sources FROM lineitem GROUP BY 1")
def edge_type_counts(t):
    return t.lineitem.groupBy(F.col("l_returnflag").alias("type")).agg(F.count("*").alias("edges"), F.count_distinct("l_suppkey").alias("sources"))


@query("SELECT l_suppkey AS module, count(DISTINCT l_partkey) AS requirements, count(*) AS chunks FROM lineitem GROUP BY 1")
def module_counts(t):
    return t.lineitem.groupBy(F.col("l_suppkey").alias("module")).agg(F.count_distinct("l_partkey").alias("requirements"), F.count("*").alias("chunks"))


@query("SELECT source, max(doc_id) AS last_page, count(*) AS pages FROM documents GROUP BY source")
def document_nodes(t):
    return t.documents.groupBy("source").agg(F.max("doc_id").alias("last_page"), F.count("*").alias("pages"))


@query("SELECT d.lang AS label, round(100.0 * count(l.quality) / count(*), 2) AS covered FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def provenance_coverage(t):
    return t.documents.join(t.labels, "doc_id", "left").groupBy(F.col("lang").alias("label")).agg(F.round(100.0 * F.count("quality") / F.count("*"), 2).alias("covered"))


@query("""SELECT 'no_label' AS "check", count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL
    UNION ALL SELECT 'near_blank', count(*) FROM documents WHERE length(text) < 80
    UNION ALL SELECT 'isolated', count(*) FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)""")
def graph_audit(t):
    nodes = t.documents.join(t.labels, "doc_id", "left").withColumnRenamed("doc_id", "id")
    edges = t.embeddings.select(F.col("vec_id").alias("src"), F.col("vec_id").alias("dst"))
    return graph.audit(nodes, edges, {"no_label": F.col("quality").isNull(), "near_blank": F.length("text") < 80})


@query("SELECT DISTINCT l_suppkey AS src, l_partkey AS dst, l_returnflag AS type FROM lineitem WHERE NOT (l_suppkey IN (SELECT p_partkey FROM part WHERE p_size > 5) AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 5))")
def dangling_edges(t):
    edges = t.lineitem.select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_returnflag").alias("type"))
    found = graph.dangling(edges, t.part.filter("p_size > 5").select(F.col("p_partkey").alias("id")))
    return found.repartition(pieces(edges), "src", "dst").distinct()


@query("""SELECT src, dst, quantity, line FROM (SELECT l_suppkey AS src, l_partkey AS dst, l_quantity AS quantity, l_linenumber AS line, row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS n FROM lineitem) WHERE n = 1""")
def edge_upsert(t):
    rows = t.lineitem.select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_quantity").alias("quantity"), F.col("l_linenumber").alias("line"), "l_shipdate", "l_orderkey")
    last = rows.groupBy("src", "dst").agg(F.max(F.struct("l_shipdate", "l_orderkey", "line", "quantity")).alias("m"))
    return last.select("src", "dst", "m.quantity", "m.line")


@query("SELECT src, dst, type, count(*) AS n FROM (SELECT DISTINCT l_suppkey AS src, l_partkey AS dst, 'HAS' AS type, l_orderkey FROM lineitem) GROUP BY ALL")
def dedup_edges(t):
    return t.lineitem.groupBy(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst")).agg(F.count_distinct("l_orderkey").alias("n")).withColumn("type", F.lit("HAS"))


@query("""WITH direct AS (SELECT DISTINCT o.o_orderkey AS chunk, s.s_nationkey AS module FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey),
    rest AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT chunk FROM direct)) SELECT chunk, CAST(module AS BIGINT) AS module, 'direct' AS method FROM direct UNION ALL SELECT o_orderkey, CAST(c_nationkey AS BIGINT), 'fallback' FROM rest JOIN customer ON o_custkey = c_custkey""")
def sourced_from(t):
    line = t.lineitem.select(F.col("l_orderkey").alias("chunk"), "l_suppkey")
    n = pieces(line)
    module = line.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("chunk", F.col("s_nationkey").cast("long").alias("module"))
    orders = t.orders.select(F.col("o_orderkey").alias("chunk"), "o_custkey").repartition(n, "chunk")
    direct = module.repartition(n, "chunk").distinct().join(orders.select("chunk"), "chunk", "left_semi")
    rest = orders.join(direct, "chunk", "left_anti")
    fallback = rest.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("chunk", F.col("c_nationkey").cast("long").alias("module"))
    return direct.withColumn("method", F.lit("direct")).unionByName(fallback.withColumn("method", F.lit("fallback")))


TRADE = """trade AS (SELECT c.c_nationkey AS src, s.s_nationkey AS dst, count(*) AS w FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer c ON o_custkey = c_custkey JOIN supplier s ON l_suppkey = s_suppkey GROUP BY ALL),
    heavy AS (SELECT src, dst FROM trade WHERE w >= (SELECT avg(w) + stddev_pop(w) FROM trade))"""


def _trade(t):
    """Customer nation to supplier nation with the number of lines: lines are counted by order's customer before nations are looked up."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("s_suppkey"))
    joined = lines.join(t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")), "o_orderkey").join(t.customer.select("c_custkey", F.col("c_nationkey").alias("src")), "c_custkey")
    return joined.join(t.supplier.select("s_suppkey", F.col("s_nationkey").alias("dst")), "s_suppkey").groupBy("src", "dst").agg(F.count("*").alias("w"))


def _heavy(t):
    from ..session import written

    edges = written(_trade(t), "trade")
    least = edges.agg(F.avg("w") + F.stddev_pop("w")).first()[0]
    return edges.filter(F.col("w") >= least).select("src", "dst", F.lit("DEPENDS_ON").alias("type"))


@query(f"WITH {TRADE} SELECT a.src AS a, a.dst AS b FROM heavy a JOIN heavy b ON a.src = b.dst AND a.dst = b.src WHERE a.src < a.dst")
def bidirectional_loops(t):
    return graph.two_way(_heavy(t))


@query(f"WITH {TRADE} SELECT src, dst, w FROM trade WHERE src = dst")
def self_loops(t):
    return _trade(t).filter("src = dst")


@query(f"WITH {TRADE} SELECT a.dst, a.src AS a, b.src AS b FROM heavy a JOIN heavy b ON a.dst = b.dst AND a.src < b.src")
def dual_allocation(t):
    return graph.shared_targets(_heavy(t))


UND = "und AS (SELECT src AS x, dst AS y FROM heavy WHERE src <> dst UNION SELECT dst, src FROM heavy WHERE src <> dst)"


@query(f"WITH {TRADE}, {UND} SELECT p.x AS a, q.y AS b, count(*) AS shared FROM und p JOIN und q ON p.y = q.x WHERE p.x < q.y AND NOT EXISTS (SELECT 1 FROM und u WHERE u.x = p.x AND u.y = q.y) GROUP BY ALL HAVING count(*) >= 2 ORDER BY shared DESC, a, b LIMIT 500")
def bridge_candidates(t):
    return graph.bridges(_heavy(t)).orderBy(F.desc("shared"), "a", "b").limit(500)


@query("""WITH part_of AS (SELECT p_partkey AS id, p_brand AS module, p_type AS kind, p_name AS name FROM part), refs AS (SELECT DISTINCT a.l_partkey AS ra, b.l_partkey AS rb FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1)
    SELECT ra, rb, ma.module AS module_a, mb.module AS module_b FROM refs JOIN part_of ma ON ra = ma.id JOIN part_of mb ON rb = mb.id WHERE ma.module <> mb.module
    AND NOT EXISTS (SELECT 1 FROM part_of x WHERE x.module = mb.module AND x.id <> rb AND contains(x.name, ma.name))""")
def spec_gaps(t):
    """References into another module none of whose other requirements mentions the referrer."""
    part = t.part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("module"), F.col("p_name").alias("name"))
    line = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    after = line.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("rb"))
    refs = line.withColumnRenamed("l_partkey", "ra").join(after, ["l_orderkey", "l_linenumber"]).select("ra", "rb").distinct()
    a, b = part.toDF("ra", "module_a", "name_a"), part.toDF("rb", "module_b", "name_b").drop("name_b")
    both = refs.join(a, "ra").join(b, "rb").filter("module_a <> module_b")
    # A module's names are few against its parts: each is kept with up to two of its ids, enough to leave out the target itself.
    names = part.groupBy("module", "name").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    wanted = both.select("module_b", "name_a").distinct()
    met = wanted.join(names, (F.col("module_b") == F.col("module")) & F.contains(F.col("name"), F.col("name_a"))).groupBy("module_b", "name_a").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    open_ = both.join(met, ["module_b", "name_a"], "left").filter(F.col("lo").isNull() | ((F.col("lo") == F.col("rb")) & (F.col("hi") == F.col("rb"))))
    return open_.select("ra", "rb", "module_a", "module_b")


@query(f"""WITH {TRADE}, {UND}, e AS (SELECT DISTINCT src, dst, row_number() OVER (ORDER BY src, dst) AS e FROM heavy), b AS (SELECT src AS x, dst AS y, e FROM e UNION ALL SELECT dst, src, e FROM e WHERE src <> dst),
    t1 AS (SELECT x AS seed, y AS node, [e] AS used FROM b WHERE x < 3), t2 AS (SELECT seed, b.y AS node, list_append(used, e) AS used FROM t1 JOIN b ON t1.node = b.x WHERE NOT list_contains(used, e))
    SELECT seed, node, hops, count(*) AS trails FROM (SELECT seed, node, 1 AS hops FROM t1 UNION ALL SELECT seed, node, 2 FROM t2) GROUP BY ALL""")
def subgraph_expand(t):
    seeds = t.nation.filter("n_nationkey < 3").select(F.col("n_nationkey").alias("id"))
    return graph.trails(_heavy(t), seeds, 2).groupBy("seed", "node", "hops").agg(F.count("*").alias("trails"))


@query(f"""WITH {TRADE}, {UND}, h0 AS (SELECT DISTINCT n_nationkey AS seed, n_nationkey AS node FROM nation WHERE n_nationkey < 3),
    h1 AS (SELECT DISTINCT seed, y AS node FROM h0 JOIN und ON node = x EXCEPT SELECT seed, node FROM h0),
    h2 AS (SELECT DISTINCT seed, y AS node FROM h1 JOIN und ON node = x EXCEPT (SELECT seed, node FROM h0 UNION SELECT seed, node FROM h1)),
    h3 AS (SELECT DISTINCT seed, y AS node FROM h2 JOIN und ON node = x EXCEPT (SELECT seed, node FROM h0 UNION SELECT seed, node FROM h1 UNION SELECT seed, node FROM h2)),
    h4 AS (SELECT DISTINCT seed, y AS node FROM h3 JOIN und ON node = x EXCEPT (SELECT seed, node FROM h0 UNION SELECT seed, node FROM h1 UNION SELECT seed, node FROM h2 UNION SELECT seed, node FROM h3)),
    r AS (SELECT *, 1 AS hops FROM h1 UNION ALL SELECT *, 2 FROM h2 UNION ALL SELECT *, 3 FROM h3 UNION ALL SELECT *, 4 FROM h4)
    SELECT seed, node, hops, round(0.9 / hops, 3) AS score, CASE WHEN 0.9 / hops >= 0.7 THEN 'critical' WHEN 0.9 / hops >= 0.4 THEN 'major' ELSE 'minor' END AS severity FROM r""")
def impact_trace(t):
    return graph.impact(_heavy(t), t.nation.filter("n_nationkey < 3").select(F.col("n_nationkey").alias("id")), 4)
