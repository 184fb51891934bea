"""Ingestion: pages to a property graph, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids as idf
from ..functions import text as tx
from ..operators import chunks, extract, graph, harvest, pages, resolve, vectors
from ..session import written
from ..sources.tables import Stages, write_graph

VERSION = "1"
#: Neighbours of a chunk, their least index score, and the cosine from which entities of a label are one.
NEIGHBOURS, LEAST_SCORE, SAME = 10, 0.80, 0.92
# Node types of the graph; a corpus may add its own.
NODE_TYPES = ["Requirement", "Document", "ConfigParameter", "Module", "Concept", "StandardRef", "DocumentRef", "Function", "System", "Organization", "FunctionalCluster", "DataType", "Class", "Category", "SpecificationItem", "ChangeRecord", "Constraint", "TestSpecification", "TestCase"]


def extended(types: list[str], more: list[str]) -> list[str]:
    """``types`` with what ``more`` has that is new and not empty."""
    return list(dict.fromkeys([*types, *[t.strip() for t in more if t and t.strip()]]))


def stamp(nodes: DataFrame, as_of: str, confidence: float, method: str = "rule_based", chunk: str | None = None) -> DataFrame:
    """The provenance columns."""
    return nodes.withColumns({
        "ingested_at": F.to_timestamp(F.lit(as_of)), "confidence_score": F.lit(confidence), "extraction_method": F.lit(method),
        "pipeline_version": F.lit(VERSION), "source_chunk_id": F.col(chunk).cast("string") if chunk else F.lit(None).cast("string"),
    })


def clean(raw: DataFrame, share: float = 0.40, embed: Callable[[Column], Column] = tx.embedding) -> DataFrame:
    """Pages ``(filename, page_1idx, markdown, ...)`` cleaned and classed; blank, legal, contents and revision pages go, and edge pages that repeat an earlier file's."""
    kept = pages.strip_repeated_lines(raw.withColumn("markdown", tx.strip_inline_noise(F.col("markdown"))), "filename", "markdown", share)
    classed = kept.withColumn("content_type", tx.page_class(F.col("markdown"))).filter(~F.col("content_type").isin("near_blank", "legal_boilerplate", "toc_heading", "toc_content", "revision_history"))
    classed = written(classed, "classed")
    classed = classed.join(pages.boilerplate(classed.filter("content_type = 'content'"), "filename", "page_1idx", "markdown", embed), ["filename", "page_1idx"], "left_anti")
    body = F.when(F.col("content_type") == "content", tx.drop_orphan_captions(F.col("markdown"))).otherwise(F.col("markdown"))
    return classed.withColumn("markdown", tx.normalize_whitespace(tx.inline_clean(body)))


def chunk(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks that pass the gate, linked within their file, and configuration parameters. Diagrams are not chunked; one extractor serves pages and chunks."""
    keys = ["filename", "page_1idx", "content_type"]
    texts = cleaned.filter("content_type IS NULL OR content_type <> 'diagram'")
    parameters = chunks.config_parameters(texts, ["filename", "page_1idx"], "markdown").withColumn("module", idf.file_module(F.col("filename")))
    parameters = parameters.withColumn("param_id", F.concat(F.lit("ECUC_"), "module", F.lit("_"), "name"))
    bare = chunks.without_tables(texts, keys, "markdown")
    sections = chunks.heading_sections(bare, keys, "markdown")
    heads = [f"h{k}" for k in range(1, 6)]
    cut = chunks.recursive_chunks(sections, [*keys, "section", *heads], "body")
    found = cut.withColumn("req_ids", idf.find_ids(F.col("chunk"))).withColumn("reason", tx.quality_reason(F.col("chunk"))).filter("reason = 'pass'").drop("reason")
    index = F.col("section") * 1000 + F.col("chunk_index")
    stem = F.regexp_replace("filename", r"\.[^.]*$", "")
    named = found.withColumn("chunk_id", tx.chunk_id(stem, F.col("page_1idx"), index, F.col("filename"))).withColumn("token_count", tx.token_estimate(F.col("chunk")))
    named = named.withColumn("chunk_type", tx.chunk_class(F.col("chunk"), F.col("req_ids"), F.col("content_type")))
    named = extract.enrich(named, "chunk", "chunk_type").withColumn("chunk_type", F.col("enriched_type")).drop("enriched_type")
    return chunks.chunk_links(named, "filename", ["page_1idx", "section", "chunk_index"], "chunk_id"), parameters


def build(cleaned: DataFrame, cut: DataFrame, parameters: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges from rules: requirements, modules, documents, chunks, parameters; endpoints that are no nodes are dropped."""
    modules = cleaned.select("filename").distinct().withColumn("module", idf.file_module(F.col("filename")))
    found = harvest.mentions(cleaned.filter("content_type <> 'diagram'"), "filename", "page_1idx", "markdown")
    known = harvest.inventory(found, modules, "filename", "page_1idx")
    near = extract.validate_references(harvest.cooccurring(found, "filename", "page_1idx"), cleaned, "filename", "page_1idx", "markdown")
    pairs = harvest.resolve_references(near, known)
    bodies = cleaned.select("filename", "page_1idx", F.explode(idf.bodies(F.col("markdown"))).alias("b")).groupBy(F.col("b.id").alias("id")).agg(F.min_by(tx.clean_body(F.col("b.body")), F.struct("filename", "page_1idx")).alias("text"))
    columns = ["id", "label", "name", "text", "module"]
    none = F.lit(None).cast("string")
    requirement = lambda c: F.concat(F.lit("req_"), c)
    module = lambda c: F.concat(F.lit("module_"), F.lower(c))
    nodes = known.join(bodies, "id", "left").select(requirement(F.col("id")).alias("id"), F.lit("Requirement").alias("label"), F.col("id").alias("name"), "text", "module")
    all_modules = known.select("module").union(modules.select("module")).union(parameters.select("module")).groupBy(module(F.col("module")).alias("id")).agg(F.min("module").alias("m"))
    nodes = nodes.unionByName(all_modules.select("id", F.lit("Module").alias("label"), F.col("m").alias("name"), idf.module_name(F.col("m")).alias("text"), F.col("m").alias("module")))
    nodes = nodes.unionByName(modules.select(F.concat(F.lit("doc_"), "filename").alias("id"), F.lit("Document").alias("label"), F.col("filename").alias("name"), none.alias("text"), "module"))
    nodes = nodes.unionByName(cut.select(F.col("chunk_id").alias("id"), F.lit("Chunk").alias("label"), F.col("chunk_id").alias("name"), F.col("chunk").alias("text"), none.alias("module")))
    nodes = nodes.unionByName(parameters.select(F.col("param_id").alias("id"), F.lit("ConfigParameter").alias("label"), "name", F.col("description").alias("text"), "module"))
    nodes = stamp(graph.keep_first(nodes.select(*columns), ["id"], ["label", F.col("text").isNull(), "text"]), as_of, 1.0)

    def edges(df: DataFrame, src, dst, kind: str) -> DataFrame:
        return df.select(src.alias("src"), dst.alias("dst"), F.lit(kind).alias("type"))

    mentions = cut.select("chunk_id", F.explode("req_ids").alias("id"))
    direct = cut.join(modules, "filename").filter("module <> 'Unknown'").select("chunk_id", "module")
    rest = mentions.join(direct, "chunk_id", "left_anti").join(known.select("id", "module"), "id").select("chunk_id", "module").distinct()
    out = [
        edges(pairs, requirement(F.col("from_id")), requirement(F.col("to_id")), "REFERENCES"),
        edges(known, module(F.col("module")), requirement(F.col("id")), "HAS_REQUIREMENT"),
        edges(parameters, module(F.col("module")), F.col("param_id"), "HAS_PARAMETER"),
        edges(modules, F.concat(F.lit("doc_"), "filename"), module(F.col("module")), "SPECIFIES"),
        edges(cut, F.concat(F.lit("doc_"), "filename"), F.col("chunk_id"), "HAS_CHUNK"),
        edges(cut.filter("next_chunk_id IS NOT NULL"), F.col("chunk_id"), F.col("next_chunk_id"), "NEXT_CHUNK"),
        edges(cut.filter("prev_chunk_id IS NOT NULL"), F.col("chunk_id"), F.col("prev_chunk_id"), "PREV_CHUNK"),
        edges(mentions, F.col("chunk_id"), requirement(F.col("id")), "MENTIONS"),
        edges(direct.unionByName(rest), F.col("chunk_id"), module(F.col("module")), "SOURCED_FROM"),
    ]
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    whole = whole.distinct()
    return nodes, whole.join(nodes.select(F.col("id").alias("src")), "src", "left_semi").join(nodes.select(F.col("id").alias("dst")), "dst", "left_semi").select("src", "dst", "type")


def _entities(cleaned: DataFrame, cut: DataFrame, parameters: DataFrame, names: DataFrame | None, as_of: str, types: list[str]) -> tuple[DataFrame, DataFrame]:
    """Concepts of glossaries, and entities of a list ``names (name, label)``, with the chunks that mention them and the pairs that one chunk mentions."""
    terms = extract.glossary_terms(cleaned.filter("content_type = 'glossary'"), ["filename", "page_1idx"], "markdown")
    concepts = terms.groupBy("term").agg(F.min_by("definition", F.struct("filename", "page_1idx")).alias("text")).select("term", "text", F.lit("Concept").alias("label"))
    listed = concepts.select(F.col("term").alias("name"), "label")
    if names is not None:
        typed = F.when(resolve.normal_label(F.col("label")).isin(*types), resolve.normal_label(F.col("label"))).otherwise("Concept")
        listed = listed.unionByName(names.select("name", typed.alias("label")))
    listed = written(listed.groupBy("name").agg(F.min("label").alias("label")), "names")
    found = written(extract.gazetteer(cut, "chunk_id", "chunk", listed), "entities")
    met, _ = extract.validate_relations(extract.cooccurring_names(found, "chunk_id"), cut, "chunk_id", "chunk")
    ident = lambda c: tx.safe_node_id(F.lit("entity"), F.col(c))
    used = listed.join(found.select("name").distinct(), "name", "left_semi").join(concepts.select(F.col("term").alias("name"), "text"), "name", "left")
    used = used.unionByName(concepts.select(F.col("term").alias("name"), "label", "text")).distinct()
    nodes = used.select(ident("name").alias("id"), "label", "name", "text", F.lit(None).cast("string").alias("module"))
    nodes = stamp(graph.keep_first(nodes, ["id"], ["label", F.col("text").isNull(), "name"]), as_of, 0.90, "glossary")
    mentions = found.select(F.col("chunk_id").alias("src"), ident("name").alias("dst"), F.lit("MENTIONS").alias("type"))
    related = met.select(ident("src_name").alias("src"), ident("dst_name").alias("dst"), F.lit("REFERENCES").alias("type")).filter("src <> dst")
    return nodes, mentions.unionByName(related).distinct()


def embedded(nodes: DataFrame, edges: DataFrame, embed: Callable[[Column], Column], k: int = NEIGHBOURS, least: float = LEAST_SCORE) -> tuple[DataFrame, DataFrame]:
    """Nodes with ``embedding``, of a chunk's text, or of a summary or the first 100 characters of what else has one; and SIMILAR_TO edges between near chunks."""
    summary = F.coalesce(F.col("summary"), F.substring("text", 1, 100)) if "summary" in nodes.columns else F.substring("text", 1, 100)
    text = F.when(F.col("label") == "Chunk", F.col("text")).otherwise(F.coalesce(summary, F.col("name")))
    made = written(nodes.drop("embedding").withColumn("embedding", embed(text)), "embedded")
    near = vectors.nearest(made.filter("label = 'Chunk' AND embedding IS NOT NULL"), "id", "embedding", k, 2 * least - 1)
    return made, edges.unionByName(near.select(F.col("a").alias("src"), F.col("b").alias("dst"), F.lit("SIMILAR_TO").alias("type")))


def same_entities(nodes: DataFrame, edges: DataFrame, least: float = SAME, labels: tuple[str, ...] = ("Concept", "Function", "System", "Organization")) -> tuple[DataFrame, DataFrame]:
    """Entities of one label whose vectors are as near as ``least`` become the first of them, antonyms apart; then those named ``Concept_X`` become ``X``."""
    some = nodes.filter(F.col("label").isin(*labels) & F.col("embedding").isNotNull())
    found = vectors.similar_components(some.select("id", "embedding", "label"), "id", "embedding", least, ["label"], resolve.guarded(some, "id", "name"))
    aliases = written(found.filter("id <> cluster").select(F.col("id").alias("old"), F.col("cluster").alias("new")), "merged")
    kept = nodes.join(aliases.select(F.col("old").alias("id")), "id", "left_anti")
    return resolve.merge_prefixed(kept, resolve.remap_edges(edges, aliases))


def resolve_names(nodes: DataFrame, edges: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of the same label and canonical name become the first of them; chains of renames are followed, edges moved."""
    keyed = resolve.canonical(nodes.withColumn("label", resolve.normal_label(F.col("label"))), names, "id", "name")
    merged = keyed.filter("label <> 'Chunk'").groupBy("label", F.lower("canonical").alias("c")).agg(F.min("id").alias("new"), F.count("*").alias("n")).filter("n > 1")
    aliases = keyed.withColumn("c", F.lower("canonical")).join(merged, ["label", "c"]).select(F.col("id").alias("old"), "new").filter("old <> new")
    kept = keyed.join(aliases.select(F.col("old").alias("id")), "id", "left_anti").withColumn("name", F.when(F.col("label") == "Chunk", F.col("name")).otherwise(F.col("canonical"))).drop("canonical")
    return kept, resolve.remap_edges(edges, resolve.follow(aliases))


def run(raw: DataFrame, folder: str, as_of: str, names: DataFrame | None = None, from_stage: int = 0, entities: DataFrame | None = None, embed: Callable[[Column], Column] = tx.embedding, types: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """All stages over ``raw`` pages, each read again where its table is complete; stages from ``from_stage`` on are made anew.

    ``names (alias, canonical)`` gives canonical names; without it spellings of
    one name become the most frequent one. ``entities (name, label)`` are looked
    for in chunks; labels beyond ``NODE_TYPES`` and ``types`` become Concept. ``embed`` is a model's vectors, or what stands for them.
    """
    stages = Stages(raw.sparkSession, folder)
    if from_stage:
        stages.invalidate(from_stage)
    cleaned = stages.run(2, "clean", lambda: clean(raw, embed=embed).orderBy("filename", "page_1idx"))
    cut = stages.run(4, "chunks", lambda: chunk(cleaned)[0])
    parameters = stages.run(5, "parameters", lambda: chunk(cleaned)[1])

    def built():
        nodes, edges = build(cleaned, cut, parameters, as_of)
        more, between = _entities(cleaned, cut, parameters, entities, as_of, extended(NODE_TYPES, types or []))
        nodes = nodes.unionByName(more.join(nodes.select("id"), "id", "left_anti"))
        summaries = cut.select(F.col("chunk_id").alias("id"), "summary")
        return nodes.join(summaries, "id", "left"), edges.unionByName(between).distinct()

    nodes = stages.run(6, "nodes", lambda: built()[0])
    edges = stages.run(6, "edges", lambda: built()[1])
    nodes, edges = resolve_names(nodes, edges, resolve.spelling_names(nodes.filter("label <> 'Chunk'"), "name") if names is None else names)
    with_vectors = embedded(nodes, edges, embed)
    nodes, edges = same_entities(stages.run(7, "embedded", lambda: with_vectors[0]), stages.run(7, "similar", lambda: with_vectors[1]))
    write_graph(nodes, edges, f"{folder}/graph")
    return nodes, edges
