"""Property graphs as tables: ``nodes (id, label, ...)`` and ``edges (src, dst, type, ...)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import pieces, written

# What an edge type weighs in an impact, and the weight of others.
EDGE_WEIGHTS = {"MENTIONS": 0.2, "SIMILAR_TO": 0.3, "SOURCED_FROM": 0.4, "HYPOTHESIZES": 0.4, "REFERENCES": 0.6, "HAS_PARAMETER": 0.6, "HAS_REQUIREMENT": 0.8, "DEPENDS_ON": 0.9, "CONTRADICTS": 1.0}
OTHER_WEIGHT = 0.3
#: Ends of a node that one task pairs.
_BLOCK = 1024


def keep_first(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row a key, the first in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__wl_n", F.row_number().over(w)).filter("__wl_n = 1").drop("__wl_n")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], nulls_remove: bool = False) -> DataFrame:
    """``old`` with ``new`` merged in by key: columns of ``new`` win where they are not null, or always with ``nulls_remove``. Columns of both are kept."""
    a, b = old.alias("a"), new.withColumn("__wl_new", F.lit(True)).alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    names = [*old.columns, *[c for c in new.columns if c not in old.columns]]

    def pick(c: str) -> Column:
        both = [F.col(f"b.{c}")] * (c in new.columns) + [F.col(f"a.{c}")] * (c in old.columns)
        if nulls_remove and len(both) == 2 and c not in keys:
            return F.when(F.col("b.__wl_new"), both[0]).otherwise(both[1]).alias(c)
        return F.coalesce(*both).alias(c)

    return a.join(b, on, "full_outer").select(*[pick(c) for c in names])


def dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges of which an end is no node."""
    ids, n = nodes.select("id").distinct(), pieces(edges)
    out = edges
    for end in ("src", "dst"):
        out = out.repartition(n, end).join(ids.select(F.col("id").alias(end), F.lit(True).alias(f"__wl_{end}")), end, "left")
    return out.filter(F.col("__wl_src").isNull() | F.col("__wl_dst").isNull()).select(*edges.columns)


def isolated(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id")))
    return nodes.join(ends, "id", "left_anti")


def two_way(edges: DataFrame) -> DataFrame:
    """``(a, b)`` with ``a < b`` and edges both ways."""
    there = edges.filter("src < dst").select(F.col("src").alias("a"), F.col("dst").alias("b"))
    return there.join(edges.filter("src > dst").select(F.col("dst").alias("a"), F.col("src").alias("b")), ["a", "b"], "left_semi").distinct()


def pairs_at(links: DataFrame, block: int = _BLOCK) -> DataFrame:
    """``(m, a, b)`` with ``a < b``: pairs of the ends ``a`` that ``links (m, a)``, distinct rows, has at the same ``m``.

    The ends of a node with more than ``block`` are dealt out as pairs of blocks,
    so a hub is the work of many tasks; nodes with one end are left out.
    """
    size = written(links.groupBy("m").agg(F.count("*").alias("n")).filter("n > 1").select("m", F.ceil(F.col("n") / block).cast("int").alias("k")), "degrees")
    own = F.pmod(F.xxhash64("a"), F.col("k")).cast("int")
    dealt = links.join(size, "m").withColumn("own", own).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    dealt = dealt.select("m", "a", "own", F.least("own", "o").alias("x"), F.greatest("own", "o").alias("y"))
    other = dealt.select("m", "x", "y", F.col("a").alias("b"), F.col("own").alias("own_b"))
    return dealt.join(other, ["m", "x", "y"]).filter((F.col("a") < F.col("b")) & ((F.col("x") == F.col("y")) | (F.col("own") != F.col("own_b")))).select("m", "a", "b")


def shared_targets(edges: DataFrame) -> DataFrame:
    """``(dst, a, b)``: pairs of sources of the same target."""
    return pairs_at(edges.select(F.col("dst").alias("m"), F.col("src").alias("a")).distinct()).withColumnRenamed("m", "dst")


def bridges(edges: DataFrame, least: int = 2, rejected: DataFrame | None = None) -> DataFrame:
    """``(a, b, shared)``: pairs without an edge that share at least ``least`` neighbours; rejected edges ``(src, dst)`` do not count as edges.

    Nodes with fewer than ``least`` neighbours are no ends of such a pair and are left out first.
    """
    both = edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).filter("src <> dst").distinct()
    direct = both
    if rejected is not None:
        gone = rejected.select("src", "dst").union(rejected.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        direct = both.join(gone, ["src", "dst"], "left_anti")
    direct = written(direct, "neighbours")
    wide = direct.groupBy("src").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select(F.col("src").alias("a"))
    links = direct.select(F.col("src").alias("m"), F.col("dst").alias("a")).join(wide, "a", "left_semi").select("m", "a")
    counts = pairs_at(links).groupBy("a", "b").agg(F.count("*").alias("shared")).filter(F.col("shared") >= least)
    return counts.join(direct.select(F.col("src").alias("a"), F.col("dst").alias("b")), ["a", "b"], "left_anti")


def breadth_first(edges: DataFrame, seeds: DataFrame, max_hops: int = 4) -> DataFrame:
    """``(seed, node, hops, best)`` for nodes within ``max_hops`` of each seed, edges taken both ways; ``best`` is the largest weight on a shortest path.

    ``edges`` has ``(src, dst, weight)``. Each hop joins the frontier, drops what
    was visited, and is written, so the plan stays short.
    """
    both = edges.select("src", "dst", "weight").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    both = written(both.groupBy("src", "dst").agg(F.max("weight").alias("weight")), "edges")
    front = seeds.select(F.col("id").alias("seed"), F.col("id").alias("node"), F.lit(0).alias("hops"), F.lit(0.0).alias("best")).distinct()
    seen = written(front, "reached")
    front = seen
    for hop in range(1, max_hops + 1):
        step = front.join(both, front["node"] == both["src"]).groupBy("seed", both["dst"].alias("node")).agg(F.max(F.greatest("best", "weight")).alias("best"))
        front = written(step.join(seen.select("seed", "node"), ["seed", "node"], "left_anti").select("seed", "node", F.lit(hop).alias("hops"), "best"), "front")
        if front.isEmpty():
            break
        seen = written(seen.union(front), "reached")
    return seen.filter("hops > 0")


def impact(edges: DataFrame, changed: DataFrame, max_hops: int = 4, derived: tuple[str, ...] = ("IMPACT_OF",)) -> DataFrame:
    """``(seed, node, hops, score, severity)``: the largest weight on a shortest path over its hops. Derived edges are not followed."""
    weights = F.create_map(*[F.lit(x) for pair in EDGE_WEIGHTS.items() for x in pair])
    weighed = edges.filter(~F.col("type").isin(*derived)).select("src", "dst", F.coalesce(F.element_at(weights, F.col("type")), F.lit(OTHER_WEIGHT)).alias("weight"))
    reached = breadth_first(weighed, changed, max_hops)
    score = F.round(F.col("best") / F.col("hops"), 3)
    return reached.select("seed", "node", "hops", score.alias("score"), severity(score).alias("severity"))


def severity(score: Column) -> Column:
    return F.when(score >= 0.7, "critical").when(score >= 0.4, "major").otherwise("minor")


def _both_ways(edges: DataFrame) -> DataFrame:
    """``(src, dst, type, e)``: edges once each, taken both ways, with what names them."""
    numbered = edges.select("src", "dst", "type").distinct().withColumn("e", F.concat_ws("\x1f", "src", "dst", "type"))
    return written(numbered.select("src", "dst", "type", "e").union(numbered.filter("src <> dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "type", "e")), "edges")


def trails(edges: DataFrame, seeds: DataFrame, max_hops: int = 3) -> DataFrame:
    """``(seed, node, hops, via)``: one row for each trail of up to ``max_hops`` edges, taken both ways, none twice; ``via`` has their types."""
    both, none = _both_ways(edges), F.array().cast("array<string>")
    front = seeds.select(F.col("id").alias("seed"), F.col("id").alias("node"), none.alias("used"), none.alias("via")).distinct()
    out = None
    for hop in range(1, max_hops + 1):
        step = front.join(both, F.col("node") == both["src"]).filter(~F.array_contains("used", F.col("e")))
        front = written(step.select("seed", F.col("dst").alias("node"), F.array_append("used", F.col("e")).alias("used"), F.array_append("via", F.col("type")).alias("via")), "trails")
        part = front.select("seed", "node", F.lit(hop).alias("hops"), "via")
        out = part if out is None else out.union(part)
    return out


def first_trails(edges: DataFrame, seeds: DataFrame, wanted: DataFrame, limit: int, max_hops: int = 3, slack: int = 64) -> DataFrame:
    """``(seed, node, hops, via)``: as ``trails``, but of each seed and number of hops only the first ``limit`` that end in a ``wanted (node)``, by node and types.

    Trails are made from their end: a node keeps the first of its own, and the
    nodes before it add an edge to those. So a hub's are made once, not for each
    seed, and no more are kept than edges times ``limit``. Each node keeps
    ``slack`` more than the nodes before it need, since those leave out trails
    that have their edge already; where more are left out, all is done again with
    a larger slack.
    """
    both = _both_ways(edges)
    near = [seeds.select(F.col("id").alias("src")).distinct()]
    for _ in range(max_hops - 2):
        near.append(written(near[-1].union(near[-1].join(both, "src").select(F.col("dst").alias("src"))).distinct(), "near"))
    ends = both.join(wanted.select(F.col("node").alias("dst")).distinct(), "dst", "left_semi")
    while True:
        now, out, enough = None, None, True
        for hop in range(1, max_hops + 1):
            keep = limit + slack * (max_hops - hop)
            if now is None:
                step = ends.select("src", F.col("dst").alias("node"), F.array("e").alias("used"), F.array("type").alias("via"))
            else:
                some = both.join(near[max_hops - hop], "src", "left_semi").withColumnRenamed("dst", "at")
                step = some.join(now.withColumnRenamed("src", "at"), "at")
                lost = step.filter(F.array_contains("used", F.col("e"))).groupBy("src", "e").agg(F.count("*").alias("n")).filter(F.col("n") > slack)
                if not lost.isEmpty():
                    enough = False
                    break
                step = step.filter(~F.array_contains("used", F.col("e")))
                step = step.select("src", "node", F.array_prepend("used", F.col("e")).alias("used"), F.array_prepend("via", F.col("type")).alias("via"))
            order = Window.partitionBy("src").orderBy("node", F.concat_ws(",", "via"), "used")
            now = written(step.withColumn("__wl_n", F.row_number().over(order)).filter(F.col("__wl_n") <= keep).drop("__wl_n"), "trails")
            of = now.join(near[0], "src", "left_semi")
            if keep > limit:
                of = of.withColumn("__wl_n", F.row_number().over(order)).filter(F.col("__wl_n") <= limit)
            part = of.select(F.col("src").alias("seed"), "node", F.lit(hop).alias("hops"), "via")
            out = part if out is None else out.union(part)
        if enough:
            return out
        slack *= 4


def audit(nodes: DataFrame, edges: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``(check, n)``: how many nodes are isolated, and how many meet each condition; one pass for all conditions."""
    counted = nodes.agg(*[F.count_if(c).alias(k) for k, c in checks.items()])
    stacked = counted.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("n")) for k in checks])).alias("x")).select("x.*")
    return stacked.unionByName(isolated(nodes, edges).agg(F.count("*").alias("n")).select(F.lit("isolated").alias("check"), "n"))


def merge_counts(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``(submitted, created, changed)``: what a merge of ``new`` by key does."""
    met = new.join(old.select(*keys).withColumn("__wl_old", F.lit(1)), keys, "left")
    return met.agg(F.count("*").alias("submitted"), F.count_if(F.col("__wl_old").isNull()).alias("created"), F.count("__wl_old").alias("changed"))


def full_audit(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(check, n)`` of a stored graph: the eight audits, by two aggregations; edges may repeat, and documents be isolated."""
    none = lambda c: F.col(c).isNull() if c in nodes.columns else F.lit(True)
    requirement, chunk = F.col("label") == "Requirement", F.col("label") == "Chunk"
    counted = nodes.agg(
        F.count_if(requirement & (F.coalesce("text", F.lit("")) == "")).alias("requirement_without_text"), F.count_if(chunk & none("embedding")).alias("chunk_without_embedding"),
        F.count_if(requirement & none("ingested_at")).alias("requirement_without_ingested_at"), F.count_if(requirement & none("confidence_score")).alias("requirement_without_confidence"),
    )
    # What is asked of the nodes of each name, and the ends that answer it: a bit each, so nodes and ends meet in one aggregation.
    asked = {"isolated": F.col("label") != "Document", "module_without_requirement": F.col("label") == "Module", "chunk_without_document": chunk, "chunk_without_module": chunk}
    bits = lambda *conditions: F.array(*[F.when(c, 1).otherwise(0) for c in conditions])
    kind = F.col("type")
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").cast("string").alias("id"), bits(F.lit(True), kind == "HAS_REQUIREMENT", F.lit(False), kind == "SOURCED_FROM").alias("met")),
        F.struct(F.col("dst").cast("string").alias("id"), bits(F.lit(True), F.lit(False), kind == "HAS_CHUNK", F.lit(False)).alias("met")),
    )).alias("x")).select("x.*").filter("id IS NOT NULL")
    zero, checks = F.lit(0), list(enumerate(asked))
    ends = ends.select("id", *[zero.cast("long").alias(f"n{i}") for i, _ in checks], *[F.col("met")[i].alias(f"m{i}") for i, _ in checks])
    rows = nodes.select(F.col("id").cast("string").alias("id"), *[F.when(c, 1).otherwise(0).cast("long").alias(f"n{i}") for i, c in enumerate(asked.values())], *[zero.alias(f"m{i}") for i, _ in checks])
    each = ends.unionByName(rows).groupBy("id").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i, _ in checks], *[F.max(f"m{i}").alias(f"m{i}") for i, _ in checks])
    apart = each.agg(*[F.coalesce(F.sum(F.when(F.col(f"m{i}") == 0, F.col(f"n{i}"))), zero.cast("long")).alias(c) for i, c in checks])
    stacked = [d.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("n")) for c in d.columns])).alias("x")).select("x.*") for d in (counted, apart)]
    return stacked[0].unionByName(stacked[1])


def sample_queries(nodes: DataFrame, edges: DataFrame, least: float = 0.70, paths: int = 20) -> dict[str, DataFrame]:
    """The views that a new graph is looked at with: labels, modules, paths of references, chunks of modules, low confidence by label."""
    refs = edges.filter("type = 'REFERENCES'").select("src", "dst")
    chain = refs.toDF("a", "b").join(refs.toDF("b", "c"), "b").filter("a <> c").select("a", "b", "c").orderBy("a", "b", "c").limit(paths)
    count = lambda kind, end: edges.filter(F.col("type") == kind).groupBy(F.col(end).alias("module")).agg(F.count("*").alias("n"))
    return {
        "labels": nodes.groupBy("label").agg(F.count("*").alias("n")), "requirements_of_modules": count("HAS_REQUIREMENT", "src"), "reference_paths": chain,
        "chunks_of_modules": count("SOURCED_FROM", "dst"), "low_confidence": nodes.filter(F.col("confidence_score") < least).groupBy("label").agg(F.count("*").alias("n")),
    }
