"""The maintenance cycle: agents as functions of the graph that return new edges, node updates and a report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import graph, maintain, vectors
from ..session import written


@dataclass
class Report:
    """What an agent did; ``errors`` are kept, not raised."""

    agent: str
    counts: dict[str, int] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)
    listed: list[str] = field(default_factory=list)

    def to_dict(self) -> dict:
        return asdict(self)


def _some(df: DataFrame, *columns: str, most: int = 50) -> list[str]:
    """The first rows of what an agent found, for its report."""
    return [r[0] for r in df.select(F.concat_ws(" -> ", *columns).alias("x")).orderBy("x").limit(most).collect()]


@dataclass
class Graph:
    """``nodes (id, label, name, text, module, ingested_at, confidence_score, extraction_method, pipeline_version, stale_reasons, ...)`` and ``edges (src, dst, type, confidence, verified)``."""

    nodes: DataFrame
    edges: DataFrame

    def of(self, *types: str) -> DataFrame:
        return self.edges.filter(F.col("type").isin(*types))


def prepared(nodes: DataFrame, edges: DataFrame) -> Graph:
    """A graph with the columns that the agents fill, null where they are new."""
    for c, kind in (("stale_reasons", "string"), ("self_conflict", "boolean"), ("summary", "string"), ("last_summarized_at", "timestamp")):
        nodes = nodes if c in nodes.columns else nodes.withColumn(c, F.lit(None).cast(kind))
    for c, kind in (("confidence", "double"), ("verified", "boolean")):
        edges = edges if c in edges.columns else edges.withColumn(c, F.lit(None).cast(kind))
    return Graph(nodes, edges)


def _with_edges(g: Graph, new: DataFrame) -> Graph:
    """New edges merged by source, target and type."""
    return Graph(g.nodes, written(graph.upsert(g.edges, new, ["src", "dst", "type"]), "edges"))


def evolution(g: Graph, as_of: str, labels: tuple[str, ...] = ("Requirement", "Entity", "Concept"), version: str = "1", days: int = 30, least: float = 0.70) -> tuple[Graph, Report]:
    why = maintain.evolution_reasons(F.col("ingested_at"), F.col("confidence_score"), F.col("extraction_method"), F.col("pipeline_version"), F.to_timestamp(F.lit(as_of)), days, least, F.lit(version))
    nodes = written(g.nodes.withColumn("stale_reasons", F.when(F.col("label").isin(*labels), F.nullif(why, F.lit("")))), "nodes")
    stale = nodes.filter("stale_reasons IS NOT NULL")
    return Graph(nodes, g.edges), Report("evolution_agent", {"stale": stale.count()}, listed=_some(stale, "id", most=100))


def conflict(g: Graph, alike: float = 0.92, most: int = 30) -> tuple[Graph, Report]:
    """Loops, requirements of two modules, and concepts whose vectors are nearer than ``alike`` by the index score, of which the ``most`` nearest count."""
    loops = graph.two_way(g.of("DEPENDS_ON")).toDF("src", "dst")
    selfish = g.of("REFERENCES").filter("src = dst").select(F.col("src").alias("id")).distinct()
    dual = graph.shared_targets(g.of("HAS_REQUIREMENT")).select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()
    found = loops.unionByName(dual)
    if "embedding" in g.nodes.columns:
        concepts = g.nodes.filter("label = 'Concept' AND embedding IS NOT NULL")
        near = vectors.similar_pairs(concepts, "id", "embedding", 2 * alike - 1).orderBy(F.desc("cosine"), "a", "b").limit(most)
        found = found.unionByName(near.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    new = written(found.distinct().withColumn("type", F.lit("CONTRADICTS")), "conflicts")
    nodes = written(g.nodes.drop("self_conflict").join(selfish.withColumn("self_conflict", F.lit(True)), "id", "left"), "nodes")
    return _with_edges(Graph(nodes, g.edges), new), Report("conflict_agent", {"conflicts": new.count(), "self_conflicts": nodes.filter("self_conflict").count()}, listed=_some(new, "src", "dst"))


def synthesis(g: Graph, least: float = 0.70, shared: int = 2, limit: int = 500) -> tuple[Graph, Report]:
    """Pairs that share neighbours become hypotheses; without a model the confidence grows with the shared ones. Rejected pairs may come again."""
    rejected = g.of("HYPOTHESIZES").filter("verified = false").select("src", "dst")
    found = graph.bridges(g.edges.filter("type NOT IN ('HAS_CHUNK', 'NEXT_CHUNK', 'PREV_CHUNK')"), shared, rejected).orderBy(F.desc("shared"), "a", "b").limit(limit)
    guess = F.round(F.lit(1.0) - F.lit(0.5) / F.col("shared"), 3)
    new = written(found.select(F.col("a").alias("src"), F.col("b").alias("dst"), F.lit("HYPOTHESIZES").alias("type"), guess.alias("confidence")).filter(F.col("confidence") >= least), "hypotheses")
    return _with_edges(g, new), Report("synthesis_agent", {"written": new.count()}, listed=_some(new, "src", "dst"))


def verification(g: Graph, batch: int = 20) -> tuple[Graph, Report]:
    """Hypotheses that are not accepted are tested, also rejected ones; those never tested come first."""
    pending = g.of("HYPOTHESIZES").filter("verified IS NULL OR verified = false").orderBy(F.col("verified").isNotNull(), "src", "dst").limit(batch)
    facts = g.nodes.select("id", F.col("stale_reasons").isNotNull().alias("stale"))
    found = maintain.hypothesis_evidence(pending, facts, g.of("CONTRADICTS"))
    said = found.withColumn("v", maintain.verdict(maintain.counter_score(F.col("stale_ends"), F.col("contradictions")), F.lit(0.0)))
    new = written(said.select("src", "dst", F.lit("HYPOTHESIZES").alias("type"), F.col("v.confidence").alias("confidence"), (F.col("v.verdict") == "accepted").alias("verified")), "verdicts")
    return _with_edges(g, new), Report("verification_agent", {"accepted": new.filter("verified").count(), "rejected": new.filter("NOT verified").count()})


def summarization(g: Graph, as_of: str | None = None, most: int = 30, size: int = 8000) -> tuple[Graph, Report]:
    """Modules with chunks newer than their last summary get the beginnings of those, in order, up to a cap, behind what they have."""
    sourced = g.of("SOURCED_FROM").select(F.col("src").alias("chunk"), F.col("dst").alias("module_id"))
    text = g.nodes.filter("label = 'Chunk'").select(F.col("id").alias("chunk"), "ingested_at", F.substring("text", 1, 800).alias("part"))
    mark = g.nodes.filter("label = 'Module'").select(F.col("id").alias("module_id"), "summary", "last_summarized_at")
    ranked = graph.Window.partitionBy("module_id").orderBy("chunk")
    new = sourced.join(text, "chunk").join(mark, "module_id").filter("last_summarized_at IS NULL OR ingested_at > last_summarized_at")
    top = new.withColumn("k", F.row_number().over(ranked)).filter(F.col("k") <= most)
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "part"))), lambda x: x["part"]), "\n")
    made = top.groupBy(F.col("module_id").alias("id")).agg(F.first("summary", ignorenulls=True).alias("old"), parts.alias("new"), F.max("ingested_at").alias("newest"))
    at = F.to_timestamp(F.lit(as_of)) if as_of else F.col("newest")
    made = written(made.select("id", maintain.capped(F.concat_ws("\n", "old", "new"), size).alias("summary"), at.alias("last_summarized_at")), "summaries")
    return Graph(written(graph.upsert(g.nodes, made, ["id"]), "nodes"), g.edges), Report("summarization_agent", {"updated": made.count()}, listed=_some(made, "id"))


def gap_detection(g: Graph, limit: int = 150, least: float = 0.65) -> tuple[Graph, Report]:
    """References into another module of which no other requirement names the referring module.

    A gap is written from a confidence of ``least`` on. Without a model that is
    0.7 where the target says nothing, and 0.9 where it has a text.
    """
    owner = g.of("HAS_REQUIREMENT").select(F.col("dst").alias("id"), F.col("src").alias("m"))
    refs = g.of("REFERENCES").select(F.col("src").alias("ra"), F.col("dst").alias("rb"))
    both = refs.join(owner.toDF("ra", "ma"), "ra").join(owner.toDF("rb", "mb"), "rb").filter("ma <> mb")
    named = g.nodes.filter("label = 'Module'").select(F.col("id").alias("ma"), F.col("name").alias("ma_name"))
    other = owner.toDF("rx", "mx")
    met = both.join(named, "ma").join(other, (F.col("mb") == F.col("mx")) & (F.col("rx") != F.col("rb")) & F.contains(F.lower("rx"), F.lower("ma_name"))).select("ra", "rb")
    said = g.nodes.select(F.col("id").alias("rb"), F.when(F.coalesce("text", F.lit("")) != "", 0.9).otherwise(0.7).alias("confidence"))
    gaps = both.join(met, ["ra", "rb"], "left_anti").select("ra", "rb").distinct().orderBy("ra", "rb").limit(limit).join(said, "rb")
    new = written(gaps.filter(F.col("confidence") >= least).select(F.col("ra").alias("src"), F.col("rb").alias("dst"), F.lit("SPEC_GAP").alias("type"), "confidence"), "gaps")
    return _with_edges(g, new), Report("gap_detection_agent", {"gaps": new.count()})


def impact(g: Graph, node_ids: list[str] | None = None, hops: int = 4, batch: int = 50, most: int = 100) -> tuple[Graph, Report]:
    changed = g.nodes.filter("stale_reasons IS NOT NULL OR (self_conflict AND id IS NOT NULL)").select("id").orderBy("id").limit(batch) if node_ids is None else g.nodes.filter(F.col("id").isin(node_ids)).select("id")
    found = graph.impact(g.edges, changed, hops)
    ranked = graph.Window.partitionBy("seed").orderBy("hops", F.desc("score"), "node")
    top = found.withColumn("k", F.row_number().over(ranked)).filter(F.col("k") <= most)
    new = written(top.select(F.col("seed").alias("src"), F.col("node").alias("dst"), F.lit("IMPACT_OF").alias("type"), F.col("score").alias("confidence")), "impacts")
    return _with_edges(g, new), Report("impact_agent", {"changed": changed.count(), "affected": new.count()})


def watchdog(g: Graph, errors: list[str], threshold: float = 0.70) -> tuple[DataFrame, float]:
    """Metrics of agents, and the acceptance threshold of the next cycle. Errors count for an agent by the first word of its name."""
    h = g.of("HYPOTHESIZES").agg(F.count("*").alias("h"), F.count_if(F.col("verified") == False).alias("r"), F.round(F.coalesce(F.avg("confidence"), F.lit(0.0)), 3).alias("c")).first()  # noqa: E712
    rows = [("synthesis_agent", h["h"], h["r"], h["c"], 0), ("conflict_agent", 0, 0, 0.0, g.of("CONTRADICTS").count()), ("evolution_agent", g.nodes.filter("stale_reasons IS NOT NULL").count(), 0, 0.0, 0)]
    made = []
    for name, n, r, c, k in rows:
        failed = sum(name.split("_")[0] in e.lower() for e in errors)
        made.append((name, n, r, float(c), k, round(r / n, 3) if n else 0.0, failed, round(failed / max(n + k, 1), 3)))
    m = g.nodes.sparkSession.createDataFrame(made, "agent string, items long, rejected long, avg_confidence double, conflicts long, rejection_rate double, errors long, error_rate double")
    m = m.withColumn("health", maintain.health(F.col("rejection_rate"), F.col("error_rate")))
    raised = min(round(threshold + 0.05, 2), 0.95) if made[0][5] >= 0.40 else threshold
    return m, raised


AGENTS: dict[str, Callable[..., tuple[Graph, Report]]] = {"conflict": conflict, "synthesis": synthesis, "verification": verification, "summarization": summarization, "gap-detection": gap_detection, "impact": impact}


def captured(name: str, g: Graph, step: Callable[[Graph], tuple[Graph, Report]]) -> tuple[Graph, Report]:
    """An agent's result; one that fails leaves the graph as it was, and its error in the report."""
    try:
        return step(g)
    except Exception as e:  # noqa: BLE001  The contract of agents: errors are captured.
        return g, Report(f"{name.replace('-', '_')}_agent", errors=[f"{name}: {e}"])


def single(name: str, g: Graph, **options) -> tuple[Graph, Report]:
    """One agent by name."""
    step = evolution if name == "evolution" else AGENTS[name]
    return captured(name, g, lambda x: step(x, **options))


STATE = "as_of string, step int, agent string, counts map<string,long>, errors array<string>, listed array<string>, threshold double, status string"


def run_cycle(g: Graph, as_of: str, threshold: float = 0.70, folder: str | None = None, question: str | None = None) -> tuple[Graph, dict]:
    """All agents in order, then a question if there is one. An error makes the state failed.

    With ``folder`` the state is appended to a table there after each agent, so
    a cycle that breaks off shows how far it came.
    """
    state: dict = {"as_of": as_of, "reports": [], "errors": []}
    spark = g.nodes.sparkSession

    def keep(report: Report, status: str) -> None:
        if folder:
            row = (as_of, len(state["reports"]), report.agent, report.counts, report.errors, report.listed, threshold, status)
            spark.createDataFrame([row], STATE).write.mode("append").parquet(f"{folder}/cycle_state")

    steps: dict[str, Callable[[Graph], tuple[Graph, Report]]] = {"evolution": lambda x: evolution(x, as_of)} | AGENTS
    steps |= {"synthesis": lambda x: synthesis(x, threshold), "summarization": lambda x: summarization(x, as_of)}
    for name, step in steps.items():
        g, report = captured(name, g, step)
        state["reports" if not report.errors else "errors"] += [report.to_dict()] if not report.errors else report.errors
        keep(report, "running")
    if question:
        from .answer import ask

        asked = spark.createDataFrame([(0, question)], "question_id long, question string")
        state["answer"] = ask(asked, g.nodes, g.edges, as_of).drop("question_id").first().asDict()
    metrics, raised = watchdog(g, state["errors"], threshold)
    totals = {k: sum(r["counts"].get(k, 0) for r in state["reports"]) for r in state["reports"] for k in r["counts"]}
    state |= {"metrics": [r.asDict() for r in metrics.collect()], "next_threshold": raised, "totals": totals, "runs": len(state["reports"]), "status": "failed" if state["errors"] else "complete"}
    keep(Report("watchdog_agent", totals, state["errors"]), state["status"])
    return g, state
