"""Maintenance of a stored graph: flags, conflicts, hypotheses, metrics, memory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evolution_reasons(ingested: Column, confidence: Column, method: Column, version: Column, as_of: Column, days: int = 30, least: float = 0.70, current: Column | None = None) -> Column:
    """Why a node is stale: age_exceeded, low_confidence, schema_drift, in that order, with commas; empty if it is not. Nulls give no reason."""
    old = ingested < as_of - F.expr(f"INTERVAL {days} DAYS")
    low = (confidence < least) & (method != "rule_based")
    drift = version != current if current is not None else F.lit(False)
    return F.concat_ws(",", F.when(old, "age_exceeded"), F.when(low, "low_confidence"), F.when(drift, "schema_drift"))


def counter_score(stale_ends: Column, contradictions: Column) -> Column:
    """Evidence in the graph against a hypothesis, 0 to 1, to two places."""
    return F.round(F.least(F.lit(1.0), F.lit(0.25) * stale_ends + F.least(F.lit(0.3) * contradictions, F.lit(0.6))), 2)


def verdict(counter: Column, disproof: Column, reject: float = 0.40, direct: float = 0.90) -> Column:
    """``(verdict, confidence)``: rejected at once from ``direct`` on, else if disproof or 0.7 of the counter-evidence reaches ``reject``."""
    combined = F.round(F.greatest(disproof, F.lit(0.7) * counter), 3)
    refused = (counter >= direct) | (combined >= reject)
    return F.struct(F.when(refused, "rejected").otherwise("accepted").alias("verdict"), F.round(F.lit(1.0) - F.when(counter >= direct, counter).otherwise(combined), 3).alias("confidence"))


def hypothesis_evidence(hypotheses: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(src, dst, stale_ends, contradictions)`` of hypotheses; an edge between the two ends counts at both. ``nodes`` has ``(id, stale)``; ``edges`` are the contradictions."""
    ends = edges.select(F.col("src").alias("id")).union(edges.filter("src <> dst").select(F.col("dst").alias("id"))).groupBy("id").agg(F.count("*").alias("hits"))
    facts = nodes.select("id", F.coalesce("stale", F.lit(False)).cast("int").alias("stale")).join(ends, "id", "full_outer")
    each = hypotheses.select("src", "dst", F.explode(F.array_distinct(F.array("src", "dst"))).alias("id")).join(facts, "id", "left")
    return each.groupBy("src", "dst").agg(F.sum(F.coalesce("stale", F.lit(0))).alias("stale_ends"), F.sum(F.coalesce("hits", F.lit(0))).alias("contradictions"))


def health(rejection: Column, error: Column, ceiling: float = 0.40, error_ceiling: float = 0.20) -> Column:
    """ok, degraded or critical; errors, which are looked at later, override."""
    return F.when(error >= 0.5, "critical").when((error >= error_ceiling) | (rejection >= ceiling), "degraded").otherwise("ok")


def tuned_threshold(now: Column, rejection: Column, ceiling: float = 0.40) -> Column:
    """The acceptance threshold of the next cycle: 0.05 more, 0.95 at most, where the rejection rate reaches its ceiling."""
    return F.when(rejection >= ceiling, F.least(F.round(now + 0.05, 2), F.lit(0.95))).otherwise(now)


def query_patterns(log: DataFrame, question: list[str], at: str, confidence: str) -> DataFrame:
    """``(question, asks, last_confidence, last_asked_at)``: the last by time, ties to the larger confidence."""
    last = F.max(F.struct(F.col(at).alias("at"), F.col(confidence).alias("c"))).alias("last")
    return log.groupBy(*question).agg(F.count("*").alias("asks"), last).select(*question, "asks", F.col("last.c").alias("last_confidence"), F.col("last.at").alias("last_asked_at"))


def vote(legs: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, confidence, primary)`` from legs ``(leg, weight, confidence)``: missing legs do not count, the heaviest present one is primary (ties to the smaller name)."""
    there = legs.filter("confidence IS NOT NULL")
    best = F.min_by("leg", F.struct(-F.col("weight"), F.col("leg"))).alias("primary")
    return there.groupBy(*keys).agg(F.round(F.sum(F.col("confidence") * F.col("weight")) / F.sum("weight"), 3).alias("confidence"), best)


def capped(text: Column, size: int = 8000, mark: str = "\n[truncated]") -> Column:
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit(mark))).otherwise(text)


def context(seeds: DataFrame, nodes: DataFrame, keys: list[str], tokens: int = 6000) -> DataFrame:
    """``(keys, context)``: seeds ``(rank, chunk_id, score, text)`` in order of rank, then nodes ``(hops, label, name, description)`` by hops and name, cut at four characters a token."""
    chunk = F.format_string("[Chunk %s | score=%.3f]\n%s", F.col("chunk_id").cast("string"), "score", F.substring("text", 1, 800))
    entry = F.concat(F.format_string("[%s] %s (hop=%d)", "label", "name", "hops"), F.when(F.coalesce(F.trim("description"), F.lit("")) != "", F.concat(F.lit("\n  → "), F.substring(F.trim("description"), 1, 300))).otherwise(""))
    listed = lambda *order: F.transform(F.array_sort(F.collect_list(F.struct(*order, "entry"))), lambda x: x["entry"])
    first = seeds.withColumn("entry", chunk).groupBy(*keys).agg(listed("rank").alias("a"))
    second = nodes.withColumn("entry", entry).groupBy(*keys).agg(listed("hops", "name").alias("b"))
    parts = F.concat(F.array(F.lit("=== Relevant Document Chunks ===")), "a", F.array(F.lit("\n=== Knowledge Graph Context (multi-hop expansion) ===")), F.coalesce("b", F.array().cast("array<string>")))
    return first.join(second, keys, "left").select(*keys, capped(F.array_join(parts, "\n\n"), tokens * 4, "\n[...context truncated...]").alias("context"))
