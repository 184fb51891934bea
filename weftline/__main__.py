"""Command line: ``python -m weftline COMMAND``."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="weftline")
    sub = p.add_subparsers(dest="command", required=True)
    ingest = sub.add_parser("ingest", help="pages (Parquet), or text files with form feeds between pages, to a graph")
    ingest.add_argument("--pages")
    ingest.add_argument("--files")
    ingest.add_argument("--pattern", default="*.txt")
    ingest.add_argument("--names", help="JSON records of alias and canonical")
    ingest.add_argument("--entities", help="JSON records of name and label")
    ingest.add_argument("--debug", action="store_true")
    ingest.add_argument("--output-dir", required=True)
    ingest.add_argument("--as-of", required=True)
    ingest.add_argument("--from-stage", type=int, default=0)
    ingest.add_argument("--fresh", action="store_true")
    for name in ("cycle", "evolution", "conflict", "synthesis", "verification", "summarization", "gap-detection", "impact", "watchdog", "audit"):
        c = sub.add_parser(name)
        c.add_argument("--graph", required=True)
        c.add_argument("--as-of", required=name in ("cycle", "evolution"))
        c.add_argument("--output-dir")
        c.add_argument("--min-confidence", type=float, default=0.70)
        c.add_argument("--node-id", action="append")
        c.add_argument("--question")
    for name in ("ask", "batch", "serve", "query-memory"):
        c = sub.add_parser(name)
        c.add_argument("--graph", required=name != "query-memory")
        c.add_argument("--as-of", required=name in ("ask", "batch"))
        c.add_argument("--question", required=name in ("ask", "query-memory"))
        c.add_argument("--answer", default="")
        c.add_argument("--confidence", type=float, default=0.0)
        c.add_argument("--input", required=name == "batch")
        c.add_argument("--output")
        c.add_argument("--output-dir", required=name in ("serve", "query-memory"))
        c.add_argument("--least", type=float, default=0.70)
        c.add_argument("--every", default="1 hour")
        c.add_argument("--cycles", type=int, help="ends after so many")
    evaluate = sub.add_parser("eval")
    for flag in ("--gt", "--input", "--output"):
        evaluate.add_argument(flag, required=True)
    sub.add_parser("routes")
    run = sub.add_parser("query", help="a registered query")
    run.add_argument("name")
    run.add_argument("--data", required=True)
    run.add_argument("--output")
    a = p.parse_args(args)

    from .plans import cycle as cy
    from .plans import ingest as ing
    from .plans import models
    from .session import written
    from .sources import tables

    if a.command == "routes":
        print(json.dumps(models.ROUTES, indent=2))
        return 0
    spark = SparkSession.builder.appName("weftline").getOrCreate()
    if a.command == "ingest":
        spark.sparkContext.setLogLevel("DEBUG" if a.debug else "WARN")
        if a.files:
            raw = tables.documents_as_pages(tables.binary_files(spark, a.files, a.pattern).orderBy("path"), tables.text_pages)
        else:
            raw = spark.read.parquet(a.pages)
        records = lambda path, schema: spark.read.schema(schema).option("multiLine", "true").json(path) if path else None
        nodes, edges = ing.run(raw, a.output_dir, a.as_of, records(a.names, "alias string, canonical string"), 1 if a.fresh else a.from_stage, records(a.entities, "name string, label string"))
        print(json.dumps({"nodes": nodes.count(), "edges": edges.count()}))
        return 0
    if a.command == "eval":
        from .operators import evaluate as ev

        gold = tables.json_records(spark, a.gt, tables.GOLD).withColumn("position", F.monotonically_increasing_id())
        scored, unmatched = ev.assembled(tables.json_records(spark, a.input, tables.PREDICTION), gold)
        tables.write_json(scored, a.output)
        print(json.dumps(ev.summary(spark.read.schema(scored.schema).json(a.output), ["rouge1", "rouge2", "rougeL", "bert_score"]).first().asDict() | {"unmatched": unmatched.count()}))
        return 0
    if a.command == "query-memory":
        from .plans import answer as an

        path = tables.Versions(spark, f"{a.output_dir}/query_memory")
        now = a.as_of or datetime.now(UTC).isoformat()
        new = spark.createDataFrame([(a.question, a.confidence, now)], "question string, confidence double, run_at string")
        kept = path.write(an.remember(path.read(an.MEMORY), new))
        hot = kept.filter("ask_count >= 3").orderBy(F.desc("ask_count"), "question").limit(10)
        low = kept.filter("last_confidence < 0.60").orderBy("last_confidence", "question").limit(10)
        print(json.dumps({"patterns": kept.count(), "hot_spots": [r["question"] for r in hot.collect()], "low_confidence": [r["question"] for r in low.collect()]}))
        return 0
    if a.command == "query":
        from .plans import all_queries

        found = all_queries.QUERIES[a.name](spark, a.data)
        found.write.parquet(a.output) if a.output else found.show(50, False)
        return 0
    g = cy.prepared(*tables.read_graph(spark, a.graph))
    if a.command == "audit":
        from .operators.graph import full_audit, sample_queries

        full_audit(g.nodes, g.edges).show(truncate=False)
        for name, view in sample_queries(g.nodes, g.edges).items():
            print(name)
            view.show(truncate=False)
        return 0
    if a.command in ("ask", "batch"):
        from .plans import answer as an

        if a.command == "ask":
            asked = spark.createDataFrame([(0, a.question)], "question_id long, question string")
        else:
            said = tables.json_records(spark, a.input, tables.GOLD)
            asked = said.select(F.monotonically_increasing_id().alias("question_id"), F.col("user_input").alias("question"))
        answers = an.ask(written(asked, "questions"), g.nodes, g.edges, a.as_of, least=a.least)
        if a.output:
            tables.write_json(answers.drop("question_id"), a.output)
        if a.command == "ask":
            print(json.dumps(answers.drop("question_id").first().asDict()))
        else:
            print(json.dumps({"answered": answers.filter(F.size("errors") == 0).count()}))
        return 0
    if a.command == "serve":
        from .streaming import events as stream

        at = tables.Versions(spark, f"{a.output_dir}/graph")

        def cycle(number: int) -> None:
            nodes, edges = tables.read_graph(spark, at.latest() or a.graph)
            after, state = cy.run_cycle(cy.prepared(nodes, edges), datetime.now(UTC).isoformat(), folder=a.output_dir)
            tables.write_graph(after.nodes, after.edges, at.next())
            print(json.dumps({"cycle": number, "status": state["status"]}), flush=True)

        ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        running = stream.service(ticks, cycle, f"{a.output_dir}/service-checkpoint", a.every)
        while running.isActive and (a.cycles is None or len(tables.Versions(spark, f"{a.output_dir}/graph").all()) < a.cycles):
            running.awaitTermination(1)
        running.stop()
        return 0
    if a.command == "watchdog":
        print(json.dumps([r.asDict() for r in cy.watchdog(g, [])[0].collect()]))
        return 0
    if a.command == "cycle":
        g, state = cy.run_cycle(g, a.as_of, a.min_confidence, a.output_dir, a.question)
    else:
        options = {"evolution": {"as_of": a.as_of}, "synthesis": {"least": a.min_confidence}, "impact": {"node_ids": a.node_id}, "summarization": {"as_of": a.as_of}}.get(a.command, {})
        g, report = cy.single(a.command, g, **options)
        state = report.to_dict()
    if a.output_dir:
        tables.write_graph(g.nodes, g.edges, a.output_dir)
    print(json.dumps(state, default=str))
    return int(bool(state["errors"]))


if __name__ == "__main__":
    sys.exit(main())
