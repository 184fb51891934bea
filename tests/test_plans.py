"""Ingestion, the cycle, streams and the provider chain end to end on small inputs."""

import pytest
from pyspark.sql import functions as F

from weftline.plans import cycle, ingest, models
from weftline.sources.tables import Stages, documents_as_pages, read_graph
from weftline.streaming import events as stream

LONG = " ".join(f"word{i}" for i in range(60))


def raw_pages(spark):
    rows = [
        ("AUTOSAR_SWS_ComM.pdf", 1, f"# Intro\n[SWS_ComM_00001] The manager shall start {LONG}. [SRS_Can_00002] It follows the driver {LONG}."),
        ("AUTOSAR_SWS_ComM.pdf", 2, f"## More\n[SWS_ComM_00003] must stop {LONG}.\n\n| Parameter Name | Type |\n|---|---|\n| Foo | INTEGER |\n\n{LONG}"),
        ("AUTOSAR_SRS_Can.pdf", 1, f"# Can\n[SRS_Can_00002] shall send, as [SWS_ComM_00001] says {LONG} again."),
        ("AUTOSAR_SRS_Can.pdf", 2, "blank"),
    ]
    return spark.createDataFrame(rows, "filename string, page_1idx int, markdown string")


def test_ingest_and_cycle(spark, tmp_path):
    nodes, edges = ingest.run(raw_pages(spark), str(tmp_path / "out"), "2024-01-01")
    by = {r["id"]: r for r in nodes.collect()}
    assert {"req_SWS_ComM_00001", "req_SRS_Can_00002", "module_comm", "module_can", "ECUC_ComM_Foo", "doc_AUTOSAR_SRS_Can.pdf"} <= set(by)
    assert by["req_SWS_ComM_00001"]["text"].startswith("says word0")
    kinds = {(r["src"], r["dst"], r["type"]) for r in edges.collect()}
    assert ("req_SWS_ComM_00001", "req_SRS_Can_00002", "REFERENCES") in kinds and ("module_comm", "ECUC_ComM_Foo", "HAS_PARAMETER") in kinds
    assert {r[2] for r in kinds} >= {"MENTIONS", "SOURCED_FROM", "HAS_CHUNK", "SPECIFIES", "HAS_REQUIREMENT"}
    ids = set(by)
    assert all(s in ids and d in ids for s, d, _ in kinds)

    g = cycle.prepared(*read_graph(spark, str(tmp_path / "out/graph")))
    g, state = cycle.run_cycle(g, "2024-06-01")
    assert state["status"] == "complete", state["errors"]
    counts = {r["agent"]: r["counts"] for r in state["reports"]}
    assert counts["evolution_agent"]["stale"] == 3 and counts["summarization_agent"]["updated"] >= 1
    assert counts["impact_agent"]["affected"] > 0 and len(state["metrics"]) == 3
    assert g.edges.groupBy("src", "dst", "type").count().filter("count > 1").isEmpty()


def test_stages_resume_and_invalidate(spark, tmp_path):
    s = Stages(spark, str(tmp_path / "st"))
    made = []
    make = lambda: made.append(1) or spark.range(3)
    assert s.run(1, "a", make).count() == 3 and s.run(1, "a", make).count() == 3 and len(made) == 1
    s.save(2, "b", spark.range(1))
    assert s.invalidate(2) == ["stage02_b"] and s.done(1, "a") and not s.done(2, "b")


def test_bad_file_is_left_out(spark):
    files = spark.createDataFrame([("x/a.pdf", bytearray(b"p1|p2")), ("x/b.pdf", bytearray(b"\xff"))], "path string, content binary")
    got = documents_as_pages(files, lambda b: b.decode().split("|")).collect()
    assert [(r["filename"], r["page"], r["markdown"]) for r in got] == [("a.pdf", 0, "p1"), ("a.pdf", 1, "p2")]


def test_streams_equal_batches(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source.repartition(3).write.parquet(str(tmp_path / "in"))
    live = stream.timed(spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), late="60 days")
    last = spark.createDataFrame([(10**9, "2030-01-01 00:00:00", -1, "end", 0.0, "{}")], "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    last.write.mode("append").parquet(str(tmp_path / "in"))
    for name, make in (("tumbling", stream.tumbling), ("sessions", stream.sessions)):
        stream.drain(make(live), str(tmp_path / name), str(tmp_path / f"{name}-cp"))
        got = spark.read.parquet(str(tmp_path / name))
        want = make(source.withColumn("ts", F.col("ts").cast("timestamp")))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    stream.drain(stream.first_seen(live, ["user_id", "event_type"]), str(tmp_path / "once"), str(tmp_path / "once-cp"))
    assert spark.read.parquet(str(tmp_path / "once")).filter("user_id >= 0").count() == source.select("user_id", "event_type").distinct().count()


def test_rejected_hypotheses_are_tested_again(spark):
    nodes = spark.createDataFrame([(x, None) for x in "abcd"], "id string, stale_reasons string")
    edges = spark.createDataFrame([("a", "b", "HYPOTHESIZES", 0.1, False), ("c", "d", "HYPOTHESIZES", 0.8, None), ("a", "c", "HYPOTHESIZES", 0.9, True)], "src string, dst string, type string, confidence double, verified boolean")
    g, report = cycle.verification(cycle.Graph(nodes, edges))
    assert sum(report.counts.values()) == 2 and g.edges.filter("src = 'a' AND dst = 'b' AND verified").count() == 1
    assert sum(cycle.verification(cycle.Graph(nodes, edges), 1)[1].counts.values()) == 1


def test_provider_chain():
    now = [0.0]

    def fail(system, user):
        raise TimeoutError

    a, b = models.Provider("a", fail), models.Provider("b", lambda s, u: u.upper(), per_minute=100)
    chain = models.Chain([models.Provider("none", fail, ready=False), a, b], clock=lambda: now[0])
    assert chain("", "x") == "X" and a._resting_until == 60.0 and chain("", "y") == "Y"
    slept = []
    p = models.Provider("p", lambda s, u: u, per_minute=2)
    for _ in range(3):
        p.answer("", "x", clock=lambda: 0.0, sleep=slept.append)
    assert slept == [60.0]
    assert models.route("verification") == "heavy_reasoning" and models.route("fast") == "fast" and models.route("?") == "mid_reasoning"


def test_ask(spark):
    got = spark.createDataFrame([("a",), (None,)], "t string").select(models.ask(models.stub(lambda s, u: s + u), "say ", F.col("t")).alias("x")).collect()
    assert [r["x"] for r in got] == ["say a", None]


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("command", [["routes"]])
def test_command_line(command, capsys):
    from weftline.__main__ import main

    assert main(command) == 0 and "heavy_reasoning" in capsys.readouterr().out


def test_a_host_rests_after_a_failure():
    now = [100.0]
    asked = []

    def say(name, fails=False):
        def call(system, user):
            asked.append(name)
            if fails:
                raise OSError
            return name

        return call

    chain = models.Chain([models.Provider("a", say("a", True), 99, host="h"), models.Provider("b", say("b"), 99, host="h"), models.Provider("c", say("c"), 99, host="i")], lambda: now[0])
    assert chain("s", "u") == "c" and asked == ["a", "c"]
    now[0] += 6
    assert chain("s", "u") == "b" and asked == ["a", "c", "b"]


def test_streamed_memory_and_merges(spark, tmp_path):
    from weftline.sources.tables import Versions

    rows = [("a", "2024-01-01", 0.5), ("b", "2024-01-02", 0.7), ("a", "2024-01-03", 0.9)]
    log = spark.createDataFrame(rows, "question string, ts string, confidence double").withColumn("ts", F.col("ts").cast("timestamp"))
    log.repartition(3).write.parquet(str(tmp_path / "log"))
    live = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    stream.memory(live).writeStream.outputMode("complete").format("memory").queryName("asked").trigger(availableNow=True).start().awaitTermination()
    got, want = spark.table("asked"), stream.memory(log)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.filter("question = 'a' AND asks = 2 AND last_confidence = 0.9").count() == 1
    kept = Versions(spark, str(tmp_path / "kept"))
    changes = live.groupBy("question").agg(F.max("confidence").alias("confidence")).select("question", "confidence")
    query = lambda df, n: kept.write(df)
    running = changes.writeStream.outputMode("update").foreachBatch(lambda batch, n: query(stream.upsert(kept.read("question string, confidence double"), batch, ["question"]), n)).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    running.awaitTermination()
    assert {tuple(r) for r in kept.read("question string, confidence double").collect()} == {("a", 0.9), ("b", 0.7)}
    again = Versions(spark, str(tmp_path / "again"))
    stream.upserting(live.select("question", "confidence").filter("question = 'b'"), ["question"], lambda: again.read("question string, confidence double"), lambda df, n: again.write(df), str(tmp_path / "cp2"))
    assert [tuple(r) for r in again.read("question string, confidence double").collect()] == [("b", 0.7)]
