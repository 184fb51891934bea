"""Answering, extraction, evaluation plug-ins, and the command line."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline import __main__ as cli
from weftline.functions import text as tx
from weftline.operators import evaluate, extract, graph, harvest, pages, resolve, vectors
from weftline.plans import answer, cycle, ingest
from weftline.sources import tables

WORDS = " ".join(f"word{i}" for i in range(60))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A small graph from pages with a glossary."""
    folder = str(tmp_path_factory.mktemp("g"))
    rows = [
        ("AUTOSAR_SWS_ComM.pdf", 1, f"# Intro\n[SWS_ComM_00001] The manager shall start the bus as [SRS_Can_00002] says {WORDS}."),
        ("AUTOSAR_SRS_Can.pdf", 1, f"# Can\n[SRS_Can_00002] The driver shall send frames over the network cluster. {WORDS} again."),
        ("AUTOSAR_SRS_Can.pdf", 2, f"# Glossary\nNetwork cluster: a set of nodes that share one bus.\nDriver: software that moves frames for others.\n{WORDS}"),
    ]
    raw = spark.createDataFrame(rows, "filename string, page_1idx int, markdown string")
    entities = spark.createDataFrame([("bus", "System"), ("frames", "Wonder")], "name string, label string")
    nodes, edges = ingest.run(raw, folder, "2024-01-01", entities=entities)
    return folder, nodes, edges


def test_ingestion_has_entities_vectors_and_summaries(stored):
    _, nodes, edges = stored
    by = {r["name"]: r for r in nodes.collect()}
    assert by["Network cluster"]["label"] == "Concept" and by["Network cluster"]["text"].startswith("a set of nodes") and by["bus"]["label"] == "System" and by["frames"]["label"] == "Concept"
    chunks = [r for r in nodes.filter("label = 'Chunk'").collect()]
    assert all(len(r["embedding"]) == 64 and r["summary"] for r in chunks)
    kinds = {(r["src"], r["dst"], r["type"]) for r in edges.collect()}
    assert ("req_SWS_ComM_00001", "req_SRS_Can_00002", "REFERENCES") in kinds and ("entity_bus", "entity_driver", "REFERENCES") not in {k for k in kinds if k[0] == "none"}
    assert any(d == "entity_bus" and t == "MENTIONS" for _, d, t in kinds) and any(t == "SIMILAR_TO" for _, _, t in kinds)


def test_ask_answers_from_the_graph(spark, stored):
    _, nodes, edges = stored
    questions = spark.createDataFrame([(1, "What shall the driver send over the network cluster?"), (2, "???")], "question_id long, question string")
    got = {r["question_id"]: r for r in answer.ask(questions, nodes, edges, "2024-02-01", least=0.5).collect()}
    assert "driver" in got[1]["answer"] and 0 < got[1]["confidence"] <= 1 and got[1]["evidence"] == [got[1]["answer"]] and not got[1]["errors"]
    assert got[1]["reasoning"].startswith("Multi-agent debate (3/3 legs)") and got[2]["confidence"] == 1.0
    nothing = answer.ask(questions, nodes.filter("false"), edges, "2024-02-01").collect()
    assert all(r["errors"] and r["answer"] is None for r in nothing)


def test_debate_counts_the_legs_that_answer(spark):
    asked = spark.createDataFrame([(1, "q", "c", 0.5)], "question_id long, question string, context string, score double")
    say = lambda a, c, e: lambda *_: F.lit(json.dumps({"answer": a, "reasoning": f"r{a}", "evidence": e, "confidence": c}))
    r = answer.debate(asked, {"prosecutor": lambda *_: F.lit("no json"), "defender": say("D", 0.8, ["x", "y"]), "skeptic": say("S", 0.2, ["y", "z"])}).first()
    assert r["answer"] == "D" and r["evidence"] == ["x", "y", "z"] and r["confidence"] == round((0.8 * 0.35 + 0.2 * 0.20) / 0.55, 3)
    assert "(2/3 legs)" in r["reasoning"] and "[defender | conf=0.80] rD" in r["reasoning"]


def test_memory_adds_up(spark):
    empty = spark.createDataFrame([], answer.MEMORY)
    new = spark.createDataFrame([("does it depend on X?", 0.4, "1"), ("does it depend on X?", 0.7, "2"), ("hello", None, "1")], "question string, confidence double, run_at string")
    once = answer.remember(empty, new)
    by = {r["question"]: r for r in answer.remember(once, new.filter("question <> 'hello'")).collect()}
    assert by["does it depend on X?"]["ask_count"] == 4 and by["does it depend on X?"]["last_confidence"] == 0.7 and by["does it depend on X?"]["category"] == "dependency_analysis"
    assert by["hello"]["ask_count"] == 1 and by["hello"]["category"] == "general" and by["hello"]["complexity"] == "simple"


def test_relations_and_references_are_validated(spark):
    texts = spark.createDataFrame([(1, "A meets B"), (2, "A alone")], "k long, t string")
    rel = spark.createDataFrame([(1, "a", "B"), (2, "A", "b"), (3, "x", "y")], "k long, src_name string, dst_name string")
    good, bad = extract.validate_relations(rel, texts, "k", "t")
    assert {r["k"] for r in good.collect()} == {1, 3} and {r["k"] for r in bad.collect()} == {2}
    again = extract.revalidated(rel, F.col("k") == 2, lambda df: df.withColumn("dst_name", F.lit("c")), ["k"])
    assert {(r["k"], r["dst_name"]) for r in again.collect()} == {(1, "B"), (2, "c"), (3, "y")}
    pages_ = spark.createDataFrame([("f", 1, "x1 and x2\nx3")], "f string, p int, t string")
    pairs = spark.createDataFrame([("f", 1, "x1", "x2"), ("f", 1, "x1", "x3"), ("g", 1, "a", "b")], "f string, p int, from_id string, to_id string")
    assert {(r["from_id"], r["to_id"]) for r in extract.validate_references(pairs, pages_, "f", "p", "t").collect()} == {("x1", "x2"), ("a", "b")}


def test_identifiers_of_real_form(spark):
    text = "[SWS_ComM_00001] shall go. [constr_1234] holds, [BSW_00042] too; [SRS_Can_Foo_00002] no, again [SWS_ComM_00001]."
    df = spark.createDataFrame([("AUTOSAR_SWS_ComM.pdf", 1, text), ("AUTOSAR_SWS_ComM.pdf", 2, "[SWS_ComM_00001]")], "f string, p int, t string")
    found = harvest.mentions(df, "f", "p", "t")
    assert [r["id"] for r in found.filter("p = 1").orderBy("pos").collect()] == ["SWS_ComM_00001", "constr_1234", "BSW_00042"]
    known = harvest.inventory(found, spark.createDataFrame([("AUTOSAR_SWS_ComM.pdf", "ComM")], "f string, module string"), "f", "p")
    one = known.filter("id = 'SWS_ComM_00001'").first()
    assert one["id_type"] == "SWS" and one["module"] == "ComM" and [(x["file"], x["page"]) for x in one["places"]] == [("AUTOSAR_SWS_ComM.pdf", 1), ("AUTOSAR_SWS_ComM.pdf", 2)]


def test_excerpts_have_a_budget(spark):
    from weftline.operators import chunks

    long = "x" * 10_000
    df = spark.createDataFrame([(1, long, [0, 3000, 6000, 9000]), (2, long, []), (3, "short", [])], "k long, t string, at array<int>")
    got = {r["k"]: r["excerpt"] for r in chunks.excerpts(df, ["k"], "t", "at", 10).collect()}
    assert len(got[1]) <= 3500 + 3 * 5 and "\n...\n" in got[1] and got[2] == long[:2500] and got[3] == "short"


def test_boilerplate_needs_enough_pages(spark):
    rows = [(f"f{i}", p, "Copyright notice of the working group, all rights reserved" if p == 1 else f"page {i} {p} " + " ".join(f"w{i * 7 + p * 13 + k}" for k in range(30))) for i in range(3) for p in (1, 2, 3, 4)]
    df = spark.createDataFrame(rows, "f string, p int, t string")
    gone = {(r["f"], r["p"]) for r in pages.boilerplate(df, "f", "p", "t", tx.embedding).collect()}
    assert gone == {("f1", 1), ("f2", 1)}
    assert pages.boilerplate(df.limit(3), "f", "p", "t", tx.embedding).isEmpty()


def test_index_meets_near_pairs(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((400, 32))
    near = base[:60] + 0.1 * rng.standard_normal((60, 32))
    rows = [(i, x.tolist()) for i, x in enumerate(np.concatenate([base, near]))] + [(900 + i, base[0].tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    whole = {(r["a"], r["b"]) for r in vectors.similar_pairs(df, "k", "v", 0.9).collect()}
    monkeypatch.setattr(vectors, "_BLOCK", 16)
    assert vectors.layout(500, 0.9)[1] > 0
    got = {(r["a"], r["b"]) for r in vectors.similar_pairs(df, "k", "v", 0.9).collect()}
    assert len(whole) > 60 and got <= whole and len(got) >= 0.99 * len(whole)
    monkeypatch.setattr(vectors, "_SCANNED", 10)
    exact = {(r["a"], r["b"]) for r in vectors.search(df, df, "k", "v", 2, 0.9).collect()}
    assert {(r["a"], r["b"]) for r in vectors.nearest(df, "k", "v", 2, 0.9).collect()} == exact


def test_guard_keeps_antonyms_apart(spark):
    df = spark.createDataFrame([("a", "Encryption job", [1.0, 0.0], "F"), ("b", "Decryption job", [1.0, 0.01], "F"), ("c", "The encryption job", [1.0, 0.02], "F")], "id string, name string, embedding array<double>, label string")
    got = {r["id"]: r["cluster"] for r in vectors.similar_components(df, "id", "embedding", 0.92, ["label"], resolve.guarded(df, "id", "name")).collect()}
    assert got == {"a": "a", "b": "b", "c": "a"}


def test_merge_can_remove(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, p string, q string")
    new = spark.createDataFrame([(1, None), (3, "c")], "id long, p string")
    keep = {r["id"]: (r["p"], r["q"]) for r in graph.upsert(old, new, ["id"]).collect()}
    gone = {r["id"]: (r["p"], r["q"]) for r in graph.upsert(old, new, ["id"], nulls_remove=True).collect()}
    assert keep == {1: ("a", "x"), 2: ("b", "y"), 3: ("c", None)} and gone == {1: (None, "x"), 2: ("b", "y"), 3: ("c", None)}
    assert graph.merge_counts(old, new, ["id"]).first().asDict() == {"submitted": 2, "created": 1, "changed": 1}


def test_judges_and_token_scores(spark):
    rows = [("the cat sat", "because", "the cat sat", ["c1", "c2"], "q"), ("dog", "because", "a wholly other text", ["c"], "q"), ("dog", None, "dog", None, "q")]
    df = spark.createDataFrame(rows, "answer string, reasoning string, reference string, reference_contexts array<string>, question string")
    got = evaluate.judged(df, lambda system, user: F.when(F.contains(user, F.lit("wholly")), "none").otherwise('{"correctness": 4, "completeness": 9, "faithfulness": 3, "context_recall": 0, "relevance": 1, "logical_validity": 5}')).collect()
    assert (got[0]["correctness"], got[0]["completeness"], got[0]["faithfulness"], got[0]["context_recall"], got[0]["logical_validity"]) == (4.0, None, 3.0, 0.0, 5.0) and got[1]["correctness"] is None
    near, far, same = (r["s"] for r in df.select(evaluate.token_score(evaluate.trigram_vectors)("answer", "reference").alias("s")).collect())
    assert near == same == 1.0 and far < 0.5


def test_stems(spark):
    from weftline.functions.stem import stem

    said = "caresses caress ponies poni cats cat feed feed agreed agre plastered plaster motoring motor sing sing conflated conflat sized size hopping hop falling fall hissing hiss failing fail filing file happy happi sky sky relational relat conditional condit rational ration digitizer digit operator oper feudalism feudal decisiveness decis hopefulness hope triplicate triplic formative form formalize formal electrical electr hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin adjustable adjust irritant irrit replacement replac adoption adopt effective effect probate probat rate rate cease ceas controlling control roll roll".split(" ")
    assert {w: stem(w) for w in said[::2]} == dict(zip(said[::2], said[1::2], strict=True))
    df = spark.createDataFrame([(1, "the drivers were sending frames", "a driver sends frame")], "k long, p string, r string")
    assert evaluate.rouge_n(df, "k", "p", "r", 1).first()["rouge"] == 0.0 and evaluate.rouge_n(df, "k", "p", "r", 1, True).first()["rouge"] == round(6 / 9, 4)
    assert df.select(evaluate.rouge_l_stems("p", "r").alias("x")).first()["x"] == round(6 / 9, 4)


def test_cycle_state_is_kept_and_errors_are_captured(spark, stored, tmp_path, monkeypatch):
    folder, *_ = stored
    g = cycle.prepared(*tables.read_graph(spark, f"{folder}/graph"))
    monkeypatch.setitem(cycle.AGENTS, "conflict", lambda g: 1 / 0)
    g, state = cycle.run_cycle(g, "2024-06-01", folder=str(tmp_path), question="What shall the driver send?")
    assert state["status"] == "failed" and state["errors"] and state["answer"]["answer"] and state["runs"] == 6
    rows = spark.read.parquet(f"{tmp_path}/cycle_state").orderBy("step").collect()
    assert len(rows) == 8 and {r["status"] for r in rows} == {"running", "failed"}
    same, report = cycle.single("conflict", g)
    assert same is g and report.errors


def test_command_line(spark, stored, tmp_path, capsys):
    folder, *_ = stored
    out = lambda: json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert cli.main(["ask", "--graph", f"{folder}/graph", "--as-of", "2024-02-01", "--question", "What shall the driver send?", "--least", "0.5"]) == 0
    assert out()["answer"]
    (tmp_path / "q.json").write_text(json.dumps([{"id": "1", "user_input": "What shall the driver send?", "reference": "The driver shall send frames."}, {"id": "2", "user_input": "What shall the driver send?", "reference": "Frames"}]))
    assert cli.main(["batch", "--graph", f"{folder}/graph", "--as-of", "2024-02-01", "--input", str(tmp_path / "q.json"), "--output", str(tmp_path / "said"), "--least", "0.5"]) == 0
    assert out()["answered"] == 2
    assert cli.main(["eval", "--gt", str(tmp_path / "q.json"), "--input", str(tmp_path / "said"), "--output", str(tmp_path / "scores")]) == 0
    assert out()["records"] == 2
    for n in (1, 2):
        assert cli.main(["query-memory", "--output-dir", str(tmp_path), "--question", "what is X", "--confidence", "0.5"]) == 0
        assert out() == {"patterns": 1, "hot_spots": [], "low_confidence": ["what is X"]}
    assert spark.read.parquet(tables.Versions(spark, f"{tmp_path}/query_memory").latest()).first()["ask_count"] == 2
    assert cli.main(["audit", "--graph", f"{folder}/graph"]) == 0 and "chunk_without_module" in capsys.readouterr().out
    (tmp_path / "texts").mkdir()
    (tmp_path / "texts/a.txt").write_text(f"# One\n{WORDS}\f# Two\nmore {WORDS}")
    assert cli.main(["ingest", "--files", str(tmp_path / "texts"), "--output-dir", str(tmp_path / "made"), "--as-of", "2024-01-01"]) == 0
    assert out()["nodes"] >= 3
    assert cli.main(["serve", "--graph", f"{folder}/graph", "--output-dir", str(tmp_path / "served"), "--every", "1 second", "--cycles", "1"]) == 0
    assert tables.Versions(spark, f"{tmp_path}/served/graph").latest()
