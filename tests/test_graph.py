"""Graph, resolution and upkeep semantics on small frames."""

from pyspark.sql import functions as F

from weftline.operators import evaluate, graph, maintain, resolve, vectors
from weftline.operators.components import connected_components


def edges(spark, some, schema="src string, dst string, type string"):
    return spark.createDataFrame(some, schema)


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_patterns(spark):
    dep = edges(spark, [("A", "B", "D"), ("B", "A", "D"), ("A", "C", "D")])
    assert pairs(graph.two_way(dep), "a", "b") == [("A", "B")]
    alloc = edges(spark, [("M1", "R", "H"), ("M2", "R", "H"), ("M3", "R", "H")])
    assert len(pairs(graph.shared_targets(alloc), "dst", "a", "b")) == 3
    cross = [("P", "x", "D"), ("Q", "x", "D"), ("P", "y", "D"), ("Q", "y", "D")]
    assert pairs(graph.bridges(edges(spark, cross)), "a", "b", "shared") == [("P", "Q", 2), ("x", "y", 2)]
    assert pairs(graph.bridges(edges(spark, [*cross, ("P", "Q", "D")])), "a", "b") == [("x", "y")]
    again = graph.bridges(edges(spark, [*cross, ("P", "Q", "HYPOTHESIZES")]), 2, edges(spark, [("P", "Q", "HYPOTHESIZES")]))
    assert ("P", "Q") in pairs(again, "a", "b")


def test_impact(spark):
    e = edges(spark, [("S", "A", "DEPENDS_ON"), ("S", "B", "MENTIONS"), ("S", "C", "HAS_REQUIREMENT"), ("C", "D", "MENTIONS"), ("D", "E", "ODD"), ("E", "F", "ODD"), ("F", "G", "ODD"), ("S", "Z", "IMPACT_OF")])
    got = {r["node"]: (r["hops"], r["score"], r["severity"]) for r in graph.impact(e, spark.createDataFrame([("S",)], "id string")).collect()}
    assert got["A"] == (1, 0.9, "critical") and got["B"] == (1, 0.2, "minor") and got["D"] == (2, 0.4, "major")
    assert "G" not in got and "Z" not in got


def test_trails_use_no_edge_twice(spark):
    e = edges(spark, [("a", "b", "X"), ("b", "c", "Y")])
    got = pairs(graph.trails(e, spark.createDataFrame([("a",)], "id string"), 3), "node", "hops")
    assert got == [("b", 1), ("c", 2)]


def test_upsert_and_audit(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, n int, s string")
    new = spark.createDataFrame([("b", 5, None), ("c", 7, "z")], "id string, n int, s string")
    merged = graph.upsert(old, new, ["id"])
    assert pairs(merged, "id", "n", "s") == [("a", 1, "x"), ("b", 5, "y"), ("c", 7, "z")]
    assert pairs(graph.upsert(merged, new, ["id"]), "id", "n", "s") == pairs(merged, "id", "n", "s")
    found = graph.audit(old, edges(spark, [("a", "q", "T")]), {"small": F.col("n") < 2})
    assert dict(pairs(found, "check", "n")) == {"small": 1, "isolated": 1}
    assert pairs(graph.dangling(edges(spark, [("a", "q", "T"), ("a", "b", "T")]), old), "src", "dst") == [("a", "q")]


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3), (200, 50)], "u long, v long")
    got = dict(pairs(connected_components(e), "node", "component"))
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100 and got[200] == 50 and None not in got
    assert connected_components(e.filter("u = 7 AND v = 7")).count() == 0


def test_resolution(spark):
    nodes = spark.createDataFrame([(1, "communication manager"), (2, "ComM"), (3, "other")], "id int, name string")
    names = spark.createDataFrame([("Communication Manager", "ComM")], "alias string, canonical string")
    assert pairs(resolve.canonical(nodes, names, "id", "name"), "id", "canonical") == [(1, "ComM"), (2, "ComM"), (3, "other")]
    a = spark.createDataFrame([("symmetric encryption", "symmetric decryption"), ("read", "read"), ("file reader", "write"), ("cat", "dog")], "a string, b string")
    assert [r["x"] for r in a.select(resolve.are_antonyms(F.col("a"), F.col("b")).alias("x")).collect()] == [True, False, True, False]
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "old string, new string")
    assert pairs(resolve.follow(chain), "old", "new") == [("a", "d"), ("b", "d"), ("c", "d")]
    moved = resolve.remap_edges(edges(spark, [("a", "d", "T"), ("a", "z", "T"), ("b", "z", "T")]), resolve.follow(chain))
    assert pairs(moved, "src", "dst") == [("d", "z")]
    tagged = spark.createDataFrame([(1, "Concept_Job"), (2, "job"), (3, "Task")], "id int, name string")
    assert pairs(resolve.prefix_pairs(tagged, "id", "name"), "prefixed", "plain") == [(1, 2)]


def test_clusters_stay_within_labels(spark):
    v = spark.createDataFrame([(1, "x", [1.0, 0.0]), (2, "x", [1.0, 0.01]), (3, "y", [1.0, 0.0])], "id int, label string, v array<double>")
    assert pairs(vectors.similar_components(v, "id", "v", 0.9, ["label"]), "id", "cluster") == [(1, 1), (2, 1), (3, 3)]
    banded = vectors.bands(spark.createDataFrame([(0.92,), (0.75,), (0.74,)], "cosine double"))
    assert [r["band"] for r in banded.collect()] == ["certain", "uncertain", "apart"]


def test_verdicts(spark):
    rows = [(0, 0), (1, 1), (0, 2), (1, 2), (2, 2)]
    df = spark.createDataFrame(rows, "stale int, hits int").withColumn("c", maintain.counter_score(F.col("stale"), F.col("hits")))
    got = [(r["c"], r["v"]["verdict"]) for r in df.withColumn("v", maintain.verdict(F.col("c"), F.lit(0.0))).collect()]
    assert got == [(0.0, "accepted"), (0.55, "accepted"), (0.6, "rejected"), (0.85, "rejected"), (1.0, "rejected")]
    nodes = spark.createDataFrame([("a", True), ("b", None)], "id string, stale boolean")
    e = maintain.hypothesis_evidence(edges(spark, [("a", "b", "H")]), nodes, edges(spark, [("a", "b", "C")])).first()
    assert (e["stale_ends"], e["contradictions"]) == (1, 2)


def test_evolution_flags_and_nulls(spark):
    rows = [("2024-01-01", 0.5, "llm_based", "0"), ("2024-03-01", 0.5, "rule_based", "1"), ("2024-03-01", 0.5, None, "1"), ("2024-03-01", 0.9, "llm_based", None), ("2024-03-01", 0.70, "llm_based", "1")]
    df = spark.createDataFrame(rows, "at string, c double, m string, v string")
    why = maintain.evolution_reasons(F.to_timestamp("at"), F.col("c"), F.col("m"), F.col("v"), F.to_timestamp(F.lit("2024-03-02")), current=F.lit("1"))
    assert [r["w"] for r in df.select(why.alias("w")).collect()] == ["age_exceeded,low_confidence,schema_drift", "", "", "", ""]


def test_vote_and_health(spark):
    legs = spark.createDataFrame([("q", "a", 0.45, 0.9), ("q", "b", 0.35, 0.6), ("q", "c", 0.20, None)], "q string, leg string, weight double, confidence double")
    r = maintain.vote(legs, ["q"]).first()
    assert (r["confidence"], r["primary"]) == (0.769, "a")
    df = spark.createDataFrame([(0.4, 0.0), (0.0, 0.2), (0.5, 0.5), (0.0, 0.0)], "r double, e double")
    got = [(x["h"], x["t"]) for x in df.select(maintain.health(F.col("r"), F.col("e")).alias("h"), maintain.tuned_threshold(F.lit(0.70), F.col("r")).alias("t")).collect()]
    assert got == [("degraded", 0.75), ("degraded", 0.70), ("critical", 0.75), ("ok", 0.70)]


def test_evaluation(spark):
    gold = spark.createDataFrame([("q ", "a", 1), ("q", "b", 2)], "user_input string, reference string, position int")
    said = spark.createDataFrame([(" q", "x"), ("other", "y")], "question string, answer string")
    matched, unmatched = evaluate.match(said, gold, "question", "user_input", "position")
    assert [r["reference"] for r in matched.collect()] == ["b"] and [r["question"] for r in unmatched.collect()] == ["other"]
    df = spark.createDataFrame([(1, "the cat sat on the mat", "the cat is on the mat"), (2, "", "x")], "k int, a string, b string")
    assert dict(pairs(evaluate.rouge_n(df, "k", "a", "b", 1), "k", "rouge")) == {1: 0.8333, 2: 0.0}
    assert [r["r"] for r in df.select(evaluate.rouge_l("a", "b").alias("r")).collect()] == [0.8333, 0.0]
    assert evaluate.summary(spark.createDataFrame([(None,)], "x double"), ["x"]).first()["avg_x"] is None


def test_lcs_against_table():
    import random

    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 15))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert evaluate.lcs(a, b) == t[-1][-1]


def test_pairs_at_hubs_are_dealt_in_blocks(spark):
    """Each pair of a hub's ends once, however small the blocks."""
    links = spark.createDataFrame([("hub", i) for i in range(30)] + [("one", 1), ("two", 1), ("two", 5)], "m string, a long")
    want = sorted([("hub", i, j) for i in range(30) for j in range(i + 1, 30)] + [("two", 1, 5)])
    for block in (3, 7, 1000):
        assert sorted(tuple(r) for r in graph.pairs_at(links, block).collect()) == want


def test_rouge_of_pairs_of_stems(spark):
    df = spark.createDataFrame([(1, "Frames are transmitted slowly", "the frame are transmitting"), (2, "one", "one two"), (3, None, "a b")], "k int, a string, b string")
    assert dict(pairs(evaluate.rouge_n(df, "k", "a", "b", 2, True), "k", "rouge")) == {1: 0.6667, 2: 0.0, 3: 0.0}
