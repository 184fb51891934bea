"""The first trails of each seed, against all trails."""

import numpy as np
from pyspark.sql import functions as F
from test_cells import moved

from weftline.operators import graph
from weftline.plans import answer


def test_first_trails_are_those_of_all(spark):
    rng = np.random.default_rng(11)
    some = {(f"n{a}", f"n{b}", "RST"[t]) for a, b, t in zip(rng.zipf(1.7, 160) % 24, rng.integers(0, 24, 160), rng.integers(0, 3, 160), strict=True)}
    edges = spark.createDataFrame(sorted(some), "src string, dst string, type string")
    seeds = spark.createDataFrame([("n0",), ("n1",), ("n5",), ("n17",), ("lone",)], "id string")
    wanted = spark.createDataFrame([(f"n{i}",) for i in range(0, 24, 2)], "node string")
    row = lambda r: (r["seed"], r["hops"], r["node"], ",".join(r["via"]))
    met = graph.trails(edges, seeds, 3).join(F.broadcast(wanted), "node", "left_semi").groupBy("seed", "hops", "node", "via").count().collect()
    every = sorted((row(r), r["count"]) for r in met)
    for limit, slack in ((9, 1), (60, 64)):
        want = []
        for seed, hops in {x[:2] for x, _ in every}:
            want += [x for x, n in every if x[:2] == (seed, hops) for _ in range(min(n, limit))][:limit]
        assert sorted(map(row, graph.first_trails(edges, seeds, wanted, limit, 3, slack).collect())) == sorted(want)


def test_expansion_does_not_follow_hubs_from_each_seed(spark):
    d = spark.range(4000).select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("src"))
    edges = d.select("src", F.lit("s").alias("dst"), F.lit("X").alias("type")).union(d.select("src", F.lit("t"), F.lit("Y")))
    nodes = spark.createDataFrame([("s", "Concept", "s", None), ("t", "Concept", "t", None)], "id string, label string, name string, text string")
    before = moved(spark)
    steps = answer.expand(nodes, edges, d.limit(200).select(F.col("src").alias("question_id"), F.col("src").alias("chunk_id")))[1]
    assert steps.count() == 200 * 300
    assert moved(spark) - before < 600_000
