"""What one task holds, and what is read and moved, in queries over large tables."""

from pyspark.sql import functions as F
from test_cells import moved

from weftline import session
from weftline.operators import extract, graph
from weftline.plans.all_queries import QUERIES


def most_rows_read(spark, run):
    """Rows that the largest task of a stage read from shuffles, in the stages of ``run``."""
    sc = spark.sparkContext
    store, none = sc._jsc.sc().statusStore(), sc._gateway.new_array(sc._gateway.jvm.double, 0)
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    before = store.stageList(None, False, False, none, None).size()
    run()
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages, most = store.stageList(None, False, False, none, None), 0
    for i in range(stages.size() - before):
        stage = stages.apply(i)
        tasks = store.taskList(stage.stageId(), stage.attemptId(), 1 << 20)
        for j in range(tasks.size()):
            metrics = tasks.apply(j).taskMetrics()
            if metrics.isDefined():
                most = max(most, metrics.get().shuffleReadMetrics().recordsRead())
    return most


def tables(spark, tmp_path, orders=2000):
    line = spark.range(orders * 4).select((F.col("id") % orders).alias("l_orderkey"), (F.col("id") % 7).alias("l_suppkey"), (F.col("id") % 11).alias("l_partkey"), F.lit("N").alias("l_returnflag"))
    line.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(orders + 5).select(F.col("id").alias("o_orderkey"), (F.col("id") % 3).alias("o_custkey")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(7).select(F.col("id").alias("s_suppkey"), (F.col("id") % 5).alias("s_nationkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(3).select(F.col("id").alias("c_custkey"), F.col("id").alias("c_nationkey")).write.parquet(f"{tmp_path}/customer.parquet")


def test_sourced_from_is_dealt_out(spark, tmp_path):
    tables(spark, tmp_path)
    got = []
    assert most_rows_read(spark, lambda: got.extend(QUERIES["sourced_from"](spark, str(tmp_path)).collect())) < 8000
    want = {(i % 2000, i % 7 % 5, "direct") for i in range(8000)} | {(i, i % 3, "fallback") for i in range(2000, 2005)}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_audit_moves_each_end_once(spark):
    edges = spark.range(3000).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("src"), F.concat(F.lit("r"), F.col("id").cast("string")).alias("dst"), F.lit("HAS_REQUIREMENT").alias("type"))
    rows = [("m1", "Module", None, 1), ("m9999", "Module", None, 1), ("r1", "Requirement", "x", None), ("c1", "Chunk", "x", 1), ("c1", "Chunk", "x", 1), (None, "Chunk", "x", 1), ("d1", "Document", None, 1)]
    nodes = spark.createDataFrame(rows, "id string, label string, text string, confidence_score int").withColumn("ingested_at", F.col("confidence_score"))
    before = moved(spark)
    got = {r["check"]: r["n"] for r in graph.full_audit(nodes, edges).collect()}
    assert moved(spark) - before < 7000
    assert got == {
        "isolated": 4, "module_without_requirement": 1, "chunk_without_document": 3, "chunk_without_module": 3, "requirement_without_text": 0,
        "chunk_without_embedding": 3, "requirement_without_ingested_at": 1, "requirement_without_confidence": 1,
    }


def test_gazetteer_deals_texts_out(spark, tmp_path):
    spark.range(4000).select(F.col("id").alias("k"), F.lit("Red bolt and ring").alias("t")).write.parquet(f"{tmp_path}/t")
    texts = spark.read.parquet(f"{tmp_path}/t")
    names = texts.select(F.element_at(F.split("t", " "), 2).alias("name")).union(texts.select(F.lower("t"))).distinct().withColumn("label", F.lit("C"))
    found = extract.gazetteer(texts, "k", "t", names)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    assert found.groupBy("name").count().collect() and found.count() == 8000


def test_dangling_keeps_and_moves(spark):
    edges = spark.createDataFrame([("a", "b", None), ("a", "q", "T"), ("q", "a", "T"), (None, "a", "T"), ("a", "b", "T")], "src string, dst string, type string")
    nodes = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    got = sorted((str(r["src"]), r["dst"], str(r["type"])) for r in graph.dangling(edges, nodes).collect())
    assert got == [("None", "a", "T"), ("a", "q", "T"), ("q", "a", "T")]


def test_pieces_follow_the_table(spark, tmp_path):
    spark.range(100_000).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert session.pieces(df) == session.width(spark)
    assert session.pieces(df, 1 << 12) > session.width(spark)
    assert session.pieces(spark.createDataFrame([(1,)], "id int").crossJoin(df)) == session.width(spark)
