"""Answering questions from a graph: search, expansion, context, debate; batches of questions, and the memory of what was asked."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import graph, maintain, vectors
from ..session import written

#: Chunks that a question starts from, hops, least index score, and tokens of a context.
TOP, HOPS, LEAST, TOKENS = 5, 3, 0.70, 6000
#: Legs of the debate and what each weighs.
WEIGHTS = {"prosecutor": 0.45, "defender": 0.35, "skeptic": 0.20}
RELATED = ("Entity", "Requirement", "Concept")
SYSTEM = 'Answer from the context alone, as JSON: {"answer": "...", "reasoning": "...", "evidence": ["..."], "confidence": 0.0}'
_SAID = "answer string, reasoning string, evidence array<string>, confidence double"


def described(*columns: str) -> Column:
    """The first of some texts that is not null, or an empty one."""
    return F.coalesce(*map(F.col, columns), F.lit(""))


def seeds(questions: DataFrame, chunks: DataFrame, embed: Callable[[Column], Column] = tx.embedding, k: int = TOP, least: float = LEAST) -> DataFrame:
    """``(question_id, rank, chunk_id, score, text)``: the ``k`` chunks nearest to each question, of an index score of ``least`` or more.

    ``chunks`` has ``(chunk_id, text, embedding)``. A question that finds none
    starts from the first ``k`` chunks, each with score 1.
    """
    asked = questions.select(F.col("question_id").alias("key"), embed(F.col("question")).alias("embedding"))
    base = chunks.select(F.col("chunk_id").alias("key"), "embedding")
    kind = dict(base.dtypes)["key"]
    # Keys of questions are kept apart from those of chunks.
    named = asked.select(F.concat(F.lit("q\x1f"), F.col("key").cast("string")).alias("key"), "embedding")
    found = vectors.search(base.select(F.concat(F.lit("c\x1f"), F.col("key").cast("string")).alias("key"), "embedding"), named, "key", "embedding", k)
    bare = lambda c: F.substring(c, 3, 1 << 30)
    scored = found.select(bare("a").cast(dict(asked.dtypes)["key"]).alias("question_id"), bare("b").cast(kind).alias("chunk_id"), vectors.index_score(F.col("cosine")).alias("score"), "rank").filter(F.col("score") >= least)
    scored = written(scored, "seeds")
    first = chunks.select("chunk_id").orderBy("chunk_id").limit(k).withColumn("rank", F.row_number().over(Window.orderBy("chunk_id")))
    alone = questions.select("question_id").join(scored.select("question_id"), "question_id", "left_anti")
    rest = alone.join(F.broadcast(first)).select("question_id", "chunk_id", F.lit(1.0).alias("score"), "rank")
    return scored.unionByName(rest).join(chunks.select("chunk_id", "text"), "chunk_id").select("question_id", "rank", "chunk_id", "score", "text")


def expand(nodes: DataFrame, edges: DataFrame, starts: DataFrame, k: int = TOP, hops: int = HOPS, labels: tuple[str, ...] = RELATED) -> tuple[DataFrame, DataFrame]:
    """Nodes ``(question_id, node, label, name, description, hops)``, once each, and path steps ``(question_id, seed, node, via, hops)`` of each question.

    Trails of up to ``hops`` edges lead from a question's chunks to named nodes
    of some labels; of each question the ``k * hops * 20`` shortest count, ties
    by seed, node and types. As many of each chunk and number of hops are made.
    """
    limit = k * hops * 20
    related = nodes.filter(F.col("label").isin(*labels) & F.col("name").isNotNull()).select(F.col("id").alias("node"), "label", "name", F.substring(described(*[c for c in ("definition", "description", "text") if c in nodes.columns]), 1, 400).alias("description"))
    begun = starts.select("question_id", F.col("chunk_id").cast("string").alias("id"))
    found = graph.first_trails(edges, begun.select("id"), related.select("node"), limit, hops)
    met = begun.withColumnRenamed("id", "seed").join(found, "seed")
    order = Window.partitionBy("question_id").orderBy("hops", "seed", "node", F.concat_ws(",", "via"))
    steps = written(met.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= limit).select("question_id", "seed", "node", "via", "hops"), "paths")
    once = steps.groupBy("question_id", "node").agg(F.min("hops").alias("hops"))
    return once.join(related, "node").select("question_id", "node", "label", "name", "description", "hops"), steps


def contexts(questions: DataFrame, nodes: DataFrame, edges: DataFrame, chunks: DataFrame, embed: Callable[[Column], Column] = tx.embedding, k: int = TOP, hops: int = HOPS, least: float = LEAST, tokens: int = TOKENS) -> DataFrame:
    """``(question_id, context, score)``: what a question is answered from, and the best score of its chunks."""
    starts = written(seeds(questions, chunks, embed, k, least), "starts")
    around, _ = expand(nodes, edges, starts, k, hops)
    best = starts.groupBy("question_id").agg(F.max("score").alias("score"))
    return maintain.context(starts, around, ["question_id"], tokens).join(best, "question_id")


def extractive(question: Column, context: Column, score: Column) -> Column:
    """A leg without a model, as a model's JSON: the line of the context that shares most words with the question, the first of equals."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(tx.WORD), F.lit(0)))
    lines = F.filter(F.split(context, "\n"), lambda x: (F.length(x) > 20) & ~x.startswith("[Chunk ") & ~x.startswith("==="))
    best = tx.once(words(question), lambda q: F.array_max(F.transform(lines, lambda x, i: F.struct(F.size(F.array_intersect(words(x), q)).alias("n"), (-i).alias("i"), x.alias("x")))))
    return F.to_json(F.struct(F.coalesce(best["x"], F.lit("")).alias("answer"), F.lit("the line that shares most words with the question").alias("reasoning"), F.array(F.coalesce(best["x"], F.lit(""))).alias("evidence"), F.round(score, 3).alias("confidence")))


def debate(asked: DataFrame, legs: dict[str, Callable[[Column, Column, Column], Column]] | None = None) -> DataFrame:
    """``(question_id, answer, reasoning, evidence, confidence)`` of ``(question_id, question, context, score)``.

    Each leg answers with JSON; one without an answer does not count. Confidence
    is the weighted mean of those that do, the heaviest gives the answer, and
    evidence is all of theirs, once each, in order of the legs.
    """
    legs = legs or dict.fromkeys(WEIGHTS, extractive)
    said = [F.struct(F.lit(name).alias("leg"), F.lit(WEIGHTS.get(name, 0.0)).alias("weight"), F.from_json(tx.parse_noisy_json(call(F.col("question"), F.col("context"), F.col("score"))), _SAID).alias("r")) for name, call in legs.items()]
    there = F.filter(F.array(*said), lambda x: x["r"].isNotNull() & (F.coalesce(x["r"]["answer"], F.lit("")) != ""))
    heard = written(asked.select("question_id", there.alias("legs")), "legs")
    total = F.aggregate("legs", F.lit(0.0), lambda a, x: a + x["weight"])
    summed = F.aggregate("legs", F.lit(0.0), lambda a, x: a + x["weight"] * F.coalesce(x["r"]["confidence"], F.lit(0.5)))
    first = F.array_max(F.transform("legs", lambda x, i: F.struct(x["weight"].alias("w"), (-i).alias("i"), x["r"]["answer"].alias("answer"))))["answer"]
    told = F.array_join(F.transform("legs", lambda x: F.concat(F.lit("["), x["leg"], F.format_string(" | conf=%.2f] ", F.coalesce(x["r"]["confidence"], F.lit(0.0))), F.coalesce(x["r"]["reasoning"], F.lit("")))), "\n\n")
    evidence = F.array_distinct(F.flatten(F.transform("legs", lambda x: F.coalesce(x["r"]["evidence"], F.array().cast("array<string>")))))
    reasoning = F.concat(F.format_string(f"Multi-agent debate (%d/{len(legs)} legs):\n\n", F.size("legs")), told)
    return heard.select("question_id", first.alias("answer"), F.when(F.size("legs") > 0, reasoning).alias("reasoning"), evidence.alias("evidence"), F.when(total > 0, F.round(summed / total, 3)).alias("confidence"))


def ask(questions: DataFrame, nodes: DataFrame, edges: DataFrame, as_of: str, embed: Callable[[Column], Column] = tx.embedding, legs=None, least: float = LEAST) -> DataFrame:
    """``(question_id, question, answer, reasoning, evidence, confidence, run_at, errors)`` of each question; errors are kept, not raised.

    Chunks are the graph's nodes of that label; those without an ``embedding``
    are embedded here.
    """
    chunks = nodes.filter("label = 'Chunk'").select(F.col("id").alias("chunk_id"), "text", *(["embedding"] if "embedding" in nodes.columns else []))
    if "embedding" not in nodes.columns:
        chunks = chunks.withColumn("embedding", embed(F.col("text")))
    asked = questions.select("question_id", "question").join(contexts(questions, nodes, edges, chunks, embed, least=least), "question_id", "left")
    answers = debate(asked.withColumn("context", F.coalesce("context", F.lit(""))).withColumn("score", F.coalesce("score", F.lit(0.0))), legs)
    failed = F.when(F.coalesce("answer", F.lit("")) == "", F.array(F.lit("no leg of the debate has answered"))).otherwise(F.array().cast("array<string>"))
    return questions.select("question_id", "question").join(answers, "question_id", "left").withColumn("run_at", F.lit(as_of)).withColumn("errors", failed)


#: Words that tell what kind of question it is; the first kind that fits counts.
CATEGORIES = (
    ("impact_assessment", "impact|affect|break|consequence|change"), ("dependency_analysis", "depend|require[sd]? by|relies|uses|upstream|downstream"), ("compliance_check", "comply|compliance|conform|violat|standard"),
    ("gap_analysis", "gap|missing|lack|uncovered|not specified"), ("requirement_lookup", "requirement|shall|specif|defin|what is"),
)


def question_class(question: Column) -> Column:
    """``(category, complexity)`` by words, else general and simple."""
    low, kind = F.lower(question), F.lit(None).cast("string")
    for name, words in reversed(CATEGORIES):
        kind = F.when(low.rlike(words), name).otherwise(kind)
    complexity = F.when(low.rlike(r"across|between modules|cross-module"), "cross_module").when(low.rlike(r"\b(and|then|through|via|chain)\b"), "multi_hop").otherwise("simple")
    return F.struct(F.coalesce(kind, F.lit("general")).alias("category"), complexity.alias("complexity"))


def remember(memory: DataFrame, answers: DataFrame) -> DataFrame:
    """``memory (question, category, complexity, last_confidence, last_asked_at, ask_count)`` with the answers ``(question, confidence, run_at)`` added."""
    new = answers.groupBy("question").agg(F.max(F.struct(F.col("run_at").alias("at"), F.coalesce("confidence", F.lit(0.0)).alias("c"))).alias("last"), F.count("*").alias("n"))
    c = question_class(F.col("question"))
    now = new.select("question", c["category"].alias("category"), c["complexity"].alias("complexity"), F.col("last.c").alias("last_confidence"), F.col("last.at").alias("last_asked_at"), "n")
    old = memory.select("question", F.col("ask_count").alias("before"))
    known = now.join(old, "question", "left").withColumn("ask_count", F.col("n") + F.coalesce("before", F.lit(0))).drop("n", "before")
    return memory.join(now.select("question"), "question", "left_anti").unionByName(known.select(*memory.columns))


MEMORY = "question string, category string, complexity string, last_confidence double, last_asked_at string, ask_count long"
