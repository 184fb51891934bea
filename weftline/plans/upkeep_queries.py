"""Queries over events, votes, answers and windows of time: upkeep, evaluation, and the batch forms of streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import evaluate, maintain
from ..streaming import events as stream
from .catalog import query
from .graph_queries import TRADE, _heavy, _trade

AS_OF = "2024-02-01 00:00:00"
K = "CAST(json_extract_string(props, '$.k') AS INT)"
REASONS = f"""concat_ws(',', CASE WHEN ts < TIMESTAMP '{AS_OF}' - INTERVAL 22 DAY THEN 'age_exceeded' END,
    CASE WHEN value / 500 < 0.70 AND event_type <> 'view' THEN 'low_confidence' END, CASE WHEN {K} <> 42 THEN 'schema_drift' END)"""


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def _reasons():
    method = F.when(F.col("event_type") == "view", "rule_based").otherwise(F.col("event_type"))
    return maintain.evolution_reasons(F.col("ts"), F.col("value") / 500, method, _k(), F.to_timestamp_ntz(F.lit(AS_OF)), 22, 0.70, F.lit(42))


@query(f"SELECT event_id, {REASONS} AS reasons FROM events WHERE {REASONS} <> ''")
def evolution_flags(t):
    return t.events.select("event_id", _reasons().alias("reasons")).filter("reasons <> ''")


@query(f"SELECT reasons, count(*) AS nodes FROM (SELECT {REASONS} AS reasons FROM events) WHERE reasons <> '' GROUP BY 1")
def evolution_counts(t):
    return t.events.select(_reasons().alias("reasons")).filter("reasons <> ''").groupBy("reasons").agg(F.count("*").alias("nodes"))


COUNTER = "round(least(1.0, 0.25 * stale + least(0.3 * hits, 0.6)), 2)"


@query(f"""WITH {TRADE}, ends AS (SELECT id, count(*) AS hits FROM (SELECT a.src AS id FROM heavy a JOIN heavy b ON a.src = b.dst AND a.dst = b.src WHERE a.src < a.dst UNION ALL SELECT a.dst FROM heavy a JOIN heavy b ON a.src = b.dst AND a.dst = b.src WHERE a.src < a.dst) GROUP BY id),
    f AS (SELECT n_nationkey AS id, CASE WHEN n_regionkey = 2 THEN 1 ELSE 0 END AS stale, coalesce(hits, 0) AS hits FROM nation LEFT JOIN ends ON id = n_nationkey),
    s AS (SELECT h.src, h.dst, a.stale + CASE WHEN h.src = h.dst THEN 0 ELSE b.stale END AS stale, a.hits + CASE WHEN h.src = h.dst THEN 0 ELSE b.hits END AS hits FROM heavy h JOIN f a ON h.src = a.id JOIN f b ON h.dst = b.id)
    SELECT src, dst, CAST(stale AS BIGINT) AS stale_ends, CAST(hits AS BIGINT) AS contradictions, CAST({COUNTER} AS DOUBLE) AS counter, CASE WHEN {COUNTER} >= 0.90 OR round(0.7 * {COUNTER}, 3) >= 0.40 THEN 'rejected' ELSE 'accepted' END AS verdict FROM s""")
def verification_scores(t):
    from ..operators.graph import two_way

    edges = _heavy(t)
    nodes = t.nation.select(F.col("n_nationkey").alias("id"), (F.col("n_regionkey") == 2).alias("stale"))
    found = maintain.hypothesis_evidence(edges, nodes, two_way(edges).toDF("src", "dst"))
    scored = found.withColumn("counter", maintain.counter_score(F.col("stale_ends"), F.col("contradictions")))
    return scored.select("src", "dst", "stale_ends", "contradictions", "counter", maintain.verdict(F.col("counter"), F.lit(0.0))["verdict"].alias("verdict"))


@query("""WITH m AS (SELECT event_type AS module, max(ts) FILTER (WHERE user_id % 10 = 0) AS last FROM events GROUP BY 1), n AS (SELECT e.event_type AS module, e.event_id, row_number() OVER (PARTITION BY e.event_type ORDER BY e.ts DESC, e.event_id) AS k FROM events e JOIN m ON m.module = e.event_type WHERE m.last IS NULL OR e.ts > m.last)
    SELECT module, count(*) AS chunks, array_to_string(list(event_id ORDER BY k) FILTER (WHERE k <= 30), ',') AS newest FROM n GROUP BY module""")
def modules_needing_summary(t):
    """Each module's chunks since its last summary, the newest 30 by name."""
    marks = t.events.groupBy(F.col("event_type").alias("module")).agg(F.max(F.when(F.col("user_id") % 10 == 0, F.col("ts"))).alias("last"))
    new = t.events.withColumnRenamed("event_type", "module").join(marks, "module").filter("last IS NULL OR ts > last").select("module", "event_id", "ts")
    counts = new.groupBy("module").agg(F.count("*").alias("chunks"))
    top = new.withColumn("k", F.row_number().over(Window.partitionBy("module").orderBy(F.desc("ts"), "event_id"))).filter("k <= 30")
    names = top.groupBy("module").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "event_id"))), lambda x: x["event_id"].cast("string")), ",").alias("newest"))
    return counts.join(names, "module")


@query("""SELECT agent, hypotheses, rejected, avg_confidence, rejection_rate, CASE WHEN rejection_rate >= 0.20 THEN 'degraded' ELSE 'ok' END AS health, CASE WHEN rejection_rate >= 0.20 THEN 0.75 ELSE 0.70 END AS threshold
    FROM (SELECT event_type AS agent, count(*) AS hypotheses, count(*) FILTER (WHERE value < 100) AS rejected, CAST(round(CAST(avg(CAST(value AS DECIMAL(18, 2))) AS DOUBLE), 3) AS DOUBLE) AS avg_confidence, round(count(*) FILTER (WHERE value < 100) / count(*), 3) AS rejection_rate FROM events GROUP BY 1)""")
def watchdog_metrics(t):
    m = t.events.groupBy(F.col("event_type").alias("agent")).agg(F.count("*").alias("hypotheses"), F.count_if(F.col("value") < 100).alias("rejected"), F.round(F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count("value"), 3).alias("avg_confidence"))
    m = m.withColumn("rejection_rate", F.round(F.col("rejected") / F.col("hypotheses"), 3))
    return m.withColumn("health", maintain.health(F.col("rejection_rate"), F.lit(0.0), 0.20)).withColumn("threshold", maintain.tuned_threshold(F.lit(0.70), F.col("rejection_rate"), 0.20))


PATTERNS = "SELECT user_id, event_type, count(*) AS asks, arg_max(value, ts) AS last_confidence, max(ts) AS last_asked_at FROM events GROUP BY 1, 2"


def _patterns(t):
    return maintain.query_patterns(t.events, ["user_id", "event_type"], "ts", "value")


@query(PATTERNS)
def query_patterns(t):
    return _patterns(t)


@query(f"SELECT user_id, event_type, asks FROM ({PATTERNS}) WHERE asks >= 3 ORDER BY asks DESC, user_id, event_type LIMIT 10")
def hot_spots(t):
    return _patterns(t).filter("asks >= 3").orderBy(F.desc("asks"), "user_id", "event_type").limit(10).select("user_id", "event_type", "asks")


@query(f"SELECT user_id, event_type, last_confidence FROM ({PATTERNS}) WHERE last_confidence < 60 ORDER BY last_confidence, user_id, event_type LIMIT 10")
def low_conf_gaps(t):
    return _patterns(t).filter("last_confidence < 60").orderBy("last_confidence", "user_id", "event_type").limit(10).select("user_id", "event_type", "last_confidence")


@query("""WITH legs AS (SELECT user_id, event_type AS leg, CASE event_type WHEN 'click' THEN 0.45 WHEN 'view' THEN 0.35 ELSE 0.20 END AS weight, CAST(max(value) AS DOUBLE) AS confidence FROM events GROUP BY ALL)
    SELECT user_id, round(sum(confidence * weight) / sum(weight), 3) AS confidence, arg_min(leg, (-weight, leg)) AS "primary" FROM legs GROUP BY user_id""")
def debate_vote(t):
    weight = F.when(F.col("leg") == "click", 0.45).when(F.col("leg") == "view", 0.35).otherwise(0.20)
    legs = t.events.groupBy("user_id", F.col("event_type").alias("leg")).agg(F.max("value").alias("confidence")).withColumn("weight", weight)
    return maintain.vote(legs, ["user_id"])


@query("""WITH s AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r, doc_id, text FROM documents), a AS (SELECT source, string_agg('[Chunk ' || doc_id || ' | score=0.500]' || chr(10) || substr(text, 1, 800), chr(10) || chr(10) ORDER BY r) AS a FROM s WHERE r <= 3 GROUP BY source),
    n AS (SELECT source, lang, count(*) AS c FROM documents GROUP BY ALL), b AS (SELECT source, string_agg('[Lang] ' || lang || ' (hop=1)' || chr(10) || '  → ' || c, chr(10) || chr(10) ORDER BY lang) AS b FROM n GROUP BY source)
    SELECT source, md5('=== Relevant Document Chunks ===' || chr(10) || chr(10) || a || chr(10) || chr(10) || chr(10) || '=== Knowledge Graph Context (multi-hop expansion) ===' || chr(10) || chr(10) || b) AS digest FROM a JOIN b USING (source)""")
def build_context(t):
    seeds = t.documents.withColumn("rank", F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))).filter("rank <= 3").select("source", "rank", F.col("doc_id").alias("chunk_id"), F.lit(0.5).alias("score"), "text")
    nodes = t.documents.groupBy("source", F.col("lang").alias("name")).agg(F.count("*").cast("string").alias("description")).withColumn("hops", F.lit(1)).withColumn("label", F.lit("Lang"))
    return maintain.context(seeds, nodes, ["source"]).select("source", F.md5("context").alias("digest"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events")
def parse_llm_json(t):
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("The answer: "), "props", F.lit(" so it is"))).otherwise("no json {here")
    return t.events.select("event_id", F.get_json_object(tx.parse_noisy_json(raw), "$.k").cast("long").alias("k"))


TURNS = "SELECT conv_id, turn, text AS answer, lag(text) OVER w AS question, lag(role) OVER w AS asker, role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"
QA = f"qa AS (SELECT conv_id, turn, question, answer FROM ({TURNS}) WHERE role = 'assistant' AND asker = 'user')"


def _qa(t):
    w = Window.partitionBy("conv_id").orderBy("turn")
    said = t.conversations.select("conv_id", "turn", F.col("text").alias("answer"), F.lag("text").over(w).alias("question"), F.lag("role").over(w).alias("asker"), "role")
    return said.filter("role = 'assistant' AND asker = 'user'").select("conv_id", "turn", "question", "answer")


MATCHED = f"""{QA}, gold AS (SELECT trim(question) AS q, arg_max(answer, conv_id * 1000 + turn) AS reference FROM qa WHERE conv_id % 3 <> 0 GROUP BY 1)"""


def _matched(t):
    qa = _qa(t)
    gold = qa.filter("conv_id % 3 <> 0").select(F.col("question").alias("user_input"), F.col("answer").alias("reference"), (F.col("conv_id") * 1000 + F.col("turn")).alias("position"))
    return evaluate.match(qa, gold, "question", "user_input", "position")


@query(f"WITH {MATCHED} SELECT conv_id, turn, md5(reference) AS reference FROM qa JOIN gold ON trim(question) = q")
def eval_match(t):
    return _matched(t)[0].select("conv_id", "turn", F.md5("reference").alias("reference"))


@query(f"WITH {MATCHED} SELECT conv_id, turn FROM qa WHERE trim(question) NOT IN (SELECT q FROM gold)")
def eval_unmatched(t):
    return _matched(t)[1].select("conv_id", "turn")


def _rouge(n: int) -> str:
    grams = "regexp_extract_all(lower({}), '[a-z0-9]+')"
    many = (lambda c: f"unnest({grams.format(c)})") if n == 1 else (lambda c: f"unnest([{grams.format(c)}[i] || ' ' || {grams.format(c)}[i + 1] FOR i IN range(1, len({grams.format(c)}))])")
    return f"""{QA}, p AS (SELECT conv_id, turn, g, count(*) AS n FROM (SELECT conv_id, turn, {many('answer')} AS g FROM qa) GROUP BY ALL), r AS (SELECT conv_id, turn, g, count(*) AS n FROM (SELECT conv_id, turn, {many('question')} AS g FROM qa) GROUP BY ALL),
    b AS (SELECT p.conv_id, p.turn, sum(least(p.n, r.n)) AS n FROM p JOIN r USING (conv_id, turn, g) GROUP BY ALL), tp AS (SELECT conv_id, turn, sum(n) AS n FROM p GROUP BY ALL), tr AS (SELECT conv_id, turn, sum(n) AS n FROM r GROUP BY ALL),
    rouge AS (SELECT qa.conv_id, qa.turn, CASE WHEN coalesce(b.n, 0) > 0 THEN round(CAST(2.0 * b.n AS DOUBLE) / (tp.n + tr.n), 4) ELSE 0.0 END AS rouge FROM qa LEFT JOIN b USING (conv_id, turn) LEFT JOIN tp USING (conv_id, turn) LEFT JOIN tr USING (conv_id, turn))"""


def _pairs(t):
    return _qa(t).withColumn("key", F.struct("conv_id", "turn"))


@query(f"WITH {_rouge(1)} SELECT conv_id, turn, CAST(rouge AS DOUBLE) AS rouge FROM rouge")
def rouge1(t):
    return evaluate.rouge_n(_pairs(t), "key", "answer", "question", 1).select("key.*", "rouge")


@query(f"WITH {_rouge(2)} SELECT conv_id, turn, CAST(rouge AS DOUBLE) AS rouge FROM rouge")
def rouge2(t):
    return evaluate.rouge_n(_pairs(t), "key", "answer", "question", 2).select("key.*", "rouge")


@query(None)
def rouge_l(t):
    """The longest common subsequence is beyond SQL; tests compare it with the quadratic table."""
    return _qa(t).select("conv_id", "turn", evaluate.rouge_l("answer", "question").alias("rouge"))


@query(f"WITH {_rouge(1)} SELECT count(*) AS records, CAST(round(avg(rouge), 4) AS DOUBLE) AS avg_rouge FROM rouge")
def eval_summary(t):
    return evaluate.summary(evaluate.rouge_n(_pairs(t), "key", "answer", "question", 1), ["rouge"])


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS value FROM events GROUP BY ALL")
def events_tumbling(t):
    return stream.tumbling(t.events)


@query("""WITH s AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM s)
    SELECT user_id, min(ts) AS start, max(ts) AS last, count(*) AS events FROM g GROUP BY user_id, k""")
def events_session(t):
    return stream.sessions(t.events)


@query("SELECT user_id, event_type, date_trunc('hour', ts) AS hour, min(event_id) AS event_id FROM events GROUP BY ALL")
def events_dedup(t):
    return t.events.groupBy("user_id", "event_type", F.date_trunc("hour", "ts").alias("hour")).agg(F.min("event_id").alias("event_id"))


@query(f"WITH {TRADE} SELECT src, count(*) AS targets, CAST(sum(w) AS BIGINT) AS lines, count(*) FILTER (WHERE w >= (SELECT avg(w) + stddev_pop(w) FROM trade)) AS heavy FROM trade GROUP BY src")
def trade_graph(t):
    edges = _trade(t)
    heavy = _heavy(t).groupBy("src").agg(F.count("*").alias("heavy"))
    return edges.groupBy("src").agg(F.count("*").alias("targets"), F.sum("w").alias("lines")).join(heavy, "src", "left").select("src", "targets", "lines", F.coalesce("heavy", F.lit(0).cast("long")).alias("heavy"))
