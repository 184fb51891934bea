"""Evaluation of answers: matching, ROUGE, judges, token vectors, averages."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.stem import stem, stemmed
from ..functions.text import parse_noisy_json, strip
from ..session import written


def match(predictions: DataFrame, gold: DataFrame, question: str, gold_question: str, order: str) -> tuple[DataFrame, DataFrame]:
    """Predictions with the last gold record, in ``order``, of the same stripped question; and those without any."""
    w = Window.partitionBy("__wl_q").orderBy(F.desc(order))
    last = gold.withColumn("__wl_q", strip(F.col(gold_question))).withColumn("__wl_n", F.row_number().over(w)).filter("__wl_n = 1").drop("__wl_n", gold_question, order)
    asked = predictions.withColumn("__wl_q", strip(F.col(question)))
    return asked.join(last, "__wl_q").drop("__wl_q"), asked.join(last.select("__wl_q"), "__wl_q", "left_anti").drop("__wl_q")


def ngrams(words: Column, n: int) -> Column:
    """The n-grams of a column of words; not of ``stemmed`` itself, as a lambda cannot hold a Python function."""
    if n == 1:
        return words
    size = F.size(words) - (n - 1)
    return F.when(size > 0, F.transform(F.sequence(F.lit(1), size), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def rouge_n(pairs: DataFrame, key: str, prediction: str, reference: str, n: int, stems: bool = False) -> DataFrame:
    """``(key, rouge)``: F1 of the multisets of n-grams of words, or of their ``stems``, to four places; 0 if either has none."""

    def grams(c: str) -> DataFrame:
        words = F.regexp_extract_all(F.lower(F.col(c)), F.lit(r"[a-z0-9]+"), F.lit(0))
        cut = pairs.select(key, (stemmed(words) if stems else words).alias("__wl_w"))
        return cut.select(key, F.explode(ngrams(F.col("__wl_w"), n)).alias("g")).groupBy(key, "g").agg(F.count("*").alias("n"))

    a, b = grams(prediction).withColumnRenamed("n", "na"), grams(reference).withColumnRenamed("n", "nb")
    sums = a.join(b, [key, "g"], "full_outer").groupBy(key).agg(F.sum(F.least(F.coalesce("na", F.lit(0)), F.coalesce("nb", F.lit(0)))).alias("both"), F.sum("na").alias("a"), F.sum("nb").alias("b"))
    f1 = F.when(F.col("both") > 0, F.round(2.0 * F.col("both") / (F.col("a") + F.col("b")), 4)).otherwise(0.0)
    return pairs.select(key).join(sums, key, "left").select(key, F.coalesce(f1, F.lit(0.0)).alias("rouge"))


def lcs(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, with a bit for each word of ``a``."""
    where: dict[str, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    row = (1 << len(a)) - 1
    full = row
    for w in b:
        hit = row & where.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _words(text: str, stems: bool) -> list[str]:
    import re

    return [stem(w) if stems and len(w) > 3 else w for w in re.findall(r"[a-z0-9]+", text.lower())]


@F.pandas_udf(DoubleType())
def rouge_l(prediction: pd.Series, reference: pd.Series) -> pd.Series:
    """F1 of the longest common subsequence of words, to four places."""
    return _longest(prediction, reference, False)


@F.pandas_udf(DoubleType())
def rouge_l_stems(prediction: pd.Series, reference: pd.Series) -> pd.Series:
    """F1 of the longest common subsequence of stems, to four places."""
    return _longest(prediction, reference, True)


def _longest(prediction: pd.Series, reference: pd.Series, stems: bool) -> pd.Series:
    out = []
    for p, r in zip(prediction.fillna(""), reference.fillna(""), strict=True):
        x, y = _words(p, stems), _words(r, stems)
        out.append(round(2 * lcs(x, y) / (len(x) + len(y)), 4) if x and y else 0.0)
    return pd.Series(out, dtype="float64")


#: What each judge is asked to score from 0 to 5, and which texts it gets.
JUDGES = {
    "answer": (("correctness", "completeness"), ("reference", "answer")), "reasoning": (("logical_validity", "relevance"), ("reference", "reasoning")),
    "faithfulness": (("faithfulness",), ("contexts", "answer")), "recall": (("context_recall",), ("contexts", "reasoning")),
}


def judged(pairs: DataFrame, ask: Callable[[str, Column], Column]) -> DataFrame:
    """``pairs (answer, reasoning, reference, reference_contexts, ...)`` with a column for each score of each judge, null where a judge gives none of 0 to 5.

    ``ask`` gives a model's answers to ``(system, texts)``.
    """
    texts = {"contexts": F.array_join("reference_contexts", "\n\n---\n\n"), "reference": F.col("reference"), "answer": F.col("answer"), "reasoning": F.col("reasoning")}
    for scores, parts in JUDGES.values():
        system = "Score from 0 to 5 and answer as JSON alone: {" + ", ".join(f'"{s}": 0' for s in scores) + "}"
        user = F.concat_ws("\n\n", *[F.concat(F.lit(f"{p}:\n"), F.coalesce(texts[p], F.lit(""))) for p in parts])
        pairs = pairs.withColumn("__wl_said", F.from_json(parse_noisy_json(ask(system, user)), ", ".join(f"{s} double" for s in scores)))
        for s in scores:
            pairs = pairs.withColumn(s, F.when(F.col(f"__wl_said.{s}").between(0, 5), F.col(f"__wl_said.{s}")))
        pairs = pairs.drop("__wl_said")
    return pairs


def token_score(embed: Callable[[list[str]], np.ndarray]):
    """A column function of ``(prediction, reference)``: F1 of the best cosines between their tokens' vectors, to four places; 0 if either has none.

    ``embed`` gives a row for each token of a list.
    """
    import re

    @F.pandas_udf(DoubleType())
    def scored(prediction: pd.Series, reference: pd.Series) -> pd.Series:
        out = []
        for p, r in zip(prediction.fillna(""), reference.fillna(""), strict=True):
            x, y = (re.findall(r"[a-z0-9]+", t.lower()) for t in (p, r))
            if not x or not y:
                out.append(0.0)
                continue
            a, b = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12) for m in (embed(x), embed(y)))
            near = a @ b.T
            one, two = near.max(axis=1).mean(), near.max(axis=0).mean()
            out.append(round(float(2 * one * two / (one + two)), 4) if one + two > 0 else 0.0)
        return pd.Series(out, dtype="float64")

    return scored


def trigram_vectors(tokens: list[str], size: int = 256) -> np.ndarray:
    """Vectors that stand in for a model's: counts of hashed letter trigrams."""
    import zlib

    out = np.zeros((len(tokens), size))
    for i, t in enumerate(tokens):
        for at in range(len(t)):
            out[i, zlib.crc32(f" {t} "[at : at + 3].encode()) % size] += 1
    return out


def assembled(predictions: DataFrame, gold: DataFrame, ask: Callable[[str, Column], Column] | None = None, embed: Callable[[list[str]], np.ndarray] = trigram_vectors) -> tuple[DataFrame, DataFrame]:
    """All metrics of each prediction without errors, one row each however often a question is asked; and the predictions without a gold record."""
    said = written(predictions.filter(F.coalesce(F.size("errors"), F.lit(0)) <= 0).withColumn("key", F.monotonically_increasing_id()), "predictions")
    found, unmatched = match(said, gold, "question", "user_input", "position")
    scored = found.withColumn("rougeL", rouge_l_stems("answer", "reference")).withColumn("bert_score", token_score(embed)("answer", "reference"))
    scored = judged(scored, ask) if ask else scored
    for n in (1, 2):
        scored = scored.join(rouge_n(found, "key", "answer", "reference", n, True).withColumnRenamed("rouge", f"rouge{n}"), "key")
    return scored.drop("key"), unmatched.drop("key")


def summary(scores: DataFrame, columns: list[str]) -> DataFrame:
    """Averages to four places without nulls; null where there is no value."""
    return scores.agg(F.count("*").alias("records"), *[F.round(F.avg(c), 4).alias(f"avg_{c}") for c in columns])
