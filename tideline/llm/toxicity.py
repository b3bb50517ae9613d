"""Toxicity by two Kneser-Ney models, one of toxic and one of ordinary texts.

A word is predicted from the class: its discounted share of the class's words, plus the class's
freed mass times a distribution that both classes share. That one counts, as Kneser-Ney does, in how
many classes a word occurs, not how often, so a word rare in one class and common in the other is
told apart, and one that neither knows favours none. A text's log-likelihoods are compared per word,
in three parts: words that speak for toxic or for ordinary text only, and words both classes know,
which tell the topic rather than the tone. A logistic curve of the parts is the score; it is fitted
on the labelled texts, each judged by counts without itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tideline.llm.shared import fold_number, small_batches

#: About so many labelled documents of each class are learned from, taken by a hash of the id.
SAMPLE = 4_000
DISCOUNT = 0.9
THRESHOLD = 0.7
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@dataclass
class ClassModels:
    """Counts go by a word's number and the class (0 ordinary, 1 toxic): texts that hold the word."""

    words: dict[str, int]
    counts: np.ndarray
    totals: np.ndarray  # of each class
    kinds: float  # how many (word, class) occur
    freed: float  # mass that discounting frees; one for both classes, so it favours none
    curve: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0, 1.0, 0.0]))

    def parts(self, text: str | None, own: int | None = None) -> np.ndarray:
        """Log-ratio per word of the whole text: words for toxic, known to both, for ordinary.

        ``own``: leave this text, of that class, out of the counts. Zeros for a text without words.
        """
        found, get = words_of(text), self.words.get
        numbers = np.fromiter((n for w in found if (n := get(w)) is not None), dtype=np.int64)
        if not len(numbers):
            return np.zeros(3)
        counts = self.counts[numbers]
        if own is not None:
            counts[:, own] -= 1
        shared = ((counts > 0).sum(axis=1) + 1 / len(self.words)) / (self.kinds + 1)
        known = (1 - self.freed) * np.maximum(counts - DISCOUNT, 0) / self.totals
        logs = np.log(known + (self.freed * shared)[:, None])
        ratio = logs[:, 1] - logs[:, 0]
        both = (counts > DISCOUNT).all(axis=1)
        sums = [ratio[~both & (ratio > 0)].sum(), ratio[both].sum(), ratio[~both & (ratio <= 0)].sum()]
        return np.array(sums) / len(found)

    def score(self, text: str | None) -> float:
        value = float(self.parts(text) @ self.curve[:3] + self.curve[3])
        return float(1 / (1 + np.exp(-np.clip(value, -40, 40))))


def fit_counts(sample: DataFrame) -> ClassModels:
    """Both models from rows (text, toxic); every text counts a word once. Spark sums all counts.

    All words are kept that two texts share; the sample of rows bounds how many there are. A word of one
    text alone tells nothing: left out of the counts, as the curve sees it, it occurs in neither class.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                found = sorted(set(words_of(text)))
                yield pd.DataFrame({"word": pd.Series(found, dtype=str), "toxic": np.int32(toxic)})

    by_word = (
        sample.select("text", "toxic").mapInPandas(count, "word string, toxic int")
        .groupBy("word")
        .agg(F.sum(1 - F.col("toxic")).alias("o"), F.sum("toxic").alias("t"))
    )
    kept = by_word.where("t + o > 1").orderBy("word").toPandas()
    counts = kept[["o", "t"]].to_numpy(dtype=np.float64)
    total = max(1.0, counts.sum())
    return ClassModels(
        {w: i for i, w in enumerate(kept["word"])}, counts, np.maximum(counts.sum(axis=0), 1.0),
        float((counts > 0).sum()), float(np.minimum(counts, DISCOUNT).sum() / total),
    )


def fit_curve(parts: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of the parts and a shift, by Newton steps with a weak pull to zero."""
    scale = parts.std(axis=0) + 1e-9
    rows, beta = np.column_stack([parts / scale, np.ones(len(parts))]), np.zeros(parts.shape[1] + 1)
    pull = np.diag([1e-4] * parts.shape[1] + [0.0]) * weight.sum()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -40, 40)))
        slope = rows.T @ (weight * (p - toxic)) + pull @ beta
        bend = (rows * (weight * p * (1 - p))[:, None]).T @ rows + pull
        step = np.linalg.solve(bend + 1e-4 * weight.sum() * np.eye(len(beta)), slope)
        beta -= np.clip(step, -3, 3)
    return np.append(beta[:-1] / scale, beta[-1])


def train(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE) -> ClassModels | None:
    """A model from rows of ``docs`` (doc_id, text) whose id is labelled and ``usable``.

    Several labels of a document are averaged (half counts as toxic), null ones left out. A hash
    of the id takes the share that gives ``sample`` documents of each class on average; equal texts
    with equal labels are learned from once. None without rows of both classes.
    """
    small_batches(docs.sparkSession)
    marks = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(
        (F.avg("toxic") >= 0.5).cast("int").alias("toxic")
    ).where(usable)
    sizes = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    share = {k: min(1.0, sample / n) for k, n in sizes.items()}
    taken = marks.where(draw < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    # About 2 * sample ids at most are broadcast; texts stay where they are.
    rows = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id")
    rows = rows.select("text", "toxic").distinct().persist()
    model = fit_counts(rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def parts(texts: pd.Series, own: pd.Series) -> pd.Series:
        return pd.Series([shared.value.parts(t, k) for t, k in zip(texts, own, strict=True)])

    seen = rows.select("toxic", parts("text", "toxic").alias("x")).toPandas()
    rows.unpersist()
    if seen["toxic"].nunique() < 2:
        return None
    weight = 1 / seen["toxic"].map(share).to_numpy(dtype=float)
    model.curve = fit_curve(np.stack(seen["x"].to_list()), seen["toxic"].to_numpy(dtype=float), weight)
    return model


def scored(docs: DataFrame, model: ClassModels | None, name: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the score of each whole text; null and empty texts get that of no words.

    Without a model all scores are 0.
    """
    if model is None:
        return docs.withColumn(name, F.lit(0.0))
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype=float)

    return docs.withColumn(name, score(F.col(text)))


def train_on_folds(docs: DataFrame, labels: DataFrame) -> ClassModels | None:
    return train(docs, labels, fold_number(F.col("doc_id"), 3) != 1)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from two of three folds, scores all rows."""
    held = F.coalesce(fold_number(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    return scored(docs.select("doc_id", "text"), train_on_folds(docs, labels)).select(
        "doc_id", held, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
