"""Language by prediction by partial matching: exact code lengths under frozen byte statistics.

For each language a tree of byte contexts up to three bytes long. A byte seen after its context
costs -log2(n / (all + distinct)) bits; else the escape, -log2(distinct / (all + distinct)), is
paid and the next shorter context asked; a context never seen costs nothing; after the empty one
come eight bits. The language with the shortest code wins, ties go to the first by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.llm.shared import fold_number, small_batches

ORDER = 3
#: About so many documents of each language are learned from, taken by a hash of the id.
SAMPLE = 2_000
#: Languages that share the tables of a model. A table has a number per language for each context
#: and byte that one of them knows, so its size stays in proportion to the counts.
BLOCK = 4


def _codes(text: str) -> np.ndarray:
    """Each byte with the three before it in one number; three line ends come first."""
    raw = np.frombuffer(b"\n" * ORDER + text.encode().lower(), dtype=np.uint8).astype(np.uint32)
    return (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]


@dataclass
class ByteTrees:
    """Costs in bits, a column per language. ``seen[k]``: contexts of k bytes with their byte."""

    languages: list[str]
    seen: list[tuple[np.ndarray, np.ndarray]]
    escapes: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(counts: pd.DataFrame) -> ByteTrees:
        """From (lang, code, n) of the longest contexts; shorter ones are their sums."""
        languages = sorted(counts["lang"].unique())
        column = {lang: i for i, lang in enumerate(languages)}
        lang = counts["lang"].map(column).to_numpy(dtype=np.int64)
        code, n = counts["code"].to_numpy(dtype=np.uint64), counts["n"].to_numpy(dtype=np.float64)
        seen, escapes = [], []
        for k in range(ORDER + 1):
            suffix = code & np.uint64((1 << 8 * (k + 1)) - 1)
            grams, at = np.unique(suffix, return_inverse=True)
            table = np.zeros((len(grams), len(languages)))
            np.add.at(table, (at, lang), n)
            contexts, up = np.unique(grams >> np.uint64(8), return_inverse=True)
            total, kinds = (np.zeros((len(contexts), len(languages))) for _ in range(2))
            np.add.at(total, up, table)
            np.add.at(kinds, up, table > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(kinds > 0, np.log2((total + kinds) / kinds), 0.0)
                cost = np.log2((total + kinds)[up] / table)
            if k == 0:
                shorter = np.full((len(grams), len(languages)), 8.0)
            else:
                older, costs = seen[-1]
                shorter = costs[np.searchsorted(older, grams & np.uint64((1 << 8 * k) - 1))]
            cost = np.where(table > 0, cost, escape[up] + shorter)
            seen.append((grams.astype(np.uint32), cost))
            escapes.append((contexts.astype(np.uint32), escape))
        return ByteTrees(languages, seen, escapes)

    def code_lengths(self, text: str) -> np.ndarray:
        """Bits for the whole text, per language."""
        bits = np.zeros(len(self.languages))
        whole = _codes(text)
        for at in range(0, len(whole), 1 << 20):
            rest = whole[at : at + (1 << 20)]
            for k in range(ORDER, -1, -1):
                if k < ORDER:
                    rest = rest & np.uint32((1 << 8 * (k + 1)) - 1)
                grams, costs = self.seen[k]
                place = np.minimum(np.searchsorted(grams, rest), len(grams) - 1)
                hit = grams[place] == rest
                bits += np.bincount(place[hit], minlength=len(grams)) @ costs if hit.sum() > len(grams) else costs[place[hit]].sum(axis=0)
                rest = rest[~hit]
                if not len(rest):
                    break
                contexts, escape = self.escapes[k]
                place = np.minimum(np.searchsorted(contexts, rest >> np.uint32(8)), len(contexts) - 1)
                known = contexts[place] == rest >> np.uint32(8)
                bits += escape[place[known]].sum(axis=0)
            else:
                bits += 8.0 * len(rest)
        return bits


@dataclass
class Languages:
    """Trees of any number of languages, a few to a block."""

    blocks: list[ByteTrees]

    @staticmethod
    def of(counts: pd.DataFrame, block: int = BLOCK) -> Languages:
        names = sorted(counts["lang"].unique())
        return Languages([
            ByteTrees.of(counts[counts["lang"].isin(names[i : i + block])]) for i in range(0, len(names), block)
        ])

    @property
    def languages(self) -> list[str]:
        return [lang for trees in self.blocks for lang in trees.languages]

    def code_lengths(self, text: str) -> np.ndarray:
        """Bits for the whole text, per language."""
        return np.concatenate([trees.code_lengths(text) for trees in self.blocks])


def train(labelled: DataFrame, sample: int = SAMPLE) -> Languages | None:
    """Trees from rows (doc_id, text, lang); null texts and languages are left out.

    Whole texts of a bounded sample are counted by Spark: of each language a hash of the id
    takes the share that gives ``sample`` documents on average. All their counts are kept, so no
    language is thinned by others. None if there is nothing to learn.
    """
    small_batches(labelled.sparkSession)
    usable = labelled.where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    share = F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, min(1.0, sample / v))])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                code, n = np.unique(np.concatenate([_codes(t) for t in texts]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "code": code.astype(np.int64), "n": n})

    counts = (
        usable.where(draw < share[F.col("lang")])
        .select("lang", "text")
        .mapInPandas(count, "lang string, code bigint, n bigint")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    return Languages.of(counts) if len(counts) else None


def predict(docs: DataFrame, model: Languages | None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred and score for whole texts.

    The score is the language's share of 2 ** -length, from equal odds. A null text, one without a
    letter, and any text without a model is ``und`` with score 0.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # as large as the counts of the sample

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        trees, out = shared.value, []
        names = [] if trees is None else trees.languages
        for value in texts:
            if trees is None or value is None or not any(map(str.isalpha, value)):
                out.append(("und", 0.0))
                continue
            bits = trees.code_lengths(value)
            best = int(np.argmin(bits))
            out.append((names[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    found = docs.select(F.col(doc_id).alias("doc_id"), run(F.col(text)).alias("r"))
    return found.select("doc_id", "r.lang_pred", "r.score")


def language_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Learns from three of four folds, predicts all rows. A null id is learned from by nobody."""
    fold = fold_number(F.col("doc_id"), 4)
    model = train(docs.select("doc_id", "text", "lang").where(fold != 2))
    held = F.coalesce(fold_number(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out")
    return predict(docs, model).select("doc_id", held, "lang_pred", "score")
