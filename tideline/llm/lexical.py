"""Ranked lexical search: MaxScore with bounds of term pairs.

Documents are cut into segments, in which each term asked for has a posting list and its greatest
impact. Terms of a query are chained by rarity, and each neighbouring pair has its intersection
list, ordered by joint impact: a document holds both terms, only one or none, so the greater of the
joint maximum and the two single ones bounds what the pair adds to any score. A query cuts the rest
of its chain into the pairs that save most; the sum of their bounds, not of all single maxima,
decides from where on lists are skipped. The k-th joint impact of a pair is a first threshold.

A segment is one row and needs nothing of the others, so an index is a table like any other: search
it at once or store it first. Defined results: a null text or one without terms has no posting and
counts nowhere; a null id comes last among equal scores; rows that share an id are documents of
their own, items that share one are queries of their own; no rows, or no score above 0, give none.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tideline.llm.shared import checkpointed, small_batches

TOP = 10
#: Postings in a segment, and bytes of query texts that are asked in one pass over the documents.
POSTINGS, QUERY_BYTES = 1_500_000, 4 * 1024 * 1024
#: Groups that the best of all tasks are first narrowed down in.
_SALTS = 64
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SEGMENT = (
    "ids binary, unnamed binary, terms binary, ends binary, docs binary, parts binary, "
    "pairs binary, pair_ends binary, pair_docs binary, pair_sums binary"
)
_KINDS = {
    "ids": "<i8", "unnamed": "?", "terms": "<i4", "ends": "<i8", "docs": "<i4", "parts": "<i4",
    "pairs": "<i4", "pair_ends": "<i8", "pair_docs": "<i4", "pair_sums": "<i8",
}


def terms_of(text: str | None) -> list[bytes]:
    return _TERM.findall((text or "").encode("utf-8", "surrogatepass").translate(_FOLD))


@dataclass
class Queries:
    """Numbered terms with their weights; of each query its terms from the rarest on."""

    numbers: dict[bytes, int]
    items: list[list[int]]
    documents: int = 0
    words: int = 0
    weights: np.ndarray | None = None

    @staticmethod
    def of(texts: list[str | None]) -> Queries:
        numbers: dict[bytes, int] = {}
        items = [sorted({numbers.setdefault(t, len(numbers)) for t in terms_of(x)}) for x in texts]
        return Queries(numbers, items)

    @property
    def pairs(self) -> list[tuple[int, int]]:
        return sorted({pair for item in self.items for pair in zip(item, item[1:])})

    def weigh(self, documents: int, words: int, holding: dict[int, int]) -> None:
        """Weights, and the order of each query's terms, from how many documents hold each term."""
        df = np.array([holding.get(k, 0) for k in range(len(self.numbers))], dtype=np.int64)
        self.documents, self.words = documents, words
        self.weights = np.array(
            [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df], dtype=np.int64
        )
        useful = [[k for k in item if df[k] and self.weights[k] > 0] for item in self.items]
        self.items = [sorted(item, key=lambda k: (df[k], k)) for item in useful]


def measure(docs: DataFrame, queries: Queries) -> Queries:
    """Counts of all documents, of all their words, and of documents that hold each query term."""
    shared = docs.sparkSession.sparkContext.broadcast(queries.numbers)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers, held, documents, words = shared.value, Counter(), 0, 0
        for batch in batches:
            for text in batch["text"]:
                found = terms_of(text)
                documents += bool(found)
                words += len(found)
                held.update(n for t in set(found) if (n := numbers.get(t)) is not None)
        yield pd.DataFrame({"term": [-1, *held], "n": [documents, *held.values()], "words": [words, *([0] * len(held))]})

    sums = (
        docs.select("text").mapInPandas(count, "term int, n bigint, words bigint")
        .groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).collect()
    )
    by_term = {r["term"]: r for r in sums}
    whole = by_term.pop(-1, Row(n=0, words=0))
    queries.weigh(whole["n"], whole["words"], {k: r["n"] for k, r in by_term.items()})
    return queries


@dataclass
class Segment:
    """Postings of some documents, numbered in the order of their ids; lists are cut by their ends."""

    ids: np.ndarray
    unnamed: np.ndarray
    terms: np.ndarray
    ends: np.ndarray
    docs: np.ndarray
    parts: np.ndarray
    pairs: np.ndarray
    pair_ends: np.ndarray
    pair_docs: np.ndarray
    pair_sums: np.ndarray

    @staticmethod
    def of(ids: list[int | None], found: list[tuple[int, int, int]], queries: Queries) -> Segment:
        """From each document's id and all (document, term, part of the impact) of them."""
        unnamed = np.array([i is None for i in ids], dtype=bool)
        named = np.array([0 if i is None else i for i in ids], dtype=np.int64)
        order = np.lexsort((named, unnamed))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        doc, term, part = (np.concatenate(c) for c in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
        doc = place[doc]
        by_term = np.lexsort((doc, term))
        doc, term, part = doc[by_term], term[by_term], part[by_term]
        terms, first = np.unique(term, return_index=True)
        ends = np.append(first, len(term))[1:]
        out = Segment(named[order], unnamed[order], terms, ends, doc, part, *[np.zeros(0, np.int64)] * 4)
        out._add_pairs(queries)
        return out

    def _add_pairs(self, queries: Queries) -> None:
        lists, pairs, ends, docs, sums = self.lists(queries.weights), [], [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in queries.pairs:
            if a not in lists or b not in lists:
                continue
            (few, one), (many, other) = sorted((lists[a], lists[b]), key=lambda x: len(x[0]))
            at = np.minimum(np.searchsorted(many, few), len(many) - 1)
            both = many[at] == few
            joint = one[both] + other[at[both]]
            best = np.argsort(-joint, kind="stable")
            pairs += [a, b]
            docs.append(few[both][best])
            sums.append(joint[best])
            ends.append(len(joint))
        self.pairs, self.pair_ends = np.array(pairs, np.int64), np.cumsum(ends, dtype=np.int64)
        self.pair_docs, self.pair_sums = np.concatenate(docs), np.concatenate(sums)

    def lists(self, weights: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Documents and impacts by term."""
        starts = np.append(0, self.ends[:-1]) if len(self.ends) else self.ends
        return {
            int(t): (self.docs[a:z], self.parts[a:z].astype(np.int64) * weights[t])
            for t, a, z in zip(self.terms, starts, self.ends)
        }

    def joint(self) -> dict[tuple[int, int], np.ndarray]:
        """Joint impacts by pair, greatest first."""
        starts = np.append(0, self.pair_ends[:-1]) if len(self.pair_ends) else self.pair_ends
        return {
            (int(a), int(b)): self.pair_sums[s:z]
            for a, b, s, z in zip(self.pairs[::2], self.pairs[1::2], starts, self.pair_ends)
        }

    def to_row(self) -> dict[str, bytes]:
        return {name: getattr(self, name).astype(kind).tobytes() for name, kind in _KINDS.items()}

    @staticmethod
    def from_row(row) -> Segment:
        return Segment(**{name: np.frombuffer(getattr(row, name), kind) for name, kind in _KINDS.items()})


def bounds(
    chain: list[int], greatest: dict[int, int], joint: dict[tuple[int, int], np.ndarray]
) -> list[int]:
    """What the terms from each place of the chain on can add to a score: the least sum over all ways
    to cut the rest of the chain into single terms and neighbouring pairs."""
    out = [0] * (len(chain) + 1)
    for k in range(len(chain) - 1, -1, -1):
        out[k] = greatest[chain[k]] + out[k + 1]
        sums = joint.get(tuple(chain[k : k + 2]))
        if sums is not None:
            pair = max(greatest[chain[k]], greatest[chain[k + 1]], int(sums[0]) if len(sums) else 0)
            out[k] = min(out[k], pair + out[k + 2])
    return out


def best_of(
    segment: Segment, lists: dict[int, tuple[np.ndarray, np.ndarray]], joint: dict[tuple[int, int], np.ndarray],
    greatest: dict[int, int], item: list[int], top: int, threshold: int, seen: Counter | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Document numbers and scores of the segment's best, best first.

    Documents that score below ``threshold`` may be left out. ``seen`` counts lists read whole and
    lists that were skipped but for candidates.
    """
    chain = [t for t in item if t in lists]
    for pair in zip(item, item[1:]):
        sums = joint.get(pair, ())
        if len(sums) >= top:
            threshold = max(threshold, int(sums[top - 1]))
    rest = bounds(chain, greatest, joint)
    total = np.zeros(len(segment.ids), np.int64)
    k = 0
    while k < len(chain) and rest[k] >= threshold:
        docs, impacts = lists[chain[k]]
        total[docs] += impacts
        k += 1
        known = total[total > 0]
        if len(known) >= top:
            threshold = max(threshold, int(np.partition(known, len(known) - top)[len(known) - top]))
    # Any other document has terms of the rest only, which add up to less than the threshold.
    left = np.flatnonzero(total)
    if seen is not None:
        seen.update(whole=k, skipped=len(chain) - k)
    for k in range(k, len(chain)):
        left = left[total[left] + rest[k] >= threshold]
        docs, impacts = lists[chain[k]]
        at = np.minimum(np.searchsorted(docs, left), len(docs) - 1)
        hit = docs[at] == left
        total[left[hit]] += impacts[at[hit]]
        if len(left) >= top:
            known = total[left]
            threshold = max(threshold, int(np.partition(known, len(known) - top)[len(known) - top]))
    left = left[total[left] >= max(1, threshold)]
    order = np.lexsort((left, -total[left]))[:top]
    return left[order], total[left[order]]


def build_index(docs: DataFrame, queries: Queries, postings: int = POSTINGS) -> DataFrame:
    """Segments of all rows (doc_id, text), with the postings of the terms asked for, one a row."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(queries)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = shared.value
        ids, found, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                words = terms_of(text)
                counts = [(n, tf) for t, tf in Counter(words).items() if (n := asked.numbers.get(t)) is not None]
                if not counts:
                    continue
                length = 10 + 90 * len(words) * asked.documents // asked.words
                term, tf = np.array(counts, dtype=np.int64).T
                part = 1_000_000_000 * tf // (1000 * tf + 8 * length)
                found.append((np.full(len(term), len(ids)), term, part))
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                held += len(term)
            if held >= postings:
                yield pd.DataFrame([Segment.of(ids, found, asked).to_row()])
                ids, found, held = [], [], 0
        if ids:
            yield pd.DataFrame([Segment.of(ids, found, asked).to_row()])

    # As text, since pandas would turn ids beside nulls into doubles.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInPandas(build, _SEGMENT)


def search(index: DataFrame, queries: Queries, top: int = TOP) -> DataFrame:
    """query (its number), doc_id and score: the best ``top`` documents of each query, with their rank."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = shared.value
        best: list[list[tuple[int, bool, int]]] = [[] for _ in asked.items]
        for batch in batches:
            for row in batch.itertuples():
                segment = Segment.from_row(row)
                lists, joint = segment.lists(asked.weights), segment.joint()
                greatest = {t: int(impacts.max()) for t, (_, impacts) in lists.items()}
                for k, item in enumerate(asked.items):
                    floor = -best[k][-1][0] if len(best[k]) == top else 1
                    docs, scores = best_of(segment, lists, joint, greatest, item, top, floor)
                    if len(docs):
                        new = zip((-scores).tolist(), segment.unnamed[docs].tolist(), segment.ids[docs].tolist())
                        best[k] = sorted([*best[k], *new])[:top]
        rows = [(k, None if unnamed else str(i), -s) for k, found in enumerate(best) for s, unnamed, i in found]
        yield pd.DataFrame(rows, columns=["query", "doc_id", "score"])

    found = index.mapInPandas(run, "query int, doc_id string, score bigint").withColumn(
        "doc_id", F.col("doc_id").cast("bigint")
    )
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS))
    for window in (Window.partitionBy("query", salt), Window.partitionBy("query")):
        found = found.withColumn("rank", F.row_number().over(window.orderBy(*order))).where(F.col("rank") <= top)
    return found


def _blocks(items: DataFrame, size: int) -> Iterator[list[Row]]:
    """Queries as rows of the driver, in blocks of about so many bytes of text."""
    block, held = [], 0
    for row in items.toLocalIterator():
        block.append(row)
        held += len(row["text"] or "")
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


def search_report(docs: DataFrame, items: DataFrame, top: int = TOP, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score of each item's best documents among all rows of ``docs``.

    Items are asked in blocks, each with two passes over the texts: one for the statistics, one
    that builds segments and searches them.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = items.schema["item_id"].dataType
    out = spark.createDataFrame([], StructType([
        StructField("item_id", kind), StructField("rank", spark.range(1).select(F.lit(1)).schema[0].dataType),
        StructField("doc_id", LongType()), StructField("score", LongType()),
    ]))
    for block in _blocks(items.select("item_id", F.col("text").cast("string").alias("text")), query_bytes):
        queries = measure(texts, Queries.of([r["text"] for r in block]))
        names = spark.createDataFrame(
            [(k, r["item_id"]) for k, r in enumerate(block)],
            StructType([StructField("query", out.schema["rank"].dataType), StructField("item_id", kind)]),
        )
        found = checkpointed(search(build_index(texts, queries), queries, top))
        out = out.unionByName(found.join(F.broadcast(names), "query").select(*out.columns))
    return out


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
counted AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_words FROM d WHERE len(terms) > 0),
tf AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, counted GROUP BY term, n_docs),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_words)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term), counted
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10"""
