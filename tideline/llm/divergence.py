"""Source divergence audit: how a source's words differ from those of its language's other sources.

Each language keeps the terms of at least ``min_documents`` of its documents. Their sorted list
becomes a minimal acyclic transducer, cut into ranges of about ``RANGE_TERMS`` that are built apart;
whole texts are streamed through it to count terms by ordinal, and ordinals settle ties. A block of
ranges of at most ``BLOCK_BYTES`` is broadcast at a time; a language with more than one block is
streamed once for each.

Defined results: null texts, languages and sources count as empty ones; a group of texts without
terms has count 0 everywhere; a language without kept terms has pairs of value 0 and no terms; rows
that are repeated count each time; no rows give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline.llm.shared import checkpointed, small_batches
from tideline.llm.transducer import Shelf, Transducer, heads

MIN_DOCUMENTS, TOP_TERMS = 3, 200
SCALE = 1_000_000_000
#: Terms in one transducer, and bytes of transducers that are broadcast at once.
RANGE_TERMS, BLOCK_BYTES = 50_000, 64 * 1024 * 1024
#: Ordinals whose counts meet in one group, and counts that a task holds before it sends them on.
ORDINALS, HELD = 4_096, 1_000_000
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _grouped(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    as_text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    return docs.select(
        as_text(lang).alias("lang"), as_text(source).alias("source"), as_text(text).alias("text")
    )


class Tally:
    """Counts by key that come in pieces; merged whenever twice as many are held as after the last time."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held, self.limit = 0, HELD // 4

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > self.limit:
            self.merged()
            self.limit = max(HELD // 4, 2 * self.held)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, where = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.bincount(where, np.concatenate(self.counts), len(keys)).astype(np.int64)
        self.keys, self.counts, self.held = [keys], [counts], len(keys)
        return keys, counts


def _places(batch: pa.RecordBatch) -> dict[str, list[int]]:
    """Rows of each language, which is the first column."""
    out: dict[str, list[int]] = {}
    for i, lang in enumerate(batch.column(0).to_pylist()):
        out.setdefault(lang, []).append(i)
    return out


def kept_terms(grouped: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """lang and term for the terms of at least so many documents of the language."""
    small_batches(grouped.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short: dict[str, Tally] = {}
        long: dict[str, Counter] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang in {*short, *long}:
                numbers, n = short[lang].merged() if lang in short else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                spelt = numbers.astype(">u8").tobytes()
                terms = [spelt[i : i + 8].rstrip(b"\0") for i in range(0, len(spelt), 8)]
                more = long.get(lang, Counter())
                column = pa.array([*terms, *more], pa.binary()).cast(pa.string())
                counts = pa.array([*n.tolist(), *more.values()], pa.int64())
                yield pa.record_batch([pa.repeat(lang, len(column)), column, counts], ["lang", "term", "documents"])

        for batch in batches:
            for lang, places in _places(batch).items():
                texts = batch.column(1).take(pa.array(places)).to_pylist()
                data, begin, length, text = _terms_in(texts)
                fits, number = length <= 8, heads(data, begin, length)
                order = np.argsort(number[fits], kind="stable")
                number, holder = number[fits][order], text[fits][order]
                # The texts are in order, so a term's repeats within a text are neighbours.
                again = (number[1:] == number[:-1]) & (holder[1:] == holder[:-1])
                short.setdefault(lang, Tally()).add(*np.unique(number[np.append(True, ~again)[: len(number)]], return_counts=True))
                whole = data.tobytes()
                found = {(int(t), whole[b : b + n]) for t, b, n in zip(text[~fits], begin[~fits], length[~fits])}
                long.setdefault(lang, Counter()).update(term for _, term in found)
            if sum(t.held for t in short.values()) + sum(map(len, long.values())) > HELD:
                yield from rows()
                short, long = {}, {}
        yield from rows()

    return (
        grouped.select("lang", "text").mapInArrow(count, "lang string, term string, documents bigint")
        .groupBy("lang", "term").agg(F.sum("documents").alias("documents"))
        .where(F.col("documents") >= min_documents).select("lang", "term")
    )


def _number(term: bytes) -> int:
    return int.from_bytes(term[:8].ljust(8, b"\0"), "big")


@dataclass(frozen=True)
class Range:
    """One transducer, by what the driver knows of it."""

    lang: str
    part: int
    first: int
    base: int
    terms: int
    size: int


@dataclass
class Vocabulary:
    """Stored transducers (lang, part, machine) and the list of their ranges, in blocks."""

    machines: DataFrame
    blocks: list[list[Range]]
    terms: dict[str, int]  # of each language

    def shelves(self, block: list[Range]) -> dict[str, Shelf]:
        """The transducers of a block, at most BLOCK_BYTES unless it is a single one."""
        wanted = self.machines.where(F.col("part").isin([r.part for r in block])).select("part", "machine")
        found = {r["part"]: bytes(r["machine"]) for r in wanted.collect()}
        out: dict[str, list] = {}
        for r in block:
            out.setdefault(r.lang, []).append((r.first, r.base, Transducer.from_bytes(found[r.part])))
        return {lang: Shelf.of(parts) for lang, parts in out.items()}


def build_vocabulary(
    terms: DataFrame, range_terms: int = RANGE_TERMS, block_bytes: int = BLOCK_BYTES
) -> Vocabulary:
    """Transducers of stored rows (lang, term), a range of terms of a language each."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lang, held = None, []
        for batch in batches:
            for name, term in zip(batch["lang"], batch["term"], strict=True):
                if held and name != lang:
                    yield row(lang, held)
                    held = []
                lang = name
                held.append(term.encode())
        if held:
            yield row(lang, held)

    def row(lang: str, held: list[bytes]) -> pd.DataFrame:
        machine = Transducer.of(held).to_bytes()
        return pd.DataFrame({
            "lang": [lang], "first": [str(_number(held[0]))], "terms": [len(held)], "machine": [machine],
        })

    parts = max(1, math.ceil(terms.count() / range_terms))
    # Terms that agree in their first eight bytes stay in one range.
    head = F.substring(F.col("term").cast("binary"), 1, 8)
    machines = checkpointed(
        terms.repartitionByRange(parts, "lang", head).sortWithinPartitions("lang", "term")
        .mapInPandas(build, "lang string, first string, terms bigint, machine binary")
        .withColumn("part", F.monotonically_increasing_id())
    )
    # A few numbers a range: one row for about 50,000 terms.
    listed = machines.select("lang", "part", "first", "terms", F.length("machine").alias("size")).collect()
    blocks: list[list[Range]] = []
    totals: dict[str, int] = {}
    size = 0
    for r in sorted(listed, key=lambda r: (r["lang"], int(r["first"]))):
        item = Range(r["lang"], r["part"], int(r["first"]), totals.get(r["lang"], 0), r["terms"], r["size"])
        totals[r["lang"]] = item.base + item.terms
        if not blocks or size + item.size > block_bytes:
            blocks.append([])
            size = 0
        blocks[-1].append(item)
        size += item.size
    return Vocabulary(machines, blocks, totals)


def _terms_in(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes of the texts, begin and length of each term, and the text it is in."""
    encoded = [t.encode("utf-8", "surrogatepass").translate(_FOLD) for t in texts]
    data = np.frombuffer(b"\0".join(encoded) + b"\0", np.uint8)
    inside = ((data >= 0x80) | ((data >= 97) & (data <= 122))).view(np.int8)
    edges = np.flatnonzero(np.diff(inside, prepend=np.int8(0)))
    begin, length = edges[::2], edges[1::2] - edges[::2]
    ends = np.cumsum([len(e) + 1 for e in encoded])
    return data, begin, length, np.searchsorted(ends, begin, "right")


def _ordinals(shelf: Shelf, data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """As ``shelf.ordinals``; a short term that the texts repeat goes through once."""
    out = np.empty(len(begin), np.int64)
    fits = length <= 8
    _, first, where = np.unique(heads(data, begin, length)[fits], return_index=True, return_inverse=True)
    out[fits] = shelf.ordinals(data, begin[fits][first], length[fits][first])[where]
    out[~fits] = shelf.ordinals(data, begin[~fits], length[~fits])
    return out


def count_terms(grouped: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """lang, source, ordinal and count, from whole texts streamed through the transducers."""
    spark = grouped.sparkSession
    small_batches(spark)
    out = None
    for block in vocabulary.blocks:
        shared = spark.sparkContext.broadcast(vocabulary.shelves(block))
        langs = sorted({r.lang for r in block})

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names: dict[tuple[str, str], int] = {}
            tally = Tally()

            def rows() -> pa.RecordBatch:
                keys, counts = tally.merged()
                group, ordinal = keys >> 40, keys & ((1 << 40) - 1)
                lists = [pa.array([n[i] for n in names], pa.string()) for i in (0, 1)]
                return pa.record_batch(
                    [*(a.take(pa.array(group)) for a in lists), pa.array(ordinal), pa.array(counts)],
                    ["lang", "source", "ordinal", "n"],
                )

            for batch in batches:
                sources = batch.column(1).to_pylist()
                for lang, places in _places(batch).items():
                    data, begin, length, text = _terms_in(batch.column(2).take(pa.array(places)).to_pylist())
                    ordinal = _ordinals(shared.value[lang], data, begin, length)
                    group = np.array([names.setdefault((lang, sources[i]), len(names)) for i in places])
                    known = ordinal >= 0
                    tally.add(*np.unique((group[text[known]] << 40) | ordinal[known], return_counts=True))
                if tally.held > HELD:
                    yield rows()
                    names, tally = {}, Tally()
            if tally.held:
                yield rows()

        part = grouped.where(F.col("lang").isin(langs)).select("lang", "source", "text").mapInArrow(
            count, "lang string, source string, ordinal bigint, n bigint"
        )
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "lang string, source string, ordinal bigint, n bigint")
    return out.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), in decimals so that nothing overflows."""
    whole = lambda c: c.cast("decimal(19,0)")
    return F.when(total + terms > 0, F.lit(1).cast("bigint") + F.call_function(
        "div", (whole(count) + 1) * F.lit(SCALE).cast("decimal(10,0)"), whole(total) + whole(terms)
    ))


def _pair_sums(frame: pd.DataFrame) -> pd.DataFrame:
    """Sums of floor((p - q)^2 / q) over the terms of one group of ordinals, by pair of sources.

    Rows without an ordinal hold each source's p of a count of 0. In 64 bits: p is at most SCALE + 1,
    and all p of a source sum to at most SCALE and one for each term.
    """
    base = frame[frame["ordinal"] < 0].sort_values("source")
    found = frame[frame["ordinal"] >= 0]
    sources = base["source"].to_numpy()
    column = pd.Index(sources).get_indexer(found["source"])
    ordinals, line = np.unique(found["ordinal"].to_numpy(), return_inverse=True)
    at_once = max(1, 2_000_000 // len(sources))
    sums = np.zeros((len(sources), len(sources)), np.int64)
    for low in range(0, len(ordinals), at_once):
        here = (line >= low) & (line < low + at_once)
        share = np.tile(base["p"].to_numpy(np.int64), (min(at_once, len(ordinals) - low), 1))
        share[line[here] - low, column[here]] = found["p"].to_numpy(np.int64)[here]
        for g in range(len(sources)):
            apart = share[:, g : g + 1] - share
            sums[g] += (apart * apart // share).sum(axis=0)
    own, other = (a.ravel() for a in np.indices(sums.shape))
    out = pd.DataFrame({
        "lang": frame["lang"].iloc[0], "source": sources[own], "item": sources[other], "value": sums.ravel(),
    })
    return out[own != other]


def divergence_report(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS,
    range_terms: int = RANGE_TERMS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank within source and part."""
    spark = docs.sparkSession
    grouped = _grouped(docs, text, lang, source)
    vocabulary = build_vocabulary(
        checkpointed(kept_terms(grouped, min_documents)), range_terms, block_bytes
    )
    counts = checkpointed(count_terms(grouped, vocabulary))
    kept = spark.createDataFrame(list(vocabulary.terms.items()), "lang string, terms bigint")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = checkpointed(
        grouped.select("lang", "source").distinct()
        .join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
        .select("lang", "source", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("total", "terms")])
    )
    shares = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "ordinal", "n", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p")
    )

    # Pairs: each group of ordinals meets all sources of its language.
    blocks = F.floor(F.col("ordinal") / ORDINALS).cast("bigint")
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("terms") - 1) / ORDINALS).cast("bigint")))
    bases = groups.where("terms > 0").select(
        "lang", "source", F.lit(-1).cast("bigint").alias("ordinal"),
        _share(F.lit(0), F.col("total"), F.col("terms")).alias("p"), each.alias("block"),
    )
    sums = (
        shares.select("lang", "source", "ordinal", "p", blocks.alias("block")).unionByName(bases)
        .groupBy("lang", "block").applyInPandas(_pair_sums, "lang string, source string, item string, value bigint")
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    )
    others = groups.select("lang", F.col("source").alias("item"))
    pairs = (
        groups.select("lang", "source").join(others, "lang").where("source <> item")
        .join(sums, ["lang", "source", "item"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(by_value))

    # Terms: a source's share of each against the language's.
    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("terms").alias("terms"))
    of_lang = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n")).join(whole, "lang").select(
        "lang", "ordinal", _share(F.col("n"), F.col("total"), F.col("terms")).alias("q")
    )
    wide = (F.col("p") - F.col("q")).cast("decimal(19,0)")
    value = F.call_function("div", wide * wide, F.col("q").cast("decimal(19,0)"))
    by_term = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = checkpointed(
        shares.join(of_lang, ["lang", "ordinal"]).where("p > q")
        .select("lang", "source", "ordinal", value.alias("value"))
        .withColumn("rank", F.row_number().over(by_term)).where(F.col("rank") <= top)
    )
    return ranked.unionByName(spell(best, vocabulary))


def spell(best: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows (lang, source, ordinal, value, rank) with the term of each ordinal as ``item``."""
    spark = best.sparkSession
    schema = "lang string, source string, part string, item string, value bigint, rank int"
    out = spark.createDataFrame([], schema)
    for block in vocabulary.blocks:
        shared = spark.sparkContext.broadcast(vocabulary.shelves(block))
        within = F.lit(False)
        for r in block:
            end = r.base + r.terms
            within = within | ((F.col("lang") == r.lang) & (F.col("ordinal") >= r.base) & (F.col("ordinal") < end))

        def spelt(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for batch in batches:
                items = [shared.value[k].term(o).decode() for k, o in zip(batch["lang"], batch["ordinal"], strict=True)]
                yield batch.assign(part="term", item=items)[["lang", "source", "part", "item", "value", "rank"]]

        out = out.unionByName(best.where(within).mapInPandas(spelt, schema))
    return out


SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d)
  GROUP BY lang, term HAVING count(*) >= 3),
langs AS (SELECT lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept k USING (lang) GROUP BY lang),
occurring AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM d)
              JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, v, CAST(coalesce(sum(n), 0) AS BIGINT) AS total
  FROM (SELECT DISTINCT lang, source FROM d) g JOIN langs USING (lang) LEFT JOIN occurring o USING (lang, source)
  GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
         1 + (1000000000 * (coalesce(n, 0) + 1)) // (total + v) AS p
  FROM groups g JOIN kept k USING (lang) LEFT JOIN occurring o USING (lang, source, term)),
whole AS (
  SELECT lang, term, 1 + (1000000000 * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v) AS q
  FROM (SELECT lang, term, CAST(sum(n) AS BIGINT) AS n FROM occurring GROUP BY ALL) JOIN langs USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(sum(value), 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, ((x.p - y.p) * (x.p - y.p)) // y.p AS value
    FROM dense x JOIN dense y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source) s
    ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  GROUP BY ALL),
terms AS (
  SELECT d.lang, source, term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value
  FROM dense d JOIN whole w USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
FROM terms QUALIFY rank <= 200"""
