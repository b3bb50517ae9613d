"""SimHash near-duplicates found by deletion-variant signatures.

Fingerprints of 64 bits link at LINK = 4 or fewer differing bits. Cut into three segments, two
linked fingerprints differ by at most one bit in one of them (4 < 2 * 3). A segment with one bit
deleted is a signature: segments that differ in that bit at most share it. Fingerprints that
share a signature are compared; nothing else can be linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tideline.llm.shared import attach, checkpointed, fresh, repeated_ids, small_batches, stored

WORDS, LINK, SEED = 4, 4, 42
#: A signature that more fingerprints may share gets a second signature from the other bits.
BUCKET = 4096
#: Up to so many fingerprints of a signature are compared pair by pair, more by a search.
SMALL = 32
#: Rows compared at a time.
PAIR_ROWS = 65_536
#: Busy signatures are broadcast up to this number (of 8 bytes each), else joined by shuffle.
BROADCAST_ROWS = 100_000


def fingerprint_of(text: str | None, words: int = WORDS) -> int:
    """Majority of the bits of the shingles' XXH64; 0 without a word. Only A-Z are lower-cased."""
    import xxhash

    parts = (text or "").encode().lower().split()  # bytes: ASCII case and white space only
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        shingles = map(b" ".join, zip(*[parts[i:] for i in range(words)], strict=False))
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.fromiter((digest(s, seed) for s in shingles), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        block = hashes[at : at + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint(text: Column) -> Column:
    """The fingerprint as a bigint with the same bits."""

    @F.pandas_udf("bigint")
    def run(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint_of(t) for t in texts), dtype="<u8", count=len(texts))
        return pd.Series(found.view("<i8"))

    return run(text)


def _cut(bits: list[int], parts: int) -> list[list[int]]:
    return [list(map(int, p)) for p in np.array_split(np.array(bits), parts)]


SEGMENTS = _cut(list(range(64)), LINK // 2 + 1)


def _value(bits: list[int]) -> Column:
    """The run of bits, as a number of its own."""
    mask = F.lit((1 << len(bits)) - 1).cast("bigint")
    return F.shiftrightunsigned("fp", bits[0]).bitwiseAND(mask)


def _without(value: Column, place: int, width: int) -> Column:
    return value.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << place)).cast("bigint"))


def _signature(bit: int, masked: Column) -> Column:
    return masked.bitwiseOR(F.lit(bit << 22).cast("bigint"))


def signatures(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(key, fp): 64 rows for each fingerprint, more where many share a signature.

    A signature can only be shared by more than ``bucket`` fingerprints if one of the two segment
    values behind it has more than half as many; those are counted (three rows for each
    fingerprint, combined before the shuffle). Under a busy signature the bits outside the
    segment are treated in the same way: three segments, one bit deleted, one more signature.
    """
    first = F.array(
        *[
            F.struct(_signature(b, _without(_value(bits), i, len(bits))).alias("key"), F.lit(s).alias("seg"))
            for s, bits in enumerate(SEGMENTS)
            for i, b in enumerate(bits)
        ]
    )
    plain = fps.select("fp", F.explode(first).alias("k")).select("k.key", "k.seg", "fp")
    values = F.array(
        *[F.struct(F.lit(s).alias("seg"), _value(bits).alias("value")) for s, bits in enumerate(SEGMENTS)]
    )
    counts = fps.select(F.explode(values).alias("v")).groupBy("v").count().where(F.col("count") > bucket / 2)
    busy_keys = F.expr(
        "CASE v.seg "
        + " ".join(
            f"WHEN {s} THEN array("
            + ", ".join(f"(v.value & {((1 << len(bits)) - 1) & ~(1 << i)}L) | {b << 22}L" for i, b in enumerate(bits))
            + ")"
            for s, bits in enumerate(SEGMENTS)
        )
        + " END"
    )
    busy = checkpointed(counts.select(F.explode(busy_keys).alias("key")).distinct())
    if busy.isEmpty():
        return plain.select("key", "fp")
    busy = F.broadcast(busy) if busy.count() <= BROADCAST_ROWS else busy
    second = F.lit(None).cast("array<bigint>")
    for s, bits in enumerate(SEGMENTS):
        left = [b for b in range(64) if b not in bits]
        keys = []
        for part in _cut(left, LINK // 2 + 1):
            value, width = _packed(_runs(part)), len(part)
            for i in range(width):
                keys.append(
                    F.shiftleft(F.col("key"), 22)
                    .bitwiseOR(F.lit((1 << 62) | (part[i] << 16)).cast("bigint"))
                    .bitwiseOR(_without(value, i, width))
                )
        second = F.when(F.col("seg") == s, F.array(*keys)).otherwise(second)
    return (
        plain.join(busy, "key", "left_anti").select("key", "fp")
        .unionByName(plain.join(busy, "key", "left_semi").select(F.explode(second).alias("key"), "fp"))
    )


def _runs(bits: list[int]) -> list[list[int]]:
    """Neighbouring bits together."""
    out: list[list[int]] = []
    for b in bits:
        if out and out[-1][-1] == b - 1:
            out[-1].append(b)
        else:
            out.append([b])
    return out


def _packed(runs: list[list[int]]) -> Column:
    """The bits of several runs side by side."""
    out, at = F.lit(0).cast("bigint"), 0
    for run in runs:
        out = out.bitwiseOR(F.shiftleft(_value(run), at))
        at += len(run)
    return out


def _pairs(keys: np.ndarray, fps: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links within runs of equal keys: all in small runs, enough to connect them in others."""
    edges = np.flatnonzero(np.diff(keys)) + 1
    starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(keys)]])
    out, sizes = [], ends - starts
    until = np.repeat(np.where(sizes <= SMALL, ends, starts), sizes)
    left = np.arange(len(keys))
    for apart in range(1, SMALL):
        left = left[left + apart < until[left]]
        if not len(left):
            break
        a, b = fps[left], fps[left + apart]
        near = np.bitwise_count(a ^ b) <= most
        out.append((a[near], b[near]))
    for k in np.flatnonzero(sizes > SMALL):
        open_ = fps[starts[k] : ends[k]]
        reached = open_[:0]
        while len(open_) or len(reached):
            if not len(reached):
                reached, open_ = open_[:1], open_[1:]
            at, reached = reached[0], reached[1:]
            near = np.bitwise_count(open_ ^ at) <= most
            found = open_[near]
            if len(found):
                out.append((np.full(len(found), at), found))
                reached, open_ = np.concatenate([reached, found]), open_[~near]
    return out


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints within LINK bits that connect all that are linked.

    Under each signature a few fingerprints give all their links; many give a tree for each of
    their components, found by a search, so the rows made grow with the members, not with pairs.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, waiting, rows = np.zeros(0, np.int64), np.zeros(0, np.uint64), [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                waiting.append(batch)
                rows += batch.num_rows
                if rows < PAIR_ROWS:
                    continue
            if waiting:
                keys = np.concatenate([keys, *[b.column(0).to_numpy() for b in waiting]])
                fps = np.concatenate([fps, *[b.column(1).to_numpy().view(np.uint64) for b in waiting]])
            waiting, rows = [], 0
            if not len(keys):
                continue
            # The last run may go on, unless all has come.
            until = len(keys) if batch is None else np.searchsorted(keys, keys[-1])
            for a, b in _pairs(keys[:until], fps[:until], LINK) if until else []:
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
            keys, fps = keys[until:], fps[until:]

    near = (
        signatures(fps, bucket)
        .repartition("key")
        .sortWithinPartitions("key", "fp")
        .mapInArrow(compare, "a bigint, b bigint")
    )
    return near.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _with_least(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows`` (a, b) with ``m``, the smallest of ``a`` and its neighbours in ``edges`` (a, b).

    A node with many neighbours, such as the root of a large group, is not left to one task.
    """
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("_size"))
    return attach(rows, stored(least, "least"), "a", "_size", ["b"])


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for nodes of pairs (a > b), the root being the smallest node reachable.

    Alternates two steps until nothing changes: each node hands its larger neighbours to its
    smallest one, then its smaller neighbours and itself. Both need one minimum per node.
    """
    edges = stored(pairs.select("a", "b"), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both.where("b > a"), both).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), "links")
        met = _with_least(large, large)
        small = (
            met.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(large.groupBy("a").agg(F.min("b").alias("b")))
        )
        edges = stored(small.distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def fingerprint_groups(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """A row for each fingerprint of stored (doc_id, fp) rows: its component's smallest doc_id,
    the fingerprint that row has, and the number of rows with this fingerprint.

    Null ids come after all others.
    """
    own = checkpointed(
        prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    )
    found = components(links(own.select("fp"), bucket)).withColumnRenamed("node", "fp")
    rooted = checkpointed(
        own.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    )
    order = F.struct(F.col("first").isNull().alias("none"), F.col("first").alias("id"), F.col("fp").alias("fp"))
    best = checkpointed(
        rooted.groupBy("root").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("size"))
    )
    return checkpointed(
        attach(rooted, best, "root", "size", ["fp"]).select(
            "fp", F.col("best.id").alias("component_id"), F.col("best.fp").alias("best_fp"), "n"
        )
    )


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", bucket: int = BUCKET
) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable over links) for every row.

    A null text has no words: fingerprint 0, linked like any other.
    """
    small_batches(docs.sparkSession)
    prints = checkpointed(
        docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text)).alias("fp"))
    )
    groups = fingerprint_groups(prints, bucket).drop("best_fp")
    return attach(prints, groups, "fp", "n", ["doc_id"]).select("doc_id", "fp", "component_id")


def drop_near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", bucket: int = BUCKET
) -> DataFrame:
    """One row of each component, the one with the smallest id, with the columns of ``docs``."""
    small_batches(docs.sparkSession)
    prints = checkpointed(
        docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text)).alias("fp"))
    )
    groups = fingerprint_groups(prints, bucket)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("best_fp"))
    lost = attach(prints, groups, "fp", "n", ["doc_id"]).where(~stays).select(F.col("doc_id").alias("_lost"))
    again = repeated_ids(docs, doc_id)
    if again is None:
        # The id tells the row, so texts are hashed once and only ids decide.
        return docs.join(lost, F.col(doc_id).eqNullSafe(F.col("_lost")), "left_anti")
    shared = F.col(doc_id).eqNullSafe(F.col("_id"))
    single = docs.join(again, shared, "left_anti")
    single = single.join(lost, F.col(doc_id).eqNullSafe(F.col("_lost")), "left_anti")
    # Rows that share an id are told apart by their fingerprints.
    fp, size = fresh(docs, "_fp"), fresh(docs, "_n")
    best, best_fp = fresh(docs, "_best"), fresh(docs, "_best_fp")
    named = groups.select(
        F.col("fp").alias(fp), F.col("component_id").alias(best),
        F.col("best_fp").alias(best_fp), F.col("n").alias(size),
    )
    marked = docs.join(again, shared, "left_semi").withColumn(fp, fingerprint(F.col(text)))
    kept = attach(marked, named, fp, size, [doc_id]).where(
        F.col(doc_id).eqNullSafe(F.col(best)) & (F.col(fp) == F.col(best_fp))
    )
    return single.unionByName(kept.dropDuplicates([doc_id, fp]).select(*docs.columns))


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
