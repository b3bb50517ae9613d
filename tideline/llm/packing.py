"""Packing by power-of-two decomposition: no sequence crosses documents, none is padded."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tideline.llm.bpe import encode_documents

SEQUENCE = 2048
END_ID = 1


def decompose(ids: DataFrame, longest: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Cuts documents (``doc_id``, ``ids`` as little-endian bytes) into pieces of 2**k ids.

    ``end_id`` closes each document. Its length is written as a sum of powers of two, as many
    times ``longest`` (a power of two) as fit, then each smaller power at most once, in falling
    order. A piece is a sequence of its own, so it needs no padding and no other document; pieces
    of equal length share a ``bucket`` (k). ``sequence_id`` is unique, without a meaning.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    steps = longest.bit_length() - 1
    end = F.lit(end_id.to_bytes(4, "little"))
    whole = F.concat("ids", end)
    tokens = F.expr("length(ids) div 4 + 1")
    full = F.expr(f"n div {longest}")
    rest = F.expr(f"n % {longest}")
    fulls = F.when(
        full > 0,
        F.transform(
            F.sequence(F.lit(0), (full - 1).cast("int")),
            lambda i: F.struct((i * longest).cast("bigint").alias("start"), F.lit(steps).alias("bucket")),
        ),
    ).otherwise(F.array().cast("array<struct<start:bigint,bucket:int>>"))
    # A power in the rest starts after all larger powers.
    bits = F.array(
        *[
            F.when(
                F.expr(f"(n & {1 << k}) != 0"),
                F.struct((F.col("n") - (rest % (2 << k))).cast("bigint").alias("start"), F.lit(k).alias("bucket")),
            )
            for k in reversed(range(steps))
        ]
    ) if steps else F.array().cast("array<struct<start:bigint,bucket:int>>")
    pieces = (
        ids.select("doc_id", whole.alias("ids"), tokens.cast("bigint").alias("n"))
        .select("doc_id", "ids", "n", F.explode(F.concat(fulls, F.array_compact(bits))).alias("piece"))
    )
    start, length = F.col("piece.start"), F.expr("shiftleft(1L, piece.bucket)")
    return pieces.select(
        "doc_id",
        start.alias("start"),
        length.alias("length"),
        F.substring("ids", (start * 4 + 1).cast("int"), (length * 4).cast("int")).alias("piece_ids"),
        F.col("n").alias("doc_tokens"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
        F.col("piece.bucket").alias("bucket"),
    )


def pack_documents(docs: DataFrame, path: str, longest: int = SEQUENCE) -> DataFrame:
    """Encodes whole documents (null: empty) and decomposes them; see ``decompose``."""
    return decompose(encode_documents(docs, path), longest)


def write_buckets(pieces: DataFrame, folder: str) -> None:
    """One folder per length, so that a reader gets batches without padding."""
    pieces.write.partitionBy("bucket").parquet(folder)


def packing_report(docs: DataFrame, path: str) -> DataFrame:
    pieces = pack_documents(docs, path)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("piece_ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "bucket",
    )
