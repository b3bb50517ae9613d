"""Exact duplicates by salted, content-checked combining; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tideline.llm.shared import BLANKS, attach, checkpointed, fresh, one_of_repeated, repeated_ids

SALTS = 16


def normalised(text: Column) -> Column:
    """The text without its white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _rank(length: Column, doc_id: Column) -> Column:
    """One number that orders rows of a group: longer first, then smaller id, null ids last.

    A decimal can be updated in place by a hash aggregate, a struct cannot.
    """
    whole = F.lit(str(2**65)).cast("decimal(20,0)")
    back = F.coalesce(F.lit(str(2**63)).cast("decimal(20,0)") - doc_id.cast("decimal(20,0)"), F.lit(0))
    return (length.cast("decimal(10,0)") * whole + back).cast("decimal(38,0)")


def _rank_id(rank: Column) -> Column:
    back = rank % F.lit(str(2**65)).cast("decimal(20,0)")
    return F.when(back > 0, (F.lit(str(2**63)).cast("decimal(20,0)") - back).cast("bigint"))


def _merged(rows: DataFrame, salts: int) -> DataFrame:
    """A row for each digest and content: the best rank and the number of rows.

    Tasks combine what they have read before they shuffle it (partial
    aggregation), salted digest groups are merged, then the winners of the salts.
    The content is part of the key at every stage.
    """
    salt = F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")
    by_salt = (
        rows.groupBy("digest", "content", salt.alias("salt"))
        .agg(F.max("rank").alias("rank"), F.count(F.lit(1)).alias("n"))
    )
    return (
        by_salt.repartition("digest")
        .groupBy("digest", "content")
        .agg(F.max("rank").alias("rank"), F.sum("n").alias("n"))
    )


def duplicate_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """The columns of ``docs`` and, of each row: its digest, the id that stays, the group's size.

    Texts are equal if they are identical without white space. Of equal texts the
    longest original stays, then the smallest id. A null text is an empty one. A
    null id loses against any id; if only null ids tie, ``keep_id`` is null.

    Added columns: ``digest`` (binary), ``keep_id``, ``group_size``, ``is_best``.
    Rows that share an id and a length within a group are all ``is_best``.
    """
    content = normalised(F.col(text))
    length = F.length(F.coalesce(F.col(text).cast("string"), F.lit("")))
    number = F.col(doc_id).cast("bigint")
    rows = docs.select(
        digest(content).alias("digest"),
        content.alias("content"),
        number.alias("id"),
        _rank(length, number).alias("rank"),
    )
    merged = _merged(rows, salts)
    groups = checkpointed(
        merged.groupBy("digest").agg(
            F.max("rank").alias("rank"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("contents")
        )
    )
    names = {n: fresh(docs, f"_{n}") for n in ("digest", "rank", "n", "own", "content")}
    marked = docs.withColumns(
        {names["digest"]: digest(content), names["own"]: _rank(length, number)}
    )

    def shown(found: DataFrame) -> DataFrame:
        rank, own = F.col(names["rank"]), F.col(names["own"])
        return found.select(
            *[F.col(c) for c in docs.columns],
            F.col(names["digest"]).alias(fresh(docs, "digest")),
            _rank_id(rank).alias(fresh(docs, "keep_id")),
            F.col(names["n"]).alias(fresh(docs, "group_size")),
            (own == rank).alias(fresh(docs, "is_best")),
        )

    one = groups.where("contents = 1").select(
        F.col("digest").alias(names["digest"]),
        F.col("rank").alias(names["rank"]),
        F.col("n").alias(names["n"]),
    )
    # A digest with one content identifies it, so the digest is enough to find the group again.
    several = groups.where("contents > 1").select(F.col("digest").alias(names["digest"]))
    if several.isEmpty():
        return shown(attach(marked, one, names["digest"], names["n"], [doc_id]))
    clean = marked.join(several, names["digest"], "left_anti")
    shared = marked.join(several, names["digest"], "left_semi").withColumn(names["content"], content)
    exact = merged.select(
        F.col("digest").alias(names["digest"]),
        F.col("content").alias(names["content"]),
        F.col("rank").alias(names["rank"]),
        F.col("n").alias(names["n"]),
    ).join(several, names["digest"], "left_semi")
    return shown(attach(clean, one, names["digest"], names["n"], [doc_id])).unionByName(
        shown(shared.join(exact, [names["digest"], names["content"]]))
    )


def duplicate_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """A row per document, dropped ones too: what stays, group size, whether it stays, digest.

    Of rows that agree in group, length and id exactly one is ``kept``.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = duplicate_groups(narrow, **how).select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("bigint").alias("group_size"),
        F.col("is_best").alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
    again = repeated_ids(narrow, "doc_id")
    if again is None:
        return found
    # Tied rows look alike here, so they are counted and laid out again, one of them kept.
    tied = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("kept")
    single = found.join(again, tied, "left_anti")
    alike = found.join(again, tied, "left_semi").groupBy(*found.columns).count()
    copies = alike.select(
        *[c for c in found.columns if c != "kept"],
        F.explode(F.expr("sequence(1L, count)")).alias("_copy"),
    ).withColumn("kept", F.col("_copy") == 1)
    return single.unionByName(copies.select(*found.columns))


def drop_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """The rows that stay, with the columns of ``docs``; one of each group.

    Of rows that agree in group, length and id any one stays.
    """
    found = duplicate_groups(docs, text, doc_id, **how)
    best, mark = found.columns[-1], found.columns[len(docs.columns)]
    kept = found.where(F.col(best))
    return one_of_repeated(kept, docs, doc_id, [mark]).select(*docs.columns)
