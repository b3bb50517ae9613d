"""Mixing sources to target weights by weighted fair queueing; DataFrame functions only.

Each source sends its documents in shuffled order, again and again. A copy's virtual finish time is
the number of words its source has sent by its end, divided by the source's target; so all sources
reach their targets at time 1. All copies are range-sorted by finish time and taken until the total
budget is used up. A source may hold any share of the rows: running sums go by range partitions,
never by one task for a source.

Defined results: a null text has size 0; a source without words has target 0; a document of size 0
is taken 0 times; a null source is a source of its own, the last one; rows that agree in id, source
and size are interchangeable, so repeated rows have one multiset of results; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline.llm.shared import attach, checkpointed, fresh

WEIGHTS = (3, 1, 2)
#: Words to mix, as a share of all words; no source is repeated more often than REPEATS.
SHARE, REPEATS = 1.5, 2
WORD = "[^\\x20\\x09-\\x0D]+"


def running(df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    """``df`` with running totals, each row's own value included, over all rows in ``order``.

    Rows are cut into ranges of the order; totals of ranges (one row a shuffle partition) give what
    lies before each. Ranges are stored before anything refers to them, as their bounds are sampled.
    """
    part = fresh(df, "_part")
    values = {fresh(df, f"_value_{name}"): value for name, value in sums.items()}
    placed = checkpointed(
        df.withColumns(values).repartitionByRange(*order).withColumn(part, F.spark_partition_id())
    )
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(part).agg(*[F.sum(v).alias(v) for v in values]).select(
        part, *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_before_{n}") for n, v in zip(sums, values)]
    )
    here = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(F.broadcast(offsets), part).select(
        *df.columns,
        *[(F.col(f"_before_{n}") + F.sum(v).over(here)).alias(n) for n, v in zip(sums, values)],
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """Position, weight, target and ``start`` (words of the sources before) of each source.

    From rows (source, source_size). The targets are proportional to the weights, except where that
    is over ``repeats`` times a source's size: level = (budget - the full sources' limits) / (weights
    of the others), for the set of full sources that makes it largest.
    """
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("position") - 1, F.lit(len(weights))) + 1).cast("int")
    )
    by_name = running(
        sizes, [F.col("source").asc_nulls_last()],
        {"position": F.lit(1).cast("bigint"), "words": F.col("source_size")},
    ).select(
        "source", "source_size", "position", (F.col("words") - F.col("source_size")).alias("start"),
        weight.cast("bigint").alias("weight"), (F.col("source_size") * repeats).alias("limit"),
    )
    filling = checkpointed(running(
        by_name, [F.col("limit") / F.col("weight"), F.col("position")],
        {"limits": F.col("limit"), "weights": F.col("weight")},
    ))
    total = filling.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    full, others = F.col("limits") - F.col("limit"), total.weights - (F.col("weights") - F.col("weight"))
    level = 0.0
    if total.words:
        level = filling.agg(F.max((F.lit(share * total.words) - full) / others)).first()[0]
    target = F.least(F.col("limit").cast("double"), F.lit(level) * F.col("weight"))
    return filling.select("source", "source_size", "position", "start", "weight", target.alias("target"))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
) -> DataFrame:
    """doc_id, source, size, source_size, target and ``taken``: words of the document in the mix.

    A document is taken whole, up to ``repeats`` times. The order is a hash of the id, so the same
    table gives the same mix however it is stored.
    """
    # Narrow rows from here on: texts are read once, for their word counts.
    sized = checkpointed(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    ))
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    targets = source_targets(by_source.drop("rows"), weights, share, repeats)
    named = lambda df: df.withColumn(
        "name", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))
    )
    groups = checkpointed(named(
        targets.join(by_source.select(F.col("source").alias("_s"), "rows"), F.col("source").eqNullSafe(F.col("_s")))
    ).select("name", "rows", "source_size", "position", "start", "target"))
    shuffle = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 15), 16, 10).cast("bigint")
    rows = attach(named(sized).withColumn("shuffle", shuffle), groups, "name", "rows", ["doc_id", "size"])
    queued = checkpointed(running(
        rows, [F.col(c) for c in ("position", "shuffle", "doc_id", "size")], {"sent": F.col("size")}
    ).withColumn("sent", F.col("sent") - F.col("start")))

    place = ("finish", "position", "round", "sent")

    def copy(number: Column) -> Column:
        """Where in the queue a copy stands."""
        finish = (number * F.col("source_size") + F.col("sent")) / F.col("target")
        return F.struct(finish.alias("finish"), "position", number.alias("round"), "sent")

    each = F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), lambda k: copy(k.cast("bigint")))
    copies = queued.where("size > 0").select("size", F.inline(each))
    budget = share * (by_source.agg(F.sum("source_size")).first()[0] or 0)
    last = running(copies, [F.col(c) for c in place], {"total": F.col("size")}).where(
        F.col("total") <= budget
    ).agg(F.max(F.struct(*place))).first()[0]
    times = F.lit(0)
    if last is not None:
        # The queue is a total order, so its last taken copy tells for each whether it is taken.
        cut = F.struct(*[F.lit(last[c]).alias(c) for c in place])
        for k in range(repeats):
            times = times + F.when(copy(F.lit(k).cast("bigint")) <= cut, 1).otherwise(0)
    taken = F.when(F.col("size") > 0, F.col("size") * times).otherwise(F.lit(0)).cast("bigint")
    return queued.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mixing_report(docs: DataFrame) -> DataFrame:
    """The mix of all documents, as the query's contract names its columns."""
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS shuffle
  FROM documents),
named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS position
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST([3, 1, 2][CAST((position - 1) % 3 + 1 AS INTEGER)] AS BIGINT) AS weight, source_size * 2 AS room FROM named),
filling AS (
  SELECT *, coalesce(sum(room) OVER w, 0) AS full_room, coalesce(sum(weight) OVER w, 0) AS full_weight
  FROM weighed
  WINDOW w AS (ORDER BY CAST(room AS DOUBLE) / weight, position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT max((1.5::DOUBLE * CAST(words AS DOUBLE) - CAST(full_room AS DOUBLE)) / CAST(weights - full_weight AS DOUBLE)) AS level
  FROM filling, (SELECT sum(source_size) AS words, sum(weight) AS weights FROM weighed)),
targets AS (
  SELECT source, source_size, position, least(CAST(room AS DOUBLE), level * weight) AS target FROM filling, level),
queued AS (
  SELECT s.*, source_size, position, target,
         sum(size) OVER (PARTITION BY position ORDER BY shuffle, doc_id, size ROWS UNBOUNDED PRECEDING) AS sent
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT doc_id, size, position, round, sent,
         CAST(round * source_size + sent AS DOUBLE) / target AS finish
  FROM queued, (VALUES (0), (1)) AS r(round) WHERE size > 0),
summed AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY finish, position, round, sent ROWS UNBOUNDED PRECEDING) AS total
  FROM copies),
taken AS (
  SELECT doc_id, sum(size) AS taken FROM summed
  WHERE total <= (SELECT 1.5::DOUBLE * sum(size) FROM sized) GROUP BY doc_id)
SELECT q.doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN taken USING (doc_id)"""
