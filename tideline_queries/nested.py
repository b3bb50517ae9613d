"""Flattening: nested columns made from each row of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline import ColumnSpec, flatten, infer_event_schema, malformed_lines, read_events_json
from tideline.session import new_folder
from tideline_queries.inputs import events, read, shown


def _charges() -> Column:
    """The charges of a line that are not zero, as an array of structs."""
    both = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.col(f"l_{kind}").alias("amount"))
            for kind in ("discount", "tax")
        ]
    )
    return F.filter(both, lambda charge: charge["amount"] > 0)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.struct(F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line")).alias("at"),
        F.to_date("l_shipdate").cast("string").alias("shipped"),
        _charges().alias("charges"),
    )


def flatten_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = read(spark, sf_dir, "events").select(
        "event_id",
        F.struct("event_type", F.struct("value").alias("measure")).alias("detail"),
        F.from_json("props", "k int").alias("props"),
    )
    return flatten(nested)


def flatten_array_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(_lines(spark, sf_dir))


def flatten_array_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(_lines(spark, sf_dir), outer=True)


def flatten_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten(read(spark, sf_dir, "embeddings"))
    return flat.withColumn("embedding", F.col("embedding").cast("double"))


def flatten_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(F.split(line, " ").alias("word")))
    nested = read(spark, sf_dir, "conversations").select(
        F.struct("conv_id", "turn").alias("at"), "role", lines.alias("lines")
    )
    return flatten(nested)


def flatten_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.array("o_orderstatus", "o_orderpriority").alias("label"),
        F.array(
            F.struct(F.lit("price").alias("measure"), F.col("o_totalprice").alias("amount")),
            F.struct(F.lit("customer").alias("measure"), F.col("o_custkey").cast("double").alias("amount")),
        ).alias("measures"),
    )
    return flatten(nested)


def flatten_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.create_map(
            F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.col("o_orderpriority")
        ).alias("attribute"),
    )
    return flatten(nested, maps="explode")


def flatten_map_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = read(spark, sf_dir, "customer").select(
        "c_custkey",
        F.create_map(F.lit("segment"), F.col("c_mktsegment")).alias("attribute"),
        F.struct("c_name", "c_acctbal").alias("detail"),
    )
    return flatten(nested, maps="drop")


def flatten_prefixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two structs with a field of the same name."""
    nested = read(spark, sf_dir, "lineitem").select(
        F.struct(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("line")).alias("order"),
        F.struct(F.col("l_partkey").alias("key"), F.col("l_quantity").alias("pieces")).alias("part"),
    )
    return flatten(nested, on_duplicate="prefix")


_LINE_SPECS = (
    ColumnSpec("order_key", "bigint", "order"),
    ColumnSpec("line", "int", "line of the order"),
    ColumnSpec("shipped", "date", "day of shipping", "yyyy-MM-dd"),
    ColumnSpec("kind", "string", "what is charged"),
    ColumnSpec("amount", "double", "share of the price"),
)
_LINE_SCHEMA = (
    "at struct<order_key:bigint,line:bigint>, shipped string, "
    "charges array<struct<kind:string,amount:double>>"
)


def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "lines")
    _lines(spark, sf_dir).write.json(folder)
    return shown(read_events_json(spark, folder, _LINE_SPECS, schema=_LINE_SCHEMA))


def ingest_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "lines")
    _lines(spark, sf_dir).write.json(folder)
    schema = infer_event_schema(spark, folder)
    return shown(read_events_json(spark, folder, _LINE_SPECS, schema=schema, outer=True))


_EVENT_SCHEMA = "event_id bigint, hhmm int, tags array<struct<kind:string>>"
_EVENT_SPECS = (ColumnSpec("event_id", "bigint"), ColumnSpec("hhmm", "int"), ColumnSpec("kind", "string"))


def ingest_json_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every error event is cut short and every click has a clock as text: the rows that could
    be read, and after them the lines that could not be read whole."""
    clock = F.hour("ts") * 100 + F.minute("ts")
    shown_clock = F.when(F.col("event_type") == "click", F.concat(F.lit('"'), F.hour("ts"), F.lit(':"')))
    line = F.concat(
        F.lit('{"event_id": '), "event_id", F.lit(', "hhmm": '), F.coalesce(shown_clock, clock.cast("string")),
        F.lit(', "tags": [{"kind": "'), "event_type", F.lit('"}]'),
        F.when(F.col("event_type") == "error", "").otherwise("}"),
    )
    folder = new_folder(spark, "lines")
    events(spark, sf_dir).select(line).write.text(folder)
    good = read_events_json(spark, folder, _EVENT_SPECS, schema=_EVENT_SCHEMA)
    bad = malformed_lines(spark, folder, _EVENT_SCHEMA)
    return shown(good.unionByName(bad, allowMissingColumns=True), ("event_id", "hhmm"))


_MALFORMED_SQL = """
WITH lines AS (
  SELECT event_id, event_type, hour(ts) AS h, hour(ts) * 100 + minute(ts) AS hhmm FROM events),
bad AS (
  SELECT '{"event_id": ' || event_id || ', "hhmm": '
         || CASE WHEN event_type = 'click' THEN '"' || h || ':"' ELSE CAST(hhmm AS VARCHAR) END
         || ', "tags": [{"kind": "' || event_type || '"}]' || CASE WHEN event_type = 'error' THEN '' ELSE '}' END AS line,
         event_type <> 'error' AS readable
  FROM lines WHERE event_type IN ('error', 'click'))
SELECT CAST(event_id AS DOUBLE) AS event_id,
       CASE WHEN event_type <> 'click' THEN CAST(hhmm AS DOUBLE) END AS hhmm,
       event_type AS kind, NULL AS line, NULL AS readable
FROM lines WHERE event_type <> 'error'
UNION ALL SELECT NULL, NULL, NULL, line, readable FROM bad"""

_CHARGES_SQL = "\nUNION ALL\n".join(
    f"""SELECT l_orderkey AS order_key, l_linenumber AS line,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped, '{kind}' AS kind, l_{kind} AS amount
FROM lineitem WHERE l_{kind} > 0"""
    for kind in ("discount", "tax")
)
_CHARGES_OUTER_SQL = f"""{_CHARGES_SQL}
UNION ALL
SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR), NULL, NULL
FROM lineitem WHERE NOT (l_discount > 0) AND NOT (l_tax > 0)"""

QUERIES = {
    "flatten_struct": flatten_struct,
    "flatten_array_inner": flatten_array_inner,
    "flatten_array_outer": flatten_array_outer,
    "flatten_vectors": flatten_vectors,
    "flatten_deep": flatten_deep,
    "flatten_siblings": flatten_siblings,
    "flatten_map": flatten_map,
    "flatten_map_dropped": flatten_map_dropped,
    "flatten_prefixed": flatten_prefixed,
    "ingest_json": ingest_json,
    "ingest_json_inferred": ingest_json_inferred,
    "ingest_json_malformed": ingest_json_malformed,
}

SQL = {
    "flatten_struct": """
SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events""",
    "flatten_array_inner": _CHARGES_SQL,
    "flatten_array_outer": _CHARGES_OUTER_SQL,
    "flatten_vectors": """
SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS embedding, label FROM embeddings""",
    "flatten_deep": """
WITH lines AS (SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS line FROM conversations)
SELECT conv_id, turn, role, unnest(string_split(line, ' ')) AS word FROM lines""",
    "flatten_siblings": """
WITH labels AS (
  SELECT o_orderkey, o_orderstatus AS label FROM orders
  UNION ALL SELECT o_orderkey, o_orderpriority FROM orders),
measures AS (
  SELECT o_orderkey, 'price' AS measure, o_totalprice AS amount FROM orders
  UNION ALL SELECT o_orderkey, 'customer', CAST(o_custkey AS DOUBLE) FROM orders)
SELECT o_orderkey, label, measure, amount FROM labels JOIN measures USING (o_orderkey)""",
    "flatten_map": """
SELECT o_orderkey, 'status' AS attribute_key, o_orderstatus AS attribute_value FROM orders
UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM orders""",
    "flatten_map_dropped": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "flatten_prefixed": """
SELECT l_orderkey AS order_key, l_linenumber AS line, l_partkey AS part_key, l_quantity AS pieces
FROM lineitem""",
    "ingest_json": _CHARGES_SQL,
    "ingest_json_inferred": _CHARGES_OUTER_SQL,
    "ingest_json_malformed": _MALFORMED_SQL,
}
