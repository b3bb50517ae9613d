"""Declared columns, casts, column comments, unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline import ColumnSpec, align_union, column_catalog, project_typed
from tideline_queries.inputs import events, read, shown

_LINE_SPECS = (
    ColumnSpec("l_shipdate", "date", "day of shipping", "yyyy-MM-dd"),
    ColumnSpec("l_orderkey", "bigint", "order"),
    ColumnSpec("l_quantity", "int", "pieces"),
    ColumnSpec("l_extendedprice", "bigint", "price, cents cut off"),
    ColumnSpec("l_tax", "boolean", "whether taxed"),
    ColumnSpec("l_returnflag", "string", "return flag"),
    ColumnSpec("l_linenumber", "string"),
)


def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(project_typed(read(spark, sf_dir, "lineitem"), _LINE_SPECS, on_error="fail"))


def try_cast_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, of which only one column holds numbers."""
    rows = events(spark, sf_dir).select(
        "event_id",
        "props",
        F.get_json_object("props", "$.k").alias("k"),
        F.col("event_type").alias("kind"),
    )
    specs = (
        ColumnSpec("event_id", "int"),
        ColumnSpec("props", "int"),
        ColumnSpec("k", "bigint"),
        ColumnSpec("kind", "date"),
    )
    return shown(project_typed(rows, specs), ("props", "k"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project_typed(read(spark, sf_dir, "lineitem"), _LINE_SPECS)
    return column_catalog(rows, count_filled=True)


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a price and with a spare column, and all orders as they are."""
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority"
    )
    bare = orders.select(F.lit("spare").alias("spare"), "o_orderpriority", "o_orderkey")
    return align_union(bare, orders)


def _catalog_sql() -> str:
    kinds = {"bigint": "bigint", "int": "int", "date": "date", "boolean": "boolean", "string": "string"}
    return "\nUNION ALL ".join(
        f"SELECT {i} AS position, '{s.name}' AS name, '{kinds[s.type]}' AS type, "
        f"'{s.comment}' AS comment, count({s.name}) AS filled FROM lineitem"
        for i, s in enumerate(_LINE_SPECS)
    )


QUERIES = {
    "typed_projection": typed_projection,
    "try_cast_projection": try_cast_projection,
    "column_catalog": catalog,
    "align_union": union_by_name,
}

SQL = {
    "typed_projection": """
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, l_orderkey,
       CAST(trunc(l_quantity) AS INTEGER) AS l_quantity,
       CAST(trunc(l_extendedprice) AS BIGINT) AS l_extendedprice,
       l_tax <> 0 AS l_tax, l_returnflag, CAST(l_linenumber AS VARCHAR) AS l_linenumber
FROM lineitem""",
    "try_cast_projection": """
SELECT CAST(event_id AS INTEGER) AS event_id,
       CAST(TRY_CAST(props AS INTEGER) AS DOUBLE) AS props,
       CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS DOUBLE) AS k,
       CAST(TRY_CAST(event_type AS DATE) AS VARCHAR) AS kind
FROM events""",
    "column_catalog": _catalog_sql(),
    "align_union": """
SELECT o_orderkey, CAST(NULL AS DOUBLE) AS o_totalprice, o_orderpriority FROM orders
UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders""",
}
