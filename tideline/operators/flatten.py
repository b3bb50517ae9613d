"""Nested columns to a flat table."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from tideline.operators.naming import column

MAP_MODES = ("keep", "drop", "explode")
DUPLICATE_MODES = ("error", "prefix")


def flatten(
    df: DataFrame,
    outer: bool = False,
    maps: str = "keep",
    on_duplicate: str = "error",
    whole: str | None = None,
) -> DataFrame:
    """Explode every array and expand every struct, at any depth.

    Columns keep their place. Arrays side by side give every combination of
    their elements within the row. ``outer`` keeps rows whose array is empty
    or null. ``maps`` says what becomes of map columns; exploding gives
    ``<name>_key`` and ``<name>_value``. Names that would clash raise, or get
    the name of their parent in front with ``on_duplicate="prefix"``.
    Rows in which the column ``whole`` is not null stay one row each, whatever
    their arrays hold.
    """
    if maps not in MAP_MODES or on_duplicate not in DUPLICATE_MODES:
        raise ValueError(f"maps must be one of {MAP_MODES}, on_duplicate one of {DUPLICATE_MODES}")
    while True:
        df = _expand_structs(df, maps, on_duplicate)
        nested = _first_to_explode(df, maps)
        if nested is None:
            return df
        df = _explode_one(df, nested, outer, whole)


def _expand_structs(df: DataFrame, maps: str, on_duplicate: str) -> DataFrame:
    """All structs, however deep, in a single projection."""
    leaves: list[tuple[tuple[str, ...], Column]] = []
    for field in df.schema.fields:
        _leaves((field.name,), field.dataType, column(field.name), maps, leaves)
    names = _leaf_names([path for path, _ in leaves], on_duplicate)
    unchanged = all(len(path) == 1 for path, _ in leaves) and len(leaves) == len(df.columns)
    return df if unchanged else df.select(*[c.alias(n) for n, (_, c) in zip(names, leaves)])


def _leaves(path: tuple[str, ...], kind: DataType, value: Column, maps: str, out: list) -> None:
    if isinstance(kind, StructType):
        for field in kind.fields:
            _leaves(path + (field.name,), field.dataType, value.getField(field.name), maps, out)
    elif not (maps == "drop" and isinstance(kind, MapType)):
        out.append((path, value))


def _leaf_names(paths: list[tuple[str, ...]], on_duplicate: str) -> list[str]:
    # Spark resolves names without regard to case by default, so compare that way.
    def clashing(names: list[str]) -> set[str]:
        return {n for n, seen in Counter(n.lower() for n in names).items() if seen > 1}

    names = [path[-1] for path in paths]
    clash = clashing(names)
    if clash and on_duplicate == "prefix":
        names = ["_".join(p) if n.lower() in clash else n for n, p in zip(names, paths)]
        clash = clashing(names)
    if clash:
        raise ValueError(f"nested names clash: {sorted(clash)}")
    return names


def _first_to_explode(df: DataFrame, maps: str) -> str | None:
    for field in df.schema.fields:
        if isinstance(field.dataType, ArrayType):
            return field.name
        if maps == "explode" and isinstance(field.dataType, MapType):
            return field.name
    return None


def _explode_one(df: DataFrame, name: str, outer: bool, whole: str | None) -> DataFrame:
    """One generator per projection: the same answer on every Spark version."""
    explode, value = F.explode_outer if outer else F.explode, column(name)
    is_map = isinstance(df.schema[name].dataType, MapType)
    made = [f"{name}_key", f"{name}_value"] if is_map else [name]
    taken = {c.lower() for c in df.columns if c != name}
    if is_map and any(m.lower() in taken for m in made):
        raise ValueError(f"map {name!r} needs the names {made}, which are taken")
    if whole is not None:
        kept = column(whole).isNotNull()
        if not outer:
            df = df.where(kept | (F.size(value) > 0))
        explode, value = F.explode_outer, F.when(~kept, value)
    return df.select(
        *[
            explode(value).alias(*made) if c == name else column(c)
            for c in df.columns
        ]
    )
