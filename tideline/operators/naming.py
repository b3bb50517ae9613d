"""Column references that are safe for any name, and what can be done with a type."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """The top-level column of that name, dots and blanks included."""
    return F.col(quoted(name))


def as_list(names: str | Iterable[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def has_order(kind: DataType) -> bool:
    """Whether values can be sorted and hashed; maps and variants cannot."""
    if isinstance(kind, ArrayType):
        return has_order(kind.elementType)
    if isinstance(kind, StructType):
        return all(has_order(field.dataType) for field in kind.fields)
    return not isinstance(kind, (MapType, VariantType))
