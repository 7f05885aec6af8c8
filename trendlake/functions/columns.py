"""Finding and flattening columns by schema only; no data is read."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _has_path(schema: T.StructType, path: list[str]) -> bool:
    if path[0] not in schema.names:
        return False
    if len(path) == 1:
        return True
    inner = schema[path[0]].dataType
    return isinstance(inner, T.StructType) and _has_path(inner, path[1:])


def _snake(name: str) -> str:
    return re.sub(r"(?<=[a-z])(?=[A-Z])", "_", name).lower()


def quoted(*parts: str) -> Column:
    return F.col(".".join(f"`{part}`" for part in parts))


def resolve_column(df: DataFrame, path: str, inside: str | None = None) -> Column | None:
    """Column for a nested field whichever way its name was written, or None.

    Tried in turn: the field below ``inside``, the nested field itself, and flat columns
    spelled ``a.b``, ``a__b``, ``a_b`` and their lower-case form with underscores.
    """
    parts = path.split(".")
    nested = [[inside, *parts]] if inside else []
    for candidate in [*nested, parts]:
        if _has_path(df.schema, candidate):
            return quoted(*candidate)
    for flat in (path, "__".join(parts), "_".join(parts), "_".join(map(_snake, parts))):
        if flat in df.columns:
            return quoted(flat)
    return None


def missing_columns(df: DataFrame, expected: tuple[str, ...] | list[str]) -> list[str]:
    """Names of ``expected`` that the frame does not have, sorted."""
    return sorted(set(expected) - set(df.columns))


def flatten_struct(df: DataFrame, separator: str = ".") -> DataFrame:
    """One column per nested leaf, named by its path; arrays stay as they are."""

    def leaves(schema: T.StructType, prefix: tuple[str, ...]):
        for item in schema.fields:
            path = (*prefix, item.name)
            if isinstance(item.dataType, T.StructType):
                yield from leaves(item.dataType, path)
            else:
                yield quoted(*path).alias(separator.join(path))

    return df.select(*leaves(df.schema, ()))
