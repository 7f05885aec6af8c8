"""Picking columns by position, and parts of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text handled at a time inside a task, whatever the size of the Arrow batch.
PART_BYTES = 2 << 20


def pick(df: DataFrame, **names: str) -> DataFrame:
    """The columns ``names`` gives (new name = name in ``df``), all others left out.

    Columns are found by exact name and taken by position, so names that differ in case
    only, repeated names and names with dots do no harm; of repeated names the first counts.
    """
    flat, at = _flat(df), list(df.columns)
    return flat.select(*(F.col(flat.columns[at.index(old)]).alias(new) for new, old in names.items()))


class Carried:
    """All columns of a frame under names that nothing clashes with, to be named back later."""

    def __init__(self, df: DataFrame) -> None:
        self.names = list(df.columns)
        self.flat = _flat(df)

    def column(self, name: str) -> Column:
        """The first column with exactly this name."""
        return F.col(self.key(name))

    def key(self, name: str) -> str:
        return self.flat.columns[self.names.index(name)]

    def forget(self, name: str) -> None:
        """Leave the first column of this name out of what ``named`` gives."""
        at = self.names.index(name)
        self.flat = self.flat.drop(self.flat.columns[at])
        del self.names[at]

    def named(self, df: DataFrame, replaced: dict[str, Column] | None = None, added: dict[str, Column] | None = None) -> DataFrame:
        """``df`` with the first names again.

        ``replaced`` gives new values to the first column of a name. ``added`` columns come last;
        they take the place of carried columns of the same name, in whatever case.
        """
        replaced, added = dict(replaced or {}), added or {}
        gone = {name.lower() for name in added}
        kept = [
            replaced.pop(name, F.col(key)).alias(name)
            for key, name in zip(self.flat.columns, self.names, strict=True)
            if name.lower() not in gone
        ]
        return df.select(*kept, *(value.alias(name) for name, value in added.items()))


def _flat(df: DataFrame) -> DataFrame:
    return df.toDF(*(f"_in{i}" for i in range(len(df.columns))))


def parts(column: pa.Array, limit: int = PART_BYTES) -> Iterator[pa.Array]:
    """Slices of a text column with about ``limit`` bytes, one row at least; no text is cut."""
    start, held = 0, 0
    for i, size in enumerate(_sizes(column)):
        if i > start and held + size > limit:
            yield column.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(column):
        yield column.slice(start)


def _sizes(column: pa.Array) -> Sequence[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_pylist()
