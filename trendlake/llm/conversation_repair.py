"""Conversation repair: faults found, and the cheapest edits that make the roles take turns."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.llm import _glr
from trendlake.llm._frames import pick

#: White space, ends of sentences, and the neighbours that are in order.
SPACE, ENDS, IN_ORDER = " \t\n\x0b\x0c\r", ".!?", {"su", "ua", "au"}
#: The role that a turn gets after a turn of another.
NEXT = {"": "user", "s": "user", "a": "user", "u": "assistant"}

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

Turn = tuple[int | None, str, str]


def faults(turns: list[Turn]) -> list[str]:
    """The first fault of each turn: blank, duplicate, truncated, or nothing."""
    seen, found = set(), []
    for _, role, text in turns:
        shown = text.strip(SPACE)
        again = (role, text) in seen
        seen.add((role, text))
        found.append("blank" if not shown else "duplicate" if again else "truncated" if shown[-1] not in ENDS else "")
    return found


def edited(turns: list[Turn], audit: str) -> list[tuple[str, str]]:
    """(role, text) of the turns after the edits of ``audit``."""
    out, last, rest = [], "", iter(turns)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rest)[1:]
        if edit != "D":
            out.append((role if edit == "K" else NEXT[last], text))
            last = out[-1][0][:1]
    return out


def repaired(turns: list[Turn]) -> dict:
    """Counts, cost, audit and repaired turns of one conversation, whose turns are in order."""
    found = faults(turns)
    initials = [role[:1] for _, role, _ in turns]
    known = {turn for turn, _, _ in turns if turn is not None}
    cost, audit = _glr.repair([(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, found, strict=True)])
    return {
        "gaps": max(known) - min(known) + 1 - len(known) if known else 0,
        **{kind: found.count(kind) for kind in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in IN_ORDER for a, b in pairwise(initials)),
        "cost": cost,
        "audit": audit,
        "repaired": [{"role": role, "text": text} for role, text in edited(turns, audit)],
    }


def repair_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", lost: str | None = None) -> DataFrame:
    """One row a conversation: faults, the cheapest repair of its structure, and the repaired turns.

    Returns (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired). ``gaps``
    are turn numbers missing between the least and the greatest; a turn's first fault counts:
    blank text, role and text seen earlier, or a last character other than ``.!?``. ``illegal``
    counts neighbours other than system-user, user-assistant, assistant-user.

    The repaired roles are an optional system turn and user-assistant pairs, or nothing. Keep costs
    0, Rerole (to user or assistant) 3, Delete 4 (blank and duplicate turns have to go), Insert (an empty turn)
    3, and a truncated turn that stays 3 more. ``audit`` has the edits' initials in order; of equally
    cheap ones it is the least by ASCII. Only the first letter of a role counts.

    A generalised LR parser over the roles' grammar keeps a graph-structured stack of all repairs at once.
    Turns are shuffled and sorted by conversation, turn (null first), role and text, and stream through
    the task; the turns of one conversation are held in memory, as its result is one row.

    Rows where the column ``lost`` is true are left out, but their conversation has a row, if need be an
    empty one. Null roles and texts count as empty, rows alike stay turns of their own, null
    conversation ids are one conversation. An empty table gives an empty table; other columns are left
    out.
    """
    names = {"conv_id": conv_id, "turn": turn, "role": role, "text": text}
    given = pick(turns, **names, **({"lost": lost} if lost else {}))
    gone = F.coalesce("lost", F.lit(False)) if lost else F.lit(False)
    shown = given.select("conv_id", F.col("turn").cast("bigint").alias("turn"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")), gone.alias("lost"))
    placed = shown.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    turned = T.ArrayType(T.StructType().add("role", "string").add("text", "string"))
    schema = T.StructType([given.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("audit", T.StringType()), T.StructField("repaired", turned)])
    return placed.mapInArrow(partial(_conversations, schema=_arrow(given.schema["conv_id"].dataType)), schema)


def _arrow(id_type: T.DataType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    turned = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    return pa.schema([("conv_id", to_arrow_type(id_type)), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired", turned)])


def _conversations(batches: Iterator[pa.RecordBatch], schema: pa.Schema, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Sorted rows to one row a conversation, some hundred of them at a time."""
    made: list[dict] = []
    for conv_id, turns in _gathered(batches):
        made.append({"conv_id": conv_id, **repaired(turns)})
        if len(made) >= rows:
            yield pa.RecordBatch.from_pylist(made, schema)
            made = []
    yield pa.RecordBatch.from_pylist(made, schema)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[Turn]]]:
    conv_id, turns = None, None
    for batch in batches:
        for i, turn, role, text, lost in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if turns is None or i != conv_id:
                if turns is not None:
                    yield conv_id, turns
                conv_id, turns = i, []
            if not lost:
                turns.append((turn, role, text))
    if turns is not None:
        yield conv_id, turns
