"""What all file readers share: region folders, source columns and absent input."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.functions.paths import decode_key, region_of_path
from trendlake.schemas import CORRUPT_COLUMN

ABSENT = frozenset({"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"})


def region_folders(root: str, regions: Sequence[str] | None) -> str:
    """``root`` itself, or a pattern for the folders of ``regions`` only.

    A recursive listing has no partition columns to prune by, so the choice of regions is
    made in the path and the other folders are never listed.
    """
    root = root.rstrip("/")
    return root if regions is None else f"{root}/region={{{','.join(regions)}}}"


def source_columns(df: DataFrame) -> tuple[Column, Column, Column]:
    """Decoded file name, its modification time and the region of its folder.

    Landed documents have a ``_metadata`` field of their own, so the file metadata is
    taken through ``metadataColumn``, which is not hidden by it.
    """
    metadata = df.metadataColumn("_metadata")
    path = decode_key(metadata.getField("file_path"), plus_is_space=False)
    return path, metadata.getField("file_modification_time"), region_of_path(path)


# Folder that the landing step puts around files of one object per line.
LINES_FOLDER = "layout=lines"

# Between two objects: a brace, a line break, a brace. No JSON string holds a raw line break
# and no JSON value two objects without a comma, so this can only part documents.
_BETWEEN = r"(?<=\})[ \t\r]*\n\s*(?=\{)"
_STRINGS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def json_texts(reader, root: str | list[str], layout: str = "auto", pattern: str = "*.json") -> DataFrame:
    """One row per JSON document below ``root``, or of the files it lists: ``value``, ``_line`` and the source columns.

    ``auto`` reads files below a folder ``layout=lines``, which the landing step writes, line by
    line, so that large ones are split, and all other files whole. A whole file may hold
    several objects as well, each beginning on a line of its own: all of them are returned, with
    their place in the file as ``_line``. ``lines`` and ``document`` read every file in one way;
    with ``lines`` the place in the file is not known and zero. The choice by folder is made on the
    file's name, so files of the other kind are not opened. ``reader`` is a batch or a streaming reader.
    """
    if layout not in ("auto", "document", "lines"):
        raise ValueError(f"layout must be 'auto', 'document' or 'lines', not {layout!r}")
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    frames = []
    if layout != "document":
        lines = _texts(reader.text(root, wholetext=False), True if layout == "auto" else None)
        frames.append(lines.select("value", F.lit(0).alias("_line"), *_SOURCE_COLUMNS))
    if layout != "lines":
        whole = _texts(reader.text(root, wholetext=True), False if layout == "auto" else None)
        pieces = F.posexplode(F.split("value", _BETWEEN)).alias("_line", "value")
        frames.append(whole.select(pieces, *_SOURCE_COLUMNS).select("value", "_line", *_SOURCE_COLUMNS))
    return reduce(DataFrame.unionByName, frames).filter(F.trim(F.col("value")) != "")


_SOURCE_COLUMNS = ("_source_file", "_modified_at", "_folder")


def _texts(texts: DataFrame, in_lines_folder: bool | None) -> DataFrame:
    """Texts with their source, of files inside or outside the folder of lines if that is asked."""
    if in_lines_folder is not None:
        inside = texts.metadataColumn("_metadata").getField("file_path").contains(f"/{LINES_FOLDER}/")
        texts = texts.filter(inside if in_lines_folder else ~inside)
    path, modified, region = source_columns(texts)
    return texts.select("value", path.alias("_source_file"), modified.alias("_modified_at"), region.alias("_folder"))


def parse_documents(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of ``schema`` beside the columns of ``texts``; broken text in ``_corrupt_record``.

    Broken is what does not parse, and also text that goes on after its first object: a parser
    stops there and the rest would be lost unseen.
    """
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    parsed = texts.withColumn("_json", F.from_json("value", kept, options))
    text = F.btrim(F.col("value"), F.lit(" \t\r\n"))
    # Taking out the strings is dear; without them a brace can only follow where one or a string did before.
    goes_on = ~text.endswith("}") | (text.rlike(r'\}\s*["{]') & F.regexp_replace(text, _STRINGS, "").rlike(r"\}\s*\{"))
    corrupt = F.coalesce(F.col(f"_json.{CORRUPT_COLUMN}"), F.when(F.col("_json").isNull() | goes_on, F.col("value")))
    fields = [F.col(f"_json.{name}").alias(name) for name in schema.names]
    return parsed.select(*fields, corrupt.alias(CORRUPT_COLUMN), *texts.columns)


def is_absent(error: AnalysisException) -> bool:
    return (error.getCondition() or "").split(".")[0] in ABSENT


def optional_frame(load: Callable[[], DataFrame]) -> DataFrame | None:
    """The loaded frame, or None when the table or path does not exist.

    Any other failure is passed on.
    """
    try:
        return load()
    except AnalysisException as error:
        if is_absent(error):
            return None
        raise
