"""Category documents to the silver reference table and to the category lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake import schemas
from trendlake.functions.clock import iso_text
from trendlake.functions.cleaning import to_count
from trendlake.functions.columns import flatten_struct, resolve_column
from trendlake.operators.clean import keep_first

_ITEM_FIELDS = schemas.REFERENCE_ITEM.names
_SOURCE = ("_source_file", "region")
_LANDING = ("_landed_at", "_landing")
# Fields of an item, and of its snippet, that have columns of their own.
_NAMED = (*_ITEM_FIELDS, "items", "_metadata")
_NAMED_SNIPPET = tuple(schemas.REFERENCE_SNIPPET.names)


def _landing_columns(documents: DataFrame) -> dict[str, Column]:
    """When and as what each document was landed, and its place; a file is a landing by default."""
    given = {name: F.col(name) for name in (*_LANDING, "_page") if name in documents.columns}
    itself = {"_landed_at": F.col("_modified_at"), "_landing": F.col("_source_file"), "_page": F.lit(0).cast("bigint")}
    return itself | given


def newest_landing_per_region(documents: DataFrame) -> DataFrame:
    """All documents of the last landing of each region: a region is replaced as a whole.

    The newest landing is found by an aggregate, so the documents of a region, in however many
    files, are never gathered in one task.
    """
    landed = documents.withColumns(_landing_columns(documents))
    newest = landed.groupBy("region").agg(F.max(F.struct(*_LANDING)).alias("_newest"))
    chosen = newest.select("region", *(F.col(f"_newest.{name}").alias(name) for name in _LANDING))
    return landed.join(chosen, ["region", *_LANDING], "left_semi")


# A file used to be the unit; for files from elsewhere it still is.
newest_file_per_region = newest_landing_per_region


def extra_fields(raw: Column) -> Column:
    """Fields of an item's text that no column is named for, as one JSON object, or null."""
    none = F.array().cast("array<struct<key:string,value:string>>")
    fields = F.from_json(raw, "map<string,string>")
    snippet = F.from_json(F.element_at(F.map_filter(fields, lambda k, _: k == "snippet"), "snippet"), "map<string,string>")

    def unnamed(entries: Column, named: tuple[str, ...], prefix: str) -> Column:
        other = F.filter(F.coalesce(F.map_entries(entries), none), lambda e: ~e.key.isin(*named))
        return F.transform(other, lambda e: F.struct(F.concat(F.lit(prefix), e.key).alias("key"), e.value.alias("value")))

    found = F.concat(unnamed(fields, _NAMED, ""), unnamed(snippet, _NAMED_SNIPPET, "snippet."))
    keys = F.array_sort(F.array_distinct(F.transform(found, lambda e: e.key)))
    first = F.transform(keys, lambda k: F.get(F.filter(found, lambda e: e.key == k), F.lit(0)).value)
    return F.when(F.size(found) > 0, F.to_json(F.map_from_arrays(keys, first), {"ignoreNullFields": "false"}))


def explode_reference_items(documents: DataFrame) -> DataFrame:
    """One row per item with its position; a document without ``items`` is one item.

    ``_extra`` holds the fields without a column where the documents bring the items as text.
    """
    itself = F.array(F.struct(*_ITEM_FIELDS))
    items = F.coalesce(F.col("items"), itself)
    raw = F.col("_raw_items") if "_raw_items" in documents.columns else F.transform(items, lambda _: F.lit(None).cast("string"))
    both = documents.withColumns({**_landing_columns(documents), "_both": F.arrays_zip(items.alias("item"), raw.alias("raw"))})
    exploded = both.select(*_SOURCE, *_LANDING, "_page", F.posexplode("_both").alias("_pos", "b"))
    return exploded.select(
        *_SOURCE, *_LANDING, "_page", "_pos", "b.item.*", extra_fields(F.col("b.raw")).alias("_extra")
    )


def distinct_keep_last(df: DataFrame, keys: Sequence[str], position: Sequence[Column]) -> DataFrame:
    """Last row of every key in the order of ``position``."""
    return keep_first(df, keys, [column.desc() for column in position])


def silver_reference(documents: DataFrame, keep_landing: bool = False) -> DataFrame:
    """Silver reference rows: flattened items, one per id and landing, with audit columns.

    The last item of an id in its region's landing counts, by page and place in the page; equal
    places, which only pages without a number have, are decided by the item itself. ``keep_landing``
    adds the landing and the place, by which ``newest_rows`` unites rows of several runs.
    """
    position = [F.col("_page"), F.col("_pos"), F.col("etag"), F.col("snippet.title"), F.col("kind"), F.col("_source_file")]
    last = explode_reference_items(documents).transform(
        distinct_keep_last, ("region", *_LANDING, "id"), position
    )
    flat = flatten_struct(last)
    return flat.select(
        "kind",
        "etag",
        "id",
        F.col("`snippet.channelId`").alias("snippet_channel_id"),
        F.col("`snippet.title`").alias("snippet_title"),
        F.col("`snippet.assignable`").alias("snippet_assignable"),
        "_extra",
        iso_text(F.current_timestamp()).alias("_ingestion_timestamp"),
        "_source_file",
        "region",
        *((*_LANDING, "_page", "_pos") if keep_landing else ()),
    )


def newest_rows(rows: DataFrame) -> DataFrame:
    """Of silver rows with their landing: each region's newest landing, the last row of an id in it.

    The result for rows of several runs is that for all their documents at once. Rows without a
    landing are older than all others.
    """
    position = [F.col(name) for name in ("_page", "_pos", "etag", "snippet_title", "kind", "_source_file")]
    newest = rows.transform(newest_landing_per_region)
    return newest.transform(distinct_keep_last, ("region", *_LANDING, "id"), position)


def missing_fields(reference: DataFrame, required: Sequence[str] = ("id", "snippet_title")) -> DataFrame:
    """Report rows of the files in which no item carries a required field.

    The columns are always there, so what is looked at are their values.
    """
    counted = reference.groupBy(*_SOURCE).agg(*(F.count(name).alias(name) for name in required))
    absent = F.array_compact(F.array(*(F.when(F.col(name) == 0, F.lit(name)) for name in required)))
    report = counted.select(*_SOURCE, absent.alias("missing_columns"))
    return report.filter(F.size("missing_columns") > 0).select(
        F.lit("schema").alias("check"),
        "_source_file",
        "region",
        "missing_columns",
        F.lit(False).alias("passed"),
        F.concat(F.lit("no item has "), F.array_join("missing_columns", ", ")).alias("message"),
    )


def category_lookup(reference: DataFrame) -> DataFrame | None:
    """``category_id, category_name``, one row per id; None for an unknown schema.

    Of several names for an id the one ingested last is taken, then the greatest name.
    """
    title = resolve_column(reference, "snippet.title")
    if title is None or "id" not in reference.columns:
        return None
    ingested = (
        F.col("_ingestion_timestamp")
        if "_ingestion_timestamp" in reference.columns
        else F.lit(None).cast("string")
    )
    named = reference.select(
        to_count(F.col("id"), reference.schema["id"].dataType).alias("category_id"),
        title.alias("category_name"),
        ingested.alias("_ingested"),
    )
    latest = F.max_by("category_name", F.struct("_ingested", "category_name"))
    return named.groupBy("category_id").agg(latest.alias("category_name"))
