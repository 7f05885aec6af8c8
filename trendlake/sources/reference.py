"""Bronze category files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake import schemas
from trendlake.functions.clock import instant
from trendlake.sources.files import json_texts, parse_documents, region_folders


def read_reference_json(
    spark: SparkSession,
    root: str,
    regions: Sequence[str] | None = None,
    layout: str = "auto",
) -> DataFrame:
    """One row per category document below ``root``, with file, landing and region."""
    return reference_documents(json_texts(spark.read, region_folders(root, regions), layout))


def reference_documents(texts: DataFrame) -> DataFrame:
    """Category documents with their source and landing.

    A landing is what one run of the landing step wrote for a region, in however many files;
    a file from elsewhere is a landing of its own. ``_landed_at`` and ``_landing`` tell
    landings apart, ``_page`` orders the documents of one. ``_raw_items`` has every item as text,
    for the fields that the schema does not name.
    """
    documents = parse_documents(texts, schemas.REFERENCE_DOCUMENT)
    raw = F.from_json("value", "items array<string>").getField("items")
    return documents.select(
        *(name for name in schemas.REFERENCE_DOCUMENT.names if name != "_metadata"),
        schemas.CORRUPT_COLUMN,
        "_source_file",
        "_modified_at",
        F.col("_folder").alias("region"),
        F.coalesce(instant(F.col("_metadata.timestamp")), F.col("_modified_at")).alias("_landed_at"),
        F.coalesce("_metadata.run_id", "_source_file").alias("_landing"),
        F.coalesce(F.col("_metadata.page"), F.col("_line").cast("bigint")).alias("_page"),
        F.coalesce(raw, F.array("value")).alias("_raw_items"),
    )
