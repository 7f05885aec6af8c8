"""Keeping broken files apart so that the others still go through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.schemas import CORRUPT_COLUMN

MALFORMED = "malformed JSON"
NO_ITEMS = "no items"


def document_error(require_items: bool = False) -> Column:
    """Why a document cannot be used, null for a good one."""
    error = F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit(MALFORMED))
    return error.when(F.size("items") == 0, F.lit(NO_ITEMS)) if require_items else error


def split_quarantine(documents: DataFrame, require_items: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good documents, and ``(_source_file, region, error)`` of the others.

    With ``require_items`` a document whose item list is empty is an error too.
    """
    judged = documents.withColumn("error", document_error(require_items))
    good = judged.filter(F.col("error").isNull()).drop("error", CORRUPT_COLUMN)
    bad = judged.filter(F.col("error").isNotNull()).select("_source_file", "region", "error")
    return good, bad
