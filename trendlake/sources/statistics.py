"""Bronze statistics: historic CSV files and landed API documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake import schemas
from trendlake.config import UNKNOWN_REGION
from trendlake.functions.clock import instant
from trendlake.sources.files import json_texts, parse_documents, region_folders, source_columns

#: What a CSV file has to have; its folder names the region.
CSV_COLUMNS = tuple(name for name in schemas.STATISTICS.names if name != "region")


def read_stats_csv(
    spark: SparkSession,
    root: str | list[str],
    regions: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Rows of all CSV files below ``root``, or of the files it lists, as text, with ``region``
    from the folder.

    Columns are matched by header name; a file whose header differs from the first one
    fails the read instead of shifting its values. The jobs read with
    :func:`trendlake.sources.csv_records.read_csv_files`, where every file may have its own header.
    ``columns`` gives the header without looking at a file. Quoted line breaks need
    ``multi_line``, which makes a file the unit of work; where titles are known to hold
    none, turn it off and large files are split between tasks.
    """
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
    )
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(name, T.StringType()) for name in columns]))
    rows = reader.csv(region_folders(root, regions) if isinstance(root, str) else root)
    _, _, region = source_columns(rows)
    return rows.withColumn("region", region)


def read_stats_api_json(
    spark: SparkSession,
    root: str,
    regions: Sequence[str] | None = None,
    layout: str = "auto",
) -> DataFrame:
    """One row per API response below ``root``, whichever way its file is laid out.

    See :func:`trendlake.sources.files.json_texts` for ``layout``. Broken input keeps its text
    in ``_corrupt_record``.
    """
    return api_documents(json_texts(spark.read, region_folders(root, regions), layout))


def api_documents(texts: DataFrame) -> DataFrame:
    """API responses with ``_source_file``, ``region`` and ``_landed_at``.

    The folder names the region; a document outside such a folder names it itself. A
    document without a landing time counts as landed when its file was written.
    """
    documents = parse_documents(texts, schemas.API_DOCUMENT)
    folder = F.col("_folder")
    region = F.when(folder == UNKNOWN_REGION, F.coalesce(F.col("_metadata.region"), folder)).otherwise(folder)
    return documents.select(
        *schemas.API_DOCUMENT.names,
        schemas.CORRUPT_COLUMN,
        "_source_file",
        region.alias("region"),
        F.coalesce(instant(F.col("_metadata.timestamp")), F.col("_modified_at")).alias("_landed_at"),
    )


def explode_items(documents: DataFrame) -> DataFrame:
    """One row per item of the API documents, as ``item`` with region and landing time."""
    return documents.select("region", "_landed_at", F.explode("items").alias("item"))
