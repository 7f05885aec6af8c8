"""Processing files by the notices of their arrival; the bronze folders themselves are never listed.

A notice names a file by its URL-encoded key. Notices come as JSON lines in a folder of their own, may be
repeated, late, or name files that are not there. A ledger has one row for every key and batch that
took it, so each file is handed on once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.functions.paths import decode_key, region_of_path
from trendlake.sources.files import json_texts, optional_frame
from trendlake.sources.quarantine import split_quarantine
from trendlake.sources.reference import reference_documents
from trendlake.staging import cleared_staging, existing, materialize
from trendlake.streaming.incremental import error_folder, merge_reference, run_new_files

NOTICE = "key string"
LEDGER = "path string, found boolean"
MISSING_FILE = "no such file"


def ledger_rows(spark: SparkSession, ledger: str, before: int | None = None) -> DataFrame:
    """The files taken by all batches, or by those before one: a batch that is repeated does not find itself."""
    stored = optional_frame(lambda: spark.read.schema(f"{LEDGER}, batch bigint").parquet(ledger))
    rows = spark.createDataFrame([], f"{LEDGER}, batch bigint") if stored is None else stored
    return rows if before is None else rows.where(F.col("batch") < before)


def new_paths(notices: DataFrame, ledger: DataFrame) -> DataFrame:
    """Decoded paths of notices, each once, without those that the ledger has found before.

    A file that was missing is taken again when another notice names it.
    """
    paths = notices.select(F.ltrim(decode_key(F.col("key")), F.lit("/")).alias("path")).where("path <> ''").distinct()
    return paths.join(ledger.where("found").select("path").distinct(), "path", "left_anti")


def _some(paths: DataFrame, most: int) -> Iterator[list[str]]:
    held: list[str] = []
    for row in paths.toLocalIterator():
        held.append(row["path"])
        if len(held) == most:
            yield held
            held = []
    if held:
        yield held


def run_notices(
    spark: SparkSession,
    notices: str,
    root: str,
    checkpoint: str,
    handle: Callable[[list[str], str], None],
    max_files: int = 10_000,
) -> None:
    """Hand the files below ``root`` that new notices name to ``handle``, at most ``max_files`` at a time, then stop.

    ``handle`` gets full paths and a name for them that a repetition has too. It has to bear getting files again:
    a batch that broke off is repeated as a whole.
    """
    root, ledger = root.rstrip("/"), f"{checkpoint.rstrip('/')}/ledger"
    stream = spark.readStream.schema(NOTICE).option("maxFilesPerTrigger", max_files).json(notices)

    def take(batch: DataFrame, number: int) -> None:
        with cleared_staging(spark):
            paths = materialize(new_paths(batch, ledger_rows(spark, ledger, number)).orderBy("path"), "notices")
            for part, some in enumerate(_some(paths, max_files)):
                found = existing(spark, [f"{root}/{path}" for path in some])
                if found:
                    handle(found, f"{number}-{part}")
                there = set(found)
                taken = spark.createDataFrame([(path, f"{root}/{path}" in there) for path in some], LEDGER)
                taken.write.mode("overwrite" if part == 0 else "append").parquet(f"{ledger}/batch={number}")

    run_new_files(stream, take, f"{checkpoint.rstrip('/')}/stream")


def noticed_reference(spark: SparkSession, notices: str, bronze: str, silver: str, checkpoint: str, layout: str = "auto", max_files: int = 10_000) -> None:
    """Replace the reference rows of every region of which notices name a new category landing.

    As ``incremental_reference``, without listing ``bronze``. Files that notices name in vain and unusable documents go to the
    error folder; the former are told by ``missing_files`` as well.
    """
    work = f"{checkpoint.rstrip('/')}/merged"

    def merge(paths: list[str], name: str) -> None:
        documents = materialize(reference_documents(json_texts(spark.read, paths, layout)), "reference-documents")
        good, errors = split_quarantine(documents, require_items=True)
        errors.write.mode("overwrite").parquet(f"{error_folder(silver)}/batch={name}")
        merge_reference(good, silver, f"{work}/{name}")

    run_notices(spark, notices, bronze, checkpoint, merge, max_files)


def missing_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Error rows of the files that were named and never found."""
    rows = ledger_rows(spark, f"{checkpoint.rstrip('/')}/ledger")
    never = rows.groupBy("path").agg(F.bool_or("found").alias("found")).where("NOT found")
    return never.select(F.col("path").alias("_source_file"), region_of_path(F.col("path")).alias("region"), F.lit(MISSING_FILE).alias("error"))
