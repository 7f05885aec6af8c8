"""Queries over the category reference branch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake import schemas
from trendlake.config import QualityRules
from trendlake.operators import normalize, quality
from trendlake.operators import reference as ref
from trendlake.plans.silver import bronze_to_silver_reference as run_reference
from trendlake.sinks.landing import land_reference_json
from trendlake.sinks.tables import write_partitions
from trendlake.sources.reference import read_reference_json as read_documents
from trendlake.sources.tables import read_table
from trendlake.staging import new_folder
from trendlake.streaming.incremental import incremental_reference as run_new_reference
from trendlake.streaming.notices import noticed_reference
from trendlake.workload import inputs
from trendlake.workload.oracle_ctes import LOOKUP, REFERENCE, with_
from trendlake.workload.registry import query

_ITEMS = """
items AS (
    SELECT *, position // 50 AS page FROM reference
)"""

_LAST_PER_PAGE = f"""{REFERENCE},{_ITEMS},
unique_items AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY region, page, id ORDER BY position DESC) AS place FROM items)
    WHERE place = 1
)"""

_SILVER_COLUMNS = """'category' AS kind, 'e' || position AS etag, id, 'c' || id AS snippet_channel_id,
       snippet_title, position % 2 = 0 AS snippet_assignable, region"""


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as if each page were one file, later pages being newer."""
    return inputs.reference_documents(spark, sf_dir).withColumns(
        {
            "id": F.lit(None).cast("string"),
            "snippet": F.lit(None).cast(schemas.REFERENCE_SNIPPET),
            "_source_file": F.concat_ws("/", F.lit("files"), "region", "page"),
            "_modified_at": F.timestamp_seconds("page"),
        }
    )


@query(with_(f"{REFERENCE},{LOOKUP}", "SELECT category_id, category_name FROM lookup"))
def category_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ref.category_lookup(inputs.reference_rows(spark, sf_dir))


@query(
    """SELECT event_type, user_id, event_id, value FROM (
           SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) AS place
           FROM events)
       WHERE place = 1"""
)
def distinct_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event per type and user, the type standing for the file."""
    events = inputs.table(spark, sf_dir, "events")
    last = ref.distinct_keep_last(events, ["event_type", "user_id"], [F.col("event_id")])
    return last.select("event_type", "user_id", "event_id", "value")


@query(
    with_(
        _LAST_PER_PAGE,
        f"SELECT {_SILVER_COLUMNS}, 'files/' || region || '/' || page AS _source_file FROM unique_items",
    )
)
def silver_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents exploded, flattened, and the last item of an id kept in each."""
    return ref.silver_reference(_documents(spark, sf_dir)).drop("_ingestion_timestamp", "_extra")


@query(
    with_(
        f"""{_LAST_PER_PAGE},
        newest AS (SELECT region, max(page) AS page FROM items GROUP BY region)""",
        f"SELECT {_SILVER_COLUMNS} FROM unique_items SEMI JOIN newest USING (region, page)",
    )
)
def newest_file_per_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = ref.newest_file_per_region(_documents(spark, sf_dir))
    return ref.silver_reference(newest).drop("_ingestion_timestamp", "_source_file", "_extra")


def _land(spark: SparkSession, documents: DataFrame, folder: str, day: int, tasks: int = 40) -> None:
    """Land the documents with so many tasks, each writing files of its own."""
    landed = documents.select("region", "kind", "etag", "items", "page").repartition(tasks)
    at = F.timestamp_seconds(F.lit(inputs.REFERENCE_EPOCH + day * 86_400))
    land_reference_json(landed, folder, at, "page")


@query(
    with_(
        f"{REFERENCE},{_ITEMS}",
        """SELECT region, id, 'e' || position AS etag, snippet_title, position % 2 = 0 AS assignable
           FROM items""",
    )
)
def read_reference_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents landed as files, read back and exploded; nothing is removed yet."""
    folder = new_folder(spark, "reference-files")
    _land(spark, _documents(spark, sf_dir), folder, 0)
    items = ref.explode_reference_items(read_documents(spark, folder))
    return items.select(
        "region",
        "id",
        "etag",
        F.col("snippet.title").alias("snippet_title"),
        F.col("snippet.assignable").alias("assignable"),
    )


# A landing is a whole: the last item of an id, by page and place, over all pages of a region.
_LANDED = with_(
    f"""{REFERENCE},
    unique_items AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY region, id ORDER BY position DESC) AS place FROM reference)
        WHERE place = 1
    )""",
    f"SELECT {_SILVER_COLUMNS} FROM unique_items",
)


def _silver_rows(spark: SparkSession, folder: str) -> DataFrame:
    table = spark.read.schema(schemas.SILVER_REFERENCE).parquet(folder)
    return table.drop("_ingestion_timestamp", "_source_file", "_extra")


@query(_LANDED)
def bronze_to_silver_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on files: an older landing, then all pages landed by forty tasks."""
    bronze, target = new_folder(spark, "reference-bronze"), new_folder(spark, "reference-silver")
    documents = _documents(spark, sf_dir)
    _land(spark, documents.withColumn("items", F.transform("items", lambda i: i.withField("id", F.lit("old")))), bronze, 0)
    _land(spark, documents, bronze, 1)
    run_reference(spark, bronze, target)
    return _silver_rows(spark, target)


@query(_LANDED)
def incremental_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of an older landing first, then a newer landing, which replaces the regions."""
    bronze, target, progress = (new_folder(spark, f"reference-{x}") for x in ("drops", "store", "progress"))
    documents = _documents(spark, sf_dir)
    older = documents.withColumn("items", F.transform("items", lambda i: i.withField("id", F.concat(F.lit("x"), i.id))))
    for day, drop in enumerate((older, documents)):
        _land(spark, drop, bronze, day)
        run_new_reference(spark, bronze, target, progress)
    return _silver_rows(spark, target)


@query(_LANDED)
def file_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices of an older landing and then of a newer one; every notice comes twice, and one names no file.

    The keys are URL-encoded. The landing folder is listed here to make the notices, and only here.
    """
    bronze, target, progress, told = (new_folder(spark, f"reference-{x}") for x in ("noticed", "store", "progress", "notices"))
    documents = _documents(spark, sf_dir)
    older = documents.withColumn("items", F.transform("items", lambda i: i.withField("id", F.concat(F.lit("x"), i.id))))
    for day, drop in enumerate((older, documents)):
        _land(spark, drop, bronze, day)
        files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(bronze)
        path = F.substring_index(files.metadataColumn("_metadata").getField("file_path"), f"{bronze.rsplit('/', 1)[-1]}/", -1)
        keys = files.select(F.url_encode(path).alias("key")).distinct()
        lost = inputs.table(spark, sf_dir, "region").select(F.url_encode(F.concat(F.lit("region="), F.lower("r_name"), F.lit("/lost.json"))).alias("key"))
        # Those of the first landing come again with the second.
        keys.unionByName(keys).unionByName(lost).write.mode("append").json(told)
        noticed_reference(spark, told, bronze, target, progress)
    return _silver_rows(spark, target)


@query(
    with_(
        REFERENCE,
        """SELECT region, id, snippet_title, position,
                  CASE WHEN region < 'c' THEN '{"grade":"' || position % 7 || '"}' END AS extra
           FROM reference WHERE region >= 'c' OR position % 2 = 1""",
    )
)
def overwrite_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of all regions first; then some regions are replaced by odd rows with a new column."""
    folder = new_folder(spark, "overwrite")
    rows = inputs.reference_rows(spark, sf_dir)
    write_partitions(rows, folder)
    item = F.to_json(F.struct("id", (F.col("position") % 7).cast("string").alias("grade")))
    odd = rows.filter((F.col("region") < "c") & (F.col("position") % 2 == 1))
    write_partitions(odd.withColumn("extra", ref.extra_fields(item)), folder)
    table = read_table(spark, path=folder, merge_schema=True)
    return table.select("region", "id", "snippet_title", "position", "extra")


@query(
    """SELECT 'schema' AS check_name, 'id, snippet.title' AS missing, false AS passed, NULL AS value
       UNION ALL SELECT 'row_count', NULL, count(*) >= 10, CAST(count(*) AS DOUBLE) FROM pages"""
)
def required_columns_warning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without the reference columns is warned about and still read."""
    pages = inputs.table(spark, sf_dir, "pages")
    warning = normalize.required_columns_warning(pages, ("id", "snippet.title"), "pages")
    read = quality.evaluate(pages, quality.row_count_check(pages, "pages", QualityRules()))
    report = warning.unionByName(read, allowMissingColumns=True)
    return report.select(
        F.col("check").alias("check_name"),
        F.array_join("missing_columns", ", ").alias("missing"),
        "passed",
        "value",
    )
