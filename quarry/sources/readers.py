"""Readers of landed documents, pages, batches, snapshots, ledgers and the relationship model. All paths are Spark paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.schemas import RELATIONSHIP
from quarry.sources.batches import aligned, list_files, read_headers
from quarry.sources.scratch import staged

EVENT = "seq bigint, token string, signature string, body string"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """item_id, revision, body of landed JSON bodies, a file each, named id.json or id-revision.json."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)(?:-(\d+))?\.json$", 1), F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)(?:-(\d+))?\.json$", 2)
    return files.select(F.nullif(name[0], F.lit("")).cast("bigint").alias("item_id"), F.nullif(name[1], F.lit("")).alias("revision"), F.col("value").alias("body"))


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """item_id, revision, body of documents landed as JSON lines, many to a file."""
    return spark.read.schema("item_id bigint, revision string, body string").json(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page, body of landed listing pages, a file each; page is the number in the file's name."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.json")
    return files.select(F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.json$", 1).cast("bigint").alias("page"), F.col("value").alias("body"))


def read_revision_index(spark: SparkSession, path: str) -> DataFrame:
    """S3: quote, revision; a JSON list or an object per line."""
    return spark.read.schema("quote bigint, revision bigint").json(path, multiLine=True).select("quote", "revision")


def read_batches(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """CSV files with headers, all columns strings, aligned by name; with file and _corrupt_record (a row that doesn't fit its header).

    path is a folder, or a list of files. Tasks read the headers from the files' first bytes; the rows are read once. Empty files count for nothing.
    Raises FileNotFoundError where no file matches or all are empty.
    """
    from quarry.sources.writers import exists

    if isinstance(path, str) and not exists(spark, path):
        raise FileNotFoundError(f"no folder {path}")
    headers = staged(read_headers(list_files(spark, path, pattern)), "headers")
    if (rows := aligned(spark, path, pattern, headers)) is None:
        raise FileNotFoundError(f"no file with a header matches {pattern} in {path}")
    return rows


def read_events(spark: SparkSession, path: str, schema: str = EVENT, files_per_trigger: int = 100) -> DataFrame:
    """A stream of event rows from JSON lines as they land."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of a live table, or None before the first."""
    from quarry.sources.live_tables import read_live

    return read_live(spark, path)


def read_ledger(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """Trimmed, filled lines of a failure ledger; empty where there is none yet."""
    from quarry.sources.writers import exists

    if not exists(spark, path):
        return spark.createDataFrame([], f"{key} string")
    return spark.read.text(path).select(F.trim("value").alias(key)).filter(f"{key} <> ''")


def read_relationships(spark: SparkSession, path: str) -> DataFrame:
    """The relationship model, typed."""
    return spark.read.schema(RELATIONSHIP).csv(path, header=True)
