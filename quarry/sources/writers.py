"""Writers. CSV has a header, UTF-8, doubled quotes and untrimmed fields; nothing is written for an empty table."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.functions.schemas import COLUMNS

CSV = {"header": True, "emptyValue": "", "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in its form."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def write_table(df: DataFrame, path: str, table: str | None = None, form: str = "csv") -> bool:
    """K1: overwrites path with the contract's columns in order; False, and the old table stays, if there are no rows.

    The plan runs once: rows are counted while they are written aside, and the folder takes the table's name if there are any.
    """
    rows, seen = df.select(COLUMNS[table]) if table else df, Observation("written")
    folder, _, name = path.rstrip("/").rpartition("/")
    aside = f"{folder}/_{name}.{uuid.uuid4().hex}"  # readers of the folder pass over names that begin so
    writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write
    writer.csv(aside, **CSV) if form == "csv" else writer.format(form).save(aside)
    fs, at = file_system(df.sparkSession, aside)
    if not counted(seen):
        fs.delete(at, True)
        return False
    _, named = file_system(df.sparkSession, path)
    fs.delete(named, True)
    if not fs.rename(at, named):
        raise OSError(f"{path} could not be replaced")
    return True


def counted(seen: Observation) -> int:
    try:
        return seen.get.get("rows", 0)
    except Py4JError:  # Spark found the plan to be empty and dropped the count
        return 0


def write_pair(parent: DataFrame, child: DataFrame, parent_path: str, child_path: str, parent_table: str, child_table: str, shared: DataFrame | None = None, form: str = "csv") -> tuple[bool, bool]:
    """K2: parent and child from one parse; shared is the parsed input of both, held while both are written."""
    if shared is not None:
        shared.persist()
    try:
        return write_table(parent, parent_path, parent_table, form), write_table(child, child_path, child_table, form)
    finally:
        if shared is not None:
            shared.unpersist()


def batch_name(start: int | None = None, end: int | None = None, revised: bool = False) -> str:
    """K3: the name of a range's batch."""
    name = "revised" if revised else ""
    if start is not None and end is not None:
        name = f"{name}_{start}_{end}".lstrip("_")
    return name or "all"


def batch_path(root: str, entity: str, start: int | None = None, end: int | None = None, revised: bool = False) -> str:
    """K3: a batch's folder, named by its range, as a partition of column batch."""
    return f"{root.rstrip('/')}/{entity}/batch={batch_name(start, end, revised)}"


def batch_column(key: str, ranges: list[tuple[int, int]], revised: Column | None = None) -> Column:
    """K3: the batch that a row belongs to: that of the first range that holds its key, else `revised` where that holds, else `all`."""
    named = None
    for start, end in ranges:
        inside, name = F.col(key).between(start, end), F.lit(batch_name(start, end))
        named = F.when(inside, name) if named is None else named.when(inside, name)
    rest = F.lit(batch_name()) if revised is None else F.when(revised, F.lit(batch_name(revised=True))).otherwise(F.lit(batch_name()))
    return rest if named is None else named.otherwise(rest)


def write_batches(df: DataFrame, path: str, table: str | None = None, batch: str = "batch") -> None:
    """K3: rows of any number of batches (column batch) in one job. Batches that have rows here are replaced; all others keep their files."""
    rows = df.select(*COLUMNS[table], batch) if table else df
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(batch).csv(path, **CSV)


def write_partition(df: DataFrame, path: str, batch: str, table: str | None = None) -> None:
    """K3: one batch; nothing is replaced if there are no rows."""
    rows = df.select(COLUMNS[table]) if table in COLUMNS else df
    write_batches(rows.withColumn("batch", F.lit(batch)), path)


def publish(df: DataFrame, uri: str, form: str = "csv") -> None:
    """K4: writes the table at a fixed place of an object store or file system."""
    writer = df.write.mode("overwrite")
    writer.csv(uri, **CSV) if form == "csv" else writer.format(form).save(uri)


def write_clean(df: DataFrame, path: str, one_file: bool = False) -> bool:
    """K5: a consolidated table; one_file is for small exports only."""
    return write_table(df.coalesce(1) if one_file else df, path)


def append_ledger(fresh: DataFrame, path: str, key: str = "id") -> None:
    """K6: appends keys, a line each; fresh comes from new_failures."""
    fresh.select(F.col(key).cast("string").alias("value")).write.mode("append").text(path)


def write_revision_failures(failed: DataFrame, path: str, number: str = "quote", revision: str = "revision") -> None:
    """K7: overwrites the ledger of revisions, number and revision joined by a dash."""
    failed.select(F.concat_ws("-", F.col(number).cast("string"), F.col(revision).cast("string")).alias("value")).write.mode("overwrite").text(path)


def write_passthrough(parsed: DataFrame, path: str) -> bool:
    """K8: all top-level fields of the documents (column doc), in the order of their names; nested values as JSON. The fields are those of the merged schema, one small row."""
    shape = parsed.agg(F.schema_of_variant_agg("doc").alias("s")).first()["s"]
    names = top_fields(shape)
    if not names:
        return False
    # the name goes in as a quoted step of the path, as it may hold any character
    return write_table(parsed.select(*(F.try_variant_get("doc", f'$["{n}"]', "string").alias(n) for n in names)), path)


def top_fields(shape: str | None) -> list[str]:
    """Field names of OBJECT<a: ..., b: ...>, nested ones left out."""
    if not shape or not shape.startswith("OBJECT<"):
        return []
    out, depth, held = [], 0, ""
    for c in shape[7:-1] + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append(held.partition(":")[0].strip().strip("`"))
            held = ""
        else:
            held += c
    return [n for n in out if n]


#: Documents in a landed file at most.
LANDED_ROWS = 200_000


def land_documents(docs: DataFrame, path: str) -> None:
    """Documents (item_id, revision, body) as gzipped JSON lines, many to a file, for read_landed. A file is read by one task, so it ends at LANDED_ROWS."""
    docs.select("item_id", "revision", "body").write.option("maxRecordsPerFile", LANDED_ROWS).json(path, compression="gzip")
