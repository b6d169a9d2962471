"""CSV batches: their files, the headers found by tasks, and the rows aligned by name."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a row gives for a cell that it lacks; an empty cell is null.
ABSENT = "\x01absent\x01"
#: Bytes read at first to find the end of a header; doubled until it is found.
HEAD = 65_536


def list_files(spark: SparkSession, paths: str | list[str], pattern: str = "*") -> DataFrame:
    """file, size, modified of the files that match: Spark's own listing, no contents."""
    found = spark.read.format("binaryFile").load(paths, pathGlobFilter=pattern)
    return found.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def first_record(text: str, whole: bool) -> list[str] | None:
    """The cells of the first CSV record, which may hold quoted line feeds; None if the text, the beginning of a file, ends within it."""
    quoted = False
    for i, sign in enumerate(text):
        if sign == '"':
            quoted = not quoted
        elif sign in "\r\n" and not quoted:
            return next(csv.reader(io.StringIO(text[:i], newline="")), [])
    return next(csv.reader(io.StringIO(text, newline="")), []) if whole else None


def header_of(uri: str) -> list[str] | None:
    """A file's header, from its first bytes only; None for an empty file."""
    fs, path = pafs.FileSystem.from_uri(uri if "://" in uri else uri.replace(":/", ":///", 1))
    held, more = b"", HEAD
    with fs.open_input_stream(path) as file:
        while True:
            read = file.read(more)
            held, more = held + read, len(held) + len(read)
            if not held:
                return None
            whole = len(read) == 0
            if cells := first_record(held.decode("utf-8-sig", "replace" if whole else "ignore"), whole):
                return cells
            if whole:
                return None


def read_headers(files: DataFrame) -> DataFrame:
    """file, header (array) of every file that isn't empty. Tasks read the heads, as many tasks as a shuffle has partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("file").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([header_of(n) for n in names], pa.list_(pa.string()))], ["file", "header"])

    # a list of files is small for what reading them costs, so its partitions are numbered, which keeps Spark from merging them
    dealt = files.select("file").repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file")
    return dealt.mapInArrow(run, "file string, header array<string>").filter("header IS NOT NULL")


def aligned(spark: SparkSession, paths: str | list[str], pattern: str, headers: DataFrame) -> DataFrame | None:
    """The rows of all files by their headers (file, header): every column that some header names, file, and _corrupt_record (a row that doesn't fit its header).

    The files are read once, as cells by place; a row learns the places of its columns by a join with its file's header. Only the distinct headers come to
    the driver. None where no file has a header; a header that names a column twice raises ValueError. headers should be a written table, as it is used twice.
    """
    shapes = [r.header for r in headers.select("header").distinct().collect()]
    if not shapes:
        return None
    for shape in shapes:
        if len(set(shape)) < len(shape):
            raise ValueError(f"a column is named twice: {shape}")
    names = list(dict.fromkeys(c for shape in sorted(shapes) for c in shape))
    width = max(map(len, shapes))
    mark = {"EXISTS_DEFAULT": f"'{ABSENT}'", "CURRENT_DEFAULT": f"'{ABSENT}'"}
    schema = T.StructType([*(T.StructField(f"_cell_{i}", T.StringType(), True, mark) for i in range(width)), T.StructField("_raw", T.StringType())])
    reader = spark.read.schema(schema).option("columnPruning", False)
    cells = reader.csv(paths, pathGlobFilter=pattern, header=True, multiLine=True, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_raw", enforceSchema=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    places = headers.select(F.col("file").alias("_file"), F.size("header").alias("_width"), F.array(*(F.nullif(F.array_position("header", F.lit(c)), F.lit(0)) for c in names)).alias("_places"))
    rows = cells.withColumn("file", F.col("_metadata.file_path")).join(places, F.col("file") == F.col("_file"))
    row = F.array(*(F.col(f"_cell_{i}") for i in range(width)))
    present = F.size(F.filter(row, lambda c: c.isNull() | (c != ABSENT)))
    # a row as wide as the widest header is kept as raw text only if it doesn't fit
    bad = (present != F.col("_width")) | ((F.col("_width") == width) & F.col("_raw").isNotNull())
    values = [F.nullif(F.get(row, F.get("_places", F.lit(i)).cast("int") - 1), F.lit(ABSENT)).alias(c) for i, c in enumerate(names)]
    return rows.select(*values, "file", F.when(bad, F.coalesce("_raw", F.array_join(row, ","))).alias("_corrupt_record"))
