"""What the operators of this subpackage share: tables, the shared folder, cutting lineage, Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a batch whose rows become Python objects at once.
BATCH_BYTES = 2 << 20
#: What small_batches lets Spark send to Python at once.
SENT_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """For jobs, not for operators: has Spark send at most SENT_ROWS rows and BATCH_BYTES bytes to Python at once from this session, as rows are whole texts and Python works beside the executor's heap."""
    for name, most in (("maxRecordsPerBatch", SENT_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        if not 0 < int(spark.conf.get(name).rstrip("bB")) <= most:
            spark.conf.set(name, str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is set, a local session gets a temporary one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: ends its lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def is_small(df: DataFrame, rows: int) -> bool:
    """Whether df has at most so many rows; reads no more than one row above that."""
    return df.limit(rows + 1).count() <= rows


def sized(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if its checked row count is at most rows, else unhinted (Spark then shuffles)."""
    return F.broadcast(df) if is_small(df, rows) else df


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores added until df has no such column (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batch: pa.RecordBatch, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most so many bytes, or of one row."""
    todo = [batch]
    while todo:
        part = todo.pop()
        if part.num_rows <= 1 or part.nbytes <= most:
            yield part
        else:
            half = part.num_rows // 2
            todo += [part.slice(half), part.slice(0, half)]


def map_arrow(df: DataFrame, run, schema: T.StructType) -> DataFrame:
    """df.mapInArrow, with batches cut to at most BATCH_BYTES before Python makes objects of them. What Spark sends at once is bounded by its own settings, see small_batches."""

    def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(part for batch in batches for part in slices(batch))

    return df.mapInArrow(in_parts, schema)


def with_row_bytes(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each string; null counts as empty."""
    return [b or b"" for b in col.cast(pa.large_binary()).to_pylist()]


TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "binary": T.BinaryType(), "boolean": T.BooleanType(), "double": T.DoubleType(), "float": T.FloatType()}


def struct(*fields: tuple[str, str]) -> T.StructType:
    """A schema from (name, type) pairs; needs no session. A type is one of TYPES or array<...> of one."""
    of = lambda kind: T.ArrayType(TYPES[kind[6:-1]]) if kind.startswith("array<") else TYPES[kind]
    return T.StructType([T.StructField(n, of(t), True) for n, t in fields])
