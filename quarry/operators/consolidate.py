"""Overlapping batches to one clean table."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import columns as C
from quarry.operators.accounting import Counted
from quarry.sources.batches import aligned, list_files, read_headers
from quarry.sources.readers import read_batches
from quarry.sources.scratch import staged
from quarry.sources.writers import exists, file_system, write_clean, write_table

FILES = "file string, size bigint, modified timestamp"
MERGED = "outcome string, files bigint, rows_in bigint, rows_added bigint"


def strings_of(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t == "string"]


def trim_all(df: DataFrame) -> DataFrame:
    """U4: every string column stripped of white space of any script."""
    return df.withColumns({c: C.stripped(F.col(c)) for c in strings_of(df)})


def na_to_null(df: DataFrame) -> DataFrame:
    """U8: null for cells that count as missing; belongs before trim_all, so that a padded blank becomes an empty string."""
    return df.withColumns({c: C.na_to_null(F.col(c)) for c in strings_of(df)})


def union_batches(batches: list[DataFrame]) -> DataFrame:
    """All rows, aligned by column name, null where a batch lacks a column."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def dedup_rows(df: DataFrame, blank_as_null: bool = False) -> DataFrame:
    """Distinct rows, null equal to null; blank_as_null makes empty strings null first."""
    if blank_as_null:
        df = df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in strings_of(df)})
    return df.dropDuplicates()


def drop_bad_files(df: DataFrame, file_col: str = "file", corrupt_col: str = "_corrupt_record") -> DataFrame:
    """Without all rows of files that have an unreadable row; such files are few, so Spark may broadcast them by their size."""
    bad = df.filter(F.col(corrupt_col).isNotNull()).select(file_col).distinct()
    return df.join(bad, file_col, "left_anti").drop(corrupt_col)


def validate_columns(df: DataFrame, expected: list[str]) -> DataFrame:
    """Df, if it has exactly the expected columns in any order."""
    if set(df.columns) != set(expected):
        raise ValueError(f"column mismatch: expected {sorted(expected)}, got {sorted(df.columns)}")
    return df


def dedup_keys(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the last by order (ties by all columns); map-side combined, so hot keys shrink before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order, *(F.col(c) for c in rest))
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("row"))
    return best.select(*keys, *(F.col("row")[c].alias(c) for c in rest)).select(df.columns)


def clean(batches: list[DataFrame], blank_as_null: bool = False) -> DataFrame:
    """The middle of U7: missing cells, trimming, union, distinct rows."""
    return dedup_rows(union_batches([trim_all(na_to_null(b)) for b in batches]), blank_as_null)


def consolidate(spark: SparkSession, tables: list[tuple[str, str, str, str]], blank_as_null: bool = False) -> DataFrame:
    """The job over a list of tables (name, folder, file pattern, target): S5, U5, U4 and U8, U2, U3, K5 for each.

    A table without files is skipped; one that fails leaves the others alone. Returns name, outcome (merged, empty, skipped or failed), detail: a row per table.
    """
    outcomes = []
    for name, folder, pattern, target in tables:
        try:
            rows = drop_bad_files(read_batches(spark, folder, pattern)).drop("file")
            outcomes.append((name, "merged" if write_clean(clean([rows], blank_as_null), target) else "empty", target))
        except FileNotFoundError as absent:
            outcomes.append((name, "skipped", str(absent)))
        except Exception as error:  # one table's fault must not stop the others
            outcomes.append((name, "failed", str(error).splitlines()[0]))
    return spark.createDataFrame(outcomes, "name string, outcome string, detail string")


def consolidate_new(spark: SparkSession, folder: str, pattern: str, root: str, key: str, blank_as_null: bool = False) -> DataFrame:
    """U7 by increments: the clean table below root/clean, as Parquet, brought up to date with the batch files of a folder.

    root/consumed names the files that it holds (file, size, modified). A run reads new files only, and adds the rows that the table doesn't hold yet; of the
    table it reads the range of keys in which the new rows lie. If a consumed file has changed or gone, everything is read anew, as rows can't be
    taken out again. The table equals that of a full run. A run that broke off is made good by the next: files are consumed when their rows are in.
    Returns one row: outcome (nothing, added, rebuilt), files (read), rows_in (all of those files' rows but of bad files), rows_added.
    """
    table, consumed = f"{root}/clean", f"{root}/consumed"
    files = staged(list_files(spark, folder, pattern), "files") if exists(spark, folder) else spark.createDataFrame([], FILES)
    known = spark.read.schema(FILES).parquet(consumed) if exists(spark, consumed) else spark.createDataFrame([], FILES)
    same = [F.col(f"f.{c}") == F.col(f"k.{c}") for c in ("file", "size", "modified")]
    rebuilt = not known.alias("k").join(files.alias("f"), same, "left_anti").isEmpty()
    fresh = files if rebuilt else staged(files.alias("f").join(known.alias("k"), same, "left_anti"), "files")
    paths = [r.file for r in fresh.select("file").toLocalIterator()]  # Spark's reader takes the paths of what it reads from the driver
    rows_in, rows_added = Counted("rows_in"), Counted("rows_added")
    headers = staged(read_headers(fresh), "headers")
    read = aligned(spark, [unquote(p) for p in paths], "*", headers) if paths else None
    if read is None and not rebuilt:
        if paths:
            fresh.write.mode("append").parquet(consumed)
        return spark.createDataFrame([("nothing", len(paths), 0, 0)], MERGED)
    if read is not None:
        rows = staged(clean([rows_in.on(drop_bad_files(read).drop("file"))], blank_as_null), "rows")
        if not rebuilt and exists(spark, table):
            rows = not_in(rows, spark.read.option("mergeSchema", True).parquet(table), key)
        rows = staged(rows_added.on(rows), "rows")  # ranges are found by a pass of its own, so the rows stand written
        ordered = rows.repartitionByRange(F.col(key)).sortWithinPartitions(key)
    if rebuilt and (read is None or not write_table(ordered, table, form="parquet")):
        fs, at = file_system(spark, table)
        fs.delete(at, True)
    elif not rebuilt:
        ordered.write.mode("append").parquet(table)
    if rebuilt:
        write_table(fresh, consumed, form="parquet") or file_system(spark, consumed)[0].delete(file_system(spark, consumed)[1], True)
    else:
        fresh.write.mode("append").parquet(consumed)
    return spark.createDataFrame([("rebuilt" if rebuilt else "added", len(paths), rows_in.rows, rows_added.rows)], MERGED)


def not_in(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The rows that a table doesn't hold, null equal to null and a column that either lacks null; only the range of the rows' keys is read of the table."""
    low, high, unkeyed = rows.agg(F.min(key), F.max(key), F.max(F.col(key).isNull())).first()
    inside = F.lit(False) if low is None else F.col(key).between(low, high)
    held = table.filter(inside | F.col(key).isNull() if unkeyed else inside) if key in table.columns else table
    names = sorted({*rows.columns, *held.columns})
    a, b = (d.select(*(F.col(f"`{n}`") if n in d.columns else F.lit(None).cast("string").alias(n) for n in names)) for d in (rows, held))
    a, b = a.alias("a"), b.alias("b")
    return a.join(b, [F.col(f"a.`{n}`").eqNullSafe(F.col(f"b.`{n}`")) for n in names], "left_anti")


def merge(batches: list[DataFrame], path: str, blank_as_null: bool = False) -> DataFrame:
    """U2-U4, U8, K5 and L8 in one pass: writes the clean table and returns rows_in and rows_out, counted on the way."""
    rows_in, rows_out = Counted("rows_in"), Counted("rows_out")
    write_clean(rows_out.on(clean([rows_in.on(union_batches(batches))], blank_as_null)), path)
    return batches[0].sparkSession.createDataFrame([(rows_in.rows, rows_out.rows)], "rows_in bigint, rows_out bigint")


def merge_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before and after consolidation, in one row."""
    counts = before.agg(F.count("*").alias("n")).select(F.lit("rows_in").alias("k"), "n").unionByName(after.agg(F.count("*").alias("n")).select(F.lit("rows_out").alias("k"), "n"))
    return counts.agg(F.max(F.when(F.col("k") == "rows_in", F.col("n"))).alias("rows_in"), F.max(F.when(F.col("k") == "rows_out", F.col("n"))).alias("rows_out"))
