"""Live tables (W1, W2, S7) and their publication (K4): changes are appended, a job folds them into buckets by key.

A table is what its newest manifest names: buckets of whole rows, and batches of changes since they were made. A batch writes its own rows and a manifest, a small file that is made only
if no file has its name, so nothing is renamed, and readers see the table with the batch or without it. The number of buckets follows from the rows: by linear hashing it grows one by
one, and a new bucket takes its rows from one other.
"""

from __future__ import annotations

import json
import math

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.events import upsert
from quarry.sources.writers import CSV, file_system

#: Rows of a bucket, on average, and batches of changes that are folded in together.
BUCKET_ROWS, FOLD_AFTER = 1_000_000, 16


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the manifests, ascending."""
    fs, at = file_system(spark, f"{path}/manifests")
    if not fs.exists(at):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def read_manifest(spark: SparkSession, path: str, version: int) -> dict | None:
    """None if its writer stopped halfway: a whole one ends with a line feed."""
    fs, at = file_system(spark, f"{path}/manifests/{version}.json")
    stream = fs.open(at)
    try:
        text = bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
    return json.loads(text) if text.endswith("\n") else None


def newest(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    """Number and content of the newest whole manifest."""
    for version in reversed(versions(spark, path)):
        if found := read_manifest(spark, path, version):
            return version, found
    return None


def commit(spark: SparkSession, path: str, version: int, content: dict) -> None:
    """Makes a manifest; OSError if another writer has made a whole one of that number."""
    fs, at = file_system(spark, f"{path}/manifests/{version}.json")
    broken = fs.exists(at) and read_manifest(spark, path, version) is None
    try:
        stream = fs.create(at, bool(broken))
    except Py4JJavaError as error:
        raise OSError(f"version {version} of {path} is there already") from error
    stream.write(bytearray((json.dumps(content) + "\n").encode()))
    stream.close()


def current_batch(spark: SparkSession, path: str) -> int | None:
    """The last batch that the table holds."""
    found = newest(spark, path)
    return found[1]["batch"] if found else None


def bucket_of(keys: list[str], buckets: int) -> Column:
    """Linear hashing: with 2^l to 2^(l+1) buckets, the last l + 1 bits of the key's hash if there is such a bucket, else the last l."""
    low = 1 << int(math.log2(buckets))
    hashed = F.xxhash64(*(F.col(k).cast("string") for k in keys))
    wide = F.pmod(hashed, F.lit(2 * low))
    return F.when(wide < buckets, wide).otherwise(F.pmod(hashed, F.lit(low))).cast("int")


def parent(bucket: int) -> int:
    """The bucket that a new one takes its rows from."""
    return bucket - (1 << int(math.log2(bucket)))


def append(df: DataFrame, path: str, batch: int, keys: list[str]) -> bool:
    """A batch of changes: per key its row of the highest seq. Writes these rows and a manifest, whatever the table's size. False, and nothing happens, if the table has that batch."""
    spark = df.sparkSession
    version, held = newest(spark, path) or (0, {"batch": None, "keys": keys, "buckets": 1, "rows": {}, "changes": [], "schema": None})
    if held["batch"] is not None and held["batch"] >= batch:
        return False
    upsert(None, df, keys).write.mode("overwrite").parquet(f"{path}/changes/batch={batch}")
    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    commit(spark, path, version + 1, held | {"batch": batch, "changes": [*held["changes"], batch], "schema": schema})
    return True


def base_rows(spark: SparkSession, path: str, held: dict, buckets: set[int] | None = None) -> DataFrame | None:
    paths = [f"{path}/base/v={v}/bucket={b}" for b, (v, _) in held["rows"].items() if buckets is None or int(b) in buckets]
    return spark.read.schema(held["schema"]).parquet(*paths) if paths else None


def changed_rows(spark: SparkSession, path: str, held: dict, batches: list[int] | None = None) -> DataFrame | None:
    paths = [f"{path}/changes/batch={b}" for b in (held["changes"] if batches is None else batches)]
    return spark.read.schema(held["schema"]).parquet(*paths) if paths else None


def read_live(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as the newest manifest names it; None before the first."""
    found = newest(spark, path)
    if not found:
        return None
    base, changes = base_rows(spark, path, found[1]), changed_rows(spark, path, found[1])
    return base if changes is None else upsert(base, changes, found[1]["keys"])


def fold(spark: SparkSession, path: str, bucket_rows: int = BUCKET_ROWS) -> bool:
    """The job that folds changes into the buckets of their keys, and splits as many buckets as the rows call for, at most doubling them. Others stay. False if there are no changes."""
    found = newest(spark, path)
    if not found or not found[1]["changes"]:
        return False
    version, held = found
    keys, before = held["keys"], held["buckets"]
    changes = changed_rows(spark, path, held)
    rows = sum(n for _, n in held["rows"].values()) + changes.count()
    buckets = min(max(before, math.ceil(rows / bucket_rows)), 2 * before) if held["rows"] else max(1, math.ceil(rows / bucket_rows))
    touched = {r[0] for r in changes.select(bucket_of(keys, buckets)).distinct().collect()}  # at most one number per bucket
    read = {b for b in touched if b < before} | {p for b in range(before, buckets) for p in [ancestor(b, before)]}
    merged = upsert(base_rows(spark, path, held, read), changes, keys)
    merged.withColumn("bucket", bucket_of(keys, buckets)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/base/v={version + 1}")
    made = spark.read.parquet(f"{path}/base/v={version + 1}").groupBy("bucket").count().collect()
    kept = {b: x for b, x in held["rows"].items() if int(b) not in read}
    commit(spark, path, version + 1, held | {"buckets": buckets, "changes": [], "rows": kept | {str(r["bucket"]): [version + 1, r["count"]] for r in made}})
    return True


def ancestor(bucket: int, before: int) -> int:
    while bucket >= before:
        bucket = parent(bucket)
    return bucket


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Deletes what the last `keep` manifests don't name; who still reads an older one must read again."""
    all_versions = versions(spark, path)
    manifests = [m for v in all_versions[-keep:] if (m := read_manifest(spark, path, v))]
    used = {f"base/v={v}/bucket={b}" for m in manifests for b, (v, _) in m["rows"].items()} | {f"changes/batch={b}" for m in manifests for b in m["changes"]}
    old = [m for v in all_versions[:-keep] if (m := read_manifest(spark, path, v))]
    unused = {f"base/v={v}/bucket={b}" for m in old for b, (v, _) in m["rows"].items()} | {f"changes/batch={b}" for m in old for b in m["changes"]}
    for name in [*sorted(unused - used), *(f"manifests/{v}.json" for v in all_versions[:-keep])]:
        fs, at = file_system(spark, f"{path}/{name}")
        fs.delete(at, True)


def publish_live(spark: SparkSession, path: str, uri: str, columns: list[str]) -> int:
    """K4: a live table's columns as CSV at a fixed place, rows in the order of seq within a bucket. Only buckets that changed since the last publication are written, then one manifest.

    Returns the number of buckets written. Readers of read_published see the old or the new table.
    """
    found = newest(spark, path)
    if not found:
        return 0
    held = found[1]
    version, known = newest(spark, uri) or (0, {"source": {}, "changes": [], "parts": {}, "buckets": held["buckets"]})
    keys, buckets = held["keys"], held["buckets"]
    fresh = changed_rows(spark, path, held, [b for b in held["changes"] if b not in known["changes"]])
    dirty = {int(b) for b, (v, _) in held["rows"].items() if known["source"].get(b) != v}
    dirty |= set() if fresh is None else {r[0] for r in fresh.select(bucket_of(keys, buckets)).distinct().collect()}
    if not dirty:
        return 0
    base, changes = base_rows(spark, path, held, dirty), changed_rows(spark, path, held)
    rows = base if changes is None else upsert(base, changes.filter(bucket_of(keys, buckets).isin(list(dirty))), keys)
    rows = rows.withColumn("bucket", bucket_of(keys, buckets)).repartition("bucket").sortWithinPartitions("bucket", "seq").select(*columns, "bucket")
    rows.write.mode("overwrite").partitionBy("bucket").csv(f"{uri}/data/v={version + 1}", **CSV)
    fs, at = file_system(spark, f"{uri}/data/v={version + 1}")
    made = [n.removeprefix("bucket=") for f in fs.listStatus(at) if (n := f.getPath().getName()).startswith("bucket=")]
    parts = {b: v for b, v in known["parts"].items() if int(b) not in dirty} | {b: version + 1 for b in made}
    commit(spark, uri, version + 1, {"source": {b: v for b, (v, _) in held["rows"].items()}, "changes": held["changes"], "parts": parts, "buckets": buckets, "columns": columns})
    return len(dirty)


def read_published(spark: SparkSession, uri: str) -> DataFrame | None:
    """The published table, as strings."""
    found = newest(spark, uri)
    if not found or not found[1]["parts"]:
        return None
    held = found[1]
    paths = [f"{uri}/data/v={v}/bucket={b}" for b, v in held["parts"].items()]
    return spark.read.schema(", ".join(f"`{c}` string" for c in held["columns"])).csv(paths, header=True, multiLine=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
