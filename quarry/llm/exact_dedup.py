"""Exact dedup through a cuckoo-filter index of live digests (operator 7).

Texts are equal when identical after lower-casing A-Z. Each text becomes a SHA-256 digest where it lies; digests are
combined per input partition and dealt by digest, so a hot text sends one row per input partition, never one per copy.
Each partition of the digests is one shard of the index: a cuckoo filter of short tags, and buckets that hold the full keys
(digest and byte length). A digest that the filter doesn't know is new; a hit is verified against its buckets' keys. When an
insertion finds no room, the filter doubles and is refilled from the stored keys. Deletion removes key and tag.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import cut, free_name, is_empty, map_arrow, struct, with_row_bytes

#: Digests of a shard; one takes some 280 bytes in memory.
SHARD_ROWS = 400_000
CHANGE = struct(("digest", "binary"), ("n_bytes", "bigint"), ("keep_id", "bigint"), ("n", "bigint"), ("deleted", "boolean"))
LIVE = struct(("digest", "binary"), ("n_bytes", "bigint"), ("keep_id", "bigint"), ("n", "bigint"))


class CuckooFilter:
    """Buckets of four 16-bit tags; a digest's tag lies in one of two buckets. Keys are kept beside the tags."""

    SLOTS, KICKS = 4, 200

    def __init__(self, buckets: int = 64):
        self.mask = buckets - 1
        self.tags: list[list[int]] = [[] for _ in range(buckets)]
        self.keys: list[list[list]] = [[] for _ in range(buckets)]
        self.resizes = 0

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(digest[:2], "big") or 1
        first = int.from_bytes(digest[2:10], "big") & self.mask
        return tag, first, self._other(first, tag)

    def _other(self, bucket: int, tag: int) -> int:
        return bucket ^ ((tag * 0x5BD1E995) & self.mask)

    def find(self, digest: bytes, n_bytes: int) -> list | None:
        """The stored entry [digest, n_bytes, keep_id, n] of this key; tags only narrow the search."""
        tag, a, b = self._places(digest)
        for at in (a, b):
            if tag in self.tags[at]:
                for entry in self.keys[at]:
                    if entry[0] == digest and entry[1] == n_bytes:
                        return entry
        return None

    def insert(self, entry: list) -> None:
        while not self._place(entry):
            self._resize()

    def _place(self, entry: list) -> bool:
        tag, a, b = self._places(entry[0])
        for at in (a, b):
            if len(self.tags[at]) < self.SLOTS:
                self.tags[at].append(tag)
                self.keys[at].append(entry)
                return True
        at, moved = a, []
        for kick in range(self.KICKS):
            slot = kick % self.SLOTS
            tag, self.tags[at][slot] = self.tags[at][slot], tag
            entry, self.keys[at][slot] = self.keys[at][slot], entry
            moved.append((at, slot))
            at = self._other(at, tag)
            if len(self.tags[at]) < self.SLOTS:
                self.tags[at].append(tag)
                self.keys[at].append(entry)
                return True
        for at, slot in reversed(moved):  # no room: put all back, so that the caller can resize and try again
            tag, self.tags[at][slot] = self.tags[at][slot], tag
            entry, self.keys[at][slot] = self.keys[at][slot], entry
        return False

    def delete(self, digest: bytes, n_bytes: int) -> bool:
        tag, a, b = self._places(digest)
        for at in (a, b):
            for slot, entry in enumerate(self.keys[at]):
                if entry[0] == digest and entry[1] == n_bytes:
                    del self.keys[at][slot], self.tags[at][slot]
                    return True
        return False

    def _resize(self) -> None:
        stored = list(self.entries())
        grown = (self.mask + 1) * 2
        while True:
            self.mask, self.resizes = grown - 1, self.resizes + 1
            self.tags, self.keys = [[] for _ in range(grown)], [[] for _ in range(grown)]
            if all(self._place(entry) for entry in stored):
                return
            grown *= 2

    def entries(self) -> Iterator[list]:
        for bucket in self.keys:
            yield from bucket


def with_digest(df: DataFrame, text_col: str = "text", digest_col: str = "digest", bytes_col: str = "n_bytes", drop_text: bool = False) -> DataFrame:
    """df with the SHA-256 of each text (A-Z lower-cased, UTF-8; null: empty) and its byte length."""
    kept = [f for f in df.schema.fields if not (drop_text and f.name == text_col)]
    out = T.StructType([*kept, *struct((digest_col, "binary"), (bytes_col, "bigint")).fields])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b.lower() for b in with_row_bytes(batch.column(text_col))]
            added = [pa.array([hashlib.sha256(b).digest() for b in texts], pa.binary()), pa.array([len(b) for b in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *added], [*names, digest_col, bytes_col])

    return map_arrow(df, run, out)


def combined(rows: DataFrame, most: int = 200_000) -> DataFrame:
    """rows (doc_id, digest, n_bytes) as insertions, combined per partition: a map of at most `most` digests at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[bytes, int], list] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((list(c) for c in zip(*((d, n, k, c, False) for (d, n), (k, c) in seen.items()))), (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()))], CHANGE.names)
            seen.clear()
            return out

        for batch in batches:
            for doc, digest, n in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "digest", "n_bytes"))):
                entry = seen.setdefault((digest, n), [None, 0])
                entry[1] += 1
                if doc is not None and (entry[0] is None or doc > entry[0]):
                    entry[0] = doc
            if len(seen) >= most:
                yield flush()
        if seen:
            yield flush()

    return map_arrow(rows.select("doc_id", "digest", "n_bytes"), run, CHANGE)


def shards_for(spark: SparkSession, rows: int) -> int | None:
    """Shards that keep each at SHARD_ROWS digests or fewer, by and large; None where Spark's own number of partitions does."""
    needed = -(-rows // SHARD_ROWS)
    return needed if needed > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def apply_changes(changes: DataFrame, live: DataFrame | None = None, shards: int | None = None) -> DataFrame:
    """The live keys after the changes: one row (digest, n_bytes, keep_id, n) per live digest.

    A task holds the digests of its shard in memory; shards is their number (see shards_for), Spark's own if None.
    live holds the index so far (the result of an earlier call). A deletion removes its digest whole; deletions in a
    call are applied after its insertions. Insertions of one digest add up n and keep the largest keep_id; null ids count least.
    """
    if live is not None:
        changes = live.select(*LIVE.names, F.lit(False).alias("deleted")).unionByName(changes.select(*CHANGE.names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, gone = CuckooFilter(), []
        for batch in batches:
            for digest, n_bytes, keep_id, n, deleted in zip(*(batch.column(c).to_pylist() for c in CHANGE.names)):
                if deleted:
                    gone.append((digest, n_bytes))
                elif entry := index.find(digest, n_bytes):
                    entry[3] += n
                    if keep_id is not None and (entry[2] is None or keep_id > entry[2]):
                        entry[2] = keep_id
                else:
                    index.insert([digest, n_bytes, keep_id, n])
        for digest, n_bytes in gone:
            index.delete(digest, n_bytes)
        block: list[list] = []
        for entry in index.entries():
            block.append(entry)
            if len(block) == 10_000:
                yield rows_of(block)
                block = []
        if block:
            yield rows_of(block)

    def rows_of(block: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*block), (pa.binary(), pa.int64(), pa.int64(), pa.int64()))], LIVE.names)

    return map_arrow(changes.select(*CHANGE.names).repartition(*([shards] if shards else []), "digest"), run, LIVE)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty and equal each other and the empty text. Of equal texts the row with the largest id stays;
    null ids count as smaller than any. Rows that repeat both id and text are told apart by number: one of them stays.
    An empty table gives no rows; other columns are ignored.
    """
    rows = cut(with_digest(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")), drop_text=True), "digests")
    live = apply_changes(combined(rows), shards=shards_for(docs.sparkSession, rows.count())).withColumnRenamed("n", "group_size")
    # copies of one row (id and text both equal) become one row with a count; few, so that no hot key arises here
    same = rows.groupBy("doc_id", "digest", "n_bytes").count()
    out = same.join(live, ["digest", "n_bytes"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))))
    return out.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the copies that exact_groups drops; all columns stay, whatever their names.

    Null texts count as empty; of equal texts the row with the largest id stays, null ids least; of rows that repeat id and text one stays. An empty table stays one.
    """
    if is_empty(docs):
        return docs
    digest, size, number, l_digest, l_keep = (free_name(docs, n) for n in ("q_digest", "q_bytes", "q_number", "l_digest", "l_keep"))
    marked = with_digest(docs, text_col, digest, size)
    slim = cut(with_digest(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")), drop_text=True), "digests")
    live = apply_changes(combined(slim), shards=shards_for(docs.sparkSession, slim.count())).select(F.col("digest").alias(l_digest), F.col("keep_id").alias(l_keep))
    stay = marked.join(live, F.col(id_col).eqNullSafe(F.col(l_keep)) & (F.col(digest) == F.col(l_digest)), "left_semi")
    one = stay.withColumn(number, F.row_number().over(Window.partitionBy(id_col, digest).orderBy(id_col)))
    return one.filter(F.col(number) == 1).select(*docs.columns)
