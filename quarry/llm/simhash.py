"""SimHash near-duplicates by a segment-popcount embedding (operator 6).

A fingerprint's bit counts per two-bit segment make a point in 32 dimensions; the Manhattan distance of two points is at
most the Hamming distance of their fingerprints. The dimensions are dealt into groups, more by a number than bits may
differ: points within that distance agree in at least that number of whole groups, so they share a cell of one of the grids that fix so many groups.
Cells are joined by shuffling points to them; in a cell the Manhattan distance sorts pairs out, and the exact Hamming distance decides.
A cell sends a spanning forest of its links, not all pairs; a cell too large for one task is split into pairs of chunks.
Equal fingerprints are one point, so copies cost nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, free_name, is_empty, map_arrow, struct, with_row_bytes
from .components import components, salted_join

SEED, BITS, SEGMENTS = 42, 64, 32
LARGE_CELL, MOST_FIXED = 4096, 5
POINTS = struct(("cell", "bigint"), ("fp", "bigint"))
LINKS = struct(("cell", "bigint"), ("a", "bigint"), ("b", "bigint"))


def fingerprint(text: bytes, words: int) -> int:
    """Majority of the bits of all shingles' hashes, as a signed number."""
    found = text.lower().split()
    n = len(found)
    if not n:
        return 0
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    count = max(1, n - words + 1)
    digest = xxhash.xxh64_intdigest
    totals = np.zeros(BITS, np.int64)
    for at in range(0, count, 1 << 14):  # long texts in steps
        a, b = starts[at : min(at + (1 << 14), count)].tolist(), ends[min(at + words, n) - 1 :].tolist()
        hashes = np.fromiter((digest(joined[x:y], SEED) for x, y in zip(a, b)), np.uint64, len(a))
        totals += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * totals > count).view(">i8")[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", fp_col: str = "fp", words: int = 4, drop_text: bool = False) -> DataFrame:
    """docs with the fingerprint of each text (null: empty). Words are split at ASCII white space, A-Z lower-cased."""
    kept = [f for f in docs.schema.fields if not (drop_text and f.name == text_col)]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, words) for t in with_row_bytes(batch.column(text_col))]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(found, pa.int64())], [*names, fp_col])

    return map_arrow(docs, run, T.StructType([*kept, T.StructField(fp_col, T.LongType(), True)]))


def grids(n: int, most: int, least_fixed: int = 1) -> tuple[list[list[int]], list[tuple[int, ...]]]:
    """Groups of dimensions and the choices of groups that the grids fix: the fewest grids whose cells hold eight of n points on average, were they spread evenly, and that fix so many groups at least."""
    information = -math.log2(3 / 8)  # bits of one dimension: counts 0, 1, 2 come as 1, 2, 1
    for fixed in range(least_fixed, MOST_FIXED + 1):
        groups = np.array_split(np.arange(SEGMENTS), most + fixed)
        if n * 2 ** -(information * fixed * SEGMENTS / (most + fixed)) <= 8:
            break
    return [g.tolist() for g in groups], list(combinations(range(most + fixed), fixed))


def unary(fps: np.ndarray) -> np.ndarray:
    """The embedding with each count written in unary, so that the bits that differ between two points are their Manhattan distance."""
    high, low = (fps >> np.uint64(1)) & np.uint64(0x5555555555555555), fps & np.uint64(0x5555555555555555)
    return ((high & low) << np.uint64(1)) | high | low


def grid_points(fps: DataFrame, most: int, n: int, least_fixed: int = 1) -> DataFrame:
    """cell, fp: every fingerprint in one cell of each grid; where fps has cells already, in one cell within its own."""
    groups, choices = grids(n, most, least_fixed)
    masks = [sum(3 << (2 * d) for g in choice for d in groups[g]) for choice in choices]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy()
            points = unary(values.view(np.uint64))
            outer = batch.column("cell").to_numpy().view(np.uint64) * np.uint64(0xD6E8FEB86659FD93) if within else np.uint64(0)
            for grid, mask in enumerate(masks):
                cell = (points & np.uint64(mask)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(grid) + outer
                yield pa.RecordBatch.from_arrays([pa.array((cell ^ (cell >> np.uint64(29))).view(np.int64)), pa.array(values)], POINTS.names)

    within = "cell" in fps.columns
    return map_arrow(fps.select("fp", "cell") if within else fps.select("fp"), run, POINTS)


def forest(points: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links among distinct fingerprints of a cell that connect what all of its links connect."""
    n = len(points)
    fps = points.view(np.uint64)
    embedded = unary(fps)
    label = np.arange(n)
    out = []
    for at in range(0, n, 128):
        near = np.bitwise_count(embedded[at : at + 128, None] ^ embedded[None, :]) <= most  # the lower bound
        i, j = np.nonzero(near)
        i, j = i[i + at < j], j[i + at < j]
        exact = np.bitwise_count(fps[i + at] ^ fps[j]) <= most
        for a, b in zip((i[exact] + at).tolist(), j[exact].tolist()):
            while label[a] != a:
                label[a] = a = label[label[a]]
            while label[b] != b:
                label[b] = b = label[label[b]]
            if a != b:
                label[max(a, b)] = min(a, b)
                out.append((a, b))
    return [(int(points[a]), int(points[b])) for a, b in out]


def cell_links(points: DataFrame, most: int, large: int) -> DataFrame:
    """Links a, b of each cell; cells of more than `large` points come back as rows with a null b, to be split. points are dealt and sorted by cell here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, over = None, [], False

        def done() -> list[tuple]:
            if over or not held:
                return []
            own = np.unique(np.concatenate(held))
            return [(cell, a, b) for a, b in forest(own, most)] if len(own) > 1 else []

        for batch in batches:
            cells, fps = batch.column("cell").to_numpy(), batch.column("fp").to_numpy()
            cuts = np.flatnonzero(np.diff(cells)) + 1
            rows = []
            for a, b in zip(np.append(0, cuts).tolist(), np.append(cuts, len(cells)).tolist()):
                if cells[a] != cell:
                    rows += done()
                    cell, held, over = int(cells[a]), [], False
                held.append(fps[a:b])
                if over or sum(map(len, held)) > large:
                    rows += [(cell, int(x), None) for part in held for x in part]
                    held, over = [], True
            if rows:
                yield linked(rows)
        if rows := done():
            yield linked(rows)

    def linked(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows)], LINKS.names)

    return map_arrow(points.repartition("cell").sortWithinPartitions("cell"), run, LINKS)


def links(fps: DataFrame, most: int = 4, large: int = LARGE_CELL) -> DataFrame:
    """a, b: links that connect all fingerprints at most `most` bits apart. fps: distinct column fp."""
    n = fps.count()
    found = cut(cell_links(grid_points(fps, most, n), most, large), "links")
    left = found.filter("b IS NULL").selectExpr("cell", "a AS fp")
    out = found.filter("b IS NOT NULL").select("a", "b")
    if is_empty(left):
        return out
    # large cells: a finer grid within each, as its points still agree in enough groups of one of the choices
    finer = cut(cell_links(grid_points(left, most, n, least_fixed=MOST_FIXED), most, large), "links")
    out = out.unionByName(finer.filter("b IS NOT NULL").select("a", "b"))
    left = finer.filter("b IS NULL").selectExpr("cell", "a AS fp")
    if is_empty(left):
        return out
    # cells that are still large: chunks by hash, one task per pair of chunks, so that every pair of points still meets
    counts = left.groupBy("cell").agg(F.ceil(F.count("*") * 4 / large).cast("int").alias("chunks"))
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    dealt = left.join(counts, "cell").select("cell", "fp", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    dealt = dealt.select(F.xxhash64("cell", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"), "fp")
    return out.unionByName(cell_links(dealt, most, 1 << 62).select("a", "b"))


def near_groups(prints: DataFrame, most: int = 4) -> DataFrame:
    """fp, component_id of every fingerprint in prints (doc_id, fp); component_id is the smallest doc_id reachable; doc_id may be of any ordered type."""
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    roots = components(links(distinct, most)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    linked = salted_join(rooted, least, "root", "fp").select("fp", "least")
    return distinct.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))


def simhash_groups(docs: DataFrame, words: int = 4, most: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id. Null texts count as empty (fingerprint zero, linked like any other); null ids count last; repeated rows stay."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    prints = cut(with_fingerprint(rows, words=words, drop_text=True), "prints")
    # the groups are written before the join, so that Spark can split the partition of a frequent fingerprint
    return prints.join(cut(near_groups(prints, most), "groups"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, words: int = 4, most: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component, that with the smallest id (null ids last, ties by the text's hash); columns as they were.

    Each row has a number of its own, so rows that share an id, or have none, are told apart.
    """
    fp, number = free_name(docs, "q_fp"), free_name(docs, "q_number")
    marked = cut(with_fingerprint(docs, text_col, fp, words).withColumn(number, F.monotonically_increasing_id()), "marked")
    key = F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text_col).alias("hash"), F.col(number).alias("number"))
    groups = near_groups(marked.select(key.alias("doc_id"), F.col(fp).alias("fp")), most)
    stay = groups.select(F.col("component_id.number").alias(number)).distinct()
    return marked.join(stay, number, "left_semi").select(*docs.columns)
