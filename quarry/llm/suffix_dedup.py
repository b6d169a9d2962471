"""Removal of repeated byte strings by ranks of sampled suffixes (operator 9).

A string of 400 bytes is repeated if it starts anywhere else. Suffixes are ranked at growing lengths and unique ones dropped, as in
prefix doubling, but from a sample of positions that the content itself chooses: the least hash of the next 320 16-byte strings.
Equal strings choose alike, so positions with one choice form a block, ranked as one:
1. by the 81 bytes from the chosen position, which every string of the block holds: unique ones are done;
2. by the whole block with the 400 bytes of its last string: repeated ones are done, all their strings are repeated;
3. the rest, at the edges of repeats, by each of their 400-byte strings among blocks of equal first rank, sorted by
   what stands before the chosen position. Strings that agree to the left are neighbours, so only those that agree with the end of a batch stay undecided; they
   are sorted by what follows, and what is then still undecided is counted by its digest.
Ranks of 1 are names by a polynomial hash, which only has to bring equal strings together; steps 2 and 3 compare BLAKE2b digests of 128 bits, as no one can make two
strings of one digest. Blocks of a periodic passage repeat their neighbours: all but two become one row, so equal bytes don't make a block per byte. Matches never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, is_empty, map_arrow, struct, with_row_bytes

LENGTH, CHOICE, GRAM = 400, 320, 16
STEM = LENGTH - CHOICE + 1
PIECE, BATCH_BYTES = 1 << 19, 1 << 21
STEMS = struct(("stem", "bigint"))
BLOCKS = struct(("stem", "bigint"), ("b1", "bigint"), ("b2", "bigint"), ("doc_id", "bigint"), ("key", "bigint"), ("start", "bigint"), ("n", "int"), ("offset", "int"))
CONTEXTS = struct(("stem", "bigint"), ("doc_id", "bigint"), ("key", "bigint"), ("start", "bigint"), ("n", "int"), ("left", "binary"), ("mid", "binary"), ("right", "binary"))
EDGES = struct(("stem", "bigint"), ("doc_id", "bigint"), ("key", "bigint"), ("start", "bigint"), ("starts", "array<bigint>"), ("ends", "array<bigint>"), ("open", "binary"), ("done", "binary"), ("h1", "bigint"), ("h2", "bigint"), ("place", "bigint"))
KEPT = struct(("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string"))


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hashes of byte strings out of sums over all bytes before, for whole arrays of bounds. Equal strings have equal hashes; unlike ones may be made to collide."""

    BASE = 0x5851F42D4C957F2D

    def __init__(self):
        self.values = scrambled(np.arange(256, dtype=np.uint64) + np.uint64(1000))
        self.powers = self.inverse = np.zeros(0, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.powers) < n:
            steps = np.full((2, max(n, PIECE + 2 * LENGTH)), self.BASE, np.uint64)
            steps[1] = pow(self.BASE, -1, 1 << 64)
            steps[:, 0] = 1
            self.powers, self.inverse = np.multiply.accumulate(steps, axis=1)

    def sums(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        self.grow(n + 1)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[:n], out=out[1:])
        return out

    def of(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return scrambled((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two numbers each: BLAKE2b of the bytes between the bounds."""
    view = memoryview(data)
    found = b"".join(hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist()))
    return np.frombuffer(found, np.int64).reshape(-1, 2)


def least_of_next(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours: of running minima from the left and the right in blocks of that width."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    rows = padded.reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return np.minimum(right[:count], left[width - 1 : width - 1 + count])


def blocks(text: bytes, hasher: Hasher, stems_only: bool = False) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each piece of a text: stem, both halves of the block's digest, start and number of positions of its blocks, and the place of the choice in it.

    Of neighbours that are equal, the first two come; the others, whose strings are all repeated, come as one row with the place -1.
    """
    for at in range(0, len(text) - LENGTH + 1, PIECE):
        data = np.frombuffer(text, np.uint8, min(PIECE + LENGTH - 1, len(text) - at), at)
        count = len(data) - LENGTH + 1
        sums = hasher.sums(data)
        grams = np.arange(count + CHOICE - 1)
        keys = (hasher.of(sums, grams, grams + GRAM) & np.uint64(0xFFFFFFFF00000000)) | grams.astype(np.uint64)
        chosen = (least_of_next(keys, CHOICE) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.flatnonzero(np.diff(chosen, prepend=-1))
        chosen = chosen[starts]
        stem = hasher.of(sums, chosen, chosen + STEM).view(np.int64)
        if stems_only:
            again = np.zeros(len(stem), bool)  # that a stem has more than two holders in a row tells no more
            again[2:] = (stem[2:] == stem[1:-1]) & (stem[1:-1] == stem[:-2])
            yield (stem[~again],)
            continue
        n = np.diff(starts, append=count)
        ends = starts + n - 1 + LENGTH
        again = equal_to_previous(data, hasher.of(sums, starts, ends), starts, n, ends, chosen - starts)
        again[1:] &= again[:-1].copy()
        kept = np.flatnonzero(~again)
        whole = digests(data, starts[kept], ends[kept])
        yield stem[kept], whole[:, 0], whole[:, 1], starts[kept] + at, n[kept], (chosen - starts)[kept]
        if again.any():
            first = np.flatnonzero(again & ~np.append(False, again[:-1]))
            last = np.flatnonzero(again & ~np.append(again[1:], False))
            nothing = np.zeros(len(first), np.int64)
            yield stem[first], nothing, nothing, starts[first] + at, starts[last] + n[last] - starts[first], nothing - 1


def equal_to_previous(data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, n: np.ndarray, ends: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Whether each block equals the one before, by its bytes; the hash only tells where to look."""
    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (n[1:] == n[:-1]) & (offset[1:] == offset[:-1])
    first = np.flatnonzero(again & ~np.append(False, again[:-1]))
    last = np.flatnonzero(again & ~np.append(again[1:], False))
    for a, b in zip(first.tolist(), last.tolist()):  # all blocks from a - 1 to b are equal if these bytes have the period n
        low, high, period = starts[a - 1], ends[b], n[a]
        if not np.array_equal(data[low : high - period], data[low + period : high]):
            again[a : b + 1] = False
    return again


def all_stems(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for text in with_row_bytes(batch.column("text")):
                for (stem,) in blocks(text, hasher, True):
                    yield pa.RecordBatch.from_arrays([pa.array(stem)], STEMS.names)

    return map_arrow(docs.select("text"), merged(run), STEMS)


def all_blocks(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for doc, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), with_row_bytes(batch.column("text"))):
                for stem, b1, b2, start, n, offset in blocks(text, hasher):
                    same = lambda v: pa.array([v], pa.int64()).take(pa.array(np.zeros(len(stem), np.int64)))  # noqa: B023, E731
                    yield pa.RecordBatch.from_arrays([pa.array(stem), pa.array(b1), pa.array(b2), same(doc), same(key), pa.array(start), pa.array(n.astype(np.int32)), pa.array(offset.astype(np.int32))], BLOCKS.names)

    return map_arrow(docs.select("doc_id", "key", "text"), merged(run), BLOCKS)


def merged(run, most: int = 20_000):
    """run with its small batches put together."""

    def larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= most:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return larger


def contexts(edges: DataFrame, docs: DataFrame) -> DataFrame:
    """The bytes of blocks before the chosen position (backwards), of its stem, and after it. edges: doc_id, key, at: array of (stem, start, n, offset)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, key, text, found in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), with_row_bytes(batch.column("text")), batch.column("at").to_pylist()):
                for f in found:
                    a, c = f["start"], f["start"] + f["offset"]
                    rows.append((f["stem"], doc, key, a, f["n"], text[a:c][::-1], text[c : c + STEM], text[c + STEM : a + f["n"] + LENGTH - 1]))
                if len(rows) > 10_000:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], CONTEXTS.names)

    mine = edges.select(F.col("doc_id").alias("e_id"), F.col("key").alias("e_key"), "at")
    held = docs.join(mine, F.col("doc_id").eqNullSafe(F.col("e_id")) & (F.col("key") == F.col("e_key")))
    return map_arrow(held.select("doc_id", "key", "text", "at"), run, CONTEXTS)


def shared_with(sides: list[bytes], other: bytes) -> np.ndarray:
    """How many first bytes each side has in common with the other."""
    width = CHOICE
    rows = np.zeros((len(sides), width), np.int16)
    for i, side in enumerate(sides):
        rows[i, : len(side)] = np.frombuffer(side, np.uint8)
        rows[i, len(side) :] = -1
    one = np.full(width + 1, -2, np.int16)
    one[: len(other)] = np.frombuffer(other, np.uint8)
    differs = np.ones((len(sides), width + 1), bool)
    differs[:, :width] = rows != one[None, :width]
    return differs.argmax(1)


def judge(found: DataFrame, side: str) -> DataFrame:
    """Repeated strings among blocks sorted by stem and one side; what a batch can't decide, as its neighbours may hold a partner.

    Rows are spans of repeated strings; for side left also bits of the positions that are open and those that are done, of every block
    whose stem may go on beyond the batch. For side right (found then has those bits) also hashes: with a place, of positions open on both sides; without, of others that may be their partners.
    """
    first = side == "left"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = Hasher(), [], 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                size += len(row["left"]) + STEM + len(row["right"])
                if size > BATCH_BYTES:
                    yield from judged(held, hasher)
                    held, size = [], 0
        if held:
            yield from judged(held, hasher)

    def judged(rows: list[dict], hasher: Hasher) -> Iterator[pa.RecordBatch]:
        texts = [r["left"][::-1] + r["mid"] + r["right"] for r in rows]
        data = np.frombuffer(b"".join(texts), np.uint8)
        begin = np.cumsum([0, *map(len, texts[:-1])])
        n = np.array([r["n"] for r in rows])
        row = np.repeat(np.arange(len(rows)), n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        places = np.repeat(begin, n) + offset
        _, code = np.unique(hasher.of(hasher.sums(data), places, places + LENGTH), return_inverse=True)
        code = code.ravel()
        # strings with one hash are told apart by their digests
        alike = np.flatnonzero(np.bincount(code)[code] > 1)
        if len(alike):
            _, told = np.unique(digests(data, places[alike], places[alike] + LENGTH).view([("a", np.int64), ("b", np.int64)]).ravel(), return_inverse=True)
            code[alike] = told.ravel() + len(code)
        repeated = np.bincount(code)[code] > 1
        out = []
        at = np.flatnonzero(repeated)
        breaks = np.flatnonzero((np.diff(row[at], prepend=-1) != 0) | (np.diff(offset[at], prepend=-2) != 1))
        for a, b in zip(breaks.tolist(), np.append(breaks[1:], len(at)).tolist()):
            r = rows[row[at[a]]]
            out.append((r["stem"], r["doc_id"], r["key"], r["start"], [r["start"] + int(offset[at[a]])], [r["start"] + int(offset[at[b - 1]]) + LENGTH], None, None, None, None, None))
        # blocks whose stem is the batch's first or last: how far do they agree with the block at that end?
        sides = [r[side] for r in rows]
        agreed = np.full(len(rows), -1)
        for end in (0, len(rows) - 1):
            own = [i for i, r in enumerate(rows) if r["stem"] == rows[end]["stem"]]
            agreed[own] = np.maximum(agreed[own], shared_with([sides[i] for i in own], sides[end]))
        before = np.array([len(r["left"]) for r in rows])[row] - offset
        beyond = (before if first else LENGTH - STEM - before) <= agreed[row]
        starts = np.cumsum(n) - n
        ends_of = np.flatnonzero(agreed >= 0).tolist()
        if first:
            for i in ends_of:
                r, own = rows[i], slice(starts[i], starts[i] + n[i])
                bits = [np.packbits(x[own]).tobytes() for x in (beyond & ~repeated, repeated)]
                out.append((r["stem"], r["doc_id"], r["key"], r["start"], None, None, *bits, None, None, None))
        else:
            open_, done = np.zeros(len(row), bool), np.zeros(len(row), bool)
            for i in ends_of:
                own = slice(starts[i], starts[i] + n[i])
                open_[own], done[own] = (np.unpackbits(np.frombuffer(rows[i][x], np.uint8), count=n[i]).astype(bool) for x in ("open", "done"))
            asking = np.flatnonzero(open_ & beyond & ~repeated)
            for i, (h1, h2) in zip(asking.tolist(), digests(data, places[asking], places[asking] + LENGTH).tolist()):
                r = rows[row[i]]
                out.append((r["stem"], r["doc_id"], r["key"], r["start"], None, None, None, None, h1, h2, r["start"] + int(offset[i])))
            partners = np.flatnonzero(beyond & (repeated | done))
            partners = partners[np.unique(code[partners], return_index=True)[1]]
            for h1, h2 in digests(data, places[partners], places[partners] + LENGTH).tolist():
                out.append((None, None, None, None, None, None, None, None, h1, h2, None))
        whole = pa.int64()
        kinds = (whole, whole, whole, whole, pa.list_(whole), pa.list_(whole), pa.binary(), pa.binary(), whole, whole, whole)
        for at in range(0, len(out), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out[at : at + 10_000]), kinds)], EDGES.names)

    return map_arrow(in_order(found, side), run, EDGES)


def in_order(found: DataFrame, side: str) -> DataFrame:
    """Blocks dealt and sorted by stem, one side, and the other: its first bytes keep like ones together, its hash tells all others apart, so that no key is that of many blocks."""
    other = "right" if side == "left" else "left"
    keys = ("stem", side, F.substring(other, 1, 32), F.xxhash64(other))
    return found.repartitionByRange(*keys).sortWithinPartitions(*keys)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, key, starts, ends: spans that repeated strings cover. docs: doc_id, key (tells rows with one id apart), text."""
    # counts are written before they are joined: Spark then splits the partition of a frequent stem
    stems = cut(all_stems(docs).groupBy("stem").agg(F.count("*").alias("holders")).filter("holders > 1").select("stem"), "stems")
    alive = cut(all_blocks(docs).join(stems, "stem"), "alive")
    place = F.struct("doc_id", "key", "start", "n", "offset")
    whole = alive.filter("offset >= 0").groupBy("stem", "b1", "b2").agg(F.count("*").alias("same"), F.min(place).alias("one")).filter("same > 1")
    whole = cut(whole, "whole")
    told = cut(alive.join(whole.drop("one"), ["stem", "b1", "b2"], "left"), "told")
    covered = told.filter("same IS NOT NULL OR offset < 0").select("doc_id", "key", F.array("start").alias("starts"), F.array(F.col("start") + F.col("n") - 1 + LENGTH).alias("ends"))
    edges = told.filter("same IS NULL AND offset >= 0").select("stem", "doc_id", "key", "start", "n", "offset")
    # a string at an edge may be repeated inside a block that is repeated as a whole: one of each such block is a partner
    partners = whole.join(edges.select("stem").distinct(), "stem", "left_semi").select("stem", "one.*")
    at = edges.unionByName(partners).groupBy("doc_id", "key").agg(F.collect_list(F.struct("stem", "start", "n", "offset")).alias("at"))
    found = cut(contexts(at, docs), "contexts")
    left = cut(judge(found, "left"), "edges")
    spans = covered.unionByName(left.filter("starts IS NOT NULL").select("doc_id", "key", "starts", "ends"))
    bits = left.filter("open IS NOT NULL")
    # positions with an open bit: blocks of their stems are sorted once more, by the other side
    again = bits.filter(F.hex("open").rlike("[1-9A-F]")).select("stem").distinct()
    if not is_empty(again):
        marks = bits.join(again, "stem", "left_semi").select("stem", F.col("doc_id").alias("m_id"), F.col("key").alias("m_key"), F.col("start").alias("m_start"), "open", "done").distinct()
        same = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("key") == F.col("m_key")) & (F.col("start") == F.col("m_start"))
        marked = found.withColumnRenamed("stem", "f_stem").join(marks, same & (F.col("f_stem") == F.col("stem"))).select(*CONTEXTS.names, "open", "done")
        right = cut(judge(cut(marked, "marked"), "right"), "edges")
        counted = right.filter("h1 IS NOT NULL")
        twice = counted.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1")
        more = counted.filter("place IS NOT NULL").join(twice, ["h1", "h2"], "left_semi")
        spans = spans.unionByName(right.filter("starts IS NOT NULL").select("doc_id", "key", "starts", "ends"))
        spans = spans.unionByName(more.select("doc_id", "key", F.array("place").alias("starts"), F.array(F.col("place") + LENGTH).alias("ends")))
    return spans.groupBy("doc_id", "key").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))


def union_of(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Spans joined where they overlap or touch, in order."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kept (bytes left of the text, as its strings were judged on the input), n_bytes, n_removed, n_spans.

    One row per row of docs; null texts count as empty, rows that repeat are each other's copies, null ids are kept apart by text.
    """
    out = struct(("doc_id", "bigint"), ("kept", "binary"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"))
    return _kept(docs, id_col, text_col, out, lambda kept, n, spans: (kept, n, n - len(kept), spans))


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As without_repeats, with the SHA-256 of the bytes left in their place."""
    return _kept(docs, id_col, text_col, KEPT, lambda kept, n, spans: (n, n - len(kept), spans, hashlib.sha256(kept).hexdigest()))


def _kept(docs: DataFrame, id_col: str, text_col: str, out, row_of) -> DataFrame:
    rows = keyed(docs, id_col, text_col)
    spans = repeated_spans(rows).select(F.col("doc_id").alias("s_id"), F.col("key").alias("s_key"), "starts", "ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc, text, starts, ends in zip(batch.column("doc_id").to_pylist(), with_row_bytes(batch.column("text")), batch.column("starts").to_pylist(), batch.column("ends").to_pylist()):
                gone = union_of(starts or [], ends or [])
                kept = b"".join(text[a:b] for a, b in zip([0, *(b for _, b in gone)], [*(a for a, _ in gone), len(text)]))
                found.append((doc, *row_of(kept, len(text), len(gone))))
            kinds = {"StringType()": pa.string(), "LongType()": pa.int64(), "BinaryType()": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(list(c), kinds[str(f.dataType)]) for f, c in zip(out.fields, zip(*found))], out.names)

    held = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("key") == F.col("s_key")), "left")
    return map_arrow(held.select("doc_id", "text", "starts", "ends"), run, out)
