"""Documents as blocks of numbered words, shared by operators 11 to 13.

A task gathers whole documents into blocks of some MB. A block numbers its distinct words by falling frequency and keeps its
documents as sequences of those numbers. Its distinct words are dealt into slots by hash, so that a word meets its equals of
all blocks in one task; what is found for a word goes back to each block as one reply per slot. A word thus makes one entry
per block and never one per occurrence, so very frequent words are no hot keys. Everything travels packed and compressed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import frame, pack_bytes, packed, unframe, unpack_bytes, unpacked
from .common import map_arrow, struct

#: Characters of a block, and distinct words, beyond which it ends with the document at hand.
BLOCK_CHARS = 16 << 20
BLOCK_WORDS = 1 << 20
ROWS = struct(("slot", "int"), ("block", "bigint"), ("label", "string"), ("docs", "array<bigint>"), ("sizes", "array<bigint>"), ("marks", "array<int>"), ("payload", "binary"))
REPLIES = struct(("block", "bigint"), ("slot", "int"), ("payload", "binary"))

#: Makes, once per task, the function that gives a text's words in lists of bounded length, or None for a text that has none by rule.
Tokens = Callable[[], Callable[[str], Iterator[list[bytes]] | None]]


def pack_ints(numbers: np.ndarray) -> bytes:
    """Whole numbers of 64 bits, each byte place apart, compressed; high bytes that are zero cost nearly nothing."""
    return packed(np.ascontiguousarray(numbers, "<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack_ints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(unpacked(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").ravel()


class Block:
    """The documents of one block."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.parts: list[np.ndarray] = []
        self.docs, self.sizes, self.marks = [], [], []
        self.filled = 0

    def add(self, doc: int | None, words: Iterator[list[bytes]] | None, mark: int, chars: int) -> None:
        size = 0
        for some in words if words is not None else ():
            self.parts.append(np.fromiter(map(self.number.__getitem__, some), np.int32, len(some)))
            size += len(some)
        self.docs.append(doc)
        self.sizes.append(size)
        self.marks.append(mark if words is not None else -1)
        self.filled += chars + 64

    def full(self, chars: int) -> bool:
        return self.filled >= chars or len(self.number) >= BLOCK_WORDS

    def rows(self, block: int, label: str | None, slots: int) -> pa.RecordBatch:
        """A row per slot of its words (their numbers, and how often they occur in documents marked 1), and one (slot -1) with the sequences."""
        sequence = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)
        words = list(self.number)
        order = np.argsort(-np.bincount(sequence, minlength=len(words)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        sequence = rank[sequence]
        counted = np.repeat(np.array(self.marks) == 1, self.sizes)
        counts = np.bincount(sequence[counted], minlength=len(words))
        rows = []
        slot = np.fromiter((xxhash.xxh3_64_intdigest(w) % slots for w in words), np.int64, len(words))[order]
        dealt = np.argsort(slot, kind="stable")
        cuts = np.flatnonzero(np.diff(slot[dealt], prepend=-1, append=-1)) if len(words) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = dealt[a:b]
            rows.append((int(slot[own[0]]), block, label, None, None, None, frame(pack_bytes([words[i] for i in order[own].tolist()]), pack_ints(np.diff(own, prepend=0)), pack_ints(counts[own]))))
        rows.append((-1, block, label, self.docs, self.sizes, self.marks, pack_ints(sequence)))
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], ROWS.names)


def slots_for(docs: DataFrame, most: int = 4096) -> int:
    """Slots by the number of scan tasks, which follows from the size of the input."""
    return min(most, max(16, docs.rdd.getNumPartitions()))


def split_blocks(docs: DataFrame, make: Tokens, slots: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """ROWS of docs (doc_id, text, label, mark). Documents of one label share blocks; null texts count as empty. A block is closed when full, and all are when together they hold twice as much."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens, part, made = make(), TaskContext.get().partitionId(), 0
        held: dict[str | None, Block] = {}
        for batch in batches:
            for doc, text, label, mark in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "label", "mark"))):
                block = held.setdefault(label, Block())
                block.add(doc, tokens(text or ""), mark, len(text or ""))
                done = [label] if block.full(block_chars) else list(held) if sum(b.filled for b in held.values()) >= 2 * block_chars else []
                for each in done:
                    yield held.pop(each).rows((part << 32) + made, each, slots)
                    made += 1
        for each, block in held.items():
            yield block.rows((part << 32) + made, each, slots)
            made += 1

    return map_arrow(docs.select("doc_id", "text", "label", "mark"), run, ROWS)


def slot_words(rows: pa.Table) -> Iterator[tuple[int, list[bytes], bytes, np.ndarray]]:
    """Of one slot's rows: block, words, their numbers in the block (still packed), counts."""
    for block, payload in zip(rows.column("block").to_pylist(), rows.column("payload")):
        words, numbers, counts = unframe(payload.as_py())
        yield block, unpack_bytes(words), numbers, unpack_ints(counts)


def reply(block: int, slot: int, numbers: bytes, *found: bytes) -> tuple[int, int, bytes]:
    return block, slot, frame(numbers, *found)


def reply_table(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.binary())
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], REPLIES.names)


def replies_of(rows: pa.Table) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Of one block's replies: numbers of words, and what was found for them."""
    for payload in rows.column("payload"):
        numbers, *found = unframe(payload.as_py())
        yield np.cumsum(unpack_ints(numbers)), found


def by_number(rows: pa.Table, count: int, field: int) -> np.ndarray:
    """A column of numbers that was found for a block's words, at each word's number."""
    out = np.zeros(count, np.int64)
    for numbers, found in replies_of(rows):
        out[numbers] = unpack_ints(found[field])
    return out


def slot_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("slot") >= 0)


def block_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("slot") < 0)
