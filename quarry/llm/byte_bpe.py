"""Byte-level BPE encoding and decoding through a global shuffle of distinct words (operator 10).

Documents are cut into pre-tokens by the tokenizer's pattern and gathered in blocks of a few MB. A block numbers its distinct
pre-tokens; its documents become sequences of those numbers, which are the positions. The distinct words are dealt by hash, so
that each meets its equals of all blocks in one task and is encoded once; the ids go back to their blocks, where the
sequences put them in the order of the text. A word makes one entry per block, never one per occurrence, so frequent words
are no hot keys. Words and sequences travel packed and compressed. Decoding looks ids up in the token-byte table, which the
vocabulary file bounds.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, struct

PACKED = struct(("key", "int"), ("block", "bigint"), ("bucket", "int"), ("ids", "array<bigint>"), ("sizes", "array<int>"), ("payload", "binary"))
TOKENS = struct(("doc_id", "bigint"), ("ids", "array<int>"))
BLOCK_CHARS = 4 << 20
MOST_BUCKETS = 4096


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def share_ranks(spark: SparkSession, path: str, most: int = 1_000_000) -> Broadcast:
    """The vocabulary for all executors; its size is that of a file, checked against `most`."""
    ranks = load_ranks(path)
    if len(ranks) > most:
        raise ValueError(f"{len(ranks)} tokens; at most {most} are broadcast")
    return spark.sparkContext.broadcast(ranks)


#: Fixed value: the pattern whose matches the array form below finds; any other pattern is matched by the regex module.
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER, LETTER, NUMBER, SPACE = range(4)
#: Characters of a text that are taken apart at once, by and large, and those searched at once for a place to cut.
PIECE_CHARS, SEARCH_CHARS = 1 << 19, 1 << 12
#: Pre-tokens whose distinct words are taken out at once.
CHUNK_WORDS = 1 << 16


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit number for each code, as good as random."""
    x = (x.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


class Splitter:
    """Pre-tokens of a text as bounds in it, and two 64-bit hashes of each, computed over whole arrays of characters."""

    BASES = (0x5851F42D4C957F2D, 0x14057B7EF767814F)

    def __init__(self, pattern: str):
        self.regex = None if pattern == KNOWN_PATTERN else regex.compile(pattern)
        self.kinds = np.zeros(0x110000, np.uint8)
        every = np.arange(0x110000, dtype="<u4")
        legal = every[(every < 0xD800) | (every >= 0xE000)].tobytes().decode("utf-32-le")
        for kind, found in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(found, legal):
                a, b = (x if x < 0xD800 else x + 0x800 for x in m.span())
                self.kinds[a:b] = kind
        self.powers = [np.ones(1, np.uint64) for _ in range(4)]

    def grow(self, n: int) -> None:
        for i, base in enumerate((*self.BASES, *(pow(b, -1, 1 << 64) for b in self.BASES))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            self.powers[i] = np.multiply.accumulate(steps)

    def pieces(self, text: str, most: int | None = None) -> Iterator[str]:
        """A long text in pieces of some `most` signs whose pre-tokens are those of the text; with a pattern that isn't known it stays whole, and so does a run of one kind of signs.

        A pre-token ends where a letter, number or other sign is followed by another kind, and looks no further, but for an apostrophe before letters. The place after white space is none, as the last of it may stand apart.
        """
        at, most = 0, most or PIECE_CHARS
        while self.regex is None and len(text) - at > most:
            cut = at + most
            while cut < len(text):
                codes = codes_of(text[cut - 1 : cut + SEARCH_CHARS])
                kind = self.kinds[codes]
                found = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[:-1] != SPACE) & ~((codes[:-1] == 39) & (kind[1:] == LETTER)))
                if len(found):
                    cut += int(found[0])
                    break
                cut += SEARCH_CHARS
            if cut >= len(text):
                break
            yield text[at:cut]
            at = cut
        yield text[at:]

    def bounds(self, text: str, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pre-tokens."""
        if self.regex:
            spans = [m.span() for m in self.regex.finditer(text) if m.end() > m.start()]
            return np.array([s[0] for s in spans], np.int64), np.array([s[1] for s in spans], np.int64)
        kind = self.kinds[codes]
        n = len(kind)
        begins = np.ones(n, bool)
        begins[1:] = kind[1:] != kind[:-1]
        # the last sign of white space before other text stands apart; if a space, it starts what follows
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE))
        begins[last] = True
        begins[last[codes[last] == 32] + 1] = False
        marks = np.flatnonzero(codes[:-1] == 39)
        if len(marks):  # contractions, where the apostrophe starts a pre-token of its own
            before = np.where(marks > 0, marks - 1, 0)
            marks = marks[(marks == 0) | (kind[before] != OTHER) & (codes[before] != 32)]
            for at in marks.tolist():
                size = 3 if text[at + 1 : at + 3] in ("re", "ve", "ll") else 2 if text[at + 1] in "stmd" else 0
                if size:
                    begins[at + 1 : at + size] = False
                    if at + size < n and kind[at + size] == LETTER:
                        begins[at + size] = True
        starts = np.flatnonzero(begins)
        return starts, np.append(starts[1:], n)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and both hashes."""
        codes = codes_of(text)
        n = len(codes)
        if n >= len(self.powers[0]):
            self.grow(max(n + 1, 2 * len(self.powers[0])))
        starts, ends = self.bounds(text, codes)
        hashes = []
        for salt, power, inverse in zip((1, 2), self.powers[:2], self.powers[2:]):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(mixed(codes, salt) * power[:n], out=sums[1:])
            hashes.append(mixed((sums[ends] - sums[starts]) * inverse[starts], 3))
        return starts, ends, *hashes


def numbered(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, given by their two hashes, numbered as they first occur: the number of each, and where each number first stands."""

    def firsts(codes: np.ndarray) -> np.ndarray:
        at = np.empty(codes.max(initial=-1) + 1, np.int64)
        at[codes[::-1]] = np.arange(len(codes))[::-1]
        return at

    codes, _ = pd.factorize(first)
    origin = firsts(codes)
    if (second != second[origin[codes]]).any():  # two words with one hash: both hashes together tell them apart
        codes, _ = pd.factorize(pd.MultiIndex.from_arrays([first, second]))
        origin = firsts(codes)
    return codes.astype(np.int32), origin


class Words:
    """The pre-tokens of a block: for each the number of its word within its chunk, and each chunk's distinct words."""

    def __init__(self):
        self.texts, self.spans, self.numbers, self.distinct = [], [], [], []
        self.pending = self.total = self.known = 0

    def add(self, text: str, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        self.spans.append((np.full(len(starts), len(self.texts), np.int32), starts.astype(np.int32), ends.astype(np.int32), first, second))  # a string holds less than 2^31 signs
        self.texts.append(text)
        self.pending += len(starts)
        if self.pending >= CHUNK_WORDS:
            self.close_chunk()

    def close_chunk(self) -> None:
        """Of the pending pre-tokens only the distinct words keep their hashes and bounds."""
        if not self.pending:
            return
        columns = [np.concatenate(c) for c in zip(*self.spans)]
        codes, origin = numbered(*columns[3:])
        self.numbers.append(codes + np.int32(self.known))
        self.distinct.append((*(c[origin] for c in columns), origin + self.total))
        self.known += len(origin)
        self.total += len(codes)
        self.spans, self.pending = [], 0

    def finish(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Number of each pre-token's word, where each word first stands, its first hash, and the words."""
        self.close_chunk()
        piece, starts, ends, first, second, stands = map(np.concatenate, zip(*self.distinct))
        self.distinct = []
        renumbered, origin = numbered(first, second)
        codes = np.concatenate([renumbered[n] for n in self.numbers])
        self.numbers = []
        words = [self.texts[p][a:b].encode("utf-8", "surrogatepass") for p, a, b in zip(piece[origin].tolist(), starts[origin].tolist(), ends[origin].tolist())]
        return codes, stands[origin], first[origin], words


def packed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Numbers below 2^31, small ones in a byte, others in four, each byte place apart; compressed."""
    small = numbers < 255
    head = np.where(small, numbers, 255).astype(np.uint8).tobytes()
    rest = numbers[~small].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return packed(len(head).to_bytes(8, "little") + head + rest)


def unpack_numbers(data: bytes) -> np.ndarray:
    raw = unpacked(data)
    n = int.from_bytes(raw[:8], "little")
    out = np.frombuffer(raw, np.uint8, n, 8).astype(np.int32)
    out[out == 255] = np.frombuffer(raw, np.uint8, -1, 8 + n).reshape(4, -1).T.copy().view("<u4").ravel()
    return out


def pack_bytes(items: list[bytes]) -> bytes:
    raw = b"".join(items)
    lengths = pack_numbers(np.fromiter(map(len, items), np.int64, len(items)))
    return len(lengths).to_bytes(8, "little") + lengths + len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_bytes(packed: bytes) -> list[bytes]:
    n = int.from_bytes(packed[:8], "little")
    lengths = unpack_numbers(packed[8 : 8 + n]).tolist()
    raw = pa.decompress(packed[16 + n :], int.from_bytes(packed[8 + n : 16 + n], "little"), codec="zstd", asbytes=True)
    ends = list(accumulate(lengths))
    return [raw[end - size : end] for end, size in zip(ends, lengths)]


def frame(payload: bytes, *others: bytes) -> bytes:
    """Several byte strings in one."""
    return b"".join(len(x).to_bytes(8, "little") + x for x in (payload, *others))


def unframe(payload: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(payload):
        n = int.from_bytes(payload[at : at + 8], "little")
        out.append(payload[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def split_words(docs: DataFrame, pattern: str, buckets: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per block: one row for each bucket of its distinct words, and one (bucket -1) with its documents' sequences.

    Words are numbered as they first occur; in the sequences 0 means the next new word and n + 1 an earlier word by its rank of frequency.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        split, part_id, blocks = Splitter(pattern), TaskContext.get().partitionId(), 0
        ids, sizes, block_words, filled = [], [], Words(), 0

        def flush() -> pa.RecordBatch:
            nonlocal blocks
            block = (part_id << 32) + blocks
            blocks += 1
            rows = []
            if block_words.pending or block_words.total:
                codes, origin, first, words = block_words.finish()
                times = np.bincount(codes)
                order = np.argsort(-times, kind="stable")
                rank = np.empty(len(order), np.int32)
                rank[order] = np.arange(1, len(order) + 1)
                sequence = rank[codes]
                sequence[origin] = 0
                bucket = (first % np.uint64(buckets)).astype(np.int64)
                dealt = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[dealt], prepend=-1, append=-1))
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    own = np.sort(dealt[a:b])
                    rows.append((int(bucket[own[0]]), block, int(bucket[own[0]]), None, None, frame(pack_bytes([words[i] for i in own.tolist()]), pack_numbers(np.diff(own, prepend=0)))))
                # ranks travel as the numbers of first occurrence in the order of frequency, for words that occur again
                again = order[: int((times > 1).sum())]
            else:
                sequence = again = np.zeros(0, np.int64)
            rows.append((block % 1_000_003, block, -1, list(ids), list(sizes), frame(pack_numbers(sequence), pack_numbers(again))))
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()))], PACKED.names)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                size = 0
                for piece in split.pieces(text) if text else ():
                    starts, *others = split(piece)
                    block_words.add(piece, starts, *others)
                    size += len(starts)
                    filled += len(piece)
                ids.append(doc)
                sizes.append(size)
                if filled >= block_chars or len(ids) >= 50_000:
                    yield flush()
                    ids, sizes, block_words, filled = [], [], Words(), 0
        if ids:
            yield flush()

    return map_arrow(docs, run, PACKED)


def encode_words(dealt: DataFrame, ranks: Broadcast, pattern: str) -> DataFrame:
    """Replaces the words by their ids. Rows are dealt by bucket before, so a word is encoded once; sequences pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple] = {}
        encode, here = encoder(ranks, pattern), -1
        for batch in batches:
            passing = pc.less(batch.column("bucket"), 0)
            yield batch.filter(passing)
            columns = batch.filter(pc.invert(passing)).to_pydict()
            for i, (bucket, payload) in enumerate(zip(columns["bucket"], columns["payload"])):
                if bucket != here:  # rows are sorted by bucket: no word comes back
                    known, here = {}, bucket
                words, numbers = unframe(payload)
                found = []
                for word in unpack_bytes(words):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = tuple(encode(word))
                    found.append(ids)
                sizes = np.fromiter(map(len, found), np.int32, len(found))
                flat = np.fromiter(chain.from_iterable(found), np.int32, sizes.sum())
                columns["payload"][i] = frame(pack_numbers(flat), pack_numbers(sizes), numbers)
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in batch.schema], batch.schema.names)

    return map_arrow(dealt, run, PACKED)


def encoder(ranks: Broadcast, pattern: str):
    """A function from the bytes of one pre-token to its ids. Kept by the task that asks for it alone, as functions travel to workers with all globals that they name."""
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})._core_bpe.encode_single_piece


def reassemble(key: tuple, rows: pa.Table) -> pa.Table:
    """The documents of one block, their ids in the order of the text."""
    columns = rows.select(["bucket", "ids", "sizes", "payload"]).to_pydict()
    flats, lengths, numbers, docs, sizes, sequence, again = [], [], [], [], [], None, None
    for bucket, ids, size, payload in zip(*columns.values()):
        if bucket < 0:
            docs, sizes, (sequence, again) = ids, size, map(unpack_numbers, unframe(payload))
        else:
            flat, length, number = map(unpack_numbers, unframe(payload))
            flats.append(flat)
            lengths.append(length)
            numbers.append(np.cumsum(number))
    if not len(sequence):
        return pa.table([pa.array(docs, pa.int64()), pa.array([[] for _ in docs], pa.list_(pa.int32()))], TOKENS.names)
    new = sequence == 0
    words = np.cumsum(new) - 1
    words[~new] = again[sequence[~new] - 1]
    flat, length = np.concatenate(flats), np.concatenate(lengths)
    start, at = np.cumsum(length) - length, np.argsort(np.concatenate(numbers))
    start, length = start[at], length[at]  # by the word's number
    each = length[words]
    ends = np.cumsum(each)
    taken = np.empty(ends[-1], np.int32)
    for a in range(0, len(words), CHUNK_WORDS):
        size, begin = each[a : a + CHUNK_WORDS], ends[a] - each[a]
        within = ends[a : a + CHUNK_WORDS] - size - begin
        taken[begin : begin + size.sum()] = flat[np.repeat(start[words[a : a + CHUNK_WORDS]] - within, size) + np.arange(size.sum())]
    bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
    return pa.table([pa.array(docs, pa.int64()), pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pa.array(taken)).cast(pa.list_(pa.int32()))], TOKENS.names)


def buckets_for(docs: DataFrame) -> int:
    """Buckets of words: more than a shuffle has partitions, as a task holds one bucket's words at a time, and as many as tasks read docs, up to MOST_BUCKETS; few otherwise, as small lists of words compress badly."""
    return max(2 * max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), min(MOST_BUCKETS, docs.rdd.getNumPartitions()))


def encode(docs: DataFrame, ranks: Broadcast, pattern: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: doc_id and its token ids. Null texts count as empty and have no ids; repeated rows and ids are kept each."""
    buckets = buckets_for(docs)
    dealt = split_words(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")), pattern, buckets, block_chars).repartition("key").sortWithinPartitions("bucket")
    return encode_words(dealt, ranks, pattern).groupBy("block").applyInArrow(reassemble, TOKENS)


class TokenTable:
    """Byte strings by id, laid end to end; joins arrays of ids to them."""

    def __init__(self, items: list[bytes]):
        self.length = np.fromiter(map(len, items), np.int64, len(items))
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(items), np.uint8)

    def join(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The strings of the ids one after another, and where each ends."""
        each = self.length[ids]
        ends = np.cumsum(each)
        taken = self.flat[np.repeat(self.start[ids] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
        return taken.tobytes(), ends

    def per_list(self, lists: pa.Array, most: int = 1 << 18) -> Iterator[Iterator[bytes]]:
        """For each list of ids the byte strings that it joins to, in parts of at most so many ids."""
        offsets, flat = lists.offsets.to_numpy().tolist(), lists.values.to_numpy(zero_copy_only=False)
        for a, b in zip(offsets[:-1], offsets[1:]):
            yield (self.join(flat[c : min(c + most, b)])[0] for c in range(a, b, most))


def token_table(ranks: dict[bytes, int]) -> list[bytes]:
    items = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        items[rank] = token
    return items


def lists_of(column: pa.Array) -> pa.Array:
    """Null lists as empty ones, without slack before the first."""
    return pa.concat_arrays([column.fill_null([])]) if column.null_count else column


def decode(tokens: DataFrame, ranks: Broadcast, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the bytes that the ids stand for (none for null). The ids join the table of token bytes, which each task holds; an id beyond it is an error."""
    out = struct(("doc_id", "bigint"), ("decoded", "binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TokenTable(token_table(ranks.value))
        for batch in batches:
            decoded = [b"".join(parts) for parts in table.per_list(lists_of(batch.column("ids")))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(decoded, pa.binary())], out.names)

    return map_arrow(tokens.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")), run, out)


def digests(tokens: DataFrame, ranks: Broadcast) -> DataFrame:
    """Of doc_id and ids: number of tokens, digest of the ids as decimals, and digest of the bytes that they decode to."""
    out = struct(("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = token_table(ranks.value)
        table, decimals = TokenTable(items), TokenTable([b" %d" % i for i in range(len(items))])
        for batch in batches:
            lists = lists_of(batch.column("ids"))
            written, decoded = [], []
            for numbers, texts in zip(decimals.per_list(lists), table.per_list(lists)):
                digest = hashlib.sha256()
                for i, part in enumerate(numbers):
                    digest.update(part if i else part[1:])
                written.append(digest.hexdigest())
                digest = hashlib.sha256()
                for part in texts:
                    digest.update(part)
                decoded.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(lists.offsets.to_numpy()), pa.int64()), pa.array(written, pa.string()), pa.array(decoded, pa.string())], out.names)

    return map_arrow(tokens, run, out)


def token_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes, decodes the ids, and returns one row of digests per document."""
    ranks = share_ranks(docs.sparkSession, path)
    return digests(encode(docs, ranks, pattern, id_col, text_col), ranks)
