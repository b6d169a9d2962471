"""Alignment of two tokenizers' tokens by bytes (operator 13).

A text (with a space before it) is cut where a space or a line feed follows a sign that is no white space: no token of either tokenizer crosses such a place, so
the cut pieces are encoded apart, and a piece that occurs often is encoded once (blocks.py). Pieces are encoded many at a
time, as one text each of both tokenizers. The first tokenizer's character offsets and the second's spans are the coarse cuts; where a
character is shared by several tokens or falls back to bytes, the lengths of the decoded tokens place the cuts within it.

Tokens of A and B overlap once for each stretch between neighbouring ends of either, so the links of a piece are the union of
the ends, and its groups the ends that both share. How many links hold a pair of ids is added up over all pieces; each piece then takes the
counts of its own pairs from one join, and each document adds up its pieces.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_CHARS, REPLIES, block_rows, pack_ints, replies_of, reply, reply_table, slot_rows, slot_words, slots_for, split_blocks, unpack_ints
from .byte_bpe import frame, pack_bytes, unframe, unpack_bytes
from .common import cut, map_arrow, struct

# Fixed value: the characters that stand for bytes in the vocabulary of a byte-level tokenizer are those that print, then others from 256 on.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPACE = "▁"
#: White space for both tokenizers; the separators 1C-1F are no white space for the first.
WHITE = r"[^\S\x1c-\x1f]"
OTHER = r"[\S\x1c-\x1f]"
#: A piece begins where a space or a line feed follows another sign; other white space may stand within, as tokens cross it.
PIECE = re.compile(rf"{WHITE}*{OTHER}+(?:(?![ \n]){WHITE}+{OTHER}+)*(?:(?![ \n]){WHITE}+\Z)?|{WHITE}+")
#: Pieces in a list; characters that are encoded as one text; length from which a piece is cut again.
LIST, JOINED, LONG = 1 << 16, 1 << 14, 1 << 12
ALIGNED = struct(("slot", "int"), ("payload", "binary"))
PAIRS = struct(("slot", "int"), ("pair", "bigint"), ("n", "bigint"))
RESULT = struct(("doc_id", "bigint"), *((c, "bigint") for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", "string"))
COUNTS = 6


class Coder:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        signs = {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in PRINTED)}
        names = self.a.get_vocab()
        self.bytes_a: list[bytes] = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.bytes_a[i] = bytes(signs[c] for c in name) if all(c in signs for c in name) else name.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        inner = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        if any(re.search(rf"[^{SPACE}]{SPACE}|.\n|\n.", p, re.DOTALL) for p in inner):
            raise ValueError("the second tokenizer has pieces that cross a space or a line feed")
        #: neighbours within some token of either
        self.pairs_a = {t[i : i + 2] for t in self.bytes_a for i in range(len(t) - 1)}
        self.pairs_b = {p[i : i + 2] for p in inner for i in range(len(p) - 1)}

    def fits(self, text: str) -> bool:
        """Whether the tokens' bytes join to the text again. Those of A always do; those of B unless the text is changed before it is split."""
        if SPACE not in text and self.b.normalize(text) == SPACE + text.replace(" ", SPACE):
            return True
        return b"".join(self.bytes_b[i] for i in self.b.encode(text)) == b" " + text.encode()

    def pieces(self, text: str) -> Iterator[list[bytes]] | None:
        """The text's pieces, in lists; none if it is empty, and None if its tokens don't join to it."""
        if text and not self.fits(text):
            return None
        return self.lists(" " + text) if text else iter(())

    def lists(self, text: str) -> Iterator[list[bytes]]:
        some: list[bytes] = []
        for m in PIECE.finditer(text):
            piece = m[0]
            some += [piece.encode()] if len(piece) <= LONG else [p.encode() for p in self.parts(piece)]
            if len(some) >= LIST:
                yield some
                some = []
        yield some

    def parts(self, piece: str) -> Iterator[str]:
        """A long piece without white space, cut where no token of either spans the place and no contraction stands."""
        start, at = 0, LONG
        while at < len(piece) - 1:
            x, y = piece[at - 1], piece[at]
            if "'" not in piece[at - 2 : at + 1] and not x.isspace() and not y.isspace() and x + y not in self.pairs_b and x.encode()[-1:] + y.encode()[:1] not in self.pairs_a:
                yield piece[start:at]
                start, at = at, at + LONG
            else:
                at += 1
        yield piece[start:]

    def encoded(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and ends in bytes of A's and B's tokens of a text that begins with white space or is a part of a piece."""
        raw = text.encode()
        code = self.a.encode(text, add_special_tokens=False)
        ids_a = np.array(code.ids, np.int64)
        width = np.array([len(c.encode()) for c in text], np.int64) if len(raw) > len(text) else np.ones(len(text), np.int64)
        bounds = np.concatenate([[0], np.cumsum(width)])
        ends_a = refined(bounds[np.array([e for _, e in code.offsets], np.int64)], self.size_a[ids_a], len(raw))
        # B puts a space before the text: that of the text itself, or one before a line feed that joins nothing; both go
        own = text[0] == " " and len(text) > 1
        skip = 0 if own else 2
        spans = self.b.encode(text[1:] if own else "\n" + text, return_type="proto").pieces
        ids_b = np.array([p.id for p in spans], np.int64)
        ends_b = np.array([p.end for p in spans], np.int64)[skip:] + (1 if own else -1)
        ids_b = ids_b[skip:]
        return ids_a, ends_a, ids_b, refined(ends_b, self.size_b[ids_b], len(raw))

    def aligned(self, pieces: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each text that some pieces join to: the ends of its pieces, and encoded()."""
        at = 0
        while at < len(pieces):
            some, size = [pieces[at]], len(pieces[at])
            at += 1
            while regular(some[-1]) and at < len(pieces) and regular(pieces[at]) and size < JOINED:
                some.append(pieces[at])
                size += len(pieces[at])
                at += 1
            yield np.cumsum([len(p) for p in some]), *self.encoded(b"".join(some).decode())


def coder_for(path_a: str, path_b: str) -> Coder:
    """One Coder per worker process, as loading takes most of a second. It is kept outside this module, since functions travel to workers with the globals that they name."""
    held = sys.__dict__.setdefault("_tokenizer_pairs", {})
    if (path_a, path_b) not in held:
        held.clear()
        held[path_a, path_b] = Coder(path_a, path_b)
    return held[path_a, path_b]


def regular(piece: bytes) -> bool:
    """One space before a sign of ASCII, and another at the end: such pieces may stand one after another."""
    return len(piece) > 1 and piece[0] == 32 and 33 <= piece[1] < 127 and 33 <= piece[-1] < 127 and len(piece) <= LONG


def refined(coarse: np.ndarray, sizes: np.ndarray, size: int) -> np.ndarray:
    """Ends of tokens in bytes. A coarse cut stands where the decoded bytes reach it; between two such cuts, within characters of several bytes, the decoded lengths place the ends."""
    exact = np.cumsum(sizes)
    if not len(exact) or exact[-1] != size:
        raise ValueError("tokens that don't join to their text")
    return np.where(coarse == exact, coarse, exact)


def links(ids_a: np.ndarray, ends_a: np.ndarray, ids_b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each overlap, in order: its end, the place of A's token and that of B's."""
    ends = np.union1d(ends_a, ends_b)
    return ends, np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


def align_words(coder: Callable[[], Coder], rows: pa.Table) -> pa.Table:
    """One slot's distinct pieces: how often they occur, numbers of tokens, groups and links, the links' pairs, and the groups as text."""
    total: dict[bytes, int] = {}
    for _, words, _, counts in slot_words(rows):
        for word, n in zip(words, counts.tolist()):
            total[word] = total.get(word, 0) + n
    pieces = sorted(total, key=lambda w: (not regular(w), w))
    sums, pairs, written = [], [], []
    for stops, ids_a, ends_a, ids_b, ends_b in coder().aligned(pieces):
        ends, a, b = links(ids_a, ends_a, ids_b, ends_b)
        both = np.intersect1d(ends_a, ends_b)
        if not np.isin(stops, both).all():
            raise ValueError("a token crosses the end of a piece")
        cuts = [np.searchsorted(x, stops, "right") for x in (ends_a, ends_b, both, ends)]
        sums.append(np.stack([np.diff(c, prepend=0) for c in cuts]))
        pairs.append(ids_a[a] << 32 | ids_b[b])
        ga, gb = (np.searchsorted(x, both, "right").tolist() for x in (ends_a, ends_b))
        names_a, names_b = ([b"%d" % i for i in x.tolist()] for x in (ids_a, ids_b))
        groups = [b",".join(names_a[i:j]) + b"|" + b",".join(names_b[k:m]) for i, j, k, m in zip([0, *ga], ga, [0, *gb], gb)]
        at = [0, *cuts[2].tolist()]
        written += [b";".join(groups[i:j]) for i, j in zip(at, at[1:])]
    found = np.concatenate(sums, 1) if sums else np.zeros((4, 0), np.int64)
    flat = np.concatenate(pairs) if pairs else np.zeros(0, np.int64)
    kinds, which = np.unique(flat, return_inverse=True)
    counts = np.fromiter(map(total.__getitem__, pieces), np.int64, len(pieces))
    payload = frame(pack_bytes(pieces), pack_ints(counts), *map(pack_ints, found), pack_ints(which), pack_ints(kinds), pack_bytes(written))
    return pa.table([pa.array([rows.column("slot")[0].as_py()], pa.int32()), pa.array([payload], pa.binary())], ALIGNED.names)


def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct pairs of each slot, and how many links hold them."""
    for batch in batches:
        for slot, payload in zip(batch.column("slot").to_pylist(), batch.column("payload")):
            _, counts, _, _, _, n_links, which, kinds, _ = unframe(payload.as_py())
            kinds, times = unpack_ints(kinds), np.repeat(unpack_ints(counts), unpack_ints(n_links))
            n = np.bincount(unpack_ints(which), weights=times, minlength=len(kinds)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kinds), slot), pa.int32()), pa.array(kinds), pa.array(n)], PAIRS.names)


def reply_blocks(words: pa.Table, found: pa.Table) -> pa.Table:
    """A slot's pieces with all counts, to the blocks that hold them. found: the slot's aligned row, and its pairs with their count and whether it is B's highest."""
    if not words.num_rows:
        return reply_table([])
    head = found.filter(pc.is_valid(found.column("payload")))
    pieces, _, *four, which, kinds, written = unframe(head.column("payload")[0].as_py())
    four, which, kinds = [unpack_ints(x) for x in four], unpack_ints(which), unpack_ints(kinds)
    known = found.filter(pc.is_null(found.column("payload"))).sort_by("pair")
    at = np.searchsorted(known.column("pair").to_numpy(), kinds)
    per_link = [known.column(c).cast(pa.int64()).to_numpy()[at][which] for c in ("best", "n")]
    ends = np.cumsum(four[3])
    per_piece = [np.diff(np.concatenate([[0], np.cumsum(x)])[ends], prepend=0) for x in per_link]
    place = {p: i for i, p in enumerate(unpack_bytes(pieces))}
    groups, out = unpack_bytes(written), []
    for block, own, numbers, _ in slot_words(words):
        i = np.fromiter(map(place.__getitem__, own), np.int64, len(own))
        out.append(reply(block, words.column("slot")[0].as_py(), numbers, *(pack_ints(x[i]) for x in (*four, *per_piece)), pack_bytes([groups[k] for k in i.tolist()])))
    return reply_table(out)


def add_up(own: pa.Table, replies: pa.Table) -> pa.Table:
    """A block's documents: the sums over their pieces, and the digest of their groups."""
    out: list[list] = [[] for _ in RESULT.names]
    if own.num_rows:
        docs, sizes = own.column("docs")[0].as_py(), np.array(own.column("sizes")[0].as_py(), np.int64)
        sequence = unpack_ints(own.column("payload")[0].as_py())
        n = int(sequence.max(initial=-1)) + 1
        columns, groups = np.zeros((COUNTS, n), np.int64), [b""] * n
        for numbers, found in replies_of(replies):
            for c, x in zip(columns, found):
                c[numbers] = unpack_ints(x)
            for i, g in zip(numbers.tolist(), unpack_bytes(found[COUNTS])):
                groups[i] = g
        ends = np.cumsum(sizes)
        sums = [np.diff(np.concatenate([[0], np.cumsum(c[sequence])])[ends], prepend=0).tolist() for c in columns]
        digests = []
        for size, end in zip(sizes.tolist(), ends.tolist()):
            digest = hashlib.sha256()
            for a in range(end - size, end, LIST):
                digest.update((b";" if a > end - size else b"") + b";".join(map(groups.__getitem__, sequence[a : min(a + LIST, end)].tolist())))
            digests.append(digest.hexdigest() if size else "")
        out = [docs, *sums, digests]
    kinds = (pa.int64(), *[pa.int64()] * COUNTS, pa.string())
    return pa.table([pa.array(c, t) for c, t in zip(out, kinds)], RESULT.names)


def align_texts(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    path_a: a file of the tokenizers library with a byte-level tokenizer; path_b: a model of sentencepiece. Null and empty texts, and those whose tokens don't
    join to them, have no tokens: zeros and an empty string. Repeated rows and null ids are kept each; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.lit(None).cast("string").alias("label"), F.lit(1).alias("mark"))
    coder = partial(coder_for, path_a, path_b)
    parts = cut(split_blocks(rows, lambda: coder().pieces, slots_for(rows), block_chars), "align_blocks")
    aligned = cut(slot_rows(parts).groupBy("slot").applyInArrow(lambda rows: align_words(coder, rows), ALIGNED), "aligned")
    each = cut(map_arrow(aligned, count_pairs, PAIRS), "align_pairs")
    # distinct pairs are far fewer than links, but no bound is known: Spark chooses the join by their size
    total = each.groupBy("pair").agg(F.sum("n").alias("n"))
    top = total.groupBy((F.col("pair").bitwiseAND(0xFFFFFFFF)).alias("b")).agg(F.max("n").alias("most"))
    known = total.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)).join(top, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    found = each.select("slot", "pair").join(known, "pair").select("slot", F.lit(None).cast("binary").alias("payload"), "pair", "n", "best")
    right = aligned.select("slot", "payload", F.lit(None).cast("bigint").alias("pair"), F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("boolean").alias("best")).unionByName(found)
    replies = slot_rows(parts).groupBy("slot").cogroup(right.groupBy("slot")).applyInArrow(reply_blocks, REPLIES)
    return block_rows(parts).groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(add_up, RESULT)
