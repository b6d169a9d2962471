"""Scores of texts by an n-gram language model kept as Elias-Fano tries (operator 12).

Words are numbered over all blocks (blocks.py). Each block sends its distinct trigrams with their counts in training documents
to shards dealt by the nearest word of the context, and by the predicted word as well where that context word is frequent, so
that no word's successors meet in one task. A shard adds the counts up, lays out its trie, and answers each block's
trigrams with quantised log-probabilities; the blocks add these up for each document.

Level by level, with v the nearest word of the context, u the one before, w the predicted one, a trie holds: the words v; for each v
its successors w, with p(w|v); for each v the words u before it, with the weight of backing off from (u, v); for each (u, v) its
successors, as places among the successors of v, with p(w|u,v). Every level is one monotone sequence, a node's children being
offset by what the nodes before it span; pointers and spans are monotone as well. A lookup is a search for the successor of a
number within the context's span. Levels lie in one buffer that is read in place, be it from a column or a mapped file.

Probabilities: p(w) = (c(w) + 1) / (N + V + 1), p(w|v) = (c(v,w) + M2 p(w)) / (c(v) + M2), p(w|u,v) = (c(u,v,w) + M3 p(w|v)) / (c(u,v) + M3):
each is a distribution over the training tokens and one unknown word.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_CHARS, REPLIES, block_rows, by_number, pack_ints, replies_of, reply, reply_table, slot_rows, slot_words, slots_for, split_blocks, unpack_ints
from .byte_bpe import frame, unframe
from .common import cut, struct
from .elias_fano import EliasFano

#: Weight of the lower order, in tokens, at orders two and three.
M2, M3 = 20.0, 5.0
#: A step of the quantised log10 probabilities: sixteen bits reach 32 orders of magnitude.
STEP = 1 / 2048
#: Tokens of a shard, on average.
SHARD_TOKENS = 1 << 19
TEXT_BYTES = 1 << 20
BEGIN, END = 0, 1  # ids of the marks around a text; words have ids from 2
SHARDS = struct(("shard", "int"), ("block", "bigint"), ("payload", "binary"))
SCORES = struct(("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"), ("train_tokens", "bigint"), ("base_score", "double"), ("score", "double"))

# Fixed value: A-Z to a-z.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the crc32 of the id as text leaves 2 modulo 7; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def word_lists(text: str) -> Iterator[list[bytes]]:
    """Words between spaces and control white space, A-Z lower-cased."""
    for part in parts_of(text.encode().translate(LOWER), b" \t\n\x0b\x0c\r"):
        yield part.split()  # of bytes: splits at these six only


def parts_of(raw: bytes, gaps: bytes, size: int = TEXT_BYTES) -> Iterator[bytes]:
    """A text in parts of some size that end before one of the bytes `gaps`; a part without one goes on."""
    at = 0
    while len(raw) - at > size:
        ends = [e for g in gaps if (e := raw.find(bytes([g]), at + size, at + 2 * size)) >= 0] or [e for g in gaps if (e := raw.find(bytes([g]), at + 2 * size)) >= 0]
        if not ends:
            break
        yield raw[at : min(ends)]
        at = min(ends)
    yield raw[at:]


def number_words(rows: pa.Table) -> pa.Table:
    """One slot's words: ids, small for frequent ones, and counts in training documents, as replies to the blocks; and one row (block -1) with the sums."""
    slot = rows.column("slot")[0].as_py()
    total: dict[bytes, int] = {}
    for _, words, _, counts in slot_words(rows):
        for word, n in zip(words, counts.tolist()):
            total[word] = total.get(word, 0) + n
    place = {w: i for i, (w, _) in enumerate(sorted(total.items(), key=lambda x: (-x[1], x[0])))}
    out = [reply(-1, slot, b"", pack_ints(np.array([sum(total.values()), sum(n > 0 for n in total.values())])))]
    for block, words, numbers, _ in slot_words(rows):
        local = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        out.append(reply(block, slot, numbers, pack_ints(local), pack_ints(np.fromiter(map(total.__getitem__, words), np.int64, len(words)))))
    return reply_table(out)


class View:
    """A block with global ids: its stream of tokens, each document between marks, and its distinct trigrams."""

    def __init__(self, own: pa.Table, replies: pa.Table, slots: int, documents: int):
        self.docs, self.sizes, self.marks = (own.column(c)[0].as_py() for c in ("docs", "sizes", "marks"))
        sequence = unpack_ints(own.column("payload")[0].as_py())
        n = int(sequence.max(initial=-1)) + 1
        slot = np.zeros(n, np.int64)
        for (numbers, _), s in zip(replies_of(replies), replies.column("slot").to_pylist()):
            slot[numbers] = s
        # local numbers: the marks, then the block's words
        self.ids = np.concatenate([[BEGIN, END], by_number(replies, n, 0) * slots + slot + 2])
        self.counts = np.concatenate([[documents, documents], by_number(replies, n, 1)])
        sizes = np.array(self.sizes, np.int64)
        ends = np.cumsum(sizes + 3)
        # arrays over all tokens take four bytes a number
        self.stream = np.full(int(ends[-1]) if len(ends) else 0, BEGIN, np.int32)
        self.stream[np.arange(len(sequence)) + np.repeat(3 * np.arange(len(sizes)) + 2, sizes)] = sequence + 2
        self.stream[ends - 1] = END
        self.at = np.flatnonzero(self.stream != BEGIN).astype(np.int32)  # positions of tokens
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)

    def trigrams(self) -> None:
        """u, v, w and counts of the distinct trigrams, ordered by (v, u, w) as numbered here; `which` is each token's."""
        s, at = self.stream, self.at
        pair, ctx = np.unique(s[at - 1].astype(np.int64) << 32 | s[at - 2], return_inverse=True)
        ctx <<= 32
        ctx |= s[at]
        full, which = np.unique(ctx, return_inverse=True)
        del ctx
        self.which = which.astype(np.int32)
        del which
        self.v, self.u, self.w = pair[full >> 32] >> 32, pair[full >> 32] & 0xFFFFFFFF, full & 0xFFFFFFFF
        train = np.array(self.marks)[self.doc] == 1
        self.times = np.bincount(self.which[train], minlength=len(full))

    def deal(self, tokens: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """For each local number: its hash, and over how many shards its successors are spread (one for each average shard that it would fill)."""
        with np.errstate(over="ignore"):
            mixed = (self.ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(33)).astype(np.int64), np.minimum((self.counts * (shards / max(tokens, 1))).astype(np.int64) + 1, shards)


def runs(x: np.ndarray, *before: np.ndarray) -> np.ndarray:
    """Where x, or one of the columns before it, differs from its predecessor."""
    new = np.ones(len(x), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in (x, *before)])
    return np.flatnonzero(new)


def lengths(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(starts, append=n)


def send_trigrams(slots: int, tokens: int, documents: int, shards: int):
    """A function for cogroup: a block and its replies to a row for each shard that its trigrams fall into."""

    def run(own: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        if own.num_rows:
            b = View(own, replies, slots, documents)
            b.trigrams()
            mixed, spread = b.deal(tokens, shards)
            split = np.flatnonzero(spread[b.v] > 1)
            # all of a spread context's count goes to each of its shards, as the shard sees only a part of its successors
            at = runs(b.u[split], b.v[split])
            first = split[at]
            sums = np.add.reduceat(b.times[split], at) if len(at) else at
            first, sums = first[sums > 0], sums[sums > 0]
            each = spread[b.v[first]]
            turn = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            again, sums = np.repeat(first, each), np.repeat(sums, each)
            places = (mixed[b.v[again]] + turn) % shards
            order = np.argsort(places, kind="stable")
            again, sums, places = again[order], sums[order], places[order]
            rows_of, none = dict(spread_rows(b, mixed, spread, shards)), np.zeros(0, np.int64)
            for shard in sorted(rows_of.keys() | set(np.unique(places).tolist())):
                a, c = np.searchsorted(places, [shard, shard + 1])
                out.append((shard, own.column("block")[0].as_py(), shard_payload(b, rows_of.get(shard, none), again[a:c], sums[a:c])))
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.binary()))], SHARDS.names)

    return run


def spread_rows(b: View, mixed: np.ndarray, spread: np.ndarray, shards: int) -> list[tuple[int, np.ndarray]]:
    """Shards and the trigrams that go there; those whose context word has no successor in training stay, as no shard knows more of them."""
    known = np.flatnonzero(b.counts[b.v] > 0)
    shard = (mixed[b.v[known]] + mixed[b.w[known]] % spread[b.v[known]]) % shards
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1))
    return [(int(shard[order[a]]), known[order[a:c]]) for a, c in zip(cuts[:-1], cuts[1:])]


def shard_payload(b: View, rows: np.ndarray, contexts: np.ndarray, sums: np.ndarray) -> bytes:
    """Packed: the distinct v, u and w with their ids, and the counts of v and w; trigrams as places in these, by runs of v and of u; their counts; spread contexts and theirs."""
    v, u, w = b.v[rows], b.u[rows], b.w[rows]
    rv, ru = runs(v), runs(u, v)
    V, U, W = np.unique(np.concatenate([v[rv], b.v[contexts]])), np.unique(np.concatenate([u[ru], b.u[contexts]])), np.unique(w)
    at = lambda own, x: np.searchsorted(own, x)
    fields = (b.ids[V], b.counts[V], b.ids[U], b.ids[W], b.counts[W], at(V, v[rv]), lengths(rv, len(v)), at(U, u[ru]), lengths(ru, len(v)), at(W, w), b.times[rows], at(V, b.v[contexts]), at(U, b.u[contexts]), sums)
    return frame(*map(pack_ints, fields))


class Sent:
    """What one block sent to a shard: ids of the distinct V, U and W, and trigrams as places in these; v and u by runs."""

    def __init__(self, V, Vn, U, W, Wn, v, nv, u, nu, w, times, cv, cu, sums):
        self.V, self.Vn, self.U, self.W, self.Wn, self.w, self.times, self.cv, self.cu, self.sums = V, Vn, U, W, Wn, w, times, cv, cu, sums
        self.v, self.u, self.nu = np.repeat(v, nv), u, nu

    @staticmethod
    def of(payload: bytes) -> Sent:
        return Sent(*map(unpack_ints, unframe(payload)))

    @staticmethod
    def of_all(sent: list[Sent]) -> Sent:
        """What several blocks sent, one after another, as places in the ids of all, ascending."""
        join = lambda c: np.concatenate([getattr(s, c) for s in sent])
        (V, at_v), U, (W, at_w) = np.unique(join("V"), return_index=True), np.unique(join("U")), np.unique(join("W"), return_index=True)
        to_v, to_u, to_w = ([np.searchsorted(own, getattr(s, c)) for s in sent] for c, own in (("V", V), ("U", U), ("W", W)))
        move = lambda to, c: np.concatenate([t[getattr(s, c)] for t, s in zip(to, sent)])
        v = move(to_v, "v")
        return Sent(V, join("Vn")[at_v], U, W, join("Wn")[at_w], v, np.ones(len(v), np.int64), move(to_u, "u"), join("nu"), move(to_w, "w"), join("times"), move(to_v, "cv"), move(to_u, "cu"), join("sums"))


def codes_of(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-np.log10(p) / STEP), 65535).astype("<u2")


def value_of(codes: np.ndarray) -> np.ndarray:
    return 10.0 ** (-STEP * codes.astype(np.float64))


def lay_out(sent: Sent, floor: float) -> bytes:
    """The trie of a shard from what all blocks sent: levels in one buffer. floor: N + V + 1."""
    V, U, W, head_n = sent.V, sent.U, sent.W, sent.Vn
    p1, seen = (sent.Wn + 1) / floor, sent.times > 0
    v, u, w, n, cv, cu, cn = sent.v[seen], np.repeat(sent.u, sent.nu)[seen], sent.w[seen], sent.times[seen], sent.cv, sent.cu, sent.sums
    # successors of v
    pairs, pair = np.unique(v * len(W) + w, return_inverse=True)
    c2 = np.bincount(pair, weights=n, minlength=len(pairs))
    pv = pairs // max(len(W), 1)
    p2 = (c2 + M2 * p1[pairs % max(len(W), 1)]) / (head_n[pv] + M2)
    start = np.searchsorted(pv, np.arange(len(V) + 1))
    # contexts (u, v): a spread one has its whole count, others the sum of their successors
    own, inside = np.unique(np.concatenate([v * len(U) + u, cv * len(U) + cu]), return_inverse=True)
    inside, spread = inside[: len(v)], inside[len(v) :]
    whole = np.bincount(spread, weights=cn, minlength=len(own))
    part = np.bincount(inside, weights=n, minlength=len(own))
    c12 = np.where(whole > 0, whole, part)
    degree = np.diff(start)[own // max(len(U), 1)]
    base = np.concatenate([[0], np.cumsum(degree)])
    # trigrams, as places among the successors of v
    full, at = np.unique(base[inside] + pair - start[v], return_inverse=True)
    c3 = np.bincount(at, weights=n, minlength=len(full))
    first = np.zeros(len(full), np.int64)
    first[at] = np.arange(len(at))
    p3 = (c3 + M3 * p2[pair[first]]) / (c12[inside[first]] + M3)
    levels = [EliasFano.pack(x) for x in (V, U, W, pairs, start, own, base, full)]
    codes = [codes_of(x).tobytes() for x in (p2, M2 / (head_n + M2), M3 / (c12 + M3), p3)]
    head = np.array([len(levels), len(codes), *(len(x) for x in levels), *(len(x) for x in codes)], "<i8").tobytes()
    return b"".join([head, *(x + bytes(-len(x) % 8) for x in (*levels, *codes))])


class Trie:
    """Levels of lay_out, read in place from bytes or a memory map."""

    def __init__(self, raw):
        raw = memoryview(raw)
        n, m = (int(x) for x in np.frombuffer(raw, "<i8", 2))
        sizes = np.frombuffer(raw, "<i8", n + m, 16).tolist()
        parts, at = [], 16 + 8 * (n + m)
        for size in sizes:
            parts.append(raw[at : at + size])
            at += size + -size % 8
        self.V, self.U, self.W, self.pairs, self.start, self.own, self.base, self.full = map(EliasFano, parts[:n])
        self.p2, self.back2, self.back3, self.p3 = (np.frombuffer(x, "<u2") for x in parts[n:])

    @staticmethod
    def open(path: str) -> Trie:
        """From a file that the operating system maps into memory."""
        with open(path, "rb") as file:
            return Trie(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def codes(self, s: Sent, floor: float) -> np.ndarray:
        """Quantised -log10 p(w|u,v), in steps, of the trigrams that were sent, by backing off where a node is missing."""
        # the words are looked up once each, contexts once for each run of them
        V, U, W = self.V.find(s.V), self.U.find(s.U), self.W.find(s.W)
        head, at_u = V[s.v[np.cumsum(s.nu) - s.nu]], U[s.u]
        own = np.full(len(head), -1, np.int64)
        both = (at_u >= 0) & (head >= 0)
        own[both] = self.own.find(head[both] * self.U.n + at_u[both])
        span = np.zeros(len(head), np.int64)  # where the context's successors begin, less where those of v do
        span[own >= 0] = self.base.get(own[own >= 0]) - self.start.get(head[own >= 0])
        own, span = np.repeat(own, s.nu), np.repeat(span, s.nu)
        v, w = V[s.v], W[s.w]
        pair = np.full(len(v), -1, np.int64)
        both = (v >= 0) & (w >= 0)
        pair[both] = self.pairs.find(v[both] * self.W.n + w[both])
        full = np.full(len(v), -1, np.int64)
        both = (pair >= 0) & (own >= 0)
        full[both] = self.full.find(span[both] + pair[both])
        p = np.where(pair >= 0, value_of(self.p2)[pair] if len(self.p2) else 0, np.where(v >= 0, value_of(self.back2)[v] if len(self.back2) else 1, 1) * ((s.Wn + 1) / floor)[s.w])
        p[own >= 0] *= value_of(self.back3[own[own >= 0]])
        found = codes_of(p)
        found[full >= 0] = self.p3[full[full >= 0]]
        return found


def answer(floor: float):
    """A function for groups: one shard's rows to each block's codes."""

    def run(rows: pa.Table) -> pa.Table:
        shard, sent = rows.column("shard")[0].as_py(), [Sent.of(p.as_py()) for p in rows.column("payload")]
        whole = Sent.of_all(sent)
        codes = Trie(lay_out(whole, floor)).codes(whole, floor)
        ends = np.cumsum([len(s.w) for s in sent]).tolist()
        out = [(block, shard, frame(b"", pack_ints(codes[a:b]))) for block, a, b in zip(rows.column("block").to_pylist(), [0, *ends], ends)]
        return reply_table(out)

    return run


def add_up(slots: int, tokens: int, kinds: int, documents: int, shards: int):
    """A function for cogroup: a block with the replies of the words (slot at least 0) and of the shards (slot below 0) to a row per document."""

    def run(own: pa.Table, replies: pa.Table) -> pa.Table:
        if not own.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2)], SCORES.names)
        words = pc.greater_equal(replies.column("slot"), 0)
        b = View(own, replies.filter(words), slots, documents)
        b.trigrams()
        mixed, spread = b.deal(tokens, shards)
        floor = tokens + kinds + 1
        base = np.log10((b.counts + 1) / floor)
        codes = codes_of((b.counts[b.w] + 1) / floor).astype(np.int64)
        answers = replies.filter(pc.invert(words))
        by_shard = {-1 - s: p for s, p in zip(answers.column("slot").to_pylist(), answers.column("payload"))}
        for shard, rows in spread_rows(b, mixed, spread, shards):
            codes[rows] = unpack_ints(unframe(by_shard[shard].as_py())[1])
        n = len(b.docs)
        token = b.stream[b.at]
        known = np.bincount(b.doc, weights=b.counts[token] > 0, minlength=n).astype(np.int64)
        score = -STEP * np.bincount(b.doc, weights=codes[b.which], minlength=n)
        base_score = np.bincount(b.doc, weights=base[token], minlength=n)
        columns = (pa.array(b.docs, pa.int64()), pa.array([m != 1 for m in b.marks], pa.bool_()), pa.array(np.array(b.sizes, np.int64) + 1), pa.array(known), pa.array(np.full(n, tokens)), pa.array(base_score), pa.array(score))
        return pa.table(list(columns), SCORES.names)

    return run


def score_texts(docs: DataFrame, is_train: Column, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per row of docs: doc_id, held_out (not trained on), n_tokens, n_known, train_tokens, base_score (unigrams), score (the model).

    Trains on the rows where is_train holds and scores all. Null texts count as empty: one token, the end. Repeated rows and null ids are
    kept each; a null is_train counts as false. Without training rows every token is unknown. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.lit(None).cast("string").alias("label"), F.when(is_train, 1).otherwise(0).alias("mark"))
    slots = slots_for(rows)
    parts = cut(split_blocks(rows, lambda: word_lists, slots, block_chars), "lm_blocks")
    words = cut(slot_rows(parts).groupBy("slot").applyInArrow(number_words, REPLIES), "lm_words")
    # sums: a small row per slot
    sums = sum((unpack_ints(unframe(bytes(r["payload"]))[1]) for r in words.filter("block = -1").collect()), np.zeros(2, np.int64))
    documents = block_rows(parts).select(F.sum(F.aggregate("marks", F.lit(0), lambda a, m: a + m)).cast("bigint")).first()[0] or 0
    tokens, kinds = int(sums[0]) + documents, int(sums[1]) + (documents > 0)
    shards = max(1, -(-tokens // shard_tokens))
    to_blocks = words.filter("block >= 0")
    sent = block_rows(parts).groupBy("block").cogroup(to_blocks.groupBy("block")).applyInArrow(send_trigrams(slots, tokens, documents, shards), SHARDS)
    answers = sent.groupBy("shard").applyInArrow(answer(tokens + kinds + 1), REPLIES).select("block", (-1 - F.col("slot")).cast("int").alias("slot"), "payload")
    return block_rows(parts).groupBy("block").cogroup(to_blocks.unionByName(answers).groupBy("block")).applyInArrow(add_up(slots, tokens, kinds, documents, shards), SCORES)
