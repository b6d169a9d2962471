"""Phrases whose words occur together more often than their parts would by chance (operator 11).

Words are numbered over all blocks (blocks.py); those below the least count can be in no candidate and become breaks. Phrases of 2, 3, ...
words are counted length by length: a task packs the ids of each phrase into one key and keeps a counting quotient filter, whose
entries go out by ranges of quotients; what all tasks send for a range is merged in order. A phrase is counted only if its first and last
words but one passed a bitmap of the frequent phrases that are one word shorter: the bitmap has a fixed size and lets some others through, which
the exact counts then drop. So nothing that is held or sent to every task grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blocks import BLOCK_CHARS, REPLIES, block_rows, by_number, pack_ints, reply, reply_table, slot_rows, slot_words, slots_for, split_blocks, unpack_ints
from .byte_bpe import frame, pack_bytes, unframe, unpack_bytes
from .common import cut, map_arrow, struct
from .language_model import parts_of
from .quotient_filter import half_bits, pack_filter, permute, restore, summed, unpack_filter

# Separators of pieces, made full stops, and A-Z to a-z, tab to space.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
SIGNS = bytes.maketrans(BREAKS + b"\t" + bytes(range(65, 91)), b"." * len(BREAKS) + b" " + bytes(range(97, 123)))
STOP = b"."
LEAST, LONGEST, KEPT, FACTOR = 100, 5, 2000, 1000
#: Bits of the bitmap, and of a part of it that one task makes.
BITMAP, PART = 1 << 26, 1 << 20
#: Phrases that a task holds before it adds them up, and of a range, on average.
HELD, RANGE = 1 << 22, 1 << 21
#: Parts in which a language's candidates are ranked before their best ones meet.
RANKED = 64
SEQUENCES = struct(("block", "bigint"), ("ids", "binary"))
FILTERS = struct(("part", "int"), ("payload", "binary"))
COUNTED = struct(("ids", "array<int>"), ("f", "bigint"))
WORDS = struct(("id", "int"), ("label", "string"), ("word", "binary"), ("f", "bigint"))


def word_lists(text: str) -> Iterator[list[bytes]]:
    """Words and stops between pieces, lower-cased."""
    for part in parts_of(text.encode().translate(SIGNS), b" ."):
        yield part.replace(STOP, b" . ").split()
    yield [STOP]


def number_words(least: int):
    """A function for groups: one slot's words to ids of the frequent ones (0 for others), as replies to the blocks; and one row (block -1) with the frequent words."""

    def run(rows: pa.Table) -> pa.Table:
        slot = rows.column("slot")[0].as_py()
        total: dict[tuple[str, bytes], int] = {}
        labels = rows.column("label").to_pylist()
        for label, (_, words, _, counts) in zip(labels, slot_words(rows)):
            for word, n in zip(words, counts.tolist()):
                total[label, word] = total.get((label, word), 0) + n
        frequent = sorted(((k, n) for k, n in total.items() if n >= least and k[1] != STOP), key=lambda x: (-x[1], x[0]))
        place = {k: i + 1 for i, (k, _) in enumerate(frequent)}
        out = [reply(-1, slot, b"", pack_ints(np.array([n for _, n in frequent], np.int64)), pack_bytes([label.encode() for (label, _), _ in frequent]), pack_bytes([word for (_, word), _ in frequent]))]
        for label, (block, words, numbers, _) in zip(labels, slot_words(rows)):
            out.append(reply(block, slot, numbers, pack_ints(np.fromiter((place.get((label, w), 0) for w in words), np.int64, len(words)))))
        return reply_table(out)

    return run


def frequent_words(slots: int):
    """Rows of block -1 to a row per frequent word; its id is its place in the slot and the slot itself, interleaved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slot, payload in zip(batch.column("slot").to_pylist(), batch.column("payload")):
                _, counts, labels, words = unframe(payload.as_py())
                counts = unpack_ints(counts)
                ids = np.arange(len(counts)) * slots + slot + 1
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array([x.decode() for x in unpack_bytes(labels)], pa.string()), pa.array(unpack_bytes(words), pa.binary()), pa.array(counts)], WORDS.names)

    return run


def with_ids(slots: int):
    """A function for cogroup: a block's documents as one sequence of word ids, with 0 between pieces and for infrequent words."""

    def run(own: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        if own.num_rows:
            sequence = unpack_ints(own.column("payload")[0].as_py())
            n = int(sequence.max(initial=-1)) + 1
            local = by_number(replies, n, 0)
            slot = np.zeros(n, np.int64)
            for payload, s in zip(replies.column("payload"), replies.column("slot").to_pylist()):
                slot[np.cumsum(unpack_ints(unframe(payload.as_py())[0]))] = s
            ids = np.where(local > 0, (local - 1) * slots + slot + 1, 0)
            out.append((own.column("block")[0].as_py(), pack_ints(ids[sequence])))
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.binary()))], SEQUENCES.names)

    return run


def keys_of(columns: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids of `bits` bits each, packed: high and low half of the key's bits, and how many bits it has."""
    total = bits * len(columns)
    half = half_bits(total)
    high, low = np.zeros(len(columns[0]), np.uint64), np.zeros(len(columns[0]), np.uint64)
    for i, c in enumerate(columns):  # the first word takes the highest bits
        at, x = bits * (len(columns) - 1 - i), c.astype(np.uint64)
        if at < half:
            low |= x << np.uint64(at)
        if at + bits > half:
            high |= x << np.uint64(at - half) if at >= half else x >> np.uint64(half - at)
    mask = np.uint64((1 << half) - 1)
    return high & mask, low & mask, total


def ids_of(high: np.ndarray, low: np.ndarray, bits: int, words: int) -> np.ndarray:
    half, mask, out = half_bits(bits * words), np.uint64((1 << bits) - 1), []
    for i in range(words):
        at = bits * (words - 1 - i)
        x = high >> np.uint64(at - half) if at >= half else low >> np.uint64(at)
        if at < half < at + bits:
            x |= high << np.uint64(half - at)
        out.append(x & mask)
    return np.stack(out, 1).astype(np.int64) if len(high) else np.zeros((0, words), np.int64)


def bit_of(columns: list[np.ndarray]) -> np.ndarray:
    """The place of a phrase in the bitmap."""
    with np.errstate(over="ignore"):
        x = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            x = (x ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
    return (x % np.uint64(BITMAP)).astype(np.int64)


def count_phrases(sequences: DataFrame, words: int, bits: int, parts: int, shorter) -> DataFrame:
    """Filters of the phrases of so many words, by ranges. shorter: a broadcast bitmap of the frequent phrases one word shorter; None for pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shorter.value, np.uint8) if shorter else None
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            high, low, counts = summed(*(np.concatenate(c) for c in zip(*held)), bits * words)
            held.clear()
            size = -(-(1 << half_bits(bits * words)) // parts)
            cuts = np.searchsorted(high, np.array([i * size for i in range(parts)] + [(1 << half_bits(bits * words)) - 1], np.uint64))
            cuts[-1] = len(high)
            out = [(i, pack_filter(high[a:b], low[a:b], counts[a:b], bits * words, i * size, size)) for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if b > a]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.binary())], FILTERS.names)

        for batch in batches:
            for payload in batch.column("ids"):
                ids = unpack_ints(payload.as_py())
                for a in range(0, max(len(ids) - words + 1, 0), HELD):
                    part = ids[a : a + HELD + words - 1]
                    n = len(part) - words + 1
                    columns = [part[i : i + n] for i in range(words)]
                    keep = np.logical_and.reduce([c > 0 for c in columns])
                    columns = [c[keep] for c in columns]
                    if bitmap is not None:
                        for some in (slice(None, -1), slice(1, None)):
                            at = bit_of(columns[some])
                            keep = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                            columns = [c[keep] for c in columns]
                    high, low, total = keys_of(columns, bits)
                    high, low = permute(high, low, total)
                    held.append(summed(high, low, np.ones(len(high), np.int64), total))
                    if sum(len(h[0]) for h in held) >= HELD:
                        yield flush()
        if held:
            yield flush()

    return map_arrow(sequences.select("ids"), run, FILTERS)


def merge_filters(words: int, bits: int, least: int):
    """A function for groups: the filters of one range to the phrases that occur often enough."""

    def run(rows: pa.Table) -> pa.Table:
        found = None
        for payload in rows.column("payload"):
            more = unpack_filter(payload.as_py(), bits * words)
            found = more if found is None else summed(*(np.concatenate(c) for c in zip(found, more)), bits * words)
        high, low, counts = found
        often = counts >= least
        ids = ids_of(*restore(high[often], low[often], bits * words), bits, words)
        return pa.table([pa.array(ids.tolist(), pa.list_(pa.int32())), pa.array(counts[often])], COUNTED.names)

    return run


def bitmap_of(phrases: DataFrame) -> bytes:
    """A bitmap of BITMAP bits, some for each phrase, made in parts of PART bits; its size is fixed."""
    schema = struct(("part", "int"), ("at", "int"))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.array(batch.column("ids").to_pylist(), np.int64)
            at = np.unique(bit_of(list(ids.T))) if len(ids) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // PART, pa.int32()), pa.array(at % PART, pa.int32())], schema.names)

    def part(rows: pa.Table) -> pa.Table:
        whole = np.zeros(PART, np.uint8)
        whole[rows.column("at").to_numpy()] = 1
        return pa.table([rows.column("part").slice(0, 1), pa.array([np.packbits(whole, bitorder="little").tobytes()], pa.binary())], FILTERS.names)

    made = map_arrow(phrases.select("ids"), bits, schema).distinct().groupBy("part").applyInArrow(part, FILTERS)
    out = bytearray(BITMAP // 8)
    for row in made.collect():  # at most BITMAP / PART rows of PART bits
        out[row["part"] * PART // 8 : (row["part"] + 1) * PART // 8] = row["payload"]
    return bytes(out)


def frequent_phrases(spark: SparkSession, sequences: DataFrame, tokens: int, bits: int, least: int, longest: int) -> DataFrame:
    """ids and f of all phrases of 2 to `longest` words that occur at least `least` times."""
    found, shorter = [], None
    parts = max(1, -(-tokens // RANGE))
    for words in range(2, longest + 1):
        filters = count_phrases(sequences, words, bits, parts, shorter)
        found.append(cut(filters.groupBy("part").applyInArrow(merge_filters(words, bits, least), COUNTED), f"phrases{words}"))
        if words < longest:
            shorter = spark.sparkContext.broadcast(bitmap_of(found[-1]))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def best_phrases(phrases: DataFrame, words: DataFrame, totals: DataFrame, kept: int = KEPT, factor: int = FACTOR) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best candidates. phrases: ids, f; words: id, label, word, f; totals: label, n."""
    parts = phrases.unionByName(words.select(F.array("id").alias("ids"), "f"))
    cuts = phrases.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("ids", 1, F.col("k")).alias("head"), F.expr("slice(ids, k + 1, size(ids) - k)").alias("tail"))
    cuts = cuts.join(parts.select(F.col("ids").alias("head"), F.col("f").alias("l")), "head").join(parts.select(F.col("ids").alias("tail"), F.col("f").alias("r")), "tail")
    # a word has one language, so the first word's is the phrase's
    cuts = cuts.join(words.select(F.col("id").alias("first"), F.col("label").alias("lang")), F.get("ids", F.lit(0)) == F.col("first")).join(totals.withColumnRenamed("label", "lang"), "lang")
    score = F.expr(f"(CAST(a AS DECIMAL(19,0)) * CAST({factor} * n AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))").cast("bigint")
    scored = cuts.withColumn("score", score).groupBy("ids", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("ids", "lang", "a", "n", "cut.l", "cut.r", "cut.score")
    # what a longer candidate covers: its parts of two words or more, each with the highest count of a longer one
    size = F.size("ids")
    inner = phrases.filter(size > 2).select("ids", "f", F.explode(F.sequence(F.lit(2), size - 1)).alias("k"))
    inner = inner.select("ids", "f", "k", F.explode(F.sequence(F.lit(1), F.size("ids") - F.col("k") + 1)).alias("at"))
    covered = inner.groupBy(F.expr("slice(ids, at, k)").alias("ids")).agg(F.max("f").alias("most"))
    left = scored.join(covered, "ids", "left").filter("most IS NULL OR 100 * most < 100 * a").drop("most")
    spelt = left.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", F.col("word").cast("string").alias("word")), "id")
    spelt = spelt.groupBy("ids").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    rows = left.join(spelt, "ids").withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(RANKED)))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= kept)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= kept)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, kept: int = KEPT, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best `kept` phrases.

    Null texts count as empty, a null language as `und`; repeated rows count each; other columns are ignored. Ties go by count, then by the phrase's bytes.
    Five ids go into 128 bits, so more than 2^25 frequent words are a ValueError.
    """
    spark = docs.sparkSession
    rows = docs.select(F.lit(None).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(lang_col), F.lit("und")).alias("label"), F.lit(1).alias("mark"))
    slots = slots_for(rows)
    parts = cut(split_blocks(rows, lambda: word_lists, slots, block_chars), "phrase_blocks")
    numbered = cut(slot_rows(parts).groupBy("slot").applyInArrow(number_words(least), REPLIES), "phrase_words")
    words = cut(map_arrow(numbered.filter("block = -1").select("slot", "payload"), frequent_words(slots), WORDS), "frequent_words")
    # all words but the stops, which are counted in the documents' sizes
    stops = map_arrow(slot_rows(parts).select("label", "payload"), count_stops, struct(("label", "string"), ("n", "bigint")))
    sizes = block_rows(parts).select("label", F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n"))
    totals = cut(sizes.unionByName(stops).groupBy("label").agg(F.sum("n").alias("n")), "phrase_totals")
    sums = words.agg(F.max("id").alias("top")).first()["top"] or 1
    tokens = totals.agg(F.sum("n")).first()[0] or 0
    bits = int(sums).bit_length()
    if bits * longest > 128:
        raise ValueError(f"{longest} ids of {bits} bits; 128 bits in all are packed")
    sequences = cut(block_rows(parts).groupBy("block").cogroup(numbered.filter("block >= 0").groupBy("block")).applyInArrow(with_ids(slots), SEQUENCES), "sequences")
    return best_phrases(frequent_phrases(spark, sequences, tokens, bits, least, longest), words, totals, kept)


def count_stops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label, and less one for each stop between pieces."""
    for batch in batches:
        labels, n = [], []
        for label, payload in zip(batch.column("label").to_pylist(), batch.column("payload")):
            words, _, counts = unframe(payload.as_py())
            words = unpack_bytes(words)
            if STOP in words:
                labels.append(label)
                n.append(-int(unpack_ints(counts)[words.index(STOP)]))
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(n, pa.int64())], ["label", "n"])


ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS p FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, p, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
cand AS (SELECT *, string_split(p, ' ') AS ws FROM f WHERE k >= 2),
cuts AS (SELECT c.lang, c.p, c.f AS a, c.k AS len, t.n, j, l.f AS l, r.f AS r, (1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c JOIN total t USING (lang)
  JOIN f l ON l.lang = c.lang AND l.p = array_to_string(c.ws[1:c.j], ' ') JOIN f r ON r.lang = c.lang AND r.p = array_to_string(c.ws[c.j + 1:c.k], ' ')),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, j) AS z FROM cuts) WHERE z = 1),
inside AS (SELECT DISTINCT lang, p, f FROM (SELECT lang, f, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS p FROM (SELECT *, unnest(range(2, k)) AS m FROM cand WHERE k > 2))),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.p = b.p AND 100 * i.f >= 100 * b.a))
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, n, score::BIGINT AS score FROM kept) WHERE rank <= 2000
"""
