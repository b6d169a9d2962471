"""Operators 11 to 13 against brute force, and the parts that they share."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quarry.llm import alignment, collocations, language_model
from quarry.llm.blocks import pack_ints, unpack_ints
from quarry.llm.elias_fano import EliasFano
from quarry.llm.quotient_filter import pack_filter, permute, restore, summed, unpack_filter

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def documents(spark, rows, lang="en"):
    return spark.createDataFrame([(d, t, lang, "x", "y") for d, t in rows], "doc_id bigint, text string, lang string, block string, SLOT string")


def babble(seed: int, n: int, words: int = 40) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(("Foo", "bar,", "bar", "baz.", "of", "THE", "the", "é", "x!y", "don't")) + draw.choice(("", "", "a", "b")) for _ in range(draw.randint(0, n)))[: words * 20]


ODD = [(None, "x y"), (7, None), (7, ""), (8, " "), (8, "same text here"), (8, "same text here"), (9, "\t\n.;"), (10, "word " * 3000), (11, "日本語の長い文章" * 900), (12, "<|endoftext|> <s> ▁ x")]


@pytest.mark.parametrize("numbers", [[], [0], [5], [0, 0, 0], list(range(100)), [3, 3, 9, 1000, 2**40], sorted(random.Random(1).randrange(10**9) for _ in range(3000))])
def test_elias_fano(numbers):
    found = EliasFano(memoryview(EliasFano.pack(np.array(numbers, np.int64))))
    assert found.get(np.arange(len(numbers))).tolist() == numbers
    asked = np.array(sorted({0, 1, 2**41, *numbers, *(x + 1 for x in numbers)}))
    assert found.successor(asked).tolist() == np.searchsorted(np.array(numbers, np.int64), asked).tolist()
    assert [p >= 0 for p in found.find(asked).tolist()] == [x in set(numbers) for x in asked.tolist()]
    alone = EliasFano(memoryview(EliasFano.pack(np.array(numbers, np.int64))))  # few queries: no table
    assert [int(alone.successor(np.array([x]))[0]) for x in asked[:50].tolist()] == np.searchsorted(np.array(numbers, np.int64), asked[:50]).tolist()
    assert alone.table is None or len(numbers) <= 4


@pytest.mark.parametrize("bits", [2, 13, 64, 65, 128])
def test_quotient_filter_gives_its_keys_back(bits):
    draw = random.Random(bits)
    half = (bits + 1) // 2
    keys = [(draw.randrange(1 << half), draw.randrange(1 << half)) for _ in range(500)]
    high, low = (np.array(c, np.uint64) for c in zip(*keys))
    ph, pl = permute(high, low, bits)
    assert [x.tolist() for x in restore(ph, pl, bits)] == [high.tolist(), low.tolist()]
    ph, pl, counts = summed(ph, pl, np.where(np.arange(500) % 7 == 0, 10**10, 3), bits)
    packed = unpack_filter(pack_filter(ph, pl, counts, bits, 0, 1 << half), bits)
    assert [x.tolist() for x in packed] == [ph.tolist(), pl.tolist(), counts.tolist()]
    assert len(ph) == len(set(keys))


@pytest.mark.parametrize("parts", [3, 14])
def test_quotient_filters_of_ranges_give_their_keys_back(parts):
    bits, size = 40, -(-(1 << 20) // parts)
    draw = np.random.default_rng(parts)
    high, low, counts = summed(draw.integers(0, 1 << 20, 500, np.uint64), draw.integers(0, 1 << 20, 500, np.uint64), np.ones(500, np.int64), bits)
    for first in range(0, 1 << 20, size):
        own = (high >= first) & (high < first + size)
        packed = unpack_filter(pack_filter(high[own], low[own], counts[own], bits, first, size), bits)
        assert [x.tolist() for x in packed] == [high[own].tolist(), low[own].tolist(), counts[own].tolist()]


def test_packed_numbers():
    numbers = np.array([0, 1, -1, 2**62, 255, 256])
    assert unpack_ints(pack_ints(numbers)).tolist() == numbers.tolist() and unpack_ints(pack_ints(numbers[:0])).tolist() == []


# Operator 11 --------------------------------------------------------------------------------------------------------


def collocations_by_sql(rows, least, kept):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    return sorted(con.execute(collocations.ORACLE.replace(">= 100 GROUP", ">= 100 GROUP").replace("HAVING count(*) >= 100", f"HAVING count(*) >= {least}").replace("rank <= 2000", f"rank <= {kept}")).fetchall())


@pytest.mark.parametrize(("least", "kept", "block"), [(2, 50, 300), (5, 2000, 1 << 20), (40, 3, 1000)])
def test_collocations(spark, least, kept, block):
    rows = [(babble(i, 60), ("en", None, "de", "und")[i % 4]) for i in range(150)] + [(None, "en"), ("", None), ("a\tb  a b\x0ba b! a b", "en"), ("q r s " * 200, "fr"), ("q r s " * 200, "fr")]
    docs = spark.createDataFrame([(t, g, 1, 2) for t, g in rows], "text string, lang string, Label int, mark int").repartition(3)
    found = collocations.mine(docs, least=least, kept=kept, block_chars=block)
    assert sorted(tuple(r) for r in found.collect()) == collocations_by_sql(rows, least, kept)


def test_collocations_counted_in_several_ranges(spark, monkeypatch):
    """More tokens than a range holds, and their number of ranges no power of two."""
    rows = [(babble(i % 12, 60), ("en", None)[i % 2]) for i in range(72)]
    tokens = sum(len(re.findall(r"[^\s.,;:!?]+", t)) for t, _ in rows)
    monkeypatch.setattr(collocations, "RANGE", tokens // 5)
    found = collocations.mine(spark.createDataFrame(rows, "text string, lang string"), least=5, kept=500)
    assert sorted(tuple(r) for r in found.collect()) == collocations_by_sql(rows, 5, 500)


def test_collocations_exact_beyond_64_bits(spark):
    n, a, part = 10**14 + 7, 10**13 + 1, 10**13 + 3
    phrases = spark.createDataFrame([([1, 2], a)], "ids array<int>, f bigint")
    words = spark.createDataFrame([(1, "en", b"x", part), (2, "en", b"y", part)], "id int, label string, word binary, f bigint")
    found = collocations.best_phrases(phrases, words, spark.createDataFrame([("en", n)], "label string, n bigint")).first()
    assert found["score"] == 1000 * a * n // (part * part)


def test_collocations_of_nothing(spark):
    assert collocations.mine(spark.createDataFrame([], "text string, lang string")).collect() == []
    assert collocations.mine(spark.createDataFrame([("one two", "en")], "text string, lang string")).collect() == []


# Operator 12 --------------------------------------------------------------------------------------------------------


def naive_scores(rows):
    """Probabilities straight from counters, for one row after another."""
    words = [[w for w in re.split(rb"[\x20\x09-\x0d]+", (t or "").encode().translate(LOWER)) if w] + [1] for _, t in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    one, two, three, after, after2 = Counter(), Counter(), Counter(), Counter(), Counter()
    for s in (["^", "^", *w] for w, h in zip(words, held) if not h):
        for u, v, w in zip(s, s[1:], s[2:]):
            one[w] += 1
            two[v, w] += 1
            three[u, v, w] += 1
            after[v] += 1
            after2[u, v] += 1
    n, kinds, out = sum(one.values()), len(one), []
    for (d, _), ws, h in zip(rows, words, held):
        base = score = 0
        s = ["^", "^", *ws]
        for u, v, w in zip(s, s[1:], s[2:]):
            p = (one[w] + 1) / (n + kinds + 1)
            base += math.log10(p)
            for c, t, m in ((two[v, w], after[v], language_model.M2), (three[u, v, w], after2[u, v], language_model.M3)):
                p = (c + m * p) / (t + m)
            score += math.log10(p)
        out.append((d, h, len(ws), sum(one[w] > 0 for w in ws), n, base, score))
    return out


@pytest.mark.parametrize(("block", "shard"), [(1 << 20, 1 << 20), (500, 150), (4000, 30)])
def test_language_model(spark, block, shard):
    rows = [(i, babble(i % 150, 60)) for i in range(200)] + ODD
    found = language_model.score_texts(documents(spark, rows).repartition(3), ~language_model.held_out(), block_chars=block, shard_tokens=shard).collect()
    key = lambda r: (r[0] or -1, r[2], round(r[5], 6))
    for got, want in zip(sorted(map(tuple, found), key=key), sorted(naive_scores(rows), key=key), strict=True):
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5])
        assert abs(got[6] - want[6]) <= got[2] * language_model.STEP


def asked(trigrams, counts, heads):
    """Trigrams (v, u, w, times) as a block sends them."""
    V, U, W = (sorted({t[i] for t in trigrams}) for i in range(3))
    trigrams = sorted(trigrams)
    columns = [[V.index(t[0]) for t in trigrams], [1] * len(trigrams), [U.index(t[1]) for t in trigrams], [1] * len(trigrams), [W.index(t[2]) for t in trigrams], [t[3] for t in trigrams]]
    return language_model.Sent(*(np.array(c, np.int64) for c in (V, [heads.get(x, 0) for x in V], U, W, [counts.get(x, 0) for x in W], *columns, [], [], [])))


def test_language_model_is_a_distribution(tmp_path):
    """Over all known words and one unknown word the probabilities of a context add up to one, but for quantisation; also from a mapped file."""
    counts, heads = {2: 8, 3: 7, 4: 5, 5: 9}, {2: 8, 3: 1}
    floor = sum(counts.values()) + len(counts) + 1
    raw = language_model.lay_out(language_model.Sent.of_all([asked([(2, 4, 3, 6), (3, 2, 5, 1)], counts, heads), asked([(2, 4, 5, 2)], counts, heads)]), floor)
    (tmp_path / "shard").write_bytes(raw)
    for context in ((2, 4), (2, 9), (3, 2), (3, 3), (77, 1)):
        query = asked([(*context, w, 0) for w in (2, 3, 4, 5, 99)], counts, heads)
        codes = language_model.Trie(raw).codes(query, floor)
        assert language_model.value_of(codes).sum() == pytest.approx(1, abs=2e-3)
        assert language_model.Trie.open(str(tmp_path / "shard")).codes(query, floor).tolist() == codes.tolist()


def test_language_model_without_training_or_rows(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    found = {r["doc_id"]: r for r in language_model.score_texts(docs, F.lit(False)).collect()}
    assert [found[1]["n_tokens"], found[1]["n_known"], found[1]["train_tokens"], found[1]["score"], found[2]["n_tokens"]] == [3, 0, 0, 0.0, 1]
    assert language_model.score_texts(documents(spark, []), F.lit(True)).collect() == []


def test_language_model_is_better_than_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [r for r in language_model.score_texts(docs, ~language_model.held_out()).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > 0.93 * sum(r["base_score"] for r in rows)


# Operator 13 --------------------------------------------------------------------------------------------------------


def naive_alignment(rows):
    """Whole texts through both tokenizers, two pointers over their ends."""
    c, found, counts = alignment.Coder(*PATHS), [], Counter()
    for d, text in rows:
        a, b = (c.a.encode(" " + text, add_special_tokens=False).ids, c.b.encode(text)) if text else ([], [])
        if not text or not (b"".join(c.bytes_a[i] for i in a) == b"".join(c.bytes_b[i] for i in b) == b" " + text.encode()):
            found.append((d, None))
            continue
        pairs, groups, i, j, x, y = [], [], 0, 0, len(c.bytes_a[a[0]]), len(c.bytes_b[b[0]])
        first = (0, 0)
        while True:
            pairs.append((a[i], b[j]))
            if x == y:
                groups.append(",".join(map(str, a[first[0] : i + 1])) + "|" + ",".join(map(str, b[first[1] : j + 1])))
                i, j = i + 1, j + 1
                if i == len(a):
                    break
                first, x, y = (i, j), x + len(c.bytes_a[a[i]]), y + len(c.bytes_b[b[j]])
            elif x < y:
                i += 1
                x += len(c.bytes_a[a[i]])
            else:
                j += 1
                y += len(c.bytes_b[b[j]])
        counts.update(pairs)
        found.append((d, (len(a), len(b), pairs, groups)))
    best: dict[int, int] = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    for d, r in found:
        yield (d, 0, 0, 0, 0, 0, 0, "") if r is None else (d, r[0], r[1], len(r[3]), len(r[2]), sum(counts[p] == best[p[1]] for p in r[2]), sum(counts[p] for p in r[2]), hashlib.sha256(";".join(r[3]).encode()).hexdigest())


@pytest.mark.parametrize("block", [1 << 20, 700])
def test_alignment(spark, block):
    draw = random.Random(3)
    signs = "ab c'sréd.,;\n\t\r 日本語👍<|endoftext|> 　\x1c\xa012ﬁé  don't{} "
    rows = [(i, "".join(draw.choice(signs) for _ in range(draw.randint(0, 80)))) for i in range(400)] + [(i, babble(i, 50)) for i in range(400, 450)] + ODD + [(13, "x1,y2;" * 3000), (14, "a" * 9000)]
    found = alignment.align_texts(documents(spark, rows).repartition(3), *PATHS, block_chars=block).collect()
    key = lambda r: (r[0] or -1, *r[1:])
    assert sorted(map(tuple, found), key=key) == sorted(naive_alignment(rows), key=key)


def test_alignment_of_nothing(spark):
    assert alignment.align_texts(documents(spark, []), *PATHS).collect() == []
    assert [tuple(r) for r in alignment.align_texts(documents(spark, [(1, None), (2, "a▁b")]), *PATHS).orderBy("doc_id").collect()] == [(1, *[0] * 6, ""), (2, *[0] * 6, "")]
