"""The pipeline's stages against brute force at the smallest scale."""

import collections
import hashlib
import random
import re

import pytest

import corpus_pipeline
from quarry.llm import decontaminate, quality, simhash
from quarry.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    before = {r.doc_id: r.text for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == table(spark, SF, "documents").columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    good = {r.doc_id for r in table(spark, SF, "labels").filter("quality = 1").collect()}
    assert len(good - set(kept["quality"])) <= 0.05 * len(good)
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    largest = {}
    for i, t in kept["quality"].items():
        largest[lower(t)] = max(i, largest.get(lower(t), i))
    assert set(kept["exact_dedup"]) == set(largest.values())
    prints = {i: simhash.fingerprint(t.encode(), 4) & (1 << 64) - 1 for i, t in kept["exact_dedup"].items()}
    gone = set(kept["exact_dedup"]) - set(kept["near_dedup"])
    assert all(any(j < i and (prints[i] ^ prints[j]).bit_count() <= 4 for j in prints) for i in gone)
    left = sorted(kept["near_dedup"])
    assert all((prints[a] ^ prints[b]).bit_count() > 4 for k, a in enumerate(left) for b in left[:k])
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    items = [plain(r.text) for r in table(spark, SF, "benchmark").collect()]
    assert set(kept["decontaminate"]) == {i for i, t in kept["near_dedup"].items() if not any(x in plain(t) for x in items)}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id: r.decoded_sha256 for r in last} == {i: hashlib.sha256((before[i] or "").encode()).hexdigest() for i in kept["decontaminate"]}


#: Names that the stages use inside, as columns of the documents.
CLASHING = ["digest", "n_bytes", "KEY", "fp", "q_fp", "q_number", "q_key", "q_digest", "Q_Tail", "grade", "keep_id", "l_digest", "b_id", "b_key", "block", "ids", "t_words", "h", "copy"]
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, equal, near and repeated rows, a benchmark item, and columns whose names clash."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(400)]
    item = next(r.text for r in table(spark, SF, "benchmark").collect() if len(r.text.split()) > 12)
    texts = [(1, None), (None, None), (2, ""), (None, ""), (3, " \n\t"), (4, " ".join(base)), (4, " ".join(base)), (5, " ".join(base).upper()), (None, " ".join(base)), (6, " ".join([*base[:200], "x", *base[201:]]))]
    texts += [(7, " ".join(word() for _ in range(60_000))), (8, f"{word()} {word()}. {item} {word()}"), (9, "字" * 3_000), (10, "Ä ä 😀 \x00 one"), (10, "another text of the same id"), (None, None)]
    rows = [(i, t, None if n % 2 else "en", None if n % 3 else "web", None if n % 5 else len(t or ""), *[n if n % 2 else None] * len(CLASHING)) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {', '.join(f'{c} long' for c in CLASHING)}")


def bag(df):
    return collections.Counter(map(tuple, df.collect()))


def test_stages_of_odd_tables(spark, odd):
    """Each stage keeps rows as they are, those that it should, whatever their ids, texts and columns."""
    before = bag(odd)
    good = corpus_pipeline.keep_good(spark, odd, SF)
    assert good.columns == odd.columns and not bag(good) - before

    exact = bag(corpus_pipeline.drop_copies(spark, odd, SF))
    assert not exact - before
    rank = lambda i: (i is not None, i or 0)
    largest = {}
    for row in before:
        text = (row[1] or "").translate(LOWER)
        largest[text] = max(largest.get(text, (False, 0)), rank(row[0]))
    assert collections.Counter(((r[1] or "").translate(LOWER), rank(r[0])) for r in exact.elements()) == collections.Counter(largest.items())

    near = bag(corpus_pipeline.drop_near_copies(spark, odd, SF))
    assert not near - before
    prints = {t: simhash.fingerprint((t or "").encode(), 4) & (1 << 64) - 1 for _, t, *_ in before}
    linked = lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4
    left = [r[1] for r in near.elements()]
    assert not any(linked(a, b) for k, a in enumerate(left) for b in left[:k]) and all(any(linked(r[1], t) for t in left) for r in before)

    clean = bag(corpus_pipeline.drop_leaks(spark, odd, SF))
    assert before - clean == collections.Counter(r for r in before.elements() if r[0] == 8) and not clean - before

    encoded = corpus_pipeline.encode(spark, odd, SF).collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert collections.Counter((r.doc_id, r.decoded_sha256) for r in encoded) == collections.Counter((r[0], sha(r[1])) for r in before.elements())


def test_stages_of_empty_tables(spark, odd):
    """No documents, labels or items: no rows, or all rows as they were."""
    for name, stage in corpus_pipeline.STAGES[:-1]:
        none = stage(spark, odd.limit(0), SF)
        assert none.columns == odd.columns and none.count() == 0, name
    assert corpus_pipeline.encode(spark, odd.limit(0), SF).count() == 0
    labels, items = (table(spark, SF, n).limit(0) for n in ("labels", "benchmark"))
    assert bag(quality.select_good(odd, labels)) == bag(odd) == bag(decontaminate.drop_contaminated(odd, items))
    nulls = spark.createDataFrame([(None, 1), (1, None), (None, None)], "doc_id long, quality int")
    assert bag(quality.select_good(odd, nulls)) == bag(odd)
    blank = spark.createDataFrame([(None, "a b c d e"), (1, None), (2, ""), (3, "..")], "item_id long, text string")
    assert bag(decontaminate.drop_contaminated(odd, blank)) == bag(odd)
