"""The operators for training data against brute force, on small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

import collections
import gzip
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers as P
import pytest
import regex
import tiktoken

from pyspark.sql import functions as F

from quarry.llm import alignment, byte_bpe, collocations, decontaminate, exact_dedup, html_extract, language_model, quality, simhash, suffix_dedup, toxicity, url_filters, warc
from quarry.llm.components import components

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids, null, empty, equal and long texts."""
    return [(1, "One Two"), (2, "one two"), (None, "ONE TWO"), (3, None), (4, ""), (5, "one  two"), (5, "one  two"), (6, "x " * 20_000), (7, "Ä"), (8, "ä")]


# 1 ------------------------------------------------------------------------------------------------------------------

QUESTION = "A train leaves Boston at 60 km per hour and travels for 3 hours before it stops near Chicago for water and coal."


def test_decontaminate(spark):
    docs = spark.createDataFrame(
        [
            (1, QUESTION), (2, "Before. A train leaves Denver at 85 km per hour and travels for 7 hours before it stops near Dallas for water and coal. After."),
            (3, "A train leaves Boston at 60 km per hour and then nothing else of that tale comes."), (4, None), (None, QUESTION.upper()), (5, ""), (1, QUESTION), (6, "clean words only " * 3000),
        ],
        DOCS,
    )
    bench = spark.createDataFrame([(9, QUESTION), (10, "tiny one"), (None, "x"), (11, None)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    assert {(1, 9), (2, 9)} <= found and not {3, 4, 5, 6} & {d for d, _ in found}
    wide = docs.selectExpr("doc_id", "text", "'a' AS key", "'b' AS place", "1 AS h", "2 AS item_id")
    clean = decontaminate.drop_contaminated(wide, bench)
    assert clean.columns == wide.columns and {3, 4, 5, 6} <= {r.doc_id for r in clean.collect()}
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0 and decontaminate.contaminated(docs.limit(0), bench).count() == 0


def test_slots_must_be_consistent(spark):
    item = "if a box holds 12 red balls and 12 blue balls then two boxes of 12 balls each hold how many balls in all of them"
    same, mixed = (item.replace("12", "{}").format(*n) for n in ((7, 7, 7), (7, 8, 9)))
    found = decontaminate.contaminated(spark.createDataFrame([(1, same), (2, mixed)], DOCS), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert [r.doc_id for r in found.collect()] == [1]


def test_partial_shifted_and_repeated_copies_keep_their_slots(spark):
    item = "every day the baker {0} bakes {1} small loaves of bread for sale before {0} walks home to eat and then the tired {0} counts all of those coins that were paid while neighbours of {0} sing some old songs"
    own = item.format("Martin", 40)
    words = own.split()
    half = " ".join(words[:26]) + " nothing else of this was ever written down by anybody who lived near there or anywhere at all in that land"
    inserted, deleted = " ".join([*words[:19], "quite", *words[19:]]), " ".join([*words[:19], *words[20:]])
    twice = item.format("Olga", 70) + ". Some other words come here. " + item.format("Peter", 90)
    mixed = own.replace("Martin", "{}").format("Olga", "Peter", "Nina", "Boris").replace("40", "70")
    texts = [own, half, inserted, deleted, twice, mixed]
    found = decontaminate.contaminated(spark.createDataFrame(list(enumerate(texts)), DOCS), spark.createDataFrame([(1, own)], "item_id long, text string")).collect()
    assert sorted(r.doc_id for r in found) == [0, 1, 2, 3, 4] and {r.consistent for r in found} == {1.0}


# 2 ------------------------------------------------------------------------------------------------------------------


def test_quality(spark):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    good = lambda: ". ".join(" ".join(word() for _ in range(8)) for _ in range(5))
    bad = lambda: " ".join(f"{word().upper()}!! ###" for _ in range(20))
    rows = [(i, bad() if i % 3 == 0 else good()) for i in range(240)]
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (902, good() * 500)], DOCS)
    grade = lambda i: 0 if i % 3 == 0 else 1
    labels = spark.createDataFrame([(i, grade(i)) for i in range(160)] + [(None, 1), (5, None), (7, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    scored = {r.doc_id: r for r in quality.score(docs, model).collect()}
    assert len(scored) == 243 and all(0 <= r.tail_probability <= 1 for r in scored.values())
    held = [scored[i].tail_probability >= 0.5 for i in range(160, 240)]
    assert np.mean([h == bool(grade(i)) for h, i in zip(held, range(160, 240))]) > 0.97
    wide = docs.selectExpr("doc_id", "text", "1 AS grade", "'x' AS q_tail", "2 AS at")
    assert quality.select_good(wide, labels).columns == wide.columns


def test_ordinal_grades_rise(spark):
    rows = [(i, " ".join(["fine"] * (i % 4) + ["poor"] * (3 - i % 4))) for i in range(120)]
    docs = spark.createDataFrame(rows, DOCS)
    model = quality.fit(docs, spark.createDataFrame([(i, i % 4) for i in range(120)], "doc_id long, quality int"), steps=80)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 3
    expected = [r.expected_grade for r in quality.score(docs.filter("doc_id < 4").orderBy("doc_id"), model).collect()]
    assert expected == sorted(expected) and expected[3] - expected[0] > 1
    nothing = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.tail_probability for r in quality.score(docs, nothing).collect()} == {1.0}


# 3 ------------------------------------------------------------------------------------------------------------------


def test_url_filters(spark):
    urls = [
        ("http://a.NET/x", "net/", "block"), ("http://www.example.net/en/1", "example.net/en/", "allow"), ("https://example.net", None, "allow"), ("http://example.com/de/", "example.com/de/", "block"),
        ("http://example.com/den", None, "allow"), ("http://notexample.com/de/", None, "allow"), ("http://x.org/fr/a?b", "org/fr/", "allow"), (None, None, "allow"), ("nohost", None, "allow"), ("http://a.net?x/", None, "allow"), ("http://a.net/" + "y" * 50_000, "net/", "block"),
    ]
    rules = spark.createDataFrame(url_filters.RULES, "action string, host string, path string")
    rows = [(i, u) for i, (u, _, _) in enumerate(urls)] + [(0, urls[0][0])]
    judged = url_filters.judge_urls(spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS u", "2 AS h"), rules).collect()
    assert len(judged) == len(rows)
    assert {(r.page_id, r.rule, r.verdict) for r in judged} == {(i, rule, verdict) for i, (_, rule, verdict) in enumerate(urls)}
    assert {r.verdict for r in url_filters.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules.limit(0)).collect()} == {"allow"}
    partial = spark.createDataFrame([("block", "a.net", "/x/ab")], "action string, host string, path string")  # a path that ends in a segment
    assert [r.verdict for r in url_filters.judge_urls(spark.createDataFrame([(1, "http://a.net/x/abc")], "page_id long, url string"), partial).collect()] == ["block"]


# 4 ------------------------------------------------------------------------------------------------------------------

BODY = "Hello, this is a long paragraph, with commas, and more text that goes on and on for a while to be scored."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<p>just one", "just one"), ("plain text &amp; more", "plain text & more"), ("<article>a<b>b</b>c<br>d<!-- x --><script>var a='</p>'</script>&nbsp;e</article>", "abc\nd e"),
        (f"<div class=header>Site</div><div id='main'><p>{BODY}</p><div class='comments'><p>I agree, totally, wow</p></div></div><div class='sidebar'><p>links, a, b</p></div>", BODY),
        (f"<body><nav><a href=x>menu</a></nav><main><h1>T</h1><p>{BODY}</p><aside>no</aside><form>no</form><ul><li>x<li>y</ul></main><footer>&copy; z</footer></body>", f"T\n{BODY}\nx\ny"),
        ("<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "</article>", "deep"),
    ],
)
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


def test_extract_keeps_rows_and_columns(spark):
    pages = spark.createDataFrame([(1, "u", "<p>é</p>", 9), (1, "u", "<p>é</p>", 9), (None, None, None, None)], "page_id long, url string, html string, extra int")
    rows = html_extract.extract(pages).collect()
    assert sorted((r.text, r.n_chars) for r in rows) == [("", 0), ("é", 1), ("é", 1)] and "extra" in rows[0]
    assert html_extract.extract(pages.limit(0)).count() == 0


# 5 ------------------------------------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    long = "ä" * 60
    pages = [(3, "http://a/x", long), (1, "http://b", long), (2, None, "short"), (4, "http://c", "short"), (5, "http://d\r\ne", None), (6, "http://f", "WARC/1.1\r\n\r\n" * 20), (7, "http://g", "z" * 300_000), (8, "http://h", "z" * 300_000), (9, "http://i", "q" * 99), (10, "http://j", "q" * 99)]
    got = {r.page_id: r for r in warc.round_trip(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert len(got) == len(pages)
    first = {}
    for i, _, html in sorted(pages, key=lambda p: p[0]):
        first.setdefault(html, i)
    for i, _, html in pages:
        payload, r = (html or "").encode(), got[i]
        again = len(payload) >= 100 and first[html] != i
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", first[html] if again else None)
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_repeated_rows_and_payloads(spark, tmp_path):
    rows = [(1, "u", "p" * 200)] * 2 + [(None, "u", "p" * 200), (2, "v", "p" * 200)]
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), f"file://{tmp_path}/w")
    captures = warc.assemble(warc.read_records(spark, f"file://{tmp_path}/w")).collect()
    assert sorted((str(c.metadata.page_id), c.record_type, c.response.refers_to_page) for c in captures) == [("1", "response", None), ("1", "response", None), ("2", "revisit", 1), ("None", "revisit", 1)]
    assert all(bytes(c.response.payload) == b"p" * 200 and c.request.http.startswith("GET /") for c in captures)


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    """As 1,000 pages of 2 MB would be: no file holds more than the bound and one page's records, and all come back."""
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" + "x" * (20_000 if i % 7 else 90_000)) for i in range(300)]
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), f"file://{tmp_path}/w", file_bytes=200_000)
    sizes = [len(gzip.decompress(f.read_bytes())) for f in (tmp_path / "w").glob("*.gz")]
    assert len(sizes) > 30 and max(sizes) < 200_000 + 92_000
    captures = warc.assemble(warc.read_records(spark, f"file://{tmp_path}/w")).collect()
    assert sorted((c.metadata.page_id, c.target_uri, bytes(c.response.payload).decode()) for c in captures) == rows


# 6 ------------------------------------------------------------------------------------------------------------------


def union_find(n):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    return label, find


def brute_components(points, most=4):
    label, find = union_find(len(points))
    fps = np.array(points, np.int64).view(np.uint64)
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps[i + 1 :]) <= most).tolist():
            a, b = find(i), find(i + 1 + j)
            label[max(a, b)] = min(a, b)
    return find


def test_simhash_groups(spark, odd):
    rnd = random.Random(3)
    base = [str(rnd.randint(0, 9999)) for _ in range(300)]
    docs = [*odd, (20, " ".join(base)), (21, " ".join([*base[:150], "x", *base[151:]])), (22, " ".join(base).upper()), (23, "other words here " * 40)]
    rows = simhash.simhash_groups(spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS fp")).collect()
    assert len(rows) == len(docs)
    prints = [simhash.fingerprint((t or "").encode(), 4) for _, t in docs]
    assert sorted(r.fingerprint for r in rows) == sorted(f"{p & (1 << 64) - 1:016x}" for p in prints)
    find = brute_components(prints)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    want = collections.Counter((i, least[find(k)]) for k, (i, _) in enumerate(docs))
    assert collections.Counter((r.doc_id, r.component_id) for r in rows) == want
    assert simhash.simhash_groups(spark.createDataFrame([], DOCS)).count() == 0


def test_near_copies_of_repeated_and_null_ids(spark):
    rnd = random.Random(8)
    one, two, three = (" ".join(str(rnd.randint(0, 9999)) for _ in range(80)) for _ in range(3))
    docs = [(1, one), (1, two), (2, two), (None, three), (None, three), (None, one), (1, one)]
    left = simhash.drop_near_copies(spark.createDataFrame(docs, DOCS)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == sorted([(1, one), (1, two), (0, three)])


@pytest.mark.parametrize("large", [8, 4096])
def test_links_connect_all(spark, large):
    rng = np.random.default_rng(0)
    base = int(rng.integers(1 << 62))
    points = sorted({base ^ sum(1 << int(b) for b in rng.integers(0, 63, 3)) for _ in range(150)} | {int(x) for x in rng.integers(0, 1 << 62, 100)})
    found = components(simhash.links(spark.createDataFrame([(p,) for p in points], "fp long"), 4, large)).collect()
    find = brute_components(points)
    groups = collections.defaultdict(set)
    for k, p in enumerate(points):
        groups[find(k)].add(p)
    assert {r.node: r.root for r in found} == {p: min(g) for g in groups.values() if len(g) > 1 for p in g}


# 7 ------------------------------------------------------------------------------------------------------------------


def test_exact_groups(spark, odd):
    rows = exact_dedup.exact_groups(spark.createDataFrame(odd, DOCS)).collect()
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    groups = collections.defaultdict(list)
    for i, t in odd:
        groups[lower(t)].append(i)
    assert len(rows) == len(odd)
    for r in rows:
        ids = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert r.keep_id == max(i for i in ids if i is not None) and r.group_size == len(ids)
    assert sum(r.kept for r in rows) == len(groups)
    wide = spark.createDataFrame(odd, DOCS).selectExpr("*", "1 AS digest", "2 AS q_digest", "3 AS n_bytes")
    kept = exact_dedup.drop_copies(wide)
    assert kept.columns == wide.columns and sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6, 7, 8]
    assert exact_dedup.exact_groups(spark.createDataFrame([], DOCS)).count() == 0 and exact_dedup.drop_copies(wide.limit(0)).count() == 0


def test_cuckoo_filter():
    index, rnd = exact_dedup.CuckooFilter(4), random.Random(2)
    digests = [rnd.randbytes(32) for _ in range(3000)]
    for i, d in enumerate(digests):
        assert index.find(d, 1) is None
        index.insert([d, 1, i, 1])
    assert index.resizes and all(index.find(d, 1)[2] == i for i, d in enumerate(digests))
    assert all(index.delete(d, 1) for d in digests[::2]) and not index.delete(digests[0], 1)
    assert [index.find(d, 1) is None for d in digests] == [i % 2 == 0 for i in range(3000)]


def test_index_changes(spark):
    change = lambda d, keep, gone=False: (bytes([d]) * 32, 5, keep, 1, gone)
    live = exact_dedup.apply_changes(spark.createDataFrame([change(1, 4), change(2, 5), change(1, 9)], exact_dedup.CHANGE))
    after = exact_dedup.apply_changes(spark.createDataFrame([change(2, None, True), change(3, 1), change(1, 2)], exact_dedup.CHANGE), live)
    assert sorted((r.digest[0], r.keep_id, r.n) for r in after.collect()) == [(1, 9, 3), (3, 1, 1)]


# 8 ------------------------------------------------------------------------------------------------------------------


def test_toxicity(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    text = lambda bad: " ".join([word() for _ in range(40)] + (rnd.sample(["zounds", "zilch", "zonked", "zombie"], 2) if bad else []))
    rows = [(i, text(i % 6 == 0)) for i in range(400)]
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (902, text(False) * 300)], DOCS)
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(400)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.fit(docs, labels.filter(~toxicity.held_out()))).withColumn("held_out", toxicity.held_out()).collect()
    assert len(scored) == 403 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    held = [r for r in scored if r.held_out and r.doc_id < 400]
    assert np.mean([r.predicted == (r.doc_id % 6 == 0) for r in held]) > 0.97
    assert {r.predicted for r in scored if r.doc_id >= 900} == {0}
    none = toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()
    assert {r.score for r in none} == {0.0}


def test_toxicity_terms_of_both_labels(spark):
    rnd = random.Random(6)
    plain = [f"plain{c}{d}" for c in "abcdefgh" for d in "abcdefgh"]
    bad = lambda: " ".join([*rnd.sample(plain, 3), "zounds", "zilch"])
    fine = lambda: " ".join([*rnd.sample(plain, 12), "lovely"])
    # most rows are toxic, so that no term can be twice as frequent among toxic ones
    rows = [(i, int(i % 5 < 3), bad() if i % 5 < 3 else fine()) for i in range(500)]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows] + [(900, " ".join(plain) + " lovely zounds"), (901, "zounds zilch plainaa")], DOCS)
    model = toxicity.fit(docs, spark.createDataFrame([(i, y) for i, y, _ in rows], "doc_id long, toxic int"))
    assert collections.Counter(model.index.labels.tolist()) == {0: 200, 1: 300}
    assert {r.doc_id: r.predicted for r in toxicity.score(docs, model).filter("doc_id >= 900").collect()} == {900: 0, 901: 1}


def test_block_max_search_is_exact():
    rng = np.random.default_rng(5)
    vectors = []
    for _ in range(400):
        terms = np.sort(rng.choice(60, rng.integers(1, 6), replace=False))
        weights = rng.random(len(terms)) + 0.1
        vectors.append((terms, weights / np.sqrt((weights**2).sum())))
    index = toxicity.BlockMaxIndex(list(range(400)), [0] * 400, vectors, 60)
    dense = np.zeros((400, 60))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for t, w in vectors[::25]:
        query = np.zeros(60)
        query[t] = w
        scores = np.sort(np.round(dense @ query, 9))[::-1]
        places, found = index.nearest(t, w, 15)
        want = scores[:15][scores[:15] > 0]
        assert np.allclose(found, want, atol=1e-6) and np.allclose(dense[index.ids[places]] @ query, found, atol=1e-6)


@pytest.mark.parametrize("head,negligible,postings", [(0, 0.02, 40), (5, 0.02, 1 << 20), (5, 0.9, 40), (60, 0.02, 1)])
def test_many_queries_at_once_find_what_dense_search_finds(monkeypatch, head, negligible, postings):
    monkeypatch.setattr(toxicity, "HEAD", head)
    monkeypatch.setattr(toxicity, "POSTINGS", postings)
    monkeypatch.setattr(toxicity.BlockMaxIndex.candidates, "__defaults__", (negligible,))
    rng = np.random.default_rng(7)
    dense = np.where(rng.random((300, 80)) < 0.06, rng.random((300, 80)) ** 4 + 1e-3, 0)
    dense[:, :3] *= 20
    dense[dense.any(1)] /= np.sqrt((dense[dense.any(1)] ** 2).sum(1, keepdims=True))
    held = [(np.flatnonzero(v), v[v > 0]) for v in dense]
    index = toxicity.BlockMaxIndex([i for i in range(200) if dense[i].any()], [0] * sum(dense[:200].any(1)), [v for v in held[:200] if len(v[0])], 80)
    row = np.repeat(np.arange(300), [len(t) for t, _ in held])
    for but in (None, np.arange(300)):
        places, cosines = index.search(row, np.concatenate([t for t, _ in held]), np.concatenate([w for _, w in held]), 300, 15, but)
        for i in range(300):
            scores = dense[:200] @ dense[i]
            if but is not None and i < 200:
                scores[i] = 0
            want = np.sort(scores)[::-1][:15]
            some = places[i] >= 0
            assert some.sum() == (want > 0).sum() and np.allclose(cosines[i], want, atol=1e-6)
            assert np.allclose(scores[index.ids[places[i][some]]], cosines[i][some], atol=1e-6)


def test_toxicity_words_are_what_the_pattern_leaves():
    rnd = random.Random(3)
    signs = [*map(chr, range(0, 0x250)), *"\u0130\u03a3\u1e9e\u2160\u0660\u0301\u4e00\U0001f600\U00010400\U0001d7d8\ufffd"]
    texts = [None, "", "_", "a" * 200 + "\u00e9" + " Ab", *("".join(rnd.choice(signs if rnd.random() < 0.5 else "aB 1_.") for _ in range(rnd.randint(0, 60))) for _ in range(300))]
    for column in (pa.array(texts), pa.array(texts).slice(3, 100), pa.array(texts[:2]), pa.array([], pa.string())):
        lists = pc.split_pattern_regex(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")), toxicity.SEPARATOR).to_pylist()
        want = [(i, s, n) for i, ws in enumerate(lists) for s, n in sorted(collections.Counter(zlib.crc32(w.encode()) % toxicity.SLOTS for w in ws if w).items())]
        assert [(int(i), int(s), int(n)) for i, s, n in zip(*toxicity.slot_counts(column))] == want
    # a batch's distinct words are hashed together, not each in Python
    words = pa.array([f"word{i}" for i in range(1000)] + ["x" * 1000], pa.large_string())
    assert toxicity.slots_of(words).tolist() == [zlib.crc32(w.encode()) % toxicity.SLOTS for w in words.to_pylist()]


# 9 ------------------------------------------------------------------------------------------------------------------


def brute_repeats(rows, length=400):
    counts = collections.Counter(b[k : k + length] for _, t in rows for b in [(t or "").encode()] for k in range(len(b) - length + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if counts[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_blocks_alike_on_both_sides_are_many_tasks(spark):
    # one stem, one right side, one beginning of the left side: told apart only by what stands 40 bytes before
    rows = [(7, i, 0, 0, 10, b"l" * 40 + i.to_bytes(4, "big"), b"m" * 81, b"r" * 100) for i in range(2000)]
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        for side in ("left", "right"):
            found = spark.createDataFrame(rows if side == "right" else [(*r[:5], r[7], r[6], r[5]) for r in rows], suffix_dedup.CONTEXTS)
            held = suffix_dedup.in_order(found, side).groupBy(F.spark_partition_id()).count().collect()
            assert max(r["count"] for r in held) < 1000 and sum(r["count"] for r in held) == 2000
    finally:
        spark.conf.set(coalesce, before)


@pytest.mark.parametrize(("seed", "batch"), [(1, 1 << 21), (2, 3000), (3, 1000)])
def test_repeated_strings(spark, monkeypatch, seed, batch):
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7)))
    base, other = " ".join(word() for _ in range(400)), " ".join(word() for _ in range(150))
    rows = [(1, base), (2, base[:900] + "X" + base[900:]), (3, base[100:1300]), (4, "ab" * 900), (5, "ab" * 300 + "c"), (6, None), (7, ""), (8, base[:399]), (9, base[:400]), (None, other + other), (None, other), (10, other + "tail"), (10, other + "tail"), (11, "x" * 400)]
    for i in range(20, 34):
        a = rnd.randint(0, 1200)
        rows.append((i, " ".join(word() for _ in range(rnd.randint(0, 60))) + base[a : a + rnd.randint(200, 900)] + " ".join(word() for _ in range(rnd.randint(0, 60)))))
    got = suffix_dedup.repeat_digests(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == brute_repeats(rows)


def test_periodic_and_crafted_strings(spark):
    """Passages of many periods, alone and shared, and pairs that collide under any polynomial modulo a power of two."""
    rnd = random.Random(9)
    noise = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    rows = [(i, noise(50) + (noise(period) * 3000)[: rnd.randint(401, 1500) + period] + noise(80)) for i, period in enumerate([1, 1, 2, 3, 7, 50, 150, 161, 300, 399, 400, 401])]
    ridge = "=-" * 700
    rows += [(20, noise(90) + ridge), (21, ridge[:401] + noise(90)), (22, "x" + ridge[:400] + "y"), (23, " " * 399), (24, " " * 400), (25, " " * 402 + "e" + " " * 402), (26, "\n" * 401), (27, "-" * 400), (28, "q" + "\n" * 1000 + "r" + "\n" * 1000)]
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    swapped = morse.translate(str.maketrans("ab", "ba"))
    for width in (512, 1024, 2048):
        for i, text in enumerate((morse[:width], swapped[:width])):
            rows.append((width + i, f"{width:05d}" * 6 + text + f"{width:05d}" * 6))
    got = suffix_dedup.repeat_digests(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == brute_repeats(rows)


def test_equal_bytes_make_few_blocks():
    for text in (b" " * 3_000_000, b"ab" * 1_500_000):
        assert sum(len(b[0]) for b in suffix_dedup.blocks(text, suffix_dedup.Hasher())) < 100
        assert sum(len(b[0]) for b in suffix_dedup.blocks(text, suffix_dedup.Hasher(), True)) < 100


def test_shards_follow_the_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i % 40}") for i in range(100)], DOCS)
    want = sorted(map(str, exact_dedup.exact_groups(docs).collect()))
    monkeypatch.setattr(exact_dedup, "SHARD_ROWS", 3)
    assert exact_dedup.shards_for(spark, 100) == 34 and exact_dedup.shards_for(spark, 9) is None
    assert sorted(map(str, exact_dedup.exact_groups(docs).collect())) == want and len(want) == 100
    assert sorted(r.doc_id for r in exact_dedup.drop_copies(docs).collect()) == list(range(60, 100))


def test_no_documents_no_repeats(spark):
    assert suffix_dedup.repeat_digests(spark.createDataFrame([], DOCS)).count() == 0
    assert [bytes(r.kept) for r in suffix_dedup.without_repeats(spark.createDataFrame([(1, "a")], DOCS)).collect()] == [b"a"]


# 10 -----------------------------------------------------------------------------------------------------------------


def test_byte_bpe(spark):
    path = P.path("byte_bpe_50k.tiktoken")
    ranks = byte_bpe.share_ranks(spark, path)
    tiktoken_encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks.value, special_tokens={})
    rnd = random.Random(5)
    signs = ["a", "Z", "1", " ", "  ", "\n", "'s", "'", "!", "é", "'ll", "　", "'re", "字", "½", "\x1c", "<|endoftext|>"]
    rows = [(i, "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 14)))) for i in range(1500)] + [(None, "no id"), (7000, None), (7001, ""), (7002, "a b  c\n" * 30_000), (7003, "y" * 3000), (7003, "y" * 3000)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS ids", "2 AS block")
    want = collections.Counter((i, tuple(tiktoken_encoding.encode_ordinary(t or ""))) for i, t in rows)
    for block in (4, 1 << 22):
        assert collections.Counter((r.doc_id, tuple(r.ids)) for r in byte_bpe.encode(docs if block > 4 else docs.filter("doc_id < 100"), ranks, P.PATTERN, block_chars=block).collect()) == (want if block > 4 else collections.Counter({k: n for k, n in want.items() if k[0] is not None and k[0] < 100}))
    digests = {r.doc_id: r for r in byte_bpe.token_digests(docs, path, P.PATTERN).collect()}
    text = dict(rows)
    for i in (3, 7000, 7001, 7002):
        ids = tiktoken_encoding.encode_ordinary(text[i] or "")
        assert (digests[i].n_tokens, digests[i].ids_sha256, digests[i].decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text[i] or "").encode()).hexdigest())
    assert [bytes(r.decoded) for r in byte_bpe.decode(spark.createDataFrame([(1, [0, 1]), (2, [])], "doc_id long, ids array<int>"), ranks).orderBy("doc_id").collect()] == [tiktoken_encoding.decode_bytes([0, 1]), b""]
    assert byte_bpe.encode(docs.limit(0), ranks, P.PATTERN).count() == 0


def test_encoder_stays_where_it_was_made(spark):
    """An encoder never answers by another vocabulary, and one made on the driver travels with no job."""

    class Sent:
        def __init__(self, value):
            self.value = value

    letters, pair = Sent({b"a": 0, b"b": 1}), Sent({b"a": 0, b"b": 1, b"ab": 2})
    for _ in range(2):
        assert byte_bpe.encoder(letters, P.PATTERN)(b"ab") == [0, 1]
        assert byte_bpe.encoder(pair, P.PATTERN)(b"ab") == [2]
    ranks = spark.sparkContext.broadcast(pair.value)
    assert [r.ids for r in byte_bpe.encode(spark.createDataFrame([(1, "abab")], DOCS), ranks, P.PATTERN).collect()] == [[2, 2]]


def test_distinct_words_of_chunks(monkeypatch):
    """Chunks of any size, and words that share a hash, give the numbers of a plain dictionary."""
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab c'") for _ in range(rnd.randint(1, 90))) for _ in range(40)]
    for pattern, size, clash in ((P.PATTERN, 1, False), (P.PATTERN, 37, True), (P.PATTERN, 1 << 16, True), (r"[^ ]+", 50, True)):
        monkeypatch.setattr(byte_bpe, "CHUNK_WORDS", size)
        split, words, seen, numbers, firsts = byte_bpe.Splitter(pattern), byte_bpe.Words(), {}, [], []
        for text in texts:
            starts, ends, first, second = split(text)
            words.add(text, starts, ends, first % np.uint64(3) if clash else first, second)
            for a, b in zip(starts.tolist(), ends.tolist()):
                if text[a:b] not in seen:
                    firsts.append(len(numbers))
                numbers.append(seen.setdefault(text[a:b], len(seen)))
        codes, origin, _, found = words.finish()
        assert (codes.tolist(), origin.tolist(), found) == (numbers, firsts, [w.encode() for w in seen])


def test_long_texts_are_cut_where_no_pre_token_stands(monkeypatch):
    """Pieces of any size have the pre-tokens of the whole text, without a space too; one run of one kind, and a text under another pattern, stay whole."""
    rnd = random.Random(11)
    split, whole = byte_bpe.Splitter(P.PATTERN), regex.compile(P.PATTERN)
    signs = ["a", "Z", "é", "字", "1", "½", " ", "  ", "\n", "\n\n", "\t ", "　", "'", "'s", "'ll", "'re", "!", "-", "\u0301", "😀"]
    for search in (1, 3, 1 << 12):
        monkeypatch.setattr(byte_bpe, "SEARCH_CHARS", search)
        for n in range(1200):
            text = "".join(rnd.choice(signs if n % 3 else signs[:6] + signs[12:]) for _ in range(rnd.randint(0, 40)))
            for most in (1, 2, 5):
                pieces = list(split.pieces(text, most))
                assert "".join(pieces) == text
                assert [w for p in pieces for w in whole.findall(p)] == whole.findall(text)
    monkeypatch.undo()
    minified = "".join(f"var{i}=f({i});" for i in range(100_000))
    assert max(map(len, split.pieces(minified, 10_000))) < 10_100
    assert list(split.pieces("字" * 100_000, 1_000)) == ["字" * 100_000]
    assert list(byte_bpe.Splitter(r"\w+ \w+|.").pieces("one two " * 1_000, 100)) == ["one two " * 1_000]


def test_buckets_follow_the_scan(spark):
    docs = spark.range(1).selectExpr("id AS doc_id", "'a' AS text")
    assert byte_bpe.buckets_for(docs.coalesce(1)) == 16
    assert byte_bpe.buckets_for(docs.repartition(300)) == 300
    assert byte_bpe.buckets_for(docs.repartition(5_000)) == byte_bpe.MOST_BUCKETS


def test_other_patterns_and_hash_ties():
    split = byte_bpe.Splitter(r"\w+|\W+")
    text = "one two, three"
    starts, ends, first, second = split(text)
    assert [text[a:b] for a, b in zip(starts, ends)] == ["one", " ", "two", ", ", "three"]
    assert len(set(first.tolist())) == len(set(second.tolist())) == 5


# 4, odd pages -------------------------------------------------------------------------------------------------------

LONG = "Good words, here and there, that make a text. " * 8
PLAIN = LONG.strip()


@pytest.mark.parametrize(
    "page, want",
    [
        (f'<div class="layout has-sidebar"><article><p>{LONG}</p></article></div>', PLAIN),
        (f'<div class="no-comments"><p>{LONG}</p></div>', PLAIN),
        (f'<div class="search-page"><article><p>{LONG}</p></article></div>', PLAIN),
        (f'<div class="overflow hidden x"><p>{LONG}</p></div>', PLAIN),
        (f"<div hidden><p>{LONG}</p></div><p>Shown.</p>", "Shown."),
        (f"<form><article><p>{LONG}</p></article></form>", PLAIN),
        (f'<article><p>{LONG}</p><div class="legal-analysis"><p>Legal text.</p></div></article>', f"{PLAIN}\nLegal text."),
        (f"<main><article><p>{LONG}</p></article><article><p>Second.</p></article></main>", f"{PLAIN}\nSecond."),
        (f"<body><h1>Title</h1><div><p>{LONG}</p><p>{LONG}</p></div><ul><li>one</li></ul></body>", f"Title\n{PLAIN}\n{PLAIN}\none"),
        (f'<body><div id="nav-bar"><a href=x>Menu</a></div><p>{LONG}</p><form><p>Your name</p></form></body>', PLAIN),
        (f'<main><article><p>{LONG}</p></article><section class="comments"><article class="comment"><p>{LONG}</p></article><article><p>{LONG}{LONG}</p></article></section></main>', PLAIN),
        (f'<main><article><p>{LONG}</p></article><article class="comment byuser"><p>{LONG}</p></article></main>', PLAIN),
        (f'<article><p>{LONG}</p><article itemtype="https://schema.org/Comment"><p>{LONG}</p></article></article>', PLAIN),
        (f'<article><p>{LONG}</p><div class="comments">' + f"<p>{LONG}</p>" * 9 + "</div></article>", PLAIN),
        (f'<article><p>{LONG}</p></article><div id="comments">' + f"<p>{LONG}</p>" * 9 + "</div>", PLAIN),
        (f'<div class="content"><p>{LONG}</p></div><article class="comment"><p>{LONG}</p></article>', PLAIN),
        (f'<article class="comment"><p>{LONG}</p></article>', PLAIN),
        (f'<div class="discussion"><p>{LONG}</p></div>', PLAIN),
        (f"<div><article><p>{LONG}</p></article></div><div><p>ad</p></div><div><article><p>{LONG}</p></article></div>", f"{PLAIN}\n{PLAIN}"),
        (f"<div><article><p>{LONG}</p></article></div><div><article><p>A teaser.</p></article></div>", PLAIN),
        (f'<main><p>Before.</p><div><article><p>{LONG}</p></article></div></main>', PLAIN),
        (f"<form><div><p>{LONG}</p><p>{LONG}</p></div></form><div><p>Copyright</p></div>", f"{PLAIN}\n{PLAIN}"),
        (f'<form><div class="text"><p>{LONG}</p></div><div class="sidebar"><div><p>{LONG}{LONG}</p></div></div></form>', PLAIN),
        (f'<div class="sidebar"><p>{LONG}{LONG}</p></div><div class="text"><p>{LONG}</p></div>', PLAIN),
        (f'<div class="text"><p>{LONG}</p></div><div class="related"><article><p>A teaser.</p></article></div>', PLAIN),
        (f'<div class="page-header-content"><p>{LONG}</p></div>', PLAIN),
        ("<p>a &lt; b &amp;&#x20;c<!-- no --> <script>x</script>d", "a < b & c d"),
        ("1 < 2 <b>and</b> <", "1 < 2 and <"),
    ],
)
def test_odd_pages(page, want):
    assert html_extract.main_text(page) == want


@pytest.mark.parametrize("page", ['<a "' * 250_000, "<div>" * 8_000 + "</p></b>" * 100_000, "<p><tbody>" + "<b>" * 90_000 + "<hr>" * 150_000, "<noscript>" * 100_000, "<!" * 500_000, "<div class=menu>" * 60_000 + "<p>x" * 100_000, ("<form>" + "<p>text, text") * 40_000, "<article><div class=comment>" * 30_000 + "x", "<div>" * 90_000 + "x" + "</div>" * 90_000, "<a '\">\"" * 150_000])
def test_hostile_pages_take_linear_time(page):
    began = time.process_time()
    html_extract.main_text(page)
    assert time.process_time() - began < 10


# 5, 7, 8, 9, 10: odd tables -------------------------------------------------------------------------------------------


def test_damaged_archive(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}" * 99) for i in range(20)], "page_id long, url string, html string")
    warc.write_warc(pages.coalesce(1), f"file://{tmp_path}/w")
    whole = next((tmp_path / "w").glob("part-*"))
    raw = whole.read_bytes()
    (tmp_path / "w" / "half.warc.gz").write_bytes(raw[: len(raw) // 2])
    (tmp_path / "w" / "no.warc").write_bytes(b"nothing")
    rows = warc.read_records(spark, f"file://{tmp_path}/w").collect()
    damaged = [r.fields for r in rows if r.type == "damaged"]
    assert len(damaged) == 2 and any("EOFError" in d for d in damaged) and sum(r.type == "response" for r in rows) >= 20


def test_toxicity_against_dense_search(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 60)) + (["zounds"] * rnd.randint(1, 3) if i % 4 == 0 else []))) for i in range(240)]
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int"))
    # the weights from their definition
    slot = lambda w: zlib.crc32(w.encode()) % toxicity.SLOTS
    held = [collections.Counter(slot(w) for w in t.split()) for _, t in rows]
    worth = {}
    for s in {s for h in held for s in h}:
        df, n, a = sum(s in h for h in held), sum(s in h for h in held[:200]), sum(s in held[i] for i in range(0, 200, 4))
        z = max(0, abs(a - n / 4) - 0.5) / math.sqrt(n * 3 / 16 + 0.5)
        worth[s] = (math.log(241 / (1 + df)) + 0.1) * (toxicity.FLOOR + z * z)

    def unit(h):
        v = {s: (1 + math.log(n)) * worth[s] for s, n in h.items()}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {s: x / length for s, x in v.items()}

    units = [unit(h) for h in held]
    for i in range(200, 240):
        cosines = sorted((sum(x * units[j].get(s, 0) for s, x in units[i].items()) for j in range(200)), reverse=True)
        slots, n = next(toxicity.per_text(pa.array([rows[i][1]])))
        found = model.index.nearest(*toxicity.weigh(slots, n, model.worth), toxicity.NEIGHBOURS)[1]
        assert np.allclose(found, [c for c in cosines[: toxicity.NEIGHBOURS] if c > 0], atol=1e-5)
    scored = toxicity.score(docs, model).collect()
    assert len({r.score for r in scored}) > 10


def test_toxicity_of_odd_tables(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 21)] + [(None, 1), (2, None)], "doc_id long, toxic int")
    rows = [(i, f"bad{'' if i % 2 else ' fine'} word{i}") for i in range(1, 21)]
    docs = spark.createDataFrame([(a, t, 1) for a, t in [*rows, rows[0], rows[0], (None, "bad"), (None, None), (30, "")]], "doc_id long, text string, score int")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model).collect()
    assert len(scored) == 25 and len({r.score for r in scored if r.doc_id == 1}) == 1 and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).collect() == []
    assert {r.held_out for r in docs.filter("doc_id IS NULL").select(toxicity.held_out().alias("held_out")).collect()} == {False}


def test_grades_are_binned_with_both_ends():
    counts = [(float(g), 1 if g in (0, 99) else 50) for g in range(100)]
    found = quality.binned(counts)
    assert len(found) <= quality.MOST_GRADES and found[0][0] == 0 and found[-1][0] == 99 and sum(n for _, n in found) == sum(n for _, n in counts)
    assert quality.binned(counts[:5]) == counts[:5]


def test_slots_of_one_value_and_contradicting_slots(spark):
    item = "A train leaves Paris at 7 and another leaves Rome at 9 while a third waits in Paris until 7 and then goes on to Rome by 9 oclock sharp"
    swap = lambda *v: item.replace("Paris", v[0]).replace("Rome", v[1]).replace("7", v[2]).replace("9", v[3])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    mixed = item.replace("Paris", "Oslo").replace("Rome", "Oslo").replace("7", "4").replace("9", "4")
    torn = item.replace("Paris", "Oslo", 1).replace("Paris", "Bern").replace("Rome", "Lima", 1).replace("Rome", "Wien").replace("7", "1", 1).replace("7", "2").replace("9", "3", 1).replace("9", "4")
    docs = spark.createDataFrame([(1, swap("Oslo", "Bern", "3", "5")), (2, mixed), (3, "a plain text of no matter"), (4, torn)], DOCS)
    assert {r.doc_id for r in decontaminate.contaminated(docs, bench).collect()} == {1, 2}
    pears = "the shop sells 5 red apples on monday and then it sells 7 green pears on friday"
    found = decontaminate.contaminated(spark.createDataFrame([(1, pears.replace("5", "3").replace("7", "3")), (2, pears.replace("5", "4").replace("7", "9"))], DOCS), spark.createDataFrame([(1, pears)], "item_id long, text string"))
    assert {(r.doc_id, r.share) for r in found.collect()} == {(1, 1.0), (2, 1.0)}


def test_short_items(spark):
    bench = spark.createDataFrame([(1, "what is two plus"), (2, "Yes"), (3, "name three"), (4, "5 7"), (5, ""), (6, None), (7, "...")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "so what is two plus three"), (2, "yes"), (3, "yes it is"), (4, "Name three."), (5, "name three rivers"), (6, "6 8"), (7, ""), (8, None), (9, "what is twoplus")], DOCS)
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()} == {(1, 1), (2, 2), (4, 3)}


def naive_leaks(docs, items):
    """Windows of template words compared one by one, for items of plain lower-case words."""
    words = lambda t: re.findall(r"[a-z]+", t)
    for d, text in docs:
        held = words(text)
        for i, item in items:
            own = words(item)
            size = min(8, len(own))
            windows = {tuple(own[a : a + size]) for a in range(len(own) - size + 1)}
            found = windows & {tuple(held[a : a + size]) for a in range(len(held) - size + 1)}
            if len(found) >= 0.5 * len(windows) or len(found) >= 20:
                yield d, i, len(found), len(found) / len(windows)


def test_plain_leaks_against_brute_force(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("red green blue apple pear tree house river stone cloud".split())
    items = [(i, " ".join(word() for _ in range(rng.randint(3, 60)))) for i in range(20)]
    docs = []
    for d in range(120):
        own = items[rng.randrange(20)][1].split()
        a = rng.randrange(len(own))
        part = own[a : a + rng.randint(1, len(own))] if d % 3 else own
        docs.append((d, " ".join([*(word() for _ in range(rng.randint(0, 15))), *part, *(word() for _ in range(rng.randint(0, 15)))])))
    found = decontaminate.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id, r.windows, r.share) for r in found.collect()) == sorted(naive_leaks(docs, items))


def test_quality_reads_texts_by_all_their_parts(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    docs = spark.createDataFrame([(i, f"{'good' if i % 2 else 'bad'} text {i}") for i in range(40)], DOCS).repartition(20)
    assert quality.labelled_features(docs, labels, "quality", 100, 1 << 10).rdd.getNumPartitions() == 20
    model = quality.fit(docs, labels, dims=1 << 10)
    rows = quality.labelled_features(docs, labels, "quality", 100, 1 << 10).cache()
    # the gradient against finite differences of the negative log likelihood
    def loss(weights, thresholds):
        total = 0.0
        for r in rows.collect():
            x = sum(weights[a] * v for a, v in zip(r["at"], r["value"]))
            p = 1 / (1 + math.exp(-(thresholds[0] - x)))
            total -= math.log(p if r["grade"] == 0 else 1 - p)
        return total

    g, n = quality.gradient(rows.coalesce(8), model)
    assert n == 40
    for at in [*np.argsort(-np.abs(model.weights))[:3].tolist(), len(model.weights)]:
        step = np.zeros(len(model.weights) + 1)
        step[at] = 1e-3
        ends = [loss(model.weights + s * step[:-1], model.thresholds + s * step[-1:]) for s in (1, -1)]
        assert abs((ends[0] - ends[1]) / 2e-3 - g[at]) < 1e-2 * max(1, abs(g[at]))


def test_batches_are_cut_by_bytes():
    from quarry.llm.common import slices

    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 50_000_000, *["y" * 1000] * 20_000])], ["text"])
    parts = list(slices(batch))
    assert parts[0].num_rows == 1 and all(p.nbytes <= 4 << 20 or p.num_rows == 1 for p in parts) and pa.Table.from_batches(parts).column("text").to_pylist() == batch.column("text").to_pylist()


def test_one_very_long_text(spark):
    """50 MB of text in one row, and one in which a letter repeats."""
    long = " ".join(f"word{i % 9973} and{i % 31}" for i in range(3_500_000))
    docs = spark.createDataFrame([(1, long), (2, "z" * 300_000), (3, "short")], DOCS)
    assert exact_dedup.exact_groups(docs).count() == 3 and simhash.simhash_groups(docs).count() == 3
    assert {r.doc_id: r.n_removed for r in suffix_dedup.repeat_digests(docs.filter("doc_id > 1")).collect()} == {2: 300_000, 3: 0}


def test_large_cells_are_refined_without_losing_links(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 6, dtype=np.int64)
    fps = sorted({int(b) ^ sum(1 << int(k) for k in rng.choice(62, rng.integers(0, 6), replace=False)) for b in base for _ in range(80)})
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin(a ^ b).count("1") <= 4:
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    table = spark.createDataFrame([(f,) for f in fps], "fp long")
    for large in (4096, 16, 4):
        found = components(simhash.links(table, 4, large))
        got = {r.node: r.root for r in found.collect()}
        assert {f: got.get(f, f) for f in fps} == {f: root(f) for f in fps}


# all ----------------------------------------------------------------------------------------------------------------

#: Names of columns that the operators make inside.
INNER = "u best p s x h digest r_host r_path r_digest action size known first_id revisit n_bytes keep_id n group_size fp root least node t_words t_hashes raw key place at n_items item_id i_text slot block label marks payload terms weights toxic vote found bucket ids sizes number first part run start stop span kept words phrase lang_ mark train grade".split()


def test_columns_of_any_name(spark):
    """Tables with columns named as those inside give what they give without them."""
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(3))
    base = " ".join(word() for _ in range(150))
    docs = spark.createDataFrame([(i, base if i % 9 == 0 else " ".join(word() for _ in range(40)), "en") for i in range(40)], "doc_id long, text string, lang string")
    pages = spark.createDataFrame([(i, f"http://h{i}.net/a/{i}?q", f"<p>{'Good words, and more. ' * 20}{i % 5}</p>") for i in range(20)], "page_id long, url string, html string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, toxic int")
    items = spark.createDataFrame([(1, base[:200])], "item_id long, text string")
    rules = spark.createDataFrame(url_filters.RULES, "action string, host string, path string")
    more = lambda df: df.select("*", *[f.alias(c) for c in INNER if c not in df.columns for f in (F.lit("z"),)])
    tokens = [P.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model")]
    for run, given in (
        (lambda d: url_filters.judge_urls(d, more(rules)), pages),
        (lambda d: html_extract.extract(d), pages),
        (lambda d: warc.round_trip(d), pages),
        (lambda d: simhash.simhash_groups(d), docs),
        (lambda d: exact_dedup.exact_groups(d), docs),
        (lambda d: decontaminate.contaminated(d, more(items)), docs),
        (lambda d: quality.score(d, quality.fit(d, more(labels), "toxic", dims=1 << 10)), docs),
        (lambda d: toxicity.score(d, toxicity.fit(d, more(labels.select("doc_id")).drop("toxic").join(labels, "doc_id"))), docs),
        (lambda d: suffix_dedup.repeat_digests(d), docs),
        (lambda d: byte_bpe.token_digests(d, tokens[0], P.PATTERN), docs),
        (lambda d: collocations.mine(d, least=5), docs),
        (lambda d: language_model.score_texts(d, F.col("doc_id") % 3 > 0), docs),
        (lambda d: alignment.align_texts(d, *tokens[1:]), docs),
    ):
        plain = run(given)
        wanted, found = (sorted(map(str, df.select(*plain.columns).collect())) for df in (plain, run(more(given))))
        assert found == wanted and wanted
