"""Toxicity: nearest labelled examples by exact TF-IDF cosine, found with a block-max inverted index (operator 8).

Terms are the lower-cased words of a text; every word counts, none is cut off. A term's weight is (1 + log tf) times its inverse document
frequency over all documents times its bearing on the label: a floor plus the squared z-score of how far the share of toxic rows
among labelled rows with the term departs from that among all (a supervised TF-IDF: no term falls out, but those that say nothing of the label weigh little).
Terms are hashed to a fixed number of slots, so both statistics are two arrays of bounded size.
The index holds a bounded sample of labelled examples in blocks: per frequent term and block the largest weight, with what the rare terms' postings add, bounds what the
block can reach, so blocks are visited from the highest bound down until no other can hold a nearer example; the result is exact. Votes are weighted by
closeness and calibrated on the labelled rows, each without itself. Index and weights are bounded, so they are broadcast.

Null and empty texts have no terms and get the calibrated share of such labelled texts. Rows that repeat each get their row. Ties are
broken by the examples' texts and labels, never by ids. Rows with a null id are scored; labels of null ids or null labels are ignored.
Without labels of both kinds every score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, map_arrow, struct

#: Bounds of the fit: labelled rows read for the weights of terms and for calibration, examples in the index, slots of terms.
SAMPLE, EXAMPLES, SLOTS = 20_000, 4_096, 1 << 18
NEIGHBOURS, BLOCK, FIRST, BINS = 15, 64, 4, 10
#: Terms whose weights a block holds in full; queries searched at once, and postings read for them (more only for a single query).
HEAD, QUERIES, POSTINGS = 512, 256, 1 << 20
#: The length of the part of a query whose terms are read only for examples that the other terms found.
NEGLIGIBLE = 0.02
#: What a term weighs that says nothing of the label.
FLOOR = 0.02
SEPARATOR, WORD = r"[^\pL\pN_]+", r"^[\pL\pN_]"
#: What a byte does to a CRC-32; words of more bytes are hashed one by one.
CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC = np.where(CRC & 1, CRC >> 1 ^ np.uint32(0xEDB88320), CRC >> 1)
LONG = 64
ASCII_WORDS = np.array([c < 128 and (chr(c).isalnum() or chr(c) == "_") for c in range(256)])
COUNTS = struct(("slot", "int"), ("n", "bigint"), ("toxic", "bigint"))
VECTORS = struct(("doc_id", "bigint"), ("toxic", "int"), ("digest", "bigint"), ("terms", "array<int>"), ("weights", "array<float>"))
SCORES = struct(("doc_id", "bigint"), ("vote", "double"), ("found", "int"), ("evidence", "array<bigint>"), ("toxic", "int"))


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The lower-cased words of a column of texts, what SEPARATOR leaves of them: row and word of each. Words are told by their bytes, all texts at once."""
    lower = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    _, bounds, held = lower.buffers()
    bounds = np.frombuffer(bounds, np.int64)[lower.offset : lower.offset + len(lower) + 1] if len(lower) else np.zeros(1, np.int64)
    data = np.frombuffer(held, np.uint8)[bounds[0] : bounds[-1]] if held else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    inside = ASCII_WORDS[data]
    lead = np.flatnonzero(data >= 192)
    if len(lead):  # letters and digits beyond ASCII, by their code points
        size = 2 + (data[lead] >= 224) + (data[lead] >= 240)
        code = (data[lead] & (255 >> (size + 1))).astype(np.int64)
        for j in (1, 2, 3):
            on = size > j
            code[on] = code[on] << 6 | data[lead[on] + j] & 63
        distinct, back = np.unique(code, return_inverse=True)
        known = pc.match_substring_regex(pa.array([chr(c) for c in distinct.tolist()], pa.string()), WORD).to_numpy(zero_copy_only=False)[back.ravel()]
        for j in (0, 1, 2, 3):
            on = size > j
            inside[lead[on] + j] = known[on]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]  # words end with their text
    begin[cuts], end[cuts - 1] = inside[cuts], inside[cuts - 1]
    at = np.flatnonzero(begin)
    offsets = np.append(0, np.cumsum(np.flatnonzero(end) + 1 - at)).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
    return np.repeat(np.arange(len(lower)), np.diff(np.searchsorted(at, bounds))), words.dictionary_encode()


def slots_of(words: pa.Array) -> np.ndarray:
    """The slot of each word: its CRC-32, a byte of all words at a time; long words one by one."""
    _, bounds, held = words.buffers()
    if not len(words):
        return np.zeros(0, np.int64)
    bounds = np.frombuffer(bounds, np.int64)[words.offset : words.offset + len(words) + 1]
    data, sizes = np.frombuffer(held, np.uint8), np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] <= LONG]
    begins, crc = bounds[order], np.full(len(order), 0xFFFFFFFF, np.uint32)
    holders = len(order) - np.cumsum(np.bincount(sizes[order], minlength=1))
    for j, n in enumerate(holders.tolist()):  # the first n words have a byte j
        crc[:n] = CRC[(crc[:n] ^ data[begins[:n] + j]) & 255] ^ (crc[:n] >> 8)
    out = np.zeros(len(words), np.int64)
    out[order] = ~crc % SLOTS
    for i in np.flatnonzero(sizes > LONG).tolist():
        out[i] = zlib.crc32(data[bounds[i] : bounds[i + 1]]) % SLOTS
    return out


def slot_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a column of texts: row, slot and number of each slot that a text holds, in the order of rows and slots. A batch's distinct words are hashed once."""
    row, words = words_of(texts)
    keys = np.sort(row * SLOTS + slots_of(words.dictionary)[words.indices.to_numpy()])
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    n = np.diff(first, append=len(keys))
    return keys[first] // SLOTS, keys[first] % SLOTS, n.astype(np.float64)


def per_text(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slots of each text in order, and how often each occurs."""
    row, slot, n = slot_counts(texts)
    bounds = np.searchsorted(row, np.arange(len(texts) + 1)).tolist()
    return ((slot[a:b], n[a:b]) for a, b in zip(bounds[:-1], bounds[1:]))


def held_out() -> Column:
    """Whether a row belongs to the held-out fold; a null id doesn't."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))


def chosen_labels(labels: DataFrame, most: int, salt: str, label_col: str = "toxic") -> DataFrame:
    """About `most` rows (doc_id, toxic) of the labels by hash of the id; several labels of a document count as toxic if any is."""
    rated = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    share = most / max(1, rated.count())
    return rated if share >= 1 else rated.filter(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1_000_000)) < int(share * 1_000_000))


def term_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Per slot the rows (text, toxic or null) that hold it, and the toxic ones; rows in all, and toxic ones. Each partition sends its counts of at most SLOTS slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, SLOTS + 1), np.int64)
        for batch in batches:
            row, slot, _ = slot_counts(batch.column("text"))
            toxic = batch.column("toxic").fill_null(0).to_numpy() > 0
            seen[0, :SLOTS] += np.bincount(slot, minlength=SLOTS)
            seen[1, :SLOTS] += np.bincount(slot[toxic[row]], minlength=SLOTS)
            seen[:, SLOTS] += batch.num_rows, toxic.sum()
        at = np.flatnonzero(seen[0])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[0, at]), pa.array(seen[1, at])], COUNTS.names)

    # at most SLOTS + 1 rows of three numbers
    sums = map_arrow(rows.select("text", "toxic"), run, COUNTS).groupBy("slot").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).toArrow()
    out = np.zeros((2, SLOTS + 1), np.int64)
    out[:, sums["slot"].to_numpy()] = sums["n"].to_numpy(), sums["toxic"].to_numpy()
    return out[0, :SLOTS], out[1, :SLOTS], int(out[0, SLOTS]), int(out[1, SLOTS])


def bearing(seen: np.ndarray, toxic: np.ndarray, rows: int, bad: int) -> np.ndarray:
    """How much a term says of the label: FLOOR, and the squared z-score of its share of toxic rows (less half a row, as counts are whole)."""
    share = bad / max(1, rows)
    z = np.maximum(0, np.abs(toxic - seen * share) - 0.5) / np.sqrt(seen * share * (1 - share) + 0.5)
    return FLOOR + z**2


def weigh(slots: np.ndarray, n: np.ndarray, worth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and their unit-length weights."""
    return weigh_rows(np.zeros(len(slots), np.int64), slots, n, worth)[1:]


def weigh_rows(row: np.ndarray, slots: np.ndarray, n: np.ndarray, worth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, slot and weight, of unit length in each row; rows without any weight have no terms."""
    weights = (1 + np.log(n)) * worth[slots]
    norm = np.sqrt(np.bincount(row, weights**2))[row]
    some = norm > 0
    return row[some], slots[some], weights[some] / norm[some]


class BlockMaxIndex:
    """Examples in blocks. Of the HEAD terms that most examples have, a block holds all weights and the largest; of all others, which few have, there are postings.

    Queries are searched many at a time. The postings of a query's rare terms are read first, but for those that together add less than
    NEGLIGIBLE. With the head terms' largest weights they bound what a block can reach; the blocks that can hold one of the nearest are
    multiplied, the highest bound first. That leaves few examples whose cosine is then computed in full. Where what was left out could
    matter, all terms are read.
    """

    def __init__(self, ids: list, labels: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], size: int, digests: list[int] | None = None):
        # examples with the same strongest term lie together, which makes the blocks' bounds tight
        ties = digests or [hash((v[0].tobytes(), v[1].tobytes())) for v in vectors]
        order = sorted(range(len(ids)), key=lambda i: (int(vectors[i][0][vectors[i][1].argmax()]), ties[i], labels[i]))
        self.ids, self.labels = np.array([ids[i] for i in order], np.int64), np.array([labels[i] for i in order], np.int8)
        self.sizes, self.slots = np.array([len(vectors[i][0]) for i in order], np.int64), size
        self.own_terms, self.own_weights = (np.concatenate([vectors[i][k] for i in order]).astype(t) if order else np.zeros(0, t) for k, t in ((0, np.int32), (1, np.float32)))
        self.invert()

    def __getstate__(self) -> dict:
        """What is broadcast: the examples; each worker inverts them again, which takes less than sending the postings."""
        return {k: getattr(self, k) for k in ("ids", "labels", "sizes", "slots", "own_terms", "own_weights")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.invert()

    def invert(self) -> None:
        self.blocks = -(-len(self.ids) // BLOCK)
        self.query = np.zeros(self.slots, np.float32)
        self.bounds = np.append(0, np.cumsum(self.sizes))
        places = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.sizes)
        self.held = np.bincount(self.own_terms, minlength=self.slots)  # examples that have a term
        head = np.argsort(-self.held, kind="stable")[:HEAD]
        head = head[self.held[head] > 0]
        self.rank = np.full(self.slots, -1, np.int32)  # of a head term, its row
        self.rank[head] = np.arange(len(head))
        row = self.rank[self.own_terms]
        mine, others = np.flatnonzero(row >= 0), np.flatnonzero(row < 0)
        self.dense = np.zeros((self.blocks, len(head), BLOCK), np.float32)
        self.dense[places[mine] // BLOCK, row[mine], places[mine] % BLOCK] = self.own_weights[mine]
        self.top = self.dense.max(2, initial=0).T.copy()  # head terms x blocks
        by_term = others[np.argsort(self.own_terms[others], kind="stable")]
        self.places, self.weights = places[by_term], self.own_weights[by_term]
        few = np.where(self.rank < 0, self.held, 0)
        self.begins = np.cumsum(few) - few  # postings of a rare term t: held[t] from begins[t] on
        # float32 sums of so many products of two unit vectors are off by less
        self.slack = 4 * (len(head) + 4) * 2.0**-24

    def multiply(self, found: np.ndarray, heads: np.ndarray, chosen: np.ndarray) -> None:
        """Adds the head terms' part of the cosines in the blocks chosen for each query."""
        for block in range(self.blocks):
            rows = np.flatnonzero(chosen[:, block])
            if len(rows):
                found[rows, block] += heads[rows] @ self.dense[block]

    def candidates(self, row: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, k: int, negligible: float = NEGLIGIBLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query and place of all examples that may be among the k nearest of n queries, in order; and of which queries others may be, too."""
        common = self.rank[terms]
        mine = common >= 0
        heads = np.zeros((n, self.top.shape[0]), np.float32)
        heads[row[mine], common[mine]] = weights[mine]
        row, terms, weights = row[~mine], terms[~mine], weights[~mine]
        # what is left out of a query has at most the length `negligible`, so adds at most that (Cauchy-Schwarz, as examples have length 1)
        small = weights**2 * np.bincount(row, minlength=n)[row] <= negligible**2
        rest = np.sqrt(np.bincount(row[small], weights[small] ** 2, n))
        row, terms, weights = row[~small], terms[~small], weights[~small]
        at, sizes = spread(self.begins[terms], self.held[terms])
        width = self.blocks * BLOCK
        found = np.bincount(np.repeat(row * width, sizes) + self.places[at], np.repeat(weights, sizes) * self.weights[at], n * width).astype(np.float32).reshape(n, self.blocks, BLOCK)
        bounds = found.max(2) + heads @ self.top
        unread = (rest + self.slack)[:, None]
        first = np.argsort(-bounds, axis=1, kind="stable")[:, :FIRST]
        chosen = np.zeros(bounds.shape, bool)
        np.put_along_axis(chosen, first, True, 1)
        self.multiply(found, heads, chosen)
        least = kth_highest(np.take_along_axis(found, first[:, :, None], 1).reshape(n, -1), k)
        self.multiply(found, heads, (bounds + unread >= least[:, None]) & ~chosen)
        found = found.reshape(n, width)
        least = kth_highest(found, k)
        query, place = np.nonzero((found >= least[:, None] - unread) & (found > 0))
        unsure = (rest > 0) & (least <= unread[:, 0])  # an example without any of these terms could be among the nearest
        return query, place, unsure

    def search(self, row: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, k: int, but: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Of each of n queries (terms in the order of their row) the places and cosines of the k nearest examples with a positive cosine, the nearest first, ties by place; never the example `but`.

        Where there are fewer the place is -1 and the cosine 0.
        """
        places, cosines = np.full((n, k), -1, np.int64), np.zeros((n, k))
        known = self.held[terms] > 0
        row, terms, weights = row[known], terms[known], weights[known]
        read = np.cumsum(np.bincount(row, np.where(self.rank[terms] < 0, self.held[terms], 0), n))
        low = 0
        while low < n:
            most = (read[low - 1] if low else 0) + POSTINGS
            high = min(n, low + QUERIES, max(low + 1, int(np.searchsorted(read, most, "right"))))
            a, b = np.searchsorted(row, (low, high))
            if a < b:
                self.search_some(row[a:b] - low, terms[a:b], weights[a:b], places[low:high], cosines[low:high], None if but is None else but[low:high])
            low = high
        return places, cosines

    def search_some(self, row: np.ndarray, terms: np.ndarray, weights: np.ndarray, places: np.ndarray, cosines: np.ndarray, but: np.ndarray | None) -> None:
        n, k = places.shape
        more = k + (but is not None)  # one of those found may be the example left out
        query, place, unsure = self.candidates(row, terms, weights, n, more)
        if unsure.any():
            again = unsure[row]
            sure = ~unsure[query]
            query_2, place_2, _ = self.candidates(row[again], terms[again], weights[again], n, more, 0.0)
            query, place = np.append(query[sure], query_2), np.append(place[sure], place_2)
        if but is not None:
            other = self.ids[place] != but[query]
            query, place = query[other], place[other]
        order = np.argsort(query, kind="stable")
        query, place = query[order], place[order]
        edges, of_terms = np.searchsorted(query, np.arange(n + 1)).tolist(), np.searchsorted(row, np.arange(n + 1)).tolist()
        scores = np.zeros(len(query))
        for i in np.unique(query).tolist():
            mine = place[edges[i] : edges[i + 1]]
            own = terms[of_terms[i] : of_terms[i + 1]]
            self.query[own] = weights[of_terms[i] : of_terms[i + 1]]
            bounds = list(zip(self.bounds[mine].tolist(), self.bounds[mine + 1].tolist()))
            products = self.query.take(np.concatenate([self.own_terms[a:b] for a, b in bounds])) * np.concatenate([self.own_weights[a:b] for a, b in bounds])
            sizes = self.sizes[mine]
            scores[edges[i] : edges[i + 1]] = np.add.reduceat(products, np.cumsum(sizes) - sizes, dtype=np.float64)
            self.query[own] = 0
        scores = np.round(scores, 7)
        order = np.lexsort((place, -scores, query))
        query, place, scores = query[order], place[order], scores[order]
        nth = np.arange(len(query)) - np.searchsorted(query, query)
        best = nth < k
        places[query[best], nth[best]], cosines[query[best], nth[best]] = place[best], scores[best]

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, but: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """As search, of one query, without places that are -1."""
        places, cosines = self.search(np.zeros(len(terms), np.int64), terms, weights, 1, k, None if but is None else np.array([but]))
        return places[0][places[0] >= 0], cosines[0][places[0] >= 0]


def kth_highest(rows: np.ndarray, k: int) -> np.ndarray:
    """Of each row; 0 if it is shorter."""
    return np.partition(rows, -k, axis=1)[:, -k] if rows.shape[1] >= k else np.zeros(len(rows), rows.dtype)


def spread(begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after another, and the sizes."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0), sizes


class ToxicityModel:
    def __init__(self, worth: np.ndarray, index: BlockMaxIndex, prior: float):
        self.worth, self.index, self.prior = worth, index, prior
        self.curve: list[float] = []
        self.sent = None

    def shared(self, spark: SparkSession) -> Broadcast:
        """What votes need of the model, broadcast once."""
        if self.sent is None:
            self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(self))
        return self.sent

    def __getstate__(self) -> dict:
        return self.__dict__ | {"sent": None}

    def vote(self, row: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, but: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        """Of n vectors: share of toxic neighbours weighted by closeness, drawn towards the prior; number of neighbours; the five nearest."""
        if not len(self.index.ids):
            return np.full(n, float(self.prior)), np.zeros(n, np.int64), [[]] * n
        places, scores = self.index.search(row, terms, weights, n, NEIGHBOURS, but)
        closeness = scores**2  # 0 where there is no neighbour
        vote = ((closeness * self.index.labels[places]).sum(1) + 0.1 * self.prior) / (closeness.sum(1) + 0.1)
        found = (places >= 0).sum(1)
        return vote, found, [ids[:m] for ids, m in zip(self.index.ids[places[:, :5]].tolist(), found.tolist())]


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic of a bounded label sample, which is broadcast."""
    return docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, examples: int = EXAMPLES) -> ToxicityModel:
    """Weights of terms, index and calibration. Document frequencies are those of all documents, the terms' bearing is that of the label sample."""
    texts = cut(labelled_texts(docs, chosen_labels(labels, sample, "terms")), "rated")
    seen, toxic, rows, bad = term_counts(texts)
    prior = bad / max(1, rows)
    both = 0 < bad < rows
    if both:
        df, _, n, _ = term_counts(docs.select("text", F.lit(None).cast("int").alias("toxic")))
        worth = ((np.log((1 + n) / (1 + df)) + 0.1) * bearing(seen, toxic, rows, bad)).astype(np.float32)
    else:
        worth = np.zeros(SLOTS, np.float32)
    vectors = cut(vectorize(texts, worth), "vectors")
    filled = vectors.filter(F.size("terms") > 0)
    share = examples / max(1, filled.count())
    indexed = filled if share >= 1 else filled.filter(F.pmod(F.xxhash64("doc_id", F.lit("index")), F.lit(1_000_000)) < int(share * 1_000_000))
    held = indexed.toArrow()  # at most about `examples` vectors
    index = BlockMaxIndex(
        held["doc_id"].to_pylist(), held["toxic"].to_pylist(), [(np.array(t, np.int64), np.array(w)) for t, w in zip(held["terms"].to_pylist(), held["weights"].to_pylist())], SLOTS, held["digest"].to_pylist()
    )
    model = ToxicityModel(worth, index, prior)
    bins = votes(vectors, model, leave_out=True).groupBy(bin_of().alias("bin")).agg(F.count("*").alias("n"), F.sum("toxic").alias("p")).collect()
    model.curve = rising([(next((r["n"] for r in bins if r["bin"] == b), 0), next((r["p"] for r in bins if r["bin"] == b), 0)) for b in range(BINS + 1)], prior)
    return model


def rising(bins: list[tuple[int, int]], prior: float) -> list[float]:
    """Share of toxic rows per bin, smoothed, never falling (pool adjacent violators)."""
    pools = []
    for n, p in bins:
        pools.append([p + prior, n + 1.0, 1])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] > pools[-1][0] / pools[-1][1]:
            p2, n2, k2 = pools.pop()
            pools[-1] = [pools[-1][0] + p2, pools[-1][1] + n2, pools[-1][2] + k2]
    return [p / n for p, n, k in pools for _ in range(k)]


def bin_of() -> Column:
    """0 for texts without neighbours, else the tenth that the vote falls into."""
    return F.when(F.col("found") == 0, 0).otherwise(1 + F.least(F.floor(F.col("vote") * BINS), F.lit(BINS - 1))).cast("int")


def vectorize(texts: DataFrame, worth: np.ndarray) -> DataFrame:
    """doc_id, toxic, digest (of the text, which orders ties), terms and weights of every row."""
    shared = texts.sparkSession.sparkContext.broadcast(worth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, slots, weights = weigh_rows(*slot_counts(batch.column("text")), shared.value)
            bounds = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
            vectors = [pa.ListArray.from_arrays(bounds, pa.array(slots.astype(np.int32))), pa.ListArray.from_arrays(bounds, pa.array(weights.astype(np.float32)))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("toxic").cast(pa.int32()), batch.column("digest"), *vectors], VECTORS.names)

    return map_arrow(texts.select("doc_id", "text", "toxic", F.xxhash64("text").alias("digest")), run, VECTORS)


def votes(rows: DataFrame, model: ToxicityModel, leave_out: bool = False) -> DataFrame:
    """doc_id, vote, found (neighbours), evidence (ids of the nearest examples), toxic, of vectors or of texts. leave_out: no text is its own neighbour."""
    shared = model.shared(rows.sparkSession)
    ready = "terms" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(shared.value)
        for batch in batches:
            if ready:
                terms, weights = batch.column("terms"), batch.column("weights")
                row = np.repeat(np.arange(batch.num_rows), np.diff(terms.offsets.to_numpy()))
                vectors = row, terms.flatten().to_numpy().astype(np.int64), weights.flatten().to_numpy()
            else:
                vectors = weigh_rows(*slot_counts(batch.column("text")), own.worth)
            vote, found, evidence = own.vote(*vectors, batch.num_rows, batch.column("doc_id").to_numpy() if leave_out else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(vote), pa.array(found.astype(np.int32)), pa.array(evidence, pa.list_(pa.int64())), batch.column("toxic")], SCORES.names)

    return map_arrow(rows, run, SCORES)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per document: doc_id, score (calibrated, 0 to 1), predicted, neighbours, evidence. Null texts count as empty."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.lit(None).cast("int").alias("toxic"))
    curve = F.array(*[F.lit(float(x)) for x in model.curve])
    # between bins the vote itself orders; the calibrated share of its bin and the next are joined by a line
    inside = F.col("vote") * BINS - F.least(F.floor(F.col("vote") * BINS), F.lit(BINS - 1))
    here, after = F.element_at(curve, bin_of() + 1), F.element_at(curve, F.least(bin_of() + 2, F.lit(BINS + 1)))
    value = F.when(F.col("found") == 0, F.element_at(curve, 1)).otherwise(here + (after - here) * inside * 0.5)
    return (
        votes(texts, model)
        .withColumn("score", F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))
        .select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.col("found").alias("neighbours"), "evidence")
    )
