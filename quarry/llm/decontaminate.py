"""Benchmark decontamination by canonical templates; DataFrame functions only (operator 1).

Numbers, units after numbers and names (capitalised words inside a sentence) become typed placeholders; what remains is lower-cased and cut into words.
Windows of eight template words are hashed and joined with those of the benchmark. A document that holds at
least half of an item's windows, or twenty of them, is a candidate. Where matched windows have placeholders, the values in the
document must answer to the item's values consistently: a re-parameterised question puts one value for each of the item's. It may put
one value for several of them, so where all windows match, only a value of the item that stands for several of the document counts against it.
Each window is read where it was found, so partial, shifted and repeated copies keep their evidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, free_name, is_empty, is_small, sized

WINDOW, LEAST_WORDS, LEAST_LITERAL = 8, 3, 3
LEAST_SHARE, LEAST_RUN, LEAST_CONSISTENT = 0.5, 20, 0.75
MOST_BROADCAST = 500_000
NUM, UNIT, NAME, MARK = "", "", "", ""
# Units of measurement that may follow a number.
UNITS = "mm cm dm m km in ft yd mi mg g kg t lb lbs oz ml cl dl l ms s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years percent pct dollar dollars usd eur euro euros cent cents pound pounds inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms liter liters litre litres ton tons degree degrees mph kmh w kw kwh v hz khz mhz ghz kb mb gb tb".split()


def words_of(text: Column) -> Column:
    """Words of a prepared text: runs of letters, digits and marks."""
    return F.split(F.trim(F.regexp_replace(text, rf"[^\p{{L}}\p{{M}}\p{{N}}{NUM}-{MARK}]+", " ")), " ")


def prepared(text: Column) -> Column:
    """text with each number as one word: its separators marked, letters after it set apart."""
    text = F.coalesce(text, F.lit(""))
    numbers = F.regexp_replace(F.regexp_replace(text, r"(?<=\d)[.,](?=\d)", MARK), r"(?<=\d)(?=\p{L})|(?<=\p{L})(?=\d)", " ")
    return F.when(text.rlike(r"\d"), numbers).otherwise(text)


def template(text: Column) -> Column:
    """A prepared text with placeholders for names, numbers and units; the number of words stays."""
    named = F.regexp_replace(text, r"(?<=[\p{L}\p{N},;] )\p{Lu}\p{Ll}[\p{L}\p{M}]*", NAME)
    numbered = F.regexp_replace(named, rf"\p{{N}}[\p{{N}}{MARK}]*", NUM)
    measured = F.regexp_replace(numbered, rf"(?i)(?<={NUM}[^\p{{L}}\p{{N}}]{{1,2}})(?:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?![\p{{L}}\p{{M}}\p{{N}}])", UNIT)
    return F.lower(F.when(text.rlike(r"\d"), measured).otherwise(named))


def window_hashes(words: str, size: int) -> Column:
    """Hashes of all windows of `size` words, in order, from a column of word hashes."""
    window = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)])
    return F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(0), F.size(words) - size), window)).otherwise(F.array().cast("array<bigint>"))


def templates(rows: DataFrame, text_col: str) -> DataFrame:
    """rows with the columns t_words (template words) and t_hashes; the words of an empty text are one empty word."""
    return rows.withColumn("t_words", words_of(template(prepared(F.col(text_col))))).withColumn("t_hashes", F.transform("t_words", lambda w: F.xxhash64(w)))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """h, size, item_id, at, n: the benchmark's windows with enough literal words. An item shorter than a window is one window of its own size; one of fewer than LEAST_WORDS must be a whole text."""
    items = benchmark.select("item_id", F.col("text").alias("i_text")).filter("item_id IS NOT NULL").distinct()
    items = templates(items, "i_text").filter("array_join(t_words, '') <> ''").withColumn("size", F.least(F.size("t_words"), F.lit(WINDOW)))
    hashes = F.lit(None).cast("array<bigint>")
    for size in range(1, WINDOW + 1):
        hashes = F.when(F.col("size") == size, window_hashes("t_hashes", size)).otherwise(hashes)
    rows = items.select("item_id", "size", "t_words", F.posexplode(hashes).alias("at", "h"))
    literal = F.size(F.filter(F.slice("t_words", F.col("at") + 1, F.col("size")), lambda w: ~w.isin(NUM, UNIT, NAME)))
    rows = rows.withColumn("literal", literal).filter(F.col("literal") >= F.least(F.col("size"), F.lit(LEAST_LITERAL)))
    counts = rows.groupBy("item_id", "size").agg(F.countDistinct("h").alias("n"), F.max(F.col("literal") < F.col("size")).alias("item_slots"))
    return rows.join(counts, ["item_id", "size"]).select("h", "size", "item_id", "at", "n", (F.col("literal") < F.col("size")).alias("has_slots"), "item_slots")


def matches(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, key, item_id, size, at, place, h, n, has_slots, item_slots: the benchmark's windows found in docs (doc_id, key, text)."""
    small = sized(windows, MOST_BROADCAST)
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # eight values at most
    # a word or two are a leak only where they are the whole text
    hashes_of = lambda n: window_hashes("t_hashes", n) if n >= LEAST_WORDS else F.when(F.size("t_hashes") == n, window_hashes("t_hashes", n)).otherwise(F.array().cast("array<bigint>"))
    # a document is made a template once; its windows of every size come out of the same word hashes
    windowed = templates(docs, "text").select("doc_id", "key", F.posexplode(F.array(*map(hashes_of, sizes))).alias("which", "hashes"))
    exploded = windowed.select("doc_id", "key", F.element_at(F.array(*map(F.lit, sizes)), F.col("which") + 1).alias("size"), F.posexplode("hashes").alias("place", "h"))
    return exploded.join(small, ["h", "size"]).select("doc_id", "key", "item_id", "size", "at", "place", "h", "n", "has_slots", "item_slots")


def enough(windows: Column, n: Column) -> Column:
    """Whether so many of an item's n windows make a candidate."""
    return (windows >= LEAST_SHARE * n) | (windows >= LEAST_RUN)


def copies(pairs: DataFrame) -> DataFrame:
    """doc_id, key, item_id, copy, whole, size, at, place: the places of pairs, dealt to the copies of the item in the document; whole tells that the copy alone has enough windows.

    A place that answers to several windows of the item keeps the one whose shift most windows share. A copy ends where the item's windows stop rising.
    """
    pair = ["doc_id", "key", "item_id"]
    rows = pairs.select(*pair, "n", F.explode("places").alias("p")).select(*pair, "n", "p.*")
    rows = rows.withColumn("support", F.count("*").over(Window.partitionBy(*pair, F.col("place") - F.col("at"))))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*pair, "place").orderBy(F.desc("support"), "at"))).filter("rank = 1")
    order = Window.partitionBy(*pair).orderBy("place")
    rows = rows.withColumn("back", F.coalesce((F.col("at") <= F.lag("at").over(order)).cast("int"), F.lit(0))).withColumn("copy", F.sum("back").over(order))
    held = F.size(F.collect_set("h").over(Window.partitionBy(*pair, "copy")))
    return rows.withColumn("whole", enough(held, F.col("n"))).select(*pair, "copy", "whole", "size", "at", "place")


def slot_shares(docs: DataFrame, pairs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, key, item_id, consistent, forward: the share of slots in matched windows whose value is the one that most often stands for the item's value in the same copy (and the item's for it, the lesser counts; in
    forward the first alone), over all copies or in the best of the copies that have enough windows. pairs: doc_id, key, item_id, n, places."""
    words = lambda df, text: templates(df, text).withColumn("raw", words_of(prepared(F.col(text))))
    wanted = pairs.select("doc_id", "key").distinct()
    held = docs.join(F.broadcast(wanted) if is_small(wanted, 50_000) else wanted, (docs["doc_id"].eqNullSafe(wanted["doc_id"])) & (docs["key"] == wanted["key"]), "left_semi")
    doc_words = words(held, "text").select(F.col("doc_id").alias("d_id"), F.col("key").alias("d_key"), F.col("raw").alias("d_raw"))
    items = words(benchmark.select("item_id", F.col("text").alias("i_text")).filter("item_id IS NOT NULL").distinct(), "i_text")
    slots = items.select("item_id", F.posexplode(F.arrays_zip(F.col("t_words").alias("t"), F.col("raw").alias("r"))).alias("at", "w"))
    slots = slots.filter(F.col("w.t").isin(NUM, UNIT, NAME)).select("item_id", "at", F.lower("w.r").alias("asked"))
    copy = ["doc_id", "key", "item_id", "copy", "whole"]
    read = copies(pairs).select(*copy, "at", "place", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("i")).select(*copy, (F.col("at") + F.col("i")).alias("at"), (F.col("place") + F.col("i")).alias("spot")).distinct()
    aligned = read.join(slots, ["item_id", "at"]).join(doc_words, F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("key") == F.col("d_key")))
    counts = aligned.select(*copy, "asked", F.lower(F.get("d_raw", F.col("spot"))).alias("told")).groupBy(*copy, "asked", "told").count()
    # both ways: one value of the document for each of the item's, and one of the item's for each of the document's
    most = lambda side: counts.groupBy(*copy, side).agg(F.max("count").alias("most"), F.sum("count").alias("all"))
    ways = most("asked").withColumn("way", F.lit(1)).drop("asked").unionByName(most("told").withColumn("way", F.lit(2)).drop("told"))
    sums = ways.groupBy(*copy, "way").agg(F.sum("most").alias("most"), F.sum("all").alias("all"))
    best = sums.groupBy(*copy).agg(F.min("most").alias("most"), F.max(F.when(F.col("way") == 1, F.col("most"))).alias("ahead"), F.max("all").alias("all"))
    share = lambda n: F.greatest(F.sum(n) / F.sum("all"), F.max(F.when(F.col("whole"), F.col(n) / F.col("all"))))
    return best.groupBy("doc_id", "key", "item_id").agg(share("most").alias("consistent"), share("ahead").alias("forward"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item it holds: doc_id, key, item_id, windows (found), share, consistent (null without slots).

    key is a hash of the text and tells rows with one doc_id apart; rows that repeat both are one. Null texts count as empty; null ids are kept as ids of their own. Items of one or two words match texts that
    are the item as a whole; windows need three literal words, or as many as they have if that is fewer, so items made of placeholders match nothing. Where all windows of an item are found, consistent is the share by the item's values alone. An empty benchmark or table of documents gives no rows.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    windows = cut(item_windows(benchmark), "windows")
    if is_empty(windows):
        return docs.select("doc_id", "key").limit(0).selectExpr("doc_id", "key", "CAST(NULL AS BIGINT) AS item_id", "0L AS windows", "0D AS share", "0D AS consistent")
    found = matches(docs, windows).groupBy("doc_id", "key", "item_id", "n").agg(F.countDistinct("h").alias("windows"), F.max("has_slots").alias("has_slots"), F.collect_set(F.when(F.col("item_slots"), F.struct("place", "at", "size", "h"))).alias("places"))
    pairs = cut(found.filter(enough(F.col("windows"), F.col("n"))), "leaks")
    plain = pairs.filter("NOT has_slots").select("doc_id", "key", "item_id", "windows", (F.col("windows") / F.col("n")).alias("share"), F.lit(None).cast("double").alias("consistent"))
    slotted = pairs.filter("has_slots")
    if is_empty(slotted):
        return plain
    shares = slot_shares(docs, slotted.select("doc_id", "key", "item_id", "n", "places"), benchmark).select(F.col("doc_id").alias("s_id"), F.col("key").alias("s_key"), F.col("item_id").alias("s_item"), "consistent", "forward")
    checked = slotted.join(shares, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("key") == F.col("s_key")) & (F.col("item_id") == F.col("s_item")), "left")
    checked = checked.withColumn("consistent", F.when(F.col("windows") == F.col("n"), F.col("forward")).otherwise(F.col("consistent")))
    checked = checked.filter(F.coalesce("consistent", F.lit(1.0)) >= LEAST_CONSISTENT)
    return plain.unionByName(checked.select("doc_id", "key", "item_id", "windows", (F.col("windows") / F.col("n")).alias("share"), "consistent"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the documents that hold a benchmark item; columns as they were, whatever their names.

    Null ids, null texts and rows that repeat are as in contaminated: rows of one id and text go or stay together. With an empty benchmark all stay; an empty table stays one.
    """
    key, b_id, b_key = (free_name(docs, n) for n in ("q_key", "b_id", "b_key"))
    bad = cut(contaminated(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias(b_id), F.col("key").alias(b_key)).distinct(), "bad")
    marked = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    clean = marked.join(sized(bad, MOST_BROADCAST), F.col(id_col).eqNullSafe(F.col(b_id)) & (F.col(key) == F.col(b_key)), "left_anti")
    return clean.select(*docs.columns)
