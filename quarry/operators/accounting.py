"""Accounting for what is missing: failures, attempts, progress, gaps, summaries."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.sources.scratch import new_path, staged


class Counted:
    """Rows that pass a place in a plan, counted by the action that runs it, so that no second pass is needed.

    Spark drops the place from a plan whose result it finds to be empty on the way, and nothing is counted then: a fit place is one that has rows only if the result has.
    """

    def __init__(self, name: str):
        self.name, self.seen = name, None

    def on(self, df: DataFrame) -> DataFrame:
        self.seen = Observation(self.name)
        return df.observe(self.seen, F.count(F.lit(1)).alias("rows"))

    @property
    def rows(self) -> int:
        """After the action; 0 if the place was never put into a plan, or dropped from one without rows."""
        try:
            return 0 if self.seen is None else int(self.seen.get.get("rows", 0))
        except Py4JError:
            return 0


def new_failures(failed: DataFrame, ledger: DataFrame, key: str = "id") -> DataFrame:
    """L1: failed keys not yet in the ledger, each once; null keys are dropped."""
    return failed.select(F.col(key).cast("string").alias(key)).filter(F.col(key).isNotNull()).distinct().join(ledger.select(F.trim(F.col(key).cast("string")).alias(key)), key, "left_anti")


def classify_attempts(log: DataFrame, max_attempts: int = 3) -> DataFrame:
    """L2: outcome per item of an attempt log (item_id, attempt, http_status): the first 200 or 404 among the allowed attempts decides, else exhausted.

    One aggregation; attempts is the deciding attempt, or the number of those made.
    """
    seen = log.filter(F.col("attempt") <= max_attempts)
    decided = F.min(F.when(F.col("http_status").isin(200, 404), F.struct("attempt", "http_status")))
    found = seen.groupBy("item_id").agg(decided.alias("d"), F.max("attempt").alias("last"))
    outcome = F.when(F.col("d.http_status") == 200, "ok").when(F.col("d.http_status") == 404, "not_found").otherwise("exhausted")
    return found.select("item_id", outcome.alias("outcome"), F.coalesce("d.attempt", "last").cast("bigint").alias("attempts"))


def ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """df in ranges of the order, written once so that every reader sees the same ranges; q_part numbers them."""
    return staged(df.repartitionByRange(*order).withColumn("q_part", F.spark_partition_id()), "ranges")


def before_each(parts: DataFrame, value: Column) -> DataFrame:
    """q_part, before: the sum of value over all earlier ranges; a small row per range."""
    sums = parts.groupBy("q_part").agg(value.alias("n"))
    return sums.select("q_part", F.coalesce(F.sum("n").over(Window.orderBy("q_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))


def numbered(df: DataFrame, order: list[str], name: str = "index") -> DataFrame:
    """df with a dense index from 0 in the given order (which must be total), without a sort in one task: ranges are sorted apart, and each adds the rows of those before it."""
    parts = ranged(df, order)
    local = parts.withColumn("q_row", F.row_number().over(Window.partitionBy("q_part").orderBy(*order)))
    return local.join(before_each(parts, F.count("*")), "q_part").withColumn(name, F.col("before") + F.col("q_row") - 1).drop("q_part", "q_row", "before")


def batch_progress(df: DataFrame, batch_size: int) -> DataFrame:
    """L3: per batch of batch_size rows: batch, total_batches, processed so far, percent of all. It follows from the number of rows alone, so nothing is sorted."""
    n = df.count()
    total = -(-n // batch_size)
    done = F.least(F.col("batch") * batch_size, F.lit(n))
    rows = df.sparkSession.range(1, total + 1).withColumnRenamed("id", "batch")
    return rows.select("batch", F.lit(total).cast("bigint").alias("total_batches"), done.cast("bigint").alias("processed"), F.round(done * 100.0 / max(n, 1), 1).cast("double").alias("percent"))


def slice_rows(df: DataFrame, order: list[str], first: int, last: int) -> DataFrame:
    """L4: rows first to last (from 0, both included) of the rows in a total order.

    The rows are written once in ranges of the order; their counts, a number per range, tell which ranges hold the slice, and only those are read and sorted, each apart.
    """
    path = new_path(df.sparkSession, "ranges")
    df.repartitionByRange(*order).withColumn("q_part", F.spark_partition_id()).write.partitionBy("q_part").parquet(path)
    parts = df.sparkSession.read.schema(f"{', '.join(f'`{n}` {t}' for n, t in df.dtypes)}, q_part int").parquet(path)
    before, wanted = 0, {}
    for part, n in sorted((r["q_part"], r["count"]) for r in parts.groupBy("q_part").count().collect()):
        if before <= last and before + n > first:
            wanted[part] = before
        before += n
    if not wanted:
        return parts.drop("q_part").limit(0)
    at = F.element_at(F.create_map(*(F.lit(x) for pair in wanted.items() for x in pair)), F.col("q_part")) + F.row_number().over(Window.partitionBy("q_part").orderBy(*order)) - 1
    return parts.filter(F.col("q_part").isin(list(wanted))).withColumn("q_at", at).filter(F.col("q_at").between(first, last)).drop("q_part", "q_at")


def missing_ids(df: DataFrame, key: str, start: int, end: int) -> DataFrame:
    """The ids from start to end that have no record."""
    return df.sparkSession.range(start, end + 1).withColumnRenamed("id", key).join(df.select(F.col(key).cast("bigint").alias(key)), key, "left_anti")


def run_summary(good: DataFrame, bad: DataFrame, child: DataFrame) -> DataFrame:
    """Processed, failed and child rows, in one row."""
    one = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("k"), "n")
    rows = one(good, "processed").unionByName(one(bad, "failed")).unionByName(one(child, "child_rows"))
    return rows.agg(*(F.max(F.when(F.col("k") == k, F.col("n"))).alias(k) for k in ("processed", "failed", "child_rows")))


def preview(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows in order, numbered from 1; the limit runs first, so the numbering sees n rows."""
    return df.orderBy(*order).limit(n).withColumn("row", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def page_stats(rows: DataFrame, page: str = "page") -> DataFrame:
    """Rows per page, and so far; pages are summed in ranges, and each adds the rows of those before it."""
    parts = ranged(rows.groupBy(page).agg(F.count("*").alias("n")), [page])
    local = parts.withColumn("own", F.sum("n").over(Window.partitionBy("q_part").orderBy(page)))
    return local.join(before_each(parts, F.sum("n")), "q_part").select(page, "n", (F.col("own") + F.col("before")).alias("so_far"))


def childless(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """Keys of parents without child rows."""
    return parent.select(key).distinct().join(child.select(key), key, "left_anti")
