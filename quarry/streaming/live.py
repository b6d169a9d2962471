"""Live tables kept current by a stream of events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from quarry.functions.schemas import COLUMNS, KEYS
from quarry.operators import events as E
from quarry.sources.live_tables import BUCKET_ROWS, FOLD_AFTER, append, fold, newest, publish_live, vacuum

Handler = Callable[[DataFrame], None]


class LiveTables:
    """quotes_live and orders_live below root. A registered handler replaces the default for its event type; its error stops only its own events of that batch, which go to the dead letters with the error's first line.

    A micro-batch appends its own rows; every fold_after batches they are folded into the buckets of their keys.
    """

    def __init__(self, spark: SparkSession, root: str, secret: str, publish_to: str | None = None, fold_after: int = FOLD_AFTER, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.root, self.secret, self.publish_to, self.fold_after, self.bucket_rows = spark, root.rstrip("/"), secret, publish_to, fold_after, bucket_rows
        self.handlers: dict[str, Handler] = {}

    def register(self, event_type: str, handler: Handler) -> None:
        self.handlers[event_type] = handler

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch; the same batch_id again changes nothing, since a live table knows its last batch."""
        triaged = E.triage(batch, self.secret, tuple(self.handlers)).persist()
        failed: dict[str, str] = {}
        try:
            for event_type, handler in self.handlers.items():
                try:
                    handler(triaged.filter((F.col("type") == event_type) & F.col("applied")))
                except Exception as error:  # a handler's fault must not lose other events
                    failed[event_type] = (str(error) or type(error).__name__).splitlines()[0]
            routed = E.route(triaged.filter(~F.col("type").isin(*self.handlers) | F.col("type").isNull()) if self.handlers else triaged)
            self.write("quotes_live", E.live_quotes(routed["quotes"]), batch_id)
            self.write("orders_live", E.live_orders(routed["orders"]), batch_id)
            dead = routed["dead"].select("seq", "body", "status", "reason", F.lit(None).cast("string").alias("error"))
            if self.handlers:
                own = triaged.filter(F.col("type").isin(*self.handlers))
                dead = dead.unionByName(own.filter(~F.col("applied")).select("seq", "body", "status", "reason", F.lit(None).cast("string").alias("error")))
                for event_type, error in failed.items():
                    lost = own.filter(F.col("applied") & (F.col("type") == event_type))
                    dead = dead.unionByName(lost.select("seq", "body", F.lit(500).alias("status"), F.lit("handler failed").alias("reason"), F.lit(error).alias("error")))
            dead.write.mode("overwrite").parquet(f"{self.root}/dead/batch={batch_id}")
        finally:
            triaged.unpersist()

    def write(self, table: str, rows: DataFrame, batch_id: int) -> None:
        path = f"{self.root}/{table}"
        if append(rows, path, batch_id, KEYS[table]) and len(newest(self.spark, path)[1]["changes"]) >= self.fold_after:
            fold(self.spark, path, self.bucket_rows)
            vacuum(self.spark, path)
        if self.publish_to:
            publish_live(self.spark, path, f"{self.publish_to.rstrip('/')}/{table}", COLUMNS[table])

    def start(self, events: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        """once: all that has landed, and the query that found nothing more. Spark gives a Python source one batch to a run of availableNow, so runs follow until one reads nothing."""
        writer = events.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        if not once:
            return writer.start()
        while True:
            query = writer.trigger(availableNow=True).start()
            query.awaitTermination()
            if not has_read(query):
                return query


def has_read(query: StreamingQuery) -> bool:
    """Whether the query's last batch moved on in any of its sources."""
    last = query.lastProgress
    return last is not None and any(s["startOffset"] != s["endOffset"] for s in last["sources"])


def latest_by_key(stream: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """Per key the row of the highest seq, kept as streaming state; for output mode update. State grows with the keys."""
    rest = [c for c in stream.columns if c not in keys]
    found = stream.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("row"))
    return found.select(*keys, *(F.col("row")[c].alias(c) for c in rest))
