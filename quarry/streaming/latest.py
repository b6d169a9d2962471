"""The latest row per key as streaming state, with changes only as output."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

#: Fixed value: the state store that such processors need.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Latest(StatefulProcessor):
    """Holds each key's row of the highest seq. A batch's row replaces it only with a higher seq, so late and repeated rows change nothing and put nothing out."""

    def __init__(self, keys: list[str], seq: str, schema: StructType):
        self.keys, self.seq, self.schema = keys, seq, schema
        self.rest = [f.name for f in schema.fields if f.name not in keys]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("latest", StructType([f for f in self.schema.fields if f.name not in self.keys]))

    def handleInputRows(self, key, rows: Iterator[Row], timer_values) -> Iterator[Row]:
        best = max((r for r in rows if r[self.seq] is not None), key=lambda r: (r[self.seq], *((r[c] is not None, str(r[c])) for c in self.rest)), default=None)
        if best is None:
            return
        held = self.held.get() if self.held.exists() else None
        if held is None or best[self.seq] > held[self.rest.index(self.seq)]:
            self.held.update(tuple(best[c] for c in self.rest))
            yield Row(**{f.name: best[f.name] for f in self.schema.fields})

    def close(self) -> None:
        pass


def latest_changes(stream: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """Per batch, the rows that became their key's latest; for output mode update, in a session whose state store is RocksDB (see with_store).

    Lower, equal and null seq change nothing; equal seq within a batch are told apart by the other columns. State grows with the keys.
    """
    return stream.groupBy(*keys).transformWithState(statefulProcessor=Latest(keys, seq, stream.schema), outputStructType=stream.schema, outputMode="Update", timeMode="None")


def with_store(spark: SparkSession) -> SparkSession:
    """A session of its own with the state store that latest_changes needs; the given one stays as it is."""
    session = spark.newSession()
    session.conf.set(*STORE)
    return session


def held_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What the state of a checkpoint holds: the keys' columns and those of their latest rows."""
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "latest").load().select("key.*", "value.*")
