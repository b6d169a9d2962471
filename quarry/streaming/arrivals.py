"""Events in the order of their arrival, from a folder of landed files or from Kafka.

A landing folder has no order of its own, so the source keeps one: a log that names the files of each batch as they were first seen. Spark's checkpoint
holds the log's entry up to which a stream has read; what a file's place in the log is, it stays after a restart. An event's seq is the number of its file times 2^36 plus the
byte at which its line begins, so large files are read in ranges by several tasks, and no line has to be counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bits of a line's place in its file, and bytes of a range that one task reads.
PLACE_BITS, RANGE_BYTES = 36, 64 << 20
SCHEMA = "seq bigint, token string, signature string, body string"
FIELDS = ("token", "signature", "body")


class Range(InputPartition):
    """The lines of a file that begin in [start, end)."""

    def __init__(self, path: str, number: int, start: int, end: int):
        self.path, self.number, self.start, self.end = path, number, start, end


class Arrivals(DataSource):
    """Options: path (folder of JSON lines), log (folder that the source may write), files (most of a batch), order (of files first seen together: time or name), range (bytes)."""

    @classmethod
    def name(cls) -> str:
        return "arrivals"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ArrivalReader(self.options)


class ArrivalReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.log = options["path"], options["log"]
        self.most, self.order, self.range = int(options.get("files", 1000)), options.get("order", "time"), int(options.get("range", RANGE_BYTES))
        self.seen: set[str] | None = None
        self.entries = self.files = 0

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def entry(self, n: int) -> dict:
        fs, folder = pafs.FileSystem.from_uri(self.log)
        with fs.open_input_stream(f"{folder}/{n:012d}.json") as file:
            return json.loads(file.readall())

    def catch_up(self) -> None:
        """The files that the log names, read once per process and added to from then on."""
        fs, folder = pafs.FileSystem.from_uri(self.log)
        fs.create_dir(folder, recursive=True)
        names = [f.base_name for f in fs.get_file_info(pafs.FileSelector(folder)) if f.base_name.endswith(".json")]
        self.entries, self.seen = len(names), set()
        for n in range(1, self.entries + 1):
            self.seen.update(p for p, _ in self.entry(n)["files"])
        self.files = len(self.seen)

    def latestOffset(self) -> dict:
        """Names files that no entry has in a new one, if there are any."""
        if self.seen is None:
            self.catch_up()
        fs, folder = pafs.FileSystem.from_uri(self.path)
        found = [f for f in fs.get_file_info(pafs.FileSelector(folder, recursive=True)) if f.is_file and f.base_name[0] not in "._" and f.path not in self.seen]
        found.sort(key=(lambda f: f.path) if self.order == "name" else (lambda f: (f.mtime_ns, f.path)))
        if found := found[: self.most]:
            self.write_entry({"first": self.files, "files": [(f.path, f.size) for f in found]})
            self.seen.update(f.path for f in found)
            self.entries, self.files = self.entries + 1, self.files + len(found)
        return {"entry": self.entries}

    def write_entry(self, entry: dict) -> None:
        """Aside first, then by one rename of a file, so an entry is there whole or not at all."""
        fs, folder = pafs.FileSystem.from_uri(self.log)
        name = f"{folder}/{self.entries + 1:012d}.json"
        with fs.open_output_stream(f"{name}.part") as file:
            file.write(json.dumps(entry).encode())
        fs.move(f"{name}.part", name)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for n in range(start["entry"] + 1, end["entry"] + 1):
            entry = self.entry(n)
            for i, (path, size) in enumerate(entry["files"]):
                if size >= 1 << PLACE_BITS:
                    raise ValueError(f"{path} holds {size} bytes; at most {(1 << PLACE_BITS) - 1}")
                out += [Range(path, entry["first"] + i, a, min(a + self.range, size)) for a in range(0, size, self.range)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        with fs.open_input_file(partition.path) as file:
            for batch in batches_of(lines_of(file, partition.start, partition.end)):
                columns = [pa.array([(partition.number << PLACE_BITS) + at for at, _ in batch], pa.int64())]
                rows = [fields_of(line) for _, line in batch]
                columns += [pa.array([r[i] for r in rows], pa.string()) for i in range(len(FIELDS))]
                yield pa.RecordBatch.from_arrays(columns, ["seq", *FIELDS])

    def commit(self, end: dict) -> None:
        pass


def lines_of(file, start: int, end: int, block: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """Place and bytes of the lines that begin in [start, end); blank lines are left out. A line that began before start is that range's."""
    at = max(start - 1, 0)
    file.seek(at)
    held, over, first = b"", False, start > 0
    while True:
        cut = held.find(b"\n")
        while cut < 0 and not over:
            more = file.read(block)
            over, scanned = not more, len(held)
            held += more
            cut = held.find(b"\n", scanned)
        line, rest = (held, b"") if cut < 0 else (held[:cut], held[cut + 1 :])
        if first:
            first = False
        elif at >= end:
            return
        elif line.strip():
            yield at, line
        if cut < 0:
            return
        at, held = at + cut + 1, rest


def batches_of(lines: Iterator[tuple[int, bytes]], rows: int = 1000) -> Iterator[list[tuple[int, bytes]]]:
    batch: list[tuple[int, bytes]] = []
    for line in lines:
        batch.append(line)
        if len(batch) >= rows:
            yield batch
            batch = []
    if batch:
        yield batch


def fields_of(line: bytes) -> tuple[str | None, ...]:
    """token, signature, body; a line that is no JSON object is itself the body, for triage to reject. A body that is no string is written as JSON."""
    text = line.decode("utf-8", "replace")
    try:
        row = json.loads(text)
    except ValueError:
        row = None
    if not isinstance(row, dict):
        return None, None, text
    return tuple(x if x is None or isinstance(x, str) else json.dumps(x) for x in map(row.get, FIELDS))


def read_arrivals(spark: SparkSession, path: str | None = None, log: str | None = None, kafka: dict[str, str] | None = None, **options: str) -> DataFrame:
    """A stream of seq, token, signature, body in the order of arrival.

    From a folder of JSON lines (path, and a log folder that the source keeps), or from Kafka by that source's own options: there seq is the offset times 4096 plus the partition, the value is the
    body, and token and signature are headers; events of one key share a partition, so seq orders them.
    """
    if kafka is not None:
        rows = spark.readStream.format("kafka").options(**kafka).option("includeHeaders", True).load()
        header = lambda name: F.get(F.filter("headers", lambda h: h["key"] == name), F.lit(0))["value"].cast("string").alias(name)
        return rows.select((F.col("offset") * 4096 + F.col("partition")).alias("seq"), header("token"), header("signature"), F.col("value").cast("string").alias("body"))
    if not path or not log:
        raise ValueError("a folder and a log are needed, or options for Kafka")
    spark.dataSource.register(Arrivals)
    return spark.readStream.format("arrivals").option("path", path).option("log", log).options(**options).load()
