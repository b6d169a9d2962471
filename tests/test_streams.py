"""Arrival order as a source, and the latest row per key as state."""

import io
import json
import random

import pytest

from quarry.sources.live_tables import read_live
from quarry.streaming.arrivals import PLACE_BITS, ArrivalReader, fields_of, lines_of, read_arrivals
from quarry.streaming.latest import held_rows, latest_changes, with_store
from quarry.streaming.live import LiveTables
from tests.test_core import SECRET


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def drain(stream, out, checkpoint):
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def test_lines_belong_to_the_range_in_which_they_begin():
    draw = random.Random(2)
    for _ in range(60):
        raw = b"\n".join(bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 9))) for _ in range(draw.randint(0, 12))) + draw.choice([b"", b"\n"])
        want, at = [], 0
        for line in raw.split(b"\n"):
            if line.strip():
                want.append((at, line))
            at += len(line) + 1
        for size in (1, 3, 7, 1000):
            assert [x for a in range(0, len(raw), size) for x in lines_of(io.BytesIO(raw), a, min(a + size, len(raw)), block=4)] == want


def test_fields_of_odd_lines():
    assert fields_of(b'{"token": "t", "body": {"a": 1}}') == ("t", None, '{"a": 1}')
    assert fields_of(b"{bad") == (None, None, "{bad") and fields_of(b"[1]") == (None, None, "[1]") and fields_of(b"\xff") == (None, None, "�")


def test_seq_is_the_same_after_a_restart(spark, tmp_path):
    land(tmp_path / "in", "b.json", [{"body": "1"}, {"body": "2"}])
    stream = lambda log: read_arrivals(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/{log}", order="name", range="5")
    drain(stream("log"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    land(tmp_path / "in", "a.json", [{"body": "3"}])  # a name that sorts before what was seen, and lands late
    land(tmp_path / "in", "_aside.json", [{"body": "no"}])
    drain(stream("log"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    found = {r.body: r.seq for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert found == {"1": 0, "2": 14, "3": 1 << PLACE_BITS}
    # a stream without a checkpoint reads the same log to the same numbers
    drain(stream("log"), f"{tmp_path}/again", f"{tmp_path}/other")
    assert {r.body: r.seq for r in spark.read.parquet(f"{tmp_path}/again").collect()} == found


def test_a_run_once_reads_more_files_than_a_batch_holds(spark, tmp_path):
    body = lambda i: json.dumps({"type": "quote.created", "data": {"quote_number": str(i), "revision_number": 1, "status": "s"}})
    for i in range(7):
        land(tmp_path / "in", f"f{i}.json", [{"token": SECRET, "body": body(i)}])
    tables, events = LiveTables(spark, f"{tmp_path}/tables", SECRET), read_arrivals(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/log", order="name", files="3")
    tables.start(events, f"{tmp_path}/checkpoint", once=True).awaitTermination()
    assert {(r.seq >> PLACE_BITS, r.quote_number) for r in read_live(spark, f"{tmp_path}/tables/quotes_live").collect()} == {(i, str(i)) for i in range(7)}


def test_files_of_a_batch_are_bounded_and_ordered_by_time(tmp_path):
    import os

    for i, name in enumerate("cab"):
        land(tmp_path / "in", name, [{"body": name}])
        os.utime(tmp_path / "in" / name, (i, i))
    reader = ArrivalReader({"path": f"file://{tmp_path}/in", "log": f"file://{tmp_path}/log", "files": "2"})
    assert [reader.latestOffset() for _ in range(3)] == [{"entry": 1}, {"entry": 2}, {"entry": 2}]
    parts = reader.partitions({"entry": 0}, {"entry": 2})
    assert [(p.path[-1], p.number) for p in parts] == [("c", 0), ("a", 1), ("b", 2)]
    # a process that begins anew goes on where the log ends
    land(tmp_path / "in", "d", [{"body": "d"}])
    anew = ArrivalReader({"path": f"file://{tmp_path}/in", "log": f"file://{tmp_path}/log"})
    assert anew.latestOffset() == {"entry": 3} and [p.number for p in anew.partitions({"entry": 2}, {"entry": 3})] == [3]


def test_arrivals_need_a_folder_and_a_log(spark):
    with pytest.raises(ValueError):
        read_arrivals(spark, "file:///nowhere")


def test_latest_rows_change_with_a_higher_seq_only(spark, tmp_path):
    session = with_store(spark)
    schema = "k string, seq bigint, v string"
    batches = [[("a", 5, "x"), ("b", 1, None), ("a", 3, "old")], [("a", 4, "late"), ("b", 1, "again"), ("c", None, "none")], [("b", 2, "y"), (None, 7, "null key")]]
    changes = []
    for i, rows in enumerate(batches):
        land(tmp_path / "in", f"{i}.json", [dict(zip(("k", "seq", "v"), r)) for r in rows])
        stream = session.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
        put = lambda df, _: changes.append(sorted((tuple(r) for r in df.collect()), key=str))
        latest_changes(stream, ["k"]).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert [c for c in changes if c] == [[("a", 5, "x"), ("b", 1, None)], [("b", 2, "y"), (None, 7, "null key")]]
    assert sorted((tuple(r) for r in held_rows(session, f"{tmp_path}/checkpoint").collect()), key=str) == sorted([("a", 5, "x"), ("b", 2, "y"), (None, 7, "null key")], key=str)
