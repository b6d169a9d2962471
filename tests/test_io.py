"""Readers, writers and streams, written and read back in a temporary folder."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quarry.functions.schemas import COLUMNS
from quarry.operators import consolidate as U
from quarry.operators import flatten as P
from quarry.operators import model as M
from quarry.sources import live_tables as L
from quarry.sources import batches as B
from quarry.sources import readers as R
from quarry.sources import writers as W
from quarry.streaming.live import LiveTables, latest_by_key
from tests.test_core import QUOTE, SECRET, docs


def csv_lines(path):
    return sorted(line for f in path.glob("part-*") for line in f.read_text().splitlines())


def test_documents_pages_index(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/7.json").write_text('{"number":\n7}')
    (tmp_path / "d/7-2.json").write_text('{"number": 7}')
    rows = R.read_documents(spark, f"file://{tmp_path}/d").orderBy("revision").collect()
    assert [(r.item_id, r.revision, json.loads(r.body)) for r in rows] == [(7, None, {"number": 7}), (7, "2", {"number": 7})]
    (tmp_path / "p").mkdir()
    (tmp_path / "p/page3.json").write_text('[{"id": 1}]')
    assert [(r.page, r.id) for r in P.flatten_pages(R.read_pages(spark, f"file://{tmp_path}/p"), id_only=True).collect()] == [(3, "1")]
    (tmp_path / "i.json").write_text('[{"quote": 1, "revision": null}, {"quote": 2, "revision": 3}]')
    assert [tuple(r) for r in P.only_revised(R.read_revision_index(spark, f"file://{tmp_path}/i.json")).collect()] == [(2, 3)]


def test_tables_and_batches(spark, tmp_path):
    note = 'two\nlines, "quoted"'
    header = P.quote_headers(P.parse(docs(spark, {"number": 1, "private_notes": note})))
    assert W.write_table(header, f"{tmp_path}/q", "quotes") and not W.write_table(header.limit(0), f"{tmp_path}/none", "quotes") and not (tmp_path / "none").exists()
    back = spark.read.csv(f"{tmp_path}/q", header=True, multiLine=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).first()
    assert list(back.asDict()) == COLUMNS["quotes"] and back.private_notes == note and back.contact_name == " "
    assert W.batch_path("r", "quotes", 1, 5) == "r/quotes/batch=1_5" and W.batch_path("r", "quotes") == "r/quotes/batch=all" and W.batch_path("r", "quotes", 1, 5, True) == "r/quotes/batch=revised_1_5"
    W.write_partition(header, f"{tmp_path}/r/quotes", W.batch_name(1, 5), "quotes")
    assert spark.read.csv(f"{tmp_path}/r/quotes", header=True).columns[-1] == "batch"


def test_mixed_batches_and_bad_files(spark, tmp_path):
    (tmp_path / "quotes_1.csv").write_text("a,b\n1,x\n2,NA\n")
    (tmp_path / "quotes_2.csv").write_text('b,a,c\ny,1,"z\nz"\n x ,1,\n')
    (tmp_path / "quotes_3.csv").write_text("a,b\n9,ok\n8,too,long\n")
    (tmp_path / "other.csv").write_text("a,b\n7,no\n")
    batches = R.read_batches(spark, f"file://{tmp_path}", "quotes_*.csv")
    kept = U.drop_bad_files(batches).drop("file")
    rows = U.clean([kept]).collect()
    assert sorted(((r.a, r.b, r.c) for r in rows), key=str) == sorted([("1", "x", None), ("2", None, None), ("1", "y", "z\nz")], key=str)
    assert W.write_clean(U.clean([kept]), f"{tmp_path}/clean", one_file=True) and len(list((tmp_path / "clean").glob("part-*"))) == 1
    with pytest.raises(FileNotFoundError):
        R.read_batches(spark, f"file://{tmp_path}", "nothing_*.csv")


def test_headers_of_files(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    (tmp_path / "a b/1.csv").write_text('\ufeffid,"two\nlines",c\n1,,x\n2,"",y\n')
    (tmp_path / "a b/2.csv").write_text('c,id\r\nz,3\r\n"q,""r""",\r\n')
    (tmp_path / "a b/3.csv").write_text("")
    (tmp_path / "a b/4.csv").write_text("id")
    (tmp_path / "a b/5.csv").write_text("id\n7\n8,9\n")
    (tmp_path / "a b/6.csv").write_text("id,c\n5\n")
    wide = ",".join(f"column_{i:06d}" for i in range(7_000))  # longer than what is read at first
    assert B.first_record(wide, False) is None and len(B.first_record(wide, True)) == 7_000
    (tmp_path / "wide.csv").write_text(wide + "\n")
    assert len(B.header_of(f"file:{tmp_path}/wide.csv")) == 7_000
    rows = R.read_batches(spark, f"file://{tmp_path}/a b").collect()
    good = sorted((str((r["id"], r["two\nlines"], r["c"])) for r in rows if r._corrupt_record is None))
    assert good == sorted(map(str, [("1", None, "x"), ("2", None, "y"), ("3", None, "z"), (None, None, 'q,"r"'), ("7", None, None)]))
    assert sorted((r.file[-5], r._corrupt_record) for r in rows if r._corrupt_record) == [("5", "8,9"), ("6", "5")]
    (tmp_path / "a b/9.csv").write_text("id,id\n1,2\n")
    with pytest.raises(ValueError):
        R.read_batches(spark, f"file://{tmp_path}/a b")


def test_consolidation_by_increments(spark, tmp_path):
    base, folder = f"file://{tmp_path}", tmp_path / "in"
    run = lambda: tuple(U.consolidate_new(spark, f"{base}/in", "*.csv", f"{base}/out", "id").first())
    table = lambda: sorted(str((r.id, r.v, r.asDict().get("w"))) for r in spark.read.option("mergeSchema", True).parquet(f"{base}/out/clean").collect())
    assert run() == ("nothing", 0, 0, 0)
    folder.mkdir()
    (folder / "a 1.csv").write_text("id,v\n1, a\n2,b\n2,b\n,n\n")
    (folder / "bad.csv").write_text("id,v\n9,z\n9,z,z\n")
    assert run() == ("added", 2, 4, 3)
    assert run() == ("nothing", 0, 0, 0)
    was = (folder / "a 1.csv").read_text(), (folder / "a 1.csv").stat()
    (folder / "a 1.csv").write_text(was[0].replace("2,b", "2,x"))  # as large and as old: the next run must not read it
    os.utime(folder / "a 1.csv", ns=(was[1].st_atime_ns, was[1].st_mtime_ns))
    (folder / "b.csv").write_text("w,id,v\n,2,b\nq,2,b\n,3,c\n,,n\n,,m\n")
    assert run() == ("added", 1, 5, 3)
    (folder / "a 1.csv").write_text(was[0])
    os.utime(folder / "a 1.csv", ns=(was[1].st_atime_ns, was[1].st_mtime_ns))
    whole = sorted(str((r.id, r.v, r.w)) for r in U.clean([U.drop_bad_files(R.read_batches(spark, f"{base}/in")).drop("file")]).collect())
    assert table() == whole and len(whole) == 6
    (folder / "c.csv").write_text("")
    assert run() == ("nothing", 0, 0, 0)  # Spark doesn't list empty files
    (folder / "bad.csv").write_text("id,v\n9,z\n")
    assert run() == ("rebuilt", 3, 10, 7) and "('9', 'z', None)" in table()
    for name in ("a 1.csv", "b.csv", "bad.csv", "c.csv"):
        (folder / name).unlink()
    (folder / "d.csv").write_text("id\n")
    assert run()[0] == "rebuilt" and not (tmp_path / "out/clean").exists()
    assert run() == ("nothing", 0, 0, 0)


def test_pair_ledger_passthrough(spark, tmp_path):
    good, bad = P.split_bad(docs(spark, {"number": 1, "order_items": [{"id": 5}, {"id": 6}]}, "{bad"), "order_items")
    assert W.write_pair(P.order_headers(P.parse(good)), P.order_items(good), f"{tmp_path}/o", f"{tmp_path}/i", "orders", "order_items", shared=good) == (True, True)
    assert len(csv_lines(tmp_path / "i")) >= 3
    ledger = f"file://{tmp_path}/ledger"
    from quarry.operators.accounting import new_failures

    for _ in range(2):
        W.append_ledger(new_failures(bad.selectExpr("item_id AS id"), R.read_ledger(spark, ledger)), ledger)
    assert [r.id for r in R.read_ledger(spark, ledger).collect()] == ["1"]
    W.write_revision_failures(spark.createDataFrame([(7, 2)], "quote long, revision long"), f"file://{tmp_path}/rev")
    assert [r.id for r in R.read_ledger(spark, f"file://{tmp_path}/rev").collect()] == ["7-2"]
    users = P.parse(docs(spark, {"id": 1, "email": "e", "extra": {"a": [1, 2]}}, {"id": 2}))
    assert W.write_passthrough(users, f"{tmp_path}/users")
    back = spark.read.csv(f"{tmp_path}/users", header=True, escape='"').orderBy("id").collect()
    assert [(r.id, r.email, r.extra) for r in back] == [("1", "e", '{"a":[1,2]}'), ("2", None, None)]
    assert not W.write_passthrough(users.limit(0), f"{tmp_path}/nobody")


def test_relationships(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        "ID,ModelID,Name,IsActive,Type,CrossFilteringBehavior,JoinOnDateBehavior,RelyOnReferentialIntegrity,FromTableID,FromColumnID,FromCardinality,ToTableID,ToColumnID,ToCardinality,State,RelationshipStorageID,RelationshipStorage2ID,ModifiedTime,RefreshedTime,SecurityFilteringBehavior\n"
        '1,1,"a",True,1,1,2,False,15,414,2,21,422,1,1,13442,,t,t,1\n2,1,"b",False,1,1,1,False,15,414,2,21,422,1,1,13442,,t,t,1\n'
    )
    profile = M.relationship_profile(R.read_relationships(spark, f"file://{tmp_path}/r.csv"))
    assert sorted(map(tuple, profile.collect())) == [("date", True, 1), ("lookup", False, 1)]


def land(path, name, *rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(json.dumps({"seq": s, "token": SECRET, "body": json.dumps(b)}) + "\n" for s, b in rows))


def test_live_tables(spark, tmp_path):
    landed, root = tmp_path / "landed", f"file://{tmp_path}/live"
    quote = lambda status, kind="quote.created": {"type": kind, "data": QUOTE | {"status": status}}
    tables = LiveTables(spark, root, SECRET, publish_to=f"file://{tmp_path}/out")
    seen = []
    tables.register("test.event", lambda batch: seen.extend(r.seq for r in batch.collect()))
    tables.register("bad.event", lambda batch: 1 / 0)
    land(landed, "1.json", (1, quote("draft")), (3, quote("sent", "quote.status_changed")), (4, {"type": "test.event", "data": "test"}), (5, {"type": "bad.event"}), (6, {"type": "nothing"}))
    run = lambda: tables.start(R.read_events(spark, f"file://{landed}"), f"file://{tmp_path}/checkpoint", once=True).awaitTermination()
    run()
    status = lambda: [(r.quote_number, r.status, r.seq) for r in R.read_snapshot(spark, f"{root}/quotes_live").collect()]
    assert status() == [("7838", "sent", 3)] and seen == [4]
    land(landed, "2.json", (2, quote("late")), (7, {"type": "order.created", "data": {"order_number": "1", "status": "s"}}))
    run()
    assert status() == [("7838", "sent", 3)] and R.read_snapshot(spark, f"{root}/orders_live").count() == 1
    before = L.current_batch(spark, f"{root}/quotes_live")
    tables.write("quotes_live", R.read_snapshot(spark, f"{root}/quotes_live").withColumn("status", F.lit("again")), before)  # the same batch again
    assert status() == [("7838", "sent", 3)]
    assert sorted((r.seq, r.reason, r.error) for r in spark.read.parquet(f"{root}/dead").collect()) == [(5, "handler failed", "division by zero"), (6, "unsupported", None)]
    assert [tuple(r)[2] for r in L.read_published(spark, f"file://{tmp_path}/out/quotes_live").collect()] == ["sent"]


ROWS = "k string, seq bigint, v string"


def test_live_table_survives_a_stop_before_the_commit(spark, tmp_path, monkeypatch):
    path, keys = f"file://{tmp_path}/t", ["k"]
    rows = lambda seq, *ks: spark.createDataFrame([(k, seq, str(seq)) for k in ks], ROWS)
    current = lambda: sorted((r.k, r.v) for r in R.read_snapshot(spark, path).collect())
    assert R.read_snapshot(spark, path) is None and not L.fold(spark, path)
    assert L.append(rows(1, "a", "b", "c"), path, 1, keys)
    monkeypatch.setattr(L, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    for stopped in (lambda: L.append(rows(2, "a"), path, 2, keys), lambda: L.fold(spark, path)):
        with pytest.raises(KeyboardInterrupt):
            stopped()
    assert L.current_batch(spark, path) == 1 and current() == [("a", "1"), ("b", "1"), ("c", "1")]
    monkeypatch.undo()
    assert L.append(rows(3, "a"), path, 2, keys) and not L.append(rows(9, "a"), path, 2, keys)
    assert current() == [("a", "3"), ("b", "1"), ("c", "1")]
    with pytest.raises(OSError):
        L.commit(spark, path, 2, {})
    (tmp_path / "t/manifests/3.json").write_text('{"batch": 3')  # a writer that stopped halfway
    assert current()[0] == ("a", "3") and L.append(rows(4, "d"), path, 3, keys) and len(current()) == 4


def test_a_batch_writes_its_own_rows_and_folding_touches_its_buckets(spark, tmp_path):
    path, keys = f"file://{tmp_path}/t", ["k"]
    L.append(spark.range(2000).selectExpr("CAST(id AS string) AS k", "id AS seq", "'old' AS v"), path, 0, keys)
    assert L.fold(spark, path, bucket_rows=100)
    _, held = L.newest(spark, path)
    assert held["buckets"] == 20 and sum(n for _, n in held["rows"].values()) == 2000 and max(n for _, n in held["rows"].values()) < 400
    size = lambda folder: sum(p.stat().st_size for p in folder.rglob("*.parquet"))
    L.append(spark.createDataFrame([("7", 5000, "new"), ("7", 4000, "older"), ("8", 1, "late")], ROWS), path, 1, keys)
    assert size(tmp_path / "t/changes/batch=1") < size(tmp_path / "t/base/v=2") / 5
    found = {r.k: r.v for r in R.read_snapshot(spark, path).collect()}
    assert len(found) == 2000 and found["7"] == "new" and found["8"] == "old"
    L.fold(spark, path, bucket_rows=100)
    _, after = L.newest(spark, path)
    # three rows more than 2000 as counted before folding: one bucket is split, and the keys' own are written anew
    assert after["buckets"] == 21 and sum(v == 4 for v, _ in after["rows"].values()) <= 4 and after["changes"] == []
    assert {r.k: r.v for r in R.read_snapshot(spark, path).collect()} == found
    L.vacuum(spark, path, keep=1)
    assert {r.k: r.v for r in R.read_snapshot(spark, path).collect()} == found and [p.name for p in (tmp_path / "t/manifests").glob("[0-9]*")] == ["4.json"]


@pytest.mark.parametrize("buckets", [1, 2, 3, 5, 8, 13])
def test_linear_hashing_moves_rows_from_one_bucket_only(spark, buckets):
    rows = spark.range(500).selectExpr("CAST(id AS string) AS k").select(L.bucket_of(["k"], buckets).alias("a"), L.bucket_of(["k"], buckets + 1).alias("b")).distinct().collect()
    assert all(r.a < buckets and (r.a == r.b or (r.b == buckets and r.a == L.parent(buckets))) for r in rows)


def test_publication_writes_changed_buckets_only(spark, tmp_path):
    path, uri, keys = f"file://{tmp_path}/t", f"file://{tmp_path}/out", ["k"]
    assert L.publish_live(spark, path, uri, ["k", "v"]) == 0 and L.read_published(spark, uri) is None
    L.append(spark.range(1000).selectExpr("CAST(id AS string) AS k", "id AS seq", "'old' AS v"), path, 0, keys)
    L.fold(spark, path, bucket_rows=100)
    assert L.publish_live(spark, path, uri, ["k", "v"]) == 10 and L.publish_live(spark, path, uri, ["k", "v"]) == 0
    before = L.read_published(spark, uri)
    L.append(spark.createDataFrame([("7", 5000, "new")], ROWS), path, 1, keys)
    assert L.publish_live(spark, path, uri, ["k", "v"]) == 1
    found = {r.k: r.v for r in L.read_published(spark, uri).collect()}
    assert len(found) == 1000 and found["7"] == "new" and sum(v == "new" for v in found.values()) == 1
    assert {r.v for r in before.collect()} == {"old"}  # who reads the old one goes on reading it
    assert L.read_published(spark, uri).columns == ["k", "v"]


def test_consolidation_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a_1.csv").write_text("x,y\n1, a\n2,NA\n")
    (tmp_path / "in/a_2.csv").write_text("y,x\na,1\n")
    (tmp_path / "in/b_1.csv").write_text("x\n1\n")
    base = f"file://{tmp_path}"
    (tmp_path / "file").write_text("in the way")
    tables = [("a", f"{base}/in", "a_*.csv", f"{base}/a"), ("none", f"{base}/in", "c_*.csv", f"{base}/c"), ("no folder", f"{base}/no", "*", f"{base}/d"), ("broken", f"{base}/in", "b_*.csv", f"{base}/file/sub"), ("b", f"{base}/in", "b_*.csv", f"{base}/b")]
    done = {r.name: r.outcome for r in U.consolidate(spark, tables).collect()}
    assert done == {"a": "merged", "none": "skipped", "no folder": "skipped", "broken": "failed", "b": "merged"}
    assert sorted((r.x, r.y) for r in spark.read.csv(f"{base}/a", header=True).collect()) == sorted([("1", "a"), ("2", None)])


def test_latest_by_key(spark, tmp_path):
    source = tmp_path / "s"
    source.mkdir()
    (source / "1.json").write_text('{"k":"a","seq":2,"v":"new"}\n{"k":"a","seq":1,"v":"old"}\n{"k":"b","seq":1,"v":"x"}\n')
    query = latest_by_key(spark.readStream.schema("k string, seq long, v string").json(f"file://{source}"), ["k"]).writeStream.format("memory").queryName("latest").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.k, r.v) for r in spark.table("latest").collect()) == [("a", "new"), ("b", "x")]
