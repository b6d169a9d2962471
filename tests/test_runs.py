"""Ranged runs, counts taken on the way, batches and slices."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quarry.functions import columns as C
from quarry.operators import accounting as A
from quarry.operators import consolidate as U
from quarry.operators import flatten as P
from quarry.operators.runs import Registry, parsed_documents
from quarry.sources import writers as W
from quarry.sources.readers import read_ledger

DOCS = "item_id bigint, revision string, body string"
QUOTE = '{"number": %d, "status": "sent", "quote_items": [{"id": 1, "components": [{"is_root_component": true, "quantities": [{"quantity": 1}, {"quantity": 2}]}]}, {"id": 2}]}'


def read(spark, path):
    return spark.read.csv(path, header=True, multiLine=True, escape='"')


def test_run_writes_pairs_ledger_and_counts(spark, tmp_path):
    docs = spark.createDataFrame([(1, None, QUOTE % 1), (2, None, "{bad"), (3, None, QUOTE % 3), (4, None, None), (9, None, QUOTE % 9)], DOCS)
    for _ in range(2):
        found = Registry().run(spark, {"quotes": docs}, str(tmp_path), 1, 5).first()
    assert tuple(found) == ("quotes", "done", 2, 2, 6, None)
    assert sorted(r.quote_number for r in read(spark, f"{tmp_path}/quotes").collect()) == ["1", "3"]
    assert read(spark, f"{tmp_path}/quote_items").filter("batch = '1_5'").count() == 6
    assert sorted(r.id for r in read_ledger(spark, f"{tmp_path}/ledger/quotes").collect()) == ["2", "4"]


def test_run_reads_and_parses_the_documents_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    docs = spark.createDataFrame([(i, None, QUOTE % i) for i in range(20)], DOCS).mapInPandas(count, DOCS)
    Registry().run(spark, {"quotes": docs}, str(tmp_path))
    assert seen.value == 20


def test_one_entity_fails_the_others_go_on(spark, tmp_path):
    docs = spark.createDataFrame([(1, None, QUOTE % 1)], DOCS)
    registry = Registry()
    registry.register("own", lambda d: d.select(F.col("item_id").alias("n")))
    registry.register("broken", lambda d: d.select("no_such_column"))
    registry.register("refusing", lambda d: d.select(F.raise_error(F.lit("refused")).alias("x")))
    found = {r.entity: r for r in registry.run(spark, {"broken": docs, "unknown": docs, "refusing": docs, "own": docs, "quotes": docs}, str(tmp_path)).collect()}
    assert {n: r.outcome for n, r in found.items()} == {"broken": "failed", "unknown": "failed", "refusing": "failed", "own": "done", "quotes": "done"}
    assert found["broken"].error and found["unknown"].processed is None and found["own"].child_rows == 0
    assert [r.n for r in read(spark, f"{tmp_path}/own").collect()] == ["1"]


def test_a_registered_transform_replaces_that_of_the_contract(spark, tmp_path):
    registry = Registry()
    registry.register("quotes", lambda d: P.quote_headers(d).withColumn("status", F.upper("status")))
    registry.run(spark, {"quotes": spark.createDataFrame([(1, None, QUOTE % 1)], DOCS)}, str(tmp_path))
    assert read(spark, f"{tmp_path}/quotes").first().status == "SENT" and read(spark, f"{tmp_path}/quote_items").count() == 3


def test_empty_range_and_empty_documents(spark, tmp_path):
    none = spark.createDataFrame([], DOCS)
    assert tuple(Registry().run(spark, {"quotes": none}, f"{tmp_path}/a").first())[1:5] == ("done", 0, 0, 0)
    assert Registry().run(spark, {"quotes": none}, f"{tmp_path}/b", 5, 1).first().outcome == "failed"


def test_write_table_keeps_the_old_one_if_there_are_no_rows(spark, tmp_path):
    rows = spark.range(3)
    assert W.write_table(rows, f"{tmp_path}/t") and not W.write_table(rows.filter("id > 5"), f"{tmp_path}/t")
    assert read(spark, f"{tmp_path}/t").count() == 3 and sorted(p.name for p in tmp_path.iterdir()) == ["t"]
    assert W.write_table(rows.filter("id > 1"), f"{tmp_path}/t") and [r.id for r in read(spark, f"{tmp_path}/t").collect()] == ["2"]


def test_batches_by_one_job_leave_others_alone(spark, tmp_path):
    rows = spark.range(20).withColumn("batch", W.batch_column("id", [(0, 4), (5, 9)], F.col("id") % 2 == 0))
    W.write_batches(rows, f"{tmp_path}/t")
    before = {p.name: p.stat().st_mtime_ns for p in tmp_path.glob("t/batch=all/*.csv")}
    assert sorted(p.name for p in (tmp_path / "t").glob("batch=*")) == ["batch=0_4", "batch=5_9", "batch=all", "batch=revised"]
    W.write_batches(rows.filter("id = 7"), f"{tmp_path}/t")
    assert {p.name: p.stat().st_mtime_ns for p in tmp_path.glob("t/batch=all/*.csv")} == before
    assert {r.batch: r["count"] for r in read(spark, f"{tmp_path}/t").groupBy("batch").count().collect()} == {"0_4": 5, "5_9": 1, "all": 5, "revised": 5}


@pytest.mark.parametrize(("first", "last"), [(0, 0), (3, 17), (95, 200), (100, 120), (0, 99), (7, 3)])
def test_slices_by_ranges(spark, first, last):
    rows = spark.range(100).selectExpr("id * 7 % 100 AS k", "CAST(id AS string) AS v")
    assert sorted(r.k for r in A.slice_rows(rows, ["k"], first, last).collect()) == list(range(100))[first : last + 1]


def test_slice_has_no_single_task_exchange(spark):
    assert "SinglePartition" not in A.slice_rows(spark.range(100), ["id"], 20, 30)._jdf.queryExecution().executedPlan().toString()


def test_merge_counts_in_one_pass(spark, tmp_path):
    a, b = spark.createDataFrame([("1", " x"), ("1", "x")], "id string, v string"), spark.createDataFrame([("2",)], "id string")
    assert tuple(U.merge([a, b], f"{tmp_path}/m").first()) == (3, 2) and read(spark, f"{tmp_path}/m").count() == 2
    assert tuple(U.merge([a.limit(0)], f"{tmp_path}/n").first()) == (0, 0)


def test_what_is_held_has_no_copies(spark):
    """Header queries take no typed items along; runs don't hold the text beside the parsed document."""
    docs = spark.createDataFrame([(1, None, QUOTE % 1), (2, None, "{bad"), (3, None, '{"number": 3, "quote_items": ["x"]}')], DOCS)
    good, bad = P.split_bad(docs, "quote_items", items=False)
    assert good.columns == bad.columns == ["item_id", "revision", "body"]
    assert [r.item_id for r in good.collect()] == [1] and sorted(r.item_id for r in bad.collect()) == [2, 3]
    assert parsed_documents(docs, "quote_items").columns == ["item_id", "revision", "doc", "items", "bad", "number"]


def test_documents_wait_in_the_shared_folder_and_not_in_memory(spark, tmp_path):
    plans, before = {}, set(shared_files(spark))
    docs = spark.createDataFrame([(1, QUOTE % 1), (2, "{bad")], "item_id bigint, body string").withColumn("revision", F.lit(None))  # a column without a type, too

    def noted(name, transform):
        def run(rows):
            plans[name] = transform(rows)._jdf.queryExecution().optimizedPlan().toString()
            return transform(rows)

        return run

    registry = Registry()
    registry.register("quotes", noted("parents", lambda d: P.quote_headers(d).filter("status = 'sent'")), children=noted("children", P.quote_items))
    registry.register("orders", lambda d: d.select(F.raise_error(F.lit("refused")).alias("x")), children=P.quote_items, field="quote_items")
    assert [tuple(r)[1:5] for r in registry.run(spark, {"quotes": docs, "orders": docs}, str(tmp_path)).collect()] == [("done", 1, 1, 3), ("failed", None, None, None)]
    assert not [n for n, p in plans.items() if "InMemoryRelation" in p] and spark.sparkContext._jsc.sc().getPersistentRDDs().isEmpty()
    assert plans["parents"].count("parseJson") == 1 and "parseJson" not in plans["children"]
    assert set(shared_files(spark)) == before


def shared_files(spark):
    return [p for p in Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")).iterdir() if p.name.startswith("run-")]


def test_header_fields_by_one_cast_equal_those_path_by_path(spark):
    bodies = ['{"number": 1.50, "status": {"a": [1, null]}, "expired": "true", "contact": {"first_name": 2, "account": "x"}, "estimator": "uuid", "salesperson": {"email": [1]}}', "[1]", "null", "{bad", '{"contact": [{"email": "a"}], "Status": "s", "expired": "maybe"}', '{"contact": {"email": null, "account": {"name": false}}, "due_date": 1e300, "priority": ""}']
    docs = P.parse(spark.createDataFrame([(i, "7", b) for i, b in enumerate(bodies)], DOCS))
    heads = P.quote_headers(docs, "payload")
    paths = {"quote_number": "number", "customer_name": "contact.account.name", "contact_email": "contact.email", "estimator_email": "estimator.email", "salesperson_email": "salesperson.email"}
    plain = [C.safe_get(F.col("doc"), *paths.get(n, n).split("."), kind=t).alias(n) for n, t in heads.dtypes if n != "contact_name"]
    assert heads.drop("contact_name").collect() == docs.select(plain).collect()
    assert heads._jdf.queryExecution().optimizedPlan().toString().count("variant_get") == 1
