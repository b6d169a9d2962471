"""Golden rows for documents, cleaning, accounting, events and the model."""

import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from quarry.functions import columns as C
from quarry.functions.schemas import COLUMNS
from quarry.operators import accounting as A
from quarry.operators import consolidate as U
from quarry.operators import events as E
from quarry.operators import flatten as P
from quarry.operators import model as M
from quarry.plans import queries as Q
from quarry.plans import reshape as S
from quarry.sources import readers as RD
from quarry.sources import writers as W

SECRET = "test-secret"
ROOT = {"is_root_component": True, "part_number": "P1", "part_uuid": "u", "description": "d", "revision": "B", "type": "t", "material": {"name": "steel"}, "process": {"name": "mill"}}


def docs(spark, *bodies, revision=None):
    return spark.createDataFrame([(i, revision, b if isinstance(b, str) or b is None else json.dumps(b)) for i, b in enumerate(bodies)], "item_id long, revision string, body string")


def parsed(spark, *bodies, revision=None):
    return P.parse(docs(spark, *bodies, revision=revision))


# Columns and headers ------------------------------------------------------------------------------------------------


def test_safe_access_and_names(spark):
    rows = parsed(spark, {"contact": {"first_name": "A", "last_name": "B", "account": {"name": "X"}}, "estimator": {"email": "e"}}, {"contact": None, "estimator": "uuid"}, {"contact": "text"}, {}, "{bad", None)
    found = P.quote_headers(rows).select("contact_name", "customer_name", "estimator_email").collect()
    assert [tuple(r) for r in found] == [("A B", "X", "e"), *[(" ", None, None)] * 5]


@pytest.mark.parametrize(("value", "expected"), [("0", True), ("  ", True), ("", False), (0, False), (0.0, False), (1, True), (None, False), (False, False), (True, True), ([], False), ({}, False), ([0], True)])
def test_truthiness(spark, value, expected):
    assert parsed(spark, {"v": value}).select(C.truthy(F.col("doc"), "v")).first()[0] is expected


def test_truthiness_of_absent(spark):
    assert parsed(spark, {}).select(C.truthy(F.col("doc"), "v")).first()[0] is False


def test_quote_key(spark):
    rows = parsed(spark, {"quote_number": "", "number": 7838}, {"quote_number": "Q1", "number": 2}, {"number": None}, {})
    assert [r[0] for r in rows.select(C.quote_key(F.col("doc"))).collect()] == ["7838", "Q1", None, None]


def test_stripped_and_missing_cells(spark):
    rows = spark.createDataFrame([("\t a　",), ("NA",), ("  ",), (None,), ("n/a",), ("",)], "c string")
    assert [r.c for r in U.trim_all(U.na_to_null(rows)).collect()] == ["a", None, "", None, None, None]


def test_hmac(spark):
    bodies = ["", "x", "é" * 100]
    for secret in ("s", "k" * 100):
        got = [r[0] for r in spark.createDataFrame([(b,) for b in bodies], "body string").select(C.hmac_sha256(F.col("body"), secret)).collect()]
        assert got == [hmac.new(secret.encode(), b.encode(), hashlib.sha256).hexdigest() for b in bodies]


# Items --------------------------------------------------------------------------------------------------------------


def test_quote_items(spark):
    breaks = [{"quantity": 1, "unit_price": 2.5, "total_price": "0.000", "lead_time": 3}, {"quantity": "5"}]
    other = ROOT | {"part_number": "P2"}
    items = [{"id": 1, "components": [{"is_root_component": False}, ROOT | {"quantities": breaks}, other]}, {"id": 2, "components": []}, {"id": 3}, {"id": "x", "components": [ROOT | {"quantities": []}]}]
    good, bad = P.split_bad(docs(spark, {"number": 7, "quote_items": items}, revision="2"), "quote_items")
    rows = P.quote_items(good)
    assert rows.columns == COLUMNS["quote_items"] and bad.count() == 0
    got = [(r.quote_number, r.quote_revision, r.item_id, r.part_number, r.is_fully_configured, r.quantity, r.lead_time) for r in rows.orderBy("item_id", "quantity").collect()]
    assert got == [("7", "2", "1", "P1", True, 1, 3), ("7", "2", "1", "P1", True, 5, None), ("7", "2", "2", "", False, None, None), ("7", "2", "3", "", False, None, None), ("7", "2", "x", "P1", True, None, None)]
    assert float(rows.filter("quantity = 1").first().total_price) == 0.0
    assert P.quote_items(good, keep_unpriced=False).count() == 2


def test_bad_documents_and_unlisted_items(spark):
    rows = docs(spark, {"quote_items": {}}, {"quote_items": ["uuid"]}, "{bad", "[1]", None, {"quote_items": [{"id": 1}, "x"]}, {"quote_items": []}, {}, {"quote_items": None}, {"quote_items": [None]})
    good, bad = P.split_bad(rows, "quote_items")
    assert sorted(r.item_id for r in bad.collect()) == [1, 2, 3, 4, 5, 9] and sorted(r.item_id for r in good.collect()) == [0, 6, 7, 8]
    assert P.quote_items(good).count() == 0 and P.quote_headers(P.parse(good)).count() == 4
    assert [r.item_id for r in P.unusable_items(P.parse(rows), "quote_items").collect()] == [0, 8]


def test_order_items(spark):
    order = {"number": 5, "order_items": [{"id": 1, "description": "own", "quantity": 2, "unit_price": 1, "components": [ROOT]}, {"id": 2}], "payment_details": {"payment_terms": "net"}, "shipping_info": {"business_name": "Z"}}
    good, _ = P.split_bad(docs(spark, order), "order_items")
    rows = P.order_items(good).orderBy("item_id").collect()
    assert [(r.order_number, r.description, r.part_number, r.material, r.quantity) for r in rows] == [("5", "own", "P1", "steel", 2), ("5", None, "", "", None)]
    head = P.order_headers(parsed(spark, order)).first()
    assert (head.payment_terms, head.customer_name, head.purchase_order_number) == ("net", "Z", None)
    assert [r.order_number for r in A.childless(P.order_headers(P.parse(docs(spark, order, {"number": 6}))), P.order_items(good), "order_number").collect()] == ["6"]


def test_revised_headers_and_union(spark):
    regular, revised = P.quote_headers(parsed(spark, {"number": 1})), P.revised_quote_headers(parsed(spark, {"number": 1}, revision="3"))
    assert revised.columns == COLUMNS["quotes_revised"] and revised.first().quote_id == "1-3"
    assert P.all_quotes(regular, revised).count() == 2 and P.all_quotes(regular, revised, include_revisions=False).count() == 1


def test_pages_and_users(spark):
    pages = spark.createDataFrame([(1, '{"results":[{"id":1},{"name":"x"}],"next":"u"}'), (2, '[{"id":2}]'), (3, '{"results":null}'), (4, "[]"), (5, "{bad")], "page long, body string")
    assert [(r.page, r.id) for r in P.flatten_pages(pages, id_only=True).orderBy("page").collect()] == [(1, "1"), (2, "2")]
    assert [(r.page, r.n, r.so_far) for r in A.page_stats(P.flatten_pages(pages)).orderBy("page").collect()] == [(1, 2, 2), (2, 1, 3)]
    users = P.user_summary(parsed(spark, {"first_name": "A", "last_name": "B", "email": "e", "role": "r"}, {"first_name": "A"}, {}))
    assert [tuple(r) for r in users.collect()] == [("A B", "e", "r"), ("A", "No email", "Unknown role"), ("", "No email", "Unknown role")]


def test_ranges(spark):
    ids = spark.range(10)
    assert P.scan_range(ids, "id", 2, 4).count() == 3 and P.scan_range(ids, "id", None, 4).count() == 5
    for args in ((5, 4), (None, 4)):
        with pytest.raises(ValueError):
            P.scan_range(ids, "id", *args, both=True)
    index = spark.createDataFrame([(1, 0), (2, None), (3, 2)], "quote long, revision long")
    assert [r.quote for r in P.only_revised(index).collect()] == [3]


# Consolidation and accounting ---------------------------------------------------------------------------------------


def test_clean_is_idempotent(spark):
    a = spark.createDataFrame([("1", " x "), ("1", "x"), (None, "NA")], "a string, b string")
    b = spark.createDataFrame([("x", "1", "z")], "b string, a string, c string")
    once = U.clean([a, b])
    assert sorted(map(tuple, once.collect()), key=str) == sorted([("1", "x", None), ("1", "x", "z"), (None, None, None)], key=str)
    assert U.clean([once]).exceptAll(once).count() == 0
    assert tuple(U.merge_stats(U.union_batches([a, b]), once).first()) == (4, 3)
    blank = spark.createDataFrame([("",), (None,)], "a string")
    assert U.dedup_rows(blank).count() == 2 and U.dedup_rows(blank, blank_as_null=True).count() == 1
    with pytest.raises(ValueError):
        U.validate_columns(a, ["a"])
    assert U.validate_columns(a, ["b", "a"]) is a


def test_dedup_keys(spark):
    rows = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), (None, 1, "n")], "k string, batch int, v string")
    assert sorted((r.k, r.v) for r in U.dedup_keys(rows, ["k"], [F.col("batch")]).collect() if r.k) == [("k", "new")]


def test_ledger_and_attempts(spark):
    fresh = A.new_failures(spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "id string"), spark.createDataFrame([(" 1 ",)], "id string"))
    assert [r.id for r in fresh.collect()] == ["2"]
    log = spark.createDataFrame([(1, 1, 200), (2, 1, 500), (2, 2, 404), (3, 1, 500), (3, 2, 429), (3, 3, 500), (3, 4, 200), (4, 1, 429)], "item_id long, attempt int, http_status int")
    assert sorted(map(tuple, A.classify_attempts(log).collect())) == [(1, "ok", 1), (2, "not_found", 2), (3, "exhausted", 3), (4, "exhausted", 1)]


def test_progress_slices_gaps(spark):
    ids = spark.range(45).repartition(7)
    assert [tuple(r) for r in A.batch_progress(ids, 20).orderBy("batch").collect()] == [(1, 3, 20, 44.4), (2, 3, 40, 88.9), (3, 3, 45, 100.0)]
    assert [r.id for r in A.slice_rows(ids, ["id"], 3, 5).collect()] == [3, 4, 5]
    assert sorted(r.id for r in A.missing_ids(ids.filter("id % 2 = 0"), "id", 40, 46).collect()) == [41, 43, 45, 46]
    assert [(r.id, r.row) for r in A.preview(ids, ["id"], 2).collect()] == [(0, 1), (1, 2)]
    assert tuple(A.run_summary(ids, ids.limit(2), ids.limit(0)).first()) == (45, 2, 0)


# Events -------------------------------------------------------------------------------------------------------------


def event(seq, body, token=SECRET, signature=None):
    return seq, token, signature, body if isinstance(body, str) or body is None else json.dumps(body)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), "seq long, token string, signature string, body string")


QUOTE = {"number": 7838, "revision_number": 3, "status": "draft", "contact": {"first_name": "A", "last_name": None}, "quote_items": ["uuid"], "estimator": "uuid"}


def test_triage(spark):
    signed = json.dumps({"type": "order.created", "data": {"order_number": "1", "status": "s"}})
    good = hmac.new(SECRET.encode(), signed.encode(), hashlib.sha256).hexdigest()
    rows = events(
        spark, event(1, signed, None, good), event(2, signed, None, "bad"), event(3, ""), event(4, "{bad"), event(5, "{}"), event(6, [1]), event(7, {"data": {}}), event(8, {"type": "unsupported.event"}),
        event(9, {"type": "quote.created", "data": None}), event(10, {"type": "quote.created", "data": QUOTE}), event(11, {"type": "quote.created", "data": QUOTE | {"revision_number": 0}}), event(12, {"type": "test.event", "data": "test"}),
        event(13, {"type": "order.created"}), event(14, None), event(15, {"type": ""}), event(16, {"type": "quote.created", "data": QUOTE | {"number": None}}),
    )
    got = {r.seq: (r.status, r.reason, r.applied) for r in E.triage(rows, SECRET, ("test.event",)).collect()}
    assert got == {
        1: (200, "ok", True), 2: (401, "unauthorized", False), 3: (400, "empty body", False), 4: (500, "malformed", False), 5: (400, "empty document", False), 6: (500, "not an object", False), 7: (400, "missing type", False),
        8: (400, "unsupported", False), 9: (500, "data is no object", False), 10: (200, "ok", True), 11: (200, "ok", False), 12: (200, "ok", True), 13: (200, "ok", False), 14: (400, "empty body", False), 15: (400, "missing type", False), 16: (200, "ok", False),
    }


def test_upsert(spark):
    as_rows = lambda *rows: E.live_quotes(E.route(E.triage(events(spark, *rows), SECRET))["quotes"])
    old = as_rows(event(1, {"type": "quote.created", "data": QUOTE}), event(2, {"type": "quote.created", "data": QUOTE | {"number": 1}}))
    new = as_rows(event(5, {"type": "quote.status_changed", "data": QUOTE | {"revision_number": "3", "status": "sent"}}), event(4, {"type": "quote.status_changed", "data": QUOTE | {"status": "late"}}))
    keys = ["quote_number", "revision_number"]
    once = E.upsert(old, new, keys)
    assert sorted((r.quote_number, r.status, r.contact_name, r.seq) for r in once.collect()) == [("1", "draft", "A ", 2), ("7838", "sent", "A ", 5)]
    assert E.upsert(once, new, keys).exceptAll(once).count() == 0 and E.upsert(once, old, keys).exceptAll(once).count() == 0
    flat = events(spark, event(1, {"type": "order.created", "data": {"order_number": "9", "status": "s", "contact_name": "Jo", "customer_name": "C"}}))
    orders = E.route(E.triage(flat, SECRET))["orders"]
    assert [(r.contact_name, r.customer_name) for r in E.live_orders(orders).collect()] == [(" ", None)]
    assert [(r.contact_name, r.customer_name) for r in E.live_orders(orders, flat_fallback=True).collect()] == [("Jo", "C")]


# The model ----------------------------------------------------------------------------------------------------------


def test_model_joins(spark):
    fact = spark.createDataFrame([(1, 10, "2024-01-31 23:59:59"), (2, 99, "2024-03-01 00:00:00"), (3, None, None)], "id long, ref long, at string").withColumn("at", F.col("at").cast("timestamp"))
    dim = spark.createDataFrame([(10, "ten"), (11, "eleven")], "key long, name string")
    assert sorted((r.id, r.name) for r in M.lookup(fact, dim, {"ref": "key"}).collect()) == [(1, "ten"), (2, None), (3, None)]
    assert [r.id for r in M.orphans(fact, dim, {"ref": "key"}).collect()] == [2]
    assert [(r.id, r.month) for r in M.calendar_join(fact, "at").orderBy("id").collect()] == [(1, 1), (2, 3), (3, None)]
    assert [tuple(r) for r in M.duplicate_keys(dim.unionAll(dim.limit(1)), ["key"]).collect()] == [(10, 2)]


def test_unusable_items_parse_once(spark):
    rows = spark.createDataFrame([(1, '{"quote_items": {}}'), (2, '{"quote_items": []}'), (3, "{}")], "item_id int, body string")
    found = P.unusable_items(P.parse(rows), "quote_items").select("item_id")
    assert [r.item_id for r in found.collect()] == [1]
    assert found._jdf.queryExecution().optimizedPlan().toString().lower().replace("_", "").count("parsejson") == 1


@pytest.mark.parametrize("documents", [S.order_documents, S.quote_documents])
def test_lines_go_to_their_order_before_they_are_gathered(spark, documents):
    plan = documents(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [b for a, b in zip(plan, plan[1:]) if "Exchange hashpartitioning(l_orderkey" in a or "Exchange hashpartitioning(l_partkey" in a]
    assert below and not any("Aggregate" in b for b in below)


@pytest.mark.parametrize("name", ["l1_new_failures", "l10_childless_orders"])
def test_documents_of_two_branches_are_parsed_before(spark, name):
    assert "from_json" not in Q.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()


def test_landed_documents_are_compressed(spark, tmp_path):
    W.land_documents(spark.createDataFrame([(1, None, "{}")], "item_id bigint, revision string, body string"), f"{tmp_path}/landed")
    assert list((tmp_path / "landed").glob("part-*.json.gz")) and RD.read_landed(spark, f"{tmp_path}/landed").collect() == [(1, None, "{}")]
