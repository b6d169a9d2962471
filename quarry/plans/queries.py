
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import columns as C
from quarry.operators import accounting as A
from quarry.operators import consolidate as U
from quarry.operators import events as E
from quarry.operators import flatten as P
from quarry.operators import model as M
from quarry.plans import reshape as R
from quarry.operators.runs import Registry
from quarry.plans.reshape import table
from quarry.sources.readers import read_ledger, read_snapshot
from quarry.sources.scratch import new_path, staged
from quarry.streaming.arrivals import read_arrivals
from quarry.streaming.live import LiveTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results compare by value."""
    return df.select(*(F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes))


def register(name: str, sql: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name], ORACLES[name] = lambda spark, sf_dir: plain(query(spark, sf_dir)), sql
        return query

    return add


# Orders -------------------------------------------------------------------------------------------------------------

ORDER_ITEMS = """
SELECT CAST(l_orderkey AS VARCHAR) AS order_number, CAST(l_linenumber AS VARCHAR) AS item_id,
  CASE WHEN l_linenumber % 4 <> 0 THEN 'P' || l_partkey ELSE '' END AS part_number, CASE WHEN l_linenumber % 4 <> 0 THEN 'u' || l_partkey ELSE '' END AS part_uuid,
  CASE WHEN l_linenumber % 4 <> 0 THEN 'A' ELSE '' END AS revision, 'line ' || l_linenumber AS description, CAST(l_quantity AS BIGINT) AS quantity,
  CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS DOUBLE) AS unit_price, CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS DOUBLE) AS total_price,
  CASE WHEN l_linenumber % 4 <> 0 THEN l_returnflag ELSE '' END AS material, CASE WHEN l_linenumber % 4 <> 0 THEN l_linestatus ELSE '' END AS process,
  l_returnflag = 'R' AS export_controlled, CASE WHEN l_linestatus <> 'F' THEN l_linestatus || '.pdf' END AS filename, CAST(l_linenumber AS BIGINT) AS lead_days, CAST(l_suppkey AS VARCHAR) AS quote_item_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def good_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.split_bad(R.order_documents(spark, sf_dir), "order_items")[0]


@register("n8_order_items", ORDER_ITEMS)
def n8_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.order_items(good_orders(spark, sf_dir))


@register(
    "p3_order_headers",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS order_number, CAST(o_custkey AS VARCHAR) AS quote_number, CAST(o_orderkey % 3 AS VARCHAR) AS quote_revision_number, o_orderstatus AS status,
  strftime(o_orderdate, '%Y-%m-%d') AS created, CAST(NULL AS VARCHAR) AS deliver_by, CAST(NULL AS VARCHAR) AS ships_on, o_orderpriority AS payment_terms, CAST(NULL AS VARCHAR) AS purchase_order_number,
  CASE WHEN o_orderkey % 5 <> 0 THEN 's' || o_custkey END AS salesperson_email, CAST(NULL AS VARCHAR) AS customer_name FROM orders
""",
)
def p3_order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.order_headers(P.parse(R.order_documents(spark, sf_dir)))


@register("n2_root_components", "SELECT part_number, count(*) AS n FROM (" + ORDER_ITEMS + ") GROUP BY part_number")
def n2_root_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.order_items(good_orders(spark, sf_dir)).groupBy("part_number").agg(F.count("*").alias("n"))


@register("l10_childless_orders", "SELECT CAST(o_orderkey AS VARCHAR) AS order_number FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def l10_childless_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = staged(good_orders(spark, sf_dir).select("number", "items"), "orders")  # parsed once for both sides
    return A.childless(good.select(F.col("number").alias("order_number")), P.order_items(good), "order_number")


# Quotes -------------------------------------------------------------------------------------------------------------

QUOTE_BASE = """
WITH q AS (SELECT o.*, c_name, c_mktsegment, o_orderkey % 97 = 5 AS malformed, o_orderkey % 97 <> 5 AND o_orderkey % 11 = 2 AS strings,
  o_orderkey % 97 <> 5 AND o_orderkey % 11 = 1 AS unlisted, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 3 AS VARCHAR) END AS rev
  FROM orders o LEFT JOIN customer ON o_custkey = c_custkey),
h AS (SELECT CAST(o_orderkey AS VARCHAR) AS quote_number, rev AS revision_number, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS created,
  CAST(NULL AS VARCHAR) AS due_date, CAST(NULL AS VARCHAR) AS sent_date, CAST(NULL AS VARCHAR) AS expired_date, o_orderkey % 2 = 0 AS expired, CAST(NULL AS VARCHAR) AS rfq_number, o_orderpriority AS priority,
  CAST(NULL AS VARCHAR) AS private_notes, CAST(NULL AS VARCHAR) AS authenticated_pdf_quote_url,
  CASE WHEN o_custkey % 7 <> 0 THEN coalesce(c_name, '') || ' ' || CASE WHEN o_custkey % 4 <> 0 THEN coalesce(c_mktsegment, '') ELSE '' END ELSE ' ' END AS contact_name,
  CASE WHEN o_custkey % 7 <> 0 THEN 'c' || o_custkey END AS contact_email, CASE WHEN o_custkey % 7 <> 0 THEN c_name END AS customer_name,
  CASE WHEN o_orderkey % 2 = 0 THEN 'e@x' END AS estimator_email, CAST(NULL AS VARCHAR) AS salesperson_email, o_orderkey % 4 AS payload FROM q WHERE NOT malformed AND NOT strings),
i AS (SELECT CAST(l_orderkey AS VARCHAR) AS quote_number, rev AS quote_revision, CAST(l_partkey AS VARCHAR) AS item_id, 'active' AS workflow_status,
  CASE WHEN l_partkey % 5 <> 0 THEN coalesce(p_brand, '') ELSE '' END AS part_number, '' AS revision, CASE WHEN l_partkey % 5 <> 0 THEN coalesce(p_name, '') ELSE '' END AS description,
  CASE WHEN l_partkey % 5 <> 0 THEN coalesce(p_type, '') ELSE '' END AS type, CASE WHEN l_partkey % 5 <> 0 AND l_partkey % 3 <> 0 THEN 'steel' ELSE '' END AS material,
  CASE WHEN l_partkey % 5 <> 0 THEN 'mill' ELSE '' END AS process, CASE WHEN l_partkey % 5 <> 0 THEN 'u' || l_partkey ELSE '' END AS part_uuid, CAST(NULL AS BOOLEAN) AS export_controlled,
  l_partkey % 5 <> 0 AND l_partkey % 2 = 0 AS priced, l_quantity, l_extendedprice, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_partkey) AS n
  FROM lineitem JOIN q ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey WHERE NOT malformed AND NOT strings AND NOT unlisted),
items AS (SELECT quote_number, quote_revision, item_id, workflow_status, part_number, revision, description, type, material, process,
  part_number <> '' AND description <> '' AND material <> '' AND process <> '' AS is_fully_configured, part_uuid, export_controlled,
  CASE WHEN priced THEN CAST(l_quantity AS BIGINT) END AS quantity, CASE WHEN priced THEN CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS DOUBLE) END AS unit_price,
  CASE WHEN priced THEN CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS DOUBLE) END AS total_price, CAST(NULL AS DOUBLE) AS total_price_with_add_ons, CASE WHEN priced THEN CAST(l_linenumber AS BIGINT) END AS lead_time
  FROM i WHERE priced OR n = 1)
"""
HEAD = "h.* EXCLUDE (payload)"


def good_quotes(spark: SparkSession, sf_dir: str, where: str = "true", items: bool = True) -> DataFrame:
    """where goes before the parse: Spark moves no filter below the generator that keeps good rows."""
    return P.split_bad(R.quote_documents(spark, sf_dir).filter(where), "quote_items", items)[0]


@register("p1_quote_headers", QUOTE_BASE + f"SELECT {HEAD} FROM h WHERE revision_number IS NULL")
def p1_quote_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.quote_headers(P.parse(good_quotes(spark, sf_dir, "revision IS NULL", items=False)))


@register("p2_revised_quote_headers", QUOTE_BASE + f"SELECT quote_number || '-' || revision_number AS quote_id, {HEAD} FROM h WHERE revision_number IS NOT NULL")
def p2_revised_quote_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.revised_quote_headers(P.parse(good_quotes(spark, sf_dir, "revision IS NOT NULL", items=False)))


@register("p9_payload_revision", QUOTE_BASE + f"SELECT {HEAD} REPLACE (CAST(payload AS VARCHAR) AS revision_number) FROM h")
def p9_payload_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.quote_headers(P.parse(good_quotes(spark, sf_dir, items=False)), revision_from="payload")


@register("n5_quote_items", QUOTE_BASE + "SELECT * FROM items WHERE quote_revision IS NULL")
def n5_quote_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.quote_items(good_quotes(spark, sf_dir, "revision IS NULL"))


@register("n6_priced_quote_items", QUOTE_BASE + "SELECT * FROM items WHERE quantity IS NOT NULL")
def n6_priced_quote_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.quote_items(good_quotes(spark, sf_dir), keep_unpriced=False)


@register("n7_revised_quote_items", QUOTE_BASE + "SELECT * FROM items WHERE quote_revision IS NOT NULL")
def n7_revised_quote_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.quote_items(good_quotes(spark, sf_dir, "revision IS NOT NULL"))


@register("f7_unusable_items", QUOTE_BASE + "SELECT o_orderkey AS item_id FROM q WHERE unlisted")
def f7_unusable_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.unusable_items(P.parse(R.quote_documents(spark, sf_dir)), "quote_items").select("item_id")


@register("f8_bad_documents", QUOTE_BASE + "SELECT o_orderkey AS item_id FROM q WHERE malformed OR strings")
def f8_bad_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.split_bad(R.quote_documents(spark, sf_dir), "quote_items")[1].select("item_id")


@register("f9_fully_configured", QUOTE_BASE + "SELECT is_fully_configured, count(*) AS n FROM items GROUP BY is_fully_configured")
def f9_fully_configured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.quote_items(good_quotes(spark, sf_dir)).groupBy("is_fully_configured").agg(F.count("*").alias("n"))


@register("u1_all_quotes", QUOTE_BASE + f"SELECT {HEAD} FROM h")
def u1_all_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    regular, revised = (P.parse(good_quotes(spark, sf_dir, where, items=False)) for where in ("revision IS NULL", "revision IS NOT NULL"))
    return P.all_quotes(P.quote_headers(regular), P.revised_quote_headers(revised))


@register("l6_run_summary", QUOTE_BASE + "SELECT (SELECT count(*) FROM h) AS processed, (SELECT count(*) FROM q WHERE malformed OR strings) AS failed, (SELECT count(*) FROM items) AS child_rows")
def l6_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Registry().run(spark, {"quotes": R.quote_documents(spark, sf_dir)}, new_path(spark, "run")).select("processed", "failed", "child_rows")


@register(
    "e1_ranged_run",
    QUOTE_BASE
    + """SELECT 'quotes' AS entity, 'done' AS outcome, (SELECT count(*) FROM h WHERE CAST(quote_number AS BIGINT) BETWEEN 50 AND 5000) AS processed,
      (SELECT count(*) FROM q WHERE (malformed OR strings) AND o_orderkey BETWEEN 50 AND 5000) AS failed, (SELECT count(*) FROM items WHERE CAST(quote_number AS BIGINT) BETWEEN 50 AND 5000) AS child_rows,
      (SELECT count(*) FROM q WHERE (malformed OR strings) AND o_orderkey BETWEEN 50 AND 5000) AS listed
    UNION ALL SELECT 'orders', 'done', (SELECT count(*) FROM orders WHERE o_orderkey BETWEEN 50 AND 5000), 0, (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey BETWEEN 50 AND 5000), 0
    UNION ALL SELECT 'contacts', 'done', (SELECT count(*) FROM customer WHERE c_custkey BETWEEN 50 AND 5000 AND c_custkey % 4 > 1), 0, 0, 0
    UNION ALL SELECT 'accounts', 'failed', NULL, NULL, NULL, 0""",
)
def e1_ranged_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two entities of the contract, one with a transform of its own, and one whose transform fails; run twice, so the ledgers' second halves are found there."""
    registry, root = Registry(), new_path(spark, "run")
    registry.register("contacts", lambda docs: P.flat_fields(docs, "contacts").filter("email IS NOT NULL"))
    registry.register("accounts", lambda docs: P.flat_fields(docs, "accounts").withColumn("url", F.raise_error(F.lit("refused"))))
    people = R.customer_documents(spark, sf_dir).withColumn("revision", F.lit(None).cast("string"))
    docs = {"quotes": R.quote_documents(spark, sf_dir), "orders": R.order_documents(spark, sf_dir), "contacts": people, "accounts": people}
    for _ in range(2):
        done = registry.run(spark, docs, root, 50, 5000)
    listed = [read_ledger(spark, f"{root}/ledger/{name}").agg(F.lit(name).alias("entity"), F.count("*").alias("listed")) for name in docs]
    return done.drop("error").join(U.union_batches(listed), "entity")


@register("l1_new_failures", QUOTE_BASE + "SELECT CAST(o_orderkey AS VARCHAR) AS id FROM q WHERE (malformed OR strings) AND o_orderkey % 2 = 1")
def l1_new_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = P.split_bad(R.quote_documents(spark, sf_dir), "quote_items")[1].selectExpr("item_id AS id")
    bad = staged(bad, "failed")
    known = table(spark, sf_dir, "orders").filter("o_orderkey % 2 = 0").selectExpr("concat(' ', o_orderkey) AS id")
    return A.new_failures(bad.unionAll(bad), known)


# Contacts, accounts, users, pages -----------------------------------------------------------------------------------

PERSON = """
WITH p AS (SELECT c_custkey AS k, c_name, ' ' || c_mktsegment AS first, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'n' || c_nationkey END AS last,
  CASE WHEN c_custkey % 4 > 1 THEN 'c' || c_custkey || '@x' END AS email, c_custkey % 4 = 0 AS no_email, CASE WHEN c_custkey % 5 <> 0 THEN 'buyer' ELSE 'Unknown role' END AS role, c_nationkey FROM customer)
"""


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.parse(R.customer_documents(spark, sf_dir))


@register("p4_contacts", PERSON + "SELECT CAST(k AS VARCHAR) AS id, first AS first_name, last AS last_name, email, CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS phone_ext, CAST(NULL AS VARCHAR) AS notes, CAST(c_nationkey AS VARCHAR) AS account_id FROM p")
def p4_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.flat_fields(people(spark, sf_dir), "contacts")


@register("p5_accounts", PERSON + "SELECT c_name AS name, CAST(k AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS erp_code, 'customer' AS type, CAST(NULL AS VARCHAR) AS url FROM p")
def p5_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.flat_fields(people(spark, sf_dir), "accounts")


@register("p6_user_summary", PERSON + "SELECT trim(first || ' ' || coalesce(last, '')) AS name, CASE WHEN no_email THEN 'No email' ELSE email END AS email, role FROM p")
def p6_user_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.user_summary(people(spark, sf_dir))


@register("p10_full_names", PERSON + "SELECT k AS id, first || ' ' || coalesce(last, '') AS full_name FROM p")
def p10_full_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc")
    return people(spark, sf_dir).select(F.col("item_id").alias("id"), C.full_name(C.safe_get(doc, "first_name"), C.safe_get(doc, "last_name")).alias("full_name"))


@register("s2_page_documents", "SELECT c_custkey // 100 AS page, CAST(row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY c_custkey) - 1 AS INTEGER) AS position, c_name AS name FROM customer")
def s2_page_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.flatten_pages(R.customer_pages(spark, sf_dir))
    return rows.select("page", "position", C.safe_get(F.col("doc"), "name").alias("name"))


@register("s2_page_ids", "SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_custkey % 10 <> 9")
def s2_page_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.flatten_pages(R.customer_pages(spark, sf_dir), id_only=True).select("id")


@register("l9_page_stats", "SELECT page, n, CAST(sum(n) OVER (ORDER BY page) AS BIGINT) AS so_far FROM (SELECT c_custkey // 100 AS page, count(*) AS n FROM customer GROUP BY 1)")
def l9_page_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.page_stats(P.flatten_pages(R.customer_pages(spark, sf_dir)))


@register("s4_range_scan", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey BETWEEN 100 AND (SELECT max(o_orderkey) // 2 FROM orders)")
def s4_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return P.scan_range(orders, "o_orderkey", 100, orders.agg(F.max("o_orderkey")).first()[0] // 2).select("o_orderkey", "o_orderstatus")


@register("f1_only_revised", "SELECT o_orderkey AS quote, o_orderkey % 4 AS revision FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 6 <> 0")
def f1_only_revised(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS quote", "CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 4 END AS revision")
    return P.only_revised(index)


# Consolidation ------------------------------------------------------------------------------------------------------

BATCHES = r"""
WITH raw AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS segment, CAST(NULL AS VARCHAR) AS nation, 1 AS batch FROM customer WHERE c_custkey % 3 <> 0
  UNION ALL BY NAME SELECT c_name AS name, CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS segment, 2 AS batch FROM customer WHERE c_custkey % 3 <> 1
  UNION ALL BY NAME SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation, 3 AS batch FROM customer WHERE c_custkey % 4 = 0)
"""


@register("u2_union_batches", "SELECT id, name, count(*) AS n, count(nation) AS nations FROM (" + BATCHES + "SELECT * FROM raw) GROUP BY id, name")
def u2_union_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.union_batches(R.customer_batches(spark, sf_dir)).groupBy("id", "name").agg(F.count("*").alias("n"), F.count("nation").alias("nations"))


@register("u3_u4_u8_consolidated", BATCHES + "SELECT DISTINCT id, name, segment, nation FROM raw")
def u3_consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.clean(R.customer_batches(spark, sf_dir))


@register("u3_blank_as_null", BATCHES + "SELECT DISTINCT id, name, nullif(segment, '') AS segment, nation FROM raw")
def u3_blank_as_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.clean(R.customer_batches(spark, sf_dir), blank_as_null=True)


@register("l8_merge_stats", BATCHES + "SELECT (SELECT count(*) FROM raw) AS rows_in, (SELECT count(*) FROM (SELECT DISTINCT id, name, segment, nation FROM raw)) AS rows_out")
def l8_merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = R.customer_batches(spark, sf_dir)
    return U.merge(batches, new_path(spark, "clean"))


@register("u9_dedup_keys", BATCHES + "SELECT id, name, segment, nation, CAST(batch AS INTEGER) AS batch FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY batch DESC) AS k FROM raw) WHERE k = 1")
def u9_dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = [U.trim_all(U.na_to_null(b)).withColumn("batch", F.lit(i + 1)) for i, b in enumerate(R.customer_batches(spark, sf_dir))]
    return U.dedup_keys(U.union_batches(batches), ["id"], [F.col("batch")]).select("id", "name", "segment", "nation", "batch")


# Accounting ---------------------------------------------------------------------------------------------------------


@register(
    "l2_attempts",
    """
WITH a AS (SELECT user_id * 1000 + event_id % 97 AS item_id, row_number() OVER (PARTITION BY user_id * 1000 + event_id % 97 ORDER BY event_id) AS attempt,
  CASE event_type WHEN 'click' THEN 200 WHEN 'view' THEN 404 WHEN 'error' THEN 500 ELSE 429 END AS s FROM events),
b AS (SELECT item_id, max(attempt) AS last, min(CASE WHEN s IN (200, 404) THEN attempt END) AS d FROM a WHERE attempt <= 3 GROUP BY item_id)
SELECT b.item_id, CASE a.s WHEN 200 THEN 'ok' WHEN 404 THEN 'not_found' ELSE 'exhausted' END AS outcome, coalesce(b.d, b.last) AS attempts FROM b LEFT JOIN a ON a.item_id = b.item_id AND a.attempt = b.d
""",
)
def l2_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.classify_attempts(R.attempt_log(spark, sf_dir))


@register(
    "l3_batch_progress",
    """
WITH r AS (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 20 + 1 AS batch FROM orders), b AS (SELECT batch, count(*) AS n FROM r GROUP BY batch)
SELECT batch, count(*) OVER () AS total_batches, CAST(sum(n) OVER (ORDER BY batch) AS BIGINT) AS processed, round(sum(n) OVER (ORDER BY batch) * 100.0 / sum(n) OVER (), 1) AS percent FROM b
""",
)
def l3_batch_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.batch_progress(table(spark, sf_dir, "orders"), 20)


@register("l4_slice", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 51 OFFSET 50")
def l4_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.slice_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 50, 100)


@register("l5_missing_ids", "SELECT range AS event_id FROM range(0, (SELECT max(event_id) + 1 FROM events)) WHERE range NOT IN (SELECT event_id FROM events WHERE event_type = 'click')")
def l5_missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return A.missing_ids(events.filter("event_type = 'click'"), "event_id", 0, events.agg(F.max("event_id")).first()[0])


@register("l7_preview", "SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS row FROM (SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 5)")
def l7_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.preview(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_custkey"], 5)


# Events -------------------------------------------------------------------------------------------------------------

EVENTS = """
WITH e AS (SELECT event_id AS i, user_id AS u, event_type AS t, ts, event_id % 31 = 0 AS empty,
  CASE WHEN event_id % 31 = 0 THEN 'empty body' WHEN event_id % 37 = 0 THEN 'malformed' WHEN event_id % 41 = 0 THEN 'empty document' WHEN event_id % 43 = 0 THEN 'not an object'
    WHEN event_id % 47 = 0 THEN 'missing type' WHEN event_type = 'view' THEN 'unsupported' WHEN event_id % 29 = 0 THEN 'data is no object' ELSE 'ok' END AS r FROM events),
f AS (SELECT *, CASE WHEN i % 5 = 0 OR (i % 5 IN (2, 4) AND NOT empty) THEN r ELSE 'unauthorized' END AS reason FROM e),
g AS (SELECT *, t IN ('click', 'error') AS quote, CASE reason WHEN 'ok' THEN 200 WHEN 'unauthorized' THEN 401 WHEN 'malformed' THEN 500 WHEN 'not an object' THEN 500 WHEN 'data is no object' THEN 500 ELSE 400 END AS status,
  reason = 'ok' AND i % 13 <> 0 AND (t NOT IN ('click', 'error') OR i % 2 = 1 OR i % 5 <> 0) AS applied FROM f),
lq AS (SELECT i AS seq, CAST(u AS VARCHAR) AS quote_number, CAST(i % 5 AS VARCHAR) AS revision_number, 's' || (i % 4) AS status, strftime(ts, '%Y-%m-%d') AS created, CAST(NULL AS VARCHAR) AS due_date, CAST(NULL AS VARCHAR) AS rfq_number,
  CAST(NULL AS VARCHAR) AS priority, CAST(NULL AS VARCHAR) AS private_notes, 'f' || u || ' ' AS contact_name, CAST(NULL AS VARCHAR) AS contact_email, CAST(NULL AS VARCHAR) AS customer_name, CAST(NULL AS VARCHAR) AS estimator_email, CAST(NULL AS VARCHAR) AS salesperson_email
  FROM g WHERE applied AND quote),
lo AS (SELECT i AS seq, CAST(u AS VARCHAR) AS order_number, 's' || (i % 4) AS status, strftime(ts, '%Y-%m-%d') AS created, CAST(NULL AS VARCHAR) AS due_date, CAST(i % 100 AS VARCHAR) AS quote_number, CAST(NULL AS VARCHAR) AS quote_revision,
  CAST(NULL AS VARCHAR) AS customer_name, 'f' || u || ' ' AS contact_name, CAST(NULL AS VARCHAR) AS contact_email, CAST(NULL AS VARCHAR) AS salesperson_email FROM g WHERE applied AND NOT quote)
"""
QUOTES_LIVE = EVENTS + "SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY quote_number, revision_number ORDER BY seq DESC) AS k FROM lq) WHERE k = 1"
ORDERS_LIVE = EVENTS + "SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY order_number ORDER BY seq DESC) AS k FROM lo) WHERE k = 1"


def triaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.triage(R.event_rows(spark, sf_dir), R.SECRET)


@register("f5_authenticated", EVENTS + "SELECT i AS seq FROM f WHERE reason <> 'unauthorized'")
def f5_authenticated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.authenticated(R.event_rows(spark, sf_dir), R.SECRET).select("seq")


@register("f6_triage", EVENTS + "SELECT i AS seq, CAST(status AS INTEGER) AS status, reason, applied FROM g")
def f6_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triaged(spark, sf_dir).select("seq", "status", "reason", "applied")


@register("f4_supported", EVENTS + "SELECT i AS seq FROM e WHERE r IN ('ok', 'data is no object')")
def f4_supported(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.event_rows(spark, sf_dir).withColumn("type", C.safe_get(F.try_parse_json("body"), "type"))
    return E.supported_events(rows).select("seq")


@register("f2_f3_incomplete", EVENTS + "SELECT i AS seq FROM g WHERE reason = 'ok' AND NOT applied")
def f2_f3_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triaged(spark, sf_dir).filter("reason = 'ok' AND NOT applied").select("seq")


@register("p7_live_quotes", EVENTS + "SELECT * FROM lq")
def p7_live_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.live_quotes(E.route(triaged(spark, sf_dir))["quotes"])


@register("p8_live_orders", EVENTS + "SELECT * FROM lo")
def p8_live_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.live_orders(E.route(triaged(spark, sf_dir))["orders"])


@register("p11_quote_keys", EVENTS + "SELECT i AS seq, CAST(u AS VARCHAR) AS quote_key FROM g WHERE reason = 'ok' AND quote")
def p11_quote_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = triaged(spark, sf_dir).filter(F.col("type").isin(*E.QUOTE_EVENTS)).filter("reason = 'ok'")
    return rows.select("seq", C.quote_key(F.try_variant_get("doc", "$.data", "variant")).alias("quote_key"))


@register("w1_quote_snapshot", QUOTES_LIVE)
def w1_quote_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = E.live_quotes(E.route(triaged(spark, sf_dir))["quotes"])
    early, late = rows.filter("seq % 2 = 1"), rows.filter("seq % 2 = 0")  # batches may come in any order
    return E.upsert(E.upsert(None, early, ["quote_number", "revision_number"]), late, ["quote_number", "revision_number"])


@register("w2_order_snapshot", ORDERS_LIVE)
def w2_order_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = E.live_orders(E.route(triaged(spark, sf_dir))["orders"])
    return E.upsert(None, rows, ["order_number"])


@register("w3_dead_letters", EVENTS + "SELECT CAST(status AS INTEGER) AS status, reason, count(*) AS n FROM g WHERE NOT applied GROUP BY status, reason")
def w3_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.route(triaged(spark, sf_dir))["dead"].groupBy("status", "reason").agg(F.count("*").alias("n"))


@register("w5_export_order", EVENTS + "SELECT order_number, CAST(row_number() OVER (ORDER BY seq) AS BIGINT) AS place FROM (SELECT order_number, max(seq) AS seq FROM lo GROUP BY order_number)")
def w5_export_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = w2_order_snapshot(spark, sf_dir).select("order_number", "seq")
    return A.numbered(live, ["seq"]).select("order_number", (F.col("index") + 1).alias("place"))


@register("s6_stream_quotes", QUOTES_LIVE.replace("SELECT * EXCLUDE (k) FROM", "SELECT * EXCLUDE (k, seq) FROM"))
def s6_stream_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events land without a seq, in files whose names follow their order; the source gives each its seq."""
    root = new_path(spark, "live")
    R.event_rows(spark, sf_dir).repartitionByRange("seq").sortWithinPartitions("seq").drop("seq").write.json(f"{root}/landed")
    tables = LiveTables(spark, f"{root}/tables", R.SECRET)
    events = read_arrivals(spark, f"{root}/landed", f"{root}/log", order="name", files="3")
    tables.start(events, f"{root}/checkpoint", once=True).awaitTermination()
    return read_snapshot(spark, f"{root}/tables/quotes_live").drop("seq")


# The model ----------------------------------------------------------------------------------------------------------


@register("m1_lookup", "SELECT o_orderkey, o_custkey, c_name, c_nationkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def m1_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.lookup(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), {"o_custkey": "c_custkey"})


@register("m2_calendar_join", "SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, count(*) AS orders FROM orders GROUP BY 1, 2")
def m2_calendar_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.calendar_join(table(spark, sf_dir, "orders").select("o_orderdate"), "o_orderdate").groupBy("year", "quarter").agg(F.count("*").alias("orders"))


@register("m3_second_date", "SELECT year(l_shipdate) AS year, month(l_shipdate) AS month, count(*) AS lines FROM lineitem GROUP BY 1, 2")
def m3_second_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.calendar_join(table(spark, sf_dir, "lineitem").select("l_shipdate"), "l_shipdate").groupBy("year", "month").agg(F.count("*").alias("lines"))


@register("m3_second_key", "SELECT s_suppkey, s_name, r_name FROM supplier LEFT JOIN region ON s_nationkey = r_regionkey")
def m3_second_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.lookup(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey"), table(spark, sf_dir, "region").select("r_regionkey", "r_name"), {"s_nationkey": "r_regionkey"}).drop("s_nationkey")


@register("m4_orphans", "SELECT s_suppkey FROM supplier WHERE s_nationkey NOT IN (SELECT r_regionkey FROM region)")
def m4_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.orphans(table(spark, sf_dir, "supplier"), table(spark, sf_dir, "region"), {"s_nationkey": "r_regionkey"}).select("s_suppkey")


@register("m5_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def m5_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
