"""Registered queries of sources and sinks: each writes what Spark derives from the given tables, and returns what the reader finds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.schemas import COLUMNS, RELATIONSHIP
from quarry.operators import accounting as A
from quarry.operators import consolidate as U
from quarry.operators import events as E
from quarry.operators import flatten as P
from quarry.operators import model as M
from quarry.plans import reshape as S
from quarry.plans.queries import BATCHES, EVENTS, ORACLES, ORDERS_LIVE, PERSON, QUERIES, QUOTES_LIVE, people, register, w1_quote_snapshot, w2_order_snapshot
from quarry.plans.reshape import table
from quarry.sources import live_tables as L
from quarry.sources import readers as R
from quarry.sources import writers as W
from quarry.sources.scratch import new_path, staged
from quarry.streaming.latest import held_rows, latest_changes, with_store
from quarry.streaming.live import LiveTables

__all__ = ["ORACLES", "QUERIES"]


def written(spark: SparkSession, path: str) -> DataFrame:
    """A CSV table as strings."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


# Sources ------------------------------------------------------------------------------------------------------------


@register("s1_landed_documents", "SELECT o_orderkey AS item_id, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 3 AS VARCHAR) END AS revision, o_orderkey % 97 <> 5 AS parsed FROM orders")
def s1_landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "landed")
    W.land_documents(S.quote_documents(spark, sf_dir), path)
    return R.read_landed(spark, path).select("item_id", "revision", F.try_parse_json("body").isNotNull().alias("parsed"))


@register("s3_revision_index", "SELECT o_orderkey AS quote, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 4 END AS revision FROM orders")
def s3_revision_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "index")
    rows = table(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey DIV 10000 AS BIGINT) AS part", "o_orderkey AS quote", "CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 4 END AS revision")
    # a list of at most 10,000 revisions to a file
    lists = rows.groupBy("part").agg(F.to_json(F.collect_list(F.struct("quote", "revision"))).alias("value"))
    lists.write.partitionBy("part").text(path)
    return R.read_revision_index(spark, path)


@register("s7_snapshot", QUOTES_LIVE)
def s7_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches, the second folded with the first, so the result comes from buckets and from changes."""
    path, keys = new_path(spark, "snapshot"), ["quote_number", "revision_number"]
    rows = staged(w1_quote_snapshot(spark, sf_dir), "live")  # triaged once for all batches
    for batch in range(4):
        L.append(rows.filter(F.col("seq") % 4 <= batch), path, batch, keys)
        if batch == 1:
            L.fold(spark, path, bucket_rows=1000)
    return R.read_snapshot(spark, path)


@register("s9_relationships", "SELECT CASE WHEN p_size % 3 = 0 THEN 'date' ELSE 'lookup' END AS kind, p_size % 4 <> 1 AS active, count(*) AS n FROM part GROUP BY 1, 2")
def s9_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "relationships")
    set_here = {"ID": F.col("p_partkey"), "Name": F.col("p_name"), "IsActive": F.col("p_size") % 4 != 1, "JoinOnDateBehavior": F.when(F.col("p_size") % 3 == 0, 2).otherwise(1), "ToTableID": F.col("p_size")}
    names = [f.split()[0] for f in RELATIONSHIP.split(", ")]
    part = table(spark, sf_dir, "part")
    part.select(*(set_here.get(n, F.lit(1)).alias(n) for n in names)).write.csv(path, **W.CSV)
    return M.relationship_profile(R.read_relationships(spark, path))


# Sinks --------------------------------------------------------------------------------------------------------------

ORDER_HEADERS = ORACLES["p3_order_headers"]


@register("k1_order_table", ORDER_HEADERS)
def k1_order_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "orders")
    W.write_table(P.order_headers(P.parse(S.order_documents(spark, sf_dir))), path, "orders")
    return written(spark, path)


@register("k2_order_pair", "SELECT CAST(o_orderkey AS VARCHAR) AS order_number, count(l_orderkey) AS items FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def k2_order_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "pair")
    # what is shared holds the results of both parses, and neither the text nor the whole document
    good = P.parse(P.split_bad(S.order_documents(spark, sf_dir), "order_items")[0]).select("number", "items", *P.order_fields(F.col("doc")))
    W.write_pair(good, P.order_items(good), f"{root}/orders", f"{root}/items", "orders", "order_items", shared=good)
    items = written(spark, f"{root}/items").groupBy("order_number").agg(F.count("*").alias("items"))
    return written(spark, f"{root}/orders").select("order_number").join(items, "order_number", "left").fillna(0, ["items"])


@register("k3_batches", "SELECT CASE WHEN o_orderkey BETWEEN 1 AND 1000 THEN '1_1000' WHEN o_orderkey % 2 = 0 THEN 'all' ELSE 'revised' END AS batch, count(*) AS n, CASE WHEN o_orderkey BETWEEN 1 AND 1000 THEN 2 ELSE 1 END AS written FROM orders GROUP BY ALL")
def k3_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All batches by one job, then one of them again; written is by how many jobs, told by the names of the files that are there before and after."""
    path = f"{new_path(spark, 'batches')}/orders"
    docs = S.order_documents(spark, sf_dir)
    heads = P.order_headers(P.parse(docs))
    number = F.col("order_number").cast("bigint")
    W.write_batches(heads.withColumn("number", number).withColumn("batch", W.batch_column("number", [(1, 1000)], number % 2 != 0)), path, "orders")
    files = lambda: written(spark, path).select("batch", F.col("_metadata.file_name").alias("file"))
    first = staged(files().distinct(), "names")
    again = P.order_headers(P.parse(P.scan_range(docs, "item_id", 1, 1000)))
    W.write_batches(again.withColumn("batch", F.lit(W.batch_name(1, 1000))), path, "orders")
    counts = files().groupBy("batch").agg(F.count("*").alias("n"), F.min("file").alias("file"))
    kept = F.when(F.col("old").isNull(), 2).otherwise(1).alias("written")
    return counts.join(first.select("batch", F.col("file").alias("old")), (counts["batch"] == first["batch"]) & (F.col("file") == F.col("old")), "left").select(counts["batch"], "n", kept)


@register("k4_published_orders", ORDERS_LIVE.replace("SELECT * EXCLUDE (k) FROM", "SELECT * EXCLUDE (k, seq) FROM"))
def k4_published_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published after each of three batches: the changed buckets only."""
    path, uri = new_path(spark, "orders_live"), new_path(spark, "published")
    rows = staged(w2_order_snapshot(spark, sf_dir), "live")
    for batch in range(3):
        L.append(rows.filter(F.col("seq") % 3 == batch), path, batch, ["order_number"])
        if batch < 2:
            L.fold(spark, path, bucket_rows=500)
        L.publish_live(spark, path, uri, COLUMNS["orders_live"])
    return L.read_published(spark, uri)


@register("k6_s8_failure_ledger", "SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderkey % 97 = 5 OR o_orderkey % 11 = 2")
def k6_failure_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "ledger")
    failed = staged(P.split_bad(S.quote_documents(spark, sf_dir), "quote_items")[1].selectExpr("item_id AS id"), "failed")
    for run in (failed.filter("id % 2 = 0"), failed):  # the second run finds half of its ids there
        W.append_ledger(A.new_failures(run, R.read_ledger(spark, path)), path)
    return R.read_ledger(spark, path)


@register("k7_revision_ledger", "SELECT o_orderkey || '-' || o_orderkey % 3 AS id FROM orders WHERE o_orderkey % 3 <> 0 AND (o_orderkey % 97 = 5 OR o_orderkey % 11 = 2)")
def k7_revision_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "ledger")
    failed = P.split_bad(S.quote_documents(spark, sf_dir).filter("revision IS NOT NULL"), "quote_items")[1]
    failed = staged(failed.select("item_id", "revision"), "failed")
    for run in (failed.filter("item_id % 2 = 0"), failed):  # the second takes the place of the first
        W.write_revision_failures(run, path, "item_id", "revision")
    return R.read_ledger(spark, path)


@register(
    "k8_passthrough",
    PERSON + "SELECT CAST(c_nationkey AS VARCHAR) AS account_id, email, first AS first_name, CAST(k AS VARCHAR) AS id, nullif(last, '') AS last_name, c_name AS name, nullif(role, 'Unknown role') AS role, 'customer' AS type FROM p",
)
def k8_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "people")
    W.write_passthrough(people(spark, sf_dir), path)
    return written(spark, path)


# Consolidation ------------------------------------------------------------------------------------------------------


def landed_batches(spark: SparkSession, sf_dir: str) -> str:
    """Batches of customers as CSV files with headers of their own, and two files with a row too long for its header."""
    root = new_path(spark, "batches")
    for i, batch in enumerate(S.customer_batches(spark, sf_dir)):
        W.write_table(batch, f"{root}/batch={i + 1}")
    bad = table(spark, sf_dir, "nation").selectExpr("concat('id,name\n', n_nationkey, ',', n_name, '\n', n_nationkey, ',', n_name, ',too long') AS value", "'bad' AS batch")
    bad.repartition(2).write.mode("append").partitionBy("batch").text(root)
    return root


@register("s5_u5_k5_merged_batches", BATCHES + "SELECT id, name, nullif(segment, '') AS segment, nation FROM (SELECT DISTINCT id, name, segment, nation FROM raw)")
def s5_merged_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, target = landed_batches(spark, sf_dir), new_path(spark, "clean")
    rows = U.drop_bad_files(R.read_batches(spark, root, "*")).drop("file")
    W.write_clean(U.clean([rows]), target)
    return written(spark, target)


@register("u5_bad_files", "SELECT 2 AS bad_files, (SELECT count(*) FROM nation) AS bad_rows")
def u5_bad_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.read_batches(spark, landed_batches(spark, sf_dir), "*").filter("_corrupt_record IS NOT NULL")
    return rows.agg(F.count_distinct("file").cast("int").alias("bad_files"), F.count("*").alias("bad_rows"))


@register("u6_validated", "SELECT r_regionkey, r_name FROM region")
def u6_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.validate_columns(table(spark, sf_dir, "region"), ["r_name", "r_regionkey"])


@register(
    "u7_consolidated",
    BATCHES + "SELECT 'customers' AS name, 'merged' AS outcome, (SELECT count(*) FROM (SELECT DISTINCT id, name, segment, nation FROM raw)) AS n UNION ALL SELECT 'orders', 'skipped', NULL UNION ALL SELECT 'nations', 'merged', (SELECT count(*) FROM nation)",
)
def u7_consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, out = landed_batches(spark, sf_dir), new_path(spark, "clean")
    W.write_table(table(spark, sf_dir, "nation"), f"{root}-nations/batch=all")
    done = U.consolidate(spark, [("customers", root, "*", f"{out}/customers"), ("orders", root, "orders_*.csv", f"{out}/orders"), ("nations", f"{root}-nations", "*", f"{out}/nations")])
    sizes = [written(spark, f"{out}/{t}").agg(F.lit(t).alias("name"), F.count("*").alias("n")) for t in ("customers", "nations")]
    return done.select("name", "outcome").join(sizes[0].unionByName(sizes[1]), "name", "left")


@register("u7_incremental", BATCHES + "SELECT DISTINCT id, name, nullif(segment, '') AS segment, nation FROM raw")
def u7_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that land one after another, each run reading the files of the last one only."""
    folder, root = new_path(spark, "batches"), new_path(spark, "clean")
    for i, batch in enumerate(S.customer_batches(spark, sf_dir)):
        W.write_table(batch, f"{folder}/batch={i + 1}")
        U.consolidate_new(spark, folder, "*", root, "id", blank_as_null=True)
    return spark.read.option("mergeSchema", True).parquet(f"{root}/clean")


# Streams ------------------------------------------------------------------------------------------------------------


@register(
    "w4_handlers",
    EVENTS
    + """SELECT seq, kind FROM (SELECT i AS seq, 'handled' AS kind FROM f WHERE t = 'view' AND reason = 'unsupported'
      UNION ALL SELECT i, 'failed' FROM f WHERE t = 'signup' AND reason IN ('ok', 'data is no object')
      UNION ALL SELECT max(seq), 'live' FROM lo JOIN events ON event_id = seq WHERE event_type <> 'signup' GROUP BY order_number)""",
)
def w4_handlers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A handler of its own for one type, one that fails for another, and the default for the rest."""
    root = new_path(spark, "live")
    S.event_rows(spark, sf_dir).write.json(f"{root}/landed")
    tables = LiveTables(spark, f"{root}/tables", S.SECRET)
    tables.register("page.viewed", lambda batch: batch.select("seq").write.mode("append").parquet(f"{root}/viewed"))
    tables.register("order.status_changed", lambda batch: batch.select(F.raise_error(F.lit("refused"))).write.format("noop").mode("overwrite").save())
    tables.start(R.read_events(spark, f"{root}/landed"), f"{root}/checkpoint", once=True).awaitTermination()
    handled = spark.read.parquet(f"{root}/viewed").select("seq", F.lit("handled").alias("kind"))
    failed = spark.read.parquet(f"{root}/tables/dead").filter("reason = 'handler failed'").select("seq", F.lit("failed").alias("kind"))
    return handled.unionByName(failed).unionByName(R.read_snapshot(spark, f"{root}/tables/orders_live").select("seq", F.lit("live").alias("kind")))


@register("w6_latest_by_key", "SELECT user_id, event_id AS seq, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k = 1")
def w6_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in no order, two to a batch, each batch putting out its changes only; what the state holds in the end is the result."""
    root, session = new_path(spark, "latest"), with_store(spark)
    schema = "user_id bigint, seq bigint, event_type string"
    table(spark, sf_dir, "events").selectExpr("user_id", "event_id AS seq", "event_type").repartition(4).write.json(f"{root}/landed")
    stream = session.readStream.schema(schema).option("maxFilesPerTrigger", 2).json(f"{root}/landed")
    put = lambda batch, _: batch.write.mode("append").parquet(f"{root}/changes")
    latest_changes(stream, ["user_id"]).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return held_rows(spark, f"{root}/checkpoint")
