"""The driver's tables reshaped into the documents, pages, events, batches and logs that the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SECRET = "test-secret"
PRICE = "decimal(18,4)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_order(lines: DataFrame) -> DataFrame:
    """Lines dealt by order before they are gathered: Spark would gather a few lines per task first and send the lists, which are wider and not fewer."""
    return lines.repartition("l_orderkey")


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, revision, body: orders with their lines as items. Of a line's two components the second is the root; lines whose number is a multiple of four have no components.

    A line's own columns go to its order, once and unpacked; items are made of them there.
    """
    component = lambda x, flag, part: F.struct(F.lit(flag).alias("is_root_component"), part.alias("part_number"), F.concat(F.lit("u"), x["l_partkey"]).alias("part_uuid"), F.lit("A").alias("revision"), F.struct(x["l_returnflag"].alias("name")).alias("material"), F.struct(x["l_linestatus"].alias("name")).alias("process"))

    def item(x: Column) -> Column:
        part, price = F.concat(F.lit("P"), x["l_partkey"]), x["l_extendedprice"].cast(PRICE)
        components = F.when(x["l_linenumber"] % 4 != 0, F.array(component(x, False, F.lit("other")), component(x, True, part)))
        return F.struct(
            x["l_linenumber"].alias("id"), F.concat(F.lit("line "), x["l_linenumber"]).alias("description"), x["l_quantity"].cast("bigint").alias("quantity"),
            price.alias("unit_price"), price.alias("total_price"), (x["l_returnflag"] == "R").alias("export_controlled"),
            F.nullif(F.concat(x["l_linestatus"], F.lit(".pdf")), F.lit("F.pdf")).alias("filename"), x["l_linenumber"].alias("lead_days"), x["l_suppkey"].alias("quote_item_id"), components.alias("components"),
        )

    own = "l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_returnflag l_linestatus".split()
    lines = by_order(table(spark, sf_dir, "lineitem").select("l_orderkey", *own)).groupBy("l_orderkey").agg(F.collect_list(F.struct(*own)).alias("lines"))
    lines = lines.select("l_orderkey", F.transform("lines", item).alias("items"))
    o = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    doc = F.struct(
        F.col("o_orderkey").alias("number"), F.col("o_custkey").alias("quote_number"), (F.col("o_orderkey") % 3).alias("quote_revision_number"), F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("created"),
        F.struct(F.col("o_orderpriority").alias("payment_terms")).alias("payment_details"), F.when(F.col("o_orderkey") % 5 != 0, F.struct(F.concat(F.lit("s"), F.col("o_custkey")).alias("email"))).alias("salesperson"), F.col("items").alias("order_items"),
    )
    return o.select(F.col("o_orderkey").alias("item_id"), F.lit(None).cast("string").alias("revision"), F.to_json(doc).alias("body"))


def quote_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, revision, body: orders as quotes, their parts as items and lines as price breaks. Every third has a revision; item fields are lists, objects, lists of strings or absent; a few bodies are malformed."""
    line = F.struct(F.col("l_quantity").cast("bigint").alias("quantity"), F.col("l_extendedprice").cast(PRICE).alias("unit_price"), F.col("l_extendedprice").cast(PRICE).alias("total_price"), F.col("l_linenumber").alias("lead_time"))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_linenumber").join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
    # the lines of an order stand in one task, so neither grouping moves them again
    parts = by_order(lines.drop("p_partkey")).groupBy("l_orderkey", "l_partkey", "p_name", "p_brand", "p_type").agg(F.collect_list(line).alias("lines"))
    root = F.struct(
        (F.col("l_partkey") % 5 != 0).alias("is_root_component"), F.col("p_brand").alias("part_number"), F.concat(F.lit("u"), F.col("l_partkey")).alias("part_uuid"), F.col("p_name").alias("description"), F.col("p_type").alias("type"),
        F.when(F.col("l_partkey") % 3 != 0, F.struct(F.lit("steel").alias("name"))).alias("material"), F.struct(F.lit("mill").alias("name")).alias("process"), F.when(F.col("l_partkey") % 2 == 0, F.col("lines")).alias("quantities"),
    )
    item = F.struct(F.col("l_partkey").alias("id"), F.lit("active").alias("workflow_status"), F.array(root).alias("components"))
    items = parts.groupBy("l_orderkey").agg(F.collect_list(item).alias("items"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    o = table(spark, sf_dir, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    contact = F.when(F.col("o_custkey") % 7 != 0, F.struct(F.col("c_name").alias("first_name"), F.when(F.col("o_custkey") % 4 != 0, F.col("c_mktsegment")).alias("last_name"), F.concat(F.lit("c"), F.col("o_custkey")).alias("email"), F.struct(F.col("c_name").alias("name")).alias("account")))
    head = F.to_json(F.struct(F.col("o_orderkey").alias("number"), F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("created"), (F.col("o_orderkey") % 2 == 0).alias("expired"), F.col("o_orderpriority").alias("priority"), (F.col("o_orderkey") % 4).alias("revision_number"), contact.alias("contact")))
    listed = F.when(F.col("items").isNotNull(), F.to_json("items"))
    field = F.when(F.col("o_orderkey") % 11 == 1, F.lit("{}")).when(F.col("o_orderkey") % 11 == 2, F.lit('["uuid"]')).otherwise(listed)
    estimator = F.when(F.col("o_orderkey") % 2 == 0, F.lit('{"email":"e@x"}')).otherwise(F.lit('"uuid"'))
    body = F.concat(F.expr("substring(h, 1, length(h) - 1)"), F.lit(',"estimator":'), estimator, F.coalesce(F.concat(F.lit(',"quote_items":'), F.col("f")), F.lit("")), F.lit("}"))
    rows = o.withColumn("h", head).withColumn("f", field)
    return rows.select(F.col("o_orderkey").alias("item_id"), F.when(F.col("o_orderkey") % 3 != 0, (F.col("o_orderkey") % 3).cast("string")).alias("revision"), F.when(F.col("o_orderkey") % 97 == 5, F.lit("{bad")).otherwise(body).alias("body"))


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, body: customers with the fields of contacts, accounts and users; some absent, some null."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    fields = [
        F.concat(F.lit('{"id":'), key), F.concat(F.lit(',"name":"'), F.col("c_name"), F.lit('"')), F.concat(F.lit(',"first_name":" '), F.col("c_mktsegment"), F.lit('"')),
        F.when(key % 3 == 0, F.lit("")).when(key % 3 == 1, F.lit(',"last_name":""')).otherwise(F.concat(F.lit(',"last_name":"n'), F.col("c_nationkey"), F.lit('"'))),
        F.when(key % 4 == 0, F.lit("")).when(key % 4 == 1, F.lit(',"email":null')).otherwise(F.concat(F.lit(',"email":"c'), key, F.lit('@x"'))),
        F.when(key % 5 == 0, F.lit("")).otherwise(F.lit(',"role":"buyer"')), F.concat(F.lit(',"account_id":'), F.col("c_nationkey")), F.lit(',"type":"customer"}'),
    ]
    return c.select(key.alias("item_id"), F.concat(*fields).alias("body"))


def customer_pages(spark: SparkSession, sf_dir: str, size: int = 100) -> DataFrame:
    """page, body: customers in listing pages; every other page is a bare list, and one document in ten has no id."""
    c = table(spark, sf_dir, "customer")
    doc = F.struct(F.col("c_custkey").alias("at"), F.when(F.col("c_custkey") % 10 != 9, F.col("c_custkey")).alias("id"), F.col("c_name").alias("name"))
    pages = c.groupBy(F.floor(F.col("c_custkey") / size).cast("bigint").alias("page")).agg(F.sort_array(F.collect_list(doc)).alias("docs"))
    listed = F.to_json("docs")
    return pages.select("page", F.when(F.col("page") % 2 == 0, F.concat(F.lit('{"results":'), listed, F.lit(',"next":"n"}'))).otherwise(listed).alias("body"))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, token, signature, body: change events of quotes and orders; one kind is unsupported, and every check of triage fails for some rows."""
    from quarry.functions.columns import hmac_sha256

    e = table(spark, sf_dir, "events")
    i, u = F.col("event_id"), F.col("user_id")
    kind = F.create_map(*(F.lit(x) for pair in {"click": "quote.created", "error": "quote.status_changed", "purchase": "order.created", "signup": "order.status_changed", "view": "page.viewed"}.items() for x in pair))[F.col("event_type")]
    status = F.when(i % 13 == 0, F.lit('""')).otherwise(F.concat(F.lit('"s'), i % 4, F.lit('"')))
    quote = F.concat(F.when(i % 3 == 0, F.concat(F.lit('"number":'), u)).otherwise(F.concat(F.lit('"quote_number":"'), u, F.lit('"'))), F.lit(',"revision_number":'), F.when(i % 2 == 0, (i % 5).cast("string")).otherwise(F.concat(F.lit('"'), i % 5, F.lit('"'))))
    order = F.concat(F.lit('"order_number":"'), u, F.lit('","quote_number":'), i % 100)
    data = F.concat(F.lit("{"), F.when(F.col("event_type").isin("click", "error"), quote).otherwise(order), F.lit(',"status":'), status, F.lit(',"created":"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('","contact":{"first_name":"f'), u, F.lit('"}}'))
    full = F.concat(F.lit('{"type":"'), kind, F.lit('","data":'), F.when(i % 29 == 0, F.lit("null")).otherwise(data), F.lit("}"))
    body = F.when(i % 31 == 0, F.lit("")).when(i % 37 == 0, F.lit("{bad")).when(i % 41 == 0, F.lit("{}")).when(i % 43 == 0, F.lit("[1]")).when(i % 47 == 0, F.lit('{"data":{}}')).otherwise(full)
    rows = e.select(i.alias("seq"), F.when(i % 5 == 0, F.lit(SECRET)).when(i % 5 == 1, F.lit("wrong")).alias("token"), body.alias("body"))
    # every fifth is signed and another fifth wrongly; the rest have the token, or neither
    signature = F.when(F.col("seq") % 5 == 2, hmac_sha256(F.col("body"), SECRET)).when(F.col("seq") % 5 == 3, hmac_sha256(F.concat("body", F.lit("x")), SECRET)).when(F.col("seq") % 5 == 4, hmac_sha256(F.col("body"), SECRET))
    return rows.select("seq", "token", signature.alias("signature"), "body")


def attempt_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, attempt, http_status: the events of a user within an hour as attempts on one item."""
    e = table(spark, sf_dir, "events")
    from pyspark.sql.window import Window

    item = F.col("user_id") * 1000 + F.col("event_id") % 97
    status = F.when(F.col("event_type") == "click", 200).when(F.col("event_type") == "view", 404).when(F.col("event_type") == "error", 500).otherwise(429)
    return e.select(item.alias("item_id"), F.row_number().over(Window.partitionBy(item).orderBy("event_id")).alias("attempt"), status.alias("http_status"))


def customer_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three overlapping batches of customers as strings: padded, with missing cells, and with different columns."""
    c = table(spark, sf_dir, "customer")
    key, name, segment = F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    first = c.filter("c_custkey % 3 <> 0").select(key, name, F.when(F.col("c_custkey") % 7 == 0, F.lit("NA")).otherwise(F.col("c_mktsegment")).alias("segment"))
    second = c.filter("c_custkey % 3 <> 1").select(name, key, F.when(F.col("c_custkey") % 7 == 0, F.lit("  ")).when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("\t "), F.col("c_mktsegment"), F.lit("　"))).otherwise(F.col("c_mktsegment")).alias("segment"))
    third = c.filter("c_custkey % 4 = 0").select(key, name, segment, F.col("c_nationkey").cast("string").alias("nation"))
    return [first, second, third]
