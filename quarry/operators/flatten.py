"""Nested documents to flat parent and child tables.

A document row is item_id, revision (null for regular quotes), body. Headers are read from parse()'s VARIANT column doc; item
tables from the typed list that split_bad() adds, so the explode carries only the fields that the tables need. A list
is exploded as by an outer explode and filtered after, as Spark would otherwise parse it again to filter before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import columns as C
from quarry.functions.schemas import COLUMNS, ORDER_ITEMS, QUOTE_HEAD, QUOTE_ITEMS

def parse(docs: DataFrame) -> DataFrame:
    """docs with the parsed body; null if malformed."""
    return docs.withColumn("doc", F.try_parse_json("body"))


def with_items(docs: DataFrame, field: str) -> DataFrame:
    """docs with the typed list of items (null unless a list, F7) and whether the document is bad (F8); field is quote_items or order_items.

    A typed JSON parse: first of the body to the text of the field, then of that. It takes a sixth of the time of casts from VARIANT.
    """
    head = F.from_json("body", f"number string, {field} string, _corrupt_record string")
    text = F.col("head")[field]
    rows = docs.withColumn("head", head).withColumn("items", F.from_json(F.when(text.startswith("["), text), QUOTE_ITEMS if field == "quote_items" else ORDER_ITEMS))
    odd = F.exists("items", lambda i: i.isNull() | F.coalesce(F.exists(i["components"], lambda c: c.isNull()), F.lit(False)))
    untyped = F.coalesce(odd, F.coalesce(text.startswith("["), F.lit(False)))  # a list that has no typed form is bad as well
    bad = F.col("body").isNull() | F.col("head").isNull() | F.col("head._corrupt_record").isNotNull() | untyped
    return rows.withColumn("bad", bad).withColumn("number", F.col("head.number")).drop("head")


def split_bad(docs: DataFrame, field: str, items: bool = True) -> tuple[DataFrame, DataFrame]:
    """F8: (good, bad). Bad are malformed bodies, bodies that are no object, and lists with an item or component that is no object. Good rows carry number and items, if wanted: where only headers are read, the typed items are looked at and not copied."""
    rows = with_items(docs, field)
    plain = rows.drop("items", "number")
    return C.rows_where(rows if items else plain, ~F.col("bad")).drop("bad"), C.rows_where(plain, F.col("bad")).drop("bad")


def unusable_items(parsed: DataFrame, field: str) -> DataFrame:
    """documents whose item field is present but no list: they keep their header and have no items."""
    return C.rows_where(parsed, C.type_of(F.col("doc"), field).isNotNull() & ~C.is_array(F.col("doc"), field))


def quote_fields(head: Column) -> list[Column]:
    plain = [head[n].alias(n) for n in "status created due_date sent_date expired_date expired rfq_number priority private_notes authenticated_pdf_quote_url".split()]
    contact = head["contact"]
    return [
        *plain, C.full_name(contact["first_name"], contact["last_name"]).alias("contact_name"), contact["email"].alias("contact_email"),
        contact["account"]["name"].alias("customer_name"), head["estimator"]["email"].alias("estimator_email"), head["salesperson"]["email"].alias("salesperson_email"),
    ]


def quote_headers(parsed: DataFrame, revision_from: str = "request") -> DataFrame:
    """17 columns per quote. The revision is the request's (null for regular quotes) or the payload's. All fields are taken by one cast of doc, as each path alone goes through the keys anew."""
    head = F.col("head")
    revision = F.col("revision").cast("string") if revision_from == "request" else head["revision_number"]
    rows = parsed.withColumn("head", C.safe_get(F.col("doc"), kind=QUOTE_HEAD))
    return rows.select(head["number"].alias("quote_number"), revision.alias("revision_number"), *quote_fields(head))


def revised_quote_headers(parsed: DataFrame) -> DataFrame:
    """The header with quote_id, number and revision joined by a dash."""
    return quote_headers(parsed).withColumn("quote_id", F.concat_ws("-", "quote_number", "revision_number")).select(COLUMNS["quotes_revised"])


def quote_items(good: DataFrame, keep_unpriced: bool = True) -> DataFrame:
    """A row per item and price break, 18 columns; items without price breaks give one row of nulls, or none. good: from split_bad."""
    items = good.select(F.col("number").alias("quote_number"), F.col("revision").cast("string").alias("quote_revision"), F.explode_outer("items").alias("i")).filter("i IS NOT NULL")
    root = items.select("quote_number", "quote_revision", F.col("i.id").alias("item_id"), "i.workflow_status", "i.export_controlled", C.root_component(F.col("i.components")).alias("root"))
    found = C.root_attributes(F.col("root"))
    flat = root.select("quote_number", "quote_revision", "item_id", "workflow_status", "export_controlled", *(c.alias(n) for n, c in found.items()), F.col("root.quantities").alias("breaks"))
    flat = flat.withColumn("is_fully_configured", C.is_fully_configured(*(F.col(n) for n in ("part_number", "description", "material", "process"))))
    rows = flat.select(*(c for c in flat.columns if c != "breaks"), F.explode_outer("breaks").alias("q"))
    if not keep_unpriced:
        rows = rows.filter("q IS NOT NULL")
    return rows.select("*", F.col("q.quantity").try_cast("bigint").alias("quantity"), "q.unit_price", "q.total_price", F.col("q.total_price_with_required_add_ons").alias("total_price_with_add_ons"), F.col("q.lead_time").try_cast("bigint").alias("lead_time")).select(COLUMNS["quote_items"])


def order_headers(parsed: DataFrame) -> DataFrame:
    """11 columns per order."""
    return parsed.select(*order_fields(F.col("doc")))


def order_fields(doc: Column) -> list[Column]:
    get = lambda *k: C.safe_get(doc, *k)
    plain = [get(n).alias(n) for n in "quote_number quote_revision_number status created deliver_by ships_on".split()]
    paid = [get("payment_details", n).alias(n) for n in ("payment_terms", "purchase_order_number")]
    return [get("number").alias("order_number"), *plain, *paid, get("salesperson", "email").alias("salesperson_email"), get("shipping_info", "business_name").alias("customer_name")]


def order_items(good: DataFrame) -> DataFrame:
    """A row per order item, 15 columns; the description is the item's, not the component's."""
    items = good.select(F.col("number").alias("order_number"), F.explode_outer("items").alias("i")).filter("i IS NOT NULL")
    own = [F.col(f"i.{n}") for n in "description unit_price total_price export_controlled filename quote_item_id".split()]
    own += [F.col(f"i.{n}").try_cast("bigint").alias(n) for n in ("quantity", "lead_days")]
    root = items.select("order_number", F.col("i.id").alias("item_id"), *own, C.root_component(F.col("i.components")).alias("root"))
    found = C.root_attributes(F.col("root"))
    return root.select("*", *(found[n].alias(n) for n in ("part_number", "part_uuid", "revision", "material", "process"))).select(COLUMNS["order_items"])


def flat_fields(parsed: DataFrame, table: str) -> DataFrame:
    """Contacts or accounts, the contract's columns by name."""
    return parsed.select(*(C.safe_get(F.col("doc"), n).alias(n) for n in COLUMNS[table]))


def user_summary(parsed: DataFrame) -> DataFrame:
    """Trimmed name, email and role, with defaults where the key is absent."""
    doc = F.col("doc")
    absent = lambda n, default: F.when(C.type_of(doc, n).isNull(), F.lit(default)).otherwise(C.safe_get(doc, n))
    name = F.concat(absent("first_name", ""), F.lit(" "), absent("last_name", ""))
    return parsed.select(C.stripped(name).alias("name"), absent("email", "No email").alias("email"), absent("role", "Unknown role").alias("role"))


def flatten_pages(pages: DataFrame, id_only: bool = False) -> DataFrame:
    """Documents of landed pages (page, body), each an envelope with results or a bare list: page, position, doc; id_only keeps the ids present."""
    parsed = pages.select("page", F.try_parse_json("body").alias("v"))
    listed = F.when(C.is_array(F.col("v")), C.safe_get(F.col("v"), kind="array<variant>")).otherwise(C.safe_get(F.col("v"), "results", kind="array<variant>"))
    rows = parsed.select("page", F.posexplode(listed).alias("position", "doc"))
    return rows.select("page", "position", C.safe_get(F.col("doc"), "id").alias("id")).filter("id IS NOT NULL") if id_only else rows


def only_revised(index: DataFrame, revision: str = "revision") -> DataFrame:
    """rows with a revision other than null and zero."""
    return index.filter(F.col(revision).isNotNull() & (F.col(revision) != 0))


def scan_range(df: DataFrame, key: str, start: int | None, end: int | None, both: bool = False) -> DataFrame:
    """Rows with start <= key <= end; an open end if none is given, unless both are required."""
    if both and (start is None or end is None):
        raise ValueError("both ends of the range are required")
    if start is not None and end is not None and start > end:
        raise ValueError(f"the range {start} to {end} is empty")
    if start is not None:
        df = df.filter(F.col(key) >= start)
    return df if end is None else df.filter(F.col(key) <= end)


def all_quotes(regular: DataFrame, revised: DataFrame | None, include_revisions: bool = True) -> DataFrame:
    """Regular and revised rows together, duplicates kept; columns of the regular ones."""
    if not include_revisions or revised is None:
        return regular
    return regular.unionByName(revised.select(regular.columns))
