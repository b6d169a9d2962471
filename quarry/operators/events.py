"""Change events: authentication, triage, routing, projection, keyed upsert.

An event row is seq (arrival order, unique), token, signature, body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import columns as C
from quarry.functions.schemas import COLUMNS

QUOTE_EVENTS = ("quote.created", "quote.status_changed")
ORDER_EVENTS = ("order.created", "order.status_changed")


def is_authentic(secret: str) -> Column:
    """the token is the secret, or the signature is the body's HMAC."""
    signed = (F.col("signature") == C.hmac_sha256(F.col("body"), secret)) & C.is_filled(F.col("body"))
    return F.coalesce(F.col("token") == secret, F.lit(False)) | F.coalesce(signed, F.lit(False))


def authenticated(events: DataFrame, secret: str) -> DataFrame:
    return events.filter(is_authentic(secret))


def supported_events(events: DataFrame, custom: tuple[str, ...] = ()) -> DataFrame:
    """events of the types that a handler exists for; events has a column type."""
    return events.filter(F.col("type").isin(*QUOTE_EVENTS, *ORDER_EVENTS, *custom))


def triage(events: DataFrame, secret: str, custom: tuple[str, ...] = ()) -> DataFrame:
    """events with doc, type, status, reason, applied. The first check that fails decides; applied is whether a good event's required fields are set (custom types always)."""
    rows = events.withColumn("doc", F.try_parse_json("body")).withColumn("type", C.safe_get(F.col("doc"), "type"))
    doc, kind = F.col("doc"), F.col("type")
    types = [*QUOTE_EVENTS, *ORDER_EVENTS, *custom]
    standard = kind.isin(*(t for t in types if t not in custom))
    named = F.when(~is_authentic(secret), "unauthorized").when(~C.is_filled(F.col("body")), "empty body").when(doc.isNull(), "malformed")
    named = named.when(~C.truthy(doc), "empty document").when(~C.is_object(doc), "not an object")
    named = named.when(~C.truthy(doc, "type"), "missing type").when(~kind.isin(types), "unsupported")
    named = named.when(standard & (F.substring(F.coalesce(F.to_json(F.try_variant_get(doc, "$.data", "variant")), F.lit("{")), 1, 1) != "{"), "data is no object").otherwise("ok")
    rows = rows.withColumn("reason", named)
    r = F.col("reason")
    status = F.when(r == "ok", 200).when(r == "unauthorized", 401).when(r.isin("malformed", "not an object", "data is no object"), 500).otherwise(400)
    complete = F.when(F.col("type").isin(*custom), True).when(F.col("type").isin(*QUOTE_EVENTS), quote_complete(doc)).when(F.col("type").isin(*ORDER_EVENTS), order_complete(doc)).otherwise(True)
    return rows.withColumn("status", status).withColumn("applied", (r == "ok") & F.coalesce(complete, F.lit(False)))


def quote_complete(doc: Column, keep_base_revision: bool = False) -> Column:
    """number, revision and status set. keep_base_revision lets revision 0 pass."""
    number = C.truthy(doc, "data", "quote_number") | C.is_filled(C.safe_get(doc, "data", "number"))
    revision = C.truthy(doc, "data", "revision_number")
    if keep_base_revision:
        revision = revision | (C.safe_get(doc, "data", "revision_number") == "0")
    return number & revision & C.truthy(doc, "data", "status")


def order_complete(doc: Column) -> Column:
    """number and status set."""
    return C.truthy(doc, "data", "order_number") & C.truthy(doc, "data", "status")


def route(triaged: DataFrame) -> dict[str, DataFrame]:
    """Quote and order events that apply, and the dead letters."""
    of = lambda types: C.rows_where(triaged, F.col("applied") & F.col("type").isin(*types))
    return {"quotes": of(QUOTE_EVENTS), "orders": of(ORDER_EVENTS), "dead": C.rows_where(triaged.drop("doc"), ~F.col("applied"))}


def contact_fields(doc: Column, flat_fallback: bool) -> dict[str, Column]:
    get = lambda *k: C.safe_get(doc, "data", *k)
    nested = {
        "contact_name": C.full_name(get("contact", "first_name"), get("contact", "last_name")), "contact_email": get("contact", "email"),
        "customer_name": get("contact", "account", "name"), "estimator_email": get("estimator", "email"), "salesperson_email": get("salesperson", "email"),
    }
    if not flat_fallback:
        return nested
    return {n: F.coalesce(F.nullif(c, F.lit(" ")), get(n)) if n == "contact_name" else F.coalesce(c, get(n)) for n, c in nested.items()}


def live_quotes(events: DataFrame, flat_fallback: bool = False) -> DataFrame:
    """Seq and 13 columns; keys are strings."""
    doc = F.col("doc")
    get = lambda n: C.safe_get(doc, "data", n)
    found = contact_fields(doc, flat_fallback) | {n: get(n) for n in "revision_number status created due_date rfq_number priority private_notes".split()}
    found["quote_number"] = C.quote_key(F.try_variant_get(doc, "$.data", "variant"))
    return events.select("seq", *(found[n].alias(n) for n in COLUMNS["quotes_live"]))


def live_orders(events: DataFrame, flat_fallback: bool = False) -> DataFrame:
    """Seq and 10 columns; keys are strings."""
    doc = F.col("doc")
    found = contact_fields(doc, flat_fallback) | {n: C.safe_get(doc, "data", n) for n in "order_number status created due_date quote_number quote_revision".split()}
    return events.select("seq", *(found[n].alias(n) for n in COLUMNS["orders_live"]))


def upsert(snapshot: DataFrame | None, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The snapshot with the batch's rows: per key the highest seq stays, from either side, so replays and late arrivals change nothing.

    Equal seq values are told apart by the row's other columns. Export in the order of seq gives replaced rows their place at the end.
    """
    rows = batch if snapshot is None else snapshot.unionByName(batch)
    rest = [c for c in rows.columns if c not in keys]
    rank = F.struct("seq", *(F.col(c) for c in rest if c != "seq"))
    best = rows.groupBy(*keys).agg(F.max(rank).alias("row"))
    return best.select(*keys, *(F.col("row")[c].alias(c) for c in rest)).select(rows.columns)
