"""Ranged runs over landed documents: a registry of transforms per entity, and the run around it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import columns as C
from quarry.operators import flatten as P
from quarry.operators.accounting import Counted, new_failures
from quarry.sources.readers import read_ledger
from quarry.sources.scratch import new_path
from quarry.sources.writers import append_ledger, batch_name, file_system, write_partition

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Entity:
    """How the documents of one kind become tables: transform gives a row per good document (of doc, the parsed body, and the columns beside it), children (if any) the rows of its list `field`."""

    table: str
    transform: Transform
    child_table: str | None = None
    children: Transform | None = None
    field: str | None = None


#: The entities of the contract.
STANDARD = {
    "quotes": Entity("quotes", P.quote_headers, "quote_items", P.quote_items, "quote_items"),
    "quotes_revised": Entity("quotes_revised", P.revised_quote_headers, "quote_items", P.quote_items, "quote_items"),
    "orders": Entity("orders", P.order_headers, "order_items", P.order_items, "order_items"),
    "contacts": Entity("contacts", lambda docs: P.flat_fields(docs, "contacts")),
    "accounts": Entity("accounts", lambda docs: P.flat_fields(docs, "accounts")),
}

SUMMARY = "entity string, outcome string, processed bigint, failed bigint, child_rows bigint, error string"


class Registry:
    """Transforms by entity. A registered one replaces that of the contract, as a subclass would; transforms are DataFrame functions, so no row leaves the JVM."""

    def __init__(self, entities: dict[str, Entity] | None = None):
        self.entities = dict(STANDARD if entities is None else entities)

    def register(self, name: str, transform: Transform, children: Transform | None = None, field: str | None = None, table: str | None = None, child_table: str | None = None) -> None:
        """Adds an entity, or replaces an entity's transforms; what isn't given stays as it was."""
        known = self.entities.get(name, Entity(name, transform))
        given = {"transform": transform, "children": children, "field": field, "table": table, "child_table": child_table}
        self.entities[name] = replace(known, **{k: v for k, v in given.items() if v is not None})

    def run(self, spark: SparkSession, docs: dict[str, DataFrame], root: str, start: int | None = None, end: int | None = None, revised: bool = False) -> DataFrame:
        """For each entity of docs (rows of item_id, revision, body) S4, F8, its transform, K2 into the batch of the range, L1 with K6, L6.

        Below root each table is partitioned by batch, and ledger/<entity> holds the ids of bad documents. An entity that fails (an unknown one, a range that is empty, a
        transform that raises) leaves the others alone. Returns a row per entity: outcome is done, or failed with the error's first line and no counts.
        """
        rows = []
        for name, landed in docs.items():
            try:
                rows.append((name, "done", *self.run_entity(spark, name, landed, root, start, end, revised), None))
            except Exception as error:  # one entity's fault must not stop the others
                rows.append((name, "failed", None, None, None, (str(error) or type(error).__name__).splitlines()[0]))
        return spark.createDataFrame(rows, SUMMARY)

    def run_entity(self, spark: SparkSession, name: str, landed: DataFrame, root: str, start: int | None, end: int | None, revised: bool) -> tuple[int, int, int]:
        """One entity: (processed, failed, child rows). The documents are read once and lie in the shared folder while parents, children and ledger are written; the rows are counted on the way."""
        if name not in self.entities:
            raise KeyError(f"no transform is registered for {name}")
        entity, path = self.entities[name], new_path(spark, "run")
        try:
            held = held_documents(judged_documents(P.scan_range(landed, "item_id", start, end), entity.field), path)  # the one pass that reads
            good, bad = held.filter("NOT bad").drop("bad"), held.filter("bad")
            batch = batch_name(start, end, revised)
            failed = held.agg(F.count_if("bad")).first()[0]
            processed, children = Counted("processed"), Counted("children")
            write_partition(processed.on(entity.transform(opened(good, filtered=True))), f"{root}/{entity.table}", batch, entity.table)
            if entity.children:
                write_partition(children.on(entity.children(opened(good))), f"{root}/{entity.child_table}", batch, entity.child_table)
            ledger = f"{root}/ledger/{name}"
            append_ledger(new_failures(bad.selectExpr("item_id AS id"), read_ledger(spark, ledger)), ledger)
            return processed.rows, failed, children.rows
        finally:
            fs, at = file_system(spark, path)
            fs.delete(at, True)


#: How held documents are written: they are read twice and then deleted, and a task gathers a row group in memory. Texts hardly repeat, so dictionaries and statistics only cost time.
HELD = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.block.size": str(16 << 20), "parquet.enable.dictionary": "false", "parquet.column.statistics.enabled": "false"}


def held_documents(rows: DataFrame, path: str) -> DataFrame:
    """rows, written once and read from there: cached rows would fill the executors' memory, and each reader would take all columns. Columns of nulls alone have no type in files and become strings."""
    typed = rows.select(*(F.col(f"`{n}`").cast("string").alias(n) if t == "void" else F.col(f"`{n}`") for n, t in rows.dtypes))
    typed.write.options(**HELD).parquet(path)
    return rows.sparkSession.read.schema(typed.schema).parquet(path)


def judged_documents(docs: DataFrame, field: str | None) -> DataFrame:
    """docs with bad (F8); with number and items as well if the entity has a list."""
    return P.with_items(docs, field) if field else P.parse(docs).withColumn("bad", ~C.is_object(F.col("doc"))).drop("doc")


def opened(rows: DataFrame, filtered: bool = False) -> DataFrame:
    """rows with doc in the place of the text. filtered: by a generator, below which no filter on doc moves, as it would parse again; without, nothing is parsed if doc isn't read."""
    doc = F.try_parse_json("body")
    doc = F.explode_outer(F.array(doc)) if filtered else doc
    return rows.select(*(doc.alias("doc") if c == "body" else F.col(f"`{c}`") for c in rows.columns))


def parsed_documents(docs: DataFrame, field: str | None) -> DataFrame:
    """item_id, revision and other columns of docs with doc for the body, and bad (F8); with number and items as well if the entity has a list. The text isn't held beside doc, which has all of it."""
    return opened(judged_documents(docs, field))
