"""Registered queries over the whole relationship model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.schemas import RELATIONSHIP
from quarry.operators import model as M
from quarry.operators.star import Star
from quarry.plans.queries import register
from quarry.plans.reshape import table
from quarry.sources import readers as R
from quarry.sources import writers as W
from quarry.sources.scratch import new_path

TABLES = ["lineitem", "orders", "customer", "nation", "region", "supplier", "part", "calendar"]
#: id, active, by day, many side, one side.
LINKS = [
    (10, True, 1, "lineitem.l_orderkey", "orders.o_orderkey"), (11, True, 1, "orders.o_custkey", "customer.c_custkey"), (12, True, 1, "customer.c_nationkey", "nation.n_nationkey"),
    (13, True, 1, "nation.n_regionkey", "region.r_regionkey"), (14, True, 1, "lineitem.l_suppkey", "supplier.s_suppkey"), (15, False, 1, "supplier.s_nationkey", "nation.n_nationkey"),
    (16, True, 2, "orders.o_orderdate", "calendar.day"), (17, False, 2, "lineitem.l_shipdate", "calendar.day"), (18, True, 1, "lineitem.l_partkey", "part.p_partkey"), (19, False, 1, "supplier.s_nationkey", "region.r_regionkey"), (20, False, 1, "orders.o_orderkey", "lineitem.l_orderkey"),
]


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The model, its relationships written and read as CSV."""
    tables = {i + 1: table(spark, sf_dir, t) if t != "calendar" else None for i, t in enumerate(TABLES)}
    dates = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("ts")).unionAll(table(spark, sf_dir, "lineitem").select("l_shipdate"))
    tables[len(TABLES)] = M.calendar(dates, "ts")
    sides = sorted({side for link in LINKS for side in link[3:]})
    number = {side: 100 + i for i, side in enumerate(sides)}
    names, rows = [f.split()[0] for f in RELATIONSHIP.split(", ")], []
    for i, active, days, many, one in LINKS:
        known = {"ID": i, "IsActive": active, "JoinOnDateBehavior": days, "FromTableID": TABLES.index(many.split(".")[0]) + 1, "FromColumnID": number[many], "ToTableID": TABLES.index(one.split(".")[0]) + 1, "ToColumnID": number[one]}
        rows.append(tuple(str(known.get(n, 1)) for n in names))
    path = new_path(spark, "relationships")
    W.write_table(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)), path)
    return Star(R.read_relationships(spark, path), tables, {n: side.split(".")[1] for side, n in number.items()})


@register("m1_path_to_region", "SELECT r_name, count(*) AS n FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def m1_path_to_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir).lookup(1, 5).groupBy("r_name").agg(F.count("*").alias("n"))


@register("m3_inactive_supplier_nation", "SELECT n_name, count(*) AS n FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name")
def m3_inactive_supplier_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir).lookup(1, 4, relationship=15).groupBy("n_name").agg(F.count("*").alias("n"))


@register("m3_inactive_ship_date", "SELECT year(l_shipdate) AS year, quarter(l_shipdate) AS quarter, count(*) AS n FROM lineitem GROUP BY ALL")
def m3_inactive_ship_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir).lookup(1, 8, relationship=17).groupBy("year", "quarter").agg(F.count("*").alias("n"))


def audit_sql() -> str:
    parts = []
    for i, active, _, many, one in LINKS:
        (mt, mc), (ot, oc) = many.split("."), one.split(".")
        if ot == "calendar":  # a row for each day
            key = f"CAST({mc} AS DATE)"
            counts = f"(SELECT count(DISTINCT {key}) FROM {mt}) AS keys, 0 AS orphans, 0 AS orphan_rows, 0 AS duplicates"
        else:
            lost = f"{mc} IS NOT NULL AND {mc} NOT IN (SELECT {oc} FROM {ot} WHERE {oc} IS NOT NULL)"
            counts = f"(SELECT count(DISTINCT {mc}) FROM {mt}) AS keys, (SELECT count(DISTINCT {mc}) FROM {mt} WHERE {lost}) AS orphans, (SELECT count(*) FROM {mt} WHERE {lost}) AS orphan_rows, (SELECT count(*) FROM (SELECT 1 FROM {ot} WHERE {oc} IS NOT NULL GROUP BY {oc} HAVING count(*) > 1)) AS duplicates"
        parts.append(f"SELECT {i} AS relationship, {TABLES.index(mt) + 1} AS from_table, {TABLES.index(ot) + 1} AS to_table, {active} AS active, {counts}")
    return " UNION ALL ".join(parts)


@register("m4_m5_audit", audit_sql())
def m4_m5_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir).audit()
