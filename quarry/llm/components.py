"""Connected components of a link table, by alternating large and small stars (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, is_empty

#: Parts that the rows of one node are dealt to in a join, as one node may have very many neighbours.
SALTS = 16


def salted_join(rows: DataFrame, by_key: DataFrame, key: str, spread: str) -> DataFrame:
    """rows with the columns of by_key (one row per key), the rows of a key dealt by the column `spread` to SALTS parts, each with a copy of the key's row."""
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    return dealt.join(by_key.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>"))), [key, "salt"]).drop("salt")


def components(links: DataFrame) -> DataFrame:
    """node, root of every node with a link; root is the smallest node reachable. links: a, b (bigint), in either direction, repeats and loops allowed.

    Each round sends every node's larger neighbours to its smallest one, then its smaller ones; written to the shared folder, so
    lineage stays short and nothing is gathered. Ends when a round changes nothing, after about log(n) rounds.
    """
    edges = cut(links.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").filter("a <> b").distinct(), "links")
    if is_empty(edges):
        return edges.selectExpr("a AS node", "b AS root")
    before = None
    while True:
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = salted_join(both, least, "a", "b").filter("b > a").selectExpr("b AS a", "m AS b").filter("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        stars = salted_join(large, small, "a", "b").selectExpr("a", "b", "m")
        edges = cut(stars.selectExpr("b AS a", "m AS b").unionByName(stars.selectExpr("a", "m AS b")).filter("a <> b").distinct(), "links")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    roots = edges.selectExpr("a AS node", "b AS root")
    return roots.unionByName(roots.selectExpr("root AS node", "root").distinct())
