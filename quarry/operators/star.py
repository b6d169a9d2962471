"""The whole relationship model: lookups along its relationships, and one audit of all of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Relationships that a model may have, as the driver holds them; the key columns of tables stay on the executors.
MOST = 10_000
AUDIT = "relationship bigint, from_table bigint, to_table bigint, active boolean"


@dataclass(frozen=True)
class Relationship:
    """A many-to-one relationship: a column of `many` refers to one of `one`; by_day if days are compared."""

    id: int
    active: bool
    by_day: bool
    many: int
    many_column: int
    one: int
    one_column: int


class Star:
    """Tables and columns by the numbers that the relationships (S9) name them by. Relationships of tables or columns that aren't given are left out."""

    def __init__(self, relationships: DataFrame, tables: dict[int, DataFrame], columns: dict[int, str]):
        self.spark, self.tables, self.columns = relationships.sparkSession, tables, columns
        rows = relationships.limit(MOST + 1).collect()
        if len(rows) > MOST:
            raise ValueError(f"more than {MOST} relationships")
        found = [Relationship(r.ID, bool(r.IsActive), r.JoinOnDateBehavior == 2, r.FromTableID, r.FromColumnID, r.ToTableID, r.ToColumnID) for r in rows]
        self.relationships = {r.id: r for r in found if {r.many, r.one} <= tables.keys() and {r.many_column, r.one_column} <= columns.keys()}

    def path(self, fact: int, dim: int, relationship: int | None = None) -> list[Relationship]:
        """M1 and M3: the relationships that lead from a table to another: the shortest way over active ones, or the one through the named relationship, active or not.

        LookupError if there is none, ValueError if several are as short.
        """
        if relationship is not None:
            if relationship not in self.relationships:
                raise LookupError(f"no relationship {relationship}")
            r = self.relationships[relationship]
            return [*self.path(fact, r.many), r, *self.path(r.one, dim)]
        ways = {fact: [[]]}
        passed = set()
        while ways and dim not in ways:
            passed |= ways.keys()
            further: dict[int, list] = {}
            for r in self.relationships.values():
                if r.active and r.many in ways and r.one not in passed:
                    further.setdefault(r.one, []).extend([*way, r] for way in ways[r.many])
            ways = further
        if dim not in ways:
            raise LookupError(f"no active relationships lead from {fact} to {dim}")
        if len(ways[dim]) > 1:
            raise ValueError(f"several ways lead from {fact} to {dim}: " + "; ".join(str([r.id for r in way]) for way in ways[dim]))
        return ways[dim][0]

    def lookup(self, fact: int, dim: int, relationship: int | None = None) -> DataFrame:
        """The rows of fact with the columns of the row of dim that the path leads to, null where it breaks off. A name that fact has as well gets the table's number.

        Of tables in between only the keys are read. The one side isn't checked to be unique: see audit.
        """
        found = self.tables[fact]
        way, own = self.path(fact, dim, relationship), found.columns
        if not way:
            return found
        taken = {c.lower() for c in own}
        key = f"q_key_{fact}"
        found = found.withColumn(key, comparable(F.col(f"`{self.columns[way[0].many_column]}`"), way[0]))
        for i, r in enumerate(way):
            last = i == len(way) - 1
            one = F.col(f"`{self.columns[r.one_column]}`")
            if last:
                more = [F.col(f"`{c}`").alias(f"{c}_{dim}" if c.lower() in taken else c) for c in self.tables[dim].columns]
            else:
                more = [comparable(F.col(f"`{self.columns[way[i + 1].many_column]}`"), way[i + 1]).alias(f"q_next_{i}")]
            found = found.join(self.tables[r.one].select(comparable(one, r).alias(f"q_one_{i}"), *more), F.col(key) == F.col(f"q_one_{i}"), "left").drop(key, f"q_one_{i}")
            key = f"q_next_{i}"
        return found

    def audit(self) -> DataFrame:
        """M4 and M5 for all relationships: relationship, from_table, to_table, active, keys (distinct references that are set), orphans (of these, those that lead nowhere), orphan_rows, duplicates (keys more than once on the one side).

        Each table is read once for all its keys; these are stacked and added up by relationship and key, which frequent keys shrink in before the shuffle. What is then added up by relationship is a row per task.
        """
        stacked = None
        for number, table in self.tables.items():
            sides = [(r, self.columns[c], many) for r in self.relationships.values() for t, c, many in ((r.many, r.many_column, 1), (r.one, r.one_column, 0)) if t == number]
            if not sides:
                continue
            entries = [F.struct(F.lit(r.id).alias("relationship"), comparable(F.col(f"`{c}`"), r).cast("string").alias("key"), F.lit(many).cast("bigint").alias("many"), F.lit(1 - many).cast("bigint").alias("one")) for r, c, many in sides]
            rows = table.select(F.explode(F.array(*entries)).alias("e")).select("e.*").filter("key IS NOT NULL")
            stacked = rows if stacked is None else stacked.unionByName(rows)
        names = self.spark.createDataFrame([(r.id, r.many, r.one, r.active) for r in self.relationships.values()], AUDIT)
        if stacked is None:
            stacked = self.spark.createDataFrame([], "relationship bigint, key string, many bigint, one bigint")
        keys = stacked.groupBy("relationship", "key").agg(F.sum("many").alias("many"), F.sum("one").alias("one"))
        orphan = (F.col("many") > 0) & (F.col("one") == 0)
        sums = keys.groupBy("relationship").agg(F.count_if(F.col("many") > 0).alias("keys"), F.count_if(orphan).alias("orphans"), F.sum(F.when(orphan, F.col("many")).otherwise(0)).alias("orphan_rows"), F.count_if(F.col("one") > 1).alias("duplicates"))
        return names.join(sums, "relationship", "left").fillna(0, ["keys", "orphans", "orphan_rows", "duplicates"])


def comparable(column: Column, relationship: Relationship) -> Column:
    return F.to_date(column) if relationship.by_day else column
