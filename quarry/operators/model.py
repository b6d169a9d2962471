"""Joins and audits of the star-shaped model that relates the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, on: dict[str, str]) -> DataFrame:
    """M1 and M3: fact with the columns of the row that it refers to; facts without one stay. on: fact column to dim column, which picks the relationship.

    No broadcast is forced: Spark sends small dimensions whole by their size, and shuffles others.
    """
    wanted = dim.select(*(F.col(d).alias(f"q_{d}") for d in on.values()), *(c for c in dim.columns if c not in on.values()))
    test = None
    for f, d in on.items():
        part = fact[f] == wanted[f"q_{d}"]
        test = part if test is None else test & part
    return fact.join(wanted, test, "left").drop(*(f"q_{d}" for d in on.values()))


def calendar(df: DataFrame, ts: str) -> DataFrame:
    """One row per day from the first to the last of a column, with its parts."""
    ends = df.agg(F.to_date(F.min(ts)).alias("a"), F.to_date(F.max(ts)).alias("b")).filter("a IS NOT NULL")
    days = ends.select(F.explode(F.sequence("a", "b")).alias("day"))
    return days.select("day", F.year("day").cast("bigint").alias("year"), F.quarter("day").cast("bigint").alias("quarter"), F.month("day").cast("bigint").alias("month"), F.dayofmonth("day").cast("bigint").alias("day_of_month"))


def calendar_join(fact: DataFrame, ts: str) -> DataFrame:
    """M2: fact with the calendar parts of a timestamp's day; the calendar has a row per day, so Spark broadcasts it by its size."""
    days = calendar(fact, ts).withColumnRenamed("day", "q_day")
    return fact.join(days, F.to_date(fact[ts]) == F.col("q_day"), "left").drop("q_day")


def orphans(fact: DataFrame, dim: DataFrame, on: dict[str, str]) -> DataFrame:
    """M4: facts whose reference is set but leads nowhere."""
    keys = dim.select(*(F.col(d).alias(f"q_{d}") for d in on.values()))
    test, filled = None, None
    for f, d in on.items():
        test = fact[f] == keys[f"q_{d}"] if test is None else test & (fact[f] == keys[f"q_{d}"])
        filled = fact[f].isNotNull() if filled is None else filled & fact[f].isNotNull()
    return fact.filter(filled).join(keys, test, "left_anti")


def duplicate_keys(dim: DataFrame, keys: list[str]) -> DataFrame:
    """M5: keys that occur more than once on the side that should be unique, with their number."""
    return dim.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def relationship_profile(model: DataFrame) -> DataFrame:
    """Relationships by kind: date joins or lookups, active or not."""
    kind = F.when(F.col("JoinOnDateBehavior") == 2, "date").otherwise("lookup")
    return model.groupBy(kind.alias("kind"), F.col("IsActive").alias("active")).agg(F.count("*").alias("n"))
