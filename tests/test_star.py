"""Lookups along the relationship model, and its audit."""

import datetime

import pytest

from quarry.functions.schemas import RELATIONSHIP
from quarry.operators.star import Star

NAMES = [f.split()[0] for f in RELATIONSHIP.split(", ")]


def model(spark, links, tables, columns):
    """links: id, active, date behaviour, many table, many column, one table, one column."""
    known = [dict(zip(("ID", "IsActive", "JoinOnDateBehavior", "FromTableID", "FromColumnID", "ToTableID", "ToColumnID"), link)) for link in links]
    rows = spark.createDataFrame([tuple(k.get(n) for n in NAMES) for k in known], RELATIONSHIP)
    return Star(rows, tables, columns)


@pytest.fixture
def star(spark):
    fact = spark.createDataFrame([(1, 10, 20, datetime.datetime(2024, 1, 2, 3)), (2, 11, 99, None), (3, None, 20, None), (4, 77, 21, None)], "id int, a int, b int, at timestamp")
    a = spark.createDataFrame([(10, 30, "x"), (11, None, "y")], "a int, c int, id string")
    b = spark.createDataFrame([(20, 31), (21, 30), (21, 30), (None, 30), (None, 30)], "b int, c int")
    c = spark.createDataFrame([(30, "thirty"), (31, "one")], "c int, name string")
    days = spark.createDataFrame([(datetime.date(2024, 1, 2), 2024)], "day date, year int")
    links = [(1, True, 1, 1, 102, 2, 102), (2, True, 1, 1, 103, 3, 103), (3, True, 1, 2, 104, 4, 104), (4, False, 1, 3, 104, 4, 104), (5, False, 2, 1, 105, 5, 106), (6, True, 1, 9, 102, 2, 102)]
    return model(spark, links, {1: fact, 2: a, 3: b, 4: c, 5: days}, {102: "a", 103: "b", 104: "c", 105: "at", 106: "day"})


def test_path_over_active_relationships(star):
    assert [r.id for r in star.path(1, 4)] == [1, 3] and star.path(1, 1) == []
    assert sorted(tuple(r) for r in star.lookup(1, 4).select("id", "name").collect()) == [(1, "thirty"), (2, None), (3, None), (4, None)]


def test_inactive_relationship_by_its_id(star):
    assert [r.id for r in star.path(1, 4, relationship=4)] == [2, 4]
    # the one side isn't unique for 21, so that row comes twice, as the audit says
    assert sorted((r["id"], r["name"]) for r in star.lookup(1, 4, relationship=4).collect() if r["id"] != 2) == [(1, "one"), (3, "one"), (4, "thirty"), (4, "thirty")]
    assert [(r["id"], r["year"]) for r in star.lookup(1, 5, relationship=5).orderBy("id").collect()] == [(1, 2024), (2, None), (3, None), (4, None)]


def test_clashing_names_get_the_tables_number(star):
    assert star.lookup(1, 2).columns == ["id", "a", "b", "at", "a_2", "c", "id_2"]


def test_no_way_and_several_ways(spark, star):
    for args in ((4, 1), (1, 5), (1, 4, 99)):
        with pytest.raises(LookupError):
            star.path(*args)
    t = spark.createDataFrame([(1,)], "k int")
    both = model(spark, [(1, True, 1, 1, 9, 2, 9), (2, True, 1, 1, 9, 3, 9), (3, True, 1, 2, 9, 4, 9), (4, True, 1, 3, 9, 4, 9)], dict.fromkeys((1, 2, 3, 4), t), {9: "k"})
    with pytest.raises(ValueError, match="several"):
        both.path(1, 4)
    assert [r.id for r in both.path(1, 4, relationship=4)] == [2, 4]


def test_audit_of_all_relationships(star):
    found = {r.relationship: tuple(r)[4:] for r in star.audit().collect()}
    assert found == {1: (3, 1, 1, 0), 2: (3, 1, 1, 1), 3: (1, 0, 0, 0), 4: (2, 0, 0, 0), 5: (1, 0, 0, 0)}


def test_audit_reads_each_table_once(star):
    plan = star.audit()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 5 and plan.count("Union") == 1 and plan.count("Aggregate") == 2


def test_audit_of_nothing(spark):
    assert model(spark, [(1, True, 1, 8, 9, 2, 9)], {}, {}).audit().collect() == []
