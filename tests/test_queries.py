"""Every registered query gives the rows of its SQL twin, or those of a plain version."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from biblioflow.plans import queries
from biblioflow.plans.registry import ORACLES, QUERIES
from tests import plain
from tests.twins import compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the supplied tables are not here")


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(QUERIES) - set(ORACLES) == {"cascade_assign", "overmerge_split", "leftover_groups", "sample_input"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_its_twins_rows(spark, name):
    compare(spark, QUERIES[name], ORACLES[name], FOLDER)


def test_cascade_gives_a_plain_versions_rows(spark):
    given = {k: df.collect() for k, df in queries.cascade_input(spark, FOLDER).items()}
    got = [(r["work_author_id"], r["author_id"], r["how"]) for r in QUERIES["cascade_assign"](spark, FOLDER).collect()]
    want = plain.cascade(given.pop("works"), given.pop("current"), 5_000_000_000, **given)
    assert len(got) == len(set(got)) == len(want) and set(got) == want
    assert {how for _, _, how in got} == {"kept", "split", "identifier", "name", "compatible", "new", "unnamed"} | ({"name again"} & {how for _, _, how in got})


def test_overmerged_works_go_where_a_plain_version_puts_them(spark):
    works = queries.overmerged_works(spark, FOLDER)
    frozen = {r["author_id"] for r in works.where("c_acctbal < 0").collect()}
    got = [tuple(r) for r in QUERIES["overmerge_split"](spark, FOLDER).select("author_id", "work_author_id", "orcid").collect()]
    assert len(got) == len(set(got)) and set(got) == plain.reassigned(works.collect(), frozen) and got


def test_leftovers_are_grouped_as_by_a_plain_version(spark):
    works = queries.overmerged_works(spark, FOLDER).where("orcid = ''")
    got = {(r["author_id"], r["work_author_id"], r["cluster"]) for r in QUERIES["leftover_groups"](spark, FOLDER).collect()}
    assert got == plain.leftover_groups(works.collect())


def test_a_sample_holds_rows_of_its_table(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").select("o_orderkey", "o_custkey")
    got = QUERIES["sample_input"](spark, FOLDER)
    assert 800 < got.count() < 1200 and got.join(orders, ["o_orderkey", "o_custkey"], "left_anti").isEmpty() and got.select(F.count_distinct("o_orderkey")).first()[0] == got.count()
