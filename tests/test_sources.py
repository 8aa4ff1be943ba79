"""Scans and sinks on Parquet and on the embedded Derby database."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from biblioflow.sources import sinks, stages, tables

DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_parquet_parts_and_absent_tables(spark, tmp_path):
    sinks.parquet(spark.range(10), f"{tmp_path}/t/a", files=1)
    sinks.parquet(spark.range(10, 15), f"{tmp_path}/t/b", files=3, spread=True)
    assert len(list((tmp_path / "t/a").glob("*.parquet"))) == 1 and len(list((tmp_path / "t/b").glob("*.parquet"))) == 3
    assert tables.warehouse_table(spark, "parquet", {"path": f"{tmp_path}/t/a"}).count() == 10
    assert [r[0] for r in tables.numbers(spark, 3).collect()] == [0, 1, 2]
    sinks.parquet(spark.range(15, 16), f"{tmp_path}/t/b", mode="append")
    assert tables.parts(spark, f"{tmp_path}/t/*").count() == 16
    assert tables.table_or_empty(spark, f"{tmp_path}/none", "id long").count() == 0
    assert tables.Catalog(str(tmp_path)).temporary("x") == f"{tmp_path}/run/x"


def test_predicates_cover_every_row_once(spark):
    df = spark.range(1000).withColumn("id", F.when(F.col("id") % 10 > 0, F.col("id")))
    predicates = tables.range_predicates("id", tables.split_points(df, "id", 7))
    assert len(predicates) == 7 and sum(df.where(p).count() for p in predicates) == 1000
    assert tables.range_predicates("id", []) == ["1 = 1"]
    texts = df.select(F.concat(F.lit("it's "), F.col("id")).alias("id"))
    dates = df.select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("id"))
    for own, points in ((texts, ["it's 3", "it's 7"]), (dates, [date(2020, 2, 1), date(2021, 1, 1)]), (dates, [datetime(2020, 2, 1, 5), datetime(2021, 1, 1)])):
        assert sum(own.where(p).count() for p in tables.range_predicates("id", points)) == 1000


def test_sample_and_statistics(spark):
    some = tables.sample(spark.range(1000), 100)
    assert 50 < some.count() < 150 and some.exceptAll(tables.sample(spark.range(1000).repartition(7), 100)).isEmpty()
    got = {r["name"]: r["value"] for r in sinks.statistics(spark.range(10), even=F.col("id") % 2 == 0).collect()}
    assert got == {"rows": 10, "even": 5}
    with pytest.raises(ValueError, match="tables"):
        sinks.require_equal(spark.range(1), spark.range(2), "tables")


def test_jdbc_round_trip(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    sinks.jdbc(spark.range(100).select(F.col("id").alias("K"), (F.col("id") * 2).alias("V")), url, "t", DRIVER, "overwrite")
    sinks.jdbc(spark.range(100, 110).select(F.col("id").alias("K"), F.col("id").alias("V")), url, "t", DRIVER)
    assert tables.jdbc_table(spark, url, "t", DRIVER).count() == 110
    ranged = tables.jdbc_by_range(spark, url, "(select * from t where V > 10) as q", "K", 0, 110, 4, DRIVER)
    assert ranged.rdd.getNumPartitions() == 4 and ranged.count() == 104
    assert tables.jdbc_by_predicates(spark, url, "t", ["K < 50", "K >= 50"], DRIVER).count() == 110
    ran = []
    sinks.staged_upsert(spark.range(5), url, "stage", DRIVER, ["UPDATE t"], ran.extend)
    assert ran == ["UPDATE t"] and tables.jdbc_table(spark, url, "stage", DRIVER).count() == 5


def test_staged_statements_run_in_one_transaction(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    own = lambda n, v: spark.range(n).select(F.col("id").alias("K"), F.lit(v).alias("V"))
    sinks.jdbc(own(5, 1), url, "t", DRIVER, "overwrite")
    run = lambda statements: sinks.transaction(spark, url, DRIVER, statements)
    update, insert = "UPDATE t SET V = 9 WHERE K IN (SELECT K FROM stage)", "INSERT INTO t SELECT K, V FROM stage WHERE K NOT IN (SELECT K FROM t)"
    held = lambda: sorted((r["K"], r["V"]) for r in tables.jdbc_table(spark, url, "t", DRIVER).collect())
    with pytest.raises(Exception, match="NOWHERE"):
        sinks.staged_upsert(own(8, 2).where("K > 3"), url, "stage", DRIVER, [update, insert, "DELETE FROM nowhere"], run)
    assert held() == [(k, 1) for k in range(5)]
    for _ in range(2):  # idempotent
        sinks.staged_upsert(own(8, 2).where("K > 3"), url, "stage", DRIVER, [update, insert], run)
        assert [k for k, _ in held()] == list(range(8)) and held()[:5] == [*((k, 1) for k in range(4)), (4, 9)]
    sinks.jdbc(own(2, 3).withColumn("W", F.lit(1)), url, "t", DRIVER, "overwrite", keep_definition=False)
    assert tables.jdbc_table(spark, url, "t", DRIVER).columns == ["K", "V", "W"]


def test_batched_updates(spark, tmp_path):
    out = str(tmp_path)

    def apply(rows):
        with open(f"{out}/{rows[0]['id']}-{len(rows)}", "w") as f:
            f.write("\n".join(str(r["id"]) for r in rows))

    sinks.batched_updates(spark.range(1000).repartition(2), apply, batch=200)
    got = [int(x) for p in tmp_path.iterdir() for x in p.read_text().split()]
    assert sorted(got) == list(range(1000))


def test_rows_are_dealt_by_their_number(spark, monkeypatch):
    """However few bytes they take: adaptive execution would put them into one task."""
    monkeypatch.setattr(stages, "ROWS_A_PART", 100)
    d = stages.dealt(spark.range(1000).select(F.lit("x").alias("same"), "id"), 1000, "id")
    assert d.rdd.getNumPartitions() == 10 and d.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 300
    assert stages.dealt(spark.range(0), 0, "id").count() == 0
