"""The relational primitives that the operators rest on, each as a small query."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from biblioflow.functions import columns
from biblioflow.plans.queries import AS_OF, query, t
from biblioflow.sources.stages import dealt


@query("SELECT o_orderkey, CAST(CASE WHEN year(o_orderdate) < 1997 THEN 1997 WHEN year(o_orderdate) > 2000 THEN 2000 ELSE year(o_orderdate) END AS BIGINT) AS y FROM orders")
def clamped_years(spark, sf_dir):
    return t(spark, sf_dir, "orders").select("o_orderkey", columns.clamp(F.year("o_orderdate"), 1997, 2000).cast("bigint").alias("y"))


@query("SELECT c_custkey, coalesce(n, 0) AS n, coalesce(p, 'none') AS p FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, min(o_orderpriority) AS p FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON o_custkey = c_custkey")
def filled_nulls(spark, sf_dir):
    n = t(spark, sf_dir, "orders").where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.min("o_orderpriority").alias("p"))
    return t(spark, sf_dir, "customer").select("c_custkey").join(n, "c_custkey", "left").fillna(0, ["n"]).fillna("none", ["p"])


@query("SELECT doc_id FROM documents WHERE contains(lower(text), 'the ') AND length(trim(text)) > 100 AND lang NOT IN ('de', 'fr') AND text IS NOT NULL")
def text_predicates(spark, sf_dir):
    text = F.col("text")
    return t(spark, sf_dir, "documents").where(F.lower(text).contains("the ") & (F.length(F.trim(text)) > 100) & ~F.col("lang").isin("de", "fr") & text.isNotNull()).select("doc_id")


@query("SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 3")
def array_size_predicate(spark, sf_dir):
    sets = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("s"))
    return sets.where(F.size(F.coalesce("s", F.array())) > 3).select("l_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= '1999-01-01' AND o_orderdate < '1999-07-01'")
def date_range(spark, sf_dir):
    return t(spark, sf_dir, "orders").where("o_orderdate >= '1999-01-01' and o_orderdate < '1999-07-01'").select("o_orderkey")


@query("SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 6 HOUR")
def recent_rows(spark, sf_dir):
    events = t(spark, sf_dir, "events")
    last = events.agg(F.max("ts")).scalar()
    return events.where(F.col("ts") > last - F.expr("INTERVAL 6 HOURS")).select("event_id")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN (SELECT l_partkey, l_suppkey FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1) USING (l_partkey, l_suppkey)")
def composite_join(spark, sf_dir):
    lines = t(spark, sf_dir, "lineitem")
    pairs = lines.groupBy("l_partkey", "l_suppkey").count().where("count > 1").drop("count")
    return lines.join(pairs, ["l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R')")
def semi_join(spark, sf_dir):
    returned = t(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("s_suppkey"))
    return t(spark, sf_dir, "supplier").join(returned, "s_suppkey", "left_semi").select("s_suppkey", "s_name")


@query("SELECT o_custkey, o_orderkey, CAST(sum(k) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM (SELECT *, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS k FROM orders)")
def running_sum(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    return t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.sum(F.substring("o_orderpriority", 1, 1).cast("bigint")).over(w).alias("running"))


@query("SELECT c_custkey, r, max(r) OVER (PARTITION BY c_nationkey) AS most FROM (SELECT c_custkey, c_nationkey, rank() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) AS r FROM customer)")
def rank_and_largest(spark, sf_dir):
    by = Window.partitionBy("c_nationkey")
    ranked = t(spark, sf_dir, "customer").withColumn("r", F.rank().over(by.orderBy("c_mktsegment")).cast("bigint"))
    return ranked.select("c_custkey", "r", F.max("r").over(by).alias("most"))


@query("SELECT o_custkey, o_orderpriority FROM (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS rn FROM orders GROUP BY 1, 2) WHERE rn = 1")
def most_frequent(spark, sf_dir):
    n = t(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").count()
    return columns.newest(n, ["o_custkey"], F.desc("count"), F.col("o_orderpriority")).select("o_custkey", "o_orderpriority")


@query("SELECT 'c' AS kind, c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT 's', s_suppkey, s_name FROM supplier")
def union_by_name(spark, sf_dir):
    a = t(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id"), F.lit("c").alias("kind"))
    return a.unionByName(t(spark, sf_dir, "supplier").select(F.lit("s").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


@query("SELECT l_orderkey AS paper_id, CAST(l_linenumber AS BIGINT) AS author_sequence_number, count(*) AS n FROM lineitem GROUP BY 1, 2")
def split_keys(spark, sf_dir):
    key = t(spark, sf_dir, "lineitem").select(F.concat_ws("_", "l_orderkey", "l_linenumber").alias("k"))
    return key.groupBy(columns.paper_of(F.col("k")).alias("paper_id"), columns.sequence_of(F.col("k")).cast("bigint").alias("author_sequence_number")).agg(F.count("*").alias("n"))


@query(f"SELECT o_orderkey AS paper_id, CAST(g AS BIGINT) AS year_diff FROM (SELECT o_orderkey, unnest(range(0, least(3, {AS_OF} - year(o_orderdate)) + 1)) AS g FROM orders)")
def year_grid(spark, sf_dir):
    """The years of a paper's window, generated in place of a join with all offsets."""
    last = F.least(F.lit(3), F.lit(AS_OF) - F.year("o_orderdate"))
    return t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("paper_id"), F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))).alias("year_diff"))


@query("SELECT l_orderkey, min(l_suppkey) AS first_supplier, max(l_suppkey) AS last_supplier, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers, avg(l_linenumber) AS mean FROM lineitem GROUP BY 1")
def grouped_measures(spark, sf_dir):
    lines = t(spark, sf_dir, "lineitem")
    return dealt(lines.select("l_orderkey", "l_suppkey", "l_linenumber"), lines.count(), "l_orderkey").groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("first_supplier"), F.max("l_suppkey").alias("last_supplier"), F.count("*").alias("n"), F.count_distinct("l_suppkey").alias("suppliers"), F.avg("l_linenumber").alias("mean")
    )


@query("SELECT s_suppkey, CAST(NULL AS TIMESTAMPTZ) AS started, 0.5 :: DOUBLE AS rand FROM supplier")
def typed_literals(spark, sf_dir):
    return t(spark, sf_dir, "supplier").select("s_suppkey", F.lit(None).cast("timestamp").alias("started"), F.lit(0.5).alias("rand"))
