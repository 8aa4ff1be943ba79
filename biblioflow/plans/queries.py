"""The bibliographic operators on the supplied tables, in the roles that these play.

paper: orders; citation event: lineitem; entity: customer; institution: supplier; topic: part name; work type: order
priority; subfield: market segment; requests: events.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from biblioflow.functions import columns, names
from biblioflow.operators import assign, authors, citations, diff, identifiers, metrics, rules
from biblioflow.sources import queue, stages, tables

AS_OF = 2001
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM")

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = t(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("topic_id"))
    return t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("paper_id"), "l_partkey").join(parts, F.col("l_partkey") == F.col("p_partkey")).select("paper_id", "topic_id")


RENAMED = "SELECT p_partkey, p_name AS a, CASE p_partkey % 5 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, 'e', 'é') WHEN 2 THEN p_name || ' x' WHEN 3 THEN replace(p_name, 'a', 'o') END AS b FROM part"


@query(f"SELECT p_partkey, coalesce(length(a), 0) <> coalesce(length(b), 0) OR lower(strip_accents(coalesce(a, ''))) <> lower(strip_accents(coalesce(b, ''))) AS changed FROM ({RENAMED})")
def display_changes(spark, sf_dir):
    """Display names that differ by more than case, dots or diacritics."""
    named = t(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("a"), F.expr("CASE p_partkey % 5 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, 'e', 'é') WHEN 2 THEN p_name || ' x' WHEN 3 THEN replace(p_name, 'a', 'o') END").alias("b"))
    return named.select("p_partkey", names.display_changed_of(F.col("a"), F.col("b")).alias("changed"))


@query("SELECT p_name AS topic_id, count(*) AS num_papers FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def topic_volume(spark, sf_dir):
    return metrics.topic_volume(work_topic(spark, sf_dir))


PROFILE_SQL = """
WITH wt AS (SELECT l_orderkey AS paper_id, p_name AS topic_id FROM lineitem JOIN part ON l_partkey = p_partkey),
v AS (SELECT topic_id, count(*) AS num_papers FROM wt GROUP BY 1),
c AS (SELECT o_custkey, topic_id, count(*) AS topic_count FROM (SELECT DISTINCT {entity} AS o_custkey, o_orderkey FROM orders{join}) m
  JOIN (SELECT DISTINCT * FROM wt) d ON d.paper_id = m.o_orderkey GROUP BY 1, 2),
r AS (SELECT *, topic_count / num_papers AS topic_share FROM c JOIN v USING (topic_id)),
k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY topic_count DESC, topic_id) AS a,
  row_number() OVER (PARTITION BY o_custkey ORDER BY topic_share DESC, topic_id) AS b FROM r)
SELECT o_custkey AS entity_id, topic_id, topic_count, topic_share FROM k WHERE a <= 30 OR b <= 30
"""


@query(PROFILE_SQL.format(entity="o_custkey", join=""))
def entity_topic_profile(spark, sf_dir):
    members = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity_id"), F.col("o_orderkey").alias("paper_id"))
    return metrics.entity_topic_profile(members, work_topic(spark, sf_dir), "entity_id", rows=t(spark, sf_dir, "lineitem").count())


@query(PROFILE_SQL.format(entity="l_suppkey", join=" JOIN lineitem ON o_orderkey = l_orderkey"))
def institution_topic_profile(spark, sf_dir):
    members = t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("entity_id"), F.col("l_orderkey").alias("paper_id"))
    papers = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("paper_id"))
    return metrics.entity_topic_profile(members.join(papers, "paper_id", "left_semi"), work_topic(spark, sf_dir), "entity_id", rows=t(spark, sf_dir, "lineitem").count())


@query(PROFILE_SQL.format(entity="c_mktsegment || c_nationkey", join=" JOIN customer ON o_custkey = c_custkey"))
def source_topic_profile(spark, sf_dir):
    """D2 of sources: a journal is a market segment of a nation."""
    own = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.concat("c_mktsegment", F.col("c_nationkey").cast("string")).alias("entity_id"))
    members = t(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("paper_id")).join(own, "o_custkey").select("entity_id", "paper_id")
    return metrics.entity_topic_profile(members, work_topic(spark, sf_dir), "entity_id", rows=t(spark, sf_dir, "lineitem").count())


def works(spark, sf_dir) -> DataFrame:
    """Orders as works; those of urgent priority are merged into the work before them."""
    key = F.col("o_orderkey")
    merge = F.when(F.col("o_orderpriority") == "1-URGENT", key - 1)
    return t(spark, sf_dir, "orders").select(key.alias("paper_id"), merge.alias("merge_into_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("publication_date"), F.col("o_orderpriority").alias("type"), F.col("o_custkey").alias("journal_id"))


WORKS = "w AS (SELECT o_orderkey AS paper_id, CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey - 1 END AS merge_into_id, year(o_orderdate) AS y FROM orders)"


def references(spark, sf_dir) -> DataFrame:
    return t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("paper_id"), (F.col("l_partkey") * 7 + F.col("l_suppkey")).alias("paper_reference_id"))


EDGES = f"""
{WORKS},
e AS (SELECT DISTINCT coalesce(a.merge_into_id, a.paper_id) AS citing, coalesce(b.merge_into_id, b.paper_id) AS cited
  FROM (SELECT l_orderkey AS p, l_partkey * 7 + l_suppkey AS r FROM lineitem) c JOIN w a ON a.paper_id = p JOIN w b ON b.paper_id = r)
"""


@query(f"WITH {EDGES} SELECT citing, cited FROM e")
def merge_aware_edges(spark, sf_dir):
    return citations.citation_edges(references(spark, sf_dir), works(spark, sf_dir))


@query(f"WITH {EDGES} SELECT citing, cited, CAST(a.y - b.y AS BIGINT) AS year_diff FROM e JOIN w a ON a.paper_id = citing JOIN w b ON b.paper_id = cited WHERE a.y >= b.y")
def dated_edges(spark, sf_dir):
    own = works(spark, sf_dir)
    return citations.dated_edges(citations.citation_edges(references(spark, sf_dir), own), own).withColumn("year_diff", F.col("year_diff").cast("bigint"))


def events_of(spark, sf_dir) -> DataFrame:
    """(cited, citing, year_diff): every shipment of an order in or after its year is a citation."""
    orders = t(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("pub_year"))
    lines = t(spark, sf_dir, "lineitem").select("l_orderkey", F.year("l_shipdate").alias("year"))
    met = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return met.where("year >= pub_year").select(F.col("l_orderkey").alias("cited"), (F.col("year") - F.col("pub_year")).alias("year_diff"))


def papers_of(spark, sf_dir) -> DataFrame:
    segment = t(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("subfield_id"))
    orders = t(spark, sf_dir, "orders").join(segment, F.col("o_custkey") == F.col("c_custkey"), "left")
    year = citations.publication_year(F.date_format("o_orderdate", "yyyy-MM-dd"), AS_OF)
    return orders.select(F.col("o_orderkey").alias("paper_id"), year.alias("pub_year"), F.col("o_orderpriority").alias("work_type"), "subfield_id")


def counted(spark, sf_dir) -> DataFrame:
    return citations.window_counts(events_of(spark, sf_dir), papers_of(spark, sf_dir), AS_OF)


COUNTED = f"""
ev AS (SELECT l_orderkey AS paper_id, year(l_shipdate) - year(o_orderdate) AS year_diff, year(o_orderdate) AS y FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(l_shipdate) >= year(o_orderdate)),
n AS (SELECT paper_id, count(*) FILTER (year_diff BETWEEN 0 AND least(3, {AS_OF} - y)) AS near, count(*) AS total, count(DISTINCT year_diff) AS offs FROM ev GROUP BY 1),
counted AS (SELECT o_orderkey AS paper_id, greatest(least(year(o_orderdate), {AS_OF}), {AS_OF} - 100) AS pub_year, o_orderpriority AS work_type, c_mktsegment AS subfield_id,
  coalesce(near, 0) AS pub_plus_3_citations, coalesce(total, 0) AS total_citations, coalesce(offs, 0) AS citation_offsets
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN n ON n.paper_id = o_orderkey)
"""


@query("SELECT o_orderkey AS paper_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(l_shipdate) >= year(o_orderdate))")
def uncited_papers(spark, sf_dir):
    return citations.uncited(papers_of(spark, sf_dir).select("paper_id"), events_of(spark, sf_dir))


@query(f"WITH {COUNTED} SELECT paper_id, pub_plus_3_citations, total_citations, citation_offsets FROM counted")
def citation_window_counts(spark, sf_dir):
    return counted(spark, sf_dir).select("paper_id", "pub_plus_3_citations", "total_citations", "citation_offsets")


EXPECTED = f"x AS (SELECT pub_year, subfield_id, work_type, round(avg(pub_plus_3_citations), 8) AS expected_citations FROM counted WHERE pub_year <= {AS_OF} AND subfield_id IS NOT NULL GROUP BY ALL)"


@query(f"WITH {COUNTED}, {EXPECTED} SELECT CAST(pub_year AS BIGINT) AS pub_year, subfield_id, work_type, expected_citations FROM x")
def expected_citations(spark, sf_dir):
    return citations.expected_citations(counted(spark, sf_dir).where("subfield_id is not null"), AS_OF).withColumn("pub_year", F.col("pub_year").cast("bigint"))


@query(f"""WITH {COUNTED}, {EXPECTED} SELECT paper_id, work_type, CASE WHEN work_type IN {PRIORITIES} AND expected_citations <> 0 THEN round(pub_plus_3_citations / expected_citations, 5) END AS fwci
FROM counted LEFT JOIN x USING (pub_year, subfield_id, work_type)""")
def fwci(spark, sf_dir):
    return citations.fwci(counted(spark, sf_dir), AS_OF, PRIORITIES)


@query(f"""WITH {COUNTED}, r AS (SELECT paper_id, pub_year, work_type, subfield_id, rank() OVER (PARTITION BY pub_year, work_type, subfield_id ORDER BY total_citations) AS k FROM counted WHERE subfield_id IS NOT NULL)
SELECT paper_id, round((k - 1) / (max(k) OVER (PARTITION BY pub_year, work_type, subfield_id) + 1), 8) AS percentile FROM r""")
def citation_percentile(spark, sf_dir):
    return citations.percentiles(counted(spark, sf_dir))


@query("SELECT o_orderkey AS paper_id, CASE WHEN o_orderpriority = '1-URGENT' AND c_mktsegment = 'BUILDING' THEN 'conference_article' WHEN o_orderpriority = '1-URGENT' THEN 'article' ELSE o_orderpriority END AS work_type FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def type_override(spark, sf_dir):
    series = F.when(F.col("c_mktsegment") == "BUILDING", "conference").otherwise("journal")
    journals = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("journal_id"), series.alias("type"), F.lit(None).cast("bigint").alias("merge_into_id"))
    own = works(spark, sf_dir).withColumn("type", F.when(F.col("type") == "1-URGENT", "article").otherwise(F.col("type")))
    return citations.work_types(own, journals)


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_request(spark, sf_dir):
    return columns.newest(t(spark, sf_dir, "events"), ["user_id"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_id", "event_type", "value")


@query("SELECT DISTINCT l_orderkey, l_partkey, l_quantity FROM (SELECT *, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_discount DESC) AS k FROM lineitem) WHERE k = 1")
def dense_rank_ties(spark, sf_dir):
    w = Window.partitionBy("l_orderkey").orderBy(F.desc("l_quantity"), F.desc("l_discount"))
    return t(spark, sf_dir, "lineitem").withColumn("k", F.dense_rank().over(w)).where("k = 1").select("l_orderkey", "l_partkey", "l_quantity").distinct()


@query("SELECT l_suppkey, l_partkey, n FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) AS rn FROM (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL)) WHERE rn <= 25")
def topk_candidates(spark, sf_dir):
    n = t(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"))
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("n"), "l_partkey")
    return n.withColumn("rn", F.row_number().over(w)).where("rn <= 25").drop("rn")


@query("SELECT c_nationkey, c_custkey FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY (c_mktsegment = 'BUILDING') DESC, coalesce(n, 0) DESC, c_custkey) AS rn FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey) WHERE rn = 1")
def conditional_winner(spark, sf_dir):
    n = t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    own = t(spark, sf_dir, "customer").join(n, "c_custkey", "left")
    return columns.newest(own, ["c_nationkey"], (F.col("c_mktsegment") == "BUILDING").desc(), F.coalesce("n", F.lit(0)).desc(), F.col("c_custkey")).select("c_nationkey", "c_custkey")


@query("SELECT s_suppkey, 5000000000 + row_number() OVER (ORDER BY s_suppkey) AS author_id FROM supplier")
def id_allocation(spark, sf_dir):
    return assign.allocated(t(spark, sf_dir, "supplier").select("s_suppkey"), ["s_suppkey"], 5_000_000_000, "author_id")


@query("SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem")
def distinct_members(spark, sf_dir):
    return t(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").dropDuplicates()


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return t(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


def feature_rows(spark, sf_dir) -> DataFrame:
    """(work, institutions, citations, coauthors): id sets of each order."""
    return t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("work")).agg(
        F.sort_array(F.collect_set("l_suppkey")).alias("institutions"), F.sort_array(F.collect_set("l_partkey")).alias("citations"), F.sort_array(F.collect_set("l_linenumber")).alias("coauthors")
    )


def line_sets(spark, sf_dir) -> DataFrame:
    """``feature_rows`` from lines dealt by order before they are grouped, one list an order instead of three sets on either side of an exchange."""
    kinds = {"institutions": "l_suppkey", "citations": "l_partkey", "coauthors": "l_linenumber"}
    lines = t(spark, sf_dir, "lineitem").select("l_orderkey", *kinds.values())
    listed = stages.dealt(lines, lines.count(), "l_orderkey").groupBy(F.col("l_orderkey").alias("work")).agg(F.collect_list(F.struct(*kinds.values())).alias("x"))
    return listed.select("work", *[F.sort_array(F.array_distinct(F.array_compact(F.col(f"x.{c}")))).alias(n) for n, c in kinds.items()])


@query("SELECT l_orderkey AS work, array_to_string(list_sort(list_distinct(list(l_suppkey))), ',') AS institutions, CAST(count(DISTINCT l_partkey) AS BIGINT) AS n_citations FROM lineitem GROUP BY 1")
def feature_sets(spark, sf_dir):
    return feature_rows(spark, sf_dir).select("work", F.array_join(columns.capped_list(F.col("institutions")), ",").alias("institutions"), F.size("citations").cast("bigint").alias("n_citations"))


@query("SELECT o_custkey, array_to_string(list_sort(list_distinct(list(l_suppkey))), ',') AS institutions FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_suppkey <> 1 GROUP BY 1")
def merged_sets(spark, sf_dir):
    own = t(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("work"))
    merged = own.join(feature_rows(spark, sf_dir), "work").groupBy("o_custkey").agg(columns.merged_sets(F.col("institutions"), 1).alias("s"))
    return merged.where(F.size("s") > 0).select("o_custkey", F.array_join("s", ",").alias("institutions"))


def work_sets(spark, sf_dir) -> DataFrame:
    """(paper_id and the sets of an authorship) of each order that has lines."""
    parts = t(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = t(spark, sf_dir, "lineitem").join(stages.sized(parts, 24), F.col("l_partkey") == F.col("p_partkey"))
    kinds = {"institutions": F.col("l_suppkey"), "citations": F.col("l_partkey") * 7 + F.col("l_suppkey"), "coauthors": F.col("p_brand"), "concepts": F.col("l_partkey") % 40}
    lines = lines.select("l_orderkey", *[x.alias(n) for n, x in kinds.items()]).repartition("l_orderkey")  # dealt as they are, one list an order
    listed = lines.groupBy(F.col("l_orderkey").alias("paper_id")).agg(F.collect_list(F.struct(*kinds)).alias("x"))
    return listed.select("paper_id", *[F.sort_array(F.array_distinct(F.array_compact(F.col(f"x.{n}")))).alias(n) for n in kinds])


def profiles(spark, sf_dir) -> DataFrame:
    """(o_custkey, paper_id, author and the sets of an authorship) of each order."""
    author = F.lower(F.concat_ws(" ", F.col("o_orderstatus"), F.split("o_orderpriority", "-")[1]))
    return t(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("paper_id"), author.alias("author")).join(work_sets(spark, sf_dir), "paper_id")


PROFILES = """f AS (SELECT l_orderkey AS w, list_distinct(list(l_suppkey)) AS i, list_distinct(list(l_partkey * 7 + l_suppkey)) AS r, list_distinct(list(p_brand)) AS c, list_distinct(list(l_partkey % 40)) AS k FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
o AS (SELECT o_custkey, o_orderkey, lower(o_orderstatus || ' ' || string_split(o_orderpriority, '-')[2]) AS author, f.* FROM orders JOIN f ON w = o_orderkey)"""


@query(f"""WITH {PROFILES},
x AS (SELECT a.o_orderkey AS a, b.o_orderkey AS b, CAST(len(list_intersect(a.i, b.i)) > 0 AS INT) AS inst_per,
  round(len(list_intersect(a.k, b.k)) / len(list_distinct(list_concat(a.k, b.k))), 4) AS concepts_per, round(len(list_intersect(a.c, b.c)) / len(list_distinct(list_concat(a.c, b.c))), 4) AS coauthors_per,
  round(len(list_intersect(a.r, b.r)) / len(list_distinct(list_concat(a.r, b.r))), 4) AS citation_per, CAST(list_contains(a.r, b.o_orderkey) OR list_contains(b.r, a.o_orderkey) AS INT) AS citation_work_match,
  CASE WHEN a.author = b.author THEN length(a.author) ELSE 0 END AS exact_match_len, CASE WHEN a.author = b.author THEN len(string_split(a.author, ' ')) ELSE 0 END AS exact_match_spaces
  FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey)
SELECT a, b, inst_per, concepts_per, coauthors_per, citation_per, citation_work_match, CAST(exact_match_len AS INT) AS exact_match_len, CAST(exact_match_spaces AS INT) AS exact_match_spaces FROM x WHERE inst_per > 0 OR citation_per > 0""")
def pair_features(spark, sf_dir):
    """Features of an entity's works that share an institution or a reference: pairs come from the members they share."""
    own = profiles(spark, sf_dir)
    member = F.explode(F.concat(F.transform("institutions", lambda x: F.concat(F.lit("i"), x)), F.transform("citations", lambda x: F.concat(F.lit("c"), x))))
    listed = own.select("o_custkey", "paper_id", member.alias("member"))
    pairs = listed.withColumnRenamed("paper_id", "a").join(listed.withColumnRenamed("paper_id", "b"), ["o_custkey", "member"]).where("a < b").select("a", "b").distinct()
    side = lambda key, s: own.select(F.col("paper_id").alias(key), *[F.col(c).alias(c + s) for c in own.columns])
    found = assign.features(pairs.join(side("a", "_1"), "a").join(side("b", "_2"), "b"))
    return found.select("a", "b", *assign.VECTOR)


@query("SELECT l_partkey, l_suppkey, min(l_orderkey) AS representative, count(*) AS n FROM lineitem GROUP BY 1, 2")
def representative_rows(spark, sf_dir):
    own = t(spark, sf_dir, "lineitem").withColumn("features", F.array("l_partkey", "l_suppkey"))
    grouped = own.groupBy("features").agg(F.min("l_orderkey").alias("representative"), F.count("*").alias("n"))
    return grouped.select(F.col("features")[0].alias("l_partkey"), F.col("features")[1].alias("l_suppkey"), "representative", "n")


@query("""WITH o AS (SELECT c_nationkey, c_custkey, CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS orcid FROM customer)
SELECT a.c_nationkey, least(a.orcid, b.orcid) AS a, greatest(a.orcid, b.orcid) AS b, count(*) AS n FROM o a JOIN o b ON a.c_nationkey = b.c_nationkey AND a.c_custkey < b.c_custkey
WHERE a.orcid = b.orcid OR a.orcid = '' OR b.orcid = '' GROUP BY ALL""")
def orcid_compatible_pairs(spark, sf_dir):
    """Compatible pairs of a block by identifier class: a class and its size say as much as all its pairs."""
    own = t(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment")).alias("orcid"))
    classes = own.groupBy("c_nationkey", "orcid").agg(F.count("*").alias("n"))
    side = lambda s: classes.select("c_nationkey", F.col("orcid").alias(s), F.col("n").alias(f"n_{s}"))
    met = side("a").join(side("b"), "c_nationkey").where((F.col("a") <= F.col("b")) & columns.orcid_compatible(F.col("a"), F.col("b")))
    n = F.when(F.col("a") == F.col("b"), F.expr("n_a * (n_a - 1) div 2")).otherwise(F.col("n_a") * F.col("n_b"))
    return met.withColumn("n", n).where("n > 0").select("c_nationkey", "a", "b", "n")


@query("SELECT DISTINCT s_suppkey, p_brand FROM supplier JOIN lineitem ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey")
def exploded_member_join(spark, sf_dir):
    """Explode an array column, then join on its elements."""
    sets = t(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.collect_set("l_partkey").alias("parts"))
    members = sets.select(F.col("l_suppkey").alias("s_suppkey"), F.explode("parts").alias("p_partkey"))
    return members.join(t(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey").join(t(spark, sf_dir, "part"), "p_partkey").select("s_suppkey", "p_brand").distinct()


def snapshots(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Customers with their last priority and their suppliers, over all orders and over those before 2000."""
    orders = t(spark, sf_dir, "orders")

    def shot(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("o_custkey").alias("author_id")).agg(F.max("o_orderpriority").alias("orcid"), F.min("o_orderpriority").alias("display_name"), F.collect_set("o_orderstatus").alias("alternates"))

    return shot(orders), shot(orders.where("o_orderdate < '2000-01-01'"))


SNAPSHOTS = "n AS (SELECT o_custkey AS author_id, max(o_orderpriority) AS orcid, min(o_orderpriority) AS display_name, list_sort(list_distinct(list(o_orderstatus))) AS alternates FROM orders GROUP BY 1), o AS (SELECT o_custkey AS author_id, max(o_orderpriority) AS orcid, min(o_orderpriority) AS display_name, list_sort(list_distinct(list(o_orderstatus))) AS alternates FROM orders WHERE o_orderdate < '2000-01-01' GROUP BY 1)"


@query(f"""WITH {SNAPSHOTS} SELECT n.author_id, CASE WHEN o.author_id IS NULL THEN 'created' WHEN n.orcid <> o.orcid OR n.display_name <> o.display_name OR n.alternates <> o.alternates THEN 'modified' ELSE 'unchanged' END AS change,
o.author_id IS NULL OR n.orcid <> o.orcid OR n.display_name <> o.display_name AS changed FROM n LEFT JOIN o USING (author_id)""")
def snapshot_diff(spark, sf_dir):
    new, old = snapshots(spark, sf_dir)
    return diff.snapshot_diff(new, old, "author_id", ["orcid", "display_name"], ["alternates"]).select("author_id", "change", "changed")


@query("SELECT DISTINCT o_custkey AS author_id FROM orders WHERE o_orderdate < '1997-01-01' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= '1997-01-01')")
def vanished_ids(spark, sf_dir):
    ids = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("author_id"), "o_orderdate")
    return diff.vanished(ids.where("o_orderdate >= '1997-01-01'"), ids.where("o_orderdate < '1997-01-01'"), "author_id")


@query("SELECT c_custkey, coalesce(p, c_mktsegment) AS c_mktsegment, greatest(c_acctbal, m) AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderpriority) AS p, max(o_totalprice) AS m FROM orders WHERE o_orderdate >= '2001-01-01' GROUP BY 1) ON o_custkey = c_custkey")
def upsert_update(spark, sf_dir):
    target = t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    recent = t(spark, sf_dir, "orders").where("o_orderdate >= '2001-01-01'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("c_mktsegment"), F.max("o_totalprice").alias("c_acctbal"))
    return diff.update_from(target, recent, "c_custkey", ["c_mktsegment", "c_acctbal"], ["c_acctbal"])


@query("SELECT s_suppkey AS k FROM supplier UNION SELECT o_custkey FROM orders")
def upsert_insert_missing(spark, sf_dir):
    return diff.insert_missing(t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")), t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), ["k"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def upsert_delete_in(spark, sf_dir):
    urgent = t(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return diff.delete_in(t(spark, sf_dir, "customer").select("c_custkey", "c_name"), urgent, ["c_custkey"])


@query("SELECT DISTINCT p_partkey, w AS name FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) WHERE trim(w) <> ''")
def upsert_unnest(spark, sf_dir):
    return diff.unnested(t(spark, sf_dir, "part").withColumn("ws", F.split("p_name", " ")), "p_partkey", "ws", "name").distinct()


@query("SELECT o_orderkey, CASE WHEN c_acctbal < 0 AND o_orderstatus <> 'F' THEN 5317838346 ELSE o_custkey END AS author_id FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def upsert_tombstone(spark, sf_dir):
    gone = t(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("author_id"))
    own = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("author_id"), "o_orderstatus")
    return diff.tombstoned(own, gone, "author_id", "author_id", only=F.col("o_orderstatus") != "F").select("o_orderkey", "author_id")


@query("SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def queue_inserts(spark, sf_dir):
    queued = t(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    return diff.queue_inserts(t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), queued).select("id")


STATE = "CASE WHEN f IS NOT NULL THEN 'finished' WHEN s IS NULL THEN 'waiting' WHEN s <= TIMESTAMP '1999-01-01' - INTERVAL 90 DAY THEN 'expired' ELSE 'leased' END"


@query(f"SELECT {STATE} AS state, count(*) AS n, CAST(min(s) AS DATE) AS oldest FROM (SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS TIMESTAMP) END AS s, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS TIMESTAMP) END AS f FROM orders) GROUP BY 1")
def queue_states(spark, sf_dir):
    """K8: rows of a work queue by state; a lease lasts 90 days."""
    day = F.col("o_orderdate").cast("timestamp_ntz")
    rows = t(spark, sf_dir, "orders").select(F.when(F.col("o_orderpriority") != "5-LOW", day).alias("started"), F.when(F.col("o_orderstatus") == "F", day).alias("finished"))
    return queue.states(rows, F.lit("1999-01-01").cast("timestamp_ntz"), F.expr("INTERVAL 90 DAY")).withColumn("oldest", F.col("oldest").cast("date"))


@query("SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey - 1 ELSE o_orderkey END AS target FROM orders")
def redirect_join(spark, sf_dir):
    own = works(spark, sf_dir)
    merges = own.where("merge_into_id is not null").select(F.col("paper_id").alias("merge_from_id"), F.col("merge_into_id").alias("merge_to_id"))
    moved = citations.redirected(own.select("paper_id", F.col("paper_id").alias("target")), merges, "target")
    return moved.select(F.col("paper_id").alias("o_orderkey"), "target")


@query("SELECT event_id, CAST(props->>'k' AS BIGINT) AS k, CASE WHEN CAST(props->>'k' AS BIGINT) % 2 = 0 THEN 2 ELSE 1 END AS n_ids FROM events")
def json_id_list(spark, sf_dir):
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    text = F.when(k % 2 == 0, F.concat(F.lit("["), k, F.lit(", -1]"))).otherwise(F.concat(F.lit("["), k, F.lit("]")))
    return t(spark, sf_dir, "events").select("event_id", k.alias("k"), F.size(columns.id_list(text)).alias("n_ids"))


RULES = [
    rules.Rule(("has_lower", " the "), (1,)),
    rules.Rule(("any", ["ción", "ñ"]), (2, 3)),
    rules.Rule(("all", ["sch", "ung"]), (4,), "german", 0),
    rules.Rule(("has", "keit"), (5,), "german", 1),
    rules.Rule(("and", ("word", "le"), ("not", ("has", "the"))), (6,)),
    rules.Rule(("regex", "[0-9]{3}-[0-9]{4}"), (7,)),
    rules.Rule(("or", ("word", "CRCA"), ("any_lower", ["license", "copyright"])), (8, -1)),
    rules.Rule(("replaced", {"-": " "}, "555 "), (9,)),
]
REWRITES = [
    rules.Rewrite(("and", ("id", 1), ("has_lower", "idiot")), (1,), (10,)),
    rules.Rewrite(("id", -1), (-1,), (11,)),
    rules.Rewrite(("and", ("id", 2), ("id", 3)), (3,)),
    rules.Rewrite(("and", ("id", 6), ("not", ("id", 7))), (6,)),
]
_HITS = " UNION ALL ".join(
    [f"SELECT doc_id, {i} AS id FROM documents WHERE {rules.sql(r.predicate)}" for r in RULES if r.group is None for i in r.emits]
    + [f"SELECT doc_id, 4 AS id FROM documents WHERE {rules.sql(RULES[2].predicate)}", f"SELECT doc_id, 5 AS id FROM documents WHERE {rules.sql(RULES[3].predicate)} AND NOT ({rules.sql(RULES[2].predicate)})"]
)
_MATCHED = f"h AS (SELECT doc_id, id FROM ({_HITS})), m AS (SELECT doc_id, text, coalesce(ids, []) AS ids FROM documents LEFT JOIN (SELECT doc_id, list(DISTINCT id) AS ids FROM h GROUP BY 1) USING (doc_id))"
_JOINED = "array_to_string(list_sort({}), ',')"


def rule_tables(spark) -> tuple[DataFrame, DataFrame]:
    """RULES and REWRITES as tables, as they would lie in a store."""
    given = [(json.dumps(r.predicate), list(r.emits), r.group, r.priority) for r in RULES]
    changes = [(k, json.dumps(r.predicate), list(r.removes), list(r.adds)) for k, r in enumerate(REWRITES)]
    return spark.createDataFrame(given, "predicate string, emits array<bigint>, group string, priority int"), spark.createDataFrame(changes, "position int, predicate string, removes array<bigint>, adds array<bigint>")


@query(f"WITH {_MATCHED} SELECT doc_id, {_JOINED.format('ids')} AS ids FROM m")
def rule_match(spark, sf_dir):
    return rules.matched(t(spark, sf_dir, "documents").select("doc_id", "text"), rules.read_rules(rule_tables(spark)[0])).select("doc_id", F.array_join("ids", ",").alias("ids"))


_ABC = "chr(97 + k % 26) || chr(97 + k // 26 % 26) || chr(97 + k // 7 % 26)"


@query(f"""WITH r AS (SELECT k, {_ABC} AS p, chr(97 + k * 5 % 26) AS z FROM (SELECT CAST(k AS INT) AS k FROM range(1200) t(k))), d AS (SELECT doc_id, text, lower(text) AS low FROM documents),
v AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+')) AS p FROM d),
h AS (SELECT doc_id, k % 400 AS id FROM d JOIN r ON k % 3 = 0 AND contains(low, p) UNION ALL SELECT doc_id, k % 400 FROM d JOIN r ON k % 3 = 1 AND contains(text, p) AND NOT contains(text, z || ' ')
  UNION ALL SELECT doc_id, k % 400 FROM v JOIN r USING (p) WHERE k % 3 = 2),
m AS (SELECT doc_id, list(DISTINCT id) AS ids FROM h GROUP BY 1),
w AS (SELECT doc_id, CASE WHEN ids IS NULL THEN [-1] ELSE list_sort(list_distinct(list_transform(ids, lambda x: CASE WHEN x % 2 = 0 THEN x + 1000 ELSE x END))) END AS ids FROM d LEFT JOIN m USING (doc_id))
SELECT doc_id, array_to_string(ids, ',') AS ids FROM w""")
def rule_table(spark, sf_dir):
    """1,200 rules and 200 rewrites, read from tables with JSON predicates."""
    letters = lambda k: chr(97 + k % 26) + chr(97 + k // 26 % 26) + chr(97 + k // 7 % 26)
    kinds = (lambda k, p: ["has_lower", p], lambda k, p: ["and", ["has", p], ["not", ["has", chr(97 + k * 5 % 26) + " "]]], lambda k, p: ["word", p])
    given = spark.createDataFrame([(json.dumps(kinds[k % 3](k, letters(k))), [k % 400], None, 0) for k in range(1200)], "predicate string, emits array<bigint>, group string, priority int")
    changes = spark.createDataFrame([(k, json.dumps(["id", k]), [k], [k + 1000]) for k in range(0, 400, 2)], "position int, predicate string, removes array<bigint>, adds array<bigint>")
    found = rules.matched(t(spark, sf_dir, "documents").select("doc_id", "text"), rules.read_rules(given))
    return rules.rewritten(found, rules.read_rewrites(changes)).select("doc_id", F.array_join("ids", ",").alias("ids"))


_REWRITTEN = f"""{_MATCHED},
a AS (SELECT doc_id, CASE WHEN list_contains(ids, 1) AND contains(lower(text), 'idiot') THEN list_append(list_filter(ids, lambda x: x <> 1), 10) ELSE ids END AS ids FROM m),
b AS (SELECT doc_id, CASE WHEN list_contains(ids, -1) THEN list_append(list_filter(ids, lambda x: x <> -1), 11) ELSE ids END AS ids FROM a),
c AS (SELECT doc_id, CASE WHEN list_contains(ids, 2) AND list_contains(ids, 3) THEN list_filter(ids, lambda x: x <> 3) ELSE ids END AS ids FROM b),
d AS (SELECT doc_id, CASE WHEN list_contains(ids, 6) AND NOT list_contains(ids, 7) THEN list_filter(ids, lambda x: x <> 6) ELSE ids END AS ids FROM c),
w AS (SELECT doc_id, CASE WHEN len(ids) = 0 THEN [-1] ELSE ids END AS ids FROM d)"""


@query(f"WITH {_REWRITTEN} SELECT doc_id, {_JOINED.format('ids')} AS ids FROM w")
def rule_rewrite(spark, sf_dir):
    given, changes = rule_tables(spark)
    found = rules.matched(t(spark, sf_dir, "documents").select("doc_id", "text"), rules.read_rules(given))
    return rules.rewritten(found, rules.read_rewrites(changes)).select("doc_id", F.array_join("ids", ",").alias("ids"))


@query("""WITH u AS (SELECT text, min(doc_id) % 5 AS k, min(doc_id) % 7 AS m FROM documents GROUP BY 1),
c AS (SELECT text, CASE WHEN m = 0 THEN [7] WHEN m = 1 THEN [-1] ELSE [k] END AS old FROM u),
f AS (SELECT text, list_filter(old, lambda x: x <> -1) AS old, CASE WHEN contains(lower(text), ' the ') THEN [99] ELSE [] END AS found FROM c),
n AS (SELECT text, old, list_distinct(list_concat(old, found)) AS ids FROM f),
r AS (SELECT text, old, CASE WHEN list_contains(ids, 99) AND contains(text, 'ing') THEN list_append(list_filter(ids, lambda x: x <> 99), 98) ELSE ids END AS ids FROM n),
w AS (SELECT text, CASE WHEN len(old) = 0 THEN [-1] ELSE old END AS old, CASE WHEN len(ids) = 0 THEN [-1] ELSE ids END AS ids FROM r)
SELECT text, array_to_string(list_sort(old), ',') AS old_ids, array_to_string(list_sort(ids), ',') AS new_ids FROM w WHERE list_sort(old) <> list_sort(ids)""")
def affiliation_refresh(spark, sf_dir):
    own = t(spark, sf_dir, "documents").groupBy("text").agg((F.min("doc_id") % 5).alias("k"), (F.min("doc_id") % 7).alias("m"))
    override = F.when(F.col("m") == 0, "[-1, 7]").when(F.col("m") == 1, "[-1]").otherwise("[]")
    strings = own.select(F.col("text").alias("original_affiliation"), F.concat(F.lit("["), "k", F.lit("]")).alias("affiliation_ids"), override.alias("affiliation_ids_override"))
    change = rules.Rewrite(("and", ("id", 99), ("has", "ing")), (99,), (98,))
    done = rules.refreshed(strings, [rules.Rule(("has_lower", " the "), (99,))], [change])
    return done.select(F.col("original_affiliation").alias("text"), F.array_join("old_ids", ",").alias("old_ids"), F.array_join("new_ids", ",").alias("new_ids"))


@query("""WITH a AS (SELECT trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(text, '&NA;', ''), '[0-9*#@$%^+=~_!?:;"<>/|]', ' ', 'g'), '[\\[\\](){}\\\\]', '', 'g'), '^[\\s.,''-]+', ''), '\\s+', ' ', 'g'), ' ') AS s, doc_id FROM documents)
SELECT doc_id, length(s) AS n, md5(s) AS h FROM a""")
def name_clean(spark, sf_dir):
    own = t(spark, sf_dir, "documents").select("doc_id", names.cleaned(F.col("text")).alias("s"))
    return own.select("doc_id", F.length("s").cast("bigint").alias("n"), F.md5("s").alias("h"))


def people(spark, sf_dir) -> DataFrame:
    """(p_partkey, p_brand, raw): part names as personal names in five ways of writing."""
    first, last = F.split("p_name", " ")[0], F.split("p_name", " ")[1]
    initial, middle = F.upper(F.left(first, F.lit(1))), F.upper(F.left("p_type", F.lit(1)))
    f, x = F.initcap(first), F.initcap(last)
    way = F.col("p_partkey") % 5
    raw = F.when(way == 0, F.concat_ws(" ", f, x)).when(way == 1, F.concat(x, F.lit(", "), f)).when(way == 2, F.concat(initial, F.lit(". "), x))
    raw = raw.when(way == 3, F.concat_ws(" ", x, initial)).otherwise(F.concat(F.lit("Dr. "), f, F.lit(" "), middle, F.lit(". "), x))
    return t(spark, sf_dir, "part").select("p_partkey", "p_brand", raw.alias("raw"))


PEOPLE = """p AS (SELECT p_partkey, p_brand, p_partkey % 5 AS way, string_split(p_name, ' ')[1] AS f, string_split(p_name, ' ')[2] AS x, lower(p_type[1]) AS m FROM part),
n0 AS (SELECT *, CASE WHEN way IN (2, 3) THEN f[1] ELSE f END AS g, CASE WHEN way = 4 THEN m ELSE '' END AS mid FROM p),
s AS (SELECT p_partkey, p_brand, way, m, mid, CASE WHEN short THEN x ELSE f END AS f, CASE WHEN short THEN x ELSE g END AS g, CASE WHEN short THEN f[1] ELSE x END AS x FROM (SELECT *, way = 3 AND length(x) <= 3 AS short FROM n0)),
n AS (SELECT *, CASE WHEN mid = '' THEN g || ' ' || x ELSE g || ' ' || mid || ' ' || x END AS search FROM s)"""


@query(f"WITH {PEOPLE} SELECT p_partkey, search, x AS block, f[1] AS letter FROM n")
def search_name(spark, sf_dir):
    own = people(spark, sf_dir).select("p_partkey", names.search_form_of(names.parsed_of("raw")).alias("search"))
    return own.select("p_partkey", "search", names.block_of(F.col("search")).alias("block"), names.letter_of(F.col("search")).alias("letter"))


@query("SELECT doc_id, NOT regexp_matches(text, '[\\p{Han}\\p{Hangul}\\p{Hiragana}\\p{Katakana}\\p{Cyrillic}\\p{Arabic}\\p{Hebrew}\\p{Thai}\\p{Greek}\\p{Devanagari}]') AS latin FROM documents")
def script_filter(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", names.keeps_script(F.col("text")).alias("latin"))


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 1 THEN 'CJK' WHEN 2 THEN 'CYRILLIC' WHEN 3 THEN 'ARABIC,GREEK' ELSE '' END AS scripts, p_partkey % 5 IN (0, 4) AS kept FROM part")
def name_scripts(spark, sf_dir):
    """Scripts of names that are not Latin, and whether the name is matched at all."""
    way = F.col("p_partkey") % 5
    tail = F.when(way == 1, " 李").when(way == 2, " Иван").when(way == 3, " علي Νίκος").when(way == 4, " Ørsted-Ñandú 3").otherwise("")
    own = t(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", tail).alias("name"))
    return own.select("p_partkey", F.array_join(names.scripts_of("name"), ",").alias("scripts"), names.keeps_script(F.col("name")).alias("kept"))


@query(f"WITH {PEOPLE} SELECT p_partkey, CASE WHEN length(g) > 1 THEN g ELSE '' END AS first, f[1] AS first_initials, mid AS middle1_initials, CASE WHEN length(x) > 1 THEN x ELSE '' END AS last, x[1] AS last_initials FROM n")
def name_slots(spark, sf_dir):
    own = people(spark, sf_dir).select("p_partkey", names.slots_of(names.search_form_of(names.parsed_of("raw"))).alias("s"))
    return own.select("p_partkey", *[F.array_join(f"s.{k}", "|").alias(k) for k in ("first", "first_initials", "middle1_initials", "last", "last_initials")])


@query(f"""WITH {PEOPLE}, d AS (SELECT DISTINCT search, g, mid, x, f[1] AS l FROM n)
SELECT a.search AS a, b.search AS b FROM d a JOIN d b ON a.x = b.x AND a.l = b.l AND a.search <= b.search
WHERE (a.g = b.g OR length(a.g) = 1 OR length(b.g) = 1) AND (a.mid = '' OR b.mid = '' OR a.mid = b.mid)""")
def blocked_match(spark, sf_dir):
    """Different names that are compatible, inside a block of last word and first letter; parts are taken once a name."""
    own = people(spark, sf_dir).select(names.search_form_of(names.parsed_of("raw")).alias("s")).distinct()
    parts = own.select("s", names.slots_of("s").alias("slots"), F.split("s", " ").alias("words"), names.block_of(F.col("s")).alias("block"), names.letter_of(F.col("s")).alias("letter"))
    side = lambda c: parts.select("block", "letter", F.col("s").alias(c), F.col("slots").alias(f"{c}_slots"), F.col("words").alias(f"{c}_slots_words"))
    met = side("a").join(side("b"), ["block", "letter"]).where("a <= b")
    return met.where(names.slots_match("a_slots", "b_slots")).select("a", "b")


@query(f"""WITH {PEOPLE}, o AS (SELECT *, p_partkey % 500 AS author_id, f[1] AS l FROM n WHERE p_partkey % 3 > 0), d AS (SELECT DISTINCT search, g, mid, x, f[1] AS l FROM n),
a AS (SELECT author_id, list(DISTINCT g) FILTER (length(g) > 1) AS firsts, list(DISTINCT l) AS initials, list(DISTINCT mid) FILTER (mid <> '') AS mids FROM o GROUP BY 1),
b AS (SELECT DISTINCT d.search, d.g, d.mid, d.l, author_id FROM d JOIN o USING (x, l))
SELECT search AS author_1, author_id FROM b JOIN a USING (author_id)
WHERE CASE WHEN length(g) > 1 AND firsts IS NOT NULL THEN list_contains(firsts, g) ELSE list_contains(initials, l) END AND (mid = '' OR mids IS NULL OR list_contains(mids, mid))""")
def merged_block_match(spark, sf_dir):
    """Names against authors whose names are merged into one structure, inside blocks."""
    own = people(spark, sf_dir).select("p_partkey", names.search_form_of(names.parsed_of("raw")).alias("author"))
    known = own.where("p_partkey % 3 > 0").select((F.col("p_partkey") % 500).alias("author_id"), "author")
    return assign.block_matches(own.select(F.col("author").alias("author_1")).distinct(), known.distinct())


@query("""WITH p AS (SELECT p_partkey, p_partkey % 6 AS way, upper(p_name[1]) || string_split(p_name, ' ')[1][2:] AS f, upper(string_split(p_name, ' ')[2][1]) || string_split(p_name, ' ')[2][2:] AS x FROM part)
SELECT p_partkey, CASE WHEN way = 4 THEN 'Prof.' ELSE '' END AS title, f AS first, CASE WHEN way IN (1, 5) THEN 'M.' ELSE '' END AS middle,
  CASE way WHEN 2 THEN 'van der ' || x WHEN 3 THEN x || ' y ' || f ELSE x END AS last, CASE WHEN way = 0 THEN 'Jr.' WHEN way = 1 THEN 'PhD' WHEN way = 5 THEN 'III' ELSE '' END AS suffix,
  lower(f || CASE WHEN way IN (1, 5) THEN ' m' ELSE '' END || ' ' || CASE way WHEN 2 THEN 'van der ' || x WHEN 3 THEN x || ' y ' || f ELSE x END) AS search FROM p""")
def name_parts(spark, sf_dir):
    """Titles, particles, conjunctions and suffixes in six ways of writing."""
    f, x, way = F.initcap(F.split("p_name", " ")[0]), F.initcap(F.split("p_name", " ")[1]), F.col("p_partkey") % 6
    c = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    raw = F.when(way == 0, c(x, ", ", f, ", Jr.")).when(way == 1, c(f, " M. ", x, ", PhD")).when(way == 2, c(f, " van der ", x)).when(way == 3, c(f, " ", x, " y ", f)).when(way == 4, c("Prof. ", f, " ", x)).otherwise(c(x, ", ", f, " M. III"))
    own = t(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"))
    parts = own.select("p_partkey", names.parts_of("raw").alias("p"), names.search_form_of(names.parsed_of("raw")).alias("search"))
    return parts.select("p_partkey", *[F.col(f"p.{k}").alias(k) for k in names.PARTS], "search")


@query("""WITH n AS (SELECT p_brand, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) WHEN p_partkey % 7 = 0 THEN p_name || '.' ELSE p_name END AS name FROM part),
c AS (SELECT p_brand, name, count(*) AS k FROM n GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY k DESC, length(name) DESC, name DESC) AS rn FROM c),
v AS (SELECT p_brand, count(DISTINCT lower(replace(name, '.', ''))) AS n_alternates FROM c GROUP BY 1)
SELECT p_brand, name AS display_name, n_alternates FROM r JOIN v USING (p_brand) WHERE rn = 1""")
def display_name(spark, sf_dir):
    name = F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).when(F.col("p_partkey") % 7 == 0, F.concat("p_name", F.lit("."))).otherwise(F.col("p_name"))
    parts = t(spark, sf_dir, "part").select("p_brand", name.alias("name"))
    n = names.alternates(parts, "p_brand", "name").groupBy("p_brand").agg(F.count("*").alias("n_alternates"))
    return names.display_names(parts, "p_brand", "name").join(n, "p_brand")


EVIDENCE = """CAST(q = x AS INT) AS family, CAST(q = x AND way NOT IN (2, 3) AND h = f AS INT) AS given,
CAST(q = x AND CASE WHEN way IN (2, 3) THEN h[1] = f[1] WHEN way = 4 THEN h <> f AND h[1] = m ELSE false END AS INT) AS initials"""


@query(f"WITH {PEOPLE}, e AS (SELECT *, CASE WHEN p_partkey % 4 = 0 THEN 'ring' ELSE x END AS q, CASE WHEN p_partkey % 3 = 0 THEN 'small' ELSE f END AS h FROM n0), r AS (SELECT p_partkey, {EVIDENCE} FROM e) SELECT p_partkey, CAST(family AS DOUBLE) AS family, CAST(given AS DOUBLE) AS given, CAST(initials AS DOUBLE) AS initials FROM r")
def name_evidence(spark, sf_dir):
    own = people(spark, sf_dir).join(t(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey")
    given = F.when(F.col("p_partkey") % 3 == 0, "small").otherwise(F.split("p_name", " ")[0])
    family = F.when(F.col("p_partkey") % 4 == 0, "ring").otherwise(F.split("p_name", " ")[1])
    e = own.select("p_partkey", names.evidence_of("raw", F.array(F.initcap(given)), F.array(F.initcap(family))).alias("e"))
    return e.select("p_partkey", *[F.get("e", F.lit(i)).alias(c) for i, c in enumerate(("family", "given", "initials"))])


@query(f"""WITH {PEOPLE}, c AS (SELECT DISTINCT l_orderkey AS paper_id, l_linenumber AS author_sequence_number, n0.*, CASE WHEN l_quantity < 25 THEN f || ' ' || x ELSE 'small ring' END AS orcid FROM lineitem JOIN n0 ON p_partkey = l_partkey),
e AS (SELECT *, string_split(orcid, ' ')[2] AS q, string_split(orcid, ' ')[1] AS h FROM c),
y AS (SELECT paper_id, author_sequence_number, orcid, {EVIDENCE} FROM e),
k AS (SELECT *, dense_rank() OVER (PARTITION BY paper_id, orcid ORDER BY family DESC, given DESC, initials DESC) AS r FROM y WHERE family > 0 AND (given > 0 OR initials > 0)),
b AS (SELECT DISTINCT paper_id, orcid, author_sequence_number FROM k WHERE r = 1),
u AS (SELECT *, count(*) OVER (PARTITION BY paper_id, orcid) AS same FROM b)
SELECT paper_id, author_sequence_number, orcid FROM u WHERE same = 1""")
def registry_reconcile(spark, sf_dir):
    """Claims of identifiers that the registry's name supports best, on one authorship of a work only."""
    own = people(spark, sf_dir).join(t(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey")
    lines = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").join(own, F.col("l_partkey") == F.col("p_partkey"))
    orcid = F.when(F.col("l_quantity") < 25, F.col("p_name")).otherwise(F.lit("small ring"))
    claims = lines.select(F.col("l_orderkey").alias("paper_id"), F.col("l_linenumber").alias("author_sequence_number"), F.col("raw").alias("original_author"), orcid.alias("orcid"))
    registry = t(spark, sf_dir, "part").select(F.col("p_name").alias("orcid"), F.split("p_name", " ")[0].alias("given_names"), F.split("p_name", " ")[1].alias("family_name")).distinct()
    return identifiers.reconciled(claims, registry)


@query("""WITH e AS (SELECT event_id, event_id % 4 AS a, user_id % 3 AS b, lpad(CAST(user_id AS VARCHAR), 19, '0') AS id FROM events)
SELECT event_id, CASE WHEN a = 0 THEN id WHEN b = 0 THEN id WHEN a = 1 THEN '' ELSE id END AS orcid FROM e""")
def identifier_priority(spark, sf_dir):
    """The user's identifier, else the harvested, else the source's; bare or as an address."""
    a, b, own = F.col("event_id") % 4, F.col("user_id") % 3, F.lpad(F.col("user_id").cast("string"), 19, "0")
    user = F.when(a == 0, F.concat(F.lit("https://orcid.org/"), own)).otherwise(F.lit("no identifier"))
    return t(spark, sf_dir, "events").select("event_id", identifiers.chosen_identifier(user, F.when(b == 0, own), F.when(a == 1, F.lit(None)).otherwise(own)).alias("orcid"))


@query("""WITH c AS (SELECT DISTINCT user_id AS paper_id, event_type AS orcid, event_id % 10 AS author_sequence_number, value FROM events),
k AS (SELECT *, dense_rank() OVER (PARTITION BY paper_id, orcid ORDER BY value DESC) AS r FROM c),
n AS (SELECT *, count(*) OVER (PARTITION BY paper_id, orcid) AS same FROM (SELECT DISTINCT paper_id, orcid, author_sequence_number FROM k WHERE r = 1))
SELECT paper_id, orcid, author_sequence_number FROM n WHERE same = 1""")
def identifier_reconcile(spark, sf_dir):
    claims = t(spark, sf_dir, "events").select(F.col("user_id").alias("paper_id"), F.col("event_type").alias("orcid"), (F.col("event_id") % 10).alias("author_sequence_number"), "value").distinct()
    best = identifiers.uniquely_best(claims, ["paper_id", "orcid"], [F.desc("value")], "author_sequence_number")
    return best.select("paper_id", "orcid", "author_sequence_number").distinct()


def authorships(spark, sf_dir) -> DataFrame:
    """Orders as authorships of their customers, with feature sets."""
    own = t(spark, sf_dir, "orders").join(t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = own.join(line_sets(spark, sf_dir), F.col("work") == F.col("o_orderkey"))
    return rows.select(
        F.concat_ws("_", "o_orderkey", F.lit("1")).alias("work_author_id"), F.col("o_orderkey").alias("paper_id"), F.col("o_custkey").alias("author_id"), F.lower(F.concat_ws(" ", "c_mktsegment", F.translate(F.col("c_nationkey").cast("string"), "0123456789", "abcdefghij"), F.col("o_orderstatus"), F.lit("author"))).alias("author"), F.lit("").alias("orcid"),
        "institutions", F.col("coauthors").cast("array<string>").alias("coauthors"), F.array().cast("array<bigint>").alias("concepts"), "citations", "o_orderdate", "o_orderpriority", "c_acctbal",
    )


def cascade_input(spark, sf_dir) -> dict[str, DataFrame]:
    """Authorships of all orders; those of 2001 on have no author yet, but for some that are asked for."""
    known = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    facts = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("paper_id"), "o_custkey", "o_orderdate", "o_totalprice").join(known, "o_custkey")
    listed = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("paper_id"), "l_partkey").join(t(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_semi")
    base = stages.staged(facts.join(listed, "paper_id", "left_semi"), "cascade_input")  # read by every part, so joined once and without the sets
    own = base.join(work_sets(spark, sf_dir), "paper_id")
    key = F.concat_ws("_", "paper_id", F.lit("1"))
    name = F.concat_ws(" ", F.when(F.col("paper_id") % 3 == 0, F.left("c_mktsegment", F.lit(1))).otherwise(F.initcap("c_mktsegment")), F.translate((F.col("o_custkey") % 400).cast("string"), "0123456789", "abcdefghij"))
    author = F.when(F.col("paper_id") % 97 == 0, "None").otherwise(name)
    orcid = F.when(F.col("o_totalprice") > 450_000, F.concat(F.lit("o"), F.col("o_custkey"))).otherwise("")
    works_ = own.select(key.alias("work_author_id"), "paper_id", author.alias("author"), orcid.alias("orcid"), "institutions", "coauthors", "concepts", "citations")
    old = base.where("o_orderdate < '2001-01-01'")
    merges = old.where("o_custkey % 50 = 7").select(F.col("o_custkey").alias("merge_from_id"), (F.col("o_custkey") + 1).alias("merge_to_id")).distinct()
    return {
        "works": works_,
        "current": old.select(key.alias("work_author_id"), F.col("o_custkey").alias("author_id")),
        "requests": old.where("paper_id % 211 = 5").select(key.alias("work_author_id"), (F.col("o_custkey") + 3).alias("new_author_id"), F.col("o_orderdate").alias("request_date")),
        "merges": merges,
        "frozen": base.where("c_acctbal < 0").select(F.col("o_custkey").alias("author_id")).distinct(),
        "removed": old.where("paper_id % 173 = 2").select("paper_id", F.col("o_custkey").alias("author_id")),
        "splits": old.where("paper_id % 307 = 11").select(F.concat(F.lit("r"), F.col("o_custkey")).alias("request"), key.alias("work_author_id")),
    }


@query()
def cascade_assign(spark, sf_dir):
    """Every round of the cascade, compared with a plain version in the tests."""
    given = cascade_input(spark, sf_dir)
    return assign.disambiguated(given.pop("works"), given.pop("current"), 5_000_000_000, **given)


_NAMED = """a AS (SELECT o_orderkey AS p, o_custkey AS author_id, CASE WHEN o_totalprice > 450000 THEN 'o' || o_custkey ELSE '' END AS orcid,
  CASE WHEN o_orderkey % 97 = 0 THEN 'None' ELSE (CASE WHEN o_orderkey % 3 = 0 THEN c_mktsegment[1] ELSE c_mktsegment[1] || lower(c_mktsegment[2:]) END) || ' ' || translate(CAST(o_custkey % 400 AS VARCHAR), '0123456789', 'abcdefghij') END AS raw
  FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate < '2001-01-01' AND o_orderkey IN (SELECT l_orderkey FROM lineitem)),
n AS (SELECT author_id, orcid, CASE WHEN p % 4 = 1 THEN replace(raw, 'u', 'ü') ELSE raw END AS author FROM a)"""


@query(f"""WITH {_NAMED},
c AS (SELECT author_id, author, count(*) AS k, replace(author, 'ü', 'u') AS folded FROM n GROUP BY ALL),
b AS (SELECT author_id, folded FROM (SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY contains(author, ' ') DESC, k DESC, length(author) DESC, author DESC) AS rn FROM c) WHERE rn = 1),
s AS (SELECT author_id, author FROM (SELECT c.*, row_number() OVER (PARTITION BY author_id ORDER BY length(author) - length(replace(author, 'ü', '')) DESC, k DESC, author DESC) AS rn FROM c JOIN b USING (author_id, folded)) WHERE rn = 1),
q AS (SELECT user_id AS author_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) AS rn FROM events WHERE user_id % 10 = 3) WHERE rn = 1),
o AS (SELECT author_id, coalesce(min(CASE WHEN orcid <> '' THEN orcid END), '') AS orcid, count(*) AS n_works, array_to_string(list_sort(list(DISTINCT author)), '|') AS alternates FROM n GROUP BY 1)
SELECT author_id, orcid, coalesce(event_type, author) AS display_name, alternates, n_works FROM o JOIN s USING (author_id) LEFT JOIN q USING (author_id)""")
def author_table(spark, sf_dir):
    """The author table over the current authorships, with variants by diacritics and curated display names."""
    given = cascade_input(spark, sf_dir)
    name = F.when(F.col("paper_id") % 4 == 1, F.replace("author", F.lit("u"), F.lit("ü"))).otherwise(F.col("author"))
    asked = t(spark, sf_dir, "events").where("user_id % 10 = 3").select(F.col("user_id").alias("author_id"), F.col("event_type").alias("display_name"), F.col("ts").alias("request_date"))
    found = authors.table(authors.counted(given["current"], given["works"].withColumn("author", name)), asked)
    return found.withColumn("alternates", F.array_join("alternates", "|"))


@query("""WITH n AS (SELECT o_orderkey || '_1' AS w, o_custkey AS author_id FROM orders WHERE o_orderdate >= '1997-01-01'), x AS (SELECT o_orderkey || '_1' AS w, CASE WHEN o_orderkey % 7 = 0 THEN o_custkey + 1 ELSE o_custkey END AS old_author_id FROM orders WHERE o_orderdate < '2000-01-01')
SELECT w AS work_author_id, author_id, old_author_id, coalesce(old_author_id <> author_id, false) AS id_changed FROM n LEFT JOIN x USING (w)""")
def author_id_changes(spark, sf_dir):
    """Which authorships have another author than before."""
    own = t(spark, sf_dir, "orders").select(F.concat_ws("_", "o_orderkey", F.lit("1")).alias("work_author_id"), F.col("o_custkey").alias("author_id"), "o_orderdate", "o_orderkey")
    old = own.where("o_orderdate < '2000-01-01'").withColumn("author_id", F.when(F.col("o_orderkey") % 7 == 0, F.col("author_id") + 1).otherwise(F.col("author_id")))
    return authors.id_changes(own.where("o_orderdate >= '1997-01-01'"), old)


@query(f"""WITH {SNAPSHOTS}, d AS (SELECT n.author_id, CASE WHEN o.author_id IS NULL THEN 'created' WHEN n.orcid <> o.orcid OR n.display_name <> o.display_name OR n.alternates <> o.alternates THEN 'modified' ELSE 'unchanged' END AS change FROM n LEFT JOIN o USING (author_id))
SELECT author_id, change, CASE WHEN change = 'created' THEN DATE '2002-01-01' ELSE DATE '1990-01-01' + CAST(author_id % 1000 AS INT) END AS created_date, CASE WHEN change = 'unchanged' THEN DATE '1995-01-01' ELSE DATE '2002-01-01' END AS modified_date FROM d""")
def dated_snapshot(spark, sf_dir):
    """Created and modified dates carried from one snapshot to the next."""
    new, old = snapshots(spark, sf_dir)
    before = old.withColumn("created_date", F.date_add(F.lit("1990-01-01").cast("date"), (F.col("author_id") % 1000).cast("int"))).withColumn("modified_date", F.lit("1995-01-01").cast("date"))
    return authors.dated(new, before, F.lit("2002-01-01").cast("date")).select("author_id", "change", "created_date", "modified_date")


def overmerged_works(spark, sf_dir, written: bool = False) -> DataFrame:
    """Authorships with identifiers by priority. ``written``: their rows are a stage first, without the sets that are empty here."""
    rows = authorships(spark, sf_dir).select("author_id", "work_author_id", "author", "o_orderpriority", "c_acctbal", "institutions", "coauthors", "citations")
    rows = (stages.staged(rows, "works") if written else rows).withColumn("concepts", F.array().cast("array<bigint>"))
    orcid = F.when(F.col("o_orderpriority") == "1-URGENT", "A").when(F.col("o_orderpriority") == "2-HIGH", "B").otherwise("")
    no_longs, no_texts = F.array().cast("array<bigint>"), F.array().cast("array<string>")
    return rows.select("author_id", "work_author_id", "c_acctbal", orcid.alias("orcid"), F.col("author").alias("name"), "institutions", "coauthors", "concepts", "citations", no_texts.alias("coauthor_orcids"), no_longs.alias("topics"), no_longs.alias("subfields"), no_longs.alias("fields"))


@query()
@stages.releasing
def overmerge_split(spark, sf_dir):
    works_ = overmerged_works(spark, sf_dir, written=True)  # read for the frozen, the over-merged and their works, so the sets are made once
    frozen = works_.where("c_acctbal < 0").select("author_id")
    return identifiers.reassigned(works_.drop("c_acctbal"), frozen)


@query()
def leftover_groups(spark, sf_dir):
    return identifiers.leftover_groups(overmerged_works(spark, sf_dir).where("orcid = ''"))


WINNERS = "m AS (SELECT o_custkey AS author_id, c_mktsegment || c_nationkey AS orcid, c_acctbal < 0 AS frozen FROM orders JOIN customer ON o_custkey = c_custkey), s AS (SELECT orcid, author_id, frozen, count(*) AS n FROM m GROUP BY ALL)"


@query(f"WITH {WINNERS}, w AS (SELECT author_id, first(author_id) OVER (PARTITION BY orcid ORDER BY frozen DESC, n DESC, author_id) AS winner_id FROM s) SELECT * FROM w WHERE author_id <> winner_id")
def identifier_winners(spark, sf_dir):
    own = t(spark, sf_dir, "orders").join(t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    members = own.select(F.col("o_custkey").alias("author_id"), F.concat("c_mktsegment", "c_nationkey").alias("orcid"), "c_acctbal")
    return assign.identifier_winners(members, members.where("c_acctbal < 0").select("author_id"))


@query("SELECT CASE WHEN c_acctbal < 0 THEN o_orderkey ELSE c_custkey END AS merge_from_id, CASE WHEN c_acctbal < 0 THEN c_custkey ELSE o_orderkey END AS merge_to_id FROM orders JOIN customer ON o_custkey = c_custkey")
def merge_map(spark, sf_dir):
    merges = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("merge_from_id"), F.col("o_orderkey").alias("merge_to_id"))
    return assign.merge_map(merges, t(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("author_id")))


@query()
def sample_input(spark, sf_dir):
    return tables.sample(t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 1000)


@query("SELECT 'rows' AS name, count(*) AS value FROM orders UNION ALL SELECT 'open', count(*) FILTER (o_orderstatus = 'O') FROM orders UNION ALL SELECT 'large', count(*) FILTER (o_totalprice > 100000) FROM orders")
def run_statistics(spark, sf_dir):
    from biblioflow.sources import sinks

    return sinks.statistics(t(spark, sf_dir, "orders"), open=F.col("o_orderstatus") == "O", large=F.col("o_totalprice") > 100000)


@query("""WITH w AS (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT'),
l AS (SELECT l_orderkey AS p, l_linenumber AS q, l_suppkey, l_partkey, l_quantity, CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey ELSE -1 END AS a, p_name FROM lineitem JOIN part ON p_partkey = l_partkey JOIN w ON o_orderkey = l_orderkey),
o AS (SELECT p, q, arg_max(p_name, struct_pack(n := length(p_name), s := p_name)) AS author, coalesce(min(CASE WHEN l_quantity > 40 THEN 'o' || l_suppkey END), '') AS orcid, list_sort(list_distinct(list(l_suppkey))) AS i, max(a) AS a FROM l GROUP BY ALL),
e AS (SELECT p, list_sort(list_distinct(list(author))) AS c FROM o GROUP BY 1),
k AS (SELECT l_orderkey AS p, list_sort(list_distinct(list(l_partkey % 60))) AS k FROM lineitem WHERE l_discount * 10 > 0.3 GROUP BY 1),
r AS (SELECT l_orderkey AS p, list_sort(list_distinct(list(l_partkey * 7 + l_suppkey))) AS r FROM lineitem GROUP BY 1)
SELECT p || '_' || q AS work_author_id, author AS original_author, orcid, array_to_string(i, ',') AS institutions, coalesce(array_to_string(k, ','), '') AS concepts, array_to_string(r, ',') AS citations, array_to_string(list_filter(c, lambda x: x <> author), ',') AS coauthors
FROM o JOIN e USING (p) LEFT JOIN k USING (p) LEFT JOIN r USING (p) WHERE a = -1""")
def disambiguation_input(spark, sf_dir):
    """One row an authorship without an author, with its paper's concepts, references and coauthors."""
    lines = t(spark, sf_dir, "lineitem").join(t(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    author = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_suppkey")).otherwise(F.lit(-1))
    orcid = F.when(F.col("l_quantity") > 40, F.concat(F.lit("o"), "l_suppkey")).otherwise("")
    affiliations = lines.select(F.col("l_orderkey").alias("paper_id"), author.alias("author_id"), F.col("l_suppkey").alias("affiliation_id"), F.col("l_linenumber").alias("author_sequence_number"), F.col("p_name").alias("original_author"), orcid.alias("original_orcid"))
    own = works(spark, sf_dir).withColumn("created_date", F.to_timestamp("publication_date"))
    concepts = lines.select(F.col("l_orderkey").alias("paper_id"), (F.col("l_partkey") % 60).alias("field_of_study"), (F.col("l_discount") * 10).alias("score"))
    rows = assign.disambiguation_input(affiliations, own, concepts, references(spark, sf_dir))
    return rows.select("work_author_id", "original_author", "orcid", *[F.array_join(c, ",").alias(c) for c in ("institutions", "concepts", "citations", "coauthors")])
