"""Merge-aware citation edges, field-weighted citation impact and normalized citation percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblioflow.functions.columns import clamp, newest

#: Work types for which an impact is published.
IMPACT_TYPES = ("article", "conference_article", "book", "review", "book-chapter")


def redirected(df: DataFrame, merges: DataFrame, column: str, source: str = "merge_from_id", target: str = "merge_to_id") -> DataFrame:
    """``column`` replaced by its merge target where it has one, one level deep."""
    m = merges.select(F.col(source).alias("_from"), F.col(target).alias("_to"))
    return df.join(m, F.col(column) == F.col("_from"), "left").withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")


def citation_edges(citations: DataFrame, works: DataFrame) -> DataFrame:
    """Distinct (citing, cited) after merging both ends; an end without a work drops its edge.

    citations: paper_id, paper_reference_id; works: paper_id, merge_into_id.
    """
    target = works.select("paper_id", F.coalesce("merge_into_id", "paper_id").alias("live"))
    citing = target.select(F.col("paper_id").alias("paper_id"), F.col("live").alias("citing"))
    cited = target.select(F.col("paper_id").alias("paper_reference_id"), F.col("live").alias("cited"))
    return citations.select("paper_id", "paper_reference_id").distinct().join(citing, "paper_id").join(cited, "paper_reference_id").select("citing", "cited").distinct()


def dated_edges(edges: DataFrame, works: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """(citing, cited, year_diff) of edges whose dates are known and in order; works: paper_id, publication_date.

    With ``as_of_year`` dates are read by ``publication_year``, moved into the hundred years before it.
    """
    year = F.year(F.to_date("publication_date")) if as_of_year is None else publication_year(F.col("publication_date"), as_of_year)
    year = works.select("paper_id", year.alias("year")).where(F.col("year").isNotNull())
    citing = year.select(F.col("paper_id").alias("citing"), F.col("year").alias("citation_year"))
    cited = year.select(F.col("paper_id").alias("cited"), F.col("year").alias("pub_year"))
    return edges.join(citing, "citing").join(cited, "cited").where("citation_year >= pub_year").select("citing", "cited", (F.col("citation_year") - F.col("pub_year")).alias("year_diff"))


def primary_subfield(work_topic: DataFrame, topics: DataFrame) -> DataFrame:
    """(paper_id, subfield_id): the subfield of the topic of rank 1; of several the smallest topic_id."""
    first = newest(work_topic.where("topic_rank = 1"), ["paper_id"], F.col("topic_id"))
    return first.join(topics.select("topic_id", "subfield_id"), "topic_id").select("paper_id", "subfield_id")


def uncited(papers: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows of ``papers`` that no edge cites."""
    return papers.join(edges.select(F.col("cited").alias("paper_id")), "paper_id", "left_anti")


def work_types(works: DataFrame, journals: DataFrame) -> DataFrame:
    """(paper_id, work_type): an article in a live conference series is a conference_article; of several rows of a journal the
    smallest type holds."""
    series = journals.where(F.col("merge_into_id").isNull()).groupBy("journal_id").agg(F.min("type").alias("_series"))
    kind = F.when((F.col("type") == "article") & (F.col("_series") == "conference"), F.lit("conference_article")).otherwise(F.col("type"))
    return works.join(series, "journal_id", "left").select("paper_id", kind.alias("work_type"))


def within(as_of_year: int, span: int = 3) -> Column:
    """Citations in the ``span`` years after publication, as far as they have passed; over year_diff and pub_year."""
    return (F.col("year_diff") >= 0) & (F.col("year_diff") <= F.least(F.lit(span), F.lit(as_of_year) - F.col("pub_year")))


def window_counts(edges: DataFrame, papers: DataFrame, as_of_year: int, span: int = 3) -> DataFrame:
    """``papers`` (paper_id, pub_year, ...) with pub_plus_3_citations and total_citations; 0 where nothing cites.

    One pass over the edges in place of a grid of years: a conditional count is the grid's last running sum.
    """
    years = papers.select(F.col("paper_id").alias("cited"), "pub_year")
    counted = edges.select("cited", "year_diff").join(years, "cited").groupBy("cited").agg(F.count_if(within(as_of_year, span)).alias("_near"), F.count("*").alias("_all"), F.count_distinct("year_diff").alias("_offsets"))
    zero = lambda c, name: F.coalesce(c, F.lit(0)).alias(name)
    return papers.join(counted.withColumnRenamed("cited", "paper_id"), "paper_id", "left").select(*papers.columns, zero("_near", "pub_plus_3_citations"), zero("_all", "total_citations"), zero("_offsets", "citation_offsets"))


def expected_citations(counted: DataFrame, as_of_year: int) -> DataFrame:
    """(pub_year, subfield_id, work_type, expected_citations): the mean three-year count, to 8 digits."""
    known = counted.where(F.col("pub_year") <= as_of_year)
    return known.groupBy("pub_year", "subfield_id", "work_type").agg(F.round(F.avg("pub_plus_3_citations"), 8).alias("expected_citations"))


def fwci(counted: DataFrame, as_of_year: int, types: tuple[str, ...] = IMPACT_TYPES, parity: bool = False) -> DataFrame:
    """(paper_id, work_type, fwci): three-year citations over the expected ones of the same year, subfield and type.

    Null where nothing was expected, without a subfield, or for types outside ``types``. With ``parity`` a missing
    expectation counts as -1, as it once did.
    """
    expected = expected_citations(counted.where(F.col("subfield_id").isNotNull()), as_of_year)
    joined = counted.join(expected, ["pub_year", "subfield_id", "work_type"], "left")
    base = F.coalesce("expected_citations", F.lit(-1.0)) if parity else F.col("expected_citations")
    ratio = F.round(F.try_divide(F.col("pub_plus_3_citations").cast("double"), base), 5)
    return joined.select("paper_id", "work_type", F.when(F.col("work_type").isin(*types), ratio).alias("fwci"))


def percentiles(counted: DataFrame, parity: bool = False) -> DataFrame:
    """(paper_id, percentile): share of the group (year, type, subfield) with fewer citations, below 1.

    (minimum rank - 1) / (largest rank + 1); with ``parity`` different year offsets are counted in place of citations.
    Papers are counted by group and value first, so only the few different values of a group are ranked.
    """
    group, value = ["pub_year", "work_type", "subfield_id"], "citation_offsets" if parity else "total_citations"
    known = counted.dropna(subset=group)
    by = Window.partitionBy(*group)
    tally = known.groupBy(*group, value).agg(F.count("*").alias("_n"))
    fewer = F.coalesce(F.sum("_n").over(by.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = tally.withColumn("_fewer", fewer)
    share = ranked.select(*group, value, F.round(F.col("_fewer") / (F.max("_fewer").over(by) + 2), 8).alias("percentile"))
    return known.join(share, [*group, value]).select("paper_id", "percentile")


def publication_year(date: Column, as_of_year: int) -> Column:
    """Year of a date text, moved into the last hundred years; null stays null."""
    return clamp(F.year(F.try_to_date(date)), as_of_year - 100, as_of_year)
