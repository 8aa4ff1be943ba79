"""Topic volume and entity topic profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from biblioflow.sources.stages import dealt


def topic_volume(work_topic: DataFrame, topic: str = "topic_id") -> DataFrame:
    """(topic, num_papers): rows of work_topic for each topic, repeated rows included."""
    return work_topic.groupBy(topic).agg(F.count("*").alias("num_papers"))


def entity_topic_profile(membership: DataFrame, work_topic: DataFrame, entity: str, paper: str = "paper_id", topic: str = "topic_id", top: int = 30, names: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """(entity, topic, topic_count, topic_share) of each entity's leading topics.

    A topic stays if it is among the ``top`` by count or by share of the topic's papers; ties go to the smaller
    topic. ``names`` (topic, display_name) adds the name. Null keys are dropped, repeated memberships count once. ``rows``: about how many the larger input has; both are then dealt by paper in parts of a bounded
    number, so that a task's memory does not grow with them.
    """
    by_paper = lambda df: df if rows is None else dealt(df, rows, paper)
    members = by_paper(membership.select(entity, paper).dropna()).distinct()
    topics = by_paper(work_topic.select(paper, topic)).distinct()
    counts = members.join(topics, paper).groupBy(entity, topic).agg(F.count("*").alias("topic_count"))
    shares = counts.join(topic_volume(work_topic, topic), topic).withColumn("topic_share", F.col("topic_count") / F.col("num_papers"))
    by = Window.partitionBy(entity)
    ranked = shares.withColumn("by_count", F.row_number().over(by.orderBy(F.desc("topic_count"), topic))).withColumn("by_share", F.row_number().over(by.orderBy(F.desc("topic_share"), topic)))
    kept = ranked.where((F.col("by_count") <= top) | (F.col("by_share") <= top)).select(entity, topic, "topic_count", "topic_share")
    return kept if names is None else kept.join(names.select(topic, "display_name"), topic).select(entity, topic, "display_name", "topic_count", "topic_share")
