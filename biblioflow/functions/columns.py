"""Small column expressions that the operators share; null and ANSI behaviour is stated at each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def clamp(x: Column, low, high) -> Column:
    """``x`` moved into [low, high]; null stays null (greatest and least alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(high)), F.lit(low)))


def orcid_compatible(a: Column, b: Column) -> Column:
    """Two identifiers may be one person's: equal, or either is missing (null or empty)."""
    a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    return (a == b) | (a == "") | (b == "")


def capped_list(c: Column, most: int = 250) -> Column:
    """Null becomes the empty list; at most ``most`` elements."""
    return F.slice(F.coalesce(c, F.array()), 1, most)


def merged_sets(c: Column, *drop) -> Column:
    """Aggregate: the sorted union of array values, without nulls and the sentinels in ``drop``."""
    merged = F.array_sort(F.array_distinct(F.array_compact(F.flatten(F.collect_list(F.coalesce(c, F.array()))))))
    for value in drop:
        merged = F.array_remove(merged, value)
    return merged


def overlap(a: Column, b: Column) -> Column:
    """Size of the intersection; a null array is empty."""
    return F.size(F.array_intersect(F.coalesce(a, F.array()), F.coalesce(b, F.array())))


def jaccard(a: Column, b: Column, digits: int = 4) -> Column:
    """Rounded Jaccard similarity; 0 where both sides are empty or null."""
    a, b = F.coalesce(a, F.array()), F.coalesce(b, F.array())
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.round(F.size(F.array_intersect(a, b)) / union, digits)).otherwise(F.lit(0.0))


def same_set(a: Column, b: Column) -> Column:
    """Equality as sets; null equals null only."""
    return F.array_sort(F.array_distinct(a)).eqNullSafe(F.array_sort(F.array_distinct(b)))


def id_list(c: Column) -> Column:
    """array<bigint> of a JSON text such as ``[1, 2]``; text that is no list gives null."""
    return F.from_json(c, "array<bigint>")


def orcid_of(c: Column) -> Column:
    """The 19-character identifier of a bare id or of a 37-character address; anything else is empty."""
    return F.when(F.length(c) == 19, c).when(F.length(c) == 37, F.right(c, F.lit(19))).otherwise(F.lit(""))


def paper_of(work_author_id: Column) -> Column:
    """The paper id in ``paper_sequence``; null if it is no number."""
    return F.split_part(work_author_id, F.lit("_"), F.lit(1)).try_cast("bigint")


def sequence_of(work_author_id: Column) -> Column:
    return F.split_part(work_author_id, F.lit("_"), F.lit(2)).try_cast("int")


def newest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row of each key: the first by ``order``, which should be total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
