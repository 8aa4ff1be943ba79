"""Snapshot differences and set-based upserts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioflow.functions.columns import newest, same_set
from biblioflow.sources.queue import priority

TOMBSTONE = 5317838346
NULL_BUCKET = 9999999999


def snapshot_diff(new: DataFrame, old: DataFrame, key: str, scalars: list[str], sets: list[str], strong: list[str] | None = None, unlike: dict[str, Callable[[Column, Column], Column]] | None = None) -> DataFrame:
    """``new`` with change (created, modified, unchanged) and changed: whether it was created or a ``strong`` column differs.

    Columns in ``sets`` compare as sets; ``strong`` defaults to all scalars. ``unlike`` gives comparisons of its own for scalars: of
    the old and the new value, whether they differ.
    """
    strong = scalars if strong is None else strong
    before = old.select(key, *[F.col(c).alias(f"_old_{c}") for c in (*scalars, *sets)], F.lit(True).alias("_was"))
    joined = new.join(before, key, "left")
    other = lambda old, new: ~new.eqNullSafe(old)
    differs = {c: (unlike or {}).get(c, other)(F.col(f"_old_{c}"), F.col(c)) for c in scalars} | {c: ~same_set(F.col(c), F.col(f"_old_{c}")) for c in sets}
    fresh, any_of = F.col("_was").isNull(), lambda names: F.greatest(F.lit(False), F.lit(False), *[differs[c] for c in names])
    change = F.when(fresh, "created").when(any_of(differs), "modified").otherwise("unchanged")
    return joined.select(*new.columns, change.alias("change"), (fresh | any_of(strong)).alias("changed"))


def vanished(new: DataFrame, old: DataFrame, key: str, sentinels: tuple = (NULL_BUCKET, TOMBSTONE)) -> DataFrame:
    """Keys of ``old`` that are not in ``new``, without the sentinels."""
    return old.select(key).distinct().where(~F.col(key).isin(*sentinels)).join(new.select(key), key, "left_anti")


def update_from(target: DataFrame, changes: DataFrame, key: str, columns: list[str], newest_of: list[str] | None = None) -> DataFrame:
    """``target`` with ``columns`` taken from the row of ``changes`` of the same key, where that has a value.

    Columns in ``newest_of`` take the greater of both. ``changes`` holds a key once.
    """
    new = changes.select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in columns])
    value = lambda c: F.greatest(c, f"_new_{c}") if c in (newest_of or []) else F.coalesce(f"_new_{c}", c)
    return target.join(new, key, "left").select(*[value(c).alias(c) if c in columns else F.col(c) for c in target.columns])


def insert_missing(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` and those ``rows`` whose keys it lacks; of several rows of a key the smallest by the other columns, null first."""
    rest = [F.col(c) for c in target.columns if c not in keys]
    return target.unionByName(newest(rows, keys, *(rest or [F.lit(0)])).join(target.select(*keys), keys, "left_anti").select(*target.columns))


def delete_in(target: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return target.join(keys.select(*on), on, "left_anti")


def upsert(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` replace those of ``target`` with the same keys; the others stay."""
    return delete_in(target, rows, keys).unionByName(rows.select(*target.columns))


def unnested(df: DataFrame, key: str, array: str, name: str) -> DataFrame:
    """A row for each non-empty element of an array column."""
    return df.select(key, F.explode(array).alias(name)).where(F.col(name).isNotNull() & (F.trim(name) != ""))


def tombstoned(target: DataFrame, keys: DataFrame, key: str, column: str, value=TOMBSTONE, only: Column | None = None) -> DataFrame:
    """``column`` set to ``value`` for the keys listed (and where ``only`` holds)."""
    marked = keys.select(F.col(key)).distinct().withColumn("_gone", F.lit(True))
    hit = F.col("_gone").isNotNull() if only is None else F.col("_gone").isNotNull() & only
    return target.join(marked, key, "left").withColumn(column, F.when(hit, F.lit(value)).otherwise(F.col(column))).drop("_gone")


def queue_inserts(ids: DataFrame, queue: DataFrame, key: str = "id") -> DataFrame:
    """(id, rand, started, finished) for ids that are not queued; the priority is a hash, so a retry gives it again."""
    new = ids.select(key).distinct().join(queue.select(key), key, "left_anti")
    return new.select(key, priority(key).alias("rand"), F.lit(None).cast("timestamp").alias("started"), F.lit(None).cast("timestamp").alias("finished"))
