"""The author table: identifier, display name, alternates and number of works of every author, kept up by changes.

What is kept is small and mergeable: for each author and name the number of its authorships, and the smallest identifier that
stands with them. A round of the cascade adds authorships, and only the authors that it touches are counted again. The table
itself is read off these counts, so no authorship is looked at twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioflow.functions.columns import newest
from biblioflow.functions.names import diacritics_of, display_changed_of, fold_of, plain_hyphens
from biblioflow.operators.diff import snapshot_diff

COUNTS = ("author_id", "author", "n", "orcid")


def counted(clusters: DataFrame, rows: DataFrame) -> DataFrame:
    """(author_id, author, n, orcid) of the authorships in ``clusters`` (work_author_id, author_id); rows: work_author_id, author, orcid.

    ``orcid`` is the smallest one that is not empty, or null.
    """
    held = clusters.select("work_author_id", "author_id").join(rows.select("work_author_id", "author", "orcid"), "work_author_id")
    return held.groupBy("author_id", "author").agg(F.count("*").alias("n"), F.min(_real("orcid")).alias("orcid"))


def _real(orcid: str) -> Column:
    return F.when(F.col(orcid) != "", F.col(orcid))


def added(counts: DataFrame, more: DataFrame) -> DataFrame:
    """Counts after those of further authorships; authors that gain none stay as they are."""
    touched = more.select("author_id").distinct()
    own = counts.join(touched, "author_id", "left_semi").unionByName(more.select(*COUNTS))
    again = own.groupBy("author_id", "author").agg(F.sum("n").alias("n"), F.min("orcid").alias("orcid"))
    return counts.join(touched, "author_id", "left_anti").select(*COUNTS).unionByName(again.select(*COUNTS))


def renumbered(counts: DataFrame, moves: DataFrame, source: str, target: str) -> DataFrame:
    """Counts where author ``source`` has become ``target``; several may become one."""
    m = moves.select(F.col(source).alias("_from"), F.col(target).alias("_to"))
    moved = counts.join(m, F.col("author_id") == F.col("_from"), "left")
    stays = moved.where("_to is null").select(*COUNTS)
    return added(stays, moved.where("_to is not null").select(F.col("_to").alias("author_id"), "author", "n", "orcid").groupBy("author_id", "author").agg(F.sum("n").alias("n"), F.min("orcid").alias("orcid")))


def owners(counts: DataFrame) -> DataFrame:
    """(author_id, orcid_2): an author's identifier, the smallest of its authorships', or the empty one."""
    return counts.groupBy("author_id").agg(F.coalesce(F.min("orcid"), F.lit("")).alias("orcid_2"))


def table(counts: DataFrame, display_requests: DataFrame | None = None) -> DataFrame:
    """(author_id, orcid, display_name, alternates, n_works): the author table of ``counts``.

    The display name is that of the newest request (author_id, display_name, request_date; ties to the greater name), else the
    most frequent name of more than one word, ties to the longest, then the greatest, and of its variants by diacritics the
    one with most of them. Alternates are the names with plain hyphens, one of each set of variants in dots and case, sorted.
    An empty requested name is no request.
    """
    named = counts.where(F.coalesce("author", F.lit("")) != "").withColumn("folded", fold_of("author"))
    order = F.struct(F.instr("author", " ") > 0, "n", F.length("author"), "author")
    best = named.groupBy("author_id").agg(F.max_by("folded", order).alias("folded"))
    shown = named.join(best, ["author_id", "folded"]).groupBy("author_id").agg(F.max_by("author", F.struct(diacritics_of("author"), "n", "author")).alias("display_name"))
    plain = named.select("author_id", plain_hyphens(F.col("author")).alias("author")).where("author <> ''")
    form = F.lower(F.replace("author", F.lit("."), F.lit("")))
    variants = plain.groupBy("author_id", form.alias("form")).agg(F.max_by("author", F.struct(F.length("author"), "author")).alias("author"))
    alternates = variants.groupBy("author_id").agg(F.sort_array(F.collect_list("author")).alias("alternates"))  # an author's different names
    own = counts.groupBy("author_id").agg(F.coalesce(F.min("orcid"), F.lit("")).alias("orcid"), F.sum("n").alias("n_works"))
    out = own.join(shown, "author_id", "left").join(alternates, "author_id", "left")
    name = F.coalesce("display_name", F.lit(""))
    if display_requests is not None:
        asked = newest(display_requests.where(F.coalesce("display_name", F.lit("")) != ""), ["author_id"], F.desc("request_date"), F.desc("display_name"))
        out = out.join(asked.select("author_id", F.col("display_name").alias("_asked")), "author_id", "left")
        name = F.coalesce("_asked", "display_name", F.lit(""))
    return out.select("author_id", "orcid", name.alias("display_name"), F.coalesce("alternates", F.array().cast("array<string>")).alias("alternates"), "n_works")


def dated(new: DataFrame, old: DataFrame, today: Column, loosely: bool = False) -> DataFrame:
    """``new`` with change, changed, created_date and modified_date; old: the table before, with its two dates.

    A created author gets ``today`` for both. A modified one keeps its first date and gets ``today`` for the other; an unchanged
    one keeps both, and ``today`` stands for a date that is missing. ``loosely``: a display name that differs only in case,
    diacritics or dots, its length the same, has not changed.
    """
    unlike = {"display_name": display_changed_of} if loosely else None
    compared = snapshot_diff(new, old, "author_id", ["orcid", "display_name"], ["alternates"], unlike=unlike)
    before = old.select("author_id", F.col("created_date").alias("_c"), F.col("modified_date").alias("_m"))
    own = compared.join(before, "author_id", "left")
    modified = F.when(F.col("change") == "unchanged", F.coalesce("_m", today)).otherwise(today)
    return own.withColumn("created_date", F.coalesce("_c", today)).withColumn("modified_date", modified).drop("_c", "_m")


def id_changes(new: DataFrame, old: DataFrame) -> DataFrame:
    """(work_author_id, author_id, old_author_id, id_changed) of each authorship in ``new``; one that is new has no old id and
    has not changed. Of several old rows the smallest author_id counts."""
    was = old.groupBy("work_author_id").agg(F.min("author_id").alias("old_author_id"))
    changed = F.col("old_author_id").isNotNull() & (F.col("old_author_id") != F.col("author_id"))
    return new.select("work_author_id", "author_id").join(was, "work_author_id", "left").withColumn("id_changed", changed)
