"""Id allocation, candidate pairs and the assignment cascade of author disambiguation."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from biblioflow.functions.columns import capped_list, jaccard, newest, orcid_compatible, overlap, paper_of
from biblioflow.functions.names import block_of, coauthor_keys, letter_of, merged_slots_of, search_form_of, slots_of, structures_match, usable
from biblioflow.operators import authors
from biblioflow.operators.citations import redirected
from biblioflow.operators.diff import NULL_BUCKET, TOMBSTONE
from biblioflow.operators.evidence import SETS
from biblioflow.operators.nearest import PART, gathered, leading_among
from biblioflow.sources.stages import releasing, staged

#: Coefficients of the pair score over the feature vector; the intercept comes first.
SCORER = (-3.0, 2.5, 1.5, 3.5, 0.05, 0.3, 2.0, 2.5)
LEAST_SCORE = 0.05
CANDIDATES = 25
# Root concepts, which say nothing about a work; they must be these for equal results.
ROOT_CONCEPTS = (17744445, 138885662, 162324750, 144133560, 15744967, 33923547, 71924100, 86803240, 41008148, 127313418, 185592680, 142362112, 144024400, 127413603, 205649164, 95457728, 192562407, 121332964, 39432304)
#: A concept below this score is no feature.
CONCEPT_SCORE = 0.3


def allocated(df: DataFrame, order: list[Column | str], last: int, name: str = "new_id", rows_a_range: int = 100_000, most_ranges: int = 10_000) -> DataFrame:
    """``df`` with ids last + 1, last + 2, ... by ``order``, without sorting all rows in one task.

    Rows are dealt by ranges of the whole order (their number grows with the rows) and sorted there; they are written
    with their range and place, and the ranges' counts are added up.
    """
    ranges = max(1, min(most_ranges, -(-df.count() // rows_a_range)))
    keys = [c if isinstance(c, Column) else F.col(c) for c in order]
    sorted_ = df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    dealt = staged(sorted_.withColumn("_range", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id() % F.lit(1 << 33)), "allocated")
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))  # at most ``most_ranges`` rows
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return dealt.join(F.broadcast(sizes.select("_range", before.alias("_base"))), "_range").withColumn(name, F.lit(last) + F.col("_base") + F.col("_place") + 1).drop("_range", "_base", "_place")


def features(pairs: DataFrame, a: str = "_1", b: str = "_2") -> DataFrame:
    """``pairs`` with the evidence that both authorships are one person's, and its sum total_per.

    Columns of either side, with suffix ``a`` and ``b``: paper_id, institutions, coauthors, concepts, citations, author.
    """
    c = lambda name, side: F.col(name + side)
    cites = F.array_contains(F.coalesce(c("citations", a), F.array()), c("paper_id", b)) | F.array_contains(F.coalesce(c("citations", b), F.array()), c("paper_id", a))
    flag = lambda x: F.when(x, 1).otherwise(0)
    out = pairs.select(
        "*",
        flag(overlap(c("institutions", a), c("institutions", b)) > 0).alias("inst_per"),
        jaccard(c("concepts", a), c("concepts", b)).alias("concepts_per"),
        jaccard(c("coauthors", a), c("coauthors", b)).alias("coauthors_per"),
        jaccard(c("citations", a), c("citations", b)).alias("citation_per"),
        flag(cites).alias("citation_work_match"),
    )
    total = F.col("inst_per") + F.col("concepts_per") + F.col("coauthors_per") + F.col("citation_per") + F.col("citation_work_match")
    return with_exact_match(out.withColumn("total_per", total), a, b)


def with_exact_match(pairs: DataFrame, a: str = "_1", b: str = "_2") -> DataFrame:
    """Length and words of the name where both sides have the same, else 0."""
    own = F.col("author" + a)
    same = F.when(own == F.col("author" + b), 1).otherwise(0)
    return pairs.withColumn("exact_match_len", same * F.length(own)).withColumn("exact_match_spaces", same * F.size(F.split(own, " ")))


VECTOR = ("inst_per", "concepts_per", "coauthors_per", "exact_match_len", "exact_match_spaces", "citation_per", "citation_work_match")


def probability() -> Column:
    """Logistic score over VECTOR, with the documented coefficients in SCORER."""
    z = F.lit(SCORER[0])
    for weight, name in zip(SCORER[1:], VECTOR, strict=True):
        z = z + F.lit(weight) * F.col(name)
    return 1 / (1 + F.exp(-z))


def scored_candidates(pairs: DataFrame, most: int = CANDIDATES, least: float = LEAST_SCORE, score: Column | None = None) -> DataFrame:
    """The best existing authorship of each (new authorship, author), at most ``most`` authors a new one, with score.

    pairs: ``features`` with work_author_id_1 (new), work_author_id_2 and author_id (existing).
    """
    some = pairs.where("total_per > 0")
    best = newest(some, ["work_author_id_1", "author_id"], F.desc("total_per"), F.col("work_author_id_2"))
    return likely(best, most, least, score)


def likely(best: DataFrame, most: int = CANDIDATES, least: float = LEAST_SCORE, score: Column | None = None) -> DataFrame:
    """Of a new authorship's best pairs, one for each author, the first ``most`` by evidence, with a score above ``least``."""
    rank = F.row_number().over(Window.partitionBy("work_author_id_1").orderBy(F.desc("total_per"), "author_id"))
    near = best.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")
    return near.withColumn("score", probability() if score is None else score).where(F.col("score") > least)


def assigned(candidates: DataFrame) -> DataFrame:
    """(work_author_id_1, author_id, orcid_1, score): each new authorship's author, at most one.

    candidates: work_author_id_1, orcid_1, author_id, orcid_2, score. Identifiers must be compatible; the best score wins
    (then the smaller author_id). An author that would gain several identifiers gets only its best authorship.
    """
    fine = candidates.where(orcid_compatible(F.col("orcid_1"), F.col("orcid_2"))).select("work_author_id_1", "author_id", F.coalesce("orcid_1", F.lit("")).alias("orcid_1"), "score")
    best = newest(fine, ["work_author_id_1"], F.desc("score"), F.col("author_id"))
    own = Window.partitionBy("author_id")
    real = F.when(F.col("orcid_1") != "", F.col("orcid_1"))
    several = F.coalesce(F.min(real).over(own) != F.max(real).over(own), F.lit(False))
    place = F.row_number().over(own.orderBy(F.desc("score"), "work_author_id_1"))
    return best.withColumn("_several", several).withColumn("_place", place).where("not _several or _place = 1").drop("_several", "_place")


def orcid_matches(new: DataFrame, owners: DataFrame) -> DataFrame:
    """(work_author_id_1, author_id) of new authorships whose identifier one author has; the smallest author_id wins."""
    owner = owners.where(F.col("orcid_2") != "").groupBy("orcid_2").agg(F.min("author_id").alias("author_id"))
    return new.join(owner, new["orcid_1"] == owner["orcid_2"]).select("work_author_id_1", "author_id")


def taken_apart(names: DataFrame, column: str) -> DataFrame:
    """(column, slots, _block, _letter) of each different name."""
    parts = names.select(column).distinct().withColumn("_form", search_form_of(column)).withColumn("slots", slots_of("_form"))
    return parts.select(column, "slots", block_of(F.col("_form")).alias("_block"), letter_of(F.col("_form")).alias("_letter"))


def block_matches(new: DataFrame, known: DataFrame) -> DataFrame:
    """(author_1, author_id) of the names (author_1) and authors' names (author_id, author) of which one shares the name's block (last word,
    letter before it), and all together, as one structure, are compatible with it. Each different name is taken apart once."""
    given = staged(taken_apart(new, "author_1"), "new_names")
    parts = known.join(taken_apart(known, "author"), "author")
    met = given.select("author_1", "_block", "_letter").join(parts.select("author_id", "_block", "_letter").distinct(), ["_block", "_letter"]).select("author_1", "author_id")
    met = staged(met.distinct(), "blocked")
    merged = merged_slots_of(parts.join(met.select("author_id").distinct(), "author_id", "left_semi"), "author_id", "slots")
    both = met.join(given.select("author_1", F.col("slots").alias("a")), "author_1").join(merged.withColumnRenamed("slots", "b"), "author_id")
    return both.where(structures_match("a", "b")).select("author_1", "author_id")


def curated_clusters(current: DataFrame, requests: DataFrame, merges: DataFrame, frozen: DataFrame) -> DataFrame:
    """(work_author_id, author_id): current clusters after the newest request for each authorship and the merges; of several
    merges of one author that to the smallest id.

    current: work_author_id, author_id; requests: work_author_id, new_author_id, request_date. The two sentinels are no
    clusters.
    """
    wanted = newest(requests, ["work_author_id"], F.desc("request_date"), F.desc("new_author_id")).select("work_author_id", "new_author_id")
    asked = current.select("work_author_id", "author_id").join(wanted, "work_author_id", "full").select("work_author_id", F.coalesce("new_author_id", "author_id").alias("author_id"))
    moved = redirected(asked, newest(merge_map(merges, frozen), ["merge_from_id"], F.col("merge_to_id")), "author_id")
    return moved.where(~F.col("author_id").isin(NULL_BUCKET, TOMBSTONE)).distinct()


@dataclass
class Cascade:
    """What a run of the cascade gives: the assignments, the counts of the author table, what its rounds observed."""

    assignments: DataFrame
    counts: DataFrame
    rounds: list[tuple[str, str, float]] = field(default_factory=list)

    def statistics(self) -> DataFrame:
        """(round, name, value) of every round: rows given, authors rebuilt and seconds; of the input its rows and empty features."""
        return self.assignments.sparkSession.createDataFrame(self.rounds, "round string, name string, value double")


@releasing
def disambiguated(works: DataFrame, current: DataFrame, last_id: int, requests: DataFrame | None = None, merges: DataFrame | None = None, frozen: DataFrame | None = None, removed: DataFrame | None = None, splits: DataFrame | None = None, **options) -> DataFrame:
    """The assignments of ``cascade``, whose tables are deleted once these are written."""
    return cascade(works, current, last_id, requests, merges, frozen, removed, splits, **options).assignments


def cascade(works: DataFrame, current: DataFrame, last_id: int, requests: DataFrame | None = None, merges: DataFrame | None = None, frozen: DataFrame | None = None, removed: DataFrame | None = None, splits: DataFrame | None = None, raw_names: DataFrame | None = None, bar_always: bool = False, crowd: int = PART) -> Cascade:
    """(work_author_id, author_id, how) of every authorship in ``works``, whether it had an author before or not, and the author table.

    works: work_author_id, paper_id, author, orcid and the lists institutions, coauthors, concepts, citations; current:
    work_author_id, author_id; requests, merges, frozen: see ``curated_clusters``; removed: (paper_id, author_id) that are parted
    and never paired by name again; splits: (request, work_author_id) that must form an author of their own; raw_names:
    (work_author_id, author, request_date), of which the newest replaces an authorship's name (ties to the greater name).

    A removal bars the rounds by name. An identifier, or a new author of just the works that the old one had, can bring an
    authorship back in the same run; with ``bar_always`` they cannot.

    1. curation; 2. an author of its own for each split; 3. authors that share an identifier become one; then for the
    others, collapsed to one of each set of equal features: 4. by identifier, 5. by exact name with evidence, 6. the same
    once more, seeing what 5 has added, 7. by compatible name with evidence, 8. new ids; 9. the collapsed are expanded,
    10. names that stand for no person go to the null bucket, 11. a new cluster that equals an old one keeps its id.
    Candidates come from blocks of names (``nearest``); ``crowd`` authorships of one meet in a task on either side, which decides nothing.
    Every round's assignments are written, and the authors' names, identifiers and members are those after the round before:
    counts of names and identifiers are kept by ``authors``, and only authors that a round touches are counted again. What the
    rounds' own passes observe is in ``rounds``.
    """
    spark, rounds = works.sparkSession, []

    def observed(df: DataFrame, name: str, round_name: str, *metrics: Column) -> DataFrame:
        """The stage, with counts of its rows taken as it is written."""
        began, seen = time.perf_counter(), Observation()
        out = staged(df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), name)
        rounds.extend((round_name, k, float(v or 0)) for k, v in seen.get.items())
        rounds.append((round_name, f"{name} seconds", time.perf_counter() - began))
        return out

    if raw_names is not None:
        wanted = newest(raw_names.where(F.coalesce("author", F.lit("")) != ""), ["work_author_id"], F.desc("request_date"), F.desc("author"))
        works = works.join(wanted.select("work_author_id", F.col("author").alias("_raw")), "work_author_id", "left").withColumn("author", F.coalesce("_raw", "author")).drop("_raw")
    none = lambda ddl: spark.createDataFrame([], ddl)
    requests = none("work_author_id string, new_author_id long, request_date timestamp") if requests is None else requests
    merges = none("merge_from_id long, merge_to_id long") if merges is None else merges
    frozen = none("author_id long") if frozen is None else frozen
    splits = none("request string, work_author_id string") if splits is None else splits
    concepts = F.sort_array(F.filter(F.coalesce("concepts", F.array().cast("array<bigint>")), lambda x: ~x.isin(*ROOT_CONCEPTS)))
    lists = {"coauthors": coauthor_keys(F.col("coauthors")), "concepts": concepts, **{c: F.sort_array(F.coalesce(c, F.array().cast("array<bigint>"))) for c in ("institutions", "citations")}}
    named = usable(F.col("author"))
    empty = [F.count_if(F.size(c) == 0).alias(f"without {c}") for c in SETS]
    rows = observed(works.withColumns(lists).withColumn("orcid", F.coalesce("orcid", F.lit(""))).withColumn("named", named), "works", "input", *empty, F.count_if(F.col("orcid") == "").alias("without orcid"))
    how = lambda df, name: df.select("work_author_id", "author_id", F.lit(name).alias("how"))

    kept = staged(curated_clusters(current, requests, merges, frozen), "curated")
    forced = allocated(splits.select("request").distinct(), ["request"], last_id, "author_id").join(splits, "request")
    forced = staged(forced.select("work_author_id", F.col("author_id").cast("long").alias("author_id")).distinct(), "split")
    last_id += splits.select("request").distinct().count()
    clusters = how(kept.join(forced, "work_author_id", "left_anti"), "kept").union(how(forced, "split"))
    clusters = clusters.join(rows.select("work_author_id", "paper_id"), "work_author_id")
    if removed is not None:
        clusters = clusters.join(removed.select("paper_id", "author_id").distinct(), ["paper_id", "author_id"], "left_anti")
    clusters = staged(clusters.select("work_author_id", "author_id", "how"), "clusters")
    winners = identifier_winners(_owned(clusters, rows), frozen)
    clusters = observed(redirected(clusters, winners, "author_id", "author_id", "winner_id").select("work_author_id", "author_id", "how"), "clusters", "curation")
    counts = observed(authors.counted(clusters, rows), "counts", "curation")

    fresh = rows.where("named").join(clusters, "work_author_id", "left_anti")
    alone = F.lit("")  # an authorship that is barred from an author is nobody's copy
    if removed is not None:
        fresh = fresh.join(removed.select("paper_id", F.lit(True).alias("_barred")).distinct(), "paper_id", "left")
        alone = F.when(F.col("_barred"), F.col("work_author_id")).otherwise(F.lit(""))
    fresh = staged(fresh, "fresh")
    profile = fresh.select("work_author_id", *PROFILE, alone.alias("_alone"))
    groups = staged(collapsed(profile, "work_author_id", [*PROFILE, "_alone"]).select("work_author_id", "members"), "groups")
    left = fresh.join(groups.select("work_author_id"), "work_author_id", "left_semi").drop("named", "_barred")
    left = staged(left.select(*[F.col(c).alias(f"{c}_1") for c in left.columns]), "left")

    def round_(name: str, given: DataFrame) -> DataFrame:
        nonlocal clusters, left, counts
        given = observed(given.select(F.col("work_author_id_1").alias("work_author_id"), "author_id"), "given", name)
        clusters = clusters.unionByName(how(given, name))
        if rounds[-2][2]:
            more = observed(authors.counted(given, rows), "gained", name)
            counts = staged(authors.added(counts, more), "counts")
        left = left.join(given.select(F.col("work_author_id").alias("work_author_id_1")), "work_author_id_1", "left_anti")
        return given

    def allowed(met: DataFrame) -> DataFrame:
        if removed is None:
            return met
        return met.join(removed.select(F.col("paper_id").alias("paper_id_1"), "author_id").distinct(), ["paper_id_1", "author_id"], "left_anti")

    matches = orcid_matches(left, authors.owners(counts))
    if bar_always:
        matches = allowed(matches.join(left.select("work_author_id_1", "paper_id_1"), "work_author_id_1"))
    round_("identifier", matches)
    block = F.xxhash64("_block", "_letter").alias("group")
    known = counts.select("author_id", "author").distinct()
    own = staged(known.join(taken_apart(known, "author").select("author", block), "author").select("author_id", "group").distinct(), "author_groups")
    looked_up = ("work_author_id", "paper_id", "author", *SETS)
    # written once: the rounds by name add members whose names their authors have, so no author comes into another block
    members = staged(gathered(clusters, rows.select(*looked_up), own), "members")
    for name in ("name", "name again", "compatible"):
        parts = staged(taken_apart(left.select("author_1"), "author_1"), "new_names")
        known = counts.select("author_id", "author")
        matches = block_matches(parts.select("author_1"), known.distinct()) if name == "compatible" else known.withColumnRenamed("author", "author_1").distinct()
        asking = left.select(*[F.col(f"{c}_1").alias(c) for c in (*looked_up, "orcid")])
        found = leading_among(matches, parts.select("author_1", block), asking, members, counts, CANDIDATES, removed, crowd, SCORER)
        found = found.join(left.select("work_author_id_1", "author_1", "orcid_1"), "work_author_id_1").withColumn("author_2", F.when(F.col("same"), F.col("author_1")))
        given = round_(name, assigned(likely(with_exact_match(found))))
        members = members.unionByName(staged(gathered(given, asking, own), "members"))

    made = allocated(left.select("work_author_id_1").distinct(), [paper_of(F.col("work_author_id_1")), "work_author_id_1"], last_id, "author_id")
    round_("new", made)
    again = groups.where(F.size("members") > 1).select("work_author_id", F.explode("members").alias("_member"))
    copies = clusters.join(again, "work_author_id").where(F.col("_member") != F.col("work_author_id")).select(F.col("_member").alias("work_author_id"), "author_id", "how")
    copies = observed(copies, "copies", "expansion")
    clusters = staged(clusters.unionByName(copies), "clusters")
    counts = staged(authors.added(counts, authors.counted(copies, rows)), "counts")
    unnamed = rows.where("not named").join(clusters, "work_author_id", "left_anti").select("work_author_id", F.lit(NULL_BUCKET).cast("long").alias("author_id"))
    old = kept_ids(clusters.where("how = 'new'"), current)
    if bar_always and removed is not None:
        barred = clusters.join(rows.select("work_author_id", "paper_id"), "work_author_id").join(removed.select("paper_id", F.col("author_id").alias("old_id")).distinct(), "paper_id")
        old = old.join(barred.select("author_id", "old_id").distinct(), ["author_id", "old_id"], "left_anti")
    old = staged(old, "kept_ids")
    clusters = redirected(clusters, old, "author_id", "author_id", "old_id").select("work_author_id", "author_id", "how")
    counts = authors.renumbered(counts, old, "author_id", "old_id")
    return Cascade(clusters.unionByName(how(unnamed.distinct(), "unnamed")), counts, rounds)


PROFILE = ("author", "orcid", "coauthors", "concepts", "institutions", "citations")


def _owners(clusters: DataFrame, rows: DataFrame) -> DataFrame:
    """(author_id, orcid_2): an author's identifier, the smallest of its members', or the empty one."""
    held = clusters.select("work_author_id", "author_id").join(rows.select("work_author_id", "orcid"), "work_author_id")
    return held.groupBy("author_id").agg(F.coalesce(F.min(F.when(F.col("orcid") != "", F.col("orcid"))), F.lit("")).alias("orcid_2"))


def _owned(clusters: DataFrame, rows: DataFrame) -> DataFrame:
    """(author_id, orcid) of every member, the orcid being its author's."""
    return clusters.join(_owners(clusters, rows).withColumnRenamed("orcid_2", "orcid"), "author_id").select("author_id", "orcid")


def merge_map(merges: DataFrame, frozen: DataFrame) -> DataFrame:
    """(merge_from_id, merge_to_id): a merge away from a frozen author runs the other way."""
    held = frozen.select(F.col("author_id").alias("merge_from_id")).distinct().withColumn("_frozen", F.lit(True))
    flipped = F.col("_frozen").isNotNull()
    joined = merges.join(held, "merge_from_id", "left")
    return joined.select(F.when(flipped, F.col("merge_to_id")).otherwise(F.col("merge_from_id")).alias("merge_from_id"), F.when(flipped, F.col("merge_from_id")).otherwise(F.col("merge_to_id")).alias("merge_to_id"))


def identifier_winners(members: DataFrame, frozen: DataFrame) -> DataFrame:
    """(author_id, winner_id): authors that share an identifier with a frozen, larger or older one."""
    sizes = members.where(F.coalesce("orcid", F.lit("")) != "").groupBy("orcid", "author_id").agg(F.count("*").alias("_n"))
    held = frozen.select("author_id").distinct().withColumn("_frozen", F.lit(True))
    own = Window.partitionBy("orcid").orderBy(F.col("_frozen").isNotNull().desc(), F.desc("_n"), "author_id")
    ranked = sizes.join(held, "author_id", "left").withColumn("winner_id", F.first("author_id").over(own))
    return ranked.where("author_id <> winner_id").select("author_id", "winner_id").distinct()


def collapsed(rows: DataFrame, key: str, features_: list[str]) -> DataFrame:
    """One row of each set of equal features: the smallest key, with the list of all."""
    return rows.groupBy(*features_).agg(F.min(key).alias(key), F.sort_array(F.collect_set(key)).alias("members"))


def expanded(assignments: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """An assignment of a representative holds for its members."""
    return assignments.join(groups.select(key, "members"), key).withColumn(key, F.explode("members")).drop("members")


def kept_ids(new: DataFrame, old: DataFrame, most: int = 5) -> DataFrame:
    """(author_id, old_id): new clusters of at most ``most`` members that equal an old one; (author_id, work_author_id) each."""
    sets = lambda df: df.groupBy("author_id").agg(F.sort_array(F.collect_set("work_author_id")).alias("m"))
    small = sets(new).where(F.size("m") <= most)
    was = sets(old).where(F.size("m") <= most).groupBy("m").agg(F.min("author_id").alias("old_id"))
    return small.join(was, "m").where("author_id <> old_id").select("author_id", "old_id")


def disambiguation_input(affiliations: DataFrame, works: DataFrame, concepts: DataFrame, citations: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """A row for each authorship without an author, with the paper's sets.

    affiliations: paper_id, author_id, affiliation_id, author_sequence_number, original_author, original_orcid.
    """
    live = works.where(F.col("merge_into_id").isNull()).select("paper_id", "created_date")
    rows = affiliations.join(live, "paper_id").withColumn("work_author_id", F.concat_ws("_", "paper_id", "author_sequence_number"))
    longest = F.max_by("original_author", F.struct(F.length("original_author"), F.col("original_author")))
    own = rows.groupBy("paper_id", "work_author_id", "created_date").agg(
        longest.alias("original_author"),
        F.coalesce(F.min(F.when(F.col("original_orcid") != "", F.col("original_orcid"))), F.lit("")).alias("orcid"),
        F.sort_array(F.collect_set("affiliation_id")).alias("institutions"),
        F.max("author_id").alias("author_id"),
    )
    sets = lambda df, column, name: df.groupBy("paper_id").agg(F.sort_array(F.collect_set(column)).alias(name))
    everyone = sets(own, "original_author", "coauthors")
    out = own.where(F.col("author_id").isNull() | (F.col("author_id") == -1))
    out = out.join(everyone, "paper_id", "left").join(sets(concepts.where(~F.col("field_of_study").isin(*ROOT_CONCEPTS) & (F.col("score") > CONCEPT_SCORE)), "field_of_study", "concepts"), "paper_id", "left").join(sets(citations, "paper_reference_id", "citations"), "paper_id", "left")
    others = capped_list(F.filter("coauthors", lambda x: x != F.col("original_author")))
    return out.select("work_author_id", "original_author", "orcid", capped_list(F.col("concepts")).alias("concepts"), capped_list(F.col("institutions")).alias("institutions"), capped_list(F.col("citations")).alias("citations"), others.alias("coauthors"), "created_date")
