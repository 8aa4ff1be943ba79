"""Identifier reconciliation and the repair of over-merged authors."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblioflow.functions.columns import orcid_of
from biblioflow.functions.names import accepted, compatible, evidence_of, search_form, search_form_of
from biblioflow.operators.evidence import shared_weights
from biblioflow.sources.stages import releasing, sized, staged

#: Weights of shared members in the reassignment of an over-merged author's works.
WEIGHTS = {"institutions": 2.0, "coauthors": 0.05, "concepts": 0.01, "citations": 0.2, "coauthor_orcids": 5.0, "topics": 5.0, "subfields": 1.0, "fields": 0.01}
#: Works of an over-merged author and members of their sets up to which all of the author's rounds run in one stream of works.
AUTHOR_MEMBERS = 4096
GIVEN = ["author_id", "work_author_id", "orcid"]
#: What the tasks of greedy assignment and of first fit return.
PLACED = pa.schema([("author_id", pa.int64()), ("first", pa.string()), ("orcid", pa.string())])
SEEDED = pa.schema([("author_id", pa.int64()), ("name", pa.string()), ("seed", pa.string())])


def chosen_identifier(user: Column, harvested: Column, source: Column) -> Column:
    """The first non-empty identifier: of the user, the harvest, the source."""
    full = lambda c: F.when(orcid_of(c) != "", orcid_of(c))
    return F.coalesce(full(user), full(harvested), full(source), F.lit(""))


def reconciled(claims: DataFrame, registry: DataFrame) -> DataFrame:
    """(paper_id, author_sequence_number, orcid): claims that the registry's name supports and that are unique.

    claims: paper_id, author_sequence_number, original_author, orcid; registry: orcid, given_names, family_name. Of a
    paper's authorships claiming one identifier those of the best evidence stay; several of them drop it. Where the registry has
    several rows of an identifier, each is tried.
    """
    tokens = lambda c: F.split(F.lower(F.coalesce(c, F.lit(""))), r"\s+")
    named = registry.select("orcid", tokens(F.col("given_names")).alias("given"), tokens(F.col("family_name")).alias("family")).distinct()
    claimed = claims.where(F.coalesce("orcid", F.lit("")) != "")
    tried = claimed.select("original_author", "orcid").distinct().join(named, "orcid").withColumn("e", evidence_of("original_author", "given", "family"))
    proof = tried.where(accepted(F.col("e"))).groupBy("original_author", "orcid").agg(F.max(F.struct(*[F.col("e")[i].alias(f"e{i}") for i in range(3)])).alias("e"))
    proof = staged(proof, "evidence")  # a name and an identifier are weighed once, however many claims have them
    fine = claimed.join(sized(proof, F.octet_length("original_author") + F.octet_length("orcid") + 64), ["original_author", "orcid"])
    return uniquely_best(fine, ["paper_id", "orcid"], [F.desc("e")], "author_sequence_number").select("paper_id", "author_sequence_number", "orcid").distinct()


def uniquely_best(df: DataFrame, keys: list[str], order: list[Column], member: str) -> DataFrame:
    """Rows of dense rank 1 in their key, where these have one ``member`` only."""
    best = df.withColumn("_rank", F.dense_rank().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")
    members = Window.partitionBy(*keys)
    return best.withColumn("_one", F.min(member).over(members) == F.max(member).over(members)).where("_one").drop("_one")


def overmerged(works: DataFrame, frozen: DataFrame, *more: Column) -> DataFrame:
    """(author_id) with more than one different identifier, not frozen; ``more``: aggregates over their works that come with them."""
    held = F.when(F.col("orcid") != "", F.col("orcid"))
    several = works.groupBy("author_id").agg(F.min(held).alias("_low"), F.max(held).alias("_high"), *more).where("_low < _high").drop("_low", "_high")
    return several.join(frozen.select("author_id").distinct(), "author_id", "left_anti")


def name_block(name: Column) -> Column:
    """The initials of a search form's first and last word, in order: names that are compatible have one, but the empty name fits all."""
    words = F.split(F.trim(name), r"\s+")
    initials = F.array_sort(F.array(*[F.substring(F.element_at(words, i), 1, 1) for i in (1, -1)]))
    return F.when(F.trim(name) == "", "").otherwise(F.array_join(initials, ""))


def _assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Greedy by score: a profile goes to the first anchor all of whose names it is compatible with; its name joins them.

    Rows lie in order of author and part; in one of these the anchors' names come first, with ``first`` null, then the profiles' pairs in
    order of score. Names are one another's only if compatible, and a misfit stays one, so an anchor's names are looked at once for a name that misses.
    """
    key, names, done, misfits = None, {}, set(), set()
    for batch in batches:
        found = []
        for author, part, first, name, orcid in zip(*(batch.column(c).to_pylist() for c in ("author_id", "part", "first", "name", "orcid")), strict=True):
            if (author, part) != key:
                key, names, done, misfits = (author, part), {}, set(), set()
            if first is None:
                names.setdefault(orcid, []).append(name)
            elif first not in done and (name, orcid) not in misfits:
                own = names[orcid]
                if all(_fits(name, n) for n in own):
                    done.add(first)
                    found.append({"author_id": author, "first": first, "orcid": orcid})
                    if name not in own:
                        own.append(name)
                else:
                    misfits.add((name, orcid))
        yield pa.RecordBatch.from_pylist(found, PLACED)


def _placed(held: DataFrame, anchored: DataFrame) -> DataFrame:
    """(author_id, first, orcid) of the greedy assignment of profiles, in parts that cannot meet.

    held: author_id, name, first, orcid, score; anchored: author_id, orcid, name. A profile fits an anchor only if all of the anchor's
    names are of its block, so each block of an author is a task of its own. The empty name fits all and bars none: such a profile
    takes its best anchor. Where an anchor has no name but the empty one, any block may be the first to take it: that author's are one task.
    """
    named = anchored.select("author_id", "orcid", "name", name_block(F.col("name")).alias("block")).distinct()
    some = F.when(F.col("block") != "", F.col("block"))
    of = named.groupBy("author_id", "orcid").agg(F.min(some).alias("low"), F.max(some).alias("high"))
    open_ = of.where("low IS NULL").select("author_id").distinct().withColumn("_open", F.lit(True))
    blocks = of.where("low IS NULL OR low = high").select("author_id", "orcid", F.col("low").alias("_own")).join(open_, "author_id", "left")
    part = lambda own: F.when(F.col("_open"), F.lit("")).otherwise(own)

    pairs = held.withColumn("block", name_block(F.col("name")))
    best = Window.partitionBy("author_id", "first").orderBy(F.col("score").desc(), "orcid")
    unnamed = pairs.where("block = ''").withColumn("_r", F.row_number().over(best)).where("_r = 1").select("author_id", "first", "orcid")
    fits = pairs.where("block <> ''").join(blocks, ["author_id", "orcid"]).where(F.col("_own").isNull() | (F.col("_own") == F.col("block")))
    fits = fits.select("author_id", part(F.col("block")).alias("part"), "first", "name", "orcid", "score")
    names = named.join(blocks, ["author_id", "orcid"]).select("author_id", part(F.col("_own")).alias("part"), "orcid", "name")
    keys = ["author_id", "part"]
    rows = names.unionByName(fits, allowMissingColumns=True).repartition(*keys)
    rows = rows.sortWithinPartitions(*keys, F.col("first").isNotNull(), F.desc("score"), "first", "orcid")
    found = rows.mapInArrow(_assign, "author_id long, first string, orcid string")
    return found.unionByName(unnamed)


_fits = lru_cache(1 << 16)(compatible)
_form = lru_cache(1 << 16)(search_form)


def _author_rounds(works: list[tuple], rounds: int) -> Iterator[tuple[str, str]]:
    """(work, identifier) given to one author's works; these are (work, identifier, name, column of lists by kind, place in these).

    A work whose name misses a name of every anchor is dropped for good, as anchors only gain names; sets are read if any work is left.
    """
    names, sets, free = defaultdict(list), {}, []
    for work, orcid, name, lists, i in works:
        if not orcid:
            free.append((work, _form(name), lists, i))
        elif (form := _form(name)) not in names[orcid]:
            names[orcid].append(form)
    for _ in range(rounds):
        may = {form: any(all(_fits(form, n) for n in own) for own in names.values()) for form in {f[1] for f in free}}
        free = [f for f in free if may[f[1]]]
        if not free:
            return
        if not sets:
            anchors = sorted(names)
            sets = {o: [set() for _ in WEIGHTS] for o in anchors}
            for _, orcid, _, lists, i in works:
                if orcid:
                    _enlarge(sets[orcid], lists, i)
        profiles = defaultdict(list)
        for work in free:
            own = [(w, k, set(items)) for k, (w, items) in enumerate(zip(WEIGHTS.values(), _members(work[2], work[3]), strict=True)) if items]
            scores = ((o, round(sum(w * len(mine & sets[o][k]) for w, k, mine in own), 6)) for o in anchors)
            if scores := tuple(s for s in scores if s[1] > 0):
                profiles[work[1], scores].append(work)
        tries = sorted((-s, min(f[0] for f in like), o, form, scores) for (form, scores), like in profiles.items() for o, s in scores)
        given = {}
        for _, _, orcid, form, scores in tries:
            if (form, scores) not in given and all(_fits(form, n) for n in names[orcid]):
                given[form, scores] = orcid
                if form not in names[orcid]:
                    names[orcid].append(form)
        if not given:
            return
        for profile, orcid in given.items():
            for work, _, lists, i in profiles[profile]:
                _enlarge(sets[orcid], lists, i)
                yield work, orcid
        gone = {f[0] for profile in given for f in profiles[profile]}
        free = [f for f in free if f[0] not in gone]


def _members(lists: list[tuple[np.ndarray, np.ndarray]], i: int) -> list[list]:
    """The members that the sets of row ``i`` hold, by kind."""
    return [[x for x in values[ends[i] : ends[i + 1]].tolist() if x is not None] if len(values) else [] for ends, values in lists]


def _enlarge(sets: list[set], lists: list[tuple[np.ndarray, np.ndarray]], i: int) -> None:
    for own, more in zip(sets, _members(lists, i), strict=True):
        own.update(more)


def _cells(column: pa.Array) -> np.ndarray:
    """A column's values, null being None."""
    return np.array([*column.to_pylist(), None], object)[:-1] if column.null_count else column.to_numpy(zero_copy_only=False)


def _in_order(rounds: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All rounds of each author, over works in order of author."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        author, works, kinds = None, [], None
        for batch in batches:
            kinds = pa.schema([batch.schema.field(c) for c in GIVEN])
            lists = [(_cells(c.offsets), _cells(c.values)) for c in (batch.column(k) for k in WEIGHTS)]
            found = []
            for i, (a, work, orcid, name) in enumerate(zip(*(_cells(batch.column(c)).tolist() for c in (*GIVEN, "name")), strict=True)):
                if a != author:
                    found += ((author, *g) for g in _author_rounds(works, rounds))
                    author, works = a, []
                works.append((work, orcid, name, lists, i))
            yield _batch(found, kinds)
        if kinds:
            yield _batch([(author, *g) for g in _author_rounds(works, rounds)], kinds)

    return run


def _batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(kinds)], schema=kinds)


@releasing
def reassigned(works: DataFrame, frozen: DataFrame, rounds: int = 3, members: int = AUTHOR_MEMBERS) -> DataFrame:
    """(author_id, work_author_id, orcid): over-merged authors' works without identifier, given to an anchor.

    works: author_id, work_author_id, orcid, name and the sets of WEIGHTS. Works of one author with the same name and the
    same scores are one profile and are given together; a round enlarges the anchors by what it assigned, and without any it is the last.
    An author whose works and their sets have up to ``members`` members has them dealt to one task, where each such author's rounds run
    in turn; the rounds of larger ones are joins (``_joined_rounds``). Both give the same.
    """
    held = F.lit(1).cast("long")
    for c in WEIGHTS:
        held = held + F.coalesce(F.array_size(c), F.lit(0))
    over = staged(overmerged(works, frozen, F.sum(held).alias("members")), "overmerged")
    few, many = (over.where(c).select("author_id") for c in (F.col("members") <= members, F.col("members") > members))
    sets = [F.coalesce(c, F.array()).alias(c) for c in WEIGHTS]
    own = works.join(sized(few, 16), "author_id", "left_semi").select("author_id", "work_author_id", F.coalesce("orcid", F.lit("")).alias("orcid"), "name", *sets)
    given = own.repartition("author_id").sortWithinPartitions("author_id").mapInArrow(_in_order(rounds), own.select(*GIVEN).schema)
    if many.isEmpty():
        return given
    return given.unionByName(_joined_rounds(works.join(sized(many, 16), "author_id", "left_semi"), rounds))


def _joined_rounds(works: DataFrame, rounds: int) -> DataFrame:
    """``reassigned`` of over-merged authors by postings and parts of names: no task gets an author whole.

    An author's profiles meet only where their names' initials are the same. Each round is written. An author to whom a round assigns
    nothing would get nothing in the next either, so a round looks only at authors that the one before it changed.
    """
    own = works.withColumn("name", search_form_of("name")).withColumn("orcid", F.coalesce("orcid", F.lit("")))
    known, done = staged(own, "crowded"), None
    for _ in range(rounds):
        anchored, free = known.where("orcid <> ''"), known.where("orcid = ''")
        pairs = shared_weights(free, anchored, WEIGHTS, "author_id", "work_author_id", "orcid").where("score > 0")
        scores = F.array_sort(F.collect_list(F.struct("orcid", "score")))  # an entry for each anchor of the author
        scored = pairs.groupBy("author_id", "work_author_id").agg(scores.alias("scores"))
        profiles = staged(scored.join(free.select("author_id", "work_author_id", "name"), ["author_id", "work_author_id"]).select("author_id", "work_author_id", "name", "scores"), "profiles")
        firsts = profiles.groupBy("author_id", "name", "scores").agg(F.min("work_author_id").alias("first"))
        held = firsts.select("author_id", "name", "first", F.explode("scores").alias("s")).select("author_id", "name", "first", "s.orcid", "s.score")
        given = profiles.join(firsts, ["author_id", "name", "scores"]).join(_placed(held, anchored), ["author_id", "first"])
        given = staged(given.select("author_id", "work_author_id", "orcid"), "given")
        done = given if done is None else done.unionByName(given)
        if given.isEmpty():
            break
        new = given.select("author_id", "work_author_id", F.col("orcid").alias("_o"))
        changed = known.join(given.select("author_id").distinct(), "author_id", "left_semi")
        known = staged(changed.join(new, ["author_id", "work_author_id"], "left").withColumn("orcid", F.coalesce("_o", "orcid")).drop("_o"), "enlarged")
    return done


def split_requests(works: DataFrame, given: DataFrame, date: str) -> DataFrame:
    """(request, author_id, orcid, works): every identifier but an author's most frequent asks for an author of its own."""
    held = works.where(F.coalesce("orcid", F.lit("")) != "").select("author_id", "work_author_id", "orcid").unionByName(given.select("author_id", "work_author_id", "orcid"))
    groups = held.join(given.select("author_id").distinct(), "author_id", "left_semi").groupBy("author_id", "orcid").agg(F.sort_array(F.collect_set("work_author_id")).alias("works"))
    place = F.row_number().over(Window.partitionBy("author_id").orderBy(F.size("works").desc(), "orcid"))
    key = F.concat_ws("-", "author_id", F.lit("orc"), "orcid", F.lit(date))
    return groups.withColumn("_p", place).where("_p > 1").select(key.alias("request"), "author_id", "orcid", "works")


def as_splits(requests: DataFrame) -> DataFrame:
    """(request, work_author_id) of ``split_requests``, as the cascade takes them."""
    return requests.select("request", F.explode("works").alias("work_author_id"))


def leftover_splits(groups: DataFrame, date: str) -> DataFrame:
    """(request, work_author_id) of ``leftover_groups``: every cluster of an author but its first asks for an author of its own."""
    key = F.concat_ws("-", "author_id", F.lit("left"), "cluster", F.lit(date))
    return groups.where("cluster > 0").select(key.alias("request"), "work_author_id")


class _Seeds:
    """Clusters by the first and last word of their first name, to look up those that a name may join."""

    def __init__(self) -> None:
        self.found: dict[tuple[str, str], list[int]] = {}

    def add(self, words: tuple[str, str], k: int) -> None:
        first, last = ((w, f"{w[0]} *") for w in words)
        for key in ((f, p) for f in first for p in last):
            self.found.setdefault(key, []).append(k)

    def fitting(self, words: tuple[str, str]) -> Iterator[int]:
        """In order: clusters whose first name's words are these, or initials of them, or begin with them, or are these turned round."""
        first, last = ([w, w[0]] if len(w) > 1 else [f"{w} *"] for w in words)
        keys = dict.fromkeys([*((f, p) for f in first for p in last), (words[1], words[0])])
        before = -1
        for k in heapq.merge(*(self.found.get(key, ()) for key in keys)):
            if k != before:
                yield k
            before = k


def _first_fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First fit over rows in order of author, block and name. Names of one cluster are all compatible, so a cluster has few: words in full or by initial."""
    key, clusters, seeds = None, [], _Seeds()
    for batch in batches:
        found = []
        for author, block, name in zip(*(batch.column(c).to_pylist() for c in ("author_id", "block", "name")), strict=True):
            if (author, block) != key:
                key, clusters, seeds = (author, block), [], _Seeds()
            words = name.split()
            ends = (words[0], words[-1])
            k = next((i for i in seeds.fitting(ends) if all(compatible(name, n) for n in clusters[i])), len(clusters))
            if k == len(clusters):
                clusters.append([])
                seeds.add(ends, k)
            clusters[k].append(name)
            found.append({"author_id": author, "name": name, "seed": clusters[k][0]})
        yield pa.RecordBatch.from_pylist(found, SEEDED)


def leftover_groups(leftovers: DataFrame) -> DataFrame:
    """(author_id, work_author_id, cluster): an author's works, first fit by compatible names in order of name.

    Different names of an author with the same initials meet in a task: others cannot share a cluster, and a name alone with its initials
    is a cluster without more ado. Clusters are numbered in
    order of their first names, as they come to be; the empty name fits all of them, so it goes to the first and changes nothing else.
    """
    rows = staged(leftovers.select("author_id", "work_author_id", F.trim(search_form_of("name")).alias("name")), "leftovers")
    named = rows.where("name <> ''").select("author_id", "name", name_block(F.col("name")).alias("block")).distinct()
    held = staged(named.withColumn("alone", F.count("*").over(Window.partitionBy("author_id", "block")) == 1), "names")
    several = held.where("NOT alone").repartition("author_id", "block").sortWithinPartitions("author_id", "block", "name")
    grouped = several.mapInArrow(_first_fit, "author_id long, name string, seed string")
    seeded = staged(grouped.unionByName(held.where("alone").select("author_id", "name", F.col("name").alias("seed"))), "seeds")
    number = (F.row_number().over(Window.partitionBy("author_id").orderBy("seed")) - 1).cast("long")
    numbers = seeded.select("author_id", "seed").distinct().withColumn("cluster", number)
    known = seeded.join(numbers, ["author_id", "seed"]).select("author_id", "name", "cluster")
    placed = rows.where("name <> ''").join(known, ["author_id", "name"])
    return placed.unionByName(rows.where("name = ''").withColumn("cluster", F.lit(0).cast("long"))).select("author_id", "work_author_id", "cluster")
