"""The likeliest authors of new authorships among those of like names, found inside groups of names without writing pairs.

Authorships of candidate authors are dealt by a group of names (whatever puts a name and the authors that it may be with together),
and so are new ones; in a task postings of both sides are looked up in sorted arrays, and only each new authorship's leading
authors leave it. A group of more than a part's authorships is dealt in parts on either side, each with leading authors of its own.
Where most pairs of a part share something, the postings that many hold are not multiplied out: products of incidence matrices
give what they add to every pair, pairs that cannot lead by it are left out, and those that are left are counted as all others.
Totals are whole ten-thousandths, so that they and their ties are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioflow.functions.columns import newest
from biblioflow.operators.evidence import CITED, CITES, COAUTHOR, CONCEPT, FEATURE, INSTITUTION, REFERENCE, SETS, SIMILAR
from biblioflow.sources.stages import sized, staged

#: Authorships of known authors, and new ones, that a part of a group has at most on average.
PART = 1 << 16
#: Shared postings that are counted at once, rows that wait for whole groups.
AT_ONCE, WAITING = 1 << 19, 1 << 15
#: A part of at least SCANNED pairs with more shared postings than one in CROWDED pairs is scanned, by postings that more than one in HOT pairs share.
SCANNED, CROWDED, HOT = 1 << 13, 8, 256
#: Pairs and new authorships that are scanned at once, members in one product, members of an author that are compared side by side.
SCAN, ABREAST, TILE, LAYERS = 1 << 21, 128, 2048, 32
#: What two totals may differ by for rounding to four digits and to 32 bits, and the least total that counts.
NEAR, LEAST = 0.0004, 0.00001
#: What two scores may differ by for rounding to 64 bits.
ALIKE = 1e-12
AUTHOR, MEMBER, NEW = range(3)
OUT = pa.schema([("work_author_id_1", pa.string()), ("author_id", pa.int64()), ("work_author_id_2", pa.string()), ("orcid_2", pa.string()), ("same", pa.bool_()), *[(c, pa.int32()) for c in ("inst_per", *FEATURE.values(), "citation_work_match")]])
OUT_DDL = "work_author_id_1 string, author_id long, work_author_id_2 string, orcid_2 string, same boolean, inst_per int, concepts_per int, coauthors_per int, citation_per int, citation_work_match int"


def _spread(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of the given lengths: the run of every element, and its place in it."""
    run = np.repeat(np.arange(len(lengths)), lengths)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _items(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every element of a list column."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(lengths)), lengths), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _among(keys: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which keys are in ``held``, which is sorted."""
    at = np.searchsorted(held, keys)
    return (at < len(held)) & (held[np.minimum(at, len(held) - 1)] == keys) if len(held) else np.zeros(len(keys), bool)


class Groups:
    """Whole parts of groups: rows in order of part, kind, author and authorship."""

    def __init__(self, rows: pa.Table, part: np.ndarray):
        kind = rows["kind"].to_numpy()
        self.of = {k: rows.filter(pa.array(kind == k)).combine_chunks() for k in (AUTHOR, MEMBER, NEW)}
        parts = {k: part[kind == k] for k in self.of}
        number = lambda k, c: self.of[k][c].to_numpy(zero_copy_only=False).astype(np.int64)
        self.authors = np.unique(number(AUTHOR, "author_id"))
        wide = len(self.authors)
        place = lambda k: parts[k] * wide + np.searchsorted(self.authors, number(k, "author_id"))
        headers = place(AUTHOR)  # sorted, as the rows are
        known = _among(number(MEMBER, "author_id"), self.authors) & _among(place(MEMBER), headers)
        if not known.all():  # members of others than this round's candidates
            self.of[MEMBER], parts[MEMBER] = self.of[MEMBER].filter(pa.array(known)).combine_chunks(), parts[MEMBER][known]
        self.author_of = np.searchsorted(headers, place(MEMBER))  # row of the author, for each member
        self.names = {k: number(k, "name") for k in (MEMBER, NEW)}
        known, ids = np.unique(np.concatenate([self.items(AUTHOR, "listed")[1], self.names[NEW]]), return_inverse=True)
        row, values = self.items(AUTHOR, "listed")
        self.n_names, self.name_of = len(known), ids[len(values) :]
        self.fits = np.sort(row * self.n_names + ids[: len(values)])
        row, values = self.items(NEW, "listed")
        held = _among(values, self.authors)
        self.barred = np.sort(row[held] * wide + np.searchsorted(self.authors, values[held]))
        self.sizes = {k: {c: self.lengths(k, c) for c in SIMILAR} for k in (MEMBER, NEW)}
        self.index(parts)

    def column(self, k: int, c: str) -> pa.Array:
        found = self.of[k][c]
        return found.chunk(0) if found.num_chunks else pa.array([], found.type)

    def items(self, k: int, c: str) -> tuple[np.ndarray, np.ndarray]:
        return _items(self.column(k, c))

    def lengths(self, k: int, c: str) -> np.ndarray:
        return self.column(k, c).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)

    def index(self, parts: dict[int, np.ndarray]) -> None:
        """Postings of both sides, those of members that are asked for in order of their part, kind and token."""
        sides = {}
        for k in (MEMBER, NEW):
            own, cited = self.items(k, "paper"), self.items(k, "citations")
            found = {INSTITUTION: self.items(k, "institutions"), CONCEPT: self.items(k, "concepts"), COAUTHOR: self.items(k, "coauthors"), REFERENCE: cited}
            found |= {CITES: cited, CITED: own} if k == NEW else {CITES: own, CITED: cited}
            sides[k] = [np.concatenate(x) for x in zip(*((r, np.full(len(r), kind), v) for kind, (r, v) in found.items()), strict=True)]
        tokens = np.unique(sides[NEW][2])
        sides[MEMBER] = [x[asked] for asked in (_among(sides[MEMBER][2], tokens),) for x in sides[MEMBER]]
        keys = {k: (parts[k][row] * 6 + kind) * (len(tokens) + 1) + np.searchsorted(tokens, token) for k, (row, kind, token) in sides.items()}
        if len(keys[NEW]) * 16 < len(keys[MEMBER]):  # few are asked for
            asked = _among(keys[MEMBER], np.unique(keys[NEW]))
            sides[MEMBER], keys[MEMBER] = [x[asked] for x in sides[MEMBER]], keys[MEMBER][asked]
        order = np.argsort(keys[MEMBER], kind="stable")
        self.posted, held = sides[MEMBER][0][order], keys[MEMBER][order]
        order = np.argsort(sides[NEW][0], kind="stable")
        self.asker, self.asked_kind, keys = sides[NEW][0][order], sides[NEW][1][order], keys[NEW][order]
        self.at = np.searchsorted(held, keys)
        self.many = np.searchsorted(held, keys, side="right") - self.at
        self.parts, self.asked = parts, keys
        n = int(max((x.max(initial=-1) for x in parts.values()), default=-1)) + 1
        pairs = np.bincount(parts[MEMBER], minlength=n) * np.bincount(parts[NEW], minlength=n)
        part = parts[NEW][self.asker]
        self.crowded = (pairs >= SCANNED) & (np.bincount(part, weights=self.many, minlength=n) * CROWDED > pairs)
        self.spread = self.many  # members that an asking posting meets one by one
        if self.crowded.any():
            _, which, askers = np.unique(keys, return_inverse=True, return_counts=True)
            self.spread = np.where(self.crowded[part] & (self.many * askers[which] * HOT > pairs[part]), 0, self.many)

    def leading(self, most: int, weights: tuple[float, ...] | None = None) -> Iterator[pa.RecordBatch]:
        n = self.of[NEW].num_rows
        if not n:
            return
        part = np.where(self.crowded[self.parts[NEW]], self.parts[NEW], -1)
        members = np.bincount(self.parts[MEMBER], minlength=len(self.crowded))[self.parts[NEW]]
        abreast = np.clip(SCAN // np.maximum(members, 1), 1, ABREAST)
        work = np.bincount(self.asker, weights=self.spread, minlength=n) + np.where(part < 0, 1, AT_ONCE // abreast)
        stretch = (np.cumsum(work) // AT_ONCE).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, (stretch[1:] != stretch[:-1]) | (part[1:] != part[:-1])])
        scan = None
        for a, b in zip(starts, [*starts[1:], n], strict=True):
            if part[a] < 0:
                scan = None
            elif scan is None or scan.part != part[a]:
                scan = Scan(self, part[a])
            if (found := self.stretch(a, b, most, scan, weights)) is not None:
                yield found

    def stretch(self, a: int, b: int, most: int, scan: Scan | None, weights: tuple[float, ...] | None) -> pa.RecordBatch | None:
        """The leading authors of a stretch of new authorships, by their best members."""
        m = self.of[MEMBER].num_rows
        own = slice(*np.searchsorted(self.asker, [a, b]))
        run, place = _spread(self.spread[own])
        cells = (self.asker[own][run] * m + self.posted[self.at[own][run] + place]) * 8 + self.asked_kind[own][run]
        if scan is not None:
            cells = np.concatenate([cells, scan.leading(a, b, most) * 8 + 7])  # of no kind, so that they are there and add nothing
        if not len(cells):
            return None
        cells.sort()
        kind, cells = cells & 7, cells >> 3
        starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
        shared = [np.add.reduceat((kind == k).astype(np.int64), starts) for k in range(6)]
        cells = cells[starts]
        new, member = np.divmod(cells, m)
        if scan is not None:
            for k, more in scan.shared(new, member):
                shared[k] += more
        parts = [(shared[INSTITUTION] > 0) * 1]
        for c, k in SIMILAR.items():
            union = np.maximum(self.sizes[NEW][c][new] + self.sizes[MEMBER][c][member] - shared[k], 1)
            parts.append((20_000 * shared[k] + union) // (2 * union))  # rounded to four digits, halves up
        parts.append((shared[CITES] + shared[CITED] > 0) * 1)
        total = 10_000 * (parts[0] + parts[-1]) + sum(parts[1:-1])

        author = self.author_of[member]
        starts = np.flatnonzero(np.r_[True, (new[1:] != new[:-1]) | (author[1:] != author[:-1])])
        top = np.maximum.reduceat(total * m + (m - 1 - member), starts)  # the first member of the best
        total, member, new, author = top // m, m - 1 - top % m, new[starts], author[starts]
        at = np.searchsorted(cells, new * m + member)
        of_author = np.searchsorted(self.authors, self.column(AUTHOR, "author_id").to_numpy(zero_copy_only=False))
        fine = (total > 0) & _among(author * self.n_names + self.name_of[new], self.fits) & ~_among(new * len(self.authors) + of_author[author], self.barred)
        total, member, new, author, at = (x[fine] for x in (total, member, new, author, at))
        order = np.lexsort((author, -total, new))
        first = np.flatnonzero(np.r_[True, new[order][1:] != new[order][:-1]]) if len(order) else np.empty(0, int)
        kept = order[_spread(np.diff(np.r_[first, len(order)]))[1] < most]
        member, new, author, at = (x[kept] for x in (member, new, author, at))
        if weights is not None and len(new):
            won = self.winning(new, member, author, [p[at] for p in parts], weights)
            member, new, author, at = (x[won] for x in (member, new, author, at))
        taken = lambda k, c, i: self.column(k, c).take(pa.array(i))
        columns = [taken(NEW, "id", new), taken(AUTHOR, "author_id", author), taken(MEMBER, "id", member), taken(AUTHOR, "orcid", author), pa.array(self.names[MEMBER][member] == self.names[NEW][new])]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*columns, *(pa.array(x[at]) for x in parts)], OUT, strict=True)], schema=OUT)

    def winning(self, new: np.ndarray, member: np.ndarray, author: np.ndarray, parts: list[np.ndarray], weights: tuple[float, ...]) -> np.ndarray:
        """Which of the leading authors may have a new authorship's best score among those of compatible identifiers.

        Scores that are alike all stay, and so do all of a group whose members are dealt to several parts.
        """
        taken = lambda k, c, i: self.column(k, c).take(pa.array(i)).to_numpy(zero_copy_only=False)
        mine, theirs = taken(NEW, "orcid", new), taken(AUTHOR, "orcid", author)
        inst, concepts, coauthors, citations, cites = parts
        same = np.where(self.names[MEMBER][member] == self.names[NEW][new], taken(NEW, "points", new), 0.0)
        z = weights[0] + weights[1] * inst + (weights[2] * concepts + weights[3] * coauthors + weights[6] * citations) / 10_000 + same + weights[7] * cites
        score = np.where((mine == "") | (theirs == "") | (mine == theirs), 1 / (1 + np.exp(-z)), -1.0)
        runs = np.flatnonzero(np.r_[True, new[1:] != new[:-1]])
        best = np.repeat(np.maximum.reduceat(score, runs), np.diff(np.r_[runs, len(new)]))
        return ((score >= 0) & (score >= best - ALIKE)) | (taken(NEW, "m", new) > 1)


class Scan:
    """The new authorships of a crowded part against all its members, by the postings that many of them hold.

    Sums of shared postings are products of matrices; a pair's total by these alone is no more than its whole total. Members
    stand in layers, the first of every author, the second of every author that has one, and so on, so that authors are
    compared layer by layer.
    """

    def __init__(self, groups: Groups, part: int):
        self.groups, self.part = groups, part
        self.first, last = np.searchsorted(groups.parts[MEMBER], [part, part + 1])
        self.first_new, last_new = np.searchsorted(groups.parts[NEW], [part, part + 1])
        n, n_new = last - self.first, last_new - self.first_new
        self.author, self.start, self.count = np.unique(groups.author_of[self.first : last], return_index=True, return_counts=True)
        order = np.argsort(-self.count, kind="stable")
        self.author, self.start, self.count = self.author[order], self.start[order], self.count[order]
        run, layer = _spread(self.count)
        at = self.start[run] + layer
        order = np.lexsort((layer, run, np.minimum(layer, LAYERS)))
        self.place = np.empty(n, np.int64)
        self.place[at[order]] = np.arange(n)
        self.widths = [int((self.count > k).sum()) for k in range(min(LAYERS, self.count[0]))]
        self.late = np.cumsum(np.r_[0, self.count[self.count > LAYERS] - LAYERS])[:-1]  # where those of each author beyond the layers begin
        own = slice(*np.searchsorted(groups.asker, [self.first_new, last_new]))
        hot = np.flatnonzero(groups.spread[own] != groups.many[own]) + own.start
        keys, at, column = np.unique(groups.asked[hot], return_index=True, return_inverse=True)
        kinds = groups.asked_kind[hot[at]]
        run, place = _spread(groups.many[hot[at]])
        holder = self.place[groups.posted[groups.at[hot[at]][run] + place] - self.first]
        asker = groups.asker[hot] - self.first_new
        self.terms, self.counts = [], {}
        for wanted in ((INSTITUTION,), *((k,) for k in SIMILAR.values()), (CITES, CITED)):
            if not (of := np.isin(kinds, wanted)).any():
                continue
            number = np.cumsum(of) - 1
            mine, theirs = np.zeros((n, of.sum()), np.float32), np.zeros((of.sum(), n_new), np.float32)
            mine[holder[of[run]], number[run[of[run]]]] = 1
            theirs[number[column[of[column]]], asker[of[column]]] = 1
            c = next((c for c, k in SIMILAR.items() if (k,) == wanted), None)
            sizes = c and [np.maximum(x, 1).astype(np.float32) for x in (groups.sizes[MEMBER][c][self.first : last][np.argsort(self.place)], groups.sizes[NEW][c][self.first_new : last_new])]
            self.terms.append((mine, theirs, sizes))
            self.counts |= {k: (mine[:, kinds[of] == k], theirs[kinds[of] == k]) for k in wanted}

    def shared(self, new: np.ndarray, member: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(kind, number of the scan's postings that are shared) of pairs."""
        for k, (mine, theirs) in self.counts.items():
            yield k, np.einsum("ij,ij->i", mine[self.place[member - self.first]], theirs.T[new - self.first_new]).astype(np.int64)

    def totals(self, block: slice) -> np.ndarray:
        """By member and new authorship, what the scan's postings add to the total of a pair."""
        wide = block.stop - block.start
        total = np.zeros((len(self.place), wide), np.float32)
        held = np.empty((2, TILE, wide), np.float32)
        for at in range(0, len(total), TILE):
            out = total[at : at + TILE]
            shared, union = held[:, : len(out)]
            for mine, theirs, sizes in self.terms:
                np.matmul(mine[at : at + TILE], theirs[:, block], out=shared)
                if sizes:
                    np.add(sizes[0][at : at + TILE, None], sizes[1][None, block], out=union)
                    np.subtract(union, shared, out=union)
                    np.divide(shared, union, out=shared)
                else:
                    np.minimum(shared, 1, out=shared)
                np.add(out, shared, out=out)
        return total

    def leading(self, a: int, b: int, most: int) -> np.ndarray:
        """Cells of the pairs that may be the best of one of the leading authors of new authorships ``a`` to ``b``, if they share nothing else."""
        groups = self.groups
        total = self.totals(slice(a - self.first_new, b - self.first_new))
        best, at = total[: self.widths[0]].copy(), 0
        for w in self.widths:
            np.maximum(best[:w], total[at : at + w], out=best[:w])
            at += w
        if len(self.late):
            n = len(self.late)
            np.maximum(best[:n], np.maximum.reduceat(total[at:], self.late, axis=0), out=best[:n])
        best = np.ascontiguousarray(best.T)
        names, which = np.unique(groups.name_of[a:b], return_inverse=True)
        fits = _among((self.author[None, :] * groups.n_names + names[:, None]).ravel(), groups.fits).reshape(len(names), -1)
        best[~fits[which]] = -1
        if len(groups.barred):
            wide = len(groups.authors)
            new, author = np.divmod(groups.barred[slice(*np.searchsorted(groups.barred, [a * wide, b * wide]))], wide)
            ids = groups.column(AUTHOR, "author_id").to_numpy(zero_copy_only=False)[self.author]
            order = np.argsort(ids)
            spot = np.minimum(np.searchsorted(ids, groups.authors[author], sorter=order), len(ids) - 1)
            there = ids[order[spot]] == groups.authors[author]
            best[(new - a)[there], order[spot][there]] = -1
        least = np.partition(best, -most, axis=1)[:, -most, None] if most < best.shape[1] else np.float32(-1)
        new, author = np.nonzero(best >= np.maximum(least - NEAR, LEAST))
        run, place = _spread(self.count[author])
        member = self.start[author][run] + place
        near = total[self.place[member], new[run]] >= np.maximum(best[new, author] - NEAR, LEAST)[run]
        return (a + new[run][near]) * groups.of[MEMBER].num_rows + self.first + member[near]


def leading_in_parts(most: int, weights: tuple[float, ...] | None = None):
    """A function over rows in order of group, part, kind, author and authorship, for ``mapInArrow``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0
        for batch in batches:
            held.append(batch)
            waiting += batch.num_rows
            if waiting >= WAITING:
                rows, part = numbered(held)
                whole = int(np.searchsorted(part, part[-1]))  # the last part may go on
                if whole:
                    yield from Groups(rows.slice(0, whole), part[:whole]).leading(most, weights)
                held = rows.slice(whole).to_batches()
                waiting = max(0, rows.num_rows - whole - WAITING) if whole else -rows.num_rows  # a long part is looked at whenever it has doubled
        if held:
            rows, part = numbered(held)
            yield from Groups(rows, part).leading(most, weights)

    def numbered(batches: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        rows = pa.Table.from_batches(batches)
        changes = np.zeros(rows.num_rows, bool)
        for c in ("group", "of_members", "of_new"):
            x = rows[c].to_numpy()
            changes[1:] |= x[1:] != x[:-1]
        return rows, np.cumsum(changes)

    return run


def _side() -> list[Column]:
    """What is looked up of an authorship, by its columns in ``rows`` of ``leading_authors``."""
    hashed = F.transform("coauthors", lambda x: F.xxhash64(x))
    lists = {c: F.array_compact(F.array_distinct(hashed if c == "coauthors" else F.col(c))).alias(c) for c in SETS}
    return [F.col("work_author_id").alias("id"), F.array_compact(F.array("paper_id")).alias("paper"), F.xxhash64("author").alias("name"), *lists.values()]


def gathered(clusters: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Authorships of authors with what is looked up of them, in every group of their author. clusters: (work_author_id, author_id);
    groups: (author_id, group); rows: see ``leading_authors``."""
    held = clusters.select("work_author_id", "author_id").join(groups, "author_id")
    return held.join(rows.select("work_author_id", *_side()), "work_author_id").drop("work_author_id")


def leading_authors(matches: DataFrame, groups: DataFrame, new: DataFrame, clusters: DataFrame, rows: DataFrame, counts: DataFrame, most: int, barred: DataFrame | None = None, part: int = PART) -> DataFrame:
    """``leading_among`` the members that are read off clusters: (work_author_id, author_id), an authorship having one author; rows: the same
    as new, of all."""
    members = gathered(clusters, rows, matches.join(groups, "author_1").select("author_id", "group").distinct())
    return leading_among(matches, groups, new, members, counts, most, barred, part)


def leading_among(matches: DataFrame, groups: DataFrame, new: DataFrame, members: DataFrame, counts: DataFrame, most: int, barred: DataFrame | None = None, part: int = PART, weights: tuple[float, ...] | None = None) -> DataFrame:
    """(work_author_id_1, author_id, orcid_2, work_author_id_2, same, features, total_per): at most ``most`` authors of each new authorship.

    They are those of the greatest totals above zero, then of smaller ids, each with its member of the greatest total, then of the
    smaller id. matches: (author_1, author_id) that may be one; groups: (author_1, group); new: work_author_id, paper_id, author and the
    lists of SETS; members: those of ``gathered``, in all groups that may be asked for, and of any authors; counts: that of
    ``authors``; barred: (paper_id, author_id). ``same``: the member's name is the new one's. With the ``weights`` of a logistic score over
    ``assign.VECTOR`` and an orcid of each new authorship, authors that cannot have its best score among those of compatible identifiers are left out.
    """
    whole = counts.groupBy("author_id").agg(F.coalesce(F.min("orcid"), F.lit("")).alias("orcid"), F.sum("n").alias("n"))
    listed = matches.join(groups, "author_1").groupBy("group", "author_id").agg(F.collect_set(F.xxhash64("author_1")).alias("listed"))
    authors = staged(listed.join(whole, "author_id"), "candidates")
    asking = new.join(groups.withColumnRenamed("author_1", "author"), "author")
    if barred is not None:
        no = barred.groupBy("paper_id").agg(F.collect_set("author_id").alias("listed"))
        asking = asking.join(no, "paper_id", "left")
    members_of = authors.groupBy("group").agg(F.sum("n").alias("m"))
    new_of = asking.groupBy("group").agg(F.count("*").alias("n"))
    pieces = lambda c: F.ceil(F.col(c) / F.lit(part)).cast("int")
    cut = members_of.join(new_of, "group").select("group", pieces("m").alias("m"), pieces("n").alias("n")).where("m > 1 OR n > 1")
    cut = staged(cut, "parts")
    large = sized(cut, 32)

    def dealt(df: DataFrame, kind: int, mine: str | None) -> DataFrame:
        """Rows in their part of their own side, and in every part of the other; authors in all."""
        parts = df.join(large, "group", "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("m", "n")})
        for side, c in (("of_members", "m"), ("of_new", "n")):
            all_ = F.explode(F.sequence(F.lit(0), F.col(c) - 1))
            parts = parts.withColumn(side, F.pmod(F.xxhash64("id"), F.col(c)).cast("int") if side == mine else all_)
        return parts.withColumn("kind", F.lit(kind)).drop("n")

    held = members.join(sized(authors.select("group").distinct(), 16), "group", "left_semi")
    scored = [] if weights is None else ["orcid", (F.lit(weights[4]) * F.length("author") + F.lit(weights[5]) * F.size(F.split("author", " "))).alias("points")]
    asks = asking.select("group", *_side(), *scored, *(["listed"] if barred is not None else [F.array().cast("array<bigint>").alias("listed")]))
    all_ = dealt(authors.select("group", "author_id", "orcid", "listed"), AUTHOR, None).unionByName(dealt(held, MEMBER, "of_members"), True).unionByName(dealt(asks, NEW, "of_new"), True)
    keys = ["group", "of_members", "of_new"]
    ordered = all_.repartition(*keys).sortWithinPartitions(*keys, "kind", "author_id", "id")
    found = ordered.mapInArrow(leading_in_parts(most, weights), OUT_DDL)
    digits = {c: F.col(c) / F.lit(10_000.0) for c in FEATURE.values()}
    total = F.col("inst_per") + F.col("citation_work_match") + sum(F.col(c) for c in FEATURE.values()) / F.lit(10_000.0)
    found = found.withColumn("total_per", F.round(total, 6)).withColumns(digits)
    return found if cut.isEmpty() else newest(found, ["work_author_id_1", "author_id"], F.desc("total_per"), F.col("work_author_id_2"))
