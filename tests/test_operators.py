"""Golden cases worked by hand, one for each operator, and empty inputs."""

from __future__ import annotations

import json
import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from biblioflow.functions import columns, names
from biblioflow.operators import assign, citations, diff, identifiers, metrics, rules


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture(scope="module")
def impact(spark):
    """Papers 1, 2 (2016, article), 3 (2019, article), 4 (2016, dataset), all of subfield 10; seen from 2020."""
    papers = spark.createDataFrame([(1, 2016, "article", 10), (2, 2016, "article", 10), (3, 2019, "article", 10), (4, 2016, "dataset", 10)], "paper_id long, pub_year int, work_type string, subfield_id long")
    offsets = [(1, 0), (1, 1), (1, 2), (1, 4)] + [(2, 3)] * 5 + [(3, 1)]
    edges = spark.createDataFrame(offsets, "cited long, year_diff int")
    return citations.window_counts(edges, papers, 2020)


def test_window_counts(impact):
    assert rows(impact, "paper_id", "pub_plus_3_citations", "total_citations") == [(1, 3, 4), (2, 5, 5), (3, 1, 1), (4, 0, 0)]


def test_expected_and_fwci(impact):
    assert rows(citations.expected_citations(impact, 2020), "pub_year", "work_type", "expected_citations") == [(2016, "article", 4.0), (2016, "dataset", 0.0), (2019, "article", 1.0)]
    assert rows(citations.fwci(impact, 2020), "paper_id", "fwci") == [(1, 0.75), (2, 1.25), (3, 1.0), (4, None)]


def test_percentiles(impact):
    assert rows(citations.percentiles(impact), "paper_id", "percentile") == [(1, 0.0), (2, 0.33333333), (3, 0.0), (4, 0.0)]
    assert rows(citations.percentiles(impact, parity=True), "paper_id", "percentile") == [(1, 0.33333333), (2, 0.0), (3, 0.0), (4, 0.0)]


def test_fwci_without_baseline(spark):
    one = spark.createDataFrame([(1, 2016, "article", None, 2, 2, 1)], "paper_id long, pub_year int, work_type string, subfield_id long, pub_plus_3_citations long, total_citations long, citation_offsets long")
    assert rows(citations.fwci(one, 2020), "fwci") == [(None,)]
    assert rows(citations.fwci(one, 2020, parity=True), "fwci") == [(-2.0,)]


def test_edges_merge_both_ends(spark):
    works = spark.createDataFrame([(1, None), (2, 1), (3, None)], "paper_id long, merge_into_id long")
    cites = spark.createDataFrame([(2, 3), (1, 3), (3, 2), (3, 9)], "paper_id long, paper_reference_id long")
    assert rows(citations.citation_edges(cites, works), "citing", "cited") == [(1, 3), (3, 1)]


def test_dated_edges_drop_unknown_and_backward(spark):
    works = spark.createDataFrame([(1, "2016-05-01"), (2, "2018-01-01"), (3, None)], "paper_id long, publication_date string")
    edges = spark.createDataFrame([(2, 1), (1, 2), (3, 1)], "citing long, cited long")
    assert rows(citations.dated_edges(edges, works), "citing", "cited", "year_diff") == [(2, 1, 2)]


def test_primary_subfield_and_types(spark):
    wt = spark.createDataFrame([(1, 20, 1), (1, 10, 1), (1, 5, 2)], "paper_id long, topic_id long, topic_rank int")
    topics = spark.createDataFrame([(10, 7), (20, 8), (5, 9)], "topic_id long, subfield_id long")
    assert rows(citations.primary_subfield(wt, topics), "paper_id", "subfield_id") == [(1, 7)]
    works = spark.createDataFrame([(1, 1, "article"), (2, 2, "article"), (3, 1, "book"), (4, None, "article")], "paper_id long, journal_id long, type string")
    journals = spark.createDataFrame([(1, "conference", None), (2, "conference", 5)], "journal_id long, type string, merge_into_id long")
    assert rows(citations.work_types(works, journals), "paper_id", "work_type") == [(1, "conference_article"), (2, "article"), (3, "book"), (4, "article")]


def test_profile_ties_and_repeats(spark):
    members = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1)], "entity long, paper_id long")
    wt = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (3, "a")], "paper_id long, topic_id string")
    found = metrics.entity_topic_profile(members, wt, "entity", top=1)
    assert rows(found, "topic_id", "topic_count", "topic_share") == [("a", 1, 0.5), ("b", 1, 1.0)]


def test_column_helpers(spark):
    one = spark.createDataFrame([(None, [1, 2], [2, 3])], "y int, a array<int>, b array<int>")
    got = one.select(columns.clamp(F.col("y"), 0, 5).alias("y"), columns.jaccard(F.col("a"), F.col("b")).alias("j"), columns.overlap(F.col("a"), F.lit(None).cast("array<int>")).alias("o")).first()
    assert (got["y"], got["j"], got["o"]) == (None, 0.3333, 0)
    ids = spark.createDataFrame([("0000-0001-2345-6789",), ("https://orcid.org/0000-0001-2345-6789",), ("x",)], "c string")
    assert [r[0] for r in ids.select(columns.orcid_of(F.col("c"))).collect()] == ["0000-0001-2345-6789", "0000-0001-2345-6789", ""]
    keys = spark.createDataFrame([("12_3",), ("x_y",)], "w string").select(columns.paper_of(F.col("w")), columns.sequence_of(F.col("w"))).collect()
    assert [tuple(k) for k in keys] == [(12, 3), (None, None)]
    lists = spark.createDataFrame([("[1, 2]",), ("no",)], "c string").select(columns.id_list(F.col("c"))).collect()
    assert [r[0] for r in lists] == [[1, 2], None]


def test_snapshot_diff(spark):
    kinds = "k string, orcid string, alternates array<string>"
    old = spark.createDataFrame([("a", "x", ["p"]), ("b", "", ["p"]), ("c", "x", ["p", "q"]), ("e", "x", [])], kinds)
    new = spark.createDataFrame([("a", "x", ["p"]), ("b", "y", ["p"]), ("c", "x", ["q", "p"]), ("d", "", []), ("e", "x", ["n"])], kinds)
    found = diff.snapshot_diff(new, old, "k", ["orcid"], ["alternates"])
    assert rows(found, "k", "change", "changed") == [("a", "unchanged", False), ("b", "modified", True), ("c", "unchanged", False), ("d", "created", True), ("e", "modified", False)]
    assert rows(diff.vanished(new, old.union(spark.createDataFrame([("z", "", [])], kinds)), "k", ()), "k") == [("z",)]


def test_upserts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert rows(diff.upsert(target, spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string"), ["k"]), "k", "v") == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(diff.insert_missing(target, spark.createDataFrame([(2, "c"), (3, "d"), (3, "d")], "k long, v string"), ["k"]), "k", "v") == [(1, "a"), (2, "b"), (3, "d")]
    assert rows(diff.update_from(target, spark.createDataFrame([(1, None), (2, "z")], "k long, v string"), "k", ["v"]), "k", "v") == [(1, "a"), (2, "z")]
    assert rows(diff.tombstoned(target, spark.createDataFrame([(1,)], "k long"), "k", "v", "-"), "k", "v") == [(1, "-"), (2, "b")]
    queued = diff.queue_inserts(spark.createDataFrame([(1,), (1,), (2,)], "id long"), spark.createDataFrame([(2,)], "id long"))
    assert rows(queued, "id", "started") == [(1, None)]


def test_features_score_and_assignment(spark):
    kinds = "work_author_id_1 string, paper_id_1 long, author_1 string, institutions_1 array<long>, coauthors_1 array<string>, concepts_1 array<long>, citations_1 array<long>, work_author_id_2 string, paper_id_2 long, author_2 string, institutions_2 array<long>, coauthors_2 array<string>, concepts_2 array<long>, citations_2 array<long>, author_id long"
    pair = spark.createDataFrame([("1_1", 1, "ann lee", [1, 2], ["a", "b"], [1, 2, 3], [2], "2_1", 2, "ann lee", [2], ["b", "c"], [2, 3, 4], [9], 7)], kinds)
    got = assign.features(pair).first()
    assert [round(got[c], 4) for c in assign.VECTOR] == [1, 0.5, 0.3333, 7, 2, 0, 1] and round(got["total_per"], 4) == 2.8333
    assert assign.scored_candidates(assign.features(pair)).count() == 1
    cand = spark.createDataFrame([("1_1", "A", 7, "", 0.9), ("2_1", "B", 7, "", 0.6), ("3_1", "", 8, "C", 0.5), ("3_1", "D", 9, "E", 0.9)], "work_author_id_1 string, orcid_1 string, author_id long, orcid_2 string, score double")
    assert rows(assign.assigned(cand), "work_author_id_1", "author_id") == [("1_1", 7), ("3_1", 8)]


def test_allocation_is_dense_and_ordered(spark):
    df = spark.range(0, 1000, 3).repartition(7)
    got = rows(assign.allocated(df, ["id"], 100), "id", "new_id")
    assert got == [(3 * i, 101 + i) for i in range(334)]


@pytest.mark.parametrize(("a", "b", "same"), [("j smith", "john smith", True), ("john smith", "smith john", True), ("john a smith", "john b smith", False), ("john smith", "john bob smith", True), ("ann lee", "bob lee", False)])
def test_compatible_names(a, b, same):
    assert names.compatible(a, b) is same and names.compatible(b, a) is same and names.compatible(a, a)


@pytest.mark.parametrize(("author", "given", "family", "points", "ok"), [
    ("M Silva", ["Maria"], ["Silva"], [1, 0, 1], True),
    ("Maria De Silva", ["Maria"], ["Silva"], [1, 1, 0], True),
    ("Silvana Costa", ["Ana"], ["Silva"], [0.75, 0, 0], False),
    ("Wei Li", ["Wei"], ["Zhang"], [0, 0, 0], False),
    ("Ana Lopez-Garcia", ["Ana"], ["Lopez-Garcia"], [2, 1, 0], True),
    ("Jean-Pierre Dupont", ["Jean-Pierre"], ["Dupont"], [1, 2, 0], True),
    ("maria silva d", ["Maria"], ["De", "Silva"], [1, 1, 1], True),
    ("J J Smith", ["John", "James"], ["Smith"], [1, 0, 2], True),
    ("Seán O'Neill", ["Sean"], ["O’Neill"], [1, 1, 0], True),
    ("Ana", ["Ana"], [], [0, 1, 0], False),
    (None, ["Ana"], ["Silva"], [0, 0, 0], False),
])
def test_name_evidence(spark, author, given, family, points, ok):
    assert names.evidence(author, given, family) == points
    one = spark.createDataFrame([([float(p) for p in points],)], "e array<double>")
    assert one.select(names.accepted(F.col("e"))).first()[0] is ok


def plain_evidence(author, given, family):
    """D7 by words and marks: what is matched becomes a mark that no later token matches."""
    clean = lambda x: "".join(" " if c in ".,|-\u2010" else c for c in names.fold(x or "").lower() if c in ".,|-\u2010 " or c.isalpha()).split()
    text, points, rest = " ".join(clean(author)), [0.0, 0.0, 0.0], {"f": [], "g": []}
    tokens = {"f": [t for x in family for t in clean(x)], "g": [t for x in given for t in clean(x)]}
    if tokens["f"] and all(t not in text for t in tokens["f"]):
        return points
    for k, (kind, own) in enumerate((("f", tokens["f"]), ("g", tokens["g"]))):
        for t in own:
            words = text.split(" ")
            if len(t) > 1 and t in words:
                points[k] += 1
                text = re.sub(rf"(^| ){t}( |$)", lambda m: m[1] + m[2], text, count=1).strip()
            elif len(t) > 1 and t in text:
                points[k] += 0.75
                text = text.replace(t, "", 1).strip()
            else:
                rest[kind].append(t)
    for t in rest["g"] + rest["f"]:
        words = text.split(" ")
        if t[0] in words:
            points[2] += 1
            words.remove(t[0])
            text = " ".join(words)
    return points


def test_evidence_matches_a_plain_version():
    rng = random.Random(5)
    words = ["Ana", "An", "A", "B", "De", "Lopez-Garcia", "Garcia", "Lopez", "Silva", "Silvana", "D.", "van", "O'Neil"]
    for _ in range(3000):
        author, given, family = ([rng.choice(words) for _ in range(rng.randrange(n, 4))] for n in (1, 0, 0))
        assert names.evidence(" ".join(author), given, family) == plain_evidence(" ".join(author), given, family), (author, given, family)


def test_structures_and_the_guard_against_swaps():
    structure = lambda *forms: names.merged_slots([names.slots(f) for f in forms])
    same = lambda a, b: (names.compatible_slots(structure(*a), structure(*b)), names.compatible_slots(structure(*b), structure(*a)))
    assert structure("john smith", "j a smith")["first"] == (["john"], ["j"]) and structure("john smith", "smith john")["last"] == (["john", "smith"], ["j", "s"])
    assert same(["john smith", "smith john"], ["john smith"]) == (True, True)
    assert same(["john smith", "smith john"], ["john smith", "smith john"]) == (True, True)
    # one name in all four lists and the other different on both sides: not one person
    assert same(["wei zhang", "zhang wei"], ["wei li", "li wei"]) == (False, False)
    assert same(["ann lee", "anna lee"], ["ann lee"]) == (True, True) and same(["ann lee"], ["bob lee"]) == (False, False)


def plain_compatible(a: str, b: str) -> bool:
    """D9 for search forms, slot by slot."""
    u, v = a.split(), b.split()
    if not u or not v:
        return True
    agree = lambda x, y: x == y if len(x) > 1 and len(y) > 1 else x[0] == y[0]
    if not agree(u[0], v[0]):
        return len(u) == len(v) == 2 and u == v[::-1]
    if not agree(u[-1], v[-1]):
        return False
    return all(agree(x, y) for x, y in zip(u[1:-1], v[1:-1], strict=False))


def test_compatibility_matches_a_plain_version_and_its_expression(spark):
    rng = random.Random(6)
    words = ["john", "j", "jon", "smith", "s", "a", "ann", "bo", "b"]
    forms = sorted({" ".join(rng.choice(words) for _ in range(rng.randrange(5))) for _ in range(60)})
    parts = spark.createDataFrame([(f,) for f in forms], "s string").select("s", names.slots_of("s").alias("slots"), F.filter(F.split("s", " "), lambda x: x != "").alias("words"))
    side = lambda c: parts.select(F.col("s").alias(c), F.col("slots").alias(f"{c}_slots"), F.col("words").alias(f"{c}_slots_words"))
    met = side("a").crossJoin(side("b")).select("a", "b", names.slots_match("a_slots", "b_slots").alias("same"))
    for r in met.collect():
        assert r["same"] == names.compatible(r["a"], r["b"]) == plain_compatible(r["a"], r["b"]), (r["a"], r["b"])


def test_display_names(spark):
    given = [("a", "John Smith"), ("a", "John Smith"), ("a", "J Smith"), ("a", "JSmith"), ("b", "Ann Lee"), ("b", "Anna Lee"), ("c", "Jose Diaz"), ("c", "Jose Diaz"), ("c", "José Díaz"), ("d", None), (None, "No Key")]
    d = spark.createDataFrame(given, "k string, n string")
    assert {(r["k"], r["display_name"]) for r in names.display_names(d, "k", "n").collect()} == {("a", "John Smith"), ("b", "Anna Lee"), ("c", "José Díaz"), ("d", ""), (None, "No Key")}
    d = spark.createDataFrame([("a", n) for n in ("J. Smith", "J Smith", "john lee (", None, "Mary\u2010Ann")], "k string, n string")
    assert rows(names.alternates(d, "k", "n"), "name") == [("J. Smith",), ("Mary-Ann",), ("john lee",)]


def test_name_forms(spark):
    assert names.search_form("O'Néil-Ørsted, J.") == "oneilorsted j"
    assert names.parsed("Smith, John") == "John Smith" and names.parsed("Smith J K") == "J K Smith" and names.parsed("None Dr. Ann Lee") == "Ann Lee"
    assert names.scripts("Ann 李") == ["CJK"]
    got = names.slots("mary-jane watson")
    assert got["first"] == (["mary", "maryjane"], ["m"]) and got["last"] == (["watson"], ["w"])
    assert not names.display_changed("Ann Lee", "ann lee") and names.display_changed("Ann Lee", "A Lee")
    keyed = spark.createDataFrame([("Ann B. Lee-Ray",), ("None",), (None,)], "n string").select(names.coauthor_key(F.col("n")), names.usable(F.col("n"))).collect()
    assert [tuple(k) for k in keyed] == [("a_leeray", True), ("none", False), (None, False)]
    lists = spark.createDataFrame([(["Ann B. Lee-Ray", "ann lee-ray", "Bo Li", None],), (None,)], "c array<string>").select(names.coauthor_keys(F.col("c"))).collect()
    assert [r[0] for r in lists] == [["a_leeray"], []]
    assert [r[0] for r in spark.createDataFrame([("ann lee",), ("lee",)], "s string").select(names.letter_of(F.col("s"))).collect()] == ["a", ""]
    one = spark.createDataFrame([(" ;(12) Ann  &NA; Lee*",), (None,)], "n string").select(names.cleaned(F.col("n"))).collect()
    assert [r[0] for r in one] == ["Ann Lee", ""]


def test_identifier_priority(spark):
    own = "0000-0001-2345-6789"
    d = spark.createDataFrame([(None, "x", own), (f"https://orcid.org/{own}", "a" * 19, ""), ("", "a" * 19, own), ("x", None, None)], "u string, h string, s string")
    assert [r[0] for r in d.select(identifiers.chosen_identifier(F.col("u"), F.col("h"), F.col("s"))).collect()] == [own, own, "a" * 19, ""]


def test_reconciled_identifiers(spark):
    claims = spark.createDataFrame([(1, 1, "Maria Silva", "o"), (1, 2, "M Silva", "o"), (2, 1, "Wei Zhang", "o"), (3, 1, "M Silva", "o"), (3, 2, "M Silva", "o")], "paper_id long, author_sequence_number int, original_author string, orcid string")
    registry = spark.createDataFrame([("o", "Maria", "Silva")], "orcid string, given_names string, family_name string")
    assert rows(identifiers.reconciled(claims, registry), "paper_id", "author_sequence_number") == [(1, 1)]


def test_overmerged_authors_are_split(spark):
    empty = ([], [], [], [], [])
    kinds = "author_id long, work_author_id string, orcid string, name string, institutions array<long>, coauthors array<string>, concepts array<long>, citations array<long>, coauthor_orcids array<string>, topics array<long>, subfields array<long>, fields array<long>"
    def row(w, o, n, inst):
        return (1, w, o, n, inst, empty[0], empty[1], empty[2], empty[3], empty[4], [], [])
    works = spark.createDataFrame([row("1_1", "A", "Ann Lee", [1]), row("2_1", "B", "Bob Lee", [2]), row("3_1", "", "A Lee", [1]), row("4_1", "", "B Lee", [2]), row("5_1", "", "C Lee", [9])], kinds)
    none = spark.createDataFrame([], "author_id long")
    given = identifiers.reassigned(works, none, rounds=2)
    assert rows(given.distinct(), "work_author_id", "orcid") == [("3_1", "A"), ("4_1", "B")]
    assert rows(identifiers.split_requests(works, given, "2020"), "request", "works") == [("1-orc-B-2020", ["2_1", "4_1"])]
    assert identifiers.reassigned(works, spark.createDataFrame([(1,)], "author_id long"), rounds=1).count() == 0
    left = spark.createDataFrame([(1, "1_1", "Ann Lee"), (1, "2_1", "A Lee"), (1, "3_1", "Bob Lee")], "author_id long, work_author_id string, name string")
    assert rows(identifiers.leftover_groups(left), "work_author_id", "cluster") == [("1_1", 0), ("2_1", 0), ("3_1", 1)]


def test_merge_map_and_winners(spark):
    merges = spark.createDataFrame([(1, 2), (3, 4)], "merge_from_id long, merge_to_id long")
    frozen = spark.createDataFrame([(1,), (1,)], "author_id long")
    assert rows(assign.merge_map(merges, frozen), "merge_from_id", "merge_to_id") == [(2, 1), (3, 4)]
    members = spark.createDataFrame([(1, "A"), (2, "A"), (2, "A"), (3, ""), (4, "B"), (5, "B")], "author_id long, orcid string")
    assert rows(assign.identifier_winners(members, frozen), "author_id", "winner_id") == [(2, 1), (5, 4)]


def test_collapse_expand_and_kept_ids(spark):
    own = spark.createDataFrame([("1_1", "a", [1]), ("2_1", "a", [1]), ("3_1", "b", [1])], "w string, name string, s array<long>")
    groups = assign.collapsed(own, "w", ["name", "s"])
    given = groups.select("w", F.col("name").alias("author"))
    assert rows(assign.expanded(given, groups, "w"), "w", "author") == [("1_1", "a"), ("2_1", "a"), ("3_1", "b")]
    kinds = "author_id long, work_author_id string"
    new = spark.createDataFrame([(10, "x"), (10, "y"), (11, "z")], kinds)
    old = spark.createDataFrame([(1, "y"), (1, "x"), (2, "z"), (2, "q")], kinds)
    assert rows(assign.kept_ids(new, old), "author_id", "old_id") == [(10, 1)]


KINDS = "work_author_id string, paper_id long, author string, orcid string, institutions array<long>, coauthors array<string>, concepts array<long>, citations array<long>"


def test_cascade_rounds(spark):
    rows_ = [
        ("1_1", 1, "Ann Lee", "O", [], [], [], []), ("2_1", 2, "Ann Lee", "", [5], ["Some Coauthor"], [1], [90]), ("3_1", 3, "A Lee", "", [5], ["Some Coauthor"], [1], [90]),
        ("4_1", 4, "Ann Lee", "", [], [], [], []), ("5_1", 5, "None", "", [], [], [], []), ("90_1", 90, "Ann Lee", "", [5], ["Some Coauthor"], [1], []), ("91_1", 91, "Someone Else", "O", [], [], [], []),
        ("6_1", 6, "Ann Lee", "", [77], [], [], [2]),  # its only evidence is authorship 2_1, which the round before adds
        ("7_1", 7, "Ann Lee", "", [5], ["Some Coauthor"], [1], [90]),  # barred from author 7
        ("8_1", 8, "Ann Lee", "", [], [], [], []),  # equal to 4_1 in all features
    ]
    works = spark.createDataFrame(rows_, KINDS)
    current = spark.createDataFrame([("90_1", 7), ("91_1", 8)], "work_author_id string, author_id long")
    removed = spark.createDataFrame([(7, 7)], "paper_id long, author_id long")
    got = rows(assign.disambiguated(works, current, 100, removed=removed), "work_author_id", "author_id", "how")
    assert got == [
        ("1_1", 8, "identifier"), ("2_1", 7, "name"), ("3_1", 7, "compatible"), ("4_1", 101, "new"), ("5_1", diff.NULL_BUCKET, "unnamed"),
        ("6_1", 7, "name again"), ("7_1", 102, "new"), ("8_1", 101, "new"), ("90_1", 7, "kept"), ("91_1", 8, "kept"),
    ]


def test_an_author_gains_one_identifier_in_all_rounds(spark):
    """Author 7 gains A by exact name; B, which fits by a compatible name a round later, is then another person's."""
    rows_ = [("90_1", 90, "Ann Lee", "", [5], [], [1], []), ("1_1", 1, "Ann Lee", "A", [5], [], [1], [90]), ("2_1", 2, "A Lee", "B", [5], [], [1], [90])]
    works, current = spark.createDataFrame(rows_, KINDS), spark.createDataFrame([("90_1", 7)], "work_author_id string, author_id long")
    assert rows(assign.disambiguated(works, current, 100), "work_author_id", "author_id", "how") == [("1_1", 7, "name"), ("2_1", 101, "new"), ("90_1", 7, "kept")]


def test_curation_comes_first(spark):
    """Newest request, merges (a frozen author keeps its id), parted works, splits, shared identifiers, kept ids."""
    named = lambda k, orcid="": (f"{k}_1", k, f"Person {chr(97 + k % 26)}{chr(97 + k // 26)}", orcid, [], [], [], [])
    works = spark.createDataFrame([named(k, {60: "X", 61: "X"}.get(k, "")) for k in (10, 20, 30, 31, 40, 50, 51, 60, 61, 70)], KINDS)
    ids = "work_author_id string, author_id long"
    current = spark.createDataFrame([("10_1", 1), ("20_1", 2), ("30_1", 3), ("31_1", 33), ("40_1", 4), ("50_1", 5), ("51_1", 5), ("60_1", 6), ("61_1", 66), ("70_1", 9)], ids)
    day = lambda n: datetime(2025, 1, n)
    requests = spark.createDataFrame([("10_1", 100, day(1)), ("10_1", 101, day(2))], "work_author_id string, new_author_id long, request_date timestamp")
    merges = spark.createDataFrame([(2, 22), (3, 33)], "merge_from_id long, merge_to_id long")
    frozen = spark.createDataFrame([(3,), (66,)], "author_id long")
    removed = spark.createDataFrame([(40, 4), (70, 9)], "paper_id long, author_id long")
    splits = spark.createDataFrame([("s", "50_1")], "request string, work_author_id string")
    got = {r["work_author_id"]: (r["author_id"], r["how"]) for r in assign.disambiguated(works, current, 1000, requests, merges, frozen, removed, splits).collect()}
    assert got["10_1"] == (101, "kept") and got["20_1"] == (22, "kept") and got["30_1"] == got["31_1"] == (3, "kept")
    assert got["50_1"] == (1001, "split") and got["51_1"] == (5, "kept") and got["60_1"] == got["61_1"] == (66, "kept")
    assert got["40_1"] == (4, "new") and got["70_1"] == (9, "new")  # alone as before, so they keep their old ids


def test_disambiguation_input(spark):
    aff = spark.createDataFrame([(1, -1, 5, 1, "A", "o"), (1, -1, 6, 1, "Ann Lee", ""), (1, 9, 5, 2, "Bob", ""), (2, -1, 5, 1, "C", "")], "paper_id long, author_id long, affiliation_id long, author_sequence_number int, original_author string, original_orcid string")
    works = spark.createDataFrame([(1, None, None), (2, 1, None)], "paper_id long, merge_into_id long, created_date timestamp")
    concepts = spark.createDataFrame([(1, 3, 0.9), (1, 4, 0.1), (1, 41008148, 0.9)], "paper_id long, field_of_study long, score double")
    got = assign.disambiguation_input(aff, works, concepts, spark.createDataFrame([(1, 8)], "paper_id long, paper_reference_id long")).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["work_author_id"], r["original_author"], r["orcid"], r["institutions"], r["concepts"], r["citations"], r["coauthors"]) == ("1_1", "Ann Lee", "o", [5, 6], [3], [8], ["Bob"])


def test_rules_and_rewrites(spark):
    texts = spark.createDataFrame([("Lab CRCA, Toulouse",), ("xCRCAx",), (None,)], "text string")
    found = rules.matched(texts, [rules.Rule(("word", "CRCA"), (9,)), rules.Rule(("id", 9), (10,))])
    assert [r["ids"] for r in found.collect()] == [[9, 10], [], []]
    one = spark.createDataFrame([("an x here", [-1, 5])], "text string, ids array<long>")
    assert rules.rewritten(one, [rules.Rewrite(("and", ("id", 5), ("has", "x")), (5,), (6,))]).first()["ids"] == [6]
    lists = spark.createDataFrame([([1, 2], []), ([-1], []), ([1], [-1, 5]), ([1], [-1])], "b array<long>, o array<long>")
    assert [r[0] for r in lists.select(rules.chosen_ids(F.col("b"), F.col("o"))).collect()] == [[1, 2], [-1], [5], [-1]]
    parent = spark.createDataFrame([("third branch", [2])], "text string, ids array<long>")
    assert rules.rewritten(parent, rules.family(1, {2: ("third", 3)})).first()["ids"] == [1, 3]


def made_up_rules(n: int, rng) -> tuple[list, list]:
    word = lambda: rng.choice("abcdefgh") + rng.choice(["ar", "el", "in", "ou"]) + rng.choice(["", "x", "y"])

    def predicate(depth: int = 0, ids: bool = False):
        kind = rng.choice(["has", "has_lower", "any", "any_lower", "all", "word", "regex", "replaced", "not", "and", "or", *(["id", "ids_more_than"] if ids else [])])
        match kind:
            case "has" | "word":
                return (kind, word())
            case "has_lower":
                return (kind, word())
            case "any" | "any_lower" | "all":
                return (kind, [word() for _ in range(rng.randrange(1, 3))])
            case "regex":
                return (kind, f"{word()} ?[a-c]")
            case "replaced":
                return (kind, {"-": " "}, f"{word()} {word()}"[:4])
            case "id":
                return (kind, rng.randrange(60))
            case "ids_more_than":
                return (kind, rng.randrange(4))
        if depth > 1:
            return ("has", word())
        return (kind, predicate(depth + 1, ids)) if kind == "not" else (kind, predicate(depth + 1, ids), ("has", word()))

    own = [rules.Rule(predicate(), (rng.randrange(60),), rng.choice([None, None, "g1", "g2"]), rng.randrange(5)) for _ in range(n)]
    own += [rules.Rule(("and", ("id", rng.randrange(60)), predicate()), (rng.randrange(60, 70),)) for _ in range(5)]
    changes = [rules.Rewrite(("and", predicate(1, True), ("id", rng.randrange(70))) if rng.random() < 0.7 else predicate(1, True), (rng.randrange(70),), tuple(rng.sample(range(70), rng.randrange(2)))) for _ in range(n)]
    return own, changes


def holds(p: tuple, text: str, ids: set) -> bool:
    """A predicate by itself, without automaton or triggers."""
    kind, *args = p
    low, outside = text.lower(), lambda i: i < 0 or i >= len(text) or not (text[i].isalnum() or text[i] == "_")
    match kind:
        case "not":
            return not holds(args[0], text, ids)
        case "and":
            return all(holds(x, text, ids) for x in args)
        case "or":
            return any(holds(x, text, ids) for x in args)
        case "has" | "has_lower":
            return args[0] in (text if kind == "has" else low)
        case "any" | "all":
            return (any if kind == "any" else all)(x in text for x in args[0])
        case "any_lower":
            return any(x in low for x in args[0])
        case "word":
            return any(text.startswith(args[0], i) and outside(i - 1) and outside(i + len(args[0])) for i in range(len(text)))
        case "regex":
            return re.search(args[0], text) is not None
        case "replaced":
            for old, new in args[0].items():
                text = text.replace(old, new)
            return args[1] in text
        case "id":
            return args[0] in ids
    return len(ids) > args[0]


def plain_ids(own: list, changes: list, text: str) -> list[int]:
    ids: set[int] = set()
    for late in (False, True):
        done, more = set(), set()
        for r in sorted([r for r in own if rules.tests_ids(r.predicate) == late], key=lambda r: r.priority):
            if not (r.group and r.group in done) and holds(r.predicate, text, ids):
                more |= set(r.emits)
                done.add(r.group)
        ids |= more
    for c in changes:
        if holds(c.predicate, text, ids):
            ids = (ids - set(c.removes)) | set(c.adds)
    return sorted(ids - {-1}) or [-1]


@pytest.mark.parametrize("n", [1, 64, 65, 200])
def test_rules_mean_the_same_in_tables_of_any_size(spark, n):
    own, changes = made_up_rules(n, random.Random(n))
    rng = random.Random(8)
    words = [a + b + c for a in "abcdefgh" for b in ("ar", "el", "in", "ou") for c in ("", "x", "y")]
    texts = [rng.choice([" ", "-", ", "]).join(rng.choice([str, str.upper, str.title])(rng.choice(words)) for _ in range(rng.randrange(12))) for _ in range(150)] + [""]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["text"]: r["ids"] for r in rules.rewritten(rules.matched(d, own), changes).collect()}
    assert got == {t: plain_ids(own, changes, t) for t in texts} and (n == 1 or len(set(map(tuple, got.values()))) > 5)


@pytest.mark.parametrize("more", [0, 61, 62, 500])
def test_patterns_know_all_scripts_beside_any_number_of_rules(spark, more):
    own = [rules.Rule(("regex", r"^\w+$"), (1,)), rules.Rule(("regex", r"^\d+$"), (2,)), rules.Rule(("regex", r"\bÉCOLE\b"), (3,)), rules.Rule(("regex", r"(?i)école"), (4,)), rules.Rule(("has", "x"), (5,), ""), rules.Rule(("has", "x"), (6,), "")]
    own += [rules.Rule(("has", f"unseen{k}"), (100 + k,)) for k in range(more)]
    d = spark.createDataFrame([("Zürich",), ("٣٤٥",), ("une ÉCOLE, là",), ("ÉCOLE x",), ("xÉCOLEx",), (None,)], "text string")
    assert [r["ids"] for r in rules.matched(d, own).collect()] == [[1], [1, 2], [3, 4], [3, 4, 5, 6], [1, 4, 5, 6], []]
    for bad in (("all", []), ("any", []), ("any_lower", []), ("and",), ("no such kind", 1), ("has",), ("not", ("has", "a"), ("has", "b"))):
        with pytest.raises(ValueError):
            rules.matched(d, [*own, rules.Rule(bad, (9,))])
        with pytest.raises(ValueError):
            rules.rewritten(d.withColumn("ids", F.array().cast("array<bigint>")), [rules.Rewrite(("or", bad, ("has", "x")))])


def test_a_large_rule_table(spark):
    """1,200 rules and 700 rewrites, read from JSON tables; the last rewrite sees what the first ones did."""
    own, changes = made_up_rules(1200, random.Random(9))
    changes = changes[:699] + [rules.Rewrite(("has", "chain"), (), (900,))]
    chain = [rules.Rewrite(("id", 900 + k), (900 + k,), (901 + k,)) for k in range(100)]
    given = spark.createDataFrame([(json.dumps(r.predicate), list(r.emits), r.group, r.priority) for r in own], "predicate string, emits array<bigint>, group string, priority int")
    table = spark.createDataFrame([(k, json.dumps(r.predicate), list(r.removes), list(r.adds)) for k, r in enumerate(changes + chain)], "position int, predicate string, removes array<bigint>, adds array<bigint>")
    read, rewrites = rules.read_rules(given), rules.read_rewrites(table)
    assert len(read) == len(own) and [r.predicate for r in rewrites] == [r.predicate for r in changes + chain]
    d = spark.createDataFrame([("chain of ar el",), ("Aarx, bel",), (None,)], "text string")
    got = [r["ids"] for r in rules.rewritten(rules.matched(d, read), rewrites).collect()]
    assert 1000 in got[0] and 900 not in got[0] and got[2]


def test_empty_inputs(spark):
    none = lambda ddl: spark.createDataFrame([], ddl)
    assert metrics.entity_topic_profile(none("e long, paper_id long"), none("paper_id long, topic_id long"), "e").count() == 0
    assert citations.citation_edges(none("paper_id long, paper_reference_id long"), none("paper_id long, merge_into_id long")).count() == 0
    assert assign.allocated(none("id long"), ["id"], 0).count() == 0
    assert rules.matched(none("text string"), [rules.Rule(("has", "x"), (1,))]).count() == 0
    assert diff.upsert(none("k long"), none("k long"), ["k"]).count() == 0


def test_rules_get_their_texts_in_small_batches(spark):
    """However many rows a partition has: Spark's default would hand 10,000 long texts to a worker at once."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    d = spark.range(1000).select(F.concat(F.lit("a the "), F.col("id")).alias("text"))
    for made in (lambda: rules.matched(d, [rules.Rule(("has", "the"), (1,))]), lambda: rules.rewritten(d.withColumn("ids", F.array(F.lit(1).cast("bigint"))), [rules.Rewrite(("id", 1), (1,), (2,))])):
        for c in (rows, size):
            spark.conf.unset(c)
        got = made()
        assert int(spark.conf.get(rows)) <= 1024 and int(spark.conf.get(size).removesuffix("b")) <= 64 << 20
        assert got.count() == 1000


def test_a_name_and_an_identifier_are_weighed_once(spark, monkeypatch):
    """3,000 claims of three names and one identifier: evidence looks at three rows."""
    seen, weigh = spark.sparkContext.accumulator(0), identifiers.evidence_of

    @F.udf("string")
    def counted(name):
        seen.add(1)
        return name

    monkeypatch.setattr(identifiers, "evidence_of", lambda author, *rest: weigh(counted(author), *rest))
    name = F.element_at(F.array(F.lit("Maria Silva"), F.lit("M. Silva"), F.lit("Wei Zhang")), (F.col("id") % 3 + 1).cast("int"))
    claims = spark.range(3000).select((F.col("id") / 3).cast("long").alias("paper_id"), (F.col("id") % 3).alias("author_sequence_number"), name.alias("original_author"), F.lit("o").alias("orcid"))
    got = identifiers.reconciled(claims, spark.createDataFrame([("o", "Maria", "Silva"), ("o", "Wei", "Li")], "orcid string, given_names string, family_name string")).collect()
    assert len(got) == 1000 and {r["author_sequence_number"] for r in got} == {0}
    assert seen.value <= 3 * 2 * 2
