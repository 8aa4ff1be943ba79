"""Greedy assignment and first fit in parts against sequential plain versions, on names made to meet in every way."""

from __future__ import annotations

import itertools
import random
import time

import pytest

from biblioflow.functions.names import compatible, search_form
from biblioflow.operators import identifiers
from tests import plain

KINDS = "author_id long, work_author_id string, orcid string, name string, institutions array<long>, coauthors array<string>, concepts array<long>, citations array<long>, coauthor_orcids array<string>, topics array<long>, subfields array<long>, fields array<long>"
FIRST, MIDDLE, LAST = ["A", "Ann", "Anna", "L", "Lee", "Bo", "B", ""], ["", "B", "Bob", "Ben", "B C"], ["Lee", "L", "Lin", "Ann", "A", "Bo", ""]
NAMES = sorted({" ".join(" ".join(n).split()) for n in itertools.product(FIRST, MIDDLE, LAST)})


def work(author, k, orcid, name, institutions, concepts):
    return (author, f"{k}_1", orcid, name, institutions, [], concepts, [], [], [], [], [])


def test_compatible_names_have_one_block(spark):
    forms = sorted({search_form(n) for n in NAMES})
    block = {r["name"]: r["b"] for r in spark.createDataFrame([(f,) for f in forms], "name string").select("name", identifiers.name_block(identifiers.F.col("name")).alias("b")).collect()}
    for a, b in itertools.product(forms, forms):
        if a and b and compatible(a, b):
            assert block[a] == block[b], (a, b)
    assert block[""] == "" and len(set(block.values())) > 5


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_leftovers_by_first_fit(spark, seed):
    chance = random.Random(seed)
    works = [(a, f"{k}_{a}", chance.choice(NAMES) if k % 17 else None) for a in range(6) for k in range((0, 1, 5, 60, 200, 400)[a])]
    works += [(7, "1_7", ""), (7, "2_7", None), (8, "1_8", ""), (8, "2_8", "Bo Lee"), (8, "3_8", "Ann Lee")]
    df = spark.createDataFrame(works, "author_id long, work_author_id string, name string")
    got = [tuple(r) for r in identifiers.leftover_groups(df).collect()]
    assert len(got) == len(works) and set(got) == plain.leftover_groups(df.collect())
    assert identifiers.leftover_groups(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_overmerged_profiles_by_score(spark, seed):
    """Also anchors of several blocks, which take no name, anchors without a name, which any block may take, and unnamed profiles."""
    chance = random.Random(seed)
    rows = []
    for a in range(5):
        for k in range(60):
            orcid = chance.choice("ABCD") if k % 4 == 0 else ""
            own = [n for n in NAMES if n] if a < 3 else ["Ann Lee", "A Lee", "Ann B Lee", "Lee Ann", "Anna Lee"]
            if a < 2 and orcid:
                own = {"A": ["Ann Lee", "A Lee"], "B": ["Bo Lin", "B L"], "C": ["Lee Ann"], "D": ["Bo Ann", "Ann Lee"]}[orcid]
            name = chance.choice(NAMES if a == 1 and not orcid else own) if not (a in (2, 4) and orcid == "A") else ""
            rows.append(work(a, 1000 * a + k, orcid, name, chance.sample(range(8), 2), chance.sample(range(9), 2)))
    works = spark.createDataFrame(rows, KINDS)
    got = [tuple(r) for r in identifiers.reassigned(works, spark.createDataFrame([(3,)], "author_id long")).select("author_id", "work_author_id", "orcid").collect()]
    want = plain.reassigned(works.collect(), {3})
    assert len(got) == len(set(got)) and set(got) == want and {a for a, _, _ in want} >= {0, 1, 2, 4}


def varied_works(chance):
    """Works of authors of 6 to 90 works, with nulls in and for sets, identifiers and names, and members listed twice."""
    rows = []
    for a in range(8):
        names = ["Ann Lee", "A Lee", "Ann B Lee", "Lee Ann", "A. B. Lee", "Bo Lin", "", None] if a % 2 else NAMES
        for k in range((6, 12, 30, 90)[a % 4]):
            orcid = chance.choice("AB") if k % 5 < 2 else chance.choice(["", None])
            drawn = [[chance.choice([*range(6), None]) for _ in range(chance.randrange(4))] for _ in range(6)]
            texts = [None if chance.random() < 0.1 else [chance.choice(["x", "y", "z", None]) for _ in range(chance.randrange(4))] for _ in range(2)]
            i, c, r, t, s, f = (None if chance.random() < 0.1 else d for d in drawn)
            rows.append((a, f"{k}_{a}", orcid, chance.choice(names[:4] if orcid and a % 2 else names), i, texts[0], c, r, texts[1], t, s, f))
    return rows


@pytest.mark.parametrize("members", [0, 150, 4096])
def test_rounds_in_a_stream_and_by_joins_give_the_same(spark, members):
    rows = varied_works(random.Random(members))
    given = spark.createDataFrame(rows, KINDS)
    got = [tuple(r) for r in identifiers.reassigned(given, spark.createDataFrame([(6,)], "author_id long"), members=members).collect()]
    none = [tuple([x for x in c or [] if x is not None] if k > 3 else c or "" if k > 1 else c for k, c in enumerate(r)) for r in rows]
    want = plain.reassigned(spark.createDataFrame(none, KINDS).collect(), {6})
    assert len(got) == len(set(got)) and set(got) == want and len({a for a, _, _ in want}) > 3


def test_authors_of_few_works_make_no_postings(spark, monkeypatch):
    """Their works are dealt once; before, each of three rounds exchanged every member of every set three times."""
    def made(*_):
        raise AssertionError("postings")

    monkeypatch.setattr(identifiers, "shared_weights", made)
    works = spark.createDataFrame(varied_works(random.Random(5)), KINDS)
    none = spark.createDataFrame([], "author_id long")
    assert identifiers.reassigned(works, none).count() > 0
    with pytest.raises(AssertionError, match="postings"):
        identifiers.reassigned(works, none, members=150)
    assert identifiers.reassigned(works.limit(0), none).count() == 0


def test_an_author_of_very_many_names(spark):
    """100,000 different names, half of them with the same initials."""
    word = lambda k: "".join("aeiou"[k // 5**i % 5] for i in range(8))
    names = [f"Ann {word(k)} L{word(k // 7)}" if k % 2 else f"{'bcdfghjkm'[k % 9]}{word(k)} {'npqrstvwz'[k // 9 % 9]}{word(3 * k)}" for k in range(100_000)]
    names = [f"Ann L{word(k)}" if k % 50 == 1 else f"Ann B L{word(k - 2)}" if k % 50 == 3 else n for k, n in enumerate(names)]
    assert len(set(names)) == len(names)
    df = spark.createDataFrame([(1, f"{k}_1", n) for k, n in enumerate(names)], "author_id long, work_author_id string, name string")
    start = time.monotonic()
    got = {r["work_author_id"]: r["cluster"] for r in identifiers.leftover_groups(df).collect()}
    assert len(got) == len(names) and time.monotonic() - start < 240
    members: dict[int, list[str]] = {}
    for k, n in enumerate(names):
        members.setdefault(got[f"{k}_1"], []).append(search_form(n))
    assert sorted(members) == list(range(len(members))) and 1 < len(members) < len(names)
    firsts = [min(members[k]) for k in range(len(members))]
    assert firsts == sorted(firsts)
    for own in itertools.islice(members.values(), 0, None, 500):
        assert all(compatible(a, b) for a in own for b in own)
