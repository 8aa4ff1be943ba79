"""Names taken apart, and letters of any script in Latin ones."""

from __future__ import annotations

import pytest

from biblioflow.functions import names

TABLE = [  # name, title, first, middle, last, suffix, parsed
    ("John Smith Jr.", "", "John", "", "Smith", "Jr.", "John Smith"),
    ("Smith, John, Jr.", "", "John", "", "Smith", "Jr.", "John Smith"),
    ("John Smith, PhD", "", "John", "", "Smith", "PhD", "John Smith"),
    ("Smith, John A. III", "", "John", "A.", "Smith", "III", "John A. Smith"),
    ("Dr. Ann B. Lee", "Dr.", "Ann", "B.", "Lee", "", "Ann B. Lee"),
    ("None Prof. Dr. Ann Lee, MD, PhD", "Prof. Dr.", "Ann", "", "Lee", "MD PhD", "Ann Lee"),
    ("Ludwig van Beethoven", "", "Ludwig", "", "van Beethoven", "", "Ludwig van Beethoven"),
    ("Ana Maria de la Cruz", "", "Ana", "Maria", "de la Cruz", "", "Ana Maria de la Cruz"),
    ("van der Berg, Jan P.", "", "Jan", "P.", "van der Berg", "", "Jan P. van der Berg"),
    ("Van Morrison", "", "Van", "", "Morrison", "", "Van Morrison"),
    ("José Ortega y Gasset", "", "José", "", "Ortega y Gasset", "", "José Ortega y Gasset"),
    ("Smith J", "", "Smith", "", "J", "", "J Smith"),
    ("Smith J K", "", "Smith", "J", "K", "", "J K Smith"),
    ("Smith J. K. L.", "", "Smith", "J. K.", "L.", "", "J. K. L. Smith"),
    ("Smith J. K", "", "Smith", "J.", "K", "", "Smith J. K"),
    ("Li J", "", "Li", "", "J", "", "Li J"),
    ("Kim J. H.", "", "Kim", "J.", "H.", "", "Kim J. H."),
    ("Dr. Smith J", "Dr.", "Smith", "", "J", "", "Smith J"),
    ("Jr.", "", "Jr.", "", "", "", "Jr."),
    ("Lee", "", "Lee", "", "", "", "Lee"),
    ("Lee,", "", "Lee", "", "", "", "Lee"),
    (",", "", "", "", "", "", ""),
    (None, "", "", "", "", "", ""),
]


@pytest.mark.parametrize("row", TABLE, ids=lambda r: str(r[0]))
def test_name_parts(row):
    assert tuple(names.name_parts(row[0]).values()) == row[1:6] and names.parsed(row[0]) == row[6]


@pytest.mark.parametrize(("name", "form"), [
    ("Иван Петров", "ivan petrov"), ("Щукина Жанна", "shchukina zhanna"), ("Юлия Хромова", "iuliia khromova"), ("Фёдор Достоевский", "fedor dostoevskii"), ("Цой", "tsoi"), ("Мышь", "mysh"),
    ("Νίκος Παπαδόπουλος", "nikos papadopoulos"), ("Θεόδωρος Ψυχάρης", "theodoros psukhares"), ("김민수", "gimminsu"), ("さくら", "sakura"), ("李 Wei", "李 wei"), ("Ørsted Łukasz", "orsted lukasz"), ("Плохой2_имя", "plokhoiimia"),
])
def test_letters_of_other_scripts(name, form):
    assert names.search_form(name) == form


def test_cyrillic_and_greek_claims_are_accepted(spark):
    from biblioflow.operators import identifiers

    assert names.evidence("Ivan Petrov", ["Иван"], ["Петров"]) == [1, 1, 0] and names.evidence("Νίκος Παπαδόπουλος", ["Nikos"], ["Papadopoulos"]) == [1, 1, 0] and names.evidence("Ivan Petrov", ["Пётр"], ["Сидоров"]) == [0, 0, 0]
    claims = spark.createDataFrame([(1, 1, "Ivan Petrov", "a"), (2, 1, "N. Papadopoulos", "b"), (3, 1, "Wei Li", "a")], "paper_id long, author_sequence_number int, original_author string, orcid string")
    registry = spark.createDataFrame([("a", "Иван", "Петров"), ("b", "Νίκος", "Παπαδόπουλος")], "orcid string, given_names string, family_name string")
    assert sorted(r["paper_id"] for r in identifiers.reconciled(claims, registry).collect()) == [1, 2]


def test_merged_structures_in_columns(spark):
    rng_names = [(1, "john smith"), (1, "j a smith"), (1, "smith john"), (2, "ann lee"), (2, "anna b lee"), (3, "")]
    d = spark.createDataFrame(rng_names, "author_id long, s string").select("author_id", names.slots_of("s").alias("slots"))
    merged = {r["author_id"]: r["slots"] for r in names.merged_slots_of(d, "author_id", "slots").collect()}
    for a in (1, 2, 3):
        want = names.merged_slots([names.slots(s) for k, s in rng_names if k == a])
        assert all((merged[a][k], merged[a][f"{k}_initials"]) == (list(w[0]), list(w[1])) for k, w in want.items())
    both = names.merged_slots_of(d, "author_id", "slots")
    met = both.selectExpr("author_id AS i", "slots AS a").crossJoin(both.selectExpr("author_id AS j", "slots AS b")).select("i", "j", names.structures_match("a", "b").alias("same"))
    for r in met.collect():
        x, y = (names.merged_slots([names.slots(s) for k, s in rng_names if k == i]) for i in (r["i"], r["j"]))
        assert r["same"] == names.compatible_slots(x, y)
