"""Leading authors of crowded groups of names against brute force, in one process."""

from __future__ import annotations

import math
import random

import pyarrow as pa
import pytest

from biblioflow.operators import nearest
from biblioflow.operators.assign import SCORER
from tests import plain

KINDS = pa.schema(
    [("group", pa.int64()), ("of_members", pa.int32()), ("of_new", pa.int32()), ("kind", pa.int32()), ("author_id", pa.int64()), ("orcid", pa.string()), ("listed", pa.list_(pa.int64())), ("id", pa.string())]
    + [("paper", pa.list_(pa.int64())), ("name", pa.int64()), *[(c, pa.list_(pa.int64())) for c in nearest.SETS], ("points", pa.float64()), ("m", pa.int32())]
)


def crowded_group(group: int, members: int, new: int, institutions: int, authors: int, seed: int, others: int = 0) -> list[dict]:
    """Nearly all pairs share a concept or a coauthor; a third of the members are one author's, and some those of ``others``, who are no candidates."""
    rng = random.Random(seed)
    some = lambda top, most: sorted({rng.randrange(top) for _ in range(rng.randrange(most))})
    row = {"group": group, "of_members": 0, "of_new": 0, "m": 1, "orcid": ""}
    sides = lambda n, first: [
        {**row, "id": f"{p}_1", "paper": [p], "name": rng.randrange(3), "institutions": some(institutions, 4), "concepts": some(12, 6), "coauthors": some(8, 5), "citations": some(members, 4), "points": 0.5} for p in range(first, first + n)
    ]
    heads = [{**row, "kind": nearest.AUTHOR, "author_id": a, "orcid": rng.choice(["", "", "p", "q"]), "listed": rng.sample(range(3), 2)} for a in range(authors)]
    held = [{**r, "kind": nearest.MEMBER, "author_id": rng.choice([1, rng.randrange(authors), rng.randrange(authors + others)])} for r in sides(members, 0)]
    asks = [{**r, "kind": nearest.NEW, "listed": some(authors, 5), "orcid": rng.choice(["", "p"])} for r in sides(new, members)]
    return heads + sorted(held, key=lambda r: (r["author_id"], r["id"])) + sorted(asks, key=lambda r: r["id"])


def led(rows: list[dict], most: int, *weights) -> list[dict]:
    return [r for b in nearest.leading_in_parts(most, *weights)(pa.Table.from_pylist(rows, KINDS).to_batches(1000)) for r in b.to_pylist()]


def brute_force(rows: list[dict], most: int) -> dict[str, list[tuple]]:
    of = lambda k: [r for r in rows if r["kind"] == k]
    heads, out = {r["author_id"]: r for r in of(nearest.AUTHOR)}, {}
    for x in of(nearest.NEW):
        best: dict = {}
        for y in of(nearest.MEMBER):
            a = y["author_id"]
            if a not in heads or x["name"] not in heads[a]["listed"] or a in x["listed"]:
                continue
            parts = (int(bool(set(x["institutions"]) & set(y["institutions"]))), *(round(1e4 * plain.jaccard(x[c], y[c])) for c in ("concepts", "coauthors", "citations")), int(y["paper"][0] in x["citations"] or x["paper"][0] in y["citations"]))
            total = 10_000 * (parts[0] + parts[4]) + sum(parts[1:4])
            if total:
                best[a] = min(best.get(a, (1,)), (-total, y["id"], heads[a]["orcid"], x["name"] == y["name"], parts))
        out[x["id"]] = sorted((v[0], a, *v[1:]) for a, v in best.items())[:most]
    return {k: v for k, v in out.items() if v}


@pytest.mark.parametrize(("institutions", "authors", "most"), [(900, 60, 5), (3, 40, 25), (40, 4, 25)])
def test_crowded_groups_are_not_multiplied_out(monkeypatch, institutions, authors, most):
    rows = crowded_group(1, 400, 120, institutions, authors, 5) + crowded_group(2, 30, 4, institutions, authors, 6) + crowded_group(3, 300, 90, institutions, authors, 7)
    spread, lengths = nearest._spread, []

    def counted(n):
        lengths.append(int(sum(n)))
        return spread(n)

    monkeypatch.setattr(nearest, "_spread", counted)
    got: dict = {}
    for r in led(rows, most):
        parts = tuple(r[c] for c in ("inst_per", "concepts_per", "coauthors_per", "citation_per", "citation_work_match"))
        total = 10_000 * (parts[0] + parts[4]) + sum(parts[1:4])
        got.setdefault(r["work_author_id_1"], []).append((-total, r["author_id"], r["work_author_id_2"], r["orcid_2"], r["same"], parts))
    want: dict = {}
    for g in (1, 2, 3):
        for k, v in brute_force([r for r in rows if r["group"] == g], most).items():
            want.setdefault(k, []).extend(v)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert max(lengths) < 400 * 120  # the first group's pairs; their shared postings are more


def test_only_authors_that_can_win_leave_a_group():
    rows = crowded_group(1, 400, 120, 50, 60, 8, others=3)
    orcids = {r["id"]: r["orcid"] for r in rows if r["kind"] == nearest.NEW}

    def score(r: dict) -> float:
        vector = (1, r["inst_per"], r["concepts_per"] / 1e4, r["coauthors_per"] / 1e4, 0, 0, r["citation_per"] / 1e4, r["citation_work_match"])
        return 1 / (1 + math.exp(-sum(w * x for w, x in zip(SCORER, vector, strict=True)) - 0.5 * r["same"]))

    fine = [r for r in led(rows, 25) if "" in (r["orcid_2"], orcids[r["work_author_id_1"]]) or r["orcid_2"] == orcids[r["work_author_id_1"]]]
    best: dict = {}
    for r in fine:
        best[r["work_author_id_1"]] = max(best.get(r["work_author_id_1"], 0.0), score(r))
    key = lambda r: (r["work_author_id_1"], r["author_id"], r["work_author_id_2"])
    assert sorted(map(key, led(rows, 25, SCORER))) == sorted(key(r) for r in fine if score(r) > best[r["work_author_id_1"]] - 1e-9)
    several = [{**r, "m": 2} for r in rows]  # members in several parts: all leave, as another part may have better ones
    assert sorted(map(key, led(several, 25, SCORER))) == sorted(map(key, led(rows, 25)))
