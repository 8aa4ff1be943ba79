"""Plain versions, over rows in memory, of the operators that SQL cannot say."""

from __future__ import annotations

import math
from collections import defaultdict

from biblioflow.functions.names import compatible, compatible_slots, merged_slots, search_form, slots
from biblioflow.operators.assign import CANDIDATES, LEAST_SCORE, ROOT_CONCEPTS, SCORER
from biblioflow.operators.diff import NULL_BUCKET, TOMBSTONE
from biblioflow.operators.identifiers import WEIGHTS

PROFILE = ("author", "orcid", "coauthors", "concepts", "institutions", "citations")


def coauthor(name: str) -> str:
    words = name.strip().lower().split()
    last = "".join(c for c in words[-1] if c not in " .,:/-")
    return f"{words[0][0]}_{last}" if len(words) > 1 else last


def jaccard(a, b) -> float:
    a, b = set(a), set(b)
    return math.floor(len(a & b) / len(a | b) * 10_000 + 0.5) / 10_000 if a | b else 0.0


def block(name: str) -> tuple[str, str]:
    words = search_form(name).split(" ")
    return words[-1], words[0][:1] if len(words) > 1 else ""


def cascade(works: list, current: list, last: int, requests: list, merges: list, frozen: list, removed: list, splits: list) -> set[tuple]:
    rows = {}
    for w in works:
        row = w.asDict()
        row["coauthors"] = tuple(sorted({k for c in row["coauthors"] if len(k := coauthor(c)) > 6}))
        row["concepts"] = tuple(sorted(c for c in row["concepts"] if c not in ROOT_CONCEPTS))
        row["institutions"], row["citations"] = tuple(sorted(row["institutions"])), tuple(sorted(row["citations"]))
        rows[row["work_author_id"]] = row
    held, barred = {f["author_id"] for f in frozen}, {(r["paper_id"], r["author_id"]) for r in removed}
    asked = {c["work_author_id"]: c["author_id"] for c in current}
    for r in sorted(requests, key=lambda r: (r["request_date"], r["new_author_id"])):
        asked[r["work_author_id"]] = r["new_author_id"]
    moves = {}
    for m in merges:
        a, b = (m["merge_to_id"], m["merge_from_id"]) if m["merge_from_id"] in held else (m["merge_from_id"], m["merge_to_id"])
        moves[a] = min(b, moves.get(a, b))
    asked = {w: moves.get(a, a) for w, a in asked.items()}
    of = {w: (a, "kept") for w, a in asked.items() if a not in (NULL_BUCKET, TOMBSTONE)}
    keys = sorted({s["request"] for s in splits})
    of |= {s["work_author_id"]: (last + 1 + keys.index(s["request"]), "split") for s in splits}
    last += len(keys)
    of = {w: x for w, x in of.items() if w in rows and (rows[w]["paper_id"], x[0]) not in barred}

    def members() -> dict:
        out = defaultdict(list)
        for w, (a, _) in of.items():
            out[a].append(w)
        return out

    def owners() -> dict:
        return {a: min([rows[w]["orcid"] for w in ws if rows[w]["orcid"]], default="") for a, ws in members().items()}

    owner, sizes, same = owners(), {a: len(ws) for a, ws in members().items()}, defaultdict(list)
    for a, o in owner.items():
        if o:
            same[o].append(a)
    winner = {a: min(group, key=lambda x: (x not in held, -sizes[x], x)) for group in same.values() for a in group}
    of = {w: (winner.get(a, a), how) for w, (a, how) in of.items()}

    named = {w for w, r in rows.items() if r["author"] != "None"}
    groups = defaultdict(list)
    papers = {p for p, _ in barred}
    for w in named - set(of):
        groups[tuple(rows[w][c] for c in PROFILE) + (w if rows[w]["paper_id"] in papers else "",)].append(w)
    copies = {min(g): g for g in groups.values()}
    left = set(copies)

    by_orcid = defaultdict(list)
    for a, o in owners().items():
        if o:
            by_orcid[o].append(a)
    given = {w: min(by_orcid[rows[w]["orcid"]]) for w in left if rows[w]["orcid"] in by_orcid}
    of |= {w: (a, "identifier") for w, a in given.items()}
    left -= set(given)

    for name in ("name", "name again", "compatible"):
        team, owner, known = members(), owners(), defaultdict(set)
        whole = {a: merged_slots([slots(search_form(n)) for n in {rows[w]["author"] for w in ws}]) for a, ws in team.items()} if name == "compatible" else {}
        for w, (a, _) in of.items():
            known[rows[w]["author"] if name != "compatible" else block(rows[w]["author"])].add((a, rows[w]["author"]))
        best = {}
        for w in left:
            x, scored = rows[w], []
            found = known[x["author"] if name != "compatible" else block(x["author"])]
            authors = {a for a, n in found if name != "compatible" or compatible_slots(slots(search_form(x["author"])), whole[a])}
            for a in authors:
                if (x["paper_id"], a) in barred:
                    continue
                tries = []
                for m in team[a]:
                    y = rows[m]
                    inst = int(bool(set(x["institutions"]) & set(y["institutions"])))
                    con, co, ref = (jaccard(x[c], y[c]) for c in ("concepts", "coauthors", "citations"))
                    cites = int(y["paper_id"] in x["citations"] or x["paper_id"] in y["citations"])
                    exact = x["author"] == y["author"]
                    total = inst + con + co + ref + cites
                    if total > 0:
                        vector = (inst, con, co, exact * len(x["author"]), exact * len(x["author"].split(" ")), ref, cites)
                        tries.append((-round(total, 6), m, vector))
                if tries:
                    total, _, vector = min(tries)
                    z = SCORER[0] + sum(c * v for c, v in zip(SCORER[1:], vector, strict=True))
                    scored.append((total, a, 1 / (1 + math.exp(-z))))
            fine = [(-round(s, 9), a) for _, a, s in sorted(scored)[:CANDIDATES] if s > LEAST_SCORE and (not x["orcid"] or not owner[a] or x["orcid"] == owner[a])]
            if fine:
                best[w] = min(fine)
        per = defaultdict(list)
        for w, (s, a) in best.items():
            per[a].append((s, w))
        for a, ws in per.items():
            several = len({rows[w]["orcid"] for _, w in ws if rows[w]["orcid"]}) > 1
            for _, w in sorted(ws)[: 1 if several else None]:
                of[w] = (a, name)
                left.discard(w)
    for k, w in enumerate(sorted(left, key=lambda w: (rows[w]["paper_id"], w))):
        of[w] = (last + 1 + k, "new")
    for w, group in copies.items():
        of |= {m: of[w] for m in group}
    old, new = defaultdict(set), defaultdict(set)
    for c in current:
        old[c["author_id"]].add(c["work_author_id"])
    for w, (a, how) in of.items():
        if how == "new":
            new[a].add(w)
    was = defaultdict(list)
    for a, ws in old.items():
        was[frozenset(ws)].append(a)
    back = {a: min(was[frozenset(ws)]) for a, ws in new.items() if len(ws) <= 5 and frozenset(ws) in was}
    of = {w: (back.get(a, a), how) for w, (a, how) in of.items()}
    return {(w, a, how) for w, (a, how) in of.items()} | {(w, NULL_BUCKET, "unnamed") for w in rows if w not in of}


def reassigned(works: list, frozen: set, rounds: int = 3) -> set[tuple]:
    rows = [w.asDict() | {"name": search_form(w["name"])} for w in works]
    orcids = defaultdict(set)
    for r in rows:
        if r["orcid"]:
            orcids[r["author_id"]].add(r["orcid"])
    out = set()
    for author in [a for a, o in orcids.items() if len(o) > 1 and a not in frozen]:
        own = [r for r in rows if r["author_id"] == author]
        for _ in range(rounds):
            anchors = {o: [r for r in own if r["orcid"] == o] for o in sorted({r["orcid"] for r in own} - {""})}
            sets = {o: {c: {x for r in rs for x in r[c]} for c in WEIGHTS} for o, rs in anchors.items()}
            profiles = defaultdict(list)
            for r in own:
                if not r["orcid"]:
                    scores = tuple((o, s) for o in anchors if (s := round(sum(w * len(set(r[c]) & sets[o][c]) for c, w in WEIGHTS.items()), 6)) > 0)
                    if scores:
                        profiles[r["name"], scores].append(r)
            held = {o: [r["name"] for r in rs] for o, rs in anchors.items()}
            tries = sorted((-s, min(r["work_author_id"] for r in rs), o, name) for (name, scores), rs in profiles.items() for o, s in scores)
            done = {}
            for _, first, o, name in tries:
                if first not in done and all(compatible(name, n) for n in held[o]):
                    done[first] = o
                    held[o].append(name)
            for rs in profiles.values():
                if o := done.get(min(r["work_author_id"] for r in rs)):
                    for r in rs:
                        r["orcid"] = o
                        out.add((author, r["work_author_id"], o))
    return out


def leftover_groups(works: list) -> set[tuple]:
    by = defaultdict(list)
    for w in works:
        by[w["author_id"]].append((search_form(w["name"]), w["work_author_id"]))
    out = set()
    for author, own in by.items():
        clusters: list[set] = []
        for name, w in sorted(own):
            k = next((i for i, c in enumerate(clusters) if name in c or all(compatible(name, n) for n in c)), len(clusters))
            if k == len(clusters):
                clusters.append(set())
            clusters[k].add(name)
            out.add((author, w, k))
    return out
