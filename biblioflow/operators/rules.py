r"""Text-to-identifier rules and conditional rewrites of identifier lists, both driven by tables of rules.

A predicate is a nested tuple:

    ("has", text)  ("has_lower", text)  ("any", [texts])  ("any_lower", [texts])  ("all", [texts])
    ("word", text)  ("regex", pattern)  ("replaced", {old: new}, text)  ("id", n)  ("ids_more_than", n)
    ("not", p)  ("and", p, ...)  ("or", p, ...)

However many rules there are, they are applied in one pass over the text (``rulebook``): an automaton finds the literals of
all rules at once, and only rules that one of these can make true are looked at. So a rule means the same in every table:
patterns are those of the ``regex`` package, where ``\w``, ``\d``, ``\b`` and case folding know all scripts; lower case is
Python's. An empty list, an unknown kind or a wrong number of arguments is refused; the empty text is in every text.

A rule emits ids where its predicate holds; of rules in one group the first by priority that holds is the only one. Null and the
empty text are no group. Rules that test ids run after all others, on what those emitted.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioflow.sources.batches import small_batches

NO_INSTITUTION = -1
#: Arguments of each kind of predicate.
ARGUMENTS = {"has": 1, "has_lower": 1, "any": 1, "any_lower": 1, "all": 1, "word": 1, "regex": 1, "replaced": 2, "id": 1, "ids_more_than": 1}
#: A character that is no part of a word, in any script.
OUTSIDE = r"[^\p{L}\p{N}_]"


@dataclass(frozen=True)
class Rule:
    predicate: tuple
    emits: tuple[int, ...]
    group: str | None = None
    priority: int = 0


@dataclass(frozen=True)
class Rewrite:
    """Where the predicate holds (it may test ids): remove, then add. Later rewrites see earlier ones."""

    predicate: tuple
    removes: tuple[int, ...] = ()
    adds: tuple[int, ...] = ()


def tests_ids(p: tuple) -> bool:
    return p[0] in ("id", "ids_more_than") or any(tests_ids(x) for x in p[1:] if isinstance(x, tuple) and x and isinstance(x[0], str))


def checked(p: tuple, ids: bool = True) -> tuple:
    """The predicate, if it is one: of a known kind, with as many arguments as that takes, and no empty list."""
    kind, *args = p
    if kind in ("not", "and", "or"):
        if not args or kind == "not" and len(args) > 1:
            raise ValueError(f"{kind} of {len(args)} predicates")
        return (kind, *(checked(x, ids) for x in args))
    if kind not in ARGUMENTS or kind in ("id", "ids_more_than") and not ids:
        raise ValueError(f"unknown predicate {kind}")
    if len(args) != ARGUMENTS[kind]:
        raise ValueError(f"{kind} takes {ARGUMENTS[kind]} arguments")
    if kind in ("any", "all", "any_lower") and not args[0]:
        raise ValueError(f"{kind} of no texts")
    return p


def sql(p: tuple, text: str = "text") -> str:
    """The predicate over text as DuckDB SQL."""
    kind, *args = p
    q = lambda s: "'" + s.replace("'", "''") + "'"
    if kind in ("not", "and", "or"):
        parts = [f"({sql(x, text)})" for x in args]
        return f"NOT {parts[0]}" if kind == "not" else f" {kind.upper()} ".join(parts)
    match kind:
        case "has":
            return f"contains({text}, {q(args[0])})"
        case "has_lower":
            return f"contains(lower({text}), {q(args[0])})"
        case "any" | "any_lower":
            own = f"lower({text})" if kind == "any_lower" else text
            return " OR ".join(f"contains({own}, {q(t)})" for t in args[0])
        case "all":
            return " AND ".join(f"contains({text}, {q(t)})" for t in args[0])
        case "word":
            return f"regexp_matches({text}, {q(f'(^|{OUTSIDE}){re.escape(args[0])}($|{OUTSIDE})')})"
        case "regex":
            return f"regexp_matches({text}, {q(args[0])})"
        case "replaced":
            return f"contains({reduce(lambda c, x: f'replace({c}, {q(x[0])}, {q(x[1])})', args[0].items(), text)}, {q(args[1])})"
    raise ValueError(f"{kind} has no SQL form")


def read_predicate(value) -> tuple:
    """A predicate of a JSON value: ``["and", ["has", "x"], ["not", ["word", "y"]]]``."""
    kind, *args = value
    if kind in ("not", "and", "or"):
        return (kind, *(read_predicate(x) for x in args))
    return (kind, *args)


def read_rules(table: DataFrame) -> list[Rule]:
    """Rules of a table (predicate: JSON text, emits array<bigint>, group, priority), in a fixed order; one row a rule."""
    rows = table.select("predicate", "emits", "group", "priority").collect()
    found = [Rule(read_predicate(json.loads(r["predicate"])), tuple(r["emits"]), r["group"], r["priority"] or 0) for r in rows]
    return sorted(found, key=lambda r: (r.group or "", r.priority, r.emits, json.dumps(r.predicate)))


def read_rewrites(table: DataFrame) -> list[Rewrite]:
    """Rewrites of a table (position, predicate: JSON text, removes, adds), in the order of ``position``; one row a rewrite."""
    rows = table.select("position", "predicate", "removes", "adds").orderBy("position").collect()
    return [Rewrite(read_predicate(json.loads(r["predicate"])), tuple(r["removes"] or ()), tuple(r["adds"] or ())) for r in rows]


def matched(df: DataFrame, rules: list[Rule], text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the sorted set of ids that the rules emit for a text; null text emits none."""
    from biblioflow.operators import rulebook

    for r in rules:
        checked(r.predicate)
    small_batches(df.sparkSession)
    return df.withColumn(out, rulebook.emitting(rules)(F.coalesce(F.col(text), F.lit(""))))


def without_no_institution(ids: Column) -> Column:
    """Nulls out; -1 out where a real id stands; [-1] where nothing is left."""
    real = F.array_sort(F.array_distinct(F.filter(F.coalesce(ids, F.array().cast("array<bigint>")), lambda x: x.isNotNull() & (x != NO_INSTITUTION))))
    return F.when(F.size(real) > 0, real).otherwise(F.array(F.lit(NO_INSTITUTION).cast("bigint")))


def chosen_ids(base: Column, override: Column) -> Column:
    """The override where it has an entry (then without -1 if it has others), else the base; [-1] if both are empty."""
    has = lambda c: F.size(F.coalesce(c, F.array())) > 0
    only_none = F.size(F.filter(override, lambda x: x != NO_INSTITUTION)) == 0
    return F.when(has(override) & ~only_none, F.filter(override, lambda x: x != NO_INSTITUTION)).when(has(override), override).when(has(base), base).otherwise(F.array(F.lit(NO_INSTITUTION).cast("bigint")))


def rewritten(df: DataFrame, rewrites: list[Rewrite], text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids after all rewrites in order, as a sorted set; nothing left gives [-1]; null ids are none."""
    from biblioflow.operators import rulebook

    for r in rewrites:
        checked(r.predicate)
    small_batches(df.sparkSession)
    done = rulebook.rewriting(rewrites)(F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(ids), F.array().cast("array<bigint>")))
    return df.withColumn(ids, without_no_institution(done))


def family(parent: int, swaps: dict[int, tuple[str, int]]) -> list[Rewrite]:
    """Rewrites of a parent and its affiliates: add the parent; swap a sibling where its phrase is in the text."""
    out = [Rewrite(("id", child), adds=(parent,)) for child in swaps]
    return out + [Rewrite(("and", ("id", child), ("has_lower", phrase)), (child,), (other,)) for child, (phrase, other) in swaps.items()]


def refreshed(df: DataFrame, rules: list[Rule], rewrites: list[Rewrite], text: str = "original_affiliation", base: str = "affiliation_ids", override: str = "affiliation_ids_override") -> DataFrame:
    """Affiliation strings whose ids change: (text, old_ids, new_ids).

    ``base`` and ``override`` hold JSON lists. Current ids and what the rules emit are united, then rewritten.
    """
    lists = df.withColumn("_now", chosen_ids(F.from_json(base, "array<bigint>"), F.from_json(override, "array<bigint>")))
    found = matched(lists, rules, text, "_found")
    united = found.withColumn("_new", without_no_institution(F.array_union("_now", "_found")))
    done = rewritten(united, rewrites, text, "_new").withColumn("_old", without_no_institution(F.col("_now")))
    return done.where(F.col("_old") != F.col("_new")).select(text, F.col("_old").alias("old_ids"), F.col("_new").alias("new_ids"))
