"""Personal names: cleaning, search form, scripts, slots, compatibility, evidence and display names.

The text rules that SQL expressions can say are columns; those over the structure of a name are plain functions of one
name, applied in Arrow batches.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters that compatibility decomposition leaves alone.
FOLD = str.maketrans({"ß": "ss", "ẞ": "SS", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "æ": "ae", "Æ": "Ae", "œ": "oe", "Œ": "Oe", "ı": "i", "ħ": "h", "Ħ": "H", "ŧ": "t", "Ŧ": "T", "ĸ": "k", "ŋ": "n", "Ŋ": "N"})
#: Scripts whose names are not matched.
OTHER_SCRIPTS = ("Han", "Hangul", "Hiragana", "Katakana", "Cyrillic", "Arabic", "Hebrew", "Thai", "Greek", "Devanagari")
MOST_CHARS = 120
# Author names that stand for no person; they must be these for equal results.
PLACEHOLDERS = (
    "None Anonymous", "Not specified", "&NA; &NA;", "Creator", "None Unknown", "Unknown Unknown", "Unknown Author", "Unknown", "Author Unknown",
    "None, None", "None", "None None", "None No authorship indicated", "No authorship indicated", "None &NA;", "&Na; &Na;", "&Na;",
    "Occdownload Gbif.Org", "GBIF.Org User", "et al. et al.", ",",
)
TITLES = {"dr", "prof", "mr", "mrs", "ms", "miss", "sir", "rev"}
SUFFIXES = {"jr", "sr", "ii", "iii", "iv", "phd", "md", "esq", "dds", "dvm", "mba", "frs", "junior", "senior"}
PARTICLES = {"van", "von", "der", "den", "de", "del", "della", "di", "da", "dos", "das", "do", "du", "la", "le", "ter", "ten", "zu", "af", "al", "el", "bin", "ibn", "ben", "st"}
CONJUNCTIONS = {"y", "und", "and", "et", "&"}
#: Letters, by the ends of their Unicode names, that sound otherwise than their names begin or end.
SOUNDS = {
    "GHE": "g", "IE": "e", "IO": "io", "SHORT I": "i", "HA": "kh", "HARD SIGN": "", "SOFT SIGN": "", "YERU": "y", "YU": "iu", "YA": "ia", "U": "u",
    "BYELORUSSIAN-UKRAINIAN I": "i", "UKRAINIAN IE": "ie", "YI": "yi", "SHORT U": "u", "RHO": "r", "CHI": "kh", "ALEF": "a", "AYIN": "a", "AIN": "a",
}
MIDDLES = 5


def fold(name: str) -> str:
    """Latin letters without diacritics; other scripts stay as they are."""
    folded = unicodedata.normalize("NFKD", name.translate(FOLD))
    return "".join(c for c in folded if not unicodedata.combining(c))


@cache
def letter(c: str) -> str:
    """A letter of any script in Latin letters, read off its Unicode name; Latin ones, and those that name no sound, as they are."""
    words = unicodedata.name(c, "").split(" WITH ")[0].split()
    if len(words) < 2 or words[0] in ("LATIN", "CJK") or not c.isalpha():
        return c
    if words[1] == "SYLLABLE":
        return words[-1].lower()
    if "LETTER" not in words:
        return c
    said = " ".join(words[words.index("LETTER") + 1 :])
    if said.removeprefix("FINAL ") in SOUNDS:
        return SOUNDS[said.removeprefix("FINAL ")]
    sound = said.split()[-1].lower()
    if words[0] in ("HIRAGANA", "KATAKANA"):
        return sound
    if words[0] == "CYRILLIC":  # named by the sound with an e before or after it, or by the vowel
        return sound.strip("e") or "e" if not set(sound) <= set("aeiou") and sound[-1] != "a" else sound.rstrip("a") or "a"
    return re.match("[^aeiou]*", sound)[0] or sound[0]  # named by a word that begins with the sound


def latin(name: str) -> str:
    """A folded name in Latin letters; what is left over is left as it is."""
    folded = fold("".join(letter(c) if "\uac00" <= c <= "\ud7a3" else c for c in name))  # syllables before they fall apart
    return folded if folded.isascii() else "".join(x.upper() if c.isupper() and len(x) == 1 else x.capitalize() if c.isupper() else x for c in folded for x in [letter(c)])


def search_form(name: str | None) -> str:
    """Lower-case Latin name: ``. , |`` part words, other punctuation and digits go, also hyphens."""
    text = re.sub(r"[.,|]", " ", latin(name or "").lower())
    return " ".join(re.sub(r"[^\w\s]|[\d_]", "", text).split())


def word_class(word: str) -> str:
    """What a word of a name may be: title, suffix, particle, conjunction, initial or name."""
    low = word.replace(".", "").lower()
    for kind, known in (("title", TITLES), ("suffix", SUFFIXES), ("particle", PARTICLES), ("conjunction", CONJUNCTIONS)):
        if low in known:
            return kind
    return "initial" if re.fullmatch(r"[^\W\d_]\.?", word) else "name"


def name_parts(name: str | None) -> dict[str, str]:
    """title, first, middle, last and suffix of a name.

    Commas part "Last, First Middle, Suffix"; after the first comma what holds suffixes only is one. Without a comma words are
    read one after the other: titles, a given name, middle names, and as the surname the last word, or all from the first
    particle that has a name behind it on; a conjunction ties the words beside it to one. A particle or suffix in the first place is a
    given name.
    """
    text = unicodedata.normalize("NFKC", re.sub(r"^(None|Array) ", "", name or ""))
    chunks = [c.split() for c in text.split(",")]
    chunks = [c for c in chunks if c] or [[]]
    suffix: list[str] = []
    for k in range(len(chunks) - 1, 0, -1):
        if all(word_class(w) == "suffix" for w in chunks[k]):
            suffix = chunks.pop(k) + suffix
    words, last = (chunks[1], chunks[0]) if len(chunks) > 1 else (chunks[0], [])
    title: list[str] = []
    for own in (words, last):
        while len(own) > 1 and word_class(own[0]) == "title":
            title.append(own.pop(0))
    while len(words) > (0 if last else 1) and len(words) + len(last) > 1 and word_class(words[-1]) == "suffix":
        suffix.insert(0, words.pop())
    middle = [w for c in chunks[2:] for w in c]
    if not last and len(words) > 1:
        at, k = len(words) - 1, len(words) - 1
        while at >= 2 and word_class(words[at - 1]) == "conjunction":
            at -= 2
        state = "given"
        for k, w in enumerate(words[1:-1], start=1):
            kind = word_class(w)
            if state in ("given", "middle") and kind == "particle":
                at, state = min(at, k), "surname"
            elif state == "given":
                state = "middle"
        at = max(1, at)
        words, last = words[:at], words[at:]
    first, middle = words[:1], words[1:] + middle
    return {k: " ".join(v) for k, v in (("title", title), ("first", first), ("middle", middle), ("last", last), ("suffix", suffix))}


def parsed(name: str | None) -> str:
    """"Last, First M, Jr." as "First M Last", without title and suffix; without a title a surname of more than three letters goes
    behind the one to three initials that follow it, if all of these have dots or none has."""
    p = name_parts(name)
    words = " ".join(p[k] for k in ("first", "middle", "last")).split()
    rest = words[1:]
    dotted = {w.endswith(".") for w in rest}
    if not p["title"] and 1 <= len(rest) <= 3 and len(words[0]) > 3 and len(dotted) == 1 and all(re.fullmatch(r"[^\W\d_]\.?", w) for w in rest):
        words = [*rest, words[0]]
    return " ".join(words)


def scripts(name: str | None) -> list[str]:
    """First words of the Unicode names of the letters that are not Latin, sorted; UNK for unnamed ones."""
    found = {unicodedata.name(c, "UNK").split()[0] for c in name or "" if c.isalpha()}
    return sorted(found - {"LATIN"})


def keeps_script(c: Column) -> Column:
    """Whether a name holds no letter of OTHER_SCRIPTS."""
    return ~F.coalesce(c, F.lit("")).rlike("[" + "".join(rf"\p{{Is{s}}}" for s in OTHER_SCRIPTS) + "]")


def cleaned(c: Column) -> Column:
    """``&NA;`` removed, digits and symbols to spaces, brackets removed, leading punctuation and extra spaces gone."""
    x = F.replace(F.coalesce(c, F.lit("")), F.lit("&NA;"), F.lit(""))
    x = F.regexp_replace(x, r"[0-9*#@$%^+=~_!?:;\"<>/|]", " ")
    x = F.regexp_replace(x, r"[\[\](){}\\]", "")
    x = F.regexp_replace(x, r"^[\s.,'-]+", "")
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def usable(raw: Column) -> Column:
    """Whether a name is one: no placeholder, and cleaned not empty, not too long, no link text; null is none."""
    name = F.when(raw.rlike(r"^[A-Za-z]+( [A-Za-z]+)*\z"), raw).otherwise(cleaned(raw))  # most are clean as they are
    fine = (name != "") & (F.length(name) <= MOST_CHARS) & ~F.lower(name).contains("download")
    return F.coalesce(~raw.isin(*PLACEHOLDERS) & fine, F.lit(False))


def coauthor_key(c: Column) -> Column:
    """First letter and last word of a name, lower-case without separators; a name of one word as it is without them."""
    return _key_of(F.trim(F.lower(c)))


def _key_of(low: Column) -> Column:
    spaced = F.translate(low, "\t\n\x0b\f\r", "     ")
    last = F.translate(F.substring_index(spaced, " ", -1), ".,:/-", "")
    key = F.when(F.contains(spaced, F.lit(" ")), F.concat(F.substring(low, 1, 1), F.lit("_"), last)).otherwise(last)
    return F.when(low.rlike(r"[\s.,:/-]"), key).otherwise(low)


def coauthor_keys(c: Column, longer_than: int = 6) -> Column:
    """The different keys of a list of coauthors that are longer than ``longer_than``, sorted; short ones tell nobody apart."""
    keys = F.transform(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.trim(F.lower(x))), _key_of)  # in two steps, so that each is taken once
    return F.sort_array(F.array_distinct(F.filter(keys, lambda k: F.length(k) > longer_than)))


def display_changed(old: str | None, new: str | None) -> bool:
    """Whether a display name differs by more than case, dots or diacritics."""
    return len(old or "") != len(new or "") or search_form(old) != search_form(new)


def block_of(search: Column) -> Column:
    """Blocking key: the last word."""
    return F.element_at(F.split(search, " "), -1)


def letter_of(search: Column) -> Column:
    """Blocking key: the first letter of what stands before the last word; empty for a name of one word."""
    return F.when(F.instr(F.trim(search), " ") > 0, F.substring(F.ltrim(search), 1, 1)).otherwise(F.lit(""))


def slots(name: str) -> dict[str, tuple[list[str], list[str]]]:
    """(names, initials) by slot: first, middle1 to middle5, last; hyphens are read as joined and as spaces."""
    found = {k: (set(), set()) for k in ("first", *(f"middle{i + 1}" for i in range(MIDDLES)), "last")}
    for reading in {name.replace("-", ""), name.replace("-", " ")}:
        words = reading.split()
        if not words:
            continue
        middle = words[1:-1]
        if len(middle) > MIDDLES:
            middle = [*middle[: MIDDLES - 1], "".join(middle[MIDDLES - 1 :])]
        for slot, word in [("first", words[0]), *((f"middle{i + 1}", w) for i, w in enumerate(middle)), ("last", words[-1])]:
            found[slot][1].add(word[0])
            if len(word) > 1:
                found[slot][0].add(word)
    return {k: (sorted(a), sorted(b)) for k, (a, b) in found.items()}


def merged_slots(structures: list[dict[str, tuple[list[str], list[str]]]]) -> dict[str, tuple[list[str], list[str]]]:
    """The slots of several names of one author as one structure: each slot's names and initials together.

    Search forms have no hyphens, so each name adds at most one of either to a slot.
    """
    return {k: tuple(sorted({x for s in structures for x in s[k][part]}) for part in (0, 1)) for k in slots("")}


def _agrees(a: tuple, b: tuple) -> bool:
    """Full names where both have them, else initials, else nothing speaks against it."""
    if a[0] and b[0]:
        return bool(set(a[0]) & set(b[0]))
    return bool(set(a[1]) & set(b[1])) if a[1] and b[1] else True


def _not_swapped(x: dict, y: dict) -> bool:
    """Whether first and last names agree by more than one name that stands in both slots.

    Where an author has been read both ways round, one name in both slots would match twice by itself. Names found in
    all four lists are set aside; of what is left, first names must meet first names or last names last names.
    """
    lists = [set(s[k][0]) for s in (x, y) for k in ("first", "last")]
    if not all(lists) or not any(first & last and len(first) > 1 for first, last in (lists[:2], lists[2:])):
        return True
    if all(len(n) == 2 for n in lists):
        return lists[2] | lists[3] <= lists[0] | lists[1]
    common = set.intersection(*lists)
    f, p, g, q = (n - common for n in lists)
    if not any((f, p, g, q)):
        return True
    return bool((f & g) or (p & q))


def compatible_slots(x: dict, y: dict) -> bool:
    """Whether two structures agree: first, last, guard against swapped names, then middles until both have none."""
    if not (x["first"][1] and y["first"][1]):
        return True
    if not _agrees(x["first"], y["first"]) or not _agrees(x["last"], y["last"]) or not _not_swapped(x, y):
        return False
    for i in range(1, MIDDLES + 1):
        p, q = x[f"middle{i}"], y[f"middle{i}"]
        if not p[1] and not q[1]:
            return True
        if p[1] and q[1] and not _agrees(p, q):
            return False
    return True


def rotated(a: str, b: str) -> bool:
    """Two names of two words each, one the other's turned round."""
    u, v = a.split(), b.split()
    return len(u) == len(v) == 2 and u == v[::-1]


def compatible(a: str, b: str) -> bool:
    """Whether two search forms may be one person's name; symmetric."""
    x, y = slots(a), slots(b)
    if x["first"][1] and y["first"][1] and not _agrees(x["first"], y["first"]):
        return rotated(a, b)
    return compatible_slots(x, y)


def registry_form(name: str | None) -> list[str]:
    """Words of a name in Latin letters for comparison with a registry: hyphens, dots, commas and bars part words, other symbols go."""
    text = re.sub(r"[.,|\-\u2010]", " ", latin(unicodedata.normalize("NFKC", name or "")).lower())
    return re.sub(r"[^\w\s]|[\d_]", "", text).split()


def evidence(author: str | None, given: list[str] | None, family: list[str] | None) -> list[float]:
    """[family, given, initials] points of a registry's name in an author string; all 0 where no family name is found.

    A token of two letters or more counts 1 as a whole word and 0.75 inside one; what matched is cut out. Of the given,
    then the family tokens left over, the first letter counts 1 as a whole word.
    """
    text = " ".join(registry_form(author))
    tokens = [[t for x in names or [] for t in registry_form(x)] for names in (family, given)]
    points, left = [0.0, 0.0, 0.0], ([], [])
    if tokens[0] and not any(t in text for t in tokens[0]):
        return points
    for kind, own in enumerate(tokens):
        for token in own:
            found = re.search(rf"\b{re.escape(token)}\b", text) if len(token) > 1 else None
            at = found.start() if found else text.find(token) if len(token) > 1 else -1
            if at < 0:
                left[kind].append(token)
                continue
            points[kind] += 1 if found else 0.75
            text = (text[:at] + text[at + len(token) :]).strip()
    for token in left[1] + left[0]:
        if found := re.search(rf"\b{re.escape(token[0])}\b", text):
            points[2] += 1
            text = (text[: found.start()] + text[found.end() :]).strip()
    return points


def accepted(e: Column) -> Column:
    """Whether an evidence array names the person."""
    return (F.get(e, F.lit(0)) > 0) & ((F.get(e, F.lit(1)) > 0) | (F.get(e, F.lit(2)) > 0))


def diacritics(name: str) -> int:
    return sum(fold(c) != c for c in name)


def plain_hyphens(c: Column) -> Column:
    """A name with plain hyphens and without a trailing bracket."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "[\u2010-\u2015]", "-"), r"[( ]+$", ""))


def display_names(rows: DataFrame, key: str, name: str) -> DataFrame:
    """(key, display_name): the most frequent name of more than one word; ties to the longest, then the greatest; of the
    variants that differ from it by diacritics only, the one with most of them. A key without names has "".

    Names are counted first; after that a key meets each of its different names once, and only in aggregates.
    """
    counts = rows.groupBy(F.col(key).alias("key"), F.col(name).alias("name")).agg(F.count("*").alias("n")).where(F.coalesce("name", F.lit("")) != "")
    counts = counts.withColumn("folded", fold_of("name"))
    order = F.struct(F.instr("name", " ") > 0, "n", F.length("name"), "name")
    best = counts.groupBy("key").agg(F.max_by("folded", order).alias("best")).select(F.col("key").alias("_key"), "best")
    same = counts.join(best, F.col("key").eqNullSafe(F.col("_key")) & (F.col("folded") == F.col("best"))).select("key", "name", "n")
    shown = same.groupBy(F.col("key").alias("_key")).agg(F.max_by("name", F.struct(diacritics_of("name"), "n", "name")).alias("display_name"))
    keys = rows.select(F.col(key).alias("key")).distinct()
    return keys.join(shown, F.col("key").eqNullSafe(F.col("_key")), "left").select(F.col("key").alias(key), F.coalesce("display_name", F.lit("")).alias("display_name"))


def alternates(rows: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name): names with plain hyphens and without a trailing bracket; of variants in dots and case the longest stays."""
    plain = rows.select(F.col(key).alias(key), plain_hyphens(F.col(name)).alias("name")).where("name <> ''")
    form = F.lower(F.replace("name", F.lit("."), F.lit("")))
    return plain.groupBy(key, form.alias("form")).agg(F.max_by("name", F.struct(F.length("name"), "name")).alias("name")).select(key, "name")


TEXTS = T.ArrayType(T.StringType())


@F.pandas_udf(T.StringType())
def search_form_of(names: pd.Series) -> pd.Series:
    return names.map(search_form)


def display_changed_of(old: Column, new: Column) -> Column:
    """``display_changed`` of two columns; null names are empty ones."""
    a, b = (F.coalesce(c, F.lit("")) for c in (old, new))
    return (F.length(a) != F.length(b)) | (search_form_of(a) != search_form_of(b))


@F.pandas_udf(T.StringType())
def parsed_of(names: pd.Series) -> pd.Series:
    return names.map(parsed)


PARTS = ("title", "first", "middle", "last", "suffix")


@F.pandas_udf(T.StructType([T.StructField(k, T.StringType()) for k in PARTS]))
def parts_of(names: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([name_parts(n) for n in names], columns=list(PARTS))


@F.pandas_udf(TEXTS)
def scripts_of(names: pd.Series) -> pd.Series:
    return names.map(scripts)


@F.pandas_udf(T.StringType())
def fold_of(names: pd.Series) -> pd.Series:
    return names.map(fold)


@F.pandas_udf(T.IntegerType())
def diacritics_of(names: pd.Series) -> pd.Series:
    return names.map(diacritics).astype("int32")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def evidence_of(author: pd.Series, given: pd.Series, family: pd.Series) -> pd.Series:
    lists = lambda x: [] if x is None else list(x)
    return pd.Series([evidence(a, lists(g), lists(f)) for a, g, f in zip(author, given, family, strict=True)])


SLOT_NAMES = [n for k in ("first", *(f"middle{i + 1}" for i in range(MIDDLES)), "last") for n in (k, f"{k}_initials")]
SLOT_TYPE = T.StructType([T.StructField(n, TEXTS) for n in SLOT_NAMES])


@F.pandas_udf(SLOT_TYPE)
def slots_of(names: pd.Series) -> pd.DataFrame:
    rows = []
    for n in names:
        row = {}
        for k, (full, initials) in slots(n or "").items():
            row[k], row[f"{k}_initials"] = full, initials
        rows.append(row)
    return pd.DataFrame(rows, columns=SLOT_NAMES)


def slots_match(a: str, b: str) -> Column:
    """``compatible`` of two columns of ``slots_of`` structures, beside which ``{column}_words`` holds the name's words."""
    u, v = F.col(f"{a}_words"), F.col(f"{b}_words")
    return structures_match(a, b, (F.size(u) == 2) & (F.size(v) == 2) & (u == F.reverse(v)))


def merged_slots_of(rows: DataFrame, key: str, slots_column: str) -> DataFrame:
    """(key, slots): the structures of all of a key's names as one, each slot's names and initials together.

    A key's different words in a slot meet, not its names' rows.
    """
    each = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.col(f"{slots_column}.{n}"))))).alias(n) for n in SLOT_NAMES]
    merged = rows.groupBy(key).agg(*each)
    return merged.select(key, F.struct(*SLOT_NAMES).alias("slots"))


def structures_match(a: str, b: str, unlike: Column | None = None) -> Column:
    """Whether two columns of structures, of one name or of several merged, agree; ``unlike``: what holds where first names do not."""
    x, y = (lambda k: F.col(f"{a}.{k}")), (lambda k: F.col(f"{b}.{k}"))
    some = lambda c: F.size(c) > 0

    def agrees(k: str) -> Column:
        initials = ~(some(x(f"{k}_initials")) & some(y(f"{k}_initials"))) | F.arrays_overlap(x(f"{k}_initials"), y(f"{k}_initials"))
        return F.when(some(x(k)) & some(y(k)), F.arrays_overlap(x(k), y(k))).otherwise(initials)

    middles = F.lit(True)
    for i in range(MIDDLES, 0, -1):
        k = f"middle{i}"
        middles = ~(some(x(f"{k}_initials")) | some(y(f"{k}_initials"))) | (agrees(k) & middles)
    lists = [x("first"), x("last"), y("first"), y("last")]
    alias = lambda f, p: F.arrays_overlap(f, p) & (F.size(f) > 1)
    guarded = some(lists[0]) & some(lists[1]) & some(lists[2]) & some(lists[3]) & (alias(lists[0], lists[1]) | alias(lists[2], lists[3]))
    pairs_only = (F.size(lists[0]) == 2) & (F.size(lists[1]) == 2) & (F.size(lists[2]) == 2) & (F.size(lists[3]) == 2)
    all_there = F.size(F.array_except(F.array_union(lists[2], lists[3]), F.array_union(lists[0], lists[1]))) == 0
    common = F.array_intersect(F.array_intersect(lists[0], lists[1]), F.array_intersect(lists[2], lists[3]))
    f, p, g, q = (F.array_except(n, common) for n in lists)
    left = ~(some(f) | some(p) | some(g) | some(q)) | F.arrays_overlap(f, g) | F.arrays_overlap(p, q)
    fine = ~guarded | F.when(pairs_only, all_there).otherwise(left)
    named = some(x("first_initials")) & some(y("first_initials"))
    return ~named | F.when(agrees("first"), agrees("last") & fine & middles).otherwise(F.lit(False) if unlike is None else unlike)
