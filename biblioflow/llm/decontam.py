"""Benchmark decontamination by a distributed positional inverted index, in DataFrame operations only.

1. ``tokens``: the words of every document, written once, with a number for each row.
2. ``postings``: the index, written once: a posting (term, row, at) for each place of a term in the corpus, either of all
   terms (an index for any test set) or of those in a vocabulary.
3. ``probes``: the different windows of the test items, each with its terms' places from the rarest term on.
4. ``phrases``: the lists of a window's two rarest terms are intersected, shifted by the terms' places (windows that
   overlap share the pair, so it is looked up once); what is left is intersected with the lists of all other terms at
   their places. A window is found where every list has its posting.
5. ``proximity``: spans of at most the window's length plus ``slack`` words that hold ``share`` of its different terms.
   If k terms may be missing, one of any k + 1 must be there, so the k + 1 rarest are looked up, and the postings
   around each are counted.

The tests' side of a join is broadcast only if its measured size allows; beyond that the same join is shuffled.

Defined cases: a null or empty text has no words; an item without words has no window; an item of fewer words than a
window is one window; a null item_id counts as the empty text; every row is judged by its own text, whatever rows share
its doc_id; other columns, also of clashing names, are left aside; empty tables give no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioflow.llm.common import ascii_lower, row_key, sized, spare, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words of a text; null has none."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, words, n_words), written once; ``row`` numbers the rows."""
    split = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), words(F.col(text)).alias("words"))
    return table(split.withColumn("n_words", F.size("words").cast("long")), "tokens")


def windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", length: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(win, terms): the different runs of ``length`` words, or the whole of a shorter item; (win, item_id as text)."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(length - 1), F.lit(1)))
    runs = items.select("item_id", "w", F.explode(starts).alias("s")).select("item_id", F.slice("w", F.col("s"), F.lit(length)).alias("terms")).distinct()
    different = table(runs.select("terms").distinct().withColumn("win", F.monotonically_increasing_id()), "windows")
    return different, table(runs.join(different, "terms").select("win", "item_id"), "items")


def vocabulary(different: DataFrame) -> DataFrame:
    return table(different.select(F.explode("terms").alias("term")).distinct(), "vocabulary")


def postings(corpus: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """(term, row, at): every place of every term, or of those in ``terms`` (term)."""
    placed = corpus.select("row", F.posexplode("words").alias("at", "term")).select("term", "row", "at")
    if terms is not None:
        placed = placed.join(sized(terms, F.octet_length("term") + 16), "term")
    return table(placed, "postings")


def probes(index: DataFrame, different: DataFrame) -> DataFrame:
    """(win, terms, by): the window's (n, place, term), rarest first; n: postings of the term, 0 if it has none."""
    counts = table(index.groupBy("term").agg(F.count("*").alias("n")), "counts")
    placed = different.select("win", F.posexplode("terms").alias("place", "term")).join(sized(counts, F.octet_length("term") + 24), "term", "left")
    entry = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "term")
    by = placed.groupBy("win").agg(F.sort_array(F.collect_list(entry)).alias("by"))  # at most a window's length
    return table(different.join(by, "win"), "probes")


def phrases(index: DataFrame, tests: DataFrame) -> DataFrame:
    """(row, win, start, length) of every occurrence of a window."""
    known = tests.where(F.col("by")[0]["n"] > 0).select("win", F.size("terms").alias("length"), F.col("by")[0].alias("a"), F.get("by", F.lit(1)).alias("b"), F.slice("by", 3, 1 << 30).alias("rest"))
    shift = (F.col("b.place") - F.col("a.place")).alias("shift")
    pairs = table(known.where(F.col("b").isNotNull()).select(F.col("a.term").alias("term"), F.col("b.term").alias("next"), shift).distinct(), "pairs")
    width = F.octet_length("term") + F.octet_length("next") + 24
    firsts = index.join(sized(pairs, width), "term").select("row", "at", "term", "next", "shift", (F.col("at") + F.col("shift")).alias("next_at"))
    seconds = table(pairs.select("next").distinct(), "seconds")
    lists = index.join(sized(seconds, F.octet_length("next") + 16), F.col("term") == F.col("next")).select("row", "next", F.col("at").alias("next_at"))
    both = firsts.join(lists, ["row", "next", "next_at"]).select("row", "at", "term", "next", "shift")
    placed = known.select("win", "length", "rest", F.col("a.term").alias("term"), F.col("b.term").alias("next"), shift, F.col("a.place").alias("place"))
    held = table(placed, "placed")
    met = both.join(sized(held, F.lit(400)), ["term", "next", "shift"]).select("row", "win", "length", "rest", (F.col("at") - F.col("place")).alias("start")).where("start >= 0")
    begun = table(met, "candidates")
    alone = index.join(sized(held.where("length = 1"), F.lit(400)), "term").select("row", "win", F.col("at").alias("start"), "length")
    places = begun.select("row", "win", "start", "length", F.explode("rest").alias("x")).select("row", "win", "start", "length", (F.col("start") + F.col("x.place")).alias("at"), F.col("x.term").alias("term"))
    rows = table(begun.where("length > 2").select("row").distinct(), "rows")
    rest = index.join(sized(rows, 16), "row")
    full = places.join(rest, ["row", "at", "term"]).groupBy("row", "win", "start", "length").agg(F.count("*").alias("n")).where("n = length - 2")
    found = full.select("row", "win", "start", "length").union(begun.where("length = 2").select("row", "win", "start", "length")).union(alone)
    return table(found, "phrases")


def proximity(index: DataFrame, tests: DataFrame, slack: int, share: float) -> DataFrame:
    """(row, win, start, length): spans of at most the window's length + ``slack`` words, from one of its terms to another,
    that hold at least ``share`` of its different terms; for every term a span begins at, the longest such one."""
    own = tests.select("win", F.array_distinct("terms").alias("terms"), (F.size("terms") + slack).alias("width"), F.array_distinct(F.transform("by", lambda x: F.struct(x["n"].alias("n"), x["term"].alias("term")))).alias("by"))
    own = own.withColumn("need", F.ceil(F.size("terms") * F.lit(share)).cast("int"))
    looked = own.select("win", "terms", "width", "need", F.explode(F.slice("by", F.lit(1), F.size("terms") - F.col("need") + 1)).alias("x")).where("x.n > 0")
    looked = table(looked.select("win", "terms", "width", "need", F.col("x.term").alias("term")), "looked")
    block = lambda at: F.floor(at / F.col("width"))
    anchors = index.join(sized(looked, F.lit(600)), "term").withColumn("block", F.explode(F.sequence(block(F.col("at")) - 1, block(F.col("at")) + 1)))
    widths = table(looked.select("width").distinct(), "widths")
    blocks = index.join(sized(vocabulary(looked), F.octet_length("term") + 16), "term").select(F.col("row"), F.col("term").alias("other"), F.col("at").alias("there"))
    blocks = blocks.withColumn("width", F.explode(F.array(*[F.lit(r["width"]) for r in widths.collect()]))) if not widths.isEmpty() else blocks.withColumn("width", F.lit(0))  # at most a window's length of widths
    blocks = blocks.withColumn("block", block(F.col("there")))
    near = anchors.join(blocks, ["row", "width", "block"]).where(F.array_contains("terms", F.col("other")) & (F.abs(F.col("at") - F.col("there")) < F.col("width")))
    around = near.groupBy("row", "win", "at", "width", "need").agg(F.sort_array(F.collect_list(F.struct("there", "other"))).alias("p"))  # below 2 x width postings
    inside = lambda x: F.filter("p", lambda y: (y["there"] >= x["there"]) & (y["there"] < x["there"] + F.col("width")))
    spans = F.transform("p", lambda x: F.struct(x["there"].alias("start"), F.size(F.array_distinct(F.transform(inside(x), lambda y: y["other"]))).alias("n"), (F.array_max(inside(x))["there"] - x["there"] + 1).alias("length")))
    fine = F.filter(spans, lambda x: (x["n"] >= F.col("need")) & (x["start"] <= F.col("at")) & (x["start"] + x["length"] > F.col("at")))
    return around.select("row", "win", F.explode(fine).alias("s")).select("row", "win", "s.start", "s.length").distinct()


def find(corpus: DataFrame, benchmark: DataFrame, length: int = WINDOW, slack: int | None = None, share: float = 0.8, index: DataFrame | None = None) -> DataFrame:
    """(row, item_id, start, length, kind) of the items' windows in a ``tokens`` table: phrases and, given ``slack``,
    proximity matches that begin where no phrase of the same window does.

    ``index``: ``postings`` of all the corpus's terms, if there is one; else the windows' terms are indexed.
    """
    different, items = windows(benchmark, length=length)
    index = postings(corpus, vocabulary(different)) if index is None else index
    tests = probes(index, different)
    exact = phrases(index, tests)
    found = exact.withColumn("kind", F.lit("phrase"))
    if slack is not None:
        near = proximity(index, tests, slack, share).join(exact.select("row", "win", "start"), ["row", "win", "start"], "left_anti")
        found = found.unionByName(near.withColumn("kind", F.lit("proximity")))
    return found.join(sized(items, F.octet_length("item_id") + 24), "win").select("row", "item_id", "start", "length", "kind").distinct()


def covered(spans: Column) -> Column:
    """Places covered by sorted (start, end) spans."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach"))
    step = lambda acc, x: F.struct((acc["n"] + F.greatest(x["end"] - F.greatest(x["start"], acc["reach"]), F.lit(0))).alias("n"), F.greatest(acc["reach"], x["end"]).alias("reach"))
    return F.aggregate(spans, zero, step, lambda acc: acc["n"])


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated) for every row of ``docs``; items is the sorted list of item ids."""
    corpus = tokens(docs, doc_id, text)
    found = find(corpus, benchmark, length)
    span = F.struct(F.col("start"), (F.col("start") + F.col("length")).alias("end"))
    hits = found.groupBy("row").agg(F.sort_array(F.collect_set(span)).alias("spans"), F.sort_array(F.collect_set("item_id")).alias("items"))
    joined = corpus.select("row", "doc_id", "n_words").join(hits, "row", "left")
    n_hit = F.coalesce(covered(F.col("spans")), F.lit(0).cast("long"))
    out = joined.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", length: int = WINDOW) -> DataFrame:
    """``docs`` without the rows of contaminated texts; each row is judged by its own text, whatever rows share its id."""
    key = spare(docs, "_key")
    keyed = docs.withColumn(key, row_key(docs))
    bad = table(report(keyed, benchmark, key, text, length).where("contaminated").select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return keyed.join(sized(bad, 40), key, "left_anti").drop(key)
