"""URL filter by the ratio of two character language models, in DataFrame operations only.

Rules on host and path label some URLs; a variable-order Markov model is counted for the accepted and one for the
rejected ones. A symbol's probability mixes the contexts of ORDER, ..., one and no symbols before it by Witten-Bell
weights, so a context counts as far as it was seen; a context of two symbols or more that was seen fewer than LEAST times
is pruned and the next shorter one stands for it. The score is the mean over the URL of the difference of the
log-probabilities; the cut between accepted and rejected is calibrated on labelled URLs that the models did not count
(those of crc32 divisible by FOLDS).

Probabilities are worked out once for each different gram of ORDER + 1 symbols in the URLs, from the shortest context up,
by joins of tables of different grams; they are broadcast to the URLs' positions only while they are measured to be
small. Where a rule fits, it decides.

Defined cases: a null URL or one without ``://`` has an empty host and path; a URL of no symbols has score null and is
allowed; without accepted or without rejected URLs every other URL is allowed; repeated rows are judged each; other
columns, also of clashing names, are left aside; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioflow.llm.common import ascii_lower, sized, table

#: Symbols besides the start mark: letters, digits, these, and ~ for anything else.
MARKS = "/.-_?=&%:#"
ALPHABET = 26 + 10 + len(MARKS) + 1 + 1
START = "^"
#: Symbols of the longest context, and how often a context of more than one is seen at least.
ORDER, LEAST = 5, 2
#: Contexts of so many symbols have at most ALPHABET ** (SHORT + 1) grams, whatever the corpus.
SHORT = 2
FOLDS = 5
#: Scores are calibrated in steps of this size, within a range.
STEP, RANGE = 0.01, 20


@dataclass(frozen=True)
class Rule:
    allow: bool
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(name, allow) of the longest rule that fits; null if none does."""
    name = allow = F.lit(None)
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, allow = F.when(fits, F.lit(rule.name)).otherwise(name), F.when(fits, F.lit(rule.allow)).otherwise(allow)
    return name.cast("string"), allow.cast("boolean")


def symbols(url: Column) -> Column:
    """What follows ``://`` (or the whole), in the small alphabet."""
    at = F.instr(url, "://")
    low = ascii_lower(F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(url))
    return F.regexp_replace(low, f"[^a-z0-9{MARKS.replace('-', chr(92) + '-')}]", "~")


def grams(rows: DataFrame, text: str, order: int = ORDER) -> DataFrame:
    """A row for each symbol, with the ``order`` before it; a row of null for an empty text."""
    n = F.length(text)
    places = F.when(n > 0, F.sequence(F.lit(1), n))
    padded = F.concat(F.lit(START * order), F.col(text))
    return rows.withColumn("at", F.explode_outer(places)).withColumn("gram", F.substring(padded, F.col("at"), F.lit(order + 1))).drop("at")


def log_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, ratio): log p(symbol | accepted) - log p(symbol | rejected) for each gram in ``counts``.

    counts: (gram, yes, no), occurrences in accepted and rejected URLs, 0 for grams of other URLs only.
    """
    sides = ("yes", "no")
    whole = counts.agg(*[F.sum(c).alias(c) for c in sides]).first()
    total = {c: whole[c] or 0 for c in sides}
    level = counts.groupBy(F.right("gram", F.lit(1)).alias("gram")).agg(*[F.sum(c).alias(c) for c in sides])
    found = level.select("gram", *[((F.col(c) + 1) / (total[c] + ALPHABET)).alias(f"p_{c}") for c in sides])
    for k in range(1, order + 1):
        level = counts.groupBy(F.right("gram", F.lit(k + 1)).alias("gram")).agg(*[F.sum(c).alias(c) for c in sides])
        level = level.withColumns({"context": F.left("gram", F.lit(k)), "shorter": F.right("gram", F.lit(k))})
        seen = level.groupBy("context").agg(*[F.sum(c).alias(f"n_{c}") for c in sides], *[F.count_if(F.col(c) > 0).alias(f"t_{c}") for c in sides])
        if k > 1:
            seen = seen.where(F.col("n_yes") + F.col("n_no") >= LEAST)
        found = found.withColumnRenamed("gram", "shorter")
        if k <= SHORT:
            seen, found = F.broadcast(seen), F.broadcast(found)

        def mixed(c: str) -> Column:
            n, t = F.col(f"n_{c}"), F.col(f"t_{c}")
            return F.when(n > 0, (F.col(c) + t * F.col(f"p_{c}")) / (n + t)).otherwise(F.col(f"p_{c}")).alias(f"p_{c}")

        found = level.join(found, "shorter").join(seen, "context", "left").select("gram", *[mixed(c) for c in sides])
    return found.select("gram", (F.log("p_yes") - F.log("p_no")).alias("ratio"))


def threshold(labelled: DataFrame) -> float | None:
    """The cut on ``score`` of the fewest wrong verdicts on rows of (score, allow), in the middle of the widest gap.

    None without both kinds.
    """
    step = F.greatest(F.least(F.floor(F.col("score") / STEP), F.lit(int(RANGE / STEP))), F.lit(-int(RANGE / STEP)))
    by = labelled.where("score is not null").groupBy(step.alias("step")).agg(F.sum(F.col("allow").cast("int")).alias("yes"), F.sum((~F.col("allow")).cast("int")).alias("no"))
    rows = sorted((r["step"], r["yes"], r["no"]) for r in by.collect())  # at most 2 * RANGE / STEP + 1 rows
    wrong = sum(no for _, _, no in rows)
    if not wrong or wrong == sum(yes + no for _, yes, no in rows):
        return None
    cuts = []  # (wrong verdicts, width of the gap, cut) between neighbouring steps
    for (at, yes, no), (then, _, _) in zip(rows, rows[1:], strict=False):
        wrong += yes - no
        cuts.append((wrong, at - then, (at + 1 + then) / 2))
    if not cuts:
        return None
    cut = min(cuts, key=lambda c: (c[0], -c[1]))[2]
    return cut * STEP


def judged(pages: DataFrame, rules: tuple[Rule, ...], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, url, host, path, rule, score, verdict) for every row; score: mean log-ratio, higher is accepted."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.monotonically_increasing_id().alias("row"))
    rows = table(rows, "numbered")
    host, path = host_and_path(F.col("url"))
    _, allow = rule_of(host, path, rules)
    known = rows.select("url", symbols(F.col("url")).alias("text"), allow.alias("allow"))
    counted = F.crc32(F.encode("url", "UTF-8")) % FOLDS != 0
    of = lambda ok: F.sum((counted & F.col("allow").eqNullSafe(ok)).cast("long"))
    counts = table(grams(known, "text").where("gram is not null").groupBy("gram").agg(of(True).alias("yes"), of(False).alias("no")), "grams")
    ratios = table(log_ratios(counts), "ratios")
    placed = grams(rows.select("row", symbols(F.col("url")).alias("text")), "text").select("row", "gram")  # of a URL only its number is copied
    scores = placed.join(sized(ratios, 40), "gram").groupBy("row").agg(F.avg("ratio").alias("score"))
    scores = rows.join(scores, "row", "left")
    host, path = host_and_path(F.col("url"))
    name, allow = rule_of(F.col("host"), F.col("path"), rules)
    found = table(scores.withColumn("host", host).withColumn("path", path).select("page_id", "url", "host", "path", name.alias("rule"), allow.alias("allow"), "score"), "urls")
    cut = threshold(found.where(~counted & F.col("allow").isNotNull()).select("score", "allow"))
    blocked = F.coalesce(~F.col("allow"), F.col("score") < F.lit(cut), F.lit(False))
    return found.select("page_id", "url", "host", "path", "rule", "score", F.when(blocked, "block").otherwise("allow").alias("verdict"))
