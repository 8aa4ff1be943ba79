"""Evidence between authorships by postings: pairs come from what they share, never from an author's whole list of works.

A posting is (kind, token): an institution, concept, coauthor key, reference, the paper that one cites, the paper that cites
one. Texts are hashed to 64 bits. ``best_authorships`` gives for each new authorship and candidate author the member of most
evidence, with the counts that make its features.

For most authors the shared postings of a pair are simply counted. An author of more than CROWD works may have postings that
very many of its works hold, and there they are not multiplied out:

* rare postings (of at most CROWD of the author's works) give pairs as they are;
* works that hold the same crowded postings, and as many concepts, coauthors and references, are one class. A new authorship
  that shares only crowded postings with them has the same total with each, so the smallest id speaks for the class. (If that
  one shares rare postings as well, its own total is higher and the class does not matter.) So the best member is among the
  pairs of rare postings and the classes' first members;
* classes are looked at only where they can still win: with s crowded postings of a kind in common, of a that the new
  authorship has, the Jaccard similarity is at most s / a, and the sum of these must reach the best total so far.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioflow.functions.columns import jaccard, newest, overlap
from biblioflow.sources.stages import sized, staged

#: Works of one author that hold a posting, up to which pairs are made from it.
CROWD = 64
SETS = ("institutions", "concepts", "coauthors", "citations")
INSTITUTION, CONCEPT, COAUTHOR, REFERENCE, CITES, CITED = range(6)
#: Sets whose Jaccard similarities are added up.
SIMILAR = {"concepts": CONCEPT, "coauthors": COAUTHOR, "citations": REFERENCE}
#: What a similarity may be above its bound by rounding to four digits.
SLACK = 0.0002


def _tokens(kind: int, items: Column) -> Column:
    return F.transform(items, lambda x: F.struct(F.lit(kind).alias("kind"), x.cast("bigint").alias("token")))


def postings(rows: DataFrame, new: bool, *keys: str) -> DataFrame:
    """(keys, kind, token) of authorships with paper_id and the lists of SETS; ``new`` says from which side a citation is read."""
    own = F.array(F.col("paper_id"))
    hashed = F.transform("coauthors", lambda x: F.xxhash64(x))
    citations, papers = (F.col("citations"), own) if new else (own, F.col("citations"))
    parts = [_tokens(INSTITUTION, F.col("institutions")), _tokens(CONCEPT, F.col("concepts")), _tokens(COAUTHOR, hashed), _tokens(REFERENCE, F.col("citations")), _tokens(CITES, citations), _tokens(CITED, papers)]
    return rows.select(*keys, F.explode(F.array_distinct(F.concat(*parts))).alias("p")).select(*keys, "p.kind", "p.token")


def sized_sets(rows: DataFrame, side: int) -> DataFrame:
    """(work_author_id_{side}, n_{set}_{side}): how many different members the sets have whose similarity counts."""
    return rows.select(F.col("work_author_id").alias(f"work_author_id_{side}"), *[F.size(F.array_distinct(F.col(c))).alias(f"n_{c}_{side}") for c in SIMILAR])


def _totals(found: DataFrame, shared: dict[int, Column]) -> DataFrame:
    """Features of pairs by how many postings of each kind they share; n_{set}_1 and n_{set}_2 are the sets' sizes."""
    flag = lambda c: F.when(c > 0, 1).otherwise(0)
    parts = {"inst_per": flag(shared[INSTITUTION]), "citation_work_match": flag(shared[CITES] + shared[CITED])}
    for name, kind in SIMILAR.items():
        union = F.col(f"n_{name}_1") + F.col(f"n_{name}_2") - shared[kind]
        parts[FEATURE[name]] = F.when(union > 0, F.round(shared[kind] / union, 4)).otherwise(0.0)
    return _with_total(found.withColumns(parts))


FEATURE = {"concepts": "concepts_per", "coauthors": "coauthors_per", "citations": "citation_per"}
FEATURES = ("inst_per", *FEATURE.values(), "citation_work_match")


def _with_total(found: DataFrame) -> DataFrame:
    return found.withColumn("total_per", F.round(sum((F.col(c) for c in FEATURES[1:]), F.col(FEATURES[0])), 6))


PAIR = ["work_author_id_1", "author_id", "work_author_id_2"]


def counted_pairs(asks: DataFrame, holds: DataFrame, new: DataFrame, rows: DataFrame) -> DataFrame:
    """Totals of all pairs that share a posting, from the shared postings alone."""
    many = [F.count_if(F.col("kind") == k).alias(f"_k{k}") for k in range(6)]
    met = asks.join(holds, ["author_id", "kind", "token"]).groupBy(*PAIR).agg(*many)
    known = met.join(sized_sets(new, 1), "work_author_id_1").join(sized_sets(rows, 2), "work_author_id_2")
    return _totals(known, {k: F.col(f"_k{k}") for k in range(6)}).select(*PAIR, *FEATURES, "total_per")


def judged_pairs(pairs: DataFrame, new: DataFrame, rows: DataFrame) -> DataFrame:
    """Totals of given pairs, from the lists of both sides."""
    side = lambda df, s: df.select(*[F.col(c).alias(f"{c}_{s}") for c in ("work_author_id", "paper_id", *SETS)])
    both = pairs.select(*PAIR).join(side(new, 1), "work_author_id_1").join(side(rows, 2), "work_author_id_2")
    cites = F.array_contains("citations_1", F.col("paper_id_2")) | F.array_contains("citations_2", F.col("paper_id_1"))
    parts = {"inst_per": F.when(overlap(F.col("institutions_1"), F.col("institutions_2")) > 0, 1).otherwise(0), "citation_work_match": F.when(cites, 1).otherwise(0)}
    parts |= {FEATURE[c]: jaccard(F.col(f"{c}_1"), F.col(f"{c}_2")) for c in SIMILAR}
    return _with_total(both.withColumns(parts)).select(*PAIR, *FEATURES, "total_per")


def best(pairs: DataFrame) -> DataFrame:
    """Of each new authorship and author the pair of the greatest total, then the smallest member; one above zero."""
    return newest(pairs.where("total_per > 0"), ["work_author_id_1", "author_id"], F.desc("total_per"), F.col("work_author_id_2"))


def crowded_best(asks: DataFrame, holds: DataFrame, new: DataFrame, rows: DataFrame, crowd: int) -> DataFrame:
    """``best`` for authors whose works share postings by the thousand, without making those pairs."""
    key = ["author_id", "kind", "token"]
    often = staged(holds.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > crowd).select(*key), "crowded")
    marked = holds.join(sized(often.withColumn("_often", F.lit(True)), 48), key, "left")
    rare = asks.join(marked.where("_often is null"), key).select(*PAIR).distinct()
    first = staged(best(judged_pairs(rare, new, rows)), "rare")
    numbers = [f"n_{c}_2" for c in SIMILAR]
    crowded = marked.where("_often").groupBy("author_id", "work_author_id_2").agg(F.sort_array(F.collect_list(F.struct("kind", "token"))).alias("held"))
    classes = crowded.join(sized_sets(rows, 2), "work_author_id_2").groupBy("author_id", "held", *numbers).agg(F.min("work_author_id_2").alias("work_author_id_2"))
    spoken = staged(classes.select("author_id", "work_author_id_2", F.explode("held").alias("p")).select("author_id", "work_author_id_2", "p.kind", "p.token"), "classes")
    wanted = asks.join(sized(often, 40), key)
    some = lambda *kinds: F.max(F.col("kind").isin(*kinds).cast("int"))
    many = [F.count_if(F.col("kind") == k).alias(f"_k{k}") for k in SIMILAR.values()]
    bound = F.col("flags") + F.lit(SLACK)
    for c, k in SIMILAR.items():
        bound = bound + F.col(f"_k{k}") / F.greatest(F.col(f"n_{c}_1"), F.lit(1))
    may = wanted.groupBy("work_author_id_1", "author_id").agg((some(INSTITUTION) + some(CITES, CITED)).alias("flags"), *many)
    may = may.join(sized_sets(new, 1), "work_author_id_1").join(first.select("work_author_id_1", "author_id", "total_per"), ["work_author_id_1", "author_id"], "left")
    may = may.where(bound >= F.coalesce("total_per", F.lit(0.0)))
    more = wanted.join(may.select("work_author_id_1", "author_id"), ["work_author_id_1", "author_id"]).join(spoken, key).select(*PAIR).distinct()
    return best(first.unionByName(judged_pairs(more, new, rows)))


def best_authorships(met: DataFrame, new: DataFrame, clusters: DataFrame, rows: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(work_author_id_1, author_id, work_author_id_2, features, total_per): for each candidate the member of most evidence.

    met: (work_author_id_1, author_id); new and rows: work_author_id, paper_id and the lists of SETS, of the new authorships and of
    all; clusters: (work_author_id, author_id), an authorship having one author. Candidates that share nothing are left out.
    """
    met = staged(met.select("work_author_id_1", "author_id").distinct(), "candidates")
    own = clusters.select("work_author_id", "author_id").join(met.select("author_id").distinct(), "author_id", "left_semi")
    large = staged(own.groupBy("author_id").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("author_id"), "large")
    holds = postings(own.join(rows, "work_author_id").withColumnRenamed("work_author_id", "work_author_id_2"), False, "author_id", "work_author_id_2")
    asks = postings(met.join(new.withColumnRenamed("work_author_id", "work_author_id_1"), "work_author_id_1"), True, "author_id", "work_author_id_1")
    if large.isEmpty():
        return best(counted_pairs(asks, holds, new, rows))
    big = sized(large, 16)
    part = lambda df, how: df.join(big, "author_id", how)
    few = best(counted_pairs(part(asks, "left_anti"), part(holds, "left_anti"), new, rows))
    return few.unionByName(crowded_best(part(asks, "left_semi"), part(holds, "left_semi"), new, rows, crowd))


def _named(kind: int, items: Column) -> Column:
    return F.transform(items, lambda x: F.struct(F.lit(kind).alias("kind"), x.cast("string").alias("token")))


def shared_weights(free: DataFrame, anchored: DataFrame, weights: dict[str, float], group: str, key: str, anchor: str) -> DataFrame:
    """(group, key, anchor, score): weighted numbers of members that a row of ``free`` shares with the union of an anchor's rows.

    Both sides: ``group`` and the lists named in ``weights``; ``free`` has ``key``, ``anchored`` has ``anchor``. Only what is shared
    meets; an anchor's members are counted once.
    """
    kinds = {c: k for k, c in enumerate(weights)}

    def listed(df: DataFrame, own: str) -> DataFrame:
        items = [_named(k, F.coalesce(F.col(c), F.array())) for c, k in kinds.items()]
        return df.select(group, own, F.explode(F.concat(*items)).alias("p")).select(group, own, "p.kind", "p.token").where("token is not null").distinct()

    met = listed(free, key).join(listed(anchored, anchor), [group, "kind", "token"])
    total = F.lit(0.0)
    many = [F.count_if(F.col("kind") == k).alias(f"_k{k}") for k in kinds.values()]
    for c, k in kinds.items():
        total = total + F.lit(weights[c]) * F.col(f"_k{k}")
    return met.groupBy(group, key, anchor).agg(*many).select(group, key, anchor, F.round(total, 6).alias("score"))
