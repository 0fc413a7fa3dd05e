"""Joins of token sets by Jaccard similarity: prefixes by rarity, bounds, and links that
connect components without comparing all pairs of a group.

Sets are rows (cid, n, tokens) with distinct ids, their size and distinct long tokens; a
similarity is given in percent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.components import components
from tallyline.session import materialize


def least_overlap(n: Column, percent: int) -> Column:
    """The fewest tokens a set of n tokens shares with any set it is linked to."""
    return F.floor((n * percent + 99) / 100)


def prefix_size(n: Column, percent: int) -> Column:
    """Linked sets share one of their first so many tokens in any order of all tokens."""
    return n - least_overlap(n, percent) + 1


def pair_overlap(n_a: Column, n_b: Column, percent: int) -> Column:
    """The fewest tokens that linked sets of these sizes share."""
    return F.ceil((n_a + n_b) * percent / (100 + percent))


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Rows (token, cid, n, own, place): the prefix of every set in the order of rarity,
    without the tokens that no other set has; ``own`` is the number of those, which come
    first. A set whose prefix holds no other tokens links with nothing and is gone."""
    postings = sets.select("cid", "n", F.explode("tokens").alias("token"))
    frequency = postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # Written, so that both sides of the join are plain shuffles and a hot token is split.
    shared = postings.join(materialize(frequency, "frequency"), "token")
    by_set = Window.partitionBy("cid")
    own = F.col("n") - F.count(F.lit(1)).over(by_set)
    rank = F.row_number().over(by_set.orderBy("df", "token"))
    ranked = shared.select("token", "cid", "n", own.alias("own"), (own + rank).alias("place"))
    return ranked.filter(F.col("place") <= prefix_size(F.col("n"), percent))


def can_link(percent: int) -> Column:
    """Two members, a and b, that meet at a token can still overlap enough: what comes after
    the token in both, and what others have of both, bounds the overlap."""
    least = pair_overlap(F.col("a.n"), F.col("b.n"), percent)
    after = 1 + F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"))
    common = F.least(F.col("a.n") - F.col("a.own"), F.col("b.n") - F.col("b.own"))
    sizes = F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent
    return sizes & (after >= least) & (common >= least)


def similar(percent: int) -> Column:
    """The sets of_a and of_b (n, tokens) are linked."""
    overlap = F.size(F.array_intersect("of_a.tokens", "of_b.tokens"))
    return 100 * overlap >= percent * (F.col("of_a.n") + F.col("of_b.n") - overlap)


def verified(pairs: DataFrame, sets: DataFrame, linked: Column) -> DataFrame:
    """The pairs (a, b) for whose sets, of_a and of_b, ``linked`` holds."""
    joined = materialize(pairs, "pairs")
    for side in "ab":
        whole = F.struct(*[c for c in sets.columns if c != "cid"]).alias(f"of_{side}")
        joined = joined.join(sets.select(F.col("cid").alias(side), whole), side)
    return materialize(joined.filter(linked).select("a", "b"), "links")


def connecting_links(
    members: DataFrame, percent: int, verify: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Links (a, b) that connect the components of all sets. ``members`` are rows (meet,
    cid, n, own, place): sets that meet under one value of ``meet`` are candidates.

    First every set is compared with the most typical one it meets, the one with the
    smallest share of tokens of its own. After that only sets still in different components
    meet. No candidate is dropped: it is in one component already or is verified."""
    members = materialize(members, "members")
    typical = F.struct((F.col("own") / F.col("n")).alias("oddness"), "cid", "n", "own", "place")
    pivots = members.groupBy("meet").agg(F.min(typical).alias("pivot"), F.count(F.lit(1)).alias("size"))
    pivots = materialize(pivots.filter("size > 1").select("meet", "pivot.*"), "pivots")
    met = members.alias("a").join(pivots.alias("b"), "meet").filter("a.cid != b.cid").filter(can_link(percent))
    times = met.groupBy(F.col("a.cid").alias("a"), F.col("b.cid").alias("b")).agg(F.count(F.lit(1)).alias("times"))
    best = times.groupBy("a").agg(F.max(F.struct("times", (-F.col("b")).alias("b"))).alias("best"))
    first = verify(best.select("a", (-F.col("best.b")).alias("b")))
    labels = components(first).withColumnRenamed("node", "cid")
    labelled = members.join(labels, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    mixed = labelled.groupBy("meet").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = materialize(mixed.filter("low < high").select("meet"), "mixed")
    open_sets = materialize(labelled.join(mixed, "meet"), "open")
    apart = F.col("a.component") < F.col("b.component")
    again = open_sets.alias("a").join(open_sets.alias("b"), "meet").filter(apart & can_link(percent))
    again = again.select(F.col("a.cid").alias("a"), F.col("b.cid").alias("b")).distinct()
    return first.unionByName(verify(again))
