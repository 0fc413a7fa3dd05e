"""URL filters: rules first, then trust that flows along the links between hosts.

Rules name a host with its subdomains and the beginning of a path; the longest rule that
fits decides. Pages that no rule decides take the verdict of their host. Hosts form a graph:
the absolute links of their pages, and a link both ways between a subdomain and the nearest
host above it that occurs itself, in a page or in a link. Trust starts at the hosts of allowed pages and follows the links (personalised
PageRank); distrust starts at the hosts of blocked pages and follows the links backwards, as
whoever links to a bad host is suspect. Where distrust outweighs trust, a host is blocked.

Defined cases: a url of null or without ``://`` has an empty host and path, fits no rule and
is allowed; a host that neither trust nor distrust reaches is allowed; a null or empty html
has no links; repeated rows each get their row and count as often in the graph; of rules of
equal length the first decides; other input columns pass through, those named like a result
are replaced by it. Ranks are doubles: what is left of a seed's rank after some 4,000 links in
a row is below the least of them and counts as none.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import count
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.arrow import column
from tallyline.session import materialize

ALLOW, BLOCK = "allow", "block"
DAMPING, ROUNDS_PER_JOB = 0.85, 5
# Ranks are settled when none changes by a larger share within a job; smaller ones than the
# least come near the end of what a double can hold and count as none.
TOLERANCE, LEAST_RANK = 1e-6, 1e-300
# Share of trust in trust and distrust under which a host is blocked.
LEAST_TRUST = 0.5

_LINK = r"""(?i)\b(?:href|src|action)\s*=\s*["']?\s*(?:https?:)?//([^\s"'<>/?#]+)"""


@dataclass(frozen=True)
class Rule:
    """``net/`` fits every path of net and its subdomains; ``a.net/x`` paths that begin /x."""

    verdict: str
    pattern: str

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, rest = self.pattern.partition("/")
        return ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, ascii_uppercase, ascii_lowercase)


def with_host(pages: DataFrame, *, url: str = "url") -> DataFrame:
    """``pages`` with host and path."""
    at = F.instr(column(url), "://")
    rest = F.when(at > 0, column(url).substr(at + 3, F.length(column(url)))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    found = {
        "host": lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    }
    kept = [column(c) for c in pages.columns if c.lower() not in found]
    return pages.select(*kept, *[c.alias(name) for name, c in found.items()])


def with_rule(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``pages`` with rule, the longest that fits, and its verdict; null where none does."""
    host, path = F.col("host"), F.col("path")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Built from the inside out: the longest comes last and is asked first.
    for r in sorted(reversed(rules), key=lambda r: len(r.pattern)):
        fits = r.fits(host, path)
        rule = F.when(fits, F.lit(r.pattern)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return pages.withColumns({"rule": rule, "verdict": verdict})


def node(host: Column) -> Column:
    """What a host is in the graph, of a page and at the end of a link alike: its name and
    port, without credentials and without the ports that browsers add themselves."""
    return F.regexp_replace(host, r"^.*@|:(?:80|443)?$", "")


def host_edges(hosted: DataFrame, *, html: str = "html") -> DataFrame:
    """Rows (src, dst, n): links between hosts with their numbers. Counted in the map tasks
    first, so a host with a third of all pages is a few rows by the time it is shuffled."""
    links = hosted.filter("host != ''").select(
        F.col("host").alias("src"), F.explode(F.regexp_extract_all(column(html), F.lit(_LINK), F.lit(1))).alias("dst")
    )
    links = links.select("src", node(lower_ascii(F.col("dst"))).alias("dst"))
    links = links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    links = materialize(links.filter("src != dst and dst != ''"), "links")
    hosts = hosted.filter("host != ''").select("host").distinct().union(links.select("dst")).distinct()
    # Every host with the nearest of the names above it, down to two labels, that is a host
    # itself: of a page or at the end of a link. A name that nobody uses ties nobody.
    hosts = materialize(hosts, "hosts")
    parts = F.split("host", r"\.")
    depth = F.size(parts)
    steps = F.when(depth > 2, F.sequence(F.lit(1), depth - 2))
    above = hosts.select(F.col("host").alias("low"), F.explode(steps).alias("k"), parts.alias("parts")).select(
        "low", "k", F.array_join(F.slice("parts", F.col("k") + 1, F.size("parts")), ".").alias("high")
    )
    used = above.join(hosts.select(F.col("host").alias("high")), "high")
    nearest = used.groupBy("low").agg(F.min("k").alias("k"))
    chain = materialize(used.join(nearest, ["low", "k"]).select("low", "high"), "chain")
    up = chain.select(F.col("low").alias("src"), F.col("high").alias("dst"), F.lit(1).cast("long").alias("n"))
    down = chain.select(F.col("high").alias("src"), F.col("low").alias("dst"), F.lit(1).cast("long").alias("n"))
    both = links.unionByName(up).unionByName(down)
    return both.groupBy("src", "dst").agg(F.sum("n").alias("n"))


def _settled(ranks: DataFrame, before: DataFrame, tolerance: float) -> bool:
    """Whether no host is new and no rank has changed by a larger share than ``tolerance``."""
    old = before.withColumnRenamed("rank", "_before")
    share = F.coalesce(F.abs(F.col("rank") - F.col("_before")) / F.col("rank"), F.lit(1.0))
    most = ranks.join(old, ["kind", "host"], "left").agg(F.max(share)).first()[0]
    return most is None or most <= tolerance


def propagate(
    edges: DataFrame,
    seeds: DataFrame,
    *,
    damping: float = DAMPING,
    rounds: int | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Rows (kind, host, rank) of personalised PageRank for every kind of ``seeds`` (kind,
    host, share; all shares add up to 1, so that kinds can be compared). ``edges`` are (kind, src, dst, share)
    with shares that add up to 1 per kind and src. What reaches a host without links ends
    there. Ranks are written every few rounds, which keeps plans short and survives the
    loss of executors. Without a number of ``rounds`` they go on until no host is new and no
    rank changes by a larger share than ``tolerance``: a threshold on the share of trust
    decides by ranks however small."""
    flows = edges.select(F.col("kind").alias("of"), "src", "dst", "share")
    start = seeds.select("kind", "host", (F.col("share") * (1 - damping)).alias("rank"))
    ranks = seeds.select("kind", "host", F.col("share").alias("rank"))
    before = ranks
    for done in count(1) if rounds is None else range(1, rounds + 1):
        passed = ranks.join(flows, (F.col("host") == F.col("src")) & (F.col("kind") == F.col("of"))).select(
            F.col("of").alias("kind"), F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank")
        )
        ranks = passed.unionByName(start).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if done % ROUNDS_PER_JOB == 0 or done == rounds:
            ranks = materialize(ranks.filter(F.col("rank") >= LEAST_RANK), "ranks")
            if rounds is None and _settled(ranks, before, tolerance):
                break
            before = ranks
    return ranks


def _shares(rows: DataFrame, by: list[str], n: str) -> DataFrame:
    """``rows`` with share: n over its sum within the group."""
    totals = rows.groupBy(*by).agg(F.sum(n).alias("_total"))
    return rows.join(totals, by).withColumn("share", F.col(n) / F.col("_total")).drop("_total", n)


def host_trust(ruled: DataFrame, *, html: str = "html", **options) -> DataFrame:
    """Rows (host, trust): the share of trust in what reached a host. ``ruled`` has host, as
    :func:`node` names it, and the verdicts of rules."""
    edges = materialize(host_edges(ruled, html=html), "graph")
    forward = edges.withColumn("kind", F.lit(ALLOW))
    backward = edges.select(
        F.col("dst").alias("src"), F.col("src").alias("dst"), "n", F.lit(BLOCK).alias("kind")
    )
    both = materialize(_shares(forward.unionByName(backward), ["kind", "src"], "n"), "flows")
    decided = ruled.filter("verdict is not null and host != ''").groupBy(F.col("verdict").alias("kind"), "host")
    seeds = materialize(decided.agg(F.count(F.lit(1)).alias("n")), "seeds")
    pages = seeds.agg(F.sum("n").alias("n")).first()["n"] or 1
    seeds = seeds.select("kind", "host", (F.col("n") / pages).alias("share"))
    ranks = propagate(both, seeds, **options)
    trust = F.coalesce(F.sum(F.when(F.col("kind") == ALLOW, F.col("rank"))), F.lit(0.0))
    return ranks.groupBy("host").agg((trust / F.sum("rank")).alias("trust"))


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    *,
    url: str = "url",
    html: str = "html",
    least_trust: float = LEAST_TRUST,
    **options,
) -> DataFrame:
    """``pages`` without html, with host, path, rule, trust (null where nothing is known)
    and verdict."""
    ruled = with_rule(with_host(pages, url=url), rules)
    graph = ruled.withColumn("host", node(F.col("host")))
    trust = materialize(host_trust(graph, html=html, **options), "trust").withColumnRenamed("host", "_node")
    judged = ruled.drop(column(html)).drop("trust").withColumn("_node", node(F.col("host")))
    judged = judged.join(trust, "_node", "left").drop("_node")
    by_host = F.when(F.col("trust") < least_trust, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return judged.withColumn("verdict", F.coalesce("verdict", by_host))
