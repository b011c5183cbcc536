"""URL rules, and link-graph propagation for hosts that no rule decides.

Rules name a host (with its subdomains) and a path prefix; the longest that fits
decides a page.  For the other pages the host decides: personalised PageRank runs
from trusted seeds along links, and distrust runs from blocked seeds against
them (who links to a bad host is suspect), both over host-to-host edges.  A host
seeds trust and distrust by the shares of its own pages that rules allow and block.

What rules say of a host's own pages outweighs the graph: such a host keeps its two
shares, and gives them on, whatever links to it.  Any other host has ``score = damping *
sum of incoming``, in units of a full seed: trust is shared over a giver's links, distrust
over the links to its giver.  A host is blocked when its distrust reaches ``threshold`` and
exceeds its trust, so a threshold means the same whatever the number of hosts.

Scale: pages are aggregated to hosts and links to host pairs before anything is
joined; scores live in tables, one row per host, and a round is one join and one
aggregation over stored edges, which adaptive execution may split at a heavy host;
``ROUNDS`` of them make one job and one stored table.

Defined results: a null url, or one without ``://``, has an empty host and path,
fits no rule and is allowed; a null html has no links; repeated rows are judged
each; links inside a host don't count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import store

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
HREF = r"(?is)<a\s[^>]*?href\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s>]+)"
ROUNDS = 6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def deciding_rule(rules: list[Rule], host: Column, path: Column, say) -> Column:
    """``say(rule)`` of the longest rule that fits (of equals, the first); else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules[::-1], key=lambda r: len(r.text)):  # the last that fits is taken
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(say(r))).otherwise(out)
    return out


def ruled(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``ruled`` (the rule's verdict)."""
    parts = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    host, path = F.col("host"), F.col("path")
    unique = list({r.text: r for r in reversed(rules)}.values())[::-1]
    return parts.withColumns({"rule": deciding_rule(unique, host, path, lambda r: r.text), "ruled": deciding_rule(unique, host, path, lambda r: r.verdict)})


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(src, dst, n)``: links from host to other host, counted."""
    links = pages.select(host_of(F.col(url)).alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(HREF), F.lit(1))).alias("link"))
    target = F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), F.col("link"))).otherwise(F.col("link"))
    ends = links.select("src", host_of(target).alias("dst")).where("src <> dst and src <> '' and dst <> ''")
    return ends.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = 0.85, tolerance: float = 1e-3) -> DataFrame:
    """``(host, trust, distrust)`` from ``seeds (host, trust, distrust)`` and ``links``.

    Hosts with a seed above 0 keep it.  Scores only rise; ``left`` bounds what all rounds to
    come can add to all hosts together (a round gives on at most ``damping`` of the last
    one's rise), so rounds end when no host can move by more than ``tolerance``.  That falls
    by a fixed factor a job, so the rounds grow with the logarithm of the seeds' mass.
    """
    links = store(links, "host-links")
    out = links.groupBy(F.col("src").alias("s")).agg(F.sum("n").alias("out"))
    into = links.groupBy(F.col("dst").alias("d")).agg(F.sum("n").alias("into"))
    shares = links.join(out, F.col("src") == F.col("s")).join(into, F.col("dst") == F.col("d"))
    forward = shares.select(F.col("src").alias("giver"), F.col("dst").alias("taker"), (F.col("n") / F.col("out")).alias("t"), F.lit(0.0).alias("d"))
    backward = shares.select(F.col("dst").alias("giver"), F.col("src").alias("taker"), F.lit(0.0).alias("t"), (F.col("n") / F.col("into")).alias("d"))
    flows = store(forward.union(backward), "host-flows")
    ends = flows.select(F.col("taker").alias("host"), F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust"))
    own = seeds.select("host", "trust", "distrust").union(ends).groupBy("host").agg(F.max("trust").alias("trust"), F.max("distrust").alias("distrust"))
    own = store(own.withColumn("known", (F.col("trust") > 0) | (F.col("distrust") > 0)), "host-seeds")
    if flows.isEmpty():
        return own.drop("known")

    def advanced(scores: DataFrame) -> DataFrame:
        given = flows.join(scores, F.col("giver") == F.col("host"))
        given = given.select(F.col("taker").alias("host"), (F.col("t") * F.col("trust") * damping).alias("trust"), (F.col("d") * F.col("distrust") * damping).alias("distrust"), F.lit(False).alias("known"))
        known = F.max("known")
        value = lambda c: F.coalesce(F.when(known, F.max(F.when(F.col("known"), F.col(c)))).otherwise(F.sum(c)), F.lit(0.0)).alias(c)
        return own.union(given).groupBy("host").agg(value("trust"), value("distrust"))

    mass = own.agg(F.sum(F.col("trust") + F.col("distrust"))).first()[0] or 0.0
    scores, total, left = own.drop("known"), mass, mass / (1 - damping)
    while left > tolerance:
        nxt = scores
        for _ in range(ROUNDS):
            nxt = advanced(nxt)
        scores = store(nxt, "host-scores")
        was, total = total, scores.agg(F.sum(F.col("trust") + F.col("distrust"))).first()[0]
        fell = damping**ROUNDS
        left = min(left * fell, max(total - was, 0.0) * fell / (1 - fell))
    return scores


def url_filter(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", html: str = "html", threshold: float = 0.5, damping: float = 0.85) -> DataFrame:
    """``(page_id, host, path, rule, verdict, host_blocked)`` of every page."""
    slim = ruled(pages.select(F.col(key).alias(key), F.col(url).alias("url")), rules)
    share = lambda verdict: F.avg(F.when(F.col("ruled") == verdict, 1.0).otherwise(0.0))
    seeds = slim.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    scores = propagate(seeds, host_links(pages, url, html), damping)
    bad = scores.where((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))).select(F.col("host").alias("h"), F.lit(True).alias("bad"))
    judged = slim.join(bad, F.col("host") == F.col("h"), "left")
    blocked = F.coalesce("bad", F.lit(False))
    verdict = F.coalesce("ruled", F.when(blocked, "block").otherwise("allow"))
    return judged.select(key, "host", "path", "rule", verdict.alias("verdict"), blocked.alias("host_blocked"))
