"""URL verdicts from rules and, where no rule fits, from trust and distrust over links between hosts.

Rules judge a url by its host and path. They also make hosts seeds: a host is trusted by the share
of its ruled pages that are allowed, and distrusted by the share that are blocked. Trust spreads along
links: a host shares it among the hosts it links to. Distrust spreads against them: a host shares it
among the hosts that link to it. Both are personalised PageRanks, and a host is blocked if
distrust is more than ``threshold`` of the two together; a host that neither reaches is allowed.

All of it is DataFrame work. A link between two hosts is one row however many pages make it; both
ranks are one table whose rounds are written, so a round costs a join and a sum over the edges. A round passes
on only what arrived in the one before. Rounds go on until no host is reached for the first time and none
gains more than ``TOLERANCE`` of its rank: on links without cycles until the longest path ends, else some 85 rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import discard, lower_ascii, materialise

DAMPING = 0.85
#: The gain in a round, as a share of a host's rank, below which ranks are done.
TOLERANCE = 1e-6
#: More rounds than this are an error.
ROUNDS = 5000
THRESHOLD = 0.5
LOCATION = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: The host of an absolute link in an anchor; no anchor reaches over the next tag.
LINK = r"""(?i)<a\s[^<>]*?\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""

#: host, path, verdict
Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a NULL url or one without ``://``."""
    known = F.coalesce(url.cast("string"), F.lit(""))
    return lower_ascii(F.regexp_extract(known, LOCATION, 1)), F.regexp_extract(known, LOCATION, 2)


def rule_of(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, as its string, and its verdict; NULL if none does. ``rules`` become part
    of the plan, so they are for hundreds, not for millions."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]) - len(r[1]), -len(r[0]), r))
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in reversed(ordered):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        found = F.when(fits, F.lit(rule_host + rule_path)).otherwise(found)
        verdict = F.when(fits, F.lit(rule_verdict)).otherwise(verdict)
    return found, verdict


def judged_by_rules(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row."""
    host, path = host_and_path(F.col(url_col))
    located = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(rules, F.col("host"), F.col("path"))
    return located.select("*", rule.alias("rule"), verdict.alias("verdict"))


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``src``, ``dst``: each pair of different hosts of which a page of the one links to the other, once."""
    host, _ = host_and_path(F.col(url_col))
    linked = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(LINK), F.lit(1)))
    links = pages.select(host.alias("src"), F.explode(linked).alias("dst"))
    return links.select("src", lower_ascii(F.col("dst")).alias("dst")).filter("src != '' AND src != dst").distinct()


class NotConverged(RuntimeError):
    """Ranks still changed after the last round allowed."""


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> DataFrame:
    """``host, trust, distrust`` of all hosts that either reaches, from ``seeds`` (``host, trust, distrust``).

    Raises :class:`NotConverged` if ``rounds`` do not end it.
    """
    both = materialise(
        edges.select(F.lit(True).alias("good"), F.col("src").alias("giver"), F.col("dst").alias("taker")).union(
            edges.select(F.lit(False), "dst", "src")
        ),
        "edges",
    )
    degree = both.groupBy("good", "giver").agg(F.count("*").alias("degree"))
    shares = materialise(both.join(degree, ["good", "giver"]).select("good", "giver", "taker", (1.0 / F.col("degree")).alias("share")), "shares")
    good = seeds.select(F.lit(True).alias("good"), "host", ((1 - damping) * F.col("trust")).alias("rank"))
    bad = seeds.select(F.lit(False).alias("good"), "host", ((1 - damping) * F.col("distrust")).alias("rank"))
    now = materialise(good.union(bad).filter("rank > 0").withColumn("gain", F.col("rank")), "ranks")
    left = now.limit(1).count()
    for _ in range(rounds):
        if not left or left <= tolerance:
            break
        givers = now.filter("gain > 0").select("good", F.col("host").alias("giver"), "gain")
        arrived = givers.join(shares, ["good", "giver"]).select(
            "good", F.col("taker").alias("host"), F.lit(0.0).alias("rank"), (damping * F.col("gain") * F.col("share")).alias("gain")
        )
        parts = arrived.union(now.select("good", "host", "rank", F.lit(0.0)))
        sums = parts.groupBy("good", "host").agg(F.sum("rank").alias("rank"), F.sum("gain").alias("gain"))
        after = materialise(sums.select("good", "host", (F.col("rank") + F.col("gain")).alias("rank"), "gain"), "ranks")
        discard(now)
        now, left = after, after.filter("gain > 0").agg(F.max(F.col("gain") / F.col("rank"))).first()[0]
    else:
        raise NotConverged(f"a host still gains {left} of its rank after {rounds} rounds")
    part = {name: F.sum(F.when(F.col("good") == value, F.col("rank")).otherwise(0.0)) for name, value in (("trust", True), ("distrust", False))}
    return now.groupBy("host").agg(*[c.alias(n) for n, c in part.items()])


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    threshold: float = THRESHOLD,
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
    rounds: int = ROUNDS,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` per row; ``verdict`` is allow or block.

    A url that is NULL or has no ``://`` has empty host and path and is allowed unless a rule says
    otherwise. NULL html has no links. Repeated rows are judged alike, and count each as a seed's
    page. Other columns are not read.
    """
    ruled = judged_by_rules(pages, rules, id_col, url_col)
    allowed, blocked = (F.sum(F.when(F.col("verdict") == v, 1).otherwise(0)) for v in ("allow", "block"))
    hosts = ruled.filter("host != '' AND verdict IS NOT NULL").groupBy("host").agg(allowed.alias("a"), blocked.alias("b"))
    total = F.col("a") + F.col("b")
    seeds = hosts.select("host", (F.col("a") / total).alias("trust"), (F.col("b") / total).alias("distrust"))
    ranks = spread(host_links(pages, url_col, html_col), seeds, damping, tolerance, rounds)
    joined = ruled.join(ranks, "host", "left")
    bad = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    verdict = F.coalesce("verdict", F.when(bad, "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")
