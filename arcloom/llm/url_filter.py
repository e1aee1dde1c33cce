"""URL verdicts: rules first, else trust and distrust that spread over the host graph. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arcloom.storage import small_side, written

#: (verdict, host, path prefix) of the production rules.
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("block", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
ROUNDS = 12
DAMPING = 0.85
#: A host is blocked if its share of all distrust exceeds this many times the sum of its share of all trust and its share
#: of all pages, which is what a walk without seeds would give it.
THRESHOLD = 1.0
#: Scores count pages: a seed page brings 1. They are sums of doubles whose order may vary, rounded to so many digits each
#: round; how large the crawl is has no part in it.
DIGITS = 9

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or without it: empty."""
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.length(url))
    return F.when(F.coalesce(at, F.lit(0)) == 0, "").otherwise(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; null or without ``://``: empty."""
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.length(url))
    return F.when(F.coalesce(at, F.lit(0)) == 0, "").otherwise(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def apply_rules(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """``pages`` (with ``host`` and ``path``) and the longest rule that fits, as ``rule`` and ``by_rule``; else null.

    A rule fits its host and all subdomains where the path starts with the rule's. The longest rule text wins, then
    the smaller text, then ``block``.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]], r[0] == "block")):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return pages.withColumns({"rule": rule, "by_rule": verdict})


def host_edges(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``src, dst, links``: links of each host to another, from absolute and protocol-relative hrefs of the pages."""
    href = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""
    link = F.explode(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(href), F.lit(1)))
    found = pages.where("host <> ''").select(F.col("host").alias("src"), link.alias("link"))
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    return (
        found.select("src", host_of(full).alias("dst")).where("dst <> '' and dst <> src")
        .groupBy("src", "dst").agg(F.count("*").alias("links"))
    )


def spread(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """``host, score`` of personalised PageRank: ``edges`` (src, dst, links), ``seeds`` (host, weight; the scores have the same sum).

    A host's score goes to the hosts it links to, by their share of its links; a host without links returns it to
    the seeds. Each round is one join on the source and one aggregate by the target with partial sums; nothing is
    gathered by host. Hosts that no seed reaches have no row.
    """
    out_of = edges.groupBy("src").agg(F.sum("links").alias("total"))
    shares = written(edges.join(out_of, "src").select("src", "dst", (F.col("links") / F.col("total")).alias("share")), "shares")
    sources = small_side(written(shares.select(F.col("src").alias("host")).distinct(), "sources"))
    start = seeds.select("host", F.round("weight", DIGITS).alias("score"))
    score, total = start, start.agg(F.sum("score")).first()[0]
    if not total or shares.isEmpty():
        return start
    for _ in range(rounds):
        moved = score.join(shares, score["host"] == shares["src"]).select(
            F.col("dst").alias("host"), (damping * F.col("score") * F.col("share")).alias("score")
        )
        lost = score.join(sources, "host", "left_anti").agg(F.coalesce(F.sum("score"), F.lit(0.0))).first()[0]
        back = start.select("host", (F.col("score") * ((1 - damping) + damping * lost / total)).alias("score"))
        score = moved.unionByName(back).groupBy("host").agg(F.round(F.sum("score"), DIGITS).alias("score"))
        score = written(score, "scores")
    return score


def _seeds(hosts: DataFrame, count: str) -> DataFrame:
    return hosts.where(F.col(count) > 0).select("host", F.col(count).cast("double").alias("weight"))


def judge(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    rules: list[tuple[str, str, str]] = RULES, rounds: int = ROUNDS, damping: float = DAMPING, threshold: float = THRESHOLD,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every page.

    The longest fitting rule decides. For other pages the host decides: trust spreads from the hosts that have pages a
    rule allows, along their links; distrust spreads against the links (a host that links to blocked hosts is
    suspect) from the hosts that have pages a rule blocks; either by the number of such pages. A host is blocked if its share
    of the distrust exceeds ``threshold`` times its share of the trust plus its share of the pages, so a large host
    needs more than a small one. A page without a host is allowed. Rows may repeat; null urls and pages count as
    empty; an empty table gives no rows.

    Host counts use partial sums, so a host with a third of all pages is one row per task; the scores (one row
    per host) join the pages by broadcast if they are few, else by a join that adaptive execution splits.
    """
    url = F.col(url_col).cast("string")
    named = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), F.col(html_col).alias("html"))
    ruled = apply_rules(named, rules)
    hosts = written(
        ruled.where("host <> ''").groupBy("host").agg(
            F.count("*").alias("pages"), F.count_if(F.col("by_rule") == "allow").alias("good"), F.count_if(F.col("by_rule") == "block").alias("bad"),
        ),
        "hosts",
    )
    edges = written(host_edges(named), "host-edges")
    trust = spread(edges, _seeds(hosts, "good"), rounds, damping)
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    distrust = spread(back, _seeds(hosts, "bad"), rounds, damping)
    scores = (
        hosts.select("host", "pages").join(trust.withColumnRenamed("score", "trust"), "host", "left")
        .join(distrust.withColumnRenamed("score", "distrust"), "host", "left").na.fill(0.0)
    )
    scores = small_side(written(scores, "host-scores"))
    sums = hosts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pages", "good", "bad"))).first()
    share = lambda c, n: F.col(c) / float(sums[n] or 1)
    own = F.when(share("distrust", "bad") > threshold * (share("trust", "good") + share("pages", "pages")), "block").otherwise("allow")
    return ruled.drop("html").join(scores, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", own).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
