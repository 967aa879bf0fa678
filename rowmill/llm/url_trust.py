"""URL filters: rules first, then trust and distrust over the graph of host links.

A rule (verdict, host, path) fits a url whose host is the rule's or a subdomain of it and whose path starts
with the rule's; the longest rule wins (of equal ones, block). Hosts whose pages are mostly allowed or mostly
blocked by rules are seeds. Trust flows along links from trusted seeds (personalised PageRank), distrust
against them from blocked seeds, so a host that links to blocked hosts shares their distrust:

    trust(h)    = seed(h) + damping * sum of trust(g) / links of g     over g that link to h
    distrust(h) = seed(h) + damping * sum of distrust(g) / links to g  over g that h links to

Rounds go on until no score changes by TOLERANCE. Scores are not divided by the number of seeds, so thresholds
mean the same at every size. A page without a rule is blocked if its host's distrust exceeds its trust by
`threshold`.

Links of a page's html count once per pair of hosts. The links of a host with more than EDGES_A_PART are spread
over parts by their other end, and only the scores of such hosts are sent more than once; the tables of scores
and edges are written.

Defined cases: NULL urls and those without `://` have empty host and path and are allowed, unless a rule
fits them; NULL html has no links; equal rows give equal rows; without seeds or links only rules decide;
an empty table gives an empty result. Input columns other than the result's are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.common import UPPER
from rowmill.plans.storage import materialise

# Verdict, host, path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DAMPING = 0.85
THRESHOLD = 0.05
ROUNDS = 100  # of the SQL beside the query, which has no test for an end; 0.85^100 is below TOLERANCE
TOLERANCE = 1e-6
MOST_ROUNDS = 1000  # 0.85^1000 is below any tolerance, so more are an error
DIGITS = 9  # scores are compared at so many digits, as sums depend on the order of their terms
SALTS = 64  # most parts of a host's links
EDGES_A_PART = 10_000

LINK = r"(?:[Hh][Rr][Ee][Ff]|[Ss][Rr][Cc])\s*=\s*[\"']?\s*(?:[Hh][Tt][Tt][Pp][Ss]?:)?//([^/?#\"'\s<>]+)"


def lower_host(host: Column) -> Column:
    return F.translate(host, UPPER, UPPER.lower())


def host_of(url: Column) -> Column:
    return F.coalesce(lower_host(F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: tuple[tuple[str, str, str], ...]) -> Column:
    """Struct (size, verdict, rule) of the longest rule that fits columns host and path, else NULL."""
    if not rules:
        return F.lit(None).cast("struct<size:int,verdict:string,rule:string>")
    listed = F.array(
        *[
            F.struct(
                F.lit(len(host + path)).alias("size"), F.lit(verdict).alias("verdict"),
                F.lit(host + path).alias("rule"), F.lit(host).alias("host"), F.lit(path).alias("path"),
            )
            for verdict, host, path in rules
        ]
    )
    fits = lambda r: (
        ((F.col("host") == r["host"]) | F.endswith("host", F.concat(F.lit("."), r["host"])))
        & F.startswith("path", r["path"])
    )
    return F.array_max(F.filter(listed, fits))


def host_edges(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Distinct (a, b), a links to b, of different hosts."""
    links = pages.select(
        host_of(F.col(url)).alias("a"), F.explode(F.regexp_extract_all(html, F.lit(LINK), 1)).alias("b")
    )
    links = links.select("a", lower_host(F.col("b")).alias("b"))
    return links.where("a <> '' AND b <> '' AND a <> b").distinct()


def propagated(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """(host, score): seeds (host) keep 1, and scores flow from `a` to `b`, shared among a's edges."""
    parts = F.least(F.ceil(F.count("*") / EDGES_A_PART), F.lit(SALTS).cast("long")).cast("int")
    shares = materialise(edges.groupBy("a").agg(F.count("*").alias("n"), parts.alias("parts")))
    # Only hosts of many links are split; the place of a link among the parts is found once for all rounds.
    salt = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("salt")
    edges = materialise(edges.join(shares, "a").select("a", "b", salt))
    seeds = seeds.select("host", F.lit(1.0).alias("score"))
    scores = materialise(seeds)
    for _ in range(MOST_ROUNDS):
        sent = scores.join(shares, scores["host"] == shares["a"]).select(
            "a", (DAMPING * F.col("score") / F.col("n")).alias("score"),
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"),
        )
        came = edges.join(sent, ["a", "salt"]).select(F.col("b").alias("host"), "score")
        new = seeds.union(came).groupBy("host").agg(F.sum("score").alias("score"))
        old = scores.withColumnRenamed("score", "old")
        new = materialise(new.join(old, "host", "left"))
        scores = new.select("host", "score")
        change = new.agg(F.max(F.abs(F.col("score") - F.coalesce("old", F.lit(0.0))))).first()[0]
        if (change or 0.0) < TOLERANCE:
            return scores
    raise RuntimeError(f"scores still change by {change} after {MOST_ROUNDS} rounds")


def judge(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    rules: tuple[tuple[str, str, str], ...] = RULES, threshold: float = THRESHOLD,
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page."""
    judged = pages.select(
        F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    ).withColumn("found", longest_rule(rules))
    judged = judged.select("page_id", "host", "path", "found.rule", F.col("found.verdict").alias("ruled"))
    edges = materialise(host_edges(pages, url, html))

    half = F.count("*") / 2
    hosts = judged.where("host <> ''").groupBy("host").agg(
        (F.count_if(F.col("ruled") == "allow") > half).alias("trusted"),
        (F.count_if(F.col("ruled") == "block") > half).alias("blocked"),
    )
    hosts = materialise(hosts)
    trust = propagated(hosts.where("trusted"), edges)
    distrust = propagated(hosts.where("blocked"), edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rounded = lambda c: F.round(F.coalesce(c, F.lit(0.0)), DIGITS)
    scores = (
        hosts.select("host")
        .join(trust.withColumnRenamed("score", "trust"), "host", "left")
        .join(distrust.withColumnRenamed("score", "distrust"), "host", "left")
        .select("host", rounded("trust").alias("trust"), rounded("distrust").alias("distrust"))
    )
    # Written, so that both sides of the next join are plain shuffles and a hot host can be split.
    out = judged.join(materialise(scores), "host", "left")
    spread = F.coalesce(F.col("distrust") - F.col("trust") >= threshold, F.lit(False))
    return out.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(spread, "block").otherwise("allow")).alias("verdict"),
        rounded("trust").alias("trust"), rounded("distrust").alias("distrust"),
    )
