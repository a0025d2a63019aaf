"""URL filters by rules and by link-graph propagation, in DataFrame operations only.

A url that a rule fits gets the rule's verdict. All others are judged by their host: trust
spreads from the hosts whose pages the rules allow along the links between hosts, distrust from
the hosts whose pages they block against the links, both as personalised PageRank. A host is
blocked when its distrust reaches ``threshold`` and exceeds its trust.

A host's seed weights are the shares of its pages that rules allow and block. A link's weight
is the number of times its source links to its target; a page's links to its own host say
nothing and are left out. Weight that reaches a host without links stays there.

Links are counted before they are shuffled, and a round is two joins of the links with the
ranks and a sum for each host, written to the shared folder; the number of rounds is fixed,
and fewer are made once no rank changes by more than ``tolerance``. A hub's links are one row
for each host that it is linked with.

Defined results: a null url, or one without ``://``, has an empty host and path; no rule fits
it, it is in no graph, and it is allowed. A host without seeds, and that no seed reaches, is
allowed. Null html has no links. Of rules that fit equally long, the first in the list wins.
Rows that repeat a page are judged alike and count as pages each; a null page_id is returned
as it is. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthtide.llm.frames import ascii_lower, settle

DAMPING = 0.85
#: By then less than 1e-7 of the weight is still on its way.
ROUNDS = 100
TOLERANCE = 1e-9
THRESHOLD = 0.05

#: The host that an anchor of a page links to, if it names one.
LINK = r"(?i)<a\s(?:[^<>]*?\s)?href\s*=\s*[\"']?(?:[a-z][a-z0-9+.-]*:)?//([^\"'\s>/?#]+)"


@dataclass(frozen=True)
class Rule:
    """A verdict on the urls of a host and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("allow", "com"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://`` up to ``/ ? #``, lower-cased; then up to ``? #``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    return ascii_lower(host), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The place in ``rules`` of the longest rule that fits, else null."""
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].text), i))
    found = F.lit(None).cast("int")
    for i in reversed(order):
        r = rules[i]
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, i).otherwise(found)
    return found


def judged_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    page_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    threshold: float = THRESHOLD,
    **propagation,
) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(
        F.col(page_col).alias("page_id"), host.alias("host"), path.alias("path")
    ).withColumn("place", fitting_rule(F.col("host"), F.col("path"), rules))
    texts = F.array(*[F.lit(r.text) for r in rules])
    verdicts = F.array(*[F.lit(r.verdict) for r in rules])
    rows = rows.select(
        "page_id",
        "host",
        "path",
        F.get(texts, "place").alias("rule"),
        F.get(verdicts, "place").alias("ruled"),
    )
    links = host_links(pages, url_col, html_col)
    ranks = propagated(rows, links, **propagation)
    blocked = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    return rows.join(ranks, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """source, target, links: between different hosts."""
    host, _ = host_and_path(F.col(url_col).cast("string"))
    targets = F.regexp_extract_all(F.col(html_col).cast("string"), F.lit(LINK), 1)
    return (
        pages.select(host.alias("source"), F.explode(targets).alias("target"))
        .select("source", ascii_lower(F.col("target")).alias("target"))
        .where("source <> '' and target <> source")
        .groupBy("source", "target")
        .agg(F.count(F.lit(1)).alias("links"))
    )


def propagated(
    judged: DataFrame,
    links: DataFrame,
    damping: float = DAMPING,
    rounds: int = ROUNDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """host, trust, distrust. ``judged`` has host and ruled (allow, block or null)."""
    share = lambda verdict: F.avg(F.when(F.col("ruled") == verdict, 1.0).otherwise(0.0))
    seeds = (
        judged.where("host <> ''")
        .groupBy("host")
        .agg(share("allow").alias("trusted"), share("block").alias("blocked"))
    )
    links = settle(links)
    out = links.groupBy("source").agg(F.sum("links").alias("out"))
    into = links.groupBy("target").agg(F.sum("links").alias("into"))
    edges = settle(
        links.join(out, "source")
        .join(into, "target")
        .select(
            "source",
            "target",
            (F.col("links") / F.col("out")).alias("onward"),
            (F.col("links") / F.col("into")).alias("back"),
        )
    )
    named = links.select(F.col("source").alias("host")).union(links.select("target")).distinct()
    seeds = settle(
        seeds.join(named, "host", "full").select(
            "host",
            ((1 - damping) * F.coalesce("trusted", F.lit(0.0))).alias("seed_trust"),
            ((1 - damping) * F.coalesce("blocked", F.lit(0.0))).alias("seed_distrust"),
        )
    )
    ranks = seeds.select(
        "host", F.col("seed_trust").alias("trust"), F.col("seed_distrust").alias("distrust")
    )
    if links.isEmpty():
        return ranks
    for _ in range(rounds):
        onward = edges.join(ranks, edges["source"] == ranks["host"]).select(
            F.col("target").alias("host"),
            (F.col("trust") * F.col("onward")).alias("t"),
            F.lit(0.0).alias("d"),
        )
        back = edges.join(ranks, edges["target"] == ranks["host"]).select(
            F.col("source").alias("host"),
            F.lit(0.0).alias("t"),
            (F.col("distrust") * F.col("back")).alias("d"),
        )
        flows = onward.union(back).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        before = ranks.select(
            "host", F.col("trust").alias("old_trust"), F.col("distrust").alias("old_distrust")
        )
        new = (
            seeds.join(flows, "host", "left")
            .join(before, "host")
            .select(
                "host",
                (F.col("seed_trust") + damping * F.coalesce("t", F.lit(0.0))).alias("trust"),
                (F.col("seed_distrust") + damping * F.coalesce("d", F.lit(0.0))).alias("distrust"),
                "old_trust",
                "old_distrust",
            )
        )
        new = settle(new)
        change = F.greatest(
            F.abs(F.col("trust") - F.col("old_trust")),
            F.abs(F.col("distrust") - F.col("old_distrust")),
        )
        moved = new.agg(F.max(change)).first()[0]
        ranks = new.select("host", "trust", "distrust")
        if moved is None or moved <= tolerance:
            break
    return ranks
