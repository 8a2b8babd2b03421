"""URL filters: rules first, then trust and distrust spread over the links between hosts."""

from __future__ import annotations

from itertools import count
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.lineage import cut_lineage
from tallyscope.functions.urls import IPV4, with_domain

#: (rule, verdict): a host and its subdomains, and the beginning of a path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Targets of links in html: attribute values of href, quoted or not.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*([^\s"'<>]+)"""
#: Longest name of a host that can be looked up; longer ones have no place in the graph.
LONGEST = 253
#: Labels below a country code under which names are registered, as in co.uk; used where no list of suffixes is given.
REGISTRIES = ("ac", "co", "com", "edu", "go", "gov", "ne", "net", "nom", "or", "org")
#: Steps of the walk that one task takes: ranks are spread by as few tasks as the graph needs.
STEPS_PER_TASK = 500_000


def after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://`` or for null."""
    host = F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def target_of(link: Column) -> Column:
    """The host a link leads to; a link like ``//host/path`` has the scheme of its page."""
    return F.when(link.startswith("//"), host_of(F.concat(F.lit("page:"), link))).otherwise(host_of(link))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if none does."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: len(r[0])):  # longer ones override shorter ones
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{rest}")
        found, verdict = F.when(fits, F.lit(rule)).otherwise(found), F.when(fits, F.lit(says)).otherwise(verdict)
    return found, verdict


def site_size(host: Column) -> Column:
    """Number of labels of the site that a host belongs to: one more than its public suffix has."""
    labels = F.split(host, r"\.")
    below_country = (F.length(F.element_at(labels, -1)) == 2) & F.get(labels, F.size(labels) - 2).isin(*REGISTRIES)
    return F.when(below_country, 3).otherwise(2)


def host_edges(pages: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """(src, dst, weight) between different hosts, from (host, html).

    A link to another host counts once per page and target. Besides, a host and the domain above it stand for each other
    with weight 1, up to the site, which is the registered domain: the hosts of a site share an owner, and sites that no
    other site links to have their standing from there. Sites below one public suffix are strangers. ``suffixes`` (suffix)
    are the public suffixes, as for ``urls.with_domain``; without them, a suffix is the last label, or the last two where
    these are one of REGISTRIES and a country code. IPv4 addresses stand for themselves. Links are counted within each
    task before they are shuffled.
    """
    usable = lambda name: (F.col(name) != "") & (F.length(name) <= LONGEST)
    links = (
        pages.filter(usable("host"))
        .select(F.col("host").alias("src"), F.explode(F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), target_of))).alias("dst"))
        .filter(usable("dst") & (F.col("src") != F.col("dst")))
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("weight"))
    )
    links = cut_lineage(links)
    named = pages.select("host").filter(usable("host")).unionByName(links.select(F.col("dst").alias("host"))).distinct()
    if suffixes is None:
        sited = named.withColumn("least", site_size(F.col("host")))
    else:
        domain = F.split(F.regexp_replace("domain", r"\.$", ""), r"\.")
        sited = with_domain(named, suffixes).select("host", F.size(domain).alias("least"))
    labels = F.split("host", r"\.")
    part = lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    up = F.transform(F.sequence(F.lit(1), F.size(labels) - F.col("least")), lambda k: F.struct(part(k).alias("src"), part(k + 1).alias("dst")))
    inner = sited.filter((F.size(labels) > F.col("least")) & ~F.col("host").rlike(IPV4))
    above = inner.select(F.explode(up).alias("e")).select("e.src", "e.dst").distinct()
    kin = above.unionByName(above.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("weight", F.lit(1.0))
    return links.unionByName(kin).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def spread_seeds(
    edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int | None = 16, every: int = 4, tolerance: float = 1e-8
) -> DataFrame:
    """(kind, host, rank) of personalised PageRank over ``edges`` (kind, src, dst, weight) from ``seeds`` (kind, host, mass).

    The walks of all kinds run together, each restarting at its own seeds in proportion to their masses; ranks of a kind
    sum to 1. What reaches a host without outgoing edges restarts, too: since that only scales the result, it is left out
    of the rounds and made good by the final scaling. A round is one join and one sum over hosts and edges; a table is
    written every few rounds, so neither the plan nor the work lost with an executor grows. A round runs in one task per
    STEPS_PER_TASK steps of the graph, however many files the tables have; a graph that fits one task needs no shuffle of its steps.

    ``rounds=None`` goes on until no rank grows by more than its ``tolerance``-th part from one written table to the next.
    Once that holds for a round it holds for all later ones: what a host gains comes from its neighbours' last gains, in the proportion in which
    its rank came from their ranks. A host that is first reached gains its whole rank, so all that seeds lead to are reached.
    """
    out = edges.groupBy("kind", "src").agg(F.sum("weight").alias("out"))
    steps = cut_lineage(edges.join(out, ["kind", "src"]).select("kind", "src", "dst", (damping * F.col("weight") / F.col("out")).alias("part")))
    total = seeds.groupBy("kind").agg(F.sum("mass").alias("total"))
    start = cut_lineage(seeds.join(total, "kind").select("kind", "host", ((1 - damping) * F.col("mass") / F.col("total")).alias("rank")))
    tasks = max(1, ceil(steps.count() / STEPS_PER_TASK))
    steps, start = steps.coalesce(tasks), start.coalesce(tasks)
    rank = written = start
    for k in count(1) if rounds is None else range(1, rounds + 1):
        moved = steps.join(rank.withColumnRenamed("host", "src"), ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), (F.col("rank") * F.col("part")).alias("rank")
        )
        rank = moved.unionByName(start).coalesce(tasks).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if k % every == 0:
            before, rank = written, cut_lineage(rank).coalesce(tasks)
            written = rank
            was = before.withColumnRenamed("rank", "was")
            grows = F.col("rank") - F.coalesce("was", F.lit(0.0)) > tolerance * F.col("rank")
            if rounds is None and rank.join(was, ["kind", "host"], "left").filter(grows).isEmpty():
                break
    whole = rank.groupBy("kind").agg(F.sum("rank").alias("whole"))
    return rank.join(whole, "kind").select("kind", "host", (F.col("rank") / F.col("whole")).alias("rank"))


def judge(
    pages: DataFrame, rules=RULES, factor: float = 1.0, share: float = 1e-6, suffixes: DataFrame | None = None, **options
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every row of ``pages`` (page_id, url, html, …).

    The longest rule that fits a url decides. Elsewhere the host does: trust spreads along links from hosts with pages
    that a rule allows, distrust against the links from hosts with pages that a rule blocks, both in proportion to the
    number of these pages, and a host is blocked if its distrust exceeds ``factor`` times its trust by more than ``share`` of
    their sum, which is above the error of ranks and of summation however small both are. ``options`` are those of
    ``spread_seeds``; with ``rounds=None`` it runs to the end. ``suffixes`` are the public suffixes for ``host_edges``. Hosts
    that neither reaches are allowed. Null urls and urls without ``://`` have an empty host and path, no place in the graph,
    and are allowed. Null html has no links. Other columns are ignored.
    """
    at = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    ruled = at.withColumn("rule", rule).withColumn("ruled", verdict)
    edges = cut_lineage(host_edges(at.select("host", "html"), suffixes))
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    kind = F.when(F.col("ruled") == "allow", "trust").otherwise("distrust")
    seeds = ruled.filter("ruled is not null").groupBy(kind.alias("kind"), "host").agg(F.count("*").cast("double").alias("mass"))
    ranks = spread_seeds(both, seeds, **options).groupBy("host").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("rank"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")]
    )
    ranks = cut_lineage(ranks)
    blocked = F.col("distrust") - factor * F.col("trust") > share * (F.col("distrust") + factor * F.col("trust"))
    return (
        ruled.select("page_id", "host", "path", "rule", "ruled")
        .join(ranks, "host", "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("ruled", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
            F.coalesce("trust", F.lit(0.0)).alias("trust"),
            F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
        )
    )
