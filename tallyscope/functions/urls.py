"""Host names and registered domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.exprs import _col

IPV4 = r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"


def url_host(url) -> Column:
    """Network location of a URL, with user info and port; '' when there is none."""
    return F.coalesce(F.try_parse_url(_col(url), F.lit("AUTHORITY")), F.lit(""))


def bare_host(host) -> Column:
    """Lower-case host name without user info, port and closing dot."""
    return F.regexp_replace(F.lower(_col(host)), r"^.*@|:[0-9]*$|\.$", "")


def with_domain(df: DataFrame, suffixes: DataFrame, host: str = "host", out: str = "domain") -> DataFrame:
    """Add the registered domain of ``host``: one label, a dot and the longest public suffix.

    ``suffixes`` has one column, ``suffix``, with rules of three kinds: a suffix; ``*.`` and a suffix, under which every
    label makes a suffix; ``!`` and a name that such a rule does not make a suffix. Each distinct host is cut into its
    possible suffixes, those are joined with the rules in all three spellings, and an exception or else the longest match
    wins. Without a match the last label stands before an empty suffix; an IPv4 address is its own label.
    """
    hosts = df.select(F.col(host)).distinct().select(host, bare_host(host).alias("_name"))
    parts = F.split("_name", r"\.")
    candidates = hosts.filter(~F.col("_name").rlike(IPV4)).select(
        host,
        F.posexplode(
            F.transform(parts, lambda _, i: F.array_join(F.slice(parts, i + 1, F.size(parts) - i), "."))
        ).alias("_at", "suffix"),
    )
    at, name = F.col("_at"), F.col("suffix")
    below = F.regexp_replace(name, r"^[^.]*\.", "")
    spelled = [
        F.struct(name.alias("rule"), at.alias("from"), F.lit(False).alias("excepts")),
        F.when(F.locate(".", name) > 0, F.struct(F.concat(F.lit("*."), below).alias("rule"), at.alias("from"), F.lit(False).alias("excepts"))),
        F.struct(F.concat(F.lit("!"), name).alias("rule"), (at + 1).alias("from"), F.lit(True).alias("excepts")),
    ]
    longest = (
        candidates.select(host, F.inline(F.array_compact(F.array(*spelled))))
        .join(suffixes.select(F.col("suffix").alias("rule")).distinct(), "rule")
        .groupBy(host)
        .agg(F.coalesce(F.min(F.when(F.col("excepts"), F.col("from"))), F.min("from")).alias("_at"))
    )
    at = F.coalesce(F.col("_at"), F.size(parts))
    label = F.when(at > 0, F.get(parts, at - 1)).otherwise(F.lit(""))
    suffix = F.array_join(F.slice(parts, at + 1, F.size(parts) - at), ".")
    resolved = hosts.join(longest, host, "left").select(
        host,
        F.when(F.col("_name").rlike(IPV4), F.concat("_name", F.lit(".")))
        .otherwise(F.concat(label, F.lit("."), suffix))
        .alias(out),
    )
    return df.join(resolved, host, "left").select(*df.columns, out)


def domain_label(domain) -> Column:
    """The label in front of the public suffix."""
    d = _col(domain)
    address = F.regexp_replace(d, r"\.$", "")
    return F.when(address.rlike(IPV4), address).otherwise(F.substring_index(d, ".", 1))
