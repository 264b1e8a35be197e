"""URL filters: host and path rules, then a listed-URL check.

A blocked Bloom filter of the listed canonical URLs passes possible hits; an
exact hash join against the list removes the false positives. Both steps are
DataFrame operations. The filter has a fixed size bound, so it is broadcast;
the list itself is never broadcast or collected.

Defined results: a null url, or one without ``://``, has an empty host and
path, no canonical form and is never listed; repeated rows are judged row by
row; an empty list lists nothing; extra columns are ignored unless named in
``keep``, where one named like a result column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandops.llm.common import aside, bloom_blocks, bloom_build, bloom_probe

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path); a rule is written ``host`` + ``path``.
Rule = tuple[str, str, str]
#: Query parameters that don't change the page a URL names.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"
#: Salts of the exact join: one listed URL may be named by a third of the rows.
SALTS = 16


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_of(url: Column) -> Column:
    """Host without ``www.`` or a port, path without trailing slashes, query
    without tracking parameters; no scheme, no fragment. Null without ``://``."""
    rest = _rest(url)
    host = F.regexp_replace(F.regexp_replace(host_of(url), ":[0-9]*$", ""), "^www[.]", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.regexp_extract(rest, "^[^?#]*[?]([^#]*)", 1)
    query = F.regexp_replace(query, f"(^|&)({TRACKING})=[^&]*", "")
    query = F.regexp_replace(query, "^&+", "")
    return F.when(rest.isNotNull(), F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query))
                                             .otherwise(F.lit(""))))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest rule that fits, else nulls. The
    rule list is a parameter of some tens of entries, tried longest first."""
    name = verdict = F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(act)).otherwise(verdict)
    return name, verdict


def listed_flag(df: DataFrame, listing: DataFrame, key: str, flag: str = "listed") -> DataFrame:
    """``df`` with ``flag``: is the canonical URL in column ``key`` in
    ``listing`` (one column ``key``)? Rows that the Bloom filter refuses never
    reach the exact join; confirmed URLs are joined over ``SALTS`` salts."""
    keys = listing.select(key).filter(F.col(key).isNotNull()).distinct()
    blocks = bloom_blocks(keys.count())
    bloom = bloom_build(keys, [key], blocks)
    probed = bloom_probe(df, bloom, [key], blocks, "_possible")
    possible = probed.filter("_possible").drop("_possible")
    confirmed = possible.select(key).distinct().join(keys, key, "left_semi")
    salted = confirmed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))) \
        .withColumn(flag, F.lit(True))
    hit = (possible.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in possible.columns]),
                                               F.lit(SALTS)).cast("int"))
           .join(salted, [key, "_salt"], "left").drop("_salt")
           .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))
    missed = probed.filter(~F.col("_possible")).drop("_possible").withColumn(flag, F.lit(False))
    return hit.unionByName(missed)


def filter_urls(pages: DataFrame, listing: DataFrame, rules: Sequence[Rule], url: str = "url",
                keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Judge every row of ``pages``: ``keep`` columns, host, path, canonical,
    rule, listed, verdict (the longest fitting rule's, else ``block`` for a
    listed URL and ``allow`` for any other). ``listing``: one column of URLs."""
    u = F.col(f"`{url}`")
    results = ["host", "path", "canonical", "listed", "rule", "verdict"]
    kept, back = aside(keep, results)
    judged = pages.select(*kept, host_of(u).alias("host"),
                          path_of(u).alias("path"), canonical_of(u).alias("canonical"))
    listed = listing.select(canonical_of(F.col(listing.columns[0])).alias("canonical"))
    rule, act = matching_rule(F.col("host"), F.col("path"), rules)
    return (listed_flag(judged, listed, "canonical")
            .withColumn("rule", rule)
            .withColumn("verdict", F.coalesce(act, F.when(F.col("listed"), F.lit("block"))
                                              .otherwise(F.lit("allow"))))
            .select(*back, *results))
