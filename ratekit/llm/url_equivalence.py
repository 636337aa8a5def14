r"""URL filters by redirect equivalence.

URLs that lead to the same page are aliases: a page and the target of its
canonical link or its refresh, and a URL and the plain form that sites
redirect it to (no scheme, `www.`, default port, fragment, tracking
parameters or closing slash).  Distributed connected components over these edges
give the classes of aliases.  A URL is judged by its own rule if one fits
(the longest); else its class decides: allowed if some alias is
explicitly allowed, blocked if some alias is blocked and none allowed,
allowed if no rule fits any of them.

Rules are a parameter: (verdict, host, path), each fitting its host and all
subdomains where the path starts with the rule's.  They are matched as an
array literal, without a join.  Classes are found with joins on URLs and
pre-aggregated minima; a class may hold any share of the pages, its two
flags are aggregated before the shuffle and joined back.

Defined results: a null URL, or one without `://`, has empty host and path
and fits no rule; without aliases it is allowed.  Null html has no links;
repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import broadcast_if_small, packed
from .components import connected_components

#: (verdict, host, path)
Rule = tuple[str, str, str]

#: Query parameters that only track where a visitor came from.
TRACKING = ["utm_[a-z]+", "ref", "fbclid", "gclid"]

_CANONICAL = [r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)",
              r"(?is)<link\b[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)[^>]*\brel\s*=\s*[\"']?canonical\b"]
_REFRESH = [r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*?\burl\s*=\s*[\"']?([^\"'\s>]+)"]


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def plain_form(url: Column) -> Column:
    """The form that common redirects lead to; null where there is no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    tracking = "^(" + "|".join(TRACKING) + ")(=|$)"
    params = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(tracking))
    tail = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    return F.when(host != "", F.concat(F.lit("://"), host, path, tail))


def resolved(target: Column, url: Column) -> Column:
    """A link's target as a full URL, seen from the page at ``url``."""
    scheme = F.regexp_extract(url, r"^([^:/?#]*:)//", 1)
    site = F.regexp_extract(url, r"^([^:/?#]*://[^/?#]*)", 1)
    folder = F.regexp_replace(F.concat(F.lit("/"), F.regexp_replace(path_of(url), "^/", "")), "[^/]*$", "")
    return F.when(target.contains("://"), target) \
        .when(target.startswith("//"), F.concat(scheme, target)) \
        .when(target.startswith("/"), F.concat(site, target)) \
        .otherwise(F.concat(site, folder, target))


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Stored rows (a, b): URLs that are aliases of each other."""
    def link(patterns):
        return F.array(*[F.regexp_extract(F.coalesce(html, F.lit("")), p, 1) for p in patterns])

    targets = F.filter(F.concat(link(_CANONICAL), link(_REFRESH)), lambda t: t != "")
    own = pages.where(F.col(url).isNotNull()).select(F.col(url).alias("a"), targets.alias("targets"))
    led = own.select("a", F.explode("targets").alias("t")).select(
        "a", resolved(F.regexp_replace("t", "&amp;", "&"), F.col("a")).alias("b"))
    led = materialize(led.distinct(), "page-links")
    every = own.select("a").unionByName(led.select(F.col("b").alias("a")))
    plain = every.select("a", plain_form(F.col("a")).alias("b"))
    return materialize(led.unionByName(plain).where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(),
                       "alias-edges")


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule as struct (rule, verdict), or null; of equals an allow, then the first."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "allow"))
    if not ordered:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    every = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(h + p).alias("rule"),
                               F.lit(v).alias("verdict")) for v, h, p in ordered])
    fits = F.filter(every, lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"])))
                    & path.startswith(r["path"]))
    best = F.get(fits, 0)
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", html: str = "html") -> DataFrame:
    """``row`` (the page), host, path, rule, verdict, alias_of (least URL of its class)."""
    labels = connected_components(alias_edges(pages, url, html))
    own = labels.withColumn("r", rule_for(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"])
    classes = own.groupBy("component").agg(
        F.coalesce(F.bool_or(F.col("r") == "allow"), F.lit(False)).alias("allowed"),
        F.coalesce(F.bool_or(F.col("r") == "block"), F.lit(False)).alias("blocked"))
    said = materialize(labels.join(classes, "component").select(
        "node", "component", (F.col("blocked") & ~F.col("allowed")).alias("class_blocked")), "alias-classes")
    rows = packed(pages, url=url).withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rows = rows.withColumn("r", rule_for(F.col("host"), F.col("path"), rules))
    joined = rows.join(broadcast_if_small(said, 240), F.col("url") == F.col("node"), "left")
    by_class = F.when(F.coalesce("class_blocked", F.lit(False)), "block").otherwise("allow")
    return joined.select("row", "host", "path", F.col("r.rule").alias("rule"),
                         F.coalesce("r.verdict", by_class).alias("verdict"),
                         F.coalesce("component", "url").alias("alias_of"))


def keep_allowed(pages: DataFrame, rules: list[Rule], url: str = "url", html: str = "html") -> DataFrame:
    """The pages whose URL is not blocked, columns unchanged."""
    return judge(pages, rules, url, html).where("verdict = 'allow'").select("row.*")
