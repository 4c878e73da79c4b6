"""URL filter with redirect equivalence.

A rule allows or blocks the urls of its host and all its subdomains whose path starts with the rule's; the
longest rule that fits decides. Urls are aliases if redirects or canonical links connect them,
over any number of steps: connected components over such edges. A url no rule fits takes the
decision of its aliases: allow if a rule allows any of them, else block if a rule blocks any, else allow.
So an explicit allow, the url's own or an alias's, precedes a block that comes from aliases, and a url's own rule
precedes both.

Edges are read from the pages (``<link rel=canonical>`` and ``<meta http-equiv=refresh>``) and may be
given besides. Scheme, fragment and the case of the host do not tell urls apart. Null urls and those without
``://`` have empty host and path, no rule and no aliases: allow. Null html has no links. Rows
that repeat a url are judged alike; page ids are only carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from oreworks import scratch
from oreworks.llm.components import components


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query (fixed values).
RULES = (
    Rule("com", "/", True),
    Rule("example.com", "/en/", False),
    Rule("www.example.com", "/en/", True),
    Rule("net", "/es/", False),
    Rule("net", "/fr/", False),
)
AFTER_SCHEME = r"^[\s\S]*?://"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next of ``/ ? #``, A-Z in lower case; else empty."""
    host = F.regexp_extract(url, AFTER_SCHEME + r"([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, AFTER_SCHEME + r"[^/?#]*([^?#]*)", 1), F.lit(""))


def query_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, AFTER_SCHEME + r"[^?#]*(\?[^#]*)?", 1), F.lit(""))


def place_of(host: Column, path: Column, query: Column) -> Column:
    """What tells urls apart: host, path and query; null without host."""
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path), query))


def _placed(urls: DataFrame, column: str, name: str) -> DataFrame:
    """Add the place of a column of urls."""
    url = F.col(column)
    parts = urls.withColumns({"_h": host_of(url), "_p": path_of(url), "_q": query_of(url)})
    return parts.withColumn(name, place_of(F.col("_h"), F.col("_p"), F.col("_q"))).drop("_h", "_p", "_q")


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The text of the longest rule that fits, null without one; of equally long ones the first given."""
    fits = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), r.text)
        for r in sorted(rules, key=lambda r: -len(r.text))
    ]
    return F.coalesce(*fits, F.lit(None).cast("string"))


def verdict_of(rule: Column, rules: tuple[Rule, ...]) -> Column:
    return F.when(rule.isin([r.text for r in rules if r.allow]), "allow").when(rule.isin([r.text for r in rules if not r.allow]), "block")


def _resolved(link: Column, scheme: Column, host: Column, path: Column) -> Column:
    """``link`` as written on a page with this scheme, host and path, as an absolute url."""
    root, folder = F.concat(scheme, F.lit("://"), host), F.regexp_replace(path, r"[^/]*$", "")
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.rlike(r"^[?#]"), F.concat(root, path, link))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), link))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Edges (a, b) from a page's place to those that its canonical links and refreshes name."""
    spark = pages.sparkSession
    tags = F.regexp_extract_all("html", F.lit(r"(?i)<(?:link|meta)\s[^>]*>"), F.lit(0))
    # Most pages name no other: only those that do are taken apart.
    named = pages.where(F.col("html").rlike(r"(?i)<(?:link|meta)\s[^>]*(?:canonical|refresh)"))
    found = named.select("url", F.explode(tags).alias("tag")).where(F.col("tag").rlike("(?i)canonical|refresh"))
    found = scratch.stage(found, scratch.new_path(spark, "tags"))

    def value(name: str) -> Column:
        quoted = F.regexp_extract("tag", rf"""(?i)\b{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
        return F.trim(F.regexp_replace(quoted, r"""^["']|["']$""", ""))

    canonical = found.where(F.lower(value("rel")).rlike(r"(^|\s)canonical(\s|$)")).select("url", value("href").alias("link"))
    moved = F.regexp_extract(value("content"), r"(?i)^[\d.]+\s*[;,]\s*(?:url\s*=\s*)?['\"]?([^'\"]*)", 1)
    refresh = found.where(F.lower(value("http-equiv")) == "refresh").select("url", moved.alias("link"))
    links = scratch.stage(canonical.unionByName(refresh).where("link <> ''"), scratch.new_path(spark, "links"))
    url = F.col("url")
    links = links.withColumns({"scheme": F.regexp_extract(url, r"^([\s\S]*?)://", 1), "host": host_of(url), "path": path_of(url)})
    links = links.withColumn("target", _resolved(F.col("link"), F.col("scheme"), F.col("host"), F.col("path")))
    return _placed(_placed(links, "url", "a"), "target", "b").select("a", "b")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule (null without one) and verdict of each page. ``redirects`` may add edges
    with the columns ``from_url`` and ``to_url``."""
    spark = pages.sparkSession
    url = F.col("url")
    own = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), query_of(url).alias("query"))
    own = own.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    by_rule = verdict_of(F.col("rule"), rules)
    edges = page_links(pages)
    if redirects is not None:
        edges = edges.unionByName(_placed(_placed(redirects, "from_url", "a"), "to_url", "b").select("a", "b"))
    roots = components(edges, "aliases")
    if roots.isEmpty():
        return own.select("page_id", "host", "path", "rule", F.coalesce(by_rule, F.lit("allow")).alias("verdict"))
    host, path = F.regexp_extract("node", r"^[^/]*", 0), F.regexp_extract("node", r"^[^/]*([^?]*)", 1)
    decided = roots.select("root", verdict_of(rule_for(host, path, rules), rules).alias("v")).where("v is not null")
    decided = decided.groupBy("root").agg(F.min("v").alias("inherited"))  # allow comes before block
    named = scratch.stage(
        roots.join(decided, "root").select(F.col("node").alias("place"), "inherited"), scratch.new_path(spark, "aliases")
    )
    own = own.withColumn("place", place_of(F.col("host"), F.col("path"), F.col("query")))
    return own.join(named, "place", "left").select(
        "page_id", "host", "path", "rule", F.coalesce(by_rule, "inherited", F.lit("allow")).alias("verdict")
    )
