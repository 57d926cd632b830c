"""URL filter: rules by host and path, block decisions carried along redirects and canonical links."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.once import literal_rows
from reviewmill.llm.common import components, stored

#: Rules up to this many are sent to all tasks; longer lists are joined by host.
BROADCAST_RULES = 10_000


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


# The rules of the production query.
RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
)
# Tags that make two addresses one: canonical links and refresh redirects, attributes in any order.
CANONICAL = r"""(?is)<link\s[^>]*rel\s*=\s*["']?canonical["'\s/>][^>]*"""
REFRESH = r"""(?is)<meta\s[^>]*http-equiv\s*=\s*["']?refresh["'\s/>][^>]*"""
HREF = r"""(?is)\shref\s*=\s*["']?([^"'\s>]+)"""
TARGET = r"""(?is)\scontent\s*=\s*["']?\s*[0-9.]*\s*[;,]\s*url\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """Host after the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or end; empty if there is no ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def address(url: Column) -> Column:
    """Node of a url: host, path and query without scheme and fragment; null if there is no host."""
    host = host_of(url)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(host != "", F.concat(host, rest))


def without_dots(path: Column) -> Column:
    """A path that begins with a slash, its ``.`` and ``..`` segments resolved; none leads above the root."""
    segments = F.slice(F.split(path, "/", -1), 2, F.size(F.split(path, "/", -1)))
    walked = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda kept, s: F.when(s == ".", kept).when(s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.array_append(kept, s)))
    ended = F.when(path.rlike(r"(?s)/\.\.?\z"), F.array_append(walked, F.lit(""))).otherwise(walked)
    return F.when(path.rlike(r"(?s)/\.\.?(?:/|\z)"), F.concat(F.lit("/"), F.array_join(ended, "/"))).otherwise(path)


def resolved(base: Column, link: Column) -> Column:
    """Absolute form of a link found on the page ``base``. Links with a host are taken as written, as urls of pages are."""
    root = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*", 0)
    page = F.regexp_extract(base, r"(?s)^.*?://[^?#]*", 0)
    folder = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*((?:[^?#]*/)?)", 1)
    path, tail = F.regexp_extract(link, r"(?s)^[^?#]*", 0), F.regexp_extract(link, r"(?s)^[^?#]*(.*)", 1)
    merged = F.when(path.startswith("/"), path).when(folder == "", F.concat(F.lit("/"), path)).otherwise(F.concat(folder, path))
    return (F.when(link == "", None).when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.startswith("//"), F.concat(F.lit("http:"), link))
            .when(link.startswith("#"), base)
            .when(link.startswith("?"), F.concat(page, link))
            .otherwise(F.concat(root, without_dots(merged), tail)))


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges ``a, b`` between a page and what its canonical link or refresh redirect names."""
    html, url = F.coalesce(F.col(html_col), F.lit("")), F.col(url_col)
    tags = F.concat(F.regexp_extract_all(html, F.lit(CANONICAL), F.lit(0)), F.regexp_extract_all(html, F.lit(REFRESH), F.lit(0)))
    # Pages without either tag name never reach the patterns.
    marked = pages.filter(html.rlike("(?i)canonical|http-equiv")).select(url.alias("url"), F.explode(tags).alias("tag"))
    link = F.replace(F.when(F.col("tag").rlike("(?i)^<link"), F.regexp_extract("tag", HREF, 1)).otherwise(F.regexp_extract("tag", TARGET, 1)), F.lit("&amp;"), F.lit("&"))
    return marked.select(address(F.col("url")).alias("a"), address(resolved(F.col("url"), link)).alias("b")) \
        .filter("a is not null and b is not null and a <> b").distinct()


def matched(urls: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``address, rule, verdict`` of every distinct ``address, host, path`` that a rule fits; the longest rule wins.

    A rule fits its host and all subdomains: every suffix of the host is looked up.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    names = list(zip(*rules))
    table = literal_rows(urls, rule_verdict=names[0], rule_host=names[1], rule_path=names[2])
    if len(rules) <= BROADCAST_RULES:
        table = F.broadcast(table)
    hits = urls.filter("host <> ''").select("address", "path", F.explode(suffixes).alias("suffix")) \
        .join(table, F.col("suffix") == F.col("rule_host")).filter(F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = hits.groupBy("address").agg(F.max(F.struct(F.length(rule), rule.alias("rule"), F.col("rule_verdict").alias("verdict"))).alias("best"))
    return best.select("address", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, host, path, rule, verdict`` of every row of ``pages``.

    The page's own rule decides, so an explicit allow is never overruled. A page
    without one is blocked if any address that redirects or canonical links tie to
    it, over any number of steps and through pages that are allowed, is blocked by
    a rule; addresses that are only linked to count too. All others are allowed.

    A url that is null or has no ``://`` has an empty host and path, no rule and
    verdict allow; a null page has no links. Repeated rows are returned as often
    as they occur; extra columns are not carried; an empty table gives no rows.
    """
    url = F.col(url_col)
    rows = stored(pages.select(F.col(id_col), address(url).alias("address"), host_of(url).alias("host"), path_of(url).alias("path")), "urls")
    parts = components(alias_edges(pages, url_col, html_col)).withColumnRenamed("node", "address")
    linked = parts.select("address", F.regexp_extract("address", "^[^/?#]*", 0).alias("host"), F.regexp_extract("address", "^[^/?#]*([^?#]*)", 1).alias("path"))
    known = stored(matched(rows.select("address", "host", "path").union(linked).distinct(), rules), "url-rules")
    blocked = parts.join(known.filter("verdict = 'block'"), "address").select("component").distinct()
    tainted = parts.join(blocked, "component").select("address", F.lit("block").alias("carried")).distinct()
    return rows.join(known, "address", "left").join(tainted, "address", "left").select(
        id_col, "host", "path", "rule", F.coalesce("verdict", "carried", F.lit("allow")).alias("verdict"))
