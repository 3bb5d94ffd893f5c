"""Block and allow rules for urls, carried to aliases through redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.llm.components import connected_components
from flowtables.plans.pin import pin
from flowtables.plans.sizes import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Parts of a query that say where a visitor came from, not what the page is.
TRACKING = r"(?i)(?:^|&)(?:utm_[a-z]+|gclid|fbclid|ref)=[^&]*"
LINK_TAG = r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH_TAG = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
#: What a browser does not read as markup: comments (to the end, if nothing ends them) and scripts.
UNREAD = r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|template)\b[^>]*>.*?(?:</\1\s*>|\z)"
REFRESH_URL = r"(?i)\burl\s*=\s*[\"']?([^\"'\s>;]+)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_node(url: Column) -> Column:
    """What names a page: host, path and query, without scheme and fragment; null for
    what is no url."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), F.concat(url_host(url), rest))


def canonical_node(node: Column) -> Column:
    """The common form of a node: without ``www.`` or ``m.``, tracking parameters,
    ``.html`` and trailing slashes."""
    path = F.regexp_replace(F.regexp_extract(node, r"(?s)^([^?]*)", 1), r"^(?:www|m)\.(?=[^/?]*\.[^/?]*)", "")
    query = F.regexp_replace(F.regexp_replace(F.regexp_extract(node, r"(?s)\?(.*)$", 1), TRACKING, ""), "^&", "")
    path = F.regexp_replace(path, r"(?<=[^/])(?:\.html?)?/*$", "")
    return F.when(query == "", path).otherwise(F.concat_ws("?", path, query))


def _target(url: Column, link: Column) -> Column:
    """An absolute url from a link on the page of ``url``."""
    scheme, base = F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*)?/)", 1)
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    return (
        F.when((link == "") | ~F.contains(url, F.lit("://")), None)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(base, link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:|^#"), None)
        .otherwise(F.concat(F.when(folder == "", F.concat(base, F.lit("/"))).otherwise(folder), link))
    )


def alias_links(
    pages: DataFrame, url: str = "url", html: str = "html", redirects: DataFrame | None = None, common_forms: bool = True
) -> DataFrame:
    """``a, b``: nodes of urls that stand for one page.  From ``<link rel=canonical>``
    and ``<meta http-equiv=refresh>`` of the pages (not in comments and scripts), from ``redirects``
    (``from_url, to_url``), and, with ``common_forms``, from each url to its common form."""
    at, body = F.col(url), F.col(html)
    # Computed once: of pages that say neither word, nothing else is looked at.
    said = F.lower(body).contains("canonical") | F.lower(body).contains("http-equiv")
    pages = pin(pages.select(at.alias("at"), F.when(said, body).alias("body")), read=F.regexp_replace("body", UNREAD, ""))
    at, body = F.col("at"), F.col("read")
    canonical = F.regexp_extract(F.regexp_extract(body, LINK_TAG, 0), HREF, 1)
    refresh = F.regexp_extract(F.regexp_extract(body, REFRESH_TAG, 0), REFRESH_URL, 1)
    # a regular expression that ignores case is slow to find its first letter
    low = F.lower(body)
    canonical = F.when(F.contains(low, F.lit("canonical")), canonical).otherwise("")
    refresh = F.when(F.contains(low, F.lit("http-equiv")), refresh).otherwise("")
    targets = [url_node(_target(at, canonical)), url_node(_target(at, refresh))]
    if common_forms:
        targets.append(canonical_node(url_node(at)))
    links = pages.select(url_node(at).alias("a"), F.explode(F.array(*targets)).alias("b"))
    if redirects is not None:
        more = redirects.select(url_node(F.col("from_url")).alias("a"), url_node(F.col("to_url")).alias("b"))
        links = links.unionByName(more)
    return links.where("a <> b")


def match_rules(nodes: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``host, path, rule, verdict`` for the distinct (``host``, ``path``) that a rule
    fits.  ``rules``: (host, path, ``block`` or ``allow``); a rule fits its host and
    all subdomains if the path starts with the rule's.  The longest wins; of equally
    long ones allow, then the first in order.

    The rules are a list on the driver, which bounds what is broadcast.  Each host is
    tried by its domain suffixes, so the work does not grow with the rules."""
    spark = nodes.sparkSession
    rows = [(h, p, h + p, v) for h, p, v in rules]
    table = spark.createDataFrame(rows, "domain string, start string, rule string, verdict string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    rank = F.struct(-F.length("rule"), F.col("verdict"), F.col("rule"))
    return (
        nodes.select("host", "path").distinct()
        .withColumn("domain", F.explode(suffixes))
        .join(F.broadcast(table), "domain")
        .where(F.startswith("path", "start"))
        .groupBy("host", "path")
        .agg(F.min(rank).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    )


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    redirects: DataFrame | None = None,
    common_forms: bool = True,
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, alias_id, blocked_by``.

    A rule that fits a url decides on it, allow rules too.  A url without a rule is
    blocked if anything it stands for is blocked by rule (``blocked_by`` is the least
    such node), and allowed otherwise: an explicit allow holds for the urls it fits,
    and does not undo a block that reaches others.  ``alias_id`` is the smallest node
    of the connected component over redirects and canonical links.

    Null urls and urls without ``://`` have empty host and path, no rule and no
    aliases, and are allowed.  Repeated rows are judged alike and all kept; columns
    other than the three named are not read, so none can clash.
    """
    named = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    links = written(alias_links(named, redirects=redirects, common_forms=common_forms), "aliases")
    aliases = connected_components(links, "a", "b")
    judged = named.select(
        "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), url_node(F.col("url")).alias("node")
    )
    hosts = aliases.select("node", "component").withColumns(
        {"host": F.regexp_extract("node", r"(?s)^([^/?]*)", 1), "path": F.regexp_extract("node", r"(?s)^[^/?]*([^?]*)", 1)}
    )
    fits = written(match_rules(judged.select("host", "path").unionByName(hosts.select("host", "path")), rules), "fits")
    blocked = (
        hosts.join(fits.where("verdict = 'block'"), ["host", "path"])
        .groupBy("component").agg(F.min("node").alias("blocked_by"))
    )
    reached = aliases.join(blocked, "component", "left")
    verdict = F.coalesce("verdict", F.when(F.col("blocked_by").isNotNull(), "block").otherwise("allow"))
    return (
        judged.join(fits, ["host", "path"], "left")
        .join(reached, "node", "left")
        .select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("component", "node").alias("alias_id"),
                F.when(F.col("rule").isNull(), F.col("blocked_by")).alias("blocked_by"))
    )
