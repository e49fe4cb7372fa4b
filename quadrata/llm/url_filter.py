"""URL filters with redirect equivalence, by DataFrame operations only.

Canonical links and redirects make urls aliases. Connected components of these links carry block decisions from any url of
a component to all others; a url that a rule fits keeps its rule's verdict, so an explicit allow goes before a block that
comes through an alias.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrata.llm.components import components
from quadrata.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """Name of a url among its aliases: host, path and query, without scheme and fragment; null without ``://``."""
    tail = F.regexp_extract(url, r"://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host_of(url), tail))


def with_rule(urls: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Adds ``rule`` and ``ruled`` (its verdict) to rows with host and path: the longest rule that fits.

    A rule (verdict, host, path) fits its host and all subdomains if the path starts with its own. Rules are matched to the
    different hosts once, by an equi-join on the ends of the host, and then to the rows by host.
    """
    spark = urls.sparkSession
    table = spark.createDataFrame([(v, h, p) for v, h, p in rules], "verdict string, rule_host string, rule_path string")
    table = table.groupBy("rule_host").agg(F.collect_list(F.struct("rule_path", "verdict")).alias("own"))
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = urls.select("host").distinct().select("host", F.explode(ends).alias("rule_host"))
    fitting = hosts.join(table, "rule_host").select("host", F.explode("own").alias("r"), "rule_host")
    each = F.struct(
        F.length(F.concat("rule_host", "r.rule_path")).alias("size"),
        F.concat("rule_host", "r.rule_path").alias("rule"),
        F.col("r.rule_path").alias("path"),
        F.col("r.verdict").alias("verdict"),
    )
    by_host = fitting.groupBy("host").agg(F.sort_array(F.collect_list(each), asc=False).alias("_rules"))
    best = F.get(F.filter("_rules", lambda r: F.col("path").startswith(r["path"])), F.lit(0))
    return urls.join(by_host, "host", "left").withColumns({"rule": best["rule"], "ruled": best["verdict"]}).drop("_rules")


def _without_dots(path: Column) -> Column:
    """The path after its ``.`` and ``..`` steps."""
    steps = F.split(path, "/")
    steps = F.when(F.element_at(steps, -1).isin(".", ".."), F.concat(steps, F.array(F.lit("")))).otherwise(steps)
    up = lambda done: F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))  # noqa: E731  the empty step before the first / stays
    step = lambda done, s: F.when(s == "..", up(done)).when(s == ".", done).otherwise(F.concat(done, F.array(s)))
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.array_join(F.aggregate(steps, F.array().cast("array<string>"), step), "/")).otherwise(path)


def _resolved(url: Column, target: Column) -> Column:
    """``target`` as seen from ``url``: a path starts at the folder of the url's path, a query at the path; null for other schemes."""
    root = F.regexp_extract(url, r"^[^/?#]*://[^/?#]*", 0)
    path = path_of(url)
    folder = F.concat(F.regexp_extract(path, r"^(.*)/", 1), F.lit("/"))
    own = F.regexp_extract(target, r"^[^?#]*", 0)
    rest = F.substr(target, F.length(own) + 1)
    placed = F.when(own == "", path).when(own.startswith("/"), own).otherwise(F.concat(folder, own))
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("#") | target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.concat(root, _without_dots(placed), rest))
    )


def links(pages: DataFrame) -> DataFrame:
    """(a, b) of every canonical link and redirect in the html of (url, html), as nodes; relative targets are resolved, &amp; is unescaped."""
    tag = r"(?is)<(?:link|meta)\b[^>]*>"
    html = F.coalesce("html", F.lit(""))
    tags = pages.select("url", F.explode(F.regexp_extract_all(html, F.lit(tag), F.lit(0))).alias("tag"))
    tags = tags.withColumn("tag", F.regexp_replace("tag", "&(?:amp|#38|#[xX]26);", "&"))
    canonical = F.when(
        F.col("tag").rlike(r"(?is)^<link\b[^>]*\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"), F.regexp_extract("tag", r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    )
    redirect = F.when(
        F.col("tag").rlike(r"(?is)^<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b"), F.regexp_extract("tag", r"(?is)\burl\s*=\s*[\"']?([^\"'\s>;]+)", 1)
    )
    target = F.nullif(F.coalesce(canonical, redirect), F.lit(""))
    rooted = _resolved(F.col("url"), target)
    return tags.select(node_of(F.col("url")).alias("a"), node_of(rooted).alias("b")).dropna().where("a <> b").distinct()


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``pages`` (page_id, url, html; more is ignored).

    verdict: that of the longest rule that fits; else block if any alias of the url, itself included, is blocked by a rule;
    else allow. Targets of links count as aliases whether or not they are pages. Null urls, and urls without ``://``, have
    empty host and path and no aliases; null html has no links.
    """
    url = F.col("url")
    found = cut_lineage(links(pages.select("url", "html")))
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    ruled = with_rule(rows, rules)
    alias = components(found, "a", "b")
    named = F.concat(F.lit("x://"), "node")
    judged = with_rule(alias.select("root", host_of(named).alias("host"), path_of(named).alias("path")), rules)
    bad = judged.where(F.col("ruled") == BLOCK).select("root").distinct()
    blocked = alias.join(bad, "root").select("node", F.lit(BLOCK).alias("through"))
    verdict = F.coalesce("ruled", "through", F.lit(ALLOW))
    return ruled.join(blocked, "node", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
