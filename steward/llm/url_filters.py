"""URL filters with redirect equivalence (operator 10).

Rules fit a host with its subdomains and a path prefix; the longest that fits decides, of equally long ones (a longer host with a
shorter path) the one whose text comes first. Few rules are an expression over host and path; any number of rules is a table that
host suffixes and path prefixes of the lengths in use are joined to, by equality. Pages that no rule fits take the
decision of what they are aliases of: redirects and canonical links are edges between URLs, connected components of them are
worked out distributed, and a block of any URL in a component holds for all of it, unless a rule explicitly allows one of
them: an explicit allow takes precedence over a block, in a page's own rule and in its component.

URLs are compared as graph nodes without scheme, default port, fragment, tracking parameters and final slash, so that a link
finds its target. Links out of a page are its ``rel=canonical`` link, its ``http-equiv=refresh`` target, and what a table of
recorded redirects says.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no rule, is no node, and is allowed; a
null or empty page text has no links; repeated rows are judged alike; rules of equal text are refused; very long URLs and
texts are taken whole; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from steward.llm.columns import picked
from steward.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
QUERY = r"(?s)^[^?#]*\?([^#]*)"
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = (
    r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\bcontent\s*=\s*["']?[^"'>]*?url\s*=\s*["']?([^"'\s>]+)"""
)

#: A rule list up to this long becomes part of every page's expression; longer lists are joined. Results are the same.
MAX_RULES = 1000


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for URLs whose host is ``host`` or below it and whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    """A rule from a text like ``example.org/en/``: host up to the first slash, path from there."""
    host, slash, path = text.partition("/")
    if verdict not in ("allow", "block") or not slash:
        raise ValueError(f"not a rule: {verdict} {text}")
    return Rule(verdict, host, slash + path)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def _no_repeats(repeats: bool) -> None:
    if repeats:
        raise ValueError("each rule text once")


def decided(host: Column, path: Column, rules: list[Rule]) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, or null, as one expression."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    for r in reversed(ordered):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The rules as a table ``(verdict, host, path)``, the form in which :func:`judge_urls` takes any number of them."""
    return spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")


def decisions(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, path, d)`` for the distinct ``urls(host, path)`` that a rule of the table fits, ``d`` as in :func:`decided`.

    Host suffixes meet the lengths of the rule paths of that host, then the prefixes of those lengths meet the rules.
    """
    whole = F.concat("host", "path")
    lengths = rules.groupBy(F.col("host").alias("suffix")).agg(F.collect_set(F.char_length("path")).alias("lengths"))
    named = rules.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), whole.alias("rule"), "verdict")
    labels = F.split("host", "[.]", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    near = urls.select("host", "path").distinct().withColumn("suffix", F.explode(suffixes)).join(lengths, "suffix")
    tried = near.withColumn("n", F.explode(F.filter("lengths", lambda n: n <= F.char_length("path"))))
    fits = tried.withColumn("prefix", F.col("path").substr(F.lit(1), F.col("n"))).join(named, ["suffix", "prefix"])
    best = F.min(F.struct((-F.char_length("rule")).alias("shortness"), "rule", "verdict"))
    return fits.groupBy("host", "path").agg(best.alias("b")).select("host", "path", F.struct("b.rule", "b.verdict").alias("d"))


def with_decisions(urls: DataFrame, rules: list[Rule] | DataFrame) -> DataFrame:
    """``urls``, which has ``host`` and ``path``, with the decision ``d`` of each row."""
    if isinstance(rules, list) and len(rules) <= MAX_RULES:
        _no_repeats(len({r.text for r in rules}) != len(rules))
        return urls.withColumn("d", decided(F.col("host"), F.col("path"), rules))
    table = rule_table(urls.sparkSession, rules) if isinstance(rules, list) else rules
    _no_repeats(not table.groupBy(F.concat("host", "path")).count().filter("count > 1").isEmpty())
    return urls.join(decisions(urls, table), ["host", "path"], "left")


def url_node(url: Column) -> Column:
    """The form in which URLs are compared; null where there is no host."""
    query = F.coalesce(F.regexp_extract(url, QUERY, 1), F.lit(""))
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[^=]*|ref)(=|$)")), "&")
    host = F.regexp_replace(host_of(url), ":(80|443)$", "")
    path = F.regexp_replace(path_of(url), "/$", "")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))))


def resolved(link: Column, base: Column) -> Column:
    """The absolute URL of a link found in the page at ``base``; null for no link or no base."""
    host = F.regexp_extract(base, HOST, 1)
    folder = F.regexp_extract(F.concat(F.lit("/"), F.ltrim(path_of(base), F.lit("/"))), r"(?s)^(.*/)[^/]*$", 1)
    return (
        F.when(F.coalesce(link, F.lit("")) == "", F.lit(None))
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(F.lit("http://"), host, link))
        .when(link.rlike("^[?#]"), F.concat(F.lit("http://"), host, path_of(base), link))
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.concat(F.lit("http://"), host, folder, link))
    )


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html", redirects: DataFrame | None = None) -> DataFrame:
    """``(source, target)`` URLs: all canonical links and refresh targets of the pages, and the rows of ``redirects``."""
    rows = picked(pages, url=url, html=html)
    links = F.concat(*[F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(p), 1) for p in (CANONICAL, REFRESH)])
    found = rows.select("url", F.explode(F.array_distinct(F.filter(links, lambda x: x != ""))).alias("link"))
    edges = found.select(F.col("url").alias("source"), resolved(F.col("link"), F.col("url")).alias("target"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select("source", "target"))
    return edges.filter("source IS NOT NULL AND target IS NOT NULL")


def alias_verdicts(edges: DataFrame, rules: list[Rule] | DataFrame, urls: DataFrame | None = None) -> DataFrame:
    """``(node, alias_verdict)`` for URLs of components in which some URL fits a rule: one that an edge names, or one of
    ``urls(url)`` that is the same node."""
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("source").alias("url")),
                F.struct(F.col("target").alias("url")),
            )
        )
    )
    if urls is not None:
        ends = ends.unionByName(urls.select("url"))
    nodes_of = ends.select(
        url_node(F.col("url")).alias("node"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    ruled = (
        with_decisions(nodes_of, rules)
        .filter("node IS NOT NULL AND d IS NOT NULL")
        .select("node", F.col("d.verdict").alias("verdict"))
        .distinct()
    )
    nodes = components(
        edges.select(url_node(F.col("source")).alias("a"), url_node(F.col("target")).alias("b")).filter(
            "a IS NOT NULL AND b IS NOT NULL"
        )
    )
    # "allow" comes before "block", so the least verdict of a component is the explicit allow, if there is one.
    by_root = nodes.join(ruled, "node").groupBy("root").agg(F.min("verdict").alias("alias_verdict"))
    return nodes.join(by_root, "root").select("node", "alias_verdict")


def judge_urls(pages: DataFrame, rules: list[Rule] | DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
               redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: ``page_id, url, host, path, rule, verdict``. ``rules`` are a list or a table ``(verdict, host, path)``."""
    aliases = alias_verdicts(alias_edges(pages, url, html, redirects), rules, picked(pages, url=url))
    rows = picked(pages, page_id=page_id, url=url).select(
        "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    judged = with_decisions(rows, rules)
    # Rows that need no alias get a key of their own that no node has: null keys would all meet in one task.
    alone = F.concat(F.lit("/"), F.xxhash64("page_id", "url"))
    unruled = F.coalesce(F.when(F.col("d").isNull(), url_node(F.col("url"))), alone)
    joined = judged.withColumn("node", unruled).join(aliases, "node", "left")
    return joined.select(
        "page_id", "url", "host", "path", F.col("d.rule").alias("rule"),
        F.coalesce(F.col("d.verdict"), F.col("alias_verdict"), F.lit("allow")).alias("verdict"),
    )
