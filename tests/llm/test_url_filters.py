import random
import re

import duckdb
import pandas as pd
import pytest

from steward.llm.bindings import URL_RULES
from steward.llm.components import components
from steward.llm.sql import URL_FILTERS
from steward.llm.url_filters import judge_urls, rule, rule_table

RULES = [rule(*r) for r in URL_RULES]


def link(url):
    return f'<html><head><link rel="canonical" href="{url}"></head></html>'


def refresh(url):
    return f"<meta http-equiv='refresh' content='0; url={url}'>"


PAGES = [
    (0, "http://a.example.com/de/1", None),  # blocked by rule
    (1, "https://b.example.net/x?utm_source=f", link("http://a.example.com/de/1")),  # alias of a blocked page
    (2, "http://c.example.net/y#top", refresh("https://b.example.net/x")),  # alias of an alias
    (3, "http://d.example.net/z", '<LINK href="http://E.example.com/fr/2" REL=canonical>'),  # alias of an allowed page
    (4, "http://f.example.net/z/", link("http://a.example.com/de/9")),
    (5, "http://f.example.net/w", link("/z")),
    (6, "http://g.example.com/fr/1", link("http://a.example.com/de/1")),  # explicit allow, in a blocked component
    (7, "http://h.example.net/", None),
    (8, None, link("http://a.example.com/de/1")),
    (9, "no url", link("http://a.example.com/de/1")),
    (10, "HTTP://X.Example.ORG/en/12", ""),
    (11, "http://example.org/es/1", None),
    (12, "http://notexample.org/es/1", None),
    (13, "http://example.org", None),
    (14, "http://m.example.com?x://y/de/", None),
    (14, "http://m.example.com?x://y/de/", None),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "h", "p", 1) for p in PAGES], "page_id long, url string, html string, host string, path string, node int")


def test_verdicts(spark, pages):
    got = {r["page_id"]: r for r in judge_urls(pages, RULES).collect()}
    verdicts = {k: r["verdict"] for k, r in got.items()}
    assert verdicts[0] == "block"
    # Page 6 is explicitly allowed in the component of pages 0, 1 and 2, and so its aliases that no rule fits are.
    assert [verdicts[i] for i in (1, 2, 6)] == ["allow"] * 3
    assert [verdicts[i] for i in (3, 4, 5, 7, 8, 9)] == ["allow", "block", "block", "allow", "allow", "allow"]
    assert (got[10]["host"], got[10]["path"], got[10]["rule"]) == ("x.example.org", "/en/12", "example.org/en/1")
    assert [got[i]["rule"] for i in (11, 12, 13)] == ["example.org/es/", "org/", None]
    assert (got[14]["host"], got[14]["path"]) == ("m.example.com", "")
    assert (got[8]["host"], got[8]["path"], got[9]["host"]) == ("", "", "")


def test_blocks_reach_aliases_where_none_is_allowed(spark, pages):
    verdicts = {r["page_id"]: r["verdict"] for r in judge_urls(pages.filter("page_id <> 6"), RULES).collect()}
    assert [verdicts[i] for i in (0, 1, 2)] == ["block"] * 3


def test_recorded_redirects_are_edges(spark, pages):
    redirects = spark.createDataFrame([("http://h.example.net/", "http://f.example.net/w"), (None, "x"), ("http://h.example.net", None)], "source string, target string")
    verdicts = {r["page_id"]: r["verdict"] for r in judge_urls(pages, RULES, redirects=redirects).collect()}
    assert verdicts[7] == "block"


def test_sql_says_the_same(spark, pages):
    con = duckdb.connect()
    frame = pd.DataFrame([p for p in PAGES if p[0] != 14], columns=["page_id", "url", "html"])
    con.register("pages", frame)
    want = sorted(con.execute(URL_FILTERS).fetchall())
    got = judge_urls(pages.filter("page_id <> 14"), RULES).select("page_id", "host", "path", "rule", "verdict")
    assert sorted(map(tuple, got.collect())) == want


def test_components_of_chains_stars_and_repeats(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    edges = [*chain, *star, (1, 1), (2, None), (9, 8), (8, 9), (9, 8)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(200, 260)} == {7}
    assert got[7] == 7 and got[9] == got[8] == 8 and 1 not in got and 2 not in got


def test_empty_and_bad_rules(spark, pages):
    assert judge_urls(pages.limit(0), RULES).count() == 0
    with pytest.raises(ValueError):
        rule("block", "no-slash")
    with pytest.raises(ValueError):
        judge_urls(pages, [*RULES, RULES[0]])


def test_all_links_and_all_urls_of_a_node_count(spark):
    rows = [
        (0, "http://h.example.org/es/", ""),  # blocked, and the same node as the next one's target, which fits no block
        (1, "http://b.example.net/x", link("http://h.example.org/es")),
        (2, "http://c.example.net/y", link("http://other.example.net/") + link("http://a.example.com/de/1")),
        (3, "http://d.example.net/z", refresh("http://third.example.net/") + refresh("http://a.example.com/de/2")),
        (4, "http://e.example.net/z", None),
    ]
    rules = [rule("block", "example.org/es/"), rule("block", "com/de/")]
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), rules)
    assert {r["page_id"]: r["verdict"] for r in got.collect()} == {0: "block", 1: "block", 2: "block", 3: "block", 4: "allow"}


def brute_rule(url, rules):
    """The longest rule that fits by a loop over all, for a page without links."""
    after = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = re.split("[/?#]", after)[0]
    path = re.split("[?#]", after[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fit, key=lambda r: (-len(r.text), r.text), default=None)
    return (best.text, best.verdict) if best else (None, "allow")


def many_rules(rng, n):
    hosts = ["com", "org", "example.com", "example.org", "a.example.com", "net", "x.net", "", "b.c.net"]
    made = {}
    while len(made) < n:
        text = rng.choice(hosts) + "/" + "".join(rng.choice("ab1/") for _ in range(rng.randint(0, 12)))
        made[text] = rule(rng.choice(["allow", "block"]), text)
    return list(made.values())


def test_any_number_of_rules_by_joins(spark, pages):
    """More rules than an expression takes give what a loop over all gives; few give the same by either way."""
    rng = random.Random(3)
    rules = many_rules(rng, 5000)
    urls = [f"http://{rng.choice(['A.', 'q.w.', ''])}{rng.choice(['example.com', 'x.net', 'org', 'c.net', 'b.c.net:80', 'net.'])}/"
            + "".join(rng.choice("ab1/?#") for _ in range(rng.randint(0, 15))) for _ in range(800)]
    urls += [None, "", "none", "://", "http://", "http:///ab", "http://com", urls[0], urls[0]]
    table = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(table, rules).collect()}
    assert got == {i: brute_rule(u, rules) for i, u in enumerate(urls)} and len({r for r, _ in got.values()}) > 100
    by_table = sorted(map(tuple, judge_urls(pages, rule_table(spark, RULES)).collect()), key=str)
    assert by_table == sorted(map(tuple, judge_urls(pages, RULES).collect()), key=str)
    empty = spark.createDataFrame([], "verdict string, host string, path string")
    assert {r["verdict"] for r in judge_urls(pages, empty).collect()} == {"allow"}
    for repeated in ([RULES[0], RULES[0]], rule_table(spark, [RULES[0], RULES[0]])):
        with pytest.raises(ValueError):
            judge_urls(pages, repeated)


def test_a_hundred_thousand_rules(spark, sf):
    """On the given pages: rules on two thirds of their paths and very many that fit none."""
    urls = [r["url"] for r in spark.read.parquet(f"{sf}/pages.parquet").select("url").collect()]
    texts = {}
    for i, url in enumerate(urls):
        after = (url or "").partition("://")[2]
        if "/" in after and i % 3:
            text = re.split("[?#]", after)[0].lower()[: -(i % 2) or None]
            texts[text] = rule(("allow", "block")[i % 2], text) if "/" in text else rule("allow", text + "/")
    rules = list(texts.values()) + [rule("block", f"host{i % 977}.example.com/p{i}") for i in range(100_000 - len(texts))]
    few = list(texts.values()) + rules[-100:]
    table = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(table, rules).collect()}
    want = {r["page_id"]: brute_rule(r["url"], few) for r in table.select("page_id", "url").collect()}
    assert len(rules) == 100_000 and got == want and sum(r is not None for r, _ in got.values()) > 20
