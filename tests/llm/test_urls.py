"""URL filters against a plain loop over rules and list."""

import re

import pytest

from tests.conftest import rows
from tillstream.llm import registry, url_filters
from tillstream.llm.url_filters import Rule

PAGES = "page_id long, url string, html string"
RULES = registry.URL_RULES


def parts(url):
    m = re.search("://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def canonical(url):
    host, path = parts(url)
    plain = re.sub(r"\.?(:(80|443)?)?\Z", "", host, count=1)
    return plain + path.rstrip("/") if plain else None


def judged(url, listed, rules=RULES):
    host, path = parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    verdict = best.verdict if best else "block" if canonical(url) in listed else "allow"
    return host, path, best and best.host + best.path, verdict


URLS = [
    "https://WWW.Example.com/en/x", "http://a.example.com/en/", "http://example.com/EN/x", "http://example.com", "http://com/", "http://xcom/y",
    "ftp://b.net/es/1?x=/fr/", "http://b.net/de/#/es/", "http://b.net?/es/", "http://b.net/fr", "http://net/fr/a b", "no scheme", "", None, "://", ":///p",
    "http://u:p@h.org:8080/a//", "http://h.org:80/a/", "HTTP://H.ORG.:443/a", "x://y://z/w", "http://münchen.org/ä", "http://h.org/" + "p" * 9000, "http://h.org\n/q", "http://s.org.\n", "http://s.org/a/\n",
    "http://s.org/%00", "http://s.org/a?b#c", "http://s.org/a#c?b", "http://www.b.net/es/",
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(3, URLS[0], None), (None, "http://s.org/a", None)], PAGES)


LISTED = ["h.org/a", "s.org/a", "s.org/a", None, "b.net/de", "example.com/en/x", "münchen.org/ä"]


@pytest.mark.parametrize("broadcast_blocks", [0, 1 << 17])
@pytest.mark.parametrize("per_block", [1, 32, 10**6])
def test_verdicts_by_hand(spark, pages, monkeypatch, broadcast_blocks, per_block):
    """The filter sent or joined; nearly empty or full of false positives."""
    monkeypatch.setattr(url_filters, "BROADCAST_BLOCKS", broadcast_blocks)
    monkeypatch.setattr(url_filters, "URLS_PER_BLOCK", per_block)
    listed = LISTED + [f"other{i}.org/" for i in range(400)]
    found = url_filters.with_verdicts(pages, spark.createDataFrame([(u,) for u in listed], "u string"), RULES)
    wanted = [(r["page_id"], *judged(r["url"], set(listed) - {None})) for r in pages.collect()]
    assert rows(found, "page_id", *url_filters.COLUMNS) == sorted(wanted, key=repr)
    assert found.columns == ["page_id", "url", "html", *url_filters.COLUMNS]


def test_filter_passes_all_listed_and_few_others(spark):
    urls = spark.range(4000).selectExpr("concat('h', id, '.org/p') as listed")
    blocks = url_filters.blocks_for(2000)
    bloom = url_filters.bloom_filter(urls.where("listed in (select concat('h', id, '.org/p') from range(2000))"), blocks)
    asked = urls.withColumn("asked", url_filters.block_of(urls["listed"], blocks))
    joined = asked.join(bloom, asked["asked"] == bloom["block"], "left")
    hit = [f"w{i}" for i in range(8)]
    bits = url_filters.bits_of(joined["listed"])
    passed = joined
    for name, bit in zip(hit, bits):
        passed = passed.where(joined[name].bitwiseAND(bit) != 0)
    found = {r[0] for r in passed.select("listed").collect()}
    assert {f"h{i}.org/p" for i in range(2000)} <= found
    assert len(found) < 2100


def test_longest_rule_wins_and_ties_go_to_the_longer_host(spark):
    rules = [Rule("allow", "org", "/abcd"), Rule("block", "b.org", "/ab"), Rule("allow", "a.b.org", "/"), Rule("block", "org", "")]
    urls = ["http://x.b.org/abcd", "http://a.b.org/x", "http://b.org", "http://c.org/ab"]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    empty = spark.createDataFrame([], "u string")
    found = url_filters.with_verdicts(frame, empty, rules)
    assert rows(found, "page_id", "rule", "verdict") == [(0, "b.org/ab", "block"), (1, "a.b.org/", "allow"), (2, "org", "block"), (3, "org", "block")]
    plain = url_filters.with_verdicts(frame, empty, [])
    assert rows(plain, "rule", "verdict") == [(None, "allow")] * 4


def test_clashing_names_and_no_rows(spark, pages):
    clash = pages.selectExpr("page_id", "url", "html as HOST", "page_id as block", "url as canonical", "html as w0", "url as listed", "1 as row")
    listed = spark.createDataFrame([("s.org/a",)], "url string")
    found = url_filters.with_verdicts(clash, listed, RULES)
    assert found.columns == ["page_id", "url", "block", "canonical", "w0", "listed", "row", *url_filters.COLUMNS]
    assert found.where("verdict = 'block' and rule is null").count() == 3
    assert url_filters.with_verdicts(pages.limit(0), listed, RULES).count() == 0
    assert url_filters.urls_of_blocked_hosts(pages.limit(0), RULES).count() == 0


def test_hosts_with_mostly_blocked_pages_are_listed(spark):
    urls = ["http://a.net/es/1", "http://a.net/de/2?q", "http://b.net/es/1", "http://b.net/de/2", "http://b.net/de/3", "http://c.com/"]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert rows(url_filters.urls_of_blocked_hosts(frame, RULES)) == [("a.net/de/2",), ("a.net/es/1",)]


def test_only_sql_functions(spark, pages):
    plan = url_filters.with_verdicts(pages, spark.createDataFrame([("s.org/a",)], "url string"), RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
