"""URL filters against rules tried one by one."""

import re

import duckdb
import pyarrow.parquet as pq
import pytest

from moodwell.llm import oracles, registry, urlrules

ADDRESSES = [
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "com"), ("allow", "com/A"), ("block", "a.com/A"),
    ("allow", "a.com/A"), ("block", "org/fr"), ("block", "x/%5B[1]\\E."), ("block", ""),
]
PATTERNS = [
    ("block", "^ads^"), ("allow", "^ads^banner"), ("block", "||shop."), ("block", ".exe|"), ("block", "|a.com/q*="),
    ("block", "*"), ("allow", "*zz*"), ("block", "É^é"),
]
URLS = [
    None, "", "no address", "http://", "://NET/", "http://Example.NET/en/x", "http://example.net/EN/x", "http://net",
    "http://net/", "http://xnet/", "http://x.net?a=/", "http://x.net#/", "ftp://A.com/A/b", "http://b.A.com/a",
    "http://com", "http://com.x/", "http://org/french", "http://org/fr", "http://org/f", "http://x/%5B[1]\\E.html",
    "http://my-ads.x/", "http://ads", "http://loads.x/", "http://x/ADS/banner", "http://shop.x/", "http://a.shop.x/",
    "http://shops.x", "http://x/a.exe", "http://x/a.exe?", "http://a.com/q?w=1", "http://a.com/q\n=", "a://b://c.net/",
    "http://x/zz", "http://É/é", "http://é/É", "http://user@h.net:80/", "http://h.net:80/", "http://a..net/",
    "http://x/" + "very/long/" * 20_000 + "ads", "http://x/" + "y" * 100_000,
]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def judge(url, addresses, patterns):
    behind = url.partition("://")[2] if url else ""
    host = re.match("[^/?#]*", behind)[0]
    rest = behind[len(host) :]
    path, host = re.match("[^?#]*", rest)[0], lowered(host)
    fits = []
    for verdict, rule in addresses:
        rule_host, slash, rule_path = rule.partition("/")
        on_host = host == lowered(rule_host) or host.endswith("." + lowered(rule_host))
        if on_host and path.startswith(slash + rule_path):
            fits.append((len(rule), verdict == "allow", rule, verdict))
    by_address = max(fits, default=None)
    fits = []
    for verdict, rule in patterns:
        body, start, end = rule, "", ""
        if body.startswith("||"):
            body, start = body[2:], r"\A(?:[^/?#]*\.)?"
        elif body.startswith("|"):
            body, start = body[1:], r"\A"
        if body.endswith("|"):
            body, end = body[:-1], r"\Z"
        body = body.lstrip("*") if start != r"\A" else body
        start = "" if rule.startswith("||*") else start
        inner = "".join({"*": ".*", "^": r"(?:[^a-z0-9]|\A|\Z)"}.get(c, re.escape(c)) for c in lowered(body))
        if re.search("(?s)" + start + (inner if end else inner.removesuffix(".*")) + end, lowered(host + rest)):
            fits.append((len(rule), verdict == "allow", rule, verdict))
    by_pattern = max(fits, default=None)
    deciding = by_address or by_pattern
    return (host, path, by_address and by_address[2], deciding[3] if deciding else "allow", by_pattern and by_pattern[2])


def check(spark, urls, addresses, patterns):
    fields = "page_id long, url string, host int, row string, rule int, token string, part int"
    rows = [(i if i % 7 else None, u, 1, "r", 2, "t", 3) for i, u in enumerate(urls)]
    found = urlrules.filter_urls(spark.createDataFrame(rows, fields), urlrules.rule_table(spark, addresses, patterns))
    got = sorted([tuple(r) for r in found.collect()], key=repr)
    assert got == sorted([(r[0], *judge(r[1], addresses, patterns)) for r in rows], key=repr)


def test_rules_one_by_one(spark):
    check(spark, URLS + URLS[-6:], ADDRESSES, PATTERNS)


def test_contract_rules(spark):
    check(spark, URLS, urlrules.ADDRESS_RULES, urlrules.PATTERN_RULES)


def test_no_rules_and_no_rows(spark):
    check(spark, URLS[:5], [], [])
    check(spark, [], ADDRESSES, PATTERNS)


@pytest.mark.parametrize("part, sent", [(2, 0), (1000, 200_000)])
def test_frequent_tokens_are_dealt_out(spark, monkeypatch, part, sent):
    monkeypatch.setattr(urlrules, "PART", part * 10)
    monkeypatch.setattr(urlrules, "sent_if_small", lambda side: side if not sent else urlrules.F.broadcast(side))
    check(spark, [f"http://h{i % 3}.net/{i}" for i in range(300)], ADDRESSES, PATTERNS)


def test_rarest_token(spark):
    rules = urlrules.compiled(urlrules.rule_table(spark)).collect()
    tokens = {r.rule: set(r.tokens) for r in rules}
    assert tokens["net/"] == {"net"} and tokens["example.com/de/"] == {"example", "com", "de"}
    assert tokens["||*.edu^wiki^*casino^"] == {"edu", "wiki"} and tokens[".exe|"] == {"exe"}


def test_query(spark, small):
    got = registry.QUERIES["op11_url_filter"](spark, small)
    pages = pq.read_table(f"{small}/pages.parquet", columns=["page_id", "url"]).to_pylist()
    want = [(p["page_id"], *judge(p["url"], urlrules.ADDRESS_RULES, urlrules.PATTERN_RULES)) for p in pages]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    engine = duckdb.connect()
    engine.execute(f"CREATE VIEW pages AS SELECT * FROM '{small}/pages.parquet'")
    said = engine.execute(oracles.URL_FILTER_SQL)
    assert [d[0] for d in said.description] == got.columns
    assert sorted(said.fetchall(), key=repr) == sorted(want, key=repr)
