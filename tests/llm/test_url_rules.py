import re

import pytest

from hourglass.llm import url_rules as U

LINES = ("||net/", "@@||example.net/en/", "||example.com/de/", "@@||org/fr/", "||Deep.Example.org/A/b", "||bare.host",
         "^pills^", "@@^pills^info^", "|m.", "^a*b^c", "odd", "^page=*x^", "/end|", "|exact.host/|")
URLS = ("http://x.example.net/en/1", "http://example.net/de/", "https://NET/", "https://anet/", "https://a.net", "http://example.com/de/x?y=/fr/",
        "http://sub.example.com/DE/", "http://example.org/fr/", "ftp://deep.example.org/A/bc", "http://deep.example.org/a/b",
        "http://bare.host", "http://bare.host:80/", "http://my-pills.example.org/", "http://pills-info.example.org/", "http://m.example.org/",
        "http://am.example.org/", "http://a.x/b/c", "http://b.a/x?b-c", "no scheme", "", None, "://", "http://", "http://?q#f", "http://h?x=://net/",
        "http://example.org/?page=12&x", "http://example.org/odd/end", "http://exact.host/", "http://exact.host/x", "http://é.net/ /en/",
        "http://x.org/fr/\n/b", "http://" + "a-" * 20_000 + "x.org/a" + "b" * 20_000, "http://example.net/en/1", "http://x.net/en/")


def by_hand(url, lines=LINES):
    """Every rule on every URL, without an index."""
    after = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", after).group()
    rest = after[len(host):]
    path = re.match(r"[^?#]*", rest).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in host + rest)
    hosts, pats = [], []
    for line in lines:
        verdict, body = ("allow", line[2:]) if line.startswith("@@") else ("block", line)
        if body.startswith("||"):
            h, slash, p = body[2:].partition("/")
            h = h.lower()
            if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
                hosts.append((-len(h + slash + p), -len(h), verdict == "allow", h + slash + p, verdict))
        else:
            regex = "".join(".*" if c == "*" else "([^a-z0-9]|^|$)" if c == "^" else re.escape(c) for c in body.strip("|").lower())
            regex = ("^" if body.startswith("|") else "") + regex + (r"\Z" if body.endswith("|") else "")
            if len(low) < 1000 and re.search(regex.replace("$", r"\Z"), low, re.DOTALL):
                pats.append((verdict == "block", line, body, verdict))
    if hosts:
        return host, path, min(hosts)[3], None, min(hosts)[4]
    if pats:
        return host, path, None, min(pats)[2], min(pats)[3]
    return host, path, None, None, "allow"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u, "x", "y", "z") for i, u in enumerate(URLS)] + [(None, URLS[0], None, None, None)],
                                 "page_id long, url string, host string, rule string, html string").repartition(3)


@pytest.mark.parametrize("max_broadcast", [U.MAX_BROADCAST, 0])
def test_index_and_join_equal_all_rules_on_every_url(spark, pages, max_broadcast):
    got = U.url_verdicts(pages, U.rule_table(spark, LINES), max_broadcast=max_broadcast).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        want = by_hand(URLS[r.page_id if r.page_id is not None else 0])
        assert (r.host, r.path, r.rule, r.pattern, r.verdict) == want, r


def test_rules_are_filed_under_their_rarest_whole_token(spark):
    rules = U.rule_table(spark, ["||example.net/en/part", "^a^b^", "*odd*", "x^only^y"])
    tokens = spark.createDataFrame([("example",)] * 3 + [("net",)] * 2 + [("en",)] * 4 + [("a",)], "token string")
    got = {r.line: r.token for r in U.index_rules(rules, tokens).collect()}
    assert got == {"||example.net/en/part": "net", "^a^b^": "b", "*odd*": "", "x^only^y": "only"}


def test_repeated_and_senseless_rules(spark):
    assert U.rule_table(spark, ["^a^", "^a^"]).count() == 1
    for line in ("||", "||/path", "||host/a?b", "", "*", "@@**"):
        with pytest.raises(ValueError):
            U.parse_rule(line)


def test_no_rules_and_no_rows(spark, pages):
    assert {r.verdict for r in U.url_verdicts(pages, U.rule_table(spark, [])).collect()} == {"allow"}
    for limit in (0, U.MAX_BROADCAST):
        assert U.url_verdicts(pages.filter("false"), U.rule_table(spark, LINES), max_broadcast=limit).collect() == []


def test_string_ids(spark):
    rows = spark.createDataFrame([("a", "http://x.net/"), (None, "http://x.org/")], "id string, address string")
    got = U.url_verdicts(rows, U.rule_table(spark, LINES), "id", "address").collect()
    assert sorted((r.id or "", r.verdict) for r in got) == [("", "allow"), ("a", "block")]
