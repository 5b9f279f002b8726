"""Shift-And masks against a regular expression for every rule."""

from __future__ import annotations

import random
import re

from adjudica.llm.queries import URL_RULES
from adjudica.llm.url_filter import ShiftAnd, url_verdicts


def by_regex(rules, host, path):
    best = None
    for text, verdict in rules:
        rule_host, slash, rest = text.partition("/")
        glob = lambda t, any_: "".join(any_ if c == "*" else "." if c == "?" else re.escape(c) for c in t)
        pattern = r"(?:[^/]*\.)?" + glob(rule_host, "[^/]*") + slash + glob(rest, ".*")
        if re.match(pattern, host + path, re.S) and (best is None or len(text) > len(best[0])):
            best = (text, verdict)
    return best


def test_automaton_equals_regex():
    rules = [*URL_RULES, ("*ads*.org/", "block"), ("a.b/*x?z", "block"), ("a.b/", "allow"), ("long" * 40 + ".com/p", "block"), ("org/y", "allow")]
    random.seed(1)
    hosts = ["com", "example.com", "xexample.com", "www.example.com", "a.b", "c.a.b", "ads.org", "my-ads-1.org", "b.net", "net", "long" * 40 + ".com", ""]
    paths = ["", "/", "/en/", "/en", "/es/1", "/fr/a.com/en/", "/axbz", "/xyz", "/qqxyzq", "/y", "/p" * 300, "/é/en/"]
    urls = [(h, p) for h in hosts for p in paths] + [
        ("".join(random.choices("ab.", k=5)), "/" + "".join(random.choices("axyz/", k=random.randint(0, 9)))) for _ in range(400)
    ]
    won = ShiftAnd(rules).winners([(h + p).encode() for h, p in urls])
    for (host, path), rule in zip(urls, won):
        expected = by_regex(rules, host, path)
        assert (rules[rule] if rule >= 0 else None) == expected, (host, path)


def test_edges(spark):
    rows = [
        (1, "HTTP://WWW.Example.COM/en/x?q#f", "z"), (2, None, "z"), (3, "", "z"), (4, "no scheme", "z"), (5, "http://a.net", "z"),
        (6, "x://a.net/fr/" + "y" * 100_000, "z"), (1, "HTTP://WWW.Example.COM/en/x?q#f", "z"), (None, "h://b.com/#", "z"), (7, "a://É.com/", "z"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string")
    found = sorted(((r.page_id, r.host, r.path[:9], r.rule, r.verdict) for r in url_verdicts(df, URL_RULES).collect()), key=repr)
    assert found == sorted([
        (1, "www.example.com", "/en/x", "www.example.com/en/", "allow"), (1, "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "", "", None, "allow"), (5, "a.net", "", None, "allow"),
        (6, "a.net", "/fr/yyyyy", "net/fr/", "block"), (None, "b.com", "/", "com/", "allow"), (7, "É.com", "/", "com/", "allow"),
    ], key=repr)
    assert url_verdicts(df.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in url_verdicts(df, [], default="block").collect()} == {"block"}
