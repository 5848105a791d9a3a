"""Address rules and vocabulary: brute force, the joined path, defined cases."""

import re
from pathlib import Path

import numpy as np
import pytest

from tripmart.llm import queries, urls

RULES = queries.URL_RULES
WORDS = urls.Vocabulary(strict=("casino", "a.b"), soft=("win", "free", "free bets"), soft_least=2)
ODD = [
    None, "", "no scheme", "http://", "http://example.org", "HTTP://Sub.EXAMPLE.org/es/x?casino", "http://example.org/es", "x://example.org?/es/",
    "http://xexample.org/es/a", "http://a.example.org/en/19#f", "http://example.com/fr/casino", "http://example.com/FR/casino", "http://com/de/",
    "http://example.com:80/de/", "http://example.net/casino", "http://example.net/casinos", "http://example.net/CASINO-x", "http://casino",
    "http://e.net/win", "http://e.net/win/win", "http://e.net/win_free", "http://e.net/winé/éfree", "http://e.net/free bets", "http://e.net/a.b", "http://e.net/xa.b",
    "http://" + "a." * 5000 + "org/", "http://x.net/" + "win/" * 5000 + "free", "a://b://example.org/", "http://u@example.org/es/\nz", "http://.org/", "http://org./",
]


def frame(spark, texts):
    rows = [(i, t, "clash", "clash", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, rule string, terms string")


def plain(url, rules, words):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    raw = re.split("[/?#]", rest, maxsplit=1)[0]
    host = "".join(c.lower() if c.isascii() else c for c in raw)
    path = re.split("[?#]", rest[len(raw) :], maxsplit=1)[0]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host + r.path), len(r.host), r.verdict), default=None)
    low = "".join(c.lower() if c.isascii() else c for c in url)
    hit = lambda terms: sum(bool(re.search(f"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", low)) for t in terms)
    strict, soft = hit(words.strict), hit(words.soft)
    verdict = best.verdict if best else "block" if strict or soft >= words.soft_least else "allow"
    return host, path, best and best.host + best.path, verdict, strict, soft


def judged(df):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict, r.strict_hits, r.soft_hits) for r in df.collect()}


def random_urls(count):
    random = np.random.default_rng(5)
    pick = lambda *x: str(random.choice(x))
    return [
        f"{pick('http', 'HTTPS')}://{pick('', 'www.', 'a.B.')}{pick('example', 'Example', 'casino', 'x-win')}.{pick('org', 'com', 'net', 'com.org')}"
        f"{pick('', '/')}{pick('', 'es/', 'en/1', 'en/2', 'fr/', 'de/')}{pick('', 'free', 'win-free', '?casino', '#a.b', 'xcasino', 'win.win')}"
        for _ in range(count)
    ]


@pytest.mark.parametrize("joined", [False, True])
def test_verdicts_equal_brute_force(spark, joined):
    texts = ODD + random_urls(600)
    rules = [*RULES, urls.Rule("b.example.com", "/", "block"), urls.Rule("com.org", "/en/", "block"), urls.Rule("org", "/en/1x", "allow")]
    given = spark.createDataFrame([(r.host, r.path, r.verdict) for r in rules], "host string, path string, verdict string") if joined else rules
    got = judged(urls.judge(frame(spark, texts), given, WORDS, rule_bytes=0))
    assert got == {i: plain(t, rules, WORDS) for i, t in enumerate(texts)}


def test_equally_long_rules(spark):
    rules = [urls.Rule("b.net", "/", "allow"), urls.Rule("net", "/12", "block"), urls.Rule("c.net", "/", "allow"), urls.Rule("c.net", "/", "block")]
    texts = ["http://b.net/12", "http://c.net/12"]
    table = spark.createDataFrame([(r.host, r.path, r.verdict) for r in rules], "host string, path string, verdict string")
    for given, limit in ((rules, 0), (table, 0), (table, 1 << 20)):
        got = judged(urls.judge(frame(spark, texts), given, WORDS, rule_bytes=limit))
        assert [got[i][2:4] for i in range(2)] == [("b.net/", "allow"), ("c.net/", "block")]


def test_defined_cases(spark):
    same = spark.createDataFrame([(1, "http://e.net/casino")] * 3 + [(None, None)], "page_id long, url string")
    rows = urls.judge(same, [], WORDS).collect()
    assert [(r.page_id, r.verdict) for r in rows if r.page_id] == [(1, "block")] * 3
    assert [(r.host, r.path, r.rule, r.verdict, r.terms) for r in rows if r.page_id is None] == [("", "", None, "allow", [])]
    assert urls.judge(same.limit(0), RULES, WORDS).count() == 0
    none = urls.judge(same, RULES, urls.Vocabulary()).collect()
    assert {r.verdict for r in none} == {"allow"}
    no_rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert urls.judge(same, no_rules, WORDS, rule_bytes=-1).where("verdict = 'block'").count() == 3
    for bad in (("A",), ("",), ("x", "x")):
        with pytest.raises(ValueError):
            urls.Vocabulary(strict=bad)


def test_query_equals_sql(spark, small):
    import sys

    sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
    import check

    got = queries.op12_urls(spark, small)
    assert check.compare(got, check.connect(small).sql(queries.ORACLE["op12_urls"])) == []
