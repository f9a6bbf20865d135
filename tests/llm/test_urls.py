import random

import pytest

from classweave.llm import urls


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    best = None
    for name, verdict in (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")):
        own, _, prefix = name.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + prefix) and (best is None or len(name) > len(best[0])):
            best = (name, verdict)
    return host, path, best


def judged(spark, addresses, **options):
    df = spark.createDataFrame(list(enumerate(addresses)), "k int, url string")
    return [tuple(r)[1:] for r in sorted(urls.filter_urls(df, **options).collect())]


def test_hosts_paths_and_rules_as_by_hand(spark):
    rng = random.Random(1)
    parts = ["http", "https://", "://", "www.", "m.", "example", ".com", ".net", "/", "/en/", "/es/", "/fr", "?a=/b", "#c", "casino", "-", "EXAMPLE.Com", "é", "com", "x", ":80", "user@"]
    addresses = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 8))) for _ in range(500)] + ["https://www.example.com/en/1", "http://a.net/es/", "http://com/", None, ""]
    for address, (url, host, path, rule, verdict) in zip(addresses, judged(spark, addresses)):
        expected_host, expected_path, best = brute(address)
        assert (url, host, path, rule) == (address, expected_host, expected_path, best and best[0])
        if best:
            assert verdict == best[1]
        elif not host:
            assert verdict == "allow"


def test_word_rules_want_whole_words(spark):
    addresses = ["http://m.casino-win.example.org/a", "http://casinos.example.org/a", "http://my.free-bets.org", "http://freebets.org", "http://a.org/casino", "http://casino.com/"]
    assert [r[-1] for r in judged(spark, addresses)] == ["block", "allow", "block", "allow", "allow", "allow"]


def test_a_rule_is_fetched_by_its_rarest_token(spark):
    targets = spark.createDataFrame([("a.com/en/",), ("b.com/en/",), ("c.com/x",), ("example.com/en/",)], "target string")
    index = {r["name"]: r["token"] for r in urls.rule_index(targets, "target", urls.NAMED_RULES).collect()}
    assert index["example.com/en/"] == "example" and index["com/"] == "com"


def test_repeated_rows_clashing_names_and_empty_tables(spark):
    df = spark.createDataFrame([("http://a.com/", "x", None), ("http://a.com/", "x", None), (None, "y", 1)], "url string, host string, rule int")
    out = urls.filter_urls(df)
    assert out.columns == ["url", "host", "rule", "host_", "path", "rule_", "verdict"]
    assert sorted((r["host"], r["host_"], r["rule_"] or "") for r in out.collect()) == [("x", "a.com", "com/"), ("x", "a.com", "com/"), ("y", "", "")]
    assert urls.filter_urls(df.where("false")).collect() == []
    assert {r["verdict"] for r in urls.filter_urls(df, rules=()).collect()} == {"allow"}
    with pytest.raises(ValueError):
        urls.filter_urls(df, rules=[urls.Rule("x+", (), "block")])
