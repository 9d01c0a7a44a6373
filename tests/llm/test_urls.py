"""URL filter against a plain loop over all rules."""

import random

import pytest

from reviewlake.llm import urls


def plain(url, rules, otherwise="allow"):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = rest
    for mark in "/?#":
        host = host.partition(mark)[0]
    path = rest[len(host):].partition("?")[0].partition("#")[0]
    host = "".join(c.lower() if c < "\x80" else c for c in host)
    fits = [(-len(h + p), h + p, v) for h, p, v in rules
            if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = min(fits) if fits else (0, None, otherwise)
    return host, path, best[1], best[2]


@pytest.mark.parametrize("limit", [1 << 20, 60])
def test_against_all_rules(spark, limit):
    random.seed(4)
    names = ["net", "org", "example.net", "a.example.net", "b.org", "Ünicode.org", ""]
    paths = ["/", "/en/", "/en", "/de/x", "", "/é"]
    rules = list({(h, p): (h, p, random.choice(["allow", "block"])) for h in names for p in paths
                  if random.random() < 0.5}.values())
    found = [None, "", "http:/x", "://", "http://", "http://NET", "http://x.Net?q=/en/", "a://b://c.net/x",
             "http://net#a/b", "http://example.net:80/en/", "http://u@b.org/en/" + "y" * 100_000, "\nhttp://b.org/en/"]
    found += [f"http://{random.choice(['', 'www.', 'x'])}{random.choice(names)}{random.choice(paths)}{tail}"
              for tail in ("", "?a", "#b", "z/") for _ in range(40)]
    df = spark.createDataFrame([(at, url, "old") for at, url in enumerate(found)], "page_id long, url string, Rule string")
    table = spark.createDataFrame([(h or None, p, v) for h, p, v in rules], "host string, path string, verdict string")
    rows = urls.filter_urls(df, table, rule_bytes=limit).collect()
    assert len(rows) == len(found)
    for row in rows:
        assert (row.host, row.path, row.rule, row.verdict) == plain(found[row.page_id], rules), found[row.page_id]


def test_digest_collisions_are_confirmed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(urls, "key_of", lambda rule: len(rule) % 2)
    file = tmp_path / "rules"
    file.write_bytes(urls.RuleTable.pack([("net", "/", "block"), ("org", "/", "allow"), ("com", "/a", "block")]))
    found, verdicts = urls.RuleTable(str(file)).judge(["org", "edu", "net"], ["/", "/", "/"], "none")
    assert found == ["org/", None, "net/"] and verdicts == ["allow", "none", "block"]


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")] * 2, "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [row.verdict for row in urls.filter_urls(pages, none).collect()] == ["allow", "allow"]
    assert urls.filter_urls(pages.limit(0), none).count() == 0


def test_hosts_of_many_labels_take_constant_memory(spark):
    table = urls.RuleTable.__new__(urls.RuleTable)
    table.lengths, table.host_lengths = [1, 4], [0, 3, 11]
    host = "a." * 100_000 + "example.net"
    assert table.candidates(host, "/en/") == ["example.net/en/", "example.net/", "net/en/", "/en/", "net/", "/"]
    assert table.candidates("anet", "/x") == ["/"] and table.candidates("", "/x") == ["/"]
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, f"http://{host}/en/")], "page_id long, url string")
    assert [row.rule for row in urls.filter_urls(pages, rules).collect()] == ["net/"]
