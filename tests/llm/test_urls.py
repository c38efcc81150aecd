from __future__ import annotations

import fixtures
from tallyforge.llm import urls

PAGES = "page_id long, url string, host string, token string, bad string"
LABELS = "doc_id long, quality int, toxic int, id string"


def pages(spark, rows):
    return spark.createDataFrame([(*row, "x", "x", "x") for row in rows], PAGES)


def labels(spark, rows):
    return spark.createDataFrame([(*row, "x") for row in rows], LABELS)


def test_host_path_and_fixed_rules(spark):
    rows = [
        (1, "HTTP://Www.Example.NET/en/x?a=1&b=2#f"),
        (2, None),
        (3, "no scheme"),
        (4, "https://net"),
        (5, "https://net/"),
        (6, "http://a.org/fr/x"),
        (7, "http://b?q=http://c.net/"),
        (None, "http://x.y.net/De"),
        (8, "http://EXAMPLE.com/de/1"),
        (8, "http://EXAMPLE.com/de/1"),
        (9, "http://notexample.com/de/1"),
        (10, "http://É.net/#x"),
        (11, ""),
    ]
    got = urls.url_report(pages(spark, rows), labels(spark, [])).collect()
    expected = [
        (1, "www.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "", "", None, "allow"),
        (3, "", "", None, "allow"),
        (4, "net", "", None, "allow"),
        (5, "net", "/", "net/", "block"),
        (6, "a.org", "/fr/x", "org/fr/", "allow"),
        (7, "b", "", None, "allow"),
        (None, "x.y.net", "/De", "net/", "block"),
        (8, "example.com", "/de/1", "example.com/de/", "block"),
        (8, "example.com", "/de/1", "example.com/de/", "block"),
        (9, "notexample.com", "/de/1", None, "allow"),
        (10, "É.net", "/", "net/", "block"),
        (11, "", "", None, "allow"),
    ]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert urls.url_report(pages(spark, []), labels(spark, [(1, 0, 0)])).collect() == []


def mined_tables(spark):
    """Pages of one shop are bad in its /win/ directory only; other hosts have that directory too."""
    rows, marks = [], []
    for k in range(400):
        host, directory = ("shop", "other", "third")[k % 3], ("win", "info")[(k // 3) % 2]
        rows.append((k, f"http://www.{host}.com/{directory}/{k}?ref=x"))
        if k % 2 or k < 200:
            marks.append((k, 0 if (host, directory) == ("shop", "win") else 1, None))
    return pages(spark, rows), labels(spark, [*marks, (0, 1, None), (9999, 0, 0), (None, 0, 1)])


def test_token_combinations_are_learned(spark):
    table, marks = mined_tables(spark)
    for row in urls.url_report(table, marks).collect():
        assert row.verdict == ("block" if row.host == "www.shop.com" and row.path.startswith("/win/") else "allow")
        assert row.rule is None


def test_rules_are_pruned(spark):
    tokens = urls.url_tokens("url", urls.host_of("url"), urls.path_of("url"))
    table, marks = mined_tables(spark)
    joined = table.join(marks, table.page_id == marks.doc_id).select(tokens.alias("tokens"), (marks.quality == 0).alias("bad"))
    rules = urls.mine_rules(fixtures.scanned(spark, joined)).collect()
    assert rules and all(row.confidence >= urls.MIN_CONFIDENCE for row in rules)
    sets = [set(row.tokens) for row in rules]
    assert all(not (a < b) for a in sets for b in sets) and any("dir:win" in found for found in sets)


def test_matches_equal_brute_force(spark):
    rules = [["a"], ["b", "c"], ["c", "d", "e"], ["x"]]
    rows = [(k, [t for n, t in enumerate("abcde") if k >> n & 1]) for k in range(32)]
    table = spark.createDataFrame([(tokens, 1.0, 1.0) for tokens in rules], "tokens array<string>, confidence double, support double")
    found = urls.matching_rows(spark.createDataFrame(rows, "scan_row long, tokens array<string>"), table).collect()
    expected = {k for k, tokens in rows if any(set(rule) <= set(tokens) for rule in rules)}
    assert sorted(row.scan_row for row in found) == sorted(expected)


def test_rare_tokens_and_pairs_are_learned_at_any_size(spark):
    """25 bad pages each, far under 0.2 % of 30,000: a host, a directory of a host, and words deep in the URL."""
    bad = ["http://bad.com/a/{}", "http://big.com/win/{}", "http://m.casino-win.site{}.com/", "http://h{}.com/a/b/cheap-pills.html", "http://g{}.com/?u=spam"]
    rows = [(n * 100 + k, url.format(k)) for n, url in enumerate(bad) for k in range(25)]
    good = [(1000 + k, f"http://{('big', 'other')[k % 2]}.com/{('win', 'info')[k // 2 % 2] if k % 2 else 'info'}/{k}") for k in range(30_000)]
    unseen = [(50_000 + n, url.format(99)) for n, url in enumerate(bad)]
    marks = [(key, 0, 0) for key, _ in rows] + [(key, 1, 0) for key, _ in good]
    got = urls.url_report(pages(spark, rows + good + unseen), labels(spark, marks)).collect()
    blocked = {row.page_id for row in got if row.verdict == "block"}
    assert blocked == {key for key, _ in rows + unseen}


def test_luck_makes_no_rule(spark):
    """Where most pages are bad, a host of which as many are bad says nothing; one of which all are does."""
    rows = [(k, f"http://h{k % 40}.com/{k}") for k in range(4000)] + [(9000 + k, f"http://bad.com/{k}") for k in range(60)]
    marks = [(k, 0 if k * 7919 % 100 < 62 else 1, 0) for k, _ in rows if k < 9000] + [(9000 + k, 0, 0) for k in range(60)]
    got = urls.url_report(pages(spark, rows), labels(spark, marks)).collect()
    assert {row.host for row in got if row.verdict == "block"} == {"bad.com"}
