from __future__ import annotations

import itertools
import random
import re
from collections import Counter

import duckdb
from compare import duckdb_rows, spark_rows
from pyspark.sql import functions as F

from tillbook.llm import urls

PAGES = "page_id bigint, url string, html string"
LABELS = "doc_id bigint, quality int, toxic int"


def tables(spark, pages, labels):
    page_frame = spark.createDataFrame(pages, PAGES).repartition(2)
    clash = page_frame.selectExpr("*", "'x' AS host", "'y' AS rule", "'z' AS fixed", "'t' AS tokens")
    return clash, spark.createDataFrame(labels, LABELS)


def planted(seed=1):
    """Pages of some hosts and path parts whose documents are mostly bad."""
    r = random.Random(seed)
    pages, labels = [], []
    for i in range(600):
        host = r.choice(["casino-win", "a1", "a2", "a3"])
        section = r.choice(["deals", "news", "en"])
        top = r.choice(["com", "org"])
        url = f"https://{r.choice(['', 'www.', 'm.'])}{host}.example.{top}/{section}/{i}{r.choice(['', '.html', '?ref=x', '#top'])}"
        bad = r.random() < (0.9 if host == "casino-win" or (host, section) == ("a1", "deals") else 0.1)
        pages.append((i, url, "h"))
        if r.random() < 0.7:
            labels.append((i, 0 if bad else 1, r.choice([0, None])))
    labels += [(0, None, None), (None, 0, 0), labels[5], (10**9, 0, 1)]
    pages += [
        (1000, None, None), (1001, "", ""), (1002, "no scheme/en/5", ""), (None, pages[3][1], ""),
        (3, pages[3][1], ""), (1003, "HTTP://WWW.Sub.EXAMPLE.NET/en/1?q", ""), (1004, "http://net/x", ""),
        (1005, "http://planet/x", ""), (1006, "http://x.example.com/de/a#b", ""), (1007, "a://b?c://d/e", ""),
        (1008, "http://x.org/fr/\n1", ""), (1009, "http://net", ""), (1010, "://", ""),
        (1011, "http://x.com/" + "seg/" * 5000, ""), (1012, "http://EXAMPLE.net/EN/1", ""),
    ]
    return pages, labels


def plain(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fitting = [
        r for r in urls.RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return host, path, max(fitting, key=lambda r: len(r.name), default=None)


def test_fixed_rules(spark):
    pages, labels = planted()
    rows = urls.op9(*tables(spark, pages, labels)).collect()
    assert len(rows) == len(pages)
    got = sorted(str((r.page_id, r.host, r.path, r.rule)) for r in rows)
    want = []
    for page_id, url, _ in pages:
        host, path, rule = plain(url)
        want.append(str((page_id, host, path, rule and rule.name)))
    assert got == sorted(want)
    verdicts = {r.rule: r.verdict for r in rows if r.rule}
    assert verdicts == {r.name: r.verdict for r in urls.RULES if r.name in verdicts}


def test_mined_rules_against_sql(spark):
    pages, labels = planted()
    result = urls.op9(*tables(spark, pages, labels))
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    assert spark_rows(result) == duckdb_rows(con, urls.OP9_SQL)
    mined = [r for r in result.collect() if r.rule is None]
    blocked = {r.page_id for r in mined if r.verdict == "block"}
    spam = {r.page_id for r in mined if "casino-win" in r.host}
    assert spam and spam <= blocked
    assert {r.page_id for r in mined if "a2." in r.host}.isdisjoint(blocked)


def test_index_finds_every_rule(spark):
    pages, labels = planted(2)
    page_frame, label_frame = tables(spark, pages, labels)
    mined = urls.mine_rules(urls.label_pages(page_frame, label_frame))
    found = {r.url for r in urls.matched(page_frame, mined).collect()}
    items = [set(r["items"]) for r in mined.rules.collect()]
    names = {r["token"]: r["item"] for r in mined.names.collect()}
    own = page_frame.select("url", urls.tokens(F.col("url")).alias("t")).collect()
    assert items and found == {r.url for r in own if any(i <= {names.get(t) for t in r.t} for i in items)}


def test_labels_by_the_number_that_ends_the_path(spark):
    ends = ["", "/", "//", ".html", ".html/", "?page=2&ref=x", "/?page=2", "#part2", ".html?a=/7", "?q#/9"]
    pages = [(i, f"https://a.com/en/{i}{end}", "h") for i, end in enumerate(ends)]
    others = ["https://a.com/en/x1", "https://a.com/en/1/x", "https://a.com/2024-01-05", "https://a.com?x=/1", None]
    pages += [(100 + i, url, "h") for i, url in enumerate(others)]
    labels = [(i, i % 2, 0) for i in range(len(ends))]
    got = {(r.url, r.bad) for r in urls.label_pages(*tables(spark, pages, labels)).collect()}
    assert got == {(pages[i][1], i % 2 == 0) for i in range(len(ends))}


def test_rules_of_urls_with_numbers_in_the_query(spark):
    pages = [(i, f"https://a{i % 3}.com/en/{i}{['/', '?page=2&ref=x'][i % 2]}", "h") for i in range(60)]
    page_frame, label_frame = tables(spark, pages, [(i, 1 - i % 2, 0) for i in range(60)])
    got = {r.page_id: r.verdict for r in urls.op9(page_frame, label_frame).collect()}
    assert got == {i: ["allow", "block"][i % 2] for i in range(60)}


def least_rules(labelled):
    """Token sets without a smaller rule, by brute force over ``[(tokens, bad)]``."""
    need = urls.MIN_PAGES
    counts = Counter()
    for own, bad in labelled:
        for size in range(1, urls.MAX_ITEMS + 1):
            for items in itertools.combinations(sorted(own), size):
                counts[items, bad] += 1
    rules = {
        frozenset(i) for i, bad in counts
        if bad and counts[i, True] >= need and counts[i, True] / (counts[i, True] + counts[i, False]) >= urls.MIN_CONFIDENCE
    }
    return {i for i in rules if not any(other < i for other in rules)}


def test_rules_by_brute_force(spark, monkeypatch):
    r = random.Random(5)
    labelled = []
    for _ in range(400):
        keys = [f"k{j:02}" for j in range(9) if r.random() < 0.4]
        keys += [f"z{j}" for j in range(r.randint(0, 3))]
        bad = r.random() < (0.9 if {"k01", "k04"} <= set(keys) or {"k02", "k03", "k07"} <= set(keys) else 0.3)
        labelled.append((f"http://h/?{'&'.join(keys)}", bad))
    frame = spark.createDataFrame(labelled, "url string, bad boolean").repartition(3)
    own = [({"host:h", *(f"query:{k}" for k in u.split("?")[1].split("&") if k)}, bad) for u, bad in labelled]
    want = least_rules(own)
    assert max(map(len, want)) > 2
    # Wide baskets are mined in groups of their tokens, with the same rules.
    for wide in (15, 5):
        monkeypatch.setattr(urls, "WIDE", wide)
        got = [frozenset(x["items"]) for x in urls.mine_rules(frame).rules.collect()]
        assert len(got) == len(set(got))
        assert {g for g in got if not any(other < g for other in got)} == want


def test_tokens_on_the_same_pages_stand_for_each_other(spark):
    def url(i):
        twins = "&t1&t2" if i % 2 else ""
        return f"http://h/?k{twins}{'&x' if i % 3 else ''}"

    rows = [(url(i), bool(i % 2 and i % 3)) for i in range(60)]
    mined = urls.mine_rules(spark.createDataFrame(rows, "url string, bad boolean"))
    rules = [set(r["items"]) for r in mined.rules.collect()]
    names = {r["token"]: r["item"] for r in mined.names.collect()}
    assert names["query:t2"] == "query:t1" and rules == [{"query:t1"}] or {"query:t1", "query:x"} in rules
    asked = ["http://o/?t2&x", "http://o/?t1&x", "http://o/?x", "http://o/?k"]
    table = spark.createDataFrame([(u,) for u in asked], "url string")
    assert {r.url for r in urls.matched(table, mined).collect()} == set(asked[:2])


def test_support_is_the_same_at_every_size(spark):
    def found(n_good):
        rows = [(f"http://spam/{i}?bad", True) for i in range(urls.MIN_PAGES)]
        rows += [(f"http://fine{i % 50}/{i}", False) for i in range(n_good)]
        frame = spark.createDataFrame(rows, "url string, bad boolean")
        return {tuple(r["items"]) for r in urls.mine_rules(frame).rules.collect()}

    assert found(30) == found(30_000) and ("host:spam",) in found(30)


def test_many_independent_tokens(spark):
    """Thirty tokens, each on half of the pages: FP-growth alone would list millions of sets."""
    r = random.Random(8)
    rows = []
    for _ in range(300):
        keys = [f"k{j:02}" for j in range(30) if r.random() < 0.5]
        rows.append((f"http://h/?{'&'.join(keys)}", {"k03", "k17", "k21"} <= set(keys) or r.random() < 0.05))
    frame = spark.createDataFrame(rows, "url string, bad boolean").repartition(4)
    own = [({"host:h", *(f"query:{k}" for k in u.split("?")[1].split("&") if k)}, bad) for u, bad in rows]
    got = {frozenset(x["items"]) for x in urls.mine_rules(frame).rules.collect()}
    want = least_rules(own)
    assert frozenset({"query:k03", "query:k17", "query:k21"}) in want
    assert {g for g in got if not any(other < g for other in got)} == want


def test_all_tokens_of_a_page_are_mined(spark):
    # Twelve path segments before the one that tells; and a word among the first ten tokens of bad
    # pages that stands behind them on the many good ones.
    deep = "/".join(f"a{chr(97 + j)}" for j in range(12))
    pages = [(i, f"https://h.com/{deep}/{['ok', 'zz'][i % 2]}/{i}", "h") for i in range(40)]
    late = "&".join(f"a{j:02}" for j in range(12))
    pages += [(100 + i, f"https://g.com/{100 + i}?k", "h") for i in range(20)]
    pages += [(200 + i, f"https://g.com/{200 + i}?{late}&k", "h") for i in range(80)]
    labels = [(i, 1 - (i % 2 if i < 40 else i < 200), 0) for i, _, _ in pages]
    page_frame, label_frame = tables(spark, pages, labels)
    rules = urls.mine_rules(urls.label_pages(page_frame, label_frame))
    assert {frozenset(r["items"]) for r in rules.rules.collect()} == {frozenset({"path:zz"})}
    got = {r.page_id: r.verdict for r in urls.op9(page_frame, label_frame).collect()}
    assert got == {i: "block" if i < 40 and i % 2 else "allow" for i, _, _ in pages}


def test_long_frequent_urls_end_at_pairs(spark):
    def url(i):
        return f"https://h.com/{i}?" + "&".join(f"q{j:03}" for j in range(10 + i % 50))

    frame = spark.createDataFrame([(url(i), i % 3 == 0) for i in range(600)], "url string, bad boolean")
    assert urls.mine_rules(frame).rules.collect() == []


def test_without_labels_or_pages(spark):
    pages, _ = planted()
    page_frame, none = tables(spark, pages, [])
    assert {r.verdict for r in urls.op9(page_frame, none).collect() if r.rule is None} == {"allow"}
    assert urls.op9(page_frame.limit(0), none).collect() == []


def test_no_python(spark):
    pages, labels = planted()
    plan = urls.op9(*tables(spark, pages, labels))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
