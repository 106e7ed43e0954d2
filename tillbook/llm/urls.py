"""URL filters: fixed host and path rules, and association rules mined from labelled pages.

A mined rule is at most ``MAX_ITEMS`` URL tokens; it blocks the URLs that have them all. It needs
``MIN_PAGES`` bad labelled pages, however many pages there are, and a share of ``MIN_CONFIDENCE``
of bad ones among its labelled pages. Spark's FP-growth finds the token combinations that are
frequent on bad pages, and those are counted again on all labelled pages. Rules match by an
inverted index: each is listed under its rarest token, joined to the distinct URLs that have it,
and holds if the URL has all its tokens. Everything is built-in expressions and Spark's own miner;
a URL that very many pages share is judged once.

FP-growth lists 2 to the number of a basket's tokens combinations, so baskets are made small first,
which loses no rule. Left out are tokens on too few bad pages, tokens that are a rule alone (with
more tokens they match nothing more), and tokens on every page. Tokens on the very same labelled
pages are mined as one and stand for each other in a match. What is still wide is dealt to groups
of tokens, and each ``MAX_ITEMS`` groups of a basket are mined as a basket of their own: every
combination that a rule may be is in one of them, and counting on whole pages follows.

Small or missing label tables give no rules, and pages without a fixed rule are then allowed. Null
URLs, and those without ``://``, have an empty host and path, no fixed rule and no tokens. Repeated
pages are judged like others.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.staging import stage

BLOCK, ALLOW = "block", "allow"
MIN_PAGES = 10
MIN_CONFIDENCE = 0.6
MAX_ITEMS = 3
# Baskets of more tokens are mined in groups of their tokens, of about so many together.
WIDE = 15
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """Pages of a host and its subdomains whose path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed values of the test query.
RULES = (
    Rule("net", "/", BLOCK),
    Rule("example.net", "/en/", ALLOW),
    Rule("example.com", "/de/", BLOCK),
    Rule("org", "/fr/", ALLOW),
)


def host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, ``A-Z`` lower-cased."""
    return F.translate(_part(url, 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """From the host's end to ``?``, ``#`` or the end."""
    return _part(url, 2)


def _part(url: Column, group: int) -> Column:
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.coalesce(F.regexp_extract(url, parts, group), F.lit(""))


def _fits(rule: Rule) -> Column:
    own = (F.col("host") == rule.host) | F.endswith("host", F.lit(f".{rule.host}"))
    return own & F.startswith("path", F.lit(rule.path))


def fixed_rule(rules: Sequence[Rule]) -> Column:
    """The longest rule that fits ``host`` and ``path``, as ``name, verdict``; else null.

    Of rules of one length, which can only be for different hosts and paths, blocks come first.
    """
    ranked = sorted(set(rules), key=lambda r: (-len(r.name), r.verdict != BLOCK, r.name))
    found = [
        F.when(
            _fits(rule),
            F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict")),
        )
        for rule in ranked
    ]
    return F.coalesce(*found, F.lit(None).cast("struct<name: string, verdict: string>"))


def tokens(url: Column) -> Column:
    """Distinct tokens in order: labels of the host, path segments (digits as 0), query keys."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    segments = F.regexp_replace(path(url), "[0-9]+", "0")

    def named(kind: str, parts: Column) -> Column:
        return F.transform(
            F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(f"{kind}:"), p)
        )

    keys = F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))
    all_tokens = F.concat(
        named("host", F.split(host(url), r"\.")),
        named("path", F.split(segments, "/")),
        named("query", keys),
    )
    known = F.when(F.instr(url, "://") > 0, F.array_sort(F.array_distinct(all_tokens)))
    return F.coalesce(known, F.array().cast("array<string>"))


class Mined(NamedTuple):
    """Rules as ``items, anchor``, and ``token, item``: which tokens stand for an item of a rule."""

    rules: DataFrame
    names: DataFrame


def mine_rules(labelled: DataFrame) -> Mined:
    """The rules whose URLs are bad. ``labelled`` has ``url, bad``.

    A rule that holds all items of another one may be left out; it matches nothing more. An
    ``anchor`` is the rarest item of a rule among labelled pages.
    """
    baskets = stage(
        labelled.filter("bad IS NOT NULL")
        .select(tokens(F.col("url")).alias("tokens"), F.col("bad").cast("long").alias("bad"))
        .groupBy("tokens")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")),
        "baskets",
    )
    names = stage(_named_items(baskets), "items")
    single = names.filter("token = item")
    alone = single.filter("is_rule").select(F.array("item").alias("items"), F.col("item").alias("anchor"))
    pages = stage(_item_baskets(baskets, names.filter("NOT is_rule AND NOT everywhere")), "pages")
    several = _counted(_frequent(pages), pages, single)
    rules = stage(alone.unionByName(several), "rules")
    return Mined(rules, names.select("token", "item"))


def _is_rule() -> Column:
    bad = F.col("bad")
    return (bad >= MIN_PAGES) & (bad >= MIN_CONFIDENCE * F.col("n"))


def _named_items(baskets: DataFrame) -> DataFrame:
    """``token, item, n, bad, is_rule, everywhere`` of the tokens on enough bad pages.

    Tokens on the same baskets have the same ``item``, the first of them. Baskets are told apart
    by sums of two 64-bit hashes of each.
    """
    hashes = [F.xxhash64("tokens", F.lit(i)).cast("decimal(38,0)").alias(f"h{i}") for i in (0, 1)]
    single = (
        baskets.select(F.explode("tokens").alias("token"), "n", "bad", *hashes)
        .groupBy("token")
        .agg(*(F.sum(c).alias(c) for c in ("n", "bad", "h0", "h1")))
        .filter(F.col("bad") >= MIN_PAGES)
    )
    total = baskets.agg(F.sum("n")).first()[0] or 0
    same = Window.partitionBy("n", "bad", "h0", "h1")
    return single.select(
        "token",
        F.min("token").over(same).alias("item"),
        "n",
        "bad",
        _is_rule().alias("is_rule"),
        (F.col("n") == total).alias("everywhere"),
    )


def _item_baskets(baskets: DataFrame, names: DataFrame) -> DataFrame:
    """``items, n, bad``: what baskets have of the named items, equal ones together."""
    return (
        baskets.select(F.xxhash64("tokens").alias("h"), "n", "bad", F.explode("tokens").alias("token"))
        .join(names.select("token", "item"), "token")
        .groupBy("h")
        .agg(
            F.array_sort(F.collect_set("item")).alias("items"),
            F.first("n").alias("n"),
            F.first("bad").alias("bad"),
        )
        .groupBy("items")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    )


def _narrow(pages: DataFrame, widest: int) -> DataFrame:
    """Baskets of about ``WIDE`` items at most, in one of which each small combination is."""
    n_groups = -(-MAX_ITEMS * widest // WIDE)
    chosen = [list(c) for c in combinations(range(n_groups), MAX_ITEMS)]

    def of_groups(groups: list[int]) -> Column:
        return F.filter("items", lambda item: F.pmod(F.xxhash64(item), F.lit(n_groups)).isin(groups))

    return pages.select(F.explode(F.array(*map(of_groups, chosen))).alias("items"), "bad")


def _frequent(pages: DataFrame) -> DataFrame:
    """``items``, sorted, of two to ``MAX_ITEMS`` that may be on ``MIN_PAGES`` bad pages."""
    bad = pages.filter((F.col("bad") > 0) & (F.size("items") > 1))
    widest = bad.agg(F.max(F.size("items"))).first()[0] or 0
    if widest > WIDE:
        bad = _narrow(bad, widest).filter(F.size("items") > 1)
    # A basket counts as often as it has bad pages; more than are needed make no difference.
    times = F.sequence(F.lit(1), F.least("bad", F.lit(MIN_PAGES)))
    rows = stage(bad.select("items", F.explode(times).alias("copy")).select("items"), "bad-pages")
    n = rows.count()
    if n < MIN_PAGES:
        return rows.filter("false")
    # FP-growth rounds the support that it needs up to whole pages.
    miner = FPGrowth(itemsCol="items", minSupport=(MIN_PAGES - 0.5) / n, minConfidence=1.0)
    found = miner.fit(rows).freqItemsets
    return (
        found.filter(F.size("items").between(2, MAX_ITEMS))
        .select(F.array_sort("items").alias("items"))
        .distinct()
    )


def _counted(candidates: DataFrame, pages: DataFrame, single: DataFrame) -> DataFrame:
    """The rules among combinations of items, counted on all labelled pages."""
    anchored = stage(
        candidates.select("items", F.explode("items").alias("item"))
        .join(single.select("item", "n"), "item")
        .groupBy("items")
        .agg(F.min(F.struct("n", "item")).alias("rarest"))
        .select("items", F.col("rarest.item").alias("anchor")),
        "candidates",
    )
    postings = pages.select(F.explode("items").alias("anchor"), F.col("items").alias("page"), "n", "bad")
    return (
        anchored.join(postings, "anchor")
        .filter(F.size(F.array_except("items", "page")) == 0)
        .groupBy("items", "anchor")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        .filter(_is_rule())
        .select("items", "anchor")
    )


def matched(urls: DataFrame, mined: Mined) -> DataFrame:
    """The distinct ``url`` of ``urls`` that some rule holds for."""
    needed = mined.rules.select(F.explode("items").alias("item")).distinct()
    names = mined.names.join(needed, "item")
    own = urls.select("url").distinct().select("url", F.explode(tokens(F.col("url"))).alias("token"))
    held = own.join(names, "token").groupBy("url").agg(F.collect_set("item").alias("held"))
    postings = held.select("url", "held", F.explode("held").alias("anchor"))
    holds = F.size(F.array_except("items", "held")) == 0
    return postings.join(mined.rules, "anchor").filter(holds).select("url").distinct()


def judge(pages: DataFrame, labelled: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of each page (``page_id, url``)."""
    url = F.col("url")
    placed = (
        pages.select("page_id", "url", host(url).alias("host"), path(url).alias("path"))
        .select("*", fixed_rule(rules).alias("fixed"))
    )
    open_urls = placed.filter("fixed IS NULL AND url IS NOT NULL")
    bad = matched(open_urls, mine_rules(labelled)).select(F.col("url").alias("bad_url"))
    judged = placed.join(bad, (F.col("url") == F.col("bad_url")) & F.col("fixed").isNull(), "left")
    mined = F.when(F.col("bad_url").isNotNull(), BLOCK).otherwise(ALLOW)
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("fixed.name").alias("rule"),
        F.coalesce("fixed.verdict", mined).alias("verdict"),
    )


def label_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``url, bad`` of pages whose document is labelled: bad is low quality, or toxic.

    A page names its document by the number that ends its path, whatever query or fragment
    follows; an extension and slashes may come after it. Several labels of one document are one,
    bad if any is.
    """
    number = F.regexp_extract(path(F.col("url")), "/([0-9]+)[^/0-9]*/*$", 1)
    named = pages.select("url", number.try_cast("bigint").alias("d"))
    known = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("bad")
    )
    return named.join(known, F.col("d") == F.col("doc_id")).select("url", "bad")


def op9(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per page with its verdict."""
    return judge(pages, label_pages(pages, labels))


def _sql_fits(rule: Rule) -> str:
    return (
        f"(host = '{rule.host}' OR suffix(host, '.{rule.host}')) AND starts_with(path, '{rule.path}')"
    )


def _sql_case(column: str) -> str:
    ranked = sorted(RULES, key=lambda r: (-len(r.name), r.verdict != BLOCK, r.name))
    whens = " ".join(f"WHEN {_sql_fits(r)} THEN '{getattr(r, column)}'" for r in ranked)
    return f"CASE {whens} END"


# Mining by brute force: every combination of up to MAX_ITEMS tokens of a labelled page.
OP9_SQL = f"""
WITH placed AS (
  SELECT page_id, url,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
  FROM pages
), parts AS (
  SELECT page_id, url, host, path, list_concat(
    list_transform(list_filter(string_split(host, '.'), lambda p: p <> ''), lambda p: 'host:' || p),
    list_transform(list_filter(string_split(regexp_replace(path, '[0-9]+', '0', 'g'), '/'), lambda p: p <> ''), lambda p: 'path:' || p),
    list_filter(list_transform(string_split(regexp_extract(coalesce(url, ''), '^[^?#]*\\?([^#]*)', 1, 's'), '&'),
      lambda p: 'query:' || split_part(p, '=', 1)), lambda p: p <> 'query:')
  ) AS all_tokens
  FROM placed
), tokens AS (
  SELECT page_id, url, host, path,
    CASE WHEN contains(coalesce(url, ''), '://') THEN list_sort(list_distinct(all_tokens)) ELSE [] END AS t
  FROM parts
), known AS (
  SELECT doc_id, bool_or(quality = 0 OR coalesce(toxic, 0) = 1) AS bad FROM labels GROUP BY doc_id
), baskets AS (
  SELECT row_number() OVER () AS r, t, bad
  FROM (SELECT t, try_cast(regexp_extract(path, '/([0-9]+)[^/0-9]*/*$', 1) AS BIGINT) AS d FROM tokens)
  JOIN known ON d = doc_id WHERE bad IS NOT NULL
), items AS (
  SELECT r, bad, unnest(t) AS item FROM baskets
), combinations AS (
  SELECT [item] AS items, bad FROM items
  UNION ALL
  SELECT [a.item, b.item], a.bad FROM items a JOIN items b ON a.r = b.r AND a.item < b.item
  UNION ALL
  SELECT [a.item, b.item, c.item], a.bad FROM items a JOIN items b ON a.r = b.r AND a.item < b.item
    JOIN items c ON b.r = c.r AND b.item < c.item
), rules AS (
  SELECT items FROM combinations GROUP BY items
  HAVING count(*) FILTER (bad) >= {MIN_PAGES} AND count(*) FILTER (bad) >= {MIN_CONFIDENCE} * count(*)
), bad AS (
  SELECT DISTINCT url AS bad_url FROM tokens JOIN rules ON list_has_all(t, items)
)
SELECT page_id, host, path, {_sql_case("name")} AS rule,
  coalesce({_sql_case("verdict")}, CASE WHEN bad_url IS NULL THEN '{ALLOW}' ELSE '{BLOCK}' END) AS verdict
FROM tokens LEFT JOIN bad ON url = bad_url
"""
