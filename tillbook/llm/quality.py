"""Quality rules: one table of thresholds, compiled into one projection of built-in expressions.

Nothing is shuffled, and no row leaves the JVM. Null and empty texts have no words and fail the
base rule; null ids are kept as they are; repeated rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.llm.text import WORD_CHAR_CLASS, whole_rows, words

SYMBOLS = "#*$%&|<>"

# Frequent function words of the corpus's four languages, in small letters. A text
# set all in capitals therefore has none, which is meant.
STOP_WORDS = (
    "the of and to in a is that for it on was as with be by are this at an from "
    "der die und das den von zu mit sich des auf ist ein eine nicht für im dem "
    "le la les de et en un une des que est dans pour qui par sur au pas "
    "el los las del que y en un una por con no se su para es al lo"
).split()

# Measure: (lowest, highest) value that passes; None leaves that side open. The base rule asks
# for 50 words, so the ratios rest on enough of them.
THRESHOLDS: Mapping[str, tuple[float | None, float | None]] = {
    "mean_word_chars": (2.0, 15.0),
    "symbols_per_word": (None, 0.3),
    "stop_word_share": (0.02, None),
    "dup_line_share": (None, 0.5),
    "repeat_word_share": (None, 0.5),
}
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _line_measures(text: Column) -> tuple[Column, Column]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CHAR_CLASS))
    return F.size(lines), F.size(lines) - F.size(F.array_distinct(lines))


def _repeat_words(hashed: DataFrame) -> DataFrame:
    """``hashed`` with ``hashes`` replaced by ``n_repeat_words``: words inside three-word windows
    found twice or more.

    ``hashes`` has a 64-bit hash for each window. Texts without a repeated one, which a hash set
    tells, skip the sort. Otherwise equal hashes stand side by side after it, and a window at
    ``p`` adds as many of its three words as the next repeated window leaves to it.
    """
    others = [c for c in hashed.columns if c != "hashes"]
    h = F.col("hashes")
    pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    repeats = F.size(h) > F.size(F.array_distinct(h))
    # Each step is a projection of its own, so that none is computed twice.
    placed = hashed.select(*others, F.when(repeats, F.sort_array(pairs)).alias("placed"))
    before = F.slice("placed", 1, F.size("placed") - 1)
    after = F.slice("placed", 2, F.size("placed"))
    equal = F.filter(
        F.arrays_zip(before.alias("a"), after.alias("b")), lambda p: p["a"]["h"] == p["b"]["h"]
    )
    ends = F.flatten(F.transform(equal, lambda p: F.array(p["a"]["i"], p["b"]["i"])))
    marked = placed.select(*others, F.sort_array(F.array_distinct(ends)).alias("places"))
    steps = F.zip_with(
        "places",
        F.slice("places", 2, F.size("places")),
        lambda p, q: F.least(F.lit(3), F.coalesce(q - p, F.lit(3))),
    )
    total = F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)
    return marked.select(*others, F.coalesce(total, F.lit(0)).alias("n_repeat_words"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the input row) with the counts that the rules are made of."""
    column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    n_lines, n_dup_lines = _line_measures(column)
    split = whole_rows(
        docs,
        words=words(column),
        n_symbols=F.length(F.regexp_replace(column, f"[^{SYMBOLS}]++", "")),
        n_lines=n_lines,
        n_dup_lines=n_dup_lines,
    )
    w = F.col("words")
    stop = F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS)))
    windows = F.greatest(F.size(w) - 2, F.lit(0))
    triples = F.arrays_zip(*(F.slice(w, i, windows).alias(f"w{i}") for i in (1, 2, 3)))
    hashed = split.select(
        "row",
        F.size(w).alias("n_words"),
        F.length(F.array_join(w, "")).alias("word_chars"),
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        stop.alias("n_stop_words"),
        F.transform(triples, lambda t: F.xxhash64(t)).alias("hashes"),
    )
    counts = _repeat_words(hashed)
    return counts.select("row", *(F.col(c).cast("long").alias(c) for c in counts.columns[1:]))


def _ratios() -> dict[str, Column]:
    n_words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "mean_word_chars": F.col("word_chars") / n_words,
        "symbols_per_word": F.col("n_symbols") / n_words,
        "stop_word_share": F.col("n_stop_words") / n_words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_word_share": F.col("n_repeat_words") / n_words,
    }


def _within(ratio: Column, bounds: tuple[float | None, float | None]) -> Column:
    low, high = bounds
    tests = [ratio >= low] if low is not None else []
    tests += [ratio <= high] if high is not None else []
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def judge(
    docs: DataFrame,
    text: str = "text",
    thresholds: Mapping[str, tuple[float | None, float | None]] = THRESHOLDS,
) -> DataFrame:
    """``row``, its counts, ``base_failed``, and ``kept``: base and all thresholds passed."""
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    ratios = _ratios()
    passed = reduce(lambda a, b: a & b, (_within(ratios[k], v) for k, v in thresholds.items()))
    measured = measure(docs, text)
    return measured.select("*", failed.alias("base_failed"), (~failed & passed).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that pass, with their own columns.

    A filter on ``kept`` alone would be moved below the projections, and its expressions then
    computed again for every use; one that also asks for the row's place stays where it is.
    """
    placed = judge(docs).select("row", "kept", F.monotonically_increasing_id().alias("place"))
    return placed.filter("kept AND place >= 0").select("row.*")


def op5(docs: DataFrame) -> DataFrame:
    """One row per document with its counts and verdict."""
    return judge(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def _bound_sql(name: str, bounds: tuple[float | None, float | None]) -> str:
    low, high = bounds
    tests = [f"{name} >= {low}"] if low is not None else []
    tests += [f"{name} <= {high}"] if high is not None else []
    return " AND ".join(tests) or "true"


OP5_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT r, doc_id, text,
    list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM texts
), windows AS (
  SELECT r, unnest(generate_series(1, len(w) - 2)) AS i, w FROM split WHERE len(w) >= 3
), grams AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM windows
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM repeated, (VALUES (0), (1), (2)) AS t(k) GROUP BY r
), counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^{SYMBOLS}]', '', 'g'))::BIGINT AS n_symbols,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    len(list_filter(w, lambda x: x IN ({", ".join(f"'{x}'" for x in STOP_WORDS)}))) AS n_stop_words,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (r)
), ratios AS (
  SELECT *, word_chars / greatest(n_words, 1) AS mean_word_chars,
    n_symbols / greatest(n_words, 1) AS symbols_per_word,
    n_stop_words / greatest(n_words, 1) AS stop_word_share,
    n_dup_lines / greatest(n_lines, 1) AS dup_line_share,
    n_repeat_words / greatest(n_words, 1) AS repeat_word_share,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(_bound_sql(k, v) for k, v in THRESHOLDS.items())} AS kept
FROM ratios
"""
