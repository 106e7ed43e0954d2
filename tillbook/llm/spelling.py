"""Spelling variants of frequent words by asymmetric chunks.

Two words are near if one inserted, deleted or replaced letter turns one into the other. The
shorter word of a pair (the first in the alphabet, if equally long) contributes two disjoint
chunks, its halves; the longer one contributes its positional grams of that size. One edit
leaves one half whole, at its place or shifted by the difference of the lengths, which is one at
most; of all grams only those at that place can match, so only they are sent. What the other
half has become is found the same way: of its two disjoint chunks one is whole. So a key is a
half and a quarter of a word, and a frequent beginning or ending makes no large group: the words
of one key differ in one quarter only. What meets is verified, and met pairs are made distinct.

Null texts have no words. A row without an id loses no letter. Repeated rows are counted again,
and words of any length are kept whole. An empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.staging import stage

RUN = r"[A-Za-zÀ-ÿ]++"
MIN_LETTERS = 6
MIN_COUNT = 5
# A form is at least so many times as frequent as the word that it is the form of.
FORM_RATIO = 5
# One word in so many, by its document, loses a letter: the planted misspellings of the query.
TYPO_EVERY = 199


def small_letters(word: Column) -> Column:
    """A to Z in lower case, all other letters as they are."""
    plain = F.length(word) == F.octet_length(word)
    return F.when(plain, F.lower(word)).otherwise(
        F.translate(word, string.ascii_uppercase, string.ascii_lowercase)
    )


def letter_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, run`` for every maximal run of letters, in lower case."""
    found = F.regexp_extract_all(F.col("text"), F.lit(RUN), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run")).select(
        "doc_id", small_letters(F.col("run")).alias("run")
    )


def misspelt(runs: DataFrame, every: int = TYPO_EVERY) -> DataFrame:
    """``word``: each run, without one letter where the hash of document and run says so."""
    hashed = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")))
    cut = runs.select("run", hashed.alias("h"))
    place = F.pmod("h", F.length("run")).cast("int")
    left_out = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    return cut.select(
        F.when(F.col("h") % every == 0, left_out).otherwise(F.col("run")).alias("word")
    )


def frequent_words(
    words: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT
) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    return (
        words.filter(F.length("word") >= min_letters)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_count)
    )


def _keys(word: Column, length: Column) -> Column:
    """The four keys of a word as one of ``length`` letters: its ends around each quarter.

    A word one letter longer than ``length`` has the same ends, the back one shifted by one.
    """
    half = F.floor(length / 2).cast("int")
    front, back = F.floor(half / 2).cast("int"), half + F.floor((length - half) / 2).cast("int")
    quarters = ((F.lit(0), front), (front, half), (half, back), (back, length))
    return F.array(
        *(
            F.concat_ws(
                " ",
                F.lit(str(i)),
                length.cast("string"),
                F.left(word, start),
                F.right(word, length - end),
            )
            for i, (start, end) in enumerate(quarters)
        )
    )


def near_pairs(words: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of near words of ``word, n``, once."""
    word, letters = F.col("word"), F.length("word")
    chunks = words.select(
        word.alias("a"),
        F.col("n").alias("a_n"),
        letters.alias("a_letters"),
        F.explode(_keys(word, letters)).alias("key"),
    )
    # As the longer word of a pair, and as one of two equally long ones.
    sizes = F.filter(F.array(letters - 1, letters), lambda size: size >= min_letters)
    grams = (
        words.select("word", "n", F.explode(sizes).alias("size"))
        .select(
            word.alias("b"),
            F.col("n").alias("b_n"),
            "size",
            F.explode(_keys(word, F.col("size"))).alias("key"),
        )
    )
    met = chunks.join(grams, "key").filter(
        (F.length("b") > F.col("a_letters")) | (F.col("a") < F.col("b"))
    )
    verified = met.filter(F.levenshtein("a", "b", 1) == 1)
    return verified.select("a", "a_n", "b", "b_n").distinct()


def forms(words: DataFrame, pairs: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n``: each word's most frequent near word, if far more frequent."""
    both = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
                F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
            )
        ).alias("p")
    ).select("p.*")
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best"),
    )
    large = -F.col("best.minus_n") >= ratio * F.col("n")
    return words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(large, F.col("best.near")).alias("form"),
        F.when(large, -F.col("best.minus_n")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """``word, root`` of every word with a form, by following forms to the last.

    Every round doubles the steps that ``root`` is away, and a form's count grows by the ratio
    with each step, so rounds are the logarithm of the logarithm of the largest count.
    """
    steps = stage(
        formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms"
    )
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        doubled = stage(
            steps.join(onward, "root", "left").select(
                "word",
                F.coalesce("next", "root").alias("root"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "roots",
        )
        steps = doubled.select("word", "root")
        if doubled.filter("moved").isEmpty():
            return steps


def variants(
    words: DataFrame,
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    ratio: int = FORM_RATIO,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the frequent words in a column ``word``."""
    frequent = stage(frequent_words(words, min_letters, min_count), "words")
    formed = stage(forms(frequent, near_pairs(frequent, min_letters), ratio), "formed")
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11(docs: DataFrame) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return variants(misspelt(letter_runs(docs)))
