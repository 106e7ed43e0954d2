"""Toxicity scores from gradient-boosted trees over dense features, calibrated by isotonic regression.

Three parts of the labelled documents, chosen by a hash of the id, serve three steps, so that
none is judged by what it was fitted on: the first gives a lexicon of words and word beginnings
that stand in toxic documents far more often than in others; trees are grown on the features of
the second; the third maps the trees' probabilities to calibrated scores. Exact copies of a text
count once. Features are densities of strong and weak lexicon words and beginnings, their
nearness to a second-person word, capitals, punctuation, and words that only match the lexicon
once digits and signs in them are read as letters. A text is worked on whole, in parts.

Training takes at most ``TRAINING_ROWS`` labelled documents, those with the smallest hashes of
their ids. Labels that are null are left out, and a document labelled both ways is toxic. Without
labels of both kinds in each part, the score is the share of toxic labels (0 without labels).
Null and empty texts have features of zero and are scored like others. Rows without an id are
scored, and never train. Repeated rows are scored again.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from math import log, log1p

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.staging import stage

# One label in so many, by the hash of its document's id, is held out.
FOLDS = 5
TRAINING_ROWS = 12_000
# Parts of the training rows, in hundredths: lexicon, trees, and the rest for calibration.
LEXICON_PART, TREES_PART = 50, 80
# A term enters the lexicon with this log-odds ratio and likelihood-ratio statistic at least.
WEAK, STRONG, SIGNIFICANT = 1.0, 3.0, 30.0
MAX_TERMS = 20_000
# Lengths of word beginnings.
BEGINNINGS = (4, 5, 6, 7)
NEAR_WORDS = 4
# Texts are read in parts of about so many characters, cut at spaces.
PART_CHARS = 1 << 18
# Words whose place in the lexicon a task remembers.
KNOWN_WORDS = 200_000
TREES, DEPTH, STEP, SEED = 20, 3, 0.3, 7

# Second-person words of English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer eure "
    "tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros tus su".split()
)
# Digits and signs that stand for letters.
_LOOKALIKES = str.maketrans("013457@$!|€", "oieastasiie")
_EDGES = "\"'`´.,;:!?¡¿()[]{}<>*_-–—…«»„“”"
_INNER = re.compile(r"[.\-_*·~'’]+")
_MARKS = re.compile(r"[!?]")
_SIGNS = re.compile(r"[^\w\s]")
_REPEATED = re.compile(r"[!?.*]{2,}")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")

FEATURES = (
    "strong_words", "weak_words", "strong_beginnings", "weak_beginnings", "strong_count",
    "weak_count", "weight", "near_second_person", "second_person", "capital_letters",
    "capital_words", "marks", "signs", "repeated_signs", "disguised", "mixed_words", "stretched",
)


def terms_of(word: str) -> Iterator[str]:
    """A word, and its beginnings marked by a hyphen."""
    yield word
    for n in BEGINNINGS:
        if len(word) > n:
            yield word[:n] + "-"


def _parts(text: str) -> Iterator[str]:
    start = 0
    while start < len(text):
        end = start + PART_CHARS
        if end < len(text):
            end = text.find(" ", end)
            end = len(text) if end < 0 else end
        yield text[start:end]
        start = end


def small_words(text: str) -> list[str]:
    """Words in lower case without signs at their ends; a word of signs only is empty."""
    return [w.strip(_EDGES) for w in text.lower().split()]


class Lexicon:
    """Weights of terms, and what a word is worth by them."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.known: dict[str, tuple[float, float, bool, bool]] = {}

    def _matched(self, word: str) -> tuple[float, float]:
        """The weight of a word and the largest of its beginnings."""
        weights = self.weights
        begun = max((weights.get(word[:n] + "-", 0.0) for n in BEGINNINGS if len(word) > n), default=0.0)
        return weights.get(word, 0.0), begun

    def of(self, word: str) -> tuple[float, float, bool, bool]:
        """``(weight as a word, by its beginning, only when undisguised, mixed with signs)``."""
        found = self.known.get(word)
        if found is None:
            found = self._of(word)
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            if len(word) < 40:
                self.known[word] = found
        return found

    def _of(self, word: str) -> tuple[float, float, bool, bool]:
        whole, begun = self._matched(word)
        mixed = not word.isalpha() and any(c.isalpha() for c in word)
        if mixed and not whole and not begun:
            plain = _INNER.sub("", word.translate(_LOOKALIKES))
            whole, begun = self._matched(plain)
            return whole, begun, whole > 0 or begun > 0, True
        return whole, begun, False, mixed


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The values of ``FEATURES`` for a text."""
    text = text or ""
    n = 0
    words_by = [0, 0]
    begun_by = [0, 0]
    weight = 0.0
    near = second = disguised = mixed = capital_words = 0
    last_hit = last_second = -(1 << 40)
    for part in _parts(text):
        for word in small_words(part):
            n += 1
            if word in SECOND_PERSON:
                second += 1
                last_second = n
                if n - last_hit <= NEAR_WORDS:
                    near += 1
            whole, begun, hidden, signs = lexicon.of(word)
            mixed += signs
            disguised += hidden
            if not whole and not begun:
                continue
            weight += max(whole, begun)
            if whole:
                words_by[whole >= STRONG] += 1
            if begun:
                begun_by[begun >= STRONG] += 1
            if max(whole, begun) >= STRONG:
                last_hit = n
                if n - last_second <= NEAR_WORDS:
                    near += 1
        capital_words += sum(len(w) > 1 and w.isupper() for w in part.split())
    letters = sum(map(str.isalpha, text)) if not text.isascii() else len(re.findall("[A-Za-z]", text))
    capitals = len(re.findall(r"[A-ZÀ-ÖØ-Þ]", text))
    per_word, per_letter, per_char = 1 / max(n, 1), 1 / max(letters, 1), 1 / max(len(text), 1)
    return [
        words_by[1] * per_word,
        words_by[0] * per_word,
        begun_by[1] * per_word,
        begun_by[0] * per_word,
        log1p(max(words_by[1], begun_by[1])),
        log1p(max(words_by[0], begun_by[0])),
        weight * per_word,
        near * per_word,
        second * per_word,
        capitals * per_letter,
        capital_words * per_word,
        len(_MARKS.findall(text)) * per_char,
        len(_SIGNS.findall(text)) * per_char,
        len(_REPEATED.findall(text)) * per_char,
        disguised * per_word,
        mixed * per_word,
        len(_STRETCHED.findall(text)) * per_word,
    ]


def remainder(doc_id: Column) -> Column:
    """The fold of a document; null for one without an id."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """``doc_id, toxic, text, part`` of at most ``rows`` labelled documents, distinct texts only.

    ``part`` is a number from 0 to 99 by the hash of the text, so copies stay in one part.
    """
    chosen = (
        labels.filter(F.col("toxic").isNotNull() & (remainder(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # At most ``rows`` pairs of numbers are broadcast.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    labelled = texts.join(F.broadcast(chosen), "doc_id")
    one = labelled.groupBy(F.xxhash64("text").alias("h")).agg(
        F.min(F.struct("doc_id", "toxic", "text")).alias("row")
    )
    return one.select("row.*", F.pmod("h", F.lit(100)).cast("int").alias("part"))


def _counted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: tuple[Counter, Counter] = Counter(), Counter()
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            words = {w for part in _parts(text) for w in small_words(part) if w.isalpha()}
            counts[bool(toxic)].update({term for word in words for term in terms_of(word)})
    terms = list(counts[0].keys() | counts[1].keys())
    yield pd.DataFrame(
        {
            "term": pd.Series(terms, dtype="object"),
            "clean": pd.Series([counts[0][t] for t in terms], dtype="int64"),
            "toxic": pd.Series([counts[1][t] for t in terms], dtype="int64"),
        }
    )


def _likelihood_ratio(seen: Column, expected: Column) -> Column:
    return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(F.lit(0.0))


def learn_lexicon(rows: DataFrame, max_terms: int = MAX_TERMS) -> dict[str, float]:
    """Weights of at most ``max_terms`` terms, the most telling ones, from labelled texts."""
    totals = rows.agg(
        F.sum(F.col("toxic")).alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
    ).first()
    n_toxic, n_clean = totals["toxic"] or 0, totals["clean"] or 0
    if not n_toxic or not n_clean:
        return {}
    counts = (
        rows.select("text", "toxic")
        .mapInPandas(_counted, "term string, clean bigint, toxic bigint")
        .groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    share = n_toxic / (n_toxic + n_clean)
    both = F.col("toxic") + F.col("clean")
    told = _likelihood_ratio(F.col("toxic"), both * share) + _likelihood_ratio(
        F.col("clean"), both * (1 - share)
    )
    odds = F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5)) - log(
        (n_toxic + 0.5) / (n_clean + 0.5)
    )
    kept = (
        counts.select("term", odds.alias("odds"), told.alias("told"))
        .filter((F.col("odds") >= WEAK) & (F.col("told") >= SIGNIFICANT))
        .orderBy(F.desc("told"), "term")
        .limit(max_terms)
    )
    return {row["term"]: row["odds"] for row in kept.collect()}


def feature_column(spark: SparkSession, text: Column, weights: dict[str, float]) -> Column:
    """The features of a text as an array; the lexicon's size is bounded by ``MAX_TERMS``."""
    sent = spark.sparkContext.broadcast(weights)
    held: dict[str, Lexicon] = {}

    @F.pandas_udf("array<double>")
    def valued(texts: pd.Series) -> pd.Series:
        lexicon = held.setdefault("lexicon", Lexicon(sent.value))
        return pd.Series([np.array(features(t, lexicon)) for t in texts], dtype="object")

    return valued(text)


class Scorer:
    """A lexicon, trees and a calibration, or a constant where labels don't suffice."""

    def __init__(
        self,
        prior: float,
        weights: dict[str, float] | None = None,
        trees: GBTClassificationModel | None = None,
        calibration: IsotonicRegressionModel | None = None,
    ):
        self.prior = prior
        self.weights = weights or {}
        self.trees = trees
        self.calibration = calibration

    def score(self, docs: DataFrame) -> DataFrame:
        """``doc_id, score`` of every document."""
        if self.trees is None or self.calibration is None:
            return docs.select("doc_id", F.lit(self.prior).alias("score"))
        spark = docs.sparkSession
        values = docs.select(
            "doc_id", array_to_vector(feature_column(spark, F.col("text"), self.weights)).alias("features")
        )
        raw = _probability(self.trees, values)
        return self.calibration.transform(raw).select(
            "doc_id", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score")
        )


def _probability(trees: GBTClassificationModel, values: DataFrame) -> DataFrame:
    return trees.transform(values).withColumn(
        "raw", vector_to_array("probability").getItem(1)
    )


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Scorer:
    """A scorer from the labelled documents that are not held out."""
    spark = docs.sparkSession
    labelled = stage(training_rows(docs, labels, rows), "labelled")
    part = F.when(F.col("part") < LEXICON_PART, 0).when(F.col("part") < TREES_PART, 1).otherwise(2)
    seen = labelled.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("toxic").alias("toxic")
    ).collect()
    n = sum(row["rows"] for row in seen)
    prior = sum(row["toxic"] for row in seen) / n if n else 0.0
    if sum(0 < row["toxic"] < row["rows"] for row in seen) < 3:
        return Scorer(prior)
    weights = learn_lexicon(labelled.filter(F.col("part") < LEXICON_PART))
    values = stage(
        labelled.filter(F.col("part") >= LEXICON_PART).select(
            F.col("toxic").cast("double").alias("label"),
            "part",
            feature_column(spark, F.col("text"), weights).alias("values"),
        ),
        "features",
    ).select("label", "part", array_to_vector("values").alias("features"))
    trees = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, maxBins=32
    ).fit(values.filter(F.col("part") < TREES_PART).coalesce(2))
    judged = _probability(trees, values.filter(F.col("part") >= TREES_PART))
    calibration = IsotonicRegression(
        featuresCol="raw", labelCol="label", predictionCol="score"
    ).fit(judged.select("label", "raw").coalesce(1))
    return Scorer(prior, weights, trees, calibration)


def op13(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    table = docs.select("doc_id", "text")
    scored = train(table, labels.select("doc_id", "toxic")).score(table)
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
