"""Personal data: base patterns, and further spans found by weak supervision.

Emails, IP addresses, payment cards and phone numbers follow fixed patterns and are always kept.
Other candidates (secrets, account and identity numbers, names) are voted on by labelers: a strict
format, gazetteers, the words before the span, and its mix of characters. Each may abstain.
Expectation-maximisation estimates how reliable every labeler is from the counts of vote patterns
alone, without labels. Its probabilities train a logistic regression over features of the span,
and spans that this accepts are added.

Everything on documents is a projection of built-in expressions; texts are not shuffled. Votes
and features take few values each, so what is counted over the corpus is one small table of their
combinations (``MAX_CELLS`` at most, by construction), and training weighs those combinations by
all the spans behind them. With no candidates there is no classifier and nothing is added.

Null and empty texts have no spans. Repeated rows and null ids are judged like others. Places
count code points from 0, ends exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.llm.text import whole_rows

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret", "iban", "ssn", "person")
ALL_KINDS = BASE_KINDS + ADDED_KINDS

# The four base patterns, written so that no text makes them slow. Possessive runs
# don't backtrack, and a run is only tried from its start or from the end of the last match (\G).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for the pattern to be tried at all.
_NEEDED = {
    "email": r"@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9][\x20-]?[0-9]",
    "phone": r"\+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# Common given names, words that start a sentence or a title rather than a name, and
# words that announce personal data.
GIVEN_NAMES = (
    "Anna Maria Peter Paul Thomas Michael John James Robert David William Richard Joseph Charles "
    "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Hans Klaus Wolfgang "
    "Jean Pierre Michel Marie Sophie Jose Juan Carlos Luis Carmen Lucia Elena José María Lucía "
    "Christopher Daniel Matthew Anthony Steven Andrew Kenneth George Edward Brian Kevin Nancy Lisa "
    "Margaret Sandra Ashley Emily Donna Michelle Carol Amanda Melissa Deborah Stephanie Rebecca "
    "Jürgen Günter Stefan Andreas Martin Christian Matthias Sabine Petra Monika Ursula Claudia "
    "Katrin Heike Jörg Björn François Jacques Philippe Nicolas Laurent Christophe Nathalie "
    "Isabelle Catherine Françoise Sylvie Véronique Céline Élodie Hélène André René Miguel Antonio "
    "Francisco Manuel Javier Fernando Sergio Alejandro Rafael Pilar Dolores Teresa Cristina Marta "
    "Isabel Rosario Ángel Andrés Jesús Sofía"
).split()
SENTENCE_WORDS = (
    "The Of And To In A Is That For It On Was As With Be By Are This At An From "
    "Der Die Das Und Den Von Zu Mit Auf Ist Ein Eine Nicht Im Le La Les De Et En Un Une Des Que "
    "El Los Las Del Y Por Con No Se Su Para Es Al Lo Dans Pour Qui Par Sur Au Pas"
).split()
TITLES = "Mr Mrs Ms Dr Herr Frau Monsieur Madame Señor Señora Dear Liebe Lieber Signed Name".split()

# Candidates of the added kinds. Their order settles which one a span is.
_NAME = r"\p{Lu}\p{Ll}{1,20}+"
_GIVEN = "(?:" + "|".join(GIVEN_NAMES) + ")(?!\\p{L})"
_NO_NAME = "(?:" + "|".join((*SENTENCE_WORDS, *TITLES)) + ")(?!\\p{L})"
CANDIDATES = {
    # In one piece, or in groups of four.
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)"
    r"(?![A-Za-z0-9])",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
    # Signed tokens of three parts; keys with slashes and plus signs; keys of one run.
    "secret": r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]++)?"
    r"|(?=[A-Za-z0-9/+]{32})(?=[A-Za-z/+]*+[0-9])(?=[a-z0-9/+]*+[A-Z])(?=[A-Z0-9/+]*+[a-z])"
    r"(?=[A-Za-z0-9]*+[/+])[A-Za-z0-9/+]{32,}+={0,2}+"
    r"|(?=[A-Za-z0-9_]{20})(?=[A-Za-z_]*+[0-9])(?=[0-9_]*+[A-Za-z])[A-Za-z0-9_]{20,}+",
    # Two or three names behind any title, from a given name on if there is one.
    "person": rf"(?=\p{{Lu}})(?!{_NO_NAME})(?:(?={_GIVEN})|(?!{_NAME}\x20{_GIVEN})){_NAME}"
    rf"(?:\x20(?!{_NO_NAME}){_NAME}){{1,2}}+(?![\p{{L}}0-9])",
}
CANDIDATE = r"(?<![\p{L}0-9_.+-])(?:" + "|".join(CANDIDATES.values()) + ")"
CONTEXT_CHARS = 24

CUES = {
    "secret": r"(?i)(?:token|secret|api[ _-]?key|key|password|passwd|bearer)[\W_]{0,6}$",
    "iban": r"(?i)(?:iban|account|konto|compte|cuenta)[\W_]{0,6}$",
    "ssn": r"(?i)(?:ssn|social security|id)[\W_]{0,6}(?:number)?[\W_]{0,6}$",
    "person": r"(?i)(?:mr|mrs|ms|dr|herr|frau|name is|named|name|dear|signed)[\W_]{1,4}$",
}
LABELERS = ("format", "gazetteer", "context", "mix")
# Kinds, votes of four labelers, and two shares in four steps.
MAX_CELLS = len(ADDED_KINDS) * 3 ** len(LABELERS) * 4 * 4

EM_ROUNDS = 50
_SMOOTHING = 1.0
_SPAN = "start: int, end: int, found: string, before: string"


def _spans(gaps: Column, found: Column) -> Column:
    """``start, end, found, before`` of matches, from them and the text pieces between them."""
    pieces = F.zip_with(
        F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(g.alias("g"), m.alias("m"))
    )
    nothing = F.struct(
        F.lit(0).alias("place"), F.array().cast(f"array<struct<{_SPAN}>>").alias("spans")
    )

    def step(acc: Column, piece: Column) -> Column:
        start = acc["place"] + F.length(piece["g"])
        end = start + F.length(piece["m"])
        span = F.struct(
            start.alias("start"),
            end.alias("end"),
            piece["m"].alias("found"),
            F.substring(piece["g"], -CONTEXT_CHARS, CONTEXT_CHARS).alias("before"),
        )
        return F.struct(end.alias("place"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    return F.aggregate(pieces, nothing, step, lambda acc: acc["spans"])


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int"))
        .when(d.cast("int") > 4, d.cast("int") * 2 - 9)
        .otherwise(d.cast("int") * 2),
    )
    return F.aggregate(doubled, F.lit(0), lambda acc, d: acc + F.coalesce(d, F.lit(0))) % 10 == 0


def _iban_sum(found: Column) -> Column:
    """The remainder by 97 of an account number's check, with letters as numbers; 1 is right."""
    compact = F.replace(found, F.lit(" "))
    turned = F.concat(F.substr(compact, F.lit(5)), F.left(compact, F.lit(4)))

    def step(acc: Column, c: Column) -> Column:
        letter = F.ascii(c) - F.ascii(F.lit("A"))
        return F.when(letter >= 0, acc * 100 + letter + 10).otherwise(acc * 10 + F.ascii(c) - F.ascii(F.lit("0"))) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def _holds(kind: str, found: Column) -> Column:
    digits = F.length(_digits(found))
    return {
        "email": F.lit(True),
        "ip": found.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
        "card": F.when(digits.between(12, 19), _luhn(_digits(found))).otherwise(False),
        "phone": digits.between(9, 15),
    }[kind]


def _split(rows: DataFrame, names: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``rows`` with a column of spans for each name, found by (needed, pattern) in ``text``."""
    others = rows.columns
    text = F.col("text")
    pieces = rows.select(
        *others,
        *(
            F.when(
                text.rlike(needed),
                F.struct(
                    F.split(text, pattern, -1).alias("gaps"),
                    F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
                ),
            ).alias(name)
            for name, (needed, pattern) in names.items()
        ),
    )
    empty = F.array().cast(f"array<struct<{_SPAN}>>")
    return pieces.select(
        *others,
        *(
            F.coalesce(_spans(F.col(name)["gaps"], F.col(name)["found"]), empty).alias(name)
            for name in names
        ),
    )


def _share_step(part: Column, whole: Column) -> Column:
    """0 to 3: none, up to a third, up to two thirds, more."""
    return F.least(F.lit(3), F.ceil(3 * part / whole)).cast("int")


def _candidate(span: Column) -> Column:
    """A candidate with its kind, votes and shares."""
    found, before = span["found"], span["before"]
    kind = reduce(
        lambda rest, item: F.when(found.rlike(f"^(?:{item[1]})$"), item[0]).otherwise(rest),
        reversed(CANDIDATES.items()),
        F.lit("person"),
    )
    words = F.split(found, " ")
    strict = found.rlike(r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$") | found.rlike(
        r"^(?:(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}|eyJ[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)+)$"
    )
    strict = F.when(kind == "iban", _iban_sum(found) == 1).otherwise(strict)
    cued = reduce(
        lambda rest, item: F.when(kind == item[0], before.rlike(item[1])).otherwise(rest),
        CUES.items(),
        F.lit(False),
    )
    is_person = kind == "person"
    distinct = F.size(F.array_distinct(F.split(found, "")))
    votes = {
        "format": F.when(strict, 1).when(is_person, 0).otherwise(-1),
        "gazetteer": F.when(~is_person, 0)
        .when(F.arrays_overlap(words, F.array(*map(F.lit, GIVEN_NAMES))), 1)
        .otherwise(-1),
        "context": F.when(cued, 1).when(is_person, -1).otherwise(0),
        "mix": F.when(is_person, 0).when(distinct >= 8, 1).otherwise(-1),
    }
    digits = F.length(_digits(found))
    small = F.length(F.regexp_replace(found, "[^a-z]", ""))
    return F.struct(
        span["start"].alias("start"),
        span["end"].alias("end"),
        kind.alias("kind"),
        *(votes[name].alias(name) for name in LABELERS),
        _share_step(digits, F.length(found)).alias("digits"),
        _share_step(small, F.length(found)).alias("small"),
    )


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row, text`` and the array ``candidates`` of each document."""
    rows = whole_rows(docs, text=F.coalesce(F.col(f"`{text}`"), F.lit("")))
    found = _split(rows, {"candidates": (CANDIDATE, CANDIDATE)})
    return found.withColumn("candidates", F.transform("candidates", _candidate))


def estimate(patterns: Mapping[tuple[int, ...], int], rounds: int = EM_ROUNDS) -> dict:
    """The probability of each vote pattern to be personal data, by expectation-maximisation.

    Votes are independent given the truth. A labeler's distribution over -1, 0, 1 is estimated
    for either truth; the first guess is the majority vote.
    """
    probability = {p: 1 / (1 + math.exp(-2.0 * sum(p))) for p in patterns}
    for _ in range(rounds):
        mass = {True: 0.0, False: 0.0}
        votes: dict = {}
        for p, n in patterns.items():
            for truth, share in ((True, probability[p]), (False, 1 - probability[p])):
                mass[truth] += n * share
                for labeler, vote in enumerate(p):
                    key = truth, labeler, vote
                    votes[key] = votes.get(key, 0.0) + n * share
        odds = math.log((mass[True] + _SMOOTHING) / (mass[False] + _SMOOTHING))

        def chance(truth: bool, labeler: int, vote: int, votes=votes, mass=mass) -> float:
            return (votes.get((truth, labeler, vote), 0.0) + _SMOOTHING) / (
                mass[truth] + 3 * _SMOOTHING
            )

        probability = {
            p: 1
            / (
                1
                + math.exp(
                    -max(
                        -30.0,
                        min(
                            30.0,
                            odds
                            + sum(
                                math.log(chance(True, k, v) / chance(False, k, v))
                                for k, v in enumerate(p)
                            ),
                        ),
                    )
                )
            )
            for p in patterns
        }
    return probability


def _features(span: Column) -> list[Column]:
    """Indicators of a candidate's kind, votes and shares."""
    tests = [span["kind"] == kind for kind in ADDED_KINDS]
    tests += [span[name] == vote for name in LABELERS for vote in (-1, 1)]
    tests += [span[name] == step for name in ("digits", "small") for step in (1, 2, 3)]
    return [test.cast("double") for test in tests]


def train(found: DataFrame) -> tuple[list[float], float] | None:
    """Coefficients and intercept of the span classifier; None without candidates.

    ``found`` is what ``candidates`` returns. Only counts of combinations reach the driver.
    """
    cell = ["kind", *LABELERS, "digits", "small"]
    counted = (
        # Without "outer", Spark would add a filter on the number of candidates, and look for them
        # once more in it.
        found.select(F.explode_outer("candidates").alias("c"))
        .filter(F.col("c").isNotNull())
        .groupBy(*(F.col("c")[name].alias(name) for name in cell))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    if not counted:
        return None
    patterns: dict[tuple[int, ...], int] = {}
    for row in counted:
        votes = tuple(row[name] for name in LABELERS)
        patterns[votes] = patterns.get(votes, 0) + row.n
    probability = estimate(patterns)
    weighted = []
    for row in sorted(counted):
        chance = probability[tuple(row[name] for name in LABELERS)]
        for label, weight in ((1.0, row.n * chance), (0.0, row.n * (1 - chance))):
            if weight > 0:
                weighted.append((*(row[name] for name in cell), label, weight))
    spark = found.sparkSession
    schema = "kind string, " + ", ".join(f"{c} int" for c in cell[1:]) + ", label double, weight double"
    table = spark.createDataFrame(weighted, schema).select(
        F.struct(*cell).alias("c"), "label", "weight"
    )
    table = table.select(
        array_to_vector(F.array(*_features(F.col("c")))).alias("features"), "label", "weight"
    ).coalesce(1)
    model = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=100).fit(table)
    return [float(c) for c in model.coefficients], float(model.intercept)


def _accepted(span: Column, model: tuple[Sequence[float], float]) -> Column:
    coefficients, intercept = model
    terms = [
        feature * F.lit(c) for feature, c in zip(_features(span), coefficients, strict=True)
    ]
    return reduce(lambda a, b: a + b, terms, F.lit(intercept)) >= 0


def _named(spans: Column, kind: str) -> Column:
    """Base spans that hold, as ``start, rank, end, kind``."""
    held = F.filter(spans, lambda s: _holds(kind, s["found"]))
    return F.transform(
        held,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(ALL_KINDS.index(kind)).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
        ),
    )


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row, text``, a count for each base kind, and the sorted spans ``base`` and ``spans``.

    Spans may overlap: a secret is listed whole beside a card inside it.
    """
    rows = candidates(docs, text)
    model = train(rows)
    split = _split(rows, {k: (_NEEDED[k], PATTERNS[k]) for k in BASE_KINDS})
    named = split.select(
        "row", "text", "candidates", *(_named(F.col(k), k).alias(k) for k in BASE_KINDS)
    )
    merged = named.select(
        "row",
        "text",
        "candidates",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sort_array(F.concat(*BASE_KINDS)).alias("base"),
    )
    counts = [f"n_{k}" for k in BASE_KINDS]
    if model is None:
        return merged.select("row", "text", *counts, "base", F.col("base").alias("spans"))
    rank = F.create_map(*(F.lit(x) for k in ADDED_KINDS for x in (k, ALL_KINDS.index(k))))
    chosen = F.filter("candidates", lambda c: _accepted(c, model))
    apart = F.transform(
        chosen,
        lambda c: F.struct(
            c["start"].alias("start"),
            F.element_at(rank, c["kind"]).alias("rank"),
            c["end"].alias("end"),
            c["kind"].alias("kind"),
        ),
    )
    added = merged.select("row", "text", *counts, "base", apart.alias("added"))
    return added.select(
        "row", "text", *counts, "base", F.sort_array(F.concat("base", "added")).alias("spans")
    )


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The input's columns with each span of ``text`` replaced by its kind in brackets.

    Spans that overlap are replaced together, all they cover once, under the first one's kind. ``length``, where the input
    has it, is set to the new text's length; null texts stay null.
    """
    found = find(docs, text)
    nothing = F.struct(F.lit(0).alias("place"), F.lit("").alias("out"))

    def step(acc: Column, span: Column) -> Column:
        before = F.substring(F.col("text"), acc["place"] + 1, span["start"] - acc["place"])
        mark = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        apart = span["start"] >= acc["place"]
        return F.struct(
            F.greatest(acc["place"], span["end"]).alias("place"),
            F.when(apart, F.concat(acc["out"], before, mark)).otherwise(acc["out"]).alias("out"),
        )

    cut = F.when(F.size("spans") > 0, F.aggregate("spans", nothing, step))
    parts = found.select("row", "text", cut.alias("cut"))
    rest = F.substring(F.col("text"), F.col("cut.place") + 1, F.length("text"))
    new = F.when(F.col("cut").isNull(), F.col(f"row.`{text}`")).otherwise(
        F.concat(F.col("cut.out"), rest)
    )
    changed = parts.select("row", new.alias("new"))
    columns = []
    for name, kind in docs.dtypes:
        value = F.col(f"row.`{name}`")
        if name == text:
            value = F.col("new")
        elif name == length:
            value = F.coalesce(F.length("new").cast(kind), value)
        columns.append(value.alias(name))
    return changed.select(*columns)


def op8(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, a digest of the base spans, and all spans."""
    return find(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        *(f"n_{k}" for k in BASE_KINDS),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
