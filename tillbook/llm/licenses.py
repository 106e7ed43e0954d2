"""Licence scans: normalised text against licence templates by Dice coefficient over word bigrams.

A notice may be a line, a paragraph or a whole text, so each of those is compared. It may also be
several paragraphs, or a sentence, among others: wherever a text shares a bigram with a template,
the window of as many words as the template has, placed so that the two bigrams coincide, is
compared with that template. A coefficient of ``t`` between ``a`` and ``b`` distinct bigrams needs
``a`` between ``t / (2 - t)`` and ``(2 - t) / t`` times ``b``, which prunes most templates before
anything is counted, and a window must share ``t / (2 - t)`` of its template's bigrams at least.
Templates are a short, fixed table; documents are not shuffled.

Of matches that overlap the best is kept: the highest coefficient, then the template with the most
bigrams, the earliest start, a line before a paragraph, text and window, the first template. So a
notice is not also reported as the one that its first paragraph resembles.

Normalised: ``A-Z`` in small letters, ASCII punctuation as spaces. Null and empty texts, and units
of fewer than two words, match nothing. Repeated rows and null ids are scanned like others.
"""

from __future__ import annotations

import string
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.llm.text import whole_rows

MIN_DICE = 0.8
LEVELS = ("line", "paragraph", "text", "window")

# Licence texts and the notices that stand for longer ones.
TEMPLATES: Mapping[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        'portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
        "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See '
        "the License for the specific language governing permissions and limitations under the "
        "License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for "
        "more details.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version "
        "2 of the License, or (at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version "
        "2 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for "
        "more details.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        'notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS.",
    ),
    "BSD": (
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE "
        "file.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
    "proprietary": ("All rights reserved.",),
}

_PLAIN = bytes.maketrans(
    (string.ascii_uppercase + string.punctuation).encode(),
    (string.ascii_lowercase + " " * len(string.punctuation)).encode(),
)
_FOUND = "array<struct<template: int, dice: double, level: string, unit: int>>"


def units(lines: list[list[bytes]]) -> Iterator[tuple[str, int, int, int]]:
    """``(level, number, start, end)`` of each line, paragraph of several lines, and several
    paragraphs; starts and ends are word numbers. A line without words ends a paragraph.
    """
    place = begun = n_lines = n_paragraphs = 0
    for i, line in enumerate([*lines, []]):
        if line:
            yield "line", i, place, place + len(line)
            place += len(line)
            n_lines += 1
        elif n_lines:
            if n_lines > 1:
                yield "paragraph", n_paragraphs, begun, place
            n_paragraphs += 1
            begun, n_lines = place, 0
    if n_paragraphs > 1:
        yield "text", 0, 0, place


def bigrams(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(words, words[1:], strict=False))


class Templates:
    """Templates by the bigrams they hold."""

    def __init__(self, texts: list[str], least: float = MIN_DICE):
        self.least = least
        self.sizes = []
        self.lengths = []
        self.bigrams = []
        self.holding: dict[tuple[bytes, bytes], list[int]] = defaultdict(list)
        self.places: dict[tuple[bytes, bytes], list[tuple[int, int]]] = defaultdict(list)
        for i, text in enumerate(texts):
            words = text.encode().translate(_PLAIN).split()
            pairs = bigrams(words)
            self.lengths.append(len(words))
            self.bigrams.append(pairs)
            self.sizes.append(len(pairs))
            for place, pair in enumerate(zip(words, words[1:], strict=False)):
                self.places[pair].append((i, place))
            for pair in pairs:
                self.holding[pair].append(i)
        self.holding = dict(self.holding)
        self.places = dict(self.places)
        self.low = least / (2 - least)
        self.high = (2 - least) / least

    def match(self, words: list[bytes]) -> tuple[int, float] | None:
        """The best template of a unit and its coefficient, if that is high enough."""
        holding = self.holding
        if not any(pair in holding for pair in zip(words, words[1:], strict=False)):
            return None
        pairs = bigrams(words)
        size = len(pairs)
        fitting = {
            i for i, other in enumerate(self.sizes) if self.low * other <= size <= self.high * other
        }
        if not fitting:
            return None
        shared: dict[int, int] = defaultdict(int)
        for pair in pairs:
            for i in holding.get(pair, ()):
                if i in fitting:
                    shared[i] += 1
        best = None
        for i in sorted(shared):
            dice = 2 * shared[i] / (size + self.sizes[i])
            if dice >= self.least and (best is None or dice > best[1]):
                best = i, dice
        return best

    def windows(self, words: list[bytes]) -> Iterator[tuple[int, int, float]]:
        """``(template, start, coefficient)`` of each window that is close enough."""
        hits: dict[int, list[int]] = defaultdict(list)
        starts: dict[int, set[int]] = defaultdict(set)
        get = self.places.get
        for i, pair in enumerate(zip(words, words[1:], strict=False)):
            for t, place in get(pair, ()):
                last = len(words) - self.lengths[t]
                if last >= 0:
                    if not hits[t] or hits[t][-1] != i:
                        hits[t].append(i)
                    starts[t].add(max(0, min(i - place, last)))
        for t, found in hits.items():
            size, length = self.sizes[t], self.lengths[t]
            needed = self.low * size - 1e-9
            if len(found) < needed:
                continue
            for start in starts[t]:
                end = start + length
                if bisect_left(found, end - 1) - bisect_left(found, start) < needed:
                    continue
                pairs = bigrams(words[start:end])
                dice = 2 * len(pairs & self.bigrams[t]) / (len(pairs) + size)
                if dice >= self.least:
                    yield t, start, dice

    def find(self, text: bytes | None) -> list[tuple[int, float, str, int]]:
        """``(template, coefficient, level, number)`` of the matches of a text, best first."""
        lines = [line.split() for line in (text or b"").translate(_PLAIN).split(b"\n")]
        words = [word for line in lines for word in line]
        if not any(pair in self.holding for pair in zip(words, words[1:], strict=False)):
            return []
        matches = []
        for level, n, start, end in units(lines):
            if match := self.match(words[start:end]):
                t, dice = match
                matches.append((-dice, -self.sizes[t], start, LEVELS.index(level), t, n, end))
        for t, start, dice in self.windows(words):
            matches.append((-dice, -self.sizes[t], start, 3, t, start, start + self.lengths[t]))
        matches.sort()
        kept, taken = [], []
        for minus, _, start, level, t, n, end in matches:
            at = bisect_left(taken, (start, end))
            before = at and taken[at - 1][1] > start
            if before or at < len(taken) and taken[at][0] < end:
                continue
            taken.insert(at, (start, end))
            kept.append((t, -minus, LEVELS[level], n))
        return kept


def _matches(text: Column, templates: Templates) -> Column:
    @F.pandas_udf(_FOUND)
    def matches(texts: pd.Series) -> pd.Series:
        names = ("template", "dice", "level", "unit")
        return pd.Series([[dict(zip(names, m, strict=True)) for m in templates.find(t)] for t in texts])

    return matches(text.cast("binary"))


def _named() -> list[tuple[str, str]]:
    return [(name, text) for name, texts in TEMPLATES.items() for text in texts]


def scan(docs: DataFrame, text: str = "text", least: float = MIN_DICE) -> DataFrame:
    """``row`` and ``found``: licence, coefficient, level and number of each match, best first.

    The number of a window is its first word's.
    """
    named = _named()
    templates = Templates([t for _, t in named], least)
    names = F.array(*(F.lit(name) for name, _ in named))
    rows = whole_rows(docs, matches=_matches(F.col(f"`{text}`"), templates))
    found = F.transform(
        "matches",
        lambda m: F.struct(
            F.get(names, m["template"]).alias("license"),
            m["dice"].alias("dice"),
            m["level"].alias("level"),
            m["unit"].alias("unit"),
            m["template"].alias("template"),
        ),
    )
    return rows.select("row", found.alias("found"))


def op3(docs: DataFrame) -> DataFrame:
    """One row per document: its best licence, how well it fits and where, and all licences."""
    names = F.array_sort(F.array_distinct(F.transform("found", lambda m: m["license"])))
    best = F.get("found", F.lit(0))
    return scan(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        best["license"].alias("license"),
        best["dice"].alias("dice"),
        F.array_join(names, ",").alias("licenses"),
        F.size("found").cast("long").alias("n_matches"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _plain_sql(column: str) -> str:
    ends = string.ascii_uppercase + string.punctuation
    plain = string.ascii_lowercase + " " * len(string.punctuation)
    return f"translate({column}, {_quoted(ends)}, {_quoted(plain)})"


_WORDS_SQL = "list_filter(regexp_split_to_array({0}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

_LOW = MIN_DICE / (2 - MIN_DICE)

OP3_SQL = f"""
WITH templates AS (
  SELECT t, license, {_WORDS_SQL.format(_plain_sql("body"))} AS w
  FROM (VALUES {", ".join(f"({i}, {_quoted(n)}, {_quoted(t)})" for i, (n, t) in enumerate(_named()))})
    AS v(t, license, body)
), template_places AS (
  SELECT t, len(w) AS n, i - 1 AS p, w[i] AS a, w[i + 1] AS b
  FROM (SELECT t, w, unnest(generate_series(1, len(w) - 1)) AS i FROM templates)
), template_pairs AS (
  SELECT DISTINCT t, a, b FROM template_places
), sizes AS (
  SELECT t, license, len(w) AS n, size
  FROM templates JOIN (SELECT t, count(*) AS size FROM template_pairs GROUP BY t) USING (t)
), texts AS (
  SELECT row_number() OVER () AS r, doc_id, {_plain_sql("coalesce(text, '')")} AS text FROM documents
), lines AS (
  SELECT r, i, {_WORDS_SQL.format("lines[i]")} AS w
  FROM (SELECT r, lines, unnest(generate_series(1, len(lines))) AS i
        FROM (SELECT r, string_split(text, chr(10)) AS lines FROM texts))
), numbered AS (
  SELECT r, i, w, i - row_number() OVER (PARTITION BY r ORDER BY i) AS p,
    sum(len(w)) OVER (PARTITION BY r ORDER BY i) - len(w) AS s
  FROM lines WHERE len(w) > 0
), paragraphs AS (
  SELECT r, p, flatten(list(w ORDER BY i)) AS w, count(*) AS n, min(s) AS s
  FROM numbered GROUP BY r, p
), whole AS (
  SELECT r, flatten(list(w ORDER BY p)) AS w, count(*) AS n FROM paragraphs GROUP BY r
), hits AS (
  SELECT r, i, t, greatest(0, least(i - p, n_words - n)) AS s
  FROM (SELECT r, i - 1 AS i, w[i] AS a, w[i + 1] AS b, len(w) AS n_words
        FROM (SELECT r, w, unnest(generate_series(1, len(w) - 1)) AS i FROM whole))
  JOIN template_places USING (a, b) WHERE n_words >= n
), enough AS (
  SELECT r, t FROM hits JOIN sizes USING (t)
  GROUP BY r, t, size HAVING count(DISTINCT i) >= {_LOW} * size - 1e-9
), starts AS (
  SELECT r, t, g.s, z.n
  FROM (SELECT DISTINCT r, t, s FROM hits) AS g JOIN enough USING (r, t) JOIN sizes AS z USING (t)
  JOIN (SELECT DISTINCT r, t, i FROM hits) AS h USING (r, t)
  WHERE h.i BETWEEN g.s AND g.s + z.n - 2
  GROUP BY r, t, g.s, z.n, z.size HAVING count(*) >= {_LOW} * z.size - 1e-9
), units AS (
  SELECT r, 0 AS level, i AS u, -1 AS own, s, w FROM numbered
  UNION ALL SELECT r, 1, p, -1, s, w FROM paragraphs WHERE n > 1
  UNION ALL SELECT r, 2, 0, -1, 0, w FROM whole WHERE n > 1
  UNION ALL SELECT r, 3, s, t, s, list_slice(w, s + 1, s + starts.n) FROM starts JOIN whole USING (r)
), pairs AS (
  SELECT DISTINCT r, level, u, own, s, len(w) AS n_words, w[i] AS a, w[i + 1] AS b
  FROM (SELECT *, unnest(generate_series(1, len(w) - 1)) AS i FROM units WHERE len(w) > 1)
), unit_sizes AS (
  SELECT r, level, u, own, s, n_words, count(*) AS size FROM pairs GROUP BY ALL
), shared AS (
  SELECT r, level, u, own, t, count(*) AS n FROM pairs JOIN template_pairs USING (a, b)
  WHERE own IN (-1, t) GROUP BY ALL
), scored AS (
  SELECT r, level, u, own, q.s, q.s + n_words AS e, t, license, z.size,
    2 * shared.n / (q.size + z.size) AS dice
  FROM shared JOIN unit_sizes AS q USING (r, level, u, own) JOIN sizes AS z USING (t)
), matched AS (
  SELECT * FROM scored WHERE dice >= {MIN_DICE}
  QUALIFY row_number() OVER (PARTITION BY r, level, u, own ORDER BY dice DESC, t) = 1
), kept AS (
  SELECT r, list_reduce(
    list([{{'s': s, 'e': e, 'dice': dice, 'license': license}}]
         ORDER BY dice DESC, size DESC, s, level, t),
    lambda k, x: CASE WHEN len(list_filter(k, lambda y: y.s < x[1].e AND x[1].s < y.e)) = 0
                      THEN list_concat(k, x) ELSE k END) AS k
  FROM matched GROUP BY r
)
SELECT doc_id, k[1].license AS license, k[1].dice AS dice,
  coalesce(array_to_string(list_sort(list_distinct(list_transform(k, lambda x: x.license))), ','), '') AS licenses,
  coalesce(len(k), 0) AS n_matches
FROM texts LEFT JOIN kept USING (r)
"""
