from __future__ import annotations

import duckdb
import pytest
from cases import documents, frame
from compare import duckdb_rows, spark_rows

from tillbook.llm import licenses


PROSE = " ".join(f"p{i} of the q{i} and" for i in range(60))


def embedded(notice, edited=False):
    """A notice in paragraphs of some lines each within a longer text."""
    words = notice.split()
    if edited and len(words) > 40:
        words[len(words) // 2 + 5] = "otherword"
    lines = [" ".join(words[i : i + 9]) for i in range(0, len(words), 9)]
    paragraphs = ["\n".join(lines[i : i + 4]) for i in range(0, len(lines), 4)]
    return "\n\n".join([PROSE, *paragraphs, PROSE])


def plain_found(text):
    """Matches of a text by all units and all windows that share a bigram in its place."""
    named = [t.encode().translate(licenses._PLAIN).split() for _, t in licenses._named()]
    lines = [line.split() for line in text.encode().translate(licenses._PLAIN).split(b"\n")]
    words = [w for line in lines for w in line]
    matches = []

    def compare(start, end, level, u, t):
        a, b = licenses.bigrams(words[start:end]), licenses.bigrams(named[t])
        dice = 2 * len(a & b) / (len(a) + len(b))
        return (-dice, -len(b), start, level, t, u, end)

    for level, n, start, end in licenses.units(lines):
        if end - start > 1:
            level = licenses.LEVELS.index(level)
            matches.append(min((compare(start, end, level, n, t) for t in range(len(named))), key=lambda m: (m[0], m[4])))
    for t, wanted in enumerate(named):
        for start in range(len(words) - len(wanted) + 1):
            part = words[start : start + len(wanted)]
            aligned = any(x == y for x, y in zip(zip(part, part[1:]), zip(wanted, wanted[1:])))
            if aligned:
                matches.append(compare(start, start + len(wanted), 3, start, t))
    kept, taken = [], set()
    for m in sorted(m for m in matches if -m[0] >= licenses.MIN_DICE):
        if taken.isdisjoint(range(m[2], m[6])):
            taken.update(range(m[2], m[6]))
            kept.append((m[4], -m[0], licenses.LEVELS[m[3]], m[5]))
    return kept


def texts():
    named = licenses._named()
    docs = [(10_000 + i, t) for i, (_, t) in enumerate(named)]
    docs += [
        (5001, "Some prose.\n\n" + named[0][1].upper() + "\nmore prose here"),
        (5002, named[3][1][:200] + "\n" + named[3][1][200:] + "\n\n\nthe end\nof it"),  # a paragraph
        (5003, "released under the MIT"),
        (5004, "All rights reserved.\nAll rights reserved.\nLicensed under CC BY-NC 4.0."),
        (5005, "all all all all"),
        (5006, "\n\n\n"),
        (5007, named[0][1] + " " + " ".join(f"w{i}" for i in range(30))),  # a notice in a long line
        (5008, "Copyright 2020 Acme Corp. All rights reserved."),
        (5009, "Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0.\nreleased under the"),
        (5010, "the software the software " * 2000),
        (5011, "All rights reserved. " * 300),
        (5012, "not a word of " + " and so ".join(t for _, t in named)),
    ]
    docs += [(20_000 + i, embedded(t)) for i, (_, t) in enumerate(named)]
    docs += [(30_000 + i, embedded(t, edited=True)) for i, (_, t) in enumerate(named)]
    return docs + documents()


def test_against_sql(spark):
    docs = texts()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    assert spark_rows(licenses.op3(frame(spark, docs))) == duckdb_rows(con, licenses.OP3_SQL)


def test_found(spark):
    rows = {r.doc_id: r for r in licenses.op3(frame(spark, texts())).collect()}
    for i, (name, _) in enumerate(licenses._named()):
        assert (rows[10_000 + i].license, rows[10_000 + i].dice) == (name, 1.0)
    assert rows[5001].license == "MIT" and rows[5002].license == "MIT"
    assert rows[5004].licenses == "CC-BY-NC-4.0,proprietary" and rows[5004].n_matches == 3
    assert [rows[i].license for i in (5005, 5006, 5010)] == [None] * 3
    assert rows[5007].license == "MIT" and rows[5008].license == "proprietary"
    assert rows[5009].licenses == "CC-BY-4.0,CC-BY-SA-4.0" and rows[5009].n_matches == 2
    assert (rows[5011].licenses, rows[5011].n_matches) == ("proprietary", 300)
    assert rows[5012].n_matches == len(licenses._named())
    for i, (name, notice) in enumerate(licenses._named()):
        assert (rows[20_000 + i].licenses, rows[20_000 + i].n_matches) == (name, 1), notice
        assert rows[30_000 + i].licenses == name, notice


def test_against_all_windows():
    templates = licenses.Templates([t for _, t in licenses._named()])
    for _, text in texts():
        if len(text or "") < 8000:
            assert templates.find((text or "").encode()) == plain_found(text or ""), text[:80]


@pytest.mark.parametrize("least", [0.3, 0.8, 1.0])
def test_pruning_loses_nothing(least):
    texts = [t for _, t in licenses._named()]
    templates = licenses.Templates(texts, least)
    for text in texts:
        words = text.encode().translate(licenses._PLAIN).split()
        for cut in range(2, len(words), 3):
            a = licenses.bigrams(words[:cut])
            scores = []
            for i, other in enumerate(texts):
                b = licenses.bigrams(other.encode().translate(licenses._PLAIN).split())
                scores.append((2 * len(a & b) / (len(a) + len(b)), -i))
            best, i = max(scores)
            assert templates.match(words[:cut]) == ((-i, best) if best >= least else None)


def test_empty_table(spark):
    assert licenses.op3(frame(spark, [])).collect() == []
