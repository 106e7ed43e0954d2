from __future__ import annotations

import re

from cases import documents, frame, split

from tillbook.llm import quality


def expected(text):
    words = split(text)
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {
        i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)
    } if len(grams) < 5000 else None
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        None if covered is None else len(covered),
    )


def test_counts(spark):
    docs = documents() + [(4000, "a b c d a b c"), (4001, "# * $\n# * $\n\n%&|<>"), (4002, "a a a a a")]
    rows = quality.op5(frame(spark, docs)).collect()
    assert len(rows) == len(docs)
    got = sorted(
        ((r.doc_id is None, r.doc_id or 0), tuple(r)[1:5], r.n_repeat_words) for r in rows
    )
    want = []
    for doc_id, text in docs:
        *counts, repeats = expected(text)
        want.append(((doc_id is None, doc_id or 0), tuple(counts), repeats))
    want.sort(key=lambda x: x[:2])
    for g, w in zip(got, want, strict=True):
        assert g[:2] == w[:2]
        assert w[2] is None or g[2] == w[2]


def test_long_text_of_repeats(spark):
    row = quality.op5(frame(spark, [(1, "a b " * 40_000)])).first()
    assert (row.n_words, row.n_repeat_words, row.base_failed, row.kept) == (80_000, 80_000, True, False)


def test_verdicts(spark):
    clean = " ".join(f"the w{i} of v{i}" for i in range(40))
    docs = [
        (1, clean),
        (2, " ".join(f"w{i}" for i in range(30))),  # short
        (3, clean.replace(" of", "*** of###")),  # symbols
        (4, " ".join(f"q{i}" for i in range(100))),  # no stop words
        (5, clean + "\nsame line" * 40),
        (6, None),
    ]
    kept = {r.doc_id for r in quality.op5(frame(spark, docs)).collect() if r.kept}
    assert kept == {1}
    good = quality.keep_good(frame(spark, docs))
    assert good.columns == frame(spark, docs).columns
    assert [r.doc_id for r in good.collect()] == [1]


def test_empty_table(spark):
    assert quality.op5(frame(spark, [])).collect() == []


def test_no_python_and_no_shuffle(spark):
    plan = quality.op5(frame(spark, documents()).coalesce(1))._jdf.queryExecution().executedPlan()
    assert "Python" not in plan.toString() and "hashpartitioning" not in plan.toString()
