from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from cases import documents, frame

from tillbook.llm import spelling


def near(a, b):
    """Exactly one letter inserted, deleted or replaced, by trying every place."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def ascii_lower(run):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in run)


def plain_counts(docs, min_letters, min_count):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = ascii_lower(run)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if doc_id is not None and h % 199 == 0:
                place = h % len(word)
                word = word[:place] + word[place + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_letters and n >= min_count}


def plain_variants(counts):
    by_word = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, others in by_word.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        f = form[w]
        rows.append((w, f, root, n, len(by_word[w]), counts[f] if f is not None else None))
    return rows


def shown(rows):
    return sorted(map(str, map(tuple, rows)))


def edited(r, word, letters):
    i = r.randrange(len(word) + 1)
    kind = r.choice("ids")
    if kind == "i":
        return word[:i] + r.choice(letters) + word[i:]
    i = min(i, len(word) - 1)
    return word[:i] + (r.choice(letters) if kind == "s" else "") + word[i + 1 :]


def word_list(seed=1, n=400, letters="abÀé"):
    """Words around few stems, so that most have near words, in chains and with ties."""
    r = random.Random(seed)
    words = ["".join(r.choice(letters) for _ in range(r.randint(6, 9))) for _ in range(12)]
    while len(words) < n:
        words.append(edited(r, r.choice(words), letters))
    return words


def test_every_near_pair_is_met(spark):
    words = sorted({w for w in word_list() if len(w) >= 6})
    table = spark.createDataFrame([(w, i % 7 + 1) for i, w in enumerate(words)], "word string, n bigint")
    found = sorted((r["a"], r["b"]) for r in spelling.near_pairs(table).collect())
    want = sorted(
        (a, b) if (len(a), a) < (len(b), b) else (b, a)
        for i, a in enumerate(words) for b in words[i + 1 :] if near(a, b)
    )
    assert len(want) > 300
    assert found == want


def test_short_words_too(spark):
    words = ["a", "ab", "abc", "b", "abcd", "bcd", "acd", "xyz"]
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    found = {frozenset((r["a"], r["b"])) for r in spelling.near_pairs(table, 1).collect()}
    want = {frozenset((a, b)) for a in words for b in words if a != b and near(a, b)}
    assert found == want


def test_forms_and_roots(spark):
    r = random.Random(4)
    words = [w for w in word_list(2) for _ in range(r.choice([1, 1, 2, 6, 30, 160, 800]) if r.random() < 0.4 else 1)]
    counts = {w: n for w, n in Counter(words).items() if len(w) >= 6}
    table = spark.createDataFrame([(w,) for w in words], "word string")
    want = plain_variants(counts)
    assert any(row[1] is not None and row[2] != row[1] for row in want)
    assert shown(spelling.variants(table, 6, 1).collect()) == shown(want)


def test_a_chain_is_followed_to_its_end(spark):
    chain = ["abcdef", "abcdefg", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk"]
    rows = [(w, 5**i) for i, w in enumerate(chain)]
    table = spark.createDataFrame(rows, "word string, n bigint")
    formed = spelling.forms(table, spelling.near_pairs(table))
    found = {row["word"]: row["root"] for row in spelling.roots(formed).collect()}
    assert found == {w: chain[-1] for w in chain[:-1]}


def test_a_frequent_ending_makes_no_large_group(spark):
    """Words of one beginning and ending meet by three quarters of a word, not by half of one."""
    r = random.Random(7)
    letters = "abcdefghijklmnop"
    words = sorted({"lower" + "".join(r.choice(letters) for _ in range(5)) for _ in range(3000)})
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    keys = table.select(spelling.F.explode(spelling._keys(spelling.F.col("word"), spelling.F.length("word"))).alias("k"))
    met = keys.groupBy("k").count().selectExpr("sum(count * (count - 1) / 2) AS pairs").first()["pairs"]
    assert met < 0.1 * len(words) ** 2 / 2


def test_whole_query(spark):
    docs = documents()
    r = random.Random(9)
    pool = word_list(6) + ["ÀÉÎÕÜ", "Straße", "ÀÉÎÕÜß", "STRASSE", "a×b÷cd"]
    docs += [
        (5000 + i, r.choice([" ", ", ", "1"]).join(r.choice(pool[:80] if r.random() < 0.8 else pool) for _ in range(60)))
        for i in range(150)
    ]
    want = plain_variants(plain_counts(docs, 6, 5))
    assert any(row[1] is not None for row in want)
    assert shown(spelling.op11(frame(spark, docs)).collect()) == shown(want)


def test_empty_table(spark):
    assert spelling.op11(frame(spark, [])).collect() == []
    assert spelling.op11(frame(spark, [(1, None), (2, ""), (3, "... 123")])).collect() == []
