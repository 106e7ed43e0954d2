"""The whole pipeline against its stages by brute force, and the queries against their SQL."""

from __future__ import annotations

import re

import duckdb
import public_tokenizers
import pytest
from compare import duckdb_rows, duckdb_types, spark_rows, spark_types
from test_decontaminate import plain_coverage
from test_packing import assert_packed
from test_pii import base
from test_simhash import plain_components
from tokenizers import Tokenizer

import __spark_entry__ as spark_entry
import corpus_pipeline
from tillbook.llm import decontaminate, quality
from tillbook.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, con, name):
    result = QUERIES[name](spark, sf_dir)
    types = {k: v.replace("array<string>", "VARCHAR[]") for k, v in spark_types(result).items()}
    assert types == duckdb_types(con, ORACLES[name])
    assert spark_rows(result) == duckdb_rows(con, ORACLES[name])


def test_all_are_registered():
    names = spark_entry.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) < set(names) and names["pipeline"] is corpus_pipeline.run
    assert set(ORACLES) < set(spark_entry.oracle_sql())


def covered(text, item):
    """Whether tiles cover an item; by all pairs of places if it shares enough words."""
    wanted, found = (set(decontaminate.tokens(t.encode())) for t in (item, text))
    if len(wanted & found) < 3:
        return False
    all_wanted = decontaminate.tokens(item.encode())
    if sum(t in found for t in all_wanted) < decontaminate.MIN_COVERAGE * len(all_wanted):
        return False
    return plain_coverage(text, item)[0] >= decontaminate.MIN_COVERAGE


def test_stages(spark, sf_dir, con):
    docs = con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality.OP5_SQL}) WHERE kept").fetchall()}
    docs = [d for d in docs if d[0] in good]
    _, least, _ = plain_components(docs)
    docs = [d for d in docs if d[0] in set(least)]
    items = [t for (t,) in con.execute("SELECT text FROM benchmark").fetchall()]
    docs = [d for d in docs if not any(covered(d[1], t) for t in items)]

    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = frame.dtypes
    for _, step in corpus_pipeline.STAGES[:-1]:
        before = frame
        frame = step(spark, frame, sf_dir)
        assert frame.dtypes == columns
    kept = {r.doc_id: r for r in before.collect()}
    assert {d: r.text for d, r in kept.items()} == dict(docs)
    redacted = {r.doc_id: r for r in frame.collect()}
    assert set(redacted) == set(kept)
    for doc_id, text in docs:
        if base(text)[1]:
            assert base(redacted[doc_id].text)[1] == ""
        elif "token" not in text:
            assert redacted[doc_id].text == text
        assert redacted[doc_id].n_chars == len(redacted[doc_id].text)

    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert_packed(rows)
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {}
    for r in rows:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {
        d: len(whole.encode(r.text, add_special_tokens=False).ids) + 1 for d, r in redacted.items()
    }
