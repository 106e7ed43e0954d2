from __future__ import annotations

import random
import zlib
from array import array

import public_tokenizers
import pyarrow as pa
import pytest
from cases import documents, frame
from tokenizers import Tokenizer

from tillbook.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def known():
    with open(PATH) as file:
        return packing.WordTokens(file.read())


def test_words_are_tokenized_like_texts(known):
    whole = Tokenizer.from_file(PATH)
    r = random.Random(1)
    signs = "abcXYZ019.,'!&<|>ßéÉñİıſΣσςǅ中 \n\t\x0b\x1c\x85\xa0́\xadＡ½²_- 😀end oftext'll's"
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    texts += ["a <|endoftext|> b", "<|EndOfText|>", "it's we'll x's", ""]
    texts += [t or "" for _, t in documents()]
    for text in texts:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert list(array("I", known.of(text))) == ids, text


def test_forgetting_and_parts_change_nothing(known, monkeypatch):
    text = "the quick brown fox, Über 12 " * 300
    ids = known.of(text)
    monkeypatch.setattr(packing, "KNOWN_WORDS", 3)
    monkeypatch.setattr(packing, "PART_CHARS", 50)
    assert known.of(text) == ids


def test_words_looked_up_together(known, monkeypatch):
    r = random.Random(4)
    texts = ["", " ", "\n\n", "one", "one two " * 40, *(t or "" for _, t in documents()[:60])]
    texts += [" ".join(r.choice(["Über,", "foo", "bar!!", "日本", "x"]) for _ in range(30)) for _ in range(50)]
    want = [known.of(text) for text in texts]
    for block, generation in ((1 << 23, 300_000), (200, 5), (1, 1)):
        monkeypatch.setattr(packing, "BLOCK_CHARS", block)
        monkeypatch.setattr(packing, "KNOWN_WORDS", generation)
        assert list(known.of_texts(pa.array(texts))) == want
    assert list(known.of_texts(pa.array(["left out", *texts]).slice(1))) == want
    assert list(known.of_texts(pa.array([], pa.string()))) == []


def test_pieces_and_sequences(spark):
    docs = documents()
    rows = packing.op6(frame(spark, docs)).collect()
    whole = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text in docs:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            crc = zlib.crc32(array("I", part).tobytes())
            want.append((doc_id is None, doc_id or 0, piece, start, len(part), crc))
    assert sorted((r.doc_id is None, r.doc_id or 0, *tuple(r)[1:5]) for r in rows) == sorted(want)
    assert_packed(rows)


def assert_packed(rows, capacity=2048):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    # Best-fit decreasing is never further from the least than 11/9 and a sequence.
    assert len(sequences) <= -(-total // capacity) * 11 / 9 + 1


def plain_best_fit(lengths, capacity):
    left = []
    for n in lengths:
        fitting = [x for x in left if x >= n]
        if fitting:
            left.remove(min(fitting))
            left.append(min(fitting) - n)
        else:
            left.append(capacity - n)
    return sorted(left)


@pytest.mark.parametrize("capacity", [1, 7, 64, 2048])
def test_best_fit(capacity):
    r = random.Random(capacity)
    lengths = sorted((r.randint(1, capacity) for _ in range(600)), reverse=True)
    sequences, offsets = packing.best_fit(lengths, capacity)
    used = {}
    for s, o, n in zip(sequences, offsets, lengths, strict=True):
        assert used.get(s, 0) == o
        used[s] = o + n
    assert sorted(capacity - u for u in used.values()) == plain_best_fit(lengths, capacity)


def test_many_shards_waste_little(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 500)
    r = random.Random(3)
    rows = [(2**60 + i, 0, 0, r.randint(1, 2047), 1) for i in range(4000)] + [(None, 0, 0, 5, 1)] * 3
    pieces = spark.createDataFrame(
        rows, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    ).repartition(4)
    pieces.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/test-pieces")
    packed = packing.pack(spark.read.parquet(path)).collect()
    assert_packed(packed)
    assert sorted(x.doc_id for x in packed if x.doc_id) == [x[0] for x in rows if x[0]]
    least = -(-sum(x[3] for x in rows) // 2048)
    assert len({x.sequence_id for x in packed}) <= least * 1.02 + 9


def test_empty_table(spark):
    assert packing.op6(frame(spark, [])).collect() == []
