"""Packing documents into training sequences by best-fit decreasing.

Documents are tokenized and cut where they are longer than a sequence. A whole sequence's piece
needs no partner. The others go, evenly and whatever their ids, to shards of at most
``SHARD_PIECES`` pieces; in each, pieces are taken by decreasing length, and a segment tree over
remaining capacities finds the tightest open sequence in a number of steps that is the logarithm
of the capacity. A shard leaves about one sequence part-filled, so shards of this size cost
nothing that matters, and their number, not their size, grows with the input.

Null and empty texts are the end token alone. Repeated rows and null ids are packed like others.
"""

from __future__ import annotations

import string
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillbook.staging import stage

CAPACITY = 2048
END_TOKEN = 0
SHARD_PIECES = 200_000
# Words of a generation that a task remembers the tokens of, and the longest that it does.
KNOWN_WORDS = 250_000
KNOWN_CHARS = 40
# Texts whose words are looked up together have about so many characters.
BLOCK_CHARS = 1 << 22
# A tokenizer's file is sent to the tasks, up to this size.
MAX_TOKENIZER_BYTES = 64 << 20
# Long texts are tokenized in parts of about so many characters, cut at spaces.
PART_CHARS = 1 << 20

# The pre-tokenizer's pattern in the tokenizer file, which the short way relies on.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Words of these signs only, which have one way to be written and known small letters.
_SIMPLE = "^[!-~¡-ÿ]*$"
# Characters below this one are letters and signs that composition leaves as they are.
_FIRST_OTHER = "ɐ"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordTokens(dict):
    """Token ids of a space-separated word as little-endian bytes.

    The words of two generations are remembered. When the younger is full it becomes the older,
    and a word that is met again goes to the younger, so frequent words stay.

    The tokenizer drops white space and lets no token cross it, so a text's ids are those of its
    words in order. Words of plain letters and signs go straight to the tokenizer's model, which
    is several times faster; all others take the whole way.
    """

    def __init__(self, tokenizer_json: str):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenize = self.tokenizer.model.tokenize
        self.pattern = regex.compile(_PATTERN)
        self.letters = _byte_letters()
        self.plain = '"Lowercase"' in tokenizer_json and "'s|'t|'re|'ve|'m|'ll|'d|" in tokenizer_json

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self._ids(word)
        if len(word) <= KNOWN_CHARS:
            if len(self) >= KNOWN_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        if not word:
            return b""
        if not self.plain or not (word.isascii() or self._composed(word)):
            return self._whole(word)
        if word.isalpha():
            small = word.lower()
            return self._part(word) if small == word else self[small]
        if "<|" in word or not word.isprintable():
            return self._whole(word)
        small = word.lower()
        if small != word:
            return self[small]
        if word[:-1].isalpha():
            return self[word[:-1]] + self[word[-1]]
        parts = self.pattern.findall(word)
        return b"".join(map(self.__getitem__, parts)) if len(parts) > 1 else self._part(word)

    @staticmethod
    def _composed(word: str) -> bool:
        return max(word) < _FIRST_OTHER and unicodedata.is_normalized("NFC", word)

    def _whole(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        """One pre-token, in small letters."""
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.tokenize(part)]).tobytes()

    def of(self, text: str) -> bytes:
        return b"".join(
            b"".join(map(self.__getitem__, part.replace("\n", " ").split(" ")))
            for part in _parts(text)
        )

    def of_texts(self, texts: pa.Array) -> Iterator[bytes]:
        """``of`` for each text; every distinct word of a block of texts is looked up once."""
        chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
        start = 0
        while start < len(texts):
            size, end = 0, start
            while end < len(texts) and (end == start or size + chars[end] <= BLOCK_CHARS):
                size += chars[end]
                end += 1
            if size > BLOCK_CHARS:
                yield self.of(texts[start].as_py())
            else:
                yield from self._of_block(texts.slice(start, end - start))
            start = end

    def _of_block(self, texts: pa.Array) -> Iterator[bytes]:
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        ids = self._of_words(coded.dictionary)
        places = coded.indices.to_numpy()
        ends = np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False)).tolist()
        for a, b in zip([0, *ends], ends, strict=False):
            yield b"".join(ids[places[a:b]].tolist())

    def _of_words(self, words: pa.Array) -> np.ndarray:
        """Token ids of distinct words. Those of simple signs are put in small letters together;
        of them, only words of letters and the parts of others are remembered.
        """
        ids = np.empty(len(words), object)
        simple = pc.and_(
            pc.match_substring_regex(words, _SIMPLE), pc.invert(pc.match_substring(words, "<|"))
        )
        if not self.plain:
            simple = pc.and_(simple, False)
        small = pc.utf8_lower(words)
        letters = pc.and_(simple, pc.utf8_is_alpha(small))
        for chosen, texts, look_up in (
            (letters, small, self.__getitem__),
            (pc.and_not(simple, letters), small, self._of_signs),
            (pc.invert(simple), words, self.__getitem__),
        ):
            held = texts.filter(chosen).to_numpy(zero_copy_only=False)
            mask = chosen.to_numpy(zero_copy_only=False)
            ids[mask] = np.fromiter(map(look_up, held), object, len(held))
        return ids

    def _of_signs(self, word: str) -> bytes:
        """A word of small letters, digits and signs, by its parts."""
        letters = word.rstrip(string.punctuation)
        if letters.isalpha():
            return self[letters] + self[word[len(letters) :]]
        return b"".join(map(self.__getitem__, self.pattern.findall(word)))


def _parts(text: str) -> Iterator[str]:
    start = 0
    while start < len(text):
        end = start + PART_CHARS
        if end < len(text):
            end = text.find(" ", end)
            end = len(text) if end < 0 else end
        yield text[start:end]
        start = end


@lru_cache(maxsize=2)
def _known_words(tokenizer_json: str) -> WordTokens:
    """One per Python worker and tokenizer, kept from task to task."""
    return WordTokens(tokenizer_json)


def cut(ids: bytes, capacity: int) -> list[tuple[int, int]]:
    """``(length, crc32)`` of each piece of a document's ids."""
    step = 4 * capacity
    return [
        (len(part) // 4, zlib.crc32(part))
        for part in (ids[i : i + step] for i in range(0, len(ids), step))
    ]


def _pieces(text: Column, broadcast, capacity: int) -> Column:
    end = array("I", [END_TOKEN]).tobytes()

    @F.arrow_udf("array<struct<length: bigint, ids_crc32: bigint>>")
    def pieces(texts: pa.Array) -> pa.Array:
        ids = _known_words(broadcast.value).of_texts(pc.fill_null(texts, ""))
        cuts = [cut(known + end, capacity) for known in ids]
        flat = [piece for pieces_of_one in cuts for piece in pieces_of_one]
        offsets = np.cumsum([0, *map(len, cuts)], dtype=np.int32)
        lengths, crcs = (pa.array([piece[i] for piece in flat], pa.int64()) for i in (0, 1))
        parts = pa.StructArray.from_arrays([lengths, crcs], ["length", "ids_crc32"])
        # A worker that waits for its next task should not hold the memory of this one's blocks.
        pa.default_memory_pool().release_unused()
        return pa.ListArray.from_arrays(pa.array(offsets), parts)

    return pieces(text)


def tokenizer_file(spark: SparkSession, path: str):
    """A tokenizer's JSON as a broadcast, so that only the driver needs the file."""
    with open(path, "rb") as file:
        data = file.read(MAX_TOKENIZER_BYTES + 1)
    if len(data) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path} is larger than a tokenizer should be")
    return spark.sparkContext.broadcast(data.decode())


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's pieces."""
    ids = _pieces(F.col("text"), tokenizer_file(docs.sparkSession, path), capacity)
    return (
        docs.select("doc_id", ids.alias("pieces"))
        # Every document has a piece. Without "outer", Spark would add a filter on the number of
        # pieces and tokenize once more for it, in a second Python worker.
        .select("doc_id", F.posexplode_outer("pieces").alias("piece", "p"))
        .select(
            "doc_id",
            "piece",
            (F.col("piece").cast("long") * capacity).alias("start"),
            "p.length",
            "p.ids_crc32",
        )
    )


class Capacities:
    """A segment tree over remaining capacities: how many open sequences have each."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.size)

    def add(self, remaining: int, n: int) -> None:
        node = remaining + self.size
        while node:
            self.counts[node] += n
            node >>= 1

    def tightest(self, length: int) -> int:
        """The smallest remaining capacity of at least ``length``, or -1."""
        node = length + self.size
        if self.counts[node]:
            return length
        # Up to the first subtree on the right with an open sequence, then down to its left edge.
        while node > 1:
            if node % 2 == 0 and self.counts[node + 1]:
                node += 1
                while node < self.size:
                    node *= 2
                    if not self.counts[node]:
                        node += 1
                return node - self.size
            node >>= 1
        return -1


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """``(sequence, offset)`` of each length, which must come in decreasing order."""
    tree = Capacities(capacity)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequences, offsets = [], []
    n = 0
    for length in lengths:
        remaining = tree.tightest(length)
        if remaining < 0:
            remaining, sequence = capacity, n
            n += 1
        else:
            sequence = open_at[remaining].pop()
            tree.add(remaining, -1)
        sequences.append(sequence)
        offsets.append(capacity - remaining)
        left = remaining - length
        if left:
            open_at[left].append(sequence)
            tree.add(left, 1)
    return sequences, offsets


_SEQUENCE_BITS = 31


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. They must be stored rows."""
    columns = pieces.columns
    # Even ids are whole sequences of one piece, odd ones come from shards.
    whole = pieces.filter(F.col("length") == capacity).select(
        *columns,
        (F.monotonically_increasing_id() * 2).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    short = pieces.filter(F.col("length") < capacity)
    n_shards = -(-short.count() // SHARD_PIECES) or 1
    place = F.monotonically_increasing_id()
    # Places run on within a stored file's part and differ in high bits between parts.
    mixed = F.pmod(F.xxhash64(place), F.lit(n_shards)).alias("shard")

    def packed(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by(
            [("length", "descending"), *((c, "ascending") for c in ("doc_id", "piece", "ids_crc32"))]
        )
        sequences, offsets = best_fit(shard["length"].to_pylist(), capacity)
        ids = (shard["shard"][0].as_py() << _SEQUENCE_BITS) + np.array(sequences, np.int64)
        kept = shard.select(columns).append_column("sequence_id", pa.array(2 * ids + 1))
        return kept.append_column("offset", pa.array(offsets, pa.int64()))

    kinds = dict(pieces.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns) + ", sequence_id bigint, offset bigint"
    shards = short.select(*columns, mixed).groupBy("shard").applyInArrow(packed, schema)
    return whole.unionByName(shards)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(stage(tokenize(docs, path, capacity), "pieces"), capacity)


def op6(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per piece with its sequence and place there."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(docs, path)
