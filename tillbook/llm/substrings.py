"""Repeated passages by fixed-block anchors.

A window of 20 words holds, wherever it starts, one whole block of 10 words that is aligned to a
multiple of 10 in its document. So the aligned, non-overlapping blocks of all documents are the
index, and every rolling run of 10 words probes it. A hit that is not its own block is extended
over the 20-word windows around it; each of those is compared with the earliest window of the
same words, and neighbouring windows that are repeats merge into maximal repeats. Hits of a block
are not paired with each other, which would square the size of a group of copies.

Documents are gathered once into chunks of a few MB and stored compressed. A chunk sends each
distinct value it has once, so a passage found everywhere makes one entry a chunk, and values
travel in sorted, packed arrays, one for each chunk and bucket. Buckets hold about
``BUCKET_WORDS`` values whatever the size of the input. Three steps read the chunks: to probe, to
extend, and to cut. Between them, only what was asked for returns to a chunk.

Windows are told apart by 64 bits of one hash within a bucket that another hash chose, blocks by
32 bits within their bucket: a block that matches by chance costs one more comparison of windows
and changes nothing.

Null and empty texts have no words. Order is by ``doc_id`` (null last), then by start; rows that
repeat a ``doc_id`` count as one document, of which only windows with a later start are repeats.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress, pairwise

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.staging import stage

WINDOW_WORDS = 20
CHUNK_BYTES = 4 << 20
BUCKET_WORDS = 2_000_000

_CHUNK = "chunk bigint, ids binary, nameless binary, ends binary, body binary, n_words bigint"
_ROW_BITS = 33
_LAST = np.iinfo(np.int64).max


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes, like to like."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_sorted(values: np.ndarray) -> bytes:
    """Rising numbers as packed differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _follow(a: np.ndarray, b: np.ndarray, factor: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A hash of the first followed by the second."""
    return _mix(a * np.uint64(factor) + b)


def _runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for every run of ``n``."""
    count = max(len(hashes) - n + 1, 0)
    run = hashes[:count]
    for i in range(1, n):
        run = _follow(run, hashes[i : i + count])
    return run


def _placed(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket in the upper 32 bits, place in the bucket in the lower; in the order of hashes."""
    n, half, low = np.uint64(n_buckets), np.uint64(32), np.uint64(0xFFFFFFFF)
    return (hashes >> half) * n + (((hashes & low) * n) >> half)


def _by_bucket(placed: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Buckets of sorted placed values, and where they are."""
    yield from _equal_runs((placed >> np.uint64(32)).astype(np.int64))


def _equal_runs(sorted_buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    edges = np.flatnonzero(np.diff(sorted_buckets, prepend=-1, append=-1)).tolist()
    for start, end in pairwise(edges if len(sorted_buckets) else ()):
        yield int(sorted_buckets[start]), slice(start, end)


class Chunk:
    """The words of some documents, in the order of their ids."""

    def __init__(self, row, window: int):
        self.number = int(row.chunk)
        self.ids = np.frombuffer(row.ids, np.int64)
        self.nameless = np.frombuffer(row.nameless, bool)
        body = zstandard.decompress(row.body)
        self.words: list[bytes] = []
        lengths, start = [], 0
        for end in np.frombuffer(row.ends, np.int64).tolist():
            words = body[start:end].split()
            self.words += words
            lengths.append(len(words))
            start = end
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.window, self.block = window, window // 2
        n = len(self.words)
        self.document = np.repeat(np.arange(len(lengths)), self.lengths)
        self.place = np.arange(n) - self.starts[self.document]
        self.left = self.lengths[self.document] - self.place
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, n)
        self.blocks = _runs(hashes, self.block)
        self.block_starts = np.flatnonzero(self.left >= self.block)
        self.window_starts = np.flatnonzero(self.left >= window)

    def block_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all rolling blocks, and which of them are aligned."""
        return self.blocks[self.block_starts], self.place[self.block_starts] % self.block == 0

    def window_hashes(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each window: the second one only chooses its bucket."""
        first, second = self.blocks[starts], self.blocks[starts + self.window - self.block]
        if self.window % 2:
            first = _follow(first, self.blocks[starts + 1])
        return _follow(first, second), _follow(second, first, 0xD6E8FEB86659FD93)

    def order(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``doc_id`` (null last) and start of windows."""
        documents = self.document[starts]
        ids = np.where(self.nameless[documents], _LAST, self.ids[documents])
        return ids, self.place[starts].astype(np.uint32)

    def candidates(self, hits: np.ndarray, n_buckets: int) -> np.ndarray:
        """Windows that hold a hit: a block found elsewhere, or twice here and once aligned."""
        hashes, aligned = self.block_hashes()
        found = np.isin(_placed(hashes, n_buckets), hits)
        values, at, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        indexed = np.zeros(len(values), bool)
        indexed[at[aligned]] = True
        found |= (indexed & (counts > 1))[at]
        before = np.zeros(len(self.words) + 1, np.int64)
        before[self.block_starts[found] + 1] = 1
        before = np.cumsum(before)
        starts = self.window_starts
        return starts[before[starts + self.window - self.block + 1] > before[starts]]


def _earliest(keys: np.ndarray, ids: np.ndarray, places: np.ndarray):
    """Sorted order of windows, the first of each key in it, and which come after a first."""
    order = np.lexsort((places, ids, keys))
    keys, ids, places = keys[order], ids[order], places[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(keys) else order
    later = (ids != ids[first]) | (places != places[first])
    return order, new, later


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    rows = docs.select(
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"),
        F.col("doc_id").isNull().alias("nameless"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << _ROW_BITS
        held: list[tuple[bool, int, bytes]] = []
        size = 0

        def chunk() -> pd.DataFrame:
            held.sort(key=lambda d: d[:2])
            ends = np.cumsum([len(t) + 1 for _, _, t in held])
            body = b"".join(t + b"\n" for _, _, t in held)
            return pd.DataFrame(
                {
                    "chunk": [number],
                    "ids": [np.array([i for _, i, _ in held], np.int64).tobytes()],
                    "nameless": [np.array([n for n, _, _ in held], bool).tobytes()],
                    "ends": [ends.astype(np.int64).tobytes()],
                    "body": [zstandard.compress(body, 3)],
                    "n_words": [sum(len(t.split()) for _, _, t in held)],
                }
            )

        for batch in batches:
            for doc_id, nameless, text in batch.itertuples(index=False):
                if held and size + len(text) > chunk_bytes:
                    yield chunk()
                    number += 1
                    held, size = [], 0
                held.append((nameless, doc_id, text))
                size += len(text)
        if held:
            yield chunk()

    return rows.mapInPandas(gather, _CHUNK)


def _probe(chunks: DataFrame, window: int, n_buckets: int) -> DataFrame:
    """What each chunk asks each bucket (all blocks) and tells it (aligned blocks)."""

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in (r for b in batches for r in b.itertuples(index=False)):
            chunk = Chunk(row, window)
            hashes, aligned = chunk.block_hashes()
            asked = _placed(np.unique(hashes), n_buckets)
            told = _placed(np.unique(hashes[aligned]), n_buckets)
            told_in = dict(_by_bucket(told))
            yield pd.DataFrame(
                [
                    (
                        bucket,
                        chunk.number,
                        pack_sorted(asked[part].astype(np.uint32)),
                        pack_sorted(told[told_in.get(bucket, slice(0))].astype(np.uint32)),
                    )
                    for bucket, part in _by_bucket(asked)
                ],
                columns=["bucket", "chunk", "asked", "told"],
            )

    return chunks.mapInPandas(probe, "bucket bigint, chunk bigint, asked binary, told binary")


def _hit(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """The blocks of a bucket that two chunks have and one has aligned, for each that asked."""
    index = np.unique(np.concatenate([unpack_sorted(d, np.uint32) for d in group["told"]]))
    replies = []
    if len(index):
        counts = np.zeros(len(index), np.int64)
        held = []
        for chunk, data in zip(group["chunk"], group["asked"], strict=True):
            asked = np.unique(unpack_sorted(data, np.uint32))
            at = np.minimum(np.searchsorted(index, asked), len(index) - 1)
            at = at[index[at] == asked]
            counts[at] += 1
            held.append((chunk, at))
        for chunk, at in held:
            found = index[at[counts[at] > 1]]
            if len(found):
                replies.append((chunk, key[0], pack_sorted(found)))
    return pd.DataFrame(replies, columns=["chunk", "bucket", "found"])


def _answered(chunks: DataFrame, replies: DataFrame) -> DataFrame:
    """Chunks with all that was sent back to them: no more than they asked for themselves."""
    sent = replies.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "found")).alias("sent"))
    return chunks.join(sent.withColumnRenamed("chunk", "to"), F.col("chunk") == F.col("to"), "left").drop("to")


def _extend(chunks: DataFrame, window: int, n_buckets: int) -> DataFrame:
    """The windows around hits: hash, and the first place in the chunk, by bucket."""

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in (r for b in batches for r in b.itertuples(index=False)):
            chunk = Chunk(row, window)
            hits = [
                (np.uint64(s["bucket"]) << np.uint64(32)) + unpack_sorted(s["found"], np.uint32)
                for s in (row.sent if row.sent is not None else ())
            ]
            hits = np.concatenate(hits) if hits else np.empty(0, np.uint64)
            starts = chunk.candidates(hits, n_buckets)
            keys, routes = chunk.window_hashes(starts)
            ids, places = chunk.order(starts)
            order, new, _ = _earliest(keys, ids, places)
            order = order[new]
            buckets = (_placed(routes[order], n_buckets) >> np.uint64(32)).astype(np.int64)
            order = order[np.argsort(buckets, kind="stable")]
            buckets = np.sort(buckets)
            yield pd.DataFrame(
                [
                    (
                        bucket,
                        chunk.number,
                        pack_sorted(keys[order[part]]),
                        pack(ids[order[part]]),
                        pack(places[order[part]]),
                    )
                    for bucket, part in _equal_runs(buckets)
                ],
                columns=["bucket", "chunk", "keys", "ids", "places"],
            )

    schema = "bucket bigint, chunk bigint, keys binary, ids binary, places binary"
    return chunks.mapInPandas(extend, schema)


def _repeat(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """For each chunk, the windows of a bucket that start earlier in another one."""
    parts = [unpack_sorted(d, np.uint64) for d in group["keys"]]
    keys = np.concatenate(parts)
    ids = np.concatenate([unpack(d, np.int64) for d in group["ids"]])
    places = np.concatenate([unpack(d, np.uint32) for d in group["places"]])
    origin = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    order, _, later = _earliest(keys, ids, places)
    repeats = np.zeros(len(keys), bool)
    repeats[order[later]] = True
    chunks = group["chunk"].to_numpy()
    replies = [
        (chunks[i], key[0], pack_sorted(part[repeats[origin == i]]))
        for i, part in enumerate(parts)
        if repeats[origin == i].any()
    ]
    return pd.DataFrame(replies, columns=["chunk", "bucket", "found"])


def _cut(chunks: DataFrame, window: int, n_buckets: int) -> DataFrame:
    """Each document without its repeats, and where those were."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in (r for b in batches for r in b.itertuples(index=False)):
            chunk = Chunk(row, window)
            starts = chunk.window_starts
            keys, _ = chunk.window_hashes(starts)
            order, _, later = _earliest(keys, *chunk.order(starts))
            repeats = np.zeros(len(starts), bool)
            repeats[order[later]] = True
            found = [unpack_sorted(s["found"], np.uint64) for s in (row.sent if row.sent is not None else ())]
            if found:
                repeats |= np.isin(keys, np.concatenate(found))
            steps = np.zeros(len(chunk.words) + 1, np.int64)
            np.add.at(steps, starts[repeats], 1)
            np.add.at(steps, starts[repeats] + window, -1)
            removed = np.cumsum(steps[:-1]) > 0
            yield pd.DataFrame(_documents(chunk, removed), columns=_CUT_COLUMNS)

    return chunks.mapInPandas(cut, _CUT)


_CUT = (
    "doc_id bigint, nameless boolean, n_words bigint, n_removed bigint, kept string, "
    "removed array<struct<start: bigint, end: bigint>>"
)
_CUT_COLUMNS = ["doc_id", "nameless", "n_words", "n_removed", "kept", "removed"]


def _documents(chunk: Chunk, removed: np.ndarray) -> Iterator[tuple]:
    for i, (start, length) in enumerate(zip(chunk.starts, chunk.lengths, strict=True)):
        words, gone = chunk.words[start : start + length], removed[start : start + length]
        edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
        yield (
            int(chunk.ids[i]),
            bool(chunk.nameless[i]),
            int(length),
            int(gone.sum()),
            b" ".join(compress(words, ~gone)).decode(errors="replace"),
            [{"start": int(s), "end": int(e)} for s, e in edges],
        )


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW_WORDS,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_words: int = BUCKET_WORDS,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, removed`` per row of ``docs`` (``doc_id, text``).

    Every word inside a window of ``window`` words that also starts earlier is removed; ``kept``
    joins the others by one space, and ``removed`` has the word ranges of maximal repeats.
    """
    chunks = stage(_chunks(docs, chunk_bytes), "chunks")
    n_words = chunks.agg(F.sum("n_words")).first()[0] or 0
    n_buckets = -(-n_words // bucket_words) or 1
    reply = "chunk bigint, bucket bigint, found binary"
    hits = _probe(chunks, window, n_buckets).groupBy("bucket").applyInPandas(_hit, reply)
    windows = _extend(_answered(chunks, hits), window, n_buckets)
    repeats = windows.groupBy("bucket").applyInPandas(_repeat, reply)
    # The cut reads what the extension found: stored, so that the extension runs once.
    found = stage(repeats, "repeats")
    cut = _cut(_answered(chunks, found), window, n_buckets)
    return cut.select(
        F.when(~F.col("nameless"), F.col("doc_id")).alias("doc_id"),
        *_CUT_COLUMNS[2:],
    )


def op2(docs: DataFrame) -> DataFrame:
    """Counts and a digest of what is kept of each document."""
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


OP2_SQL = f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), windows AS (
  SELECT r, doc_id, i, hash(w[i:i + {WINDOW_WORDS - 1}]) AS h, md5(array_to_string(w[i:i + {WINDOW_WORDS - 1}], ' ')) AS m
  FROM (SELECT r, doc_id, w, unnest(generate_series(1, len(w) - {WINDOW_WORDS - 1})) AS i FROM split WHERE len(w) >= {WINDOW_WORDS})
), repeats AS (
  SELECT r, i FROM (SELECT r, i, rank() OVER (PARTITION BY h, m ORDER BY doc_id NULLS LAST, i) AS k FROM windows) WHERE k > 1
), covered AS (
  SELECT r, list(DISTINCT i + k) AS c FROM repeats, generate_series(0, {WINDOW_WORDS - 1}) AS t(k) GROUP BY r
), kept AS (
  SELECT doc_id, w, coalesce(len(c), 0) AS n_removed,
    CASE WHEN c IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(c, i)) END AS k
  FROM split LEFT JOIN covered USING (r)
)
SELECT doc_id, len(w)::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
  sha256(array_to_string(k, ' ')) AS kept_sha256
FROM kept
"""
