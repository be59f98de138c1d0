"""Exact substring dedup: fixed-block anchors, rolling probes, extension to maximal exact repeats.

Every document is cut into non-overlapping anchors of ``(window + 1) // 2`` words, so each window of
``window`` words holds a whole anchor of its own document. Anchors of all documents form the index. All
rolling runs of an anchor's length, of all documents, are probes. A run whose hash is in the index and
starts in two places or more is a hit, and only a window that holds a hit can repeat. Hits are extended
to all windows that hold them; a window whose word sequence starts in two places or more is kept, which
is judged by 128 bits of hash over all such windows, and the union of kept windows is the set of maximal
exact repeats.

The two counts go by ranges of the hash. A block of documents sends each range its distinct hashes, sorted
and packed, and gets back those that repeat; so however often a passage repeats, a block sends it once and
no pair of its copies is ever formed. Texts meet the answers in compressed blocks.

A null or empty text has no words. Rows with a null id and repeated rows count as documents of their own,
and each comes back as a row; two equal rows of ``window`` words or more thus remove each other's words.
An empty table gives an empty result. ``docs`` should be a scan or a written table: blocks are numbered by
partition and place, which has to come out the same when they are cut again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhouse.llm.tables import documents
from meterhouse.llm.words import FACTOR, WordHashes, rolling

WINDOW = 35
BLOCK_CHARS = 8_000_000
RANGE_CHARS = 16_000_000  # of the corpus, for each range of hashes
LEAST_RANGES = 64
SPARE_BITS = 8  # of an anchor's hash beyond those that number all runs
OTHER_FACTOR = np.uint64(0xD6E8FEB86659FD93)
ROW = "range int, block long, body binary"


class Packing:
    """Compressed bodies of a task."""

    def __init__(self):
        self.zip, self.unzip = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()

    def planes(self, values: np.ndarray) -> bytes:
        """Values whose high bytes are alike, byte by byte."""
        return self.zip.compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())

    def from_planes(self, body: bytes) -> np.ndarray:
        planes = np.frombuffer(self.unzip.decompress(body), np.uint8).reshape(8, -1)
        return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.uint64)

    def rising(self, values: np.ndarray) -> bytes:
        """Values in ascending order, by their differences."""
        return self.planes(np.diff(values, prepend=np.uint64(0)))

    def from_rising(self, body: bytes) -> np.ndarray:
        return np.cumsum(self.from_planes(body), dtype=np.uint64)


class Block:
    """Texts that lie together, as one run of words with the ends of the documents."""

    def __init__(self, texts: list[bytes]):
        self.words = [text.split() for text in texts]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.sizes)
        known = WordHashes()
        self.ids = np.concatenate([known.of(w) for w in self.words] + [np.zeros(0, np.uint64)])
        self.begin = np.repeat(self.ends - self.sizes, self.sizes)
        self.end = np.repeat(self.ends, self.sizes)

    def runs(self, width: int, factor: np.uint64 = FACTOR) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of ``width`` words, and whether it lies within one document."""
        hashes = rolling(self.ids, width, factor)
        return hashes, np.arange(len(hashes)) + width <= self.end[: len(hashes)]

    def holding(self, marked: np.ndarray, inner: int, window: int) -> np.ndarray:
        """Windows, by their start, that hold a marked run of ``inner`` words."""
        size = max(0, len(self.ids) - window + 1)
        count = np.concatenate(([0], np.cumsum(marked)))
        at = np.arange(size)
        return count[at + window - inner + 1] > count[at]


def cut_blocks(
    batches: Iterator[pa.RecordBatch], block_chars: int
) -> Iterator[tuple[int, pa.Array, list[bytes]]]:
    n, size, ids, texts = TaskContext.get().partitionId() << 32, 0, [], []
    for batch in batches:
        for i, text in enumerate(batch.column("text")):
            texts.append((text.as_py() or "").encode("utf-8", "replace"))
            ids.append(batch.column("doc_id").slice(i, 1))
            size += len(texts[-1])
            if size >= block_chars:
                yield n, pa.concat_arrays(ids), texts
                n, size, ids, texts = n + 1, 0, [], []
    if ids:
        yield n, pa.concat_arrays(ids), texts


def by_range(values: np.ndarray, shift: int, ranges: int) -> Iterator[tuple[int, slice]]:
    """The part of ascending ``values`` in each range; ``shift`` leaves 32 bits."""
    of = ((values >> np.uint64(shift)) * np.uint64(ranges)) >> np.uint64(32)
    cuts = np.flatnonzero(np.diff(of, prepend=np.uint64(ranges)))
    for a, b in zip(cuts, np.append(cuts[1:], len(of))):
        yield int(of[a]), slice(int(a), int(b))


def row_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.binary()][-len(names) :]
    columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)] if rows else [
        pa.array([], t) for t in types
    ]
    return pa.RecordBatch.from_arrays(columns, names)


def joined_body(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def split_body(body: bytes) -> list[bytes]:
    parts, at = [], 0
    while at < len(body):
        size = int.from_bytes(body[at : at + 4], "little")
        parts.append(body[at + 4 : at + 4 + size])
        at += 4 + size
    return parts


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row: the words left, joined by one space."""
    docs = docs.select("doc_id", "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(LEAST_RANGES, total // RANGE_CHARS)
    bits = min(64, max(40, int(total).bit_length() + SPARE_BITS))
    anchor = (window + 1) // 2
    drop = np.uint64(64 - bits)

    def anchor_runs(block: Block) -> tuple[np.ndarray, np.ndarray]:
        hashes, inside = block.runs(anchor)
        return hashes >> drop, inside

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct anchor-length runs of each block: anchors, and whether runs start twice."""
        packing = Packing()
        for n, _, texts in cut_blocks(batches, block_chars):
            block = Block(texts)
            hashes, inside = anchor_runs(block)
            place = np.arange(len(hashes)) - block.begin[: len(hashes)]
            is_anchor = place[inside] % anchor == 0
            values, at, count = np.unique(
                hashes[inside], return_inverse=True, return_counts=True
            )
            index = np.bincount(at, is_anchor, len(values)) > 0
            rows = []
            for r, part in by_range(values, bits - 32, ranges):
                flags = index[part] + 2 * (count[part] > 1)
                body = joined_body(
                    packing.rising(values[part]), packing.zip.compress(flags.astype(np.uint8))
                )
                rows.append((r, n, body))
            yield row_batch(rows, ["range", "block", "body"])

    def find_hits(rows: pa.Table) -> pa.Table:
        """For each block its runs that are an anchor somewhere and start in two places or more."""
        packing = Packing()
        values, flags = [], []
        for body in rows.column("body"):
            a, b = split_body(body.as_py())
            values.append(packing.from_rising(a))
            flags.append(np.frombuffer(packing.unzip.decompress(b), np.uint8))
        every, at = np.unique(np.concatenate(values), return_inverse=True)
        flag = np.concatenate(flags)
        index = np.bincount(at, flag & 1, len(every)) > 0
        twice = np.bincount(at, 1 + (flag >> 1), len(every)) > 1
        hit = (index & twice)[at]
        return answers(rows, values, hit, packing.rising)

    def answers(rows: pa.Table, values: list[np.ndarray], keep: np.ndarray, pack) -> pa.Table:
        ends = np.cumsum([len(v) for v in values])
        parts = [v[keep[e - len(v) : e]] for v, e in zip(values, ends)]
        some = [(b.as_py(), pack(p)) for b, p in zip(rows.column("block"), parts) if len(p)]
        return pa.Table.from_batches([row_batch(some, ["back", "body"])])

    def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=6)
        for n, ids, texts in cut_blocks(batches, block_chars):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(1, n)),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([zip_.compress(joined_body(*texts))], pa.binary()),
                ],
                ["block", "doc_ids", "texts"],
            )

    def open_block(texts: pa.Table) -> Block:
        data = zstandard.ZstdDecompressor().decompress(texts.column("texts")[0].as_py())
        return Block(split_body(data))

    def known(rows: pa.Table, unpack) -> np.ndarray:
        found = [unpack(body.as_py()) for body in rows.column("body")]
        return np.sort(np.concatenate(found + [np.zeros(0, np.uint64)]))

    def among(values: np.ndarray, found: np.ndarray) -> np.ndarray:
        if not len(found):
            return np.zeros(len(values), bool)
        at = np.minimum(np.searchsorted(found, values), len(found) - 1)
        return found[at] == values

    def extend(texts: pa.Table, hits: pa.Table) -> pa.Table:
        """Distinct windows of a block that hold a hit, and which of them start twice in it."""
        packing, block = Packing(), open_block(texts)
        hashes, inside = anchor_runs(block)
        marked = inside & among(hashes, known(hits, packing.from_rising))
        high, whole = block.runs(window)
        low, _ = block.runs(window, OTHER_FACTOR)
        chosen = whole & block.holding(marked, anchor, window)
        high, low = high[chosen], low[chosen]
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))[: len(high)]
        count = np.diff(np.append(np.flatnonzero(new), len(high)))
        high, low = high[new], low[new]
        rows = []
        for r, part in by_range(high, 32, ranges):
            flags = (count[part] > 1).astype(np.uint8)
            body = joined_body(
                packing.rising(high[part]), low[part].tobytes(), packing.zip.compress(flags)
            )
            rows.append((r, texts.column("block")[0].as_py(), body))
        return pa.Table.from_batches([row_batch(rows, ["range", "block", "body"])])

    def find_repeats(rows: pa.Table) -> pa.Table:
        """For each block the windows that start in two places or more, by their first 64 bits."""
        packing = Packing()
        high, low, flags = [], [], []
        for body in rows.column("body"):
            a, b, c = split_body(body.as_py())
            high.append(packing.from_rising(a))
            low.append(np.frombuffer(b, np.uint64))
            flags.append(np.frombuffer(packing.unzip.decompress(c), np.uint8))
        every = np.empty(sum(map(len, high)), [("high", "<u8"), ("low", "<u8")])
        every["high"], every["low"] = np.concatenate(high), np.concatenate(low)
        distinct, at = np.unique(every, return_inverse=True)
        twice = np.bincount(at, 1 + np.concatenate(flags), len(distinct)) > 1
        return answers(rows, low, twice[at], packing.planes)

    def remove(texts: pa.Table, repeats: pa.Table) -> pa.Table:
        packing, block = Packing(), open_block(texts)
        low, whole = block.runs(window, OTHER_FACTOR)
        repeated = whole & among(low, known(repeats, packing.from_planes))
        change = np.zeros(len(block.ids) + 1, np.int64)
        starts = np.flatnonzero(repeated)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + window, -1)
        gone = np.cumsum(change[:-1]) > 0
        removed, kept = [], []
        for words, end in zip(block.words, block.ends.tolist()):
            mine = gone[end - len(words) : end]
            removed.append(int(mine.sum()))
            if removed[-1]:
                words = [words[i] for i in np.flatnonzero(~mine).tolist()]
            kept.append(b" ".join(words).decode())
        return pa.table(
            {
                "doc_id": texts.column("doc_ids").combine_chunks().flatten(),
                "n_words": pa.array(block.sizes),
                "n_removed": pa.array(removed, pa.int64()),
                "kept": pa.array(kept, pa.string()),
            }
        )

    id_type = docs.schema["doc_id"].dataType
    text_row = (
        T.StructType()
        .add("block", T.LongType())
        .add("doc_ids", T.ArrayType(id_type))
        .add("texts", T.BinaryType())
    )
    result = (
        T.StructType()
        .add("doc_id", id_type)
        .add("n_words", T.LongType())
        .add("n_removed", T.LongType())
        .add("kept", T.StringType())
    )
    blocks = docs.mapInArrow(texts_of, text_row)
    hits = (
        docs.mapInArrow(probe, ROW).groupBy("range").applyInArrow(find_hits, "back long, body binary")
    )
    windows = blocks.groupBy("block").cogroup(hits.groupBy("back")).applyInArrow(extend, ROW)
    repeats = windows.groupBy("range").applyInArrow(find_repeats, "back long, body binary")
    blocks = docs.mapInArrow(texts_of, text_row)
    return blocks.groupBy("block").cogroup(repeats.groupBy("back")).applyInArrow(remove, result)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document left without those in repeated windows of 35."""
    return remove_repeats(documents(spark, folder)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM w),
s AS (SELECT doc_id, i, md5_number(array_to_string(words[i : i + 34], ' ')) AS window_hash FROM p),
r AS (SELECT window_hash FROM s GROUP BY window_hash HAVING count(*) > 1),
gone AS (
  SELECT doc_id, list(DISTINCT j) AS places
  FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM s SEMI JOIN r USING (window_hash))
  GROUP BY doc_id),
kept AS (
  SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
    CASE WHEN places IS NULL THEN words ELSE list_transform(
      list_filter(list_zip(words, range(1, len(words) + 1)),
        lambda x: NOT list_contains(places, x[2])), lambda x: x[1]) END AS left_words
  FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(left_words, ' '), '')) AS kept_sha256
FROM kept
"""
