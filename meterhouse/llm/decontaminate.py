"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A document leaks an item when it holds at least ``threshold`` of the item's distinct five-word
shingles (A-Z lower-cased). Items are partitioned by their number of shingles, in powers of two. An
item of m shingles is searched for by its ``m - ceil(threshold * m) + 1`` least shingle hashes: a
document that leaks it misses fewer shingles than that, so it holds one of them and none is lost. All
signatures of a partition lie below a cutoff, so of a document's shingles only those below it, its own
MinHash sketch for that partition, are looked up, and a document with too few shingles for a partition
is not looked up there at all. Candidates are then verified on the shingles themselves.

Items of at most ``BLOCK_BYTES`` of text are sent out, and nothing of the documents is shuffled. Beyond
that, signatures are a table that Spark makes and joins: a document's hashes below the cutoffs that a Bloom
filter of ``BLOOM_BITS`` of all signatures lets through meet it by partition and hash, and the candidates
found, one for each pair of texts however often either is repeated, are verified by joins with both. Both
ways verify the same shingles, so they give the same rows.

A null or empty text holds nothing, and an item of fewer than five words has no shingles and leaks
nowhere. Null ids, repeated rows and repeated items are reported like any others, row by row. An empty
benchmark leaks nothing. Further columns pass through.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhouse.llm.tables import documents, fresh
from meterhouse.llm.words import WordHashes, rolling
from meterhouse.session import write_and_read

WORDS = 5
THRESHOLD = 0.8
BLOCK_BYTES = 32_000_000
BLOOM_BITS = 1 << 28
BLOOM_PART = 1 << 19  # bits of the filter that are put together in one place
CHUNK_WORDS = 1_000_000
LEAK = T.ArrayType(
    T.StructType()
    .add("item_id", T.LongType())
    .add("shared", T.LongType())
    .add("n_shingles", T.LongType())
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def shingles_of(words: list[bytes]) -> set[bytes]:
    return {b" ".join(words[i : i + WORDS]) for i in range(len(words) - WORDS + 1)}


def signature(words: list[bytes], hashes: WordHashes, threshold: float) -> tuple[int, np.ndarray]:
    """The number of distinct shingles of an item, and its least shingle hashes."""
    size = len(shingles_of(words))
    minima = np.unique(rolling(hashes.of(words), WORDS))
    return size, minima[: size - enough(size, threshold) + 1]


def enough(size: int, threshold: float) -> int:
    """The least number of shared shingles that leaks an item of ``size``."""
    return math.ceil(threshold * size - 1e-9)


class ItemIndex:
    """Signatures of one block of items, by size partition."""

    def __init__(self, items: list[tuple[int | None, str | None]], threshold: float):
        self.threshold, self.ids, self.shingles = threshold, [], []
        parts: dict[int, list[tuple[int, int]]] = defaultdict(list)
        least: dict[int, int] = {}
        hashes = WordHashes()
        for item_id, text in items:
            words = words_of(text)
            if len(words) < WORDS:
                continue
            n = len(self.ids)
            self.ids.append(item_id)
            self.shingles.append(shingles_of(words))
            size = len(self.shingles[n])
            part = size.bit_length()
            least[part] = min(least.get(part, size), enough(size, threshold))
            parts[part] += [(int(h), n) for h in signature(words, hashes, threshold)[1]]
        self.parts = []
        for part, found in sorted(parts.items()):
            found.sort()
            keys = np.array([h for h, _ in found], np.uint64)
            self.parts.append((least[part], keys, np.array([n for _, n in found])))

    def candidates(self, hashes: np.ndarray, doc: np.ndarray, size: np.ndarray) -> set:
        """(document, item) pairs that share a signature value; size is each document's shingles."""
        pairs = set()
        for least, keys, items in self.parts:
            low = np.flatnonzero((hashes <= keys[-1]) & (size[doc] >= least))
            begin = np.searchsorted(keys, hashes[low], "left")
            hit = keys[np.minimum(begin, len(keys) - 1)] == hashes[low]
            low, begin = low[hit], begin[hit]
            until = np.searchsorted(keys, hashes[low], "right")
            for d, a, b in zip(doc[low].tolist(), begin.tolist(), until.tolist()):
                pairs.update((d, n) for n in items[a:b].tolist())
        return pairs

    def verified(self, words: list[bytes], items: list[int]) -> list[dict]:
        have, found = shingles_of(words), []
        for n in sorted(items):
            wanted = self.shingles[n]
            shared = len(wanted & have)
            if shared >= enough(len(wanted), self.threshold):
                found.append(
                    {"item_id": self.ids[n], "shared": shared, "n_shingles": len(wanted)}
                )
        return found


def search(index: ItemIndex, texts: list[str | None], hashes: WordHashes) -> list[list[dict]]:
    """Leaked items of each text, a chunk of about ``CHUNK_WORDS`` words at a time."""
    out: list[list[dict]] = [[] for _ in texts]
    at = 0
    while at < len(texts):
        chunk, total, first = [], 0, at
        while at < len(texts) and (not chunk or total < CHUNK_WORDS):
            chunk.append(words_of(texts[at]))
            total, at = total + len(chunk[-1]), at + 1
        length = np.array([len(w) for w in chunk])
        ids = np.concatenate([hashes.of(w) for w in chunk])
        end = np.repeat(np.cumsum(length), length)
        doc = np.repeat(np.arange(len(chunk)), length)
        run = rolling(ids, WORDS)
        inside = np.arange(len(run)) + WORDS <= end[: len(run)]
        pairs = index.candidates(
            run[inside], doc[: len(run)][inside], np.maximum(length - WORDS + 1, 0)
        )
        by_doc = defaultdict(list)
        for d, n in pairs:
            by_doc[d].append(n)
        for d, items in by_doc.items():
            out[first + d] = index.verified(chunk[d], items)
    return out


def searcher(index: Broadcast):
    @F.arrow_udf(LEAK)
    def leaked(texts: pa.Array) -> pa.Array:
        rows = search(index.value, texts.to_pylist(), WordHashes())
        kind = pa.struct([(n, pa.int64()) for n in ("item_id", "shared", "n_shingles")])
        return pa.array(rows, pa.list_(kind))

    return leaked


def leaks(text: Column, items: DataFrame, threshold: float = THRESHOLD) -> Column:
    """Items (item_id, text) that each text leaks, as an array of (item_id, shared, n_shingles).

    All items are sent out: for a benchmark of at most ``BLOCK_BYTES``.
    """
    rows = items.select(F.col("item_id").cast("long"), "text").collect()
    index = ItemIndex([(r.item_id, r.text) for r in rows], threshold)
    return searcher(items.sparkSession.sparkContext.broadcast(index))(text)


def is_small(items: DataFrame) -> bool:
    return (items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0) <= BLOCK_BYTES


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class Bloom:
    """Which hashes may be among those added; two bits each."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(BLOOM_BITS - 1)
        return tuple((x & mask).astype(np.int64) for x in (hashes, hashes >> np.uint64(28)))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in self.places(hashes):
            found &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return found


def bloom_of(signatures: DataFrame) -> Bloom:
    """The filter of all signature hashes: of its parts, each put together in one group."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.unique(np.concatenate(Bloom.places(hashes)))
            parts = [pa.array(at // BLOOM_PART), pa.array((at % BLOOM_PART).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(parts, ["part", "at"])

    # a part has BLOOM_PART different places at most
    pairs = signatures.select("hash").mapInArrow(places, "part long, at int").distinct()
    bits = np.zeros(BLOOM_BITS // 8, np.uint8)

    def put_together(key: tuple, rows: pa.Table) -> pa.Table:
        own = np.zeros(BLOOM_PART, np.uint8)
        own[rows["at"].to_numpy()] = 1
        packed = np.packbits(own, bitorder="little").tobytes()
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([packed], pa.binary())})

    for row in pairs.groupBy("part").applyInArrow(put_together, "part long, bits binary").toLocalIterator():
        at = row.part * BLOOM_PART // 8
        bits[at : at + BLOOM_PART // 8] = np.frombuffer(row.bits, np.uint8)
    return Bloom(bits)


def leaked_pairs(texts: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, item_id, shared, n_shingles): items that the text of each key leaks, all by joins.

    ``texts`` has (key, text), rows of equal texts included. A written table.
    """
    spark = texts.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text", text_key(F.col("text")).alias("item"))
    distinct = items.groupBy("item").agg(F.min("text").alias("item_text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            out = {"part": [], "hash": [], "item": [], "least": []}
            for key, text in zip(batch.column("item"), batch.column("item_text"), strict=True):
                words = words_of(text.as_py())
                if len(words) >= WORDS:
                    size, minima = signature(words, hashes, threshold)
                    out["part"] += [size.bit_length()] * len(minima)
                    out["hash"] += minima.view(np.int64).tolist()
                    out["item"] += [key.as_py()] * len(minima)
                    out["least"] += [enough(size, threshold)] * len(minima)
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out)
            )

    schema = "part int, hash long, item binary, least long"
    signatures = write_and_read(distinct.mapInArrow(sign, schema), "signatures")
    # hashes are unsigned; with the top bit turned they order as longs do
    turned = F.col("hash").bitwiseXOR(F.lit(-(1 << 63)))
    bounds = signatures.groupBy("part").agg(F.max(turned).alias("cutoff"), F.min("least").alias("least"))
    # a row for each power of two
    parts = [(r.part, np.uint64(r.cutoff + (1 << 63)), r.least) for r in bounds.collect()]
    sent = spark.sparkContext.broadcast(bloom_of(signatures))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, names = WordHashes(), ["part", "hash", "key"]
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text"), strict=True):
                every = rolling(hashes.of(words_of(text.as_py())), WORDS)
                own = np.unique(every)
                near = own[sent.value.has(own)]
                for part, cutoff, least in parts if len(near) else ():
                    low = near[near <= cutoff] if len(every) >= least else near[:0]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(low), part, np.int32)),
                            pa.array(low.view(np.int64)),
                            pa.array([key.as_py()] * len(low), pa.binary()),
                        ],
                        names,
                    )

    probes = texts.mapInArrow(probe, "part int, hash long, key binary").distinct()
    found = probes.join(signatures.drop("least"), ["part", "hash"]).select("key", "item").distinct()
    candidates = write_and_read(found, "candidates")
    wanted = texts.join(candidates.select("key").distinct(), "key", "left_semi")
    wanted = wanted.groupBy("key").agg(F.min("text").alias("text"))
    met = candidates.join(distinct, "item").join(wanted, "key")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, have = None, set()  # candidates of a text come one after the other
        for batch in batches:
            shared, sizes = [], []
            texts_, keys = batch.column("text"), batch.column("key").to_pylist()
            for n, item in enumerate(batch.column("item_text")):
                if keys[n] != last:
                    last, have = keys[n], shingles_of(words_of(texts_[n].as_py()))
                want = shingles_of(words_of(item.as_py()))
                both = len(want & have)
                shared.append(both if both >= enough(len(want), threshold) else None)
                sizes.append(len(want))
            columns = [batch.column("key"), batch.column("item"), pa.array(shared, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "item", "shared", "n_shingles"])

    schema = "key binary, item binary, shared long, n_shingles long"
    pairs = met.select("key", "item", "text", "item_text").mapInArrow(verify, schema)
    pairs = pairs.where("shared is not null").join(items.select("item", "item_id"), "item").drop("item")
    return write_and_read(pairs, "leaks")


def contamination(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, shared, n_shingles, containment) of every leak."""
    if is_small(items):
        found = docs.select(
            "doc_id", F.explode(leaks(F.col("text"), items, threshold)).alias("leak")
        ).select("doc_id", "leak.*")
    else:
        keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("key"))
        pairs = leaked_pairs(keyed.select("key", "text"), items, threshold)
        found = keyed.select("doc_id", "key").join(pairs, "key").drop("key")
    return found.select(
        "doc_id", "item_id", "shared", "n_shingles",
        (F.col("shared") / F.col("n_shingles")).alias("containment"),
    )


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that leak no item, with their columns."""
    mark = fresh(docs, "leaks")
    if is_small(items):
        marked = docs.withColumn(mark, F.size(leaks(F.col("text"), items, threshold)))
        return marked.where(F.col(mark) == 0).drop(mark)
    texts = docs.select(text_key(docs["text"]).alias("key"), "text")
    leaked = leaked_pairs(texts, items, threshold).select(F.col("key").alias(mark)).distinct()
    return docs.join(leaked, text_key(docs["text"]) == F.col(mark), "left_anti")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of a document and a benchmark item that it holds."""
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return contamination(documents(spark, folder), items)


ORACLE = r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')
  FROM benchmark),
s AS (
  SELECT DISTINCT kind, id, array_to_string(words[i : i + 4], ' ') AS shingle
  FROM (SELECT kind, id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
sizes AS (SELECT id AS item_id, count(*) AS n FROM s WHERE kind = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared, any_value(n) AS n_shingles,
  count(*) / any_value(n) AS containment
FROM s AS d JOIN s AS i ON d.kind = 'd' AND i.kind = 'i' AND d.shingle = i.shingle
JOIN sizes ON sizes.item_id = i.id
GROUP BY d.id, i.id HAVING count(*) >= ceil(0.8 * any_value(n) - 1e-9)
"""
