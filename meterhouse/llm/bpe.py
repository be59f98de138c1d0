"""Byte-level BPE over a corpus: every distinct word is encoded once, wherever it occurs.

Texts are cut into pre-tokens by the tokenizer's pattern. Documents that lie together form a block, in
which each distinct pre-token has a number, frequent ones a small one; a document is then the sequence
of these numbers by position. Only the distinct words of the blocks are shuffled by word, those of a
block for one bucket of words packed into a row: each distinct word of the corpus is encoded once in
its bucket, its ids go back to the blocks that hold it, and a block puts the ids in place of its
numbers, position by position. However common a word is, a block sends it once. Texts are cut once: words
and sequences leave in the same shuffle, dealt by one key, which both readers take their part from.
Decoding joins every id with the token-byte table, whose size is that of the vocabulary.

A null or empty text has no ids. Rows with a null id and repeated rows are encoded each for itself;
every row of the input is one row of the result. An empty table gives an empty result. ``docs`` should
be a scan or a written table: blocks are numbered by partition and place, which has to come out the
same when a lost part of the shuffle is cut again.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhouse.llm.tables import documents

BLOCK_CHARS = 4_000_000
BUCKET_CHARS = 64_000_000  # of the corpus, for each bucket of words
LEAST_BUCKETS = 64
SHORT = 64  # bytes
NUMBER_BYTES = 4

# Code points not assigned in Unicode 16, which the tokenizer library's tables stop at,
# but letters or numbers for newer tables. To the tokenizer they are neither.
NEWER = regex.compile(
    "[\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4"
    "\uA7DD\uA7E2\uA7F1\uAB6C-\uAB6D\U000107BB-\U000107BF\U00010940-\U00010959"
    "\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB"
    "\U00011DE0-\U00011DE9\U00011DF1\U0001246F\U00012475-\U0001247F\U00012550-\U00012686"
    "\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3\U00016FF2-\U00016FF6\U000187F8-\U000187FF"
    "\U00018CD6-\U00018CDA\U00018D09-\U00018D20\U00018D80-\U00018DF2\U00018E00-\U00019191"
    "\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168\U0001D6A6\U0001DF1F-\U0001DF24"
    "\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE"
    "\U0001E6E0-\U0001E6E2\U0001E6E4-\U0001E6E5\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4"
    "\U0001E6FE-\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD"
    "\U000323B0-\U00033479\U0003D000-\U0003FC3F]"
)
NEITHER = "\u2603"  # stands for one of them while a text is cut
IDS = T.ArrayType(T.IntegerType())


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a ranks file, a token in base64 and its id on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(n) for t, n in map(bytes.split, lines)}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: always the pair of least rank merges, the leftmost of equal ones."""
    if word in ranks:
        return [ranks[word]]
    return encode_short(word, ranks) if len(word) <= SHORT else encode_long(word, ranks)


def encode_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """All pairs are looked through for each merge."""
    never = len(ranks) + 256
    rank_of = ranks.get
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [rank_of(a + b, never) for a, b in zip(parts, parts[1:])]
    while pairs:
        least = min(pairs)
        if least == never:
            break
        at = pairs.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = rank_of(parts[at - 1] + parts[at], never)
        if at < len(pairs):
            pairs[at] = rank_of(parts[at] + parts[at + 1], never)
    return [ranks[p] for p in parts]


def encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Pairs wait in a heap, so a very long pre-token takes little more than linear time."""
    size = len(word)
    end = list(range(1, size + 1))  # of the part that begins at each place; 0: no part begins here
    before = list(range(-1, size - 1))
    heap = []

    def offer(at: int) -> None:
        if at >= 0 and end[at] < size:
            to = end[end[at]]
            rank = ranks.get(word[at:to])
            if rank is not None:
                heapq.heappush(heap, (rank, at, to))

    for at in range(size):
        offer(at)
    while heap:
        _, at, to = heapq.heappop(heap)
        middle = end[at]
        if not middle or middle >= to or end[middle] != to:
            continue  # one of its parts has merged meanwhile
        end[at], end[middle] = to, 0
        if to < size:
            before[to] = at
        offer(before[at])
        offer(at)
    ids, at = [], 0
    while at < size:
        ids.append(ranks[word[at : end[at]]])
        at = end[at]
    return ids


def packed_words(words: list[bytes], zip_: zstandard.ZstdCompressor) -> bytes:
    sizes = np.array([len(w) for w in words], "<u4").tobytes()
    return zip_.compress(len(words).to_bytes(4, "little") + sizes + b"".join(words))


def unpacked_words(body: bytes, unzip: zstandard.ZstdDecompressor) -> Iterator[bytes]:
    data = unzip.decompress(body)
    count = int.from_bytes(data[:4], "little")
    at = 4 + 4 * count
    for size in np.frombuffer(data, "<u4", count, 4).tolist():
        yield data[at : at + size]
        at += size


def class_ranges(name: str) -> str:
    """The code points below U+10000 of a character class, as ranges for a set of characters."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    runs = regex.finditer(f"{name}+", NEWER.sub(NEITHER, every))
    return "".join(f"\\u{m.start_point:04x}-\\u{m.end_point:04x}" for m in map(Run, runs))


class Run:
    """First and last code point of a match in the text of all code points."""

    def __init__(self, found: regex.Match):
        self.start_point, self.end_point = (
            n + 0x800 * (n >= 0xD800) for n in (found.start(), found.end() - 1)
        )


def plain_pattern(pattern: str) -> re.Pattern | None:
    """The same pattern with its classes spelled out, three times as fast; None if it has others."""
    names = {r"\p{L}": class_ranges(r"\p{L}"), r"\p{N}": class_ranges(r"\p{N}")}
    names[r"\s"] = class_ranges(r"\s")
    parts = re.split(r"(\[[^\]]*\])", pattern)
    for i, part in enumerate(parts):
        for name, ranges in names.items():
            part = part.replace(name, ranges if i % 2 else f"[{ranges}]")
        parts[i] = part if i % 2 else part.replace(r"\S", f"[^{names[chr(92) + 's']}]")
    spelled = "".join(parts)
    return None if re.search(r"\\(?!u)|\(\?[^!=:]", spelled) else re.compile(spelled)


class PreTokens:
    """Cuts texts by a tokenizer's pattern."""

    def __init__(self, pattern: str):
        self.full, self.plain = regex.compile(pattern), plain_pattern(pattern)

    def __call__(self, text: str) -> list[str]:
        if self.plain and (text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text)):
            return self.plain.findall(text)
        if not NEWER.search(text):
            return self.full.findall(text)
        cut = self.full.finditer(NEWER.sub(NEITHER, text))
        return [text[m.start() : m.end()] for m in cut]


class Numbers(dict):
    """Numbers words in the order in which they first occur."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def packed(numbers: np.ndarray, zip_: zstandard.ZstdCompressor) -> bytes:
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, NUMBER_BYTES).T
    return zip_.compress(planes.tobytes())


def unpacked(body: bytes, unzip: zstandard.ZstdDecompressor) -> np.ndarray:
    planes = np.frombuffer(unzip.decompress(body), np.uint8).reshape(NUMBER_BYTES, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class Blocks:
    """Cuts the batches of a task into blocks: ids and numbers of its documents, and its words."""

    def __init__(self, pattern: str, block_chars: int):
        self.pattern, self.block_chars = pattern, block_chars

    def __call__(
        self, batches: Iterator[pa.RecordBatch]
    ) -> Iterator[tuple[int, pa.Array, list[np.ndarray], list[str]]]:
        cut = PreTokens(self.pattern)
        n, size, ids, found, numbers = TaskContext.get().partitionId() << 32, 0, [], [], Numbers()
        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                text = text.as_py() or ""
                words = cut(text)
                found.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                ids.append(batch.column("doc_id").slice(i, 1))
                size += len(text)
                if size >= self.block_chars:
                    yield n, pa.concat_arrays(ids), *self.by_frequency(found, numbers)
                    n, size, ids, found, numbers = n + 1, 0, [], [], Numbers()
        if ids:
            yield n, pa.concat_arrays(ids), *self.by_frequency(found, numbers)

    @staticmethod
    def by_frequency(found: list[np.ndarray], numbers: dict[str, int]):
        sizes = np.bincount(np.concatenate(found), minlength=len(numbers))
        order = np.argsort(-sizes, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        words = list(numbers)
        return [rank[f] for f in found], [words[i] for i in order]


ID_ROWS = "back long, numbers binary, sizes binary, ids binary"


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    block_chars: int = BLOCK_CHARS,
    back: bool = False,
) -> DataFrame:
    """(doc_id, ids) of every row of ``docs``.

    With ``back`` also ``packed``, the ids as unsigned 32-bit integers, least byte first, and ``bytes``,
    decoded from the ids where they are put together.
    """
    docs = docs.select("doc_id", "text")
    context = docs.sparkSession.sparkContext
    table, tokens = context.broadcast(ranks), context.broadcast(token_table(ranks) if back else [])
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, total // BUCKET_CHARS)
    # sequences go to their block, words to their bucket, which is a number below 0
    part_rows = T.StructType().add("to", T.LongType()).add("block", T.LongType())
    part_rows = part_rows.add("numbers", T.BinaryType()).add("words", T.BinaryType())
    part_rows = part_rows.add(docs.schema["doc_id"]).add("body", T.BinaryType())
    id_rows = T.StructType([docs.schema["doc_id"]]).add("ids", IDS)
    if back:
        id_rows = id_rows.add("packed", T.BinaryType()).add("bytes", T.BinaryType())
    blocks = Blocks(pattern, block_chars)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=3)
        for block, ids, found, words in blocks(batches):
            coded = [w.encode() for w in words]
            bucket = np.array([xxhash.xxh64_intdigest(w) % buckets for w in coded], np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            rows = np.split(order, cuts[1:]) if len(order) else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([-1 - int(bucket[r[0]]) for r in rows], pa.int64()),
                    pa.array([block] * len(rows), pa.int64()),
                    pa.array([packed(np.diff(r, prepend=0), zip_) for r in rows], pa.binary()),
                    pa.array([packed_words([coded[i] for i in r], zip_) for r in rows], pa.binary()),
                    pa.nulls(len(rows), ids.type),
                    pa.nulls(len(rows), pa.binary()),
                ],
                part_rows.names,
            )
            none = pa.nulls(len(ids), pa.binary())
            same = pa.array(np.full(len(ids), block))
            bodies = pa.array([packed(f, zip_) for f in found], pa.binary())
            yield pa.RecordBatch.from_arrays([same, same, none, none, ids, bodies], part_rows.names)

    def encode_bucket(key: tuple, rows: pa.Table) -> pa.Table:
        if key[0].as_py() >= 0:
            rows = rows.slice(0, 0)
        zip_, unzip = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        known, ids_of = table.value, {}
        sizes, ids = [], []
        for body in rows.column("words"):
            lists = []
            for word in unpacked_words(body.as_py(), unzip):
                found = ids_of.get(word)
                if found is None:
                    found = ids_of[word] = encode_word(word, known)
                lists.append(found)
            sizes.append(packed(np.array([len(x) for x in lists]), zip_))
            ids.append(packed(np.array([i for x in lists for i in x]), zip_))
        return pa.table(
            {
                "back": rows.column("block"),
                "numbers": rows.column("numbers"),
                "sizes": pa.array(sizes, pa.binary()),
                "ids": pa.array(ids, pa.binary()),
            }
        )

    def assemble(key: tuple, bodies: pa.Table, words: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            bodies = bodies.slice(0, 0)
        unzip = zstandard.ZstdDecompressor()
        columns = [
            [unpacked(body, unzip).astype(np.int64) for body in words.column(c).to_pylist()]
            for c in ("numbers", "sizes", "ids")
        ]
        none = [np.zeros(0, np.int64)]
        numbers = np.concatenate([np.cumsum(x) for x in columns[0]] + none)
        sizes, values = (np.concatenate(x + none) for x in columns[1:])
        length, begin = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        length[numbers], begin[numbers] = sizes, np.cumsum(sizes) - sizes
        out = []
        for body in bodies.column("body").to_pylist():
            at = unpacked(body, unzip)
            count = length[at]
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            out.append(values[np.repeat(begin[at], count) + inner].astype(np.int32))
        offsets = np.cumsum([0] + [len(x) for x in out]).astype(np.int32)
        values = pa.array(np.concatenate(out + [np.zeros(0, np.int32)]))
        columns = [bodies.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), values)]
        if back:
            token = tokens.value.__getitem__
            columns.append(pa.array([x.astype("<u4").tobytes() for x in out], pa.binary()))
            columns.append(pa.array([b"".join(map(token, x.tolist())) for x in out], pa.binary()))
        return pa.table(columns, names=id_rows.names)

    parts = docs.mapInArrow(cut, part_rows).groupBy("to")
    replies = parts.applyInArrow(encode_bucket, ID_ROWS)
    return parts.cogroup(replies.groupBy("back")).applyInArrow(assemble, id_rows)


def token_table(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each id."""
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, n in ranks.items():
        table[n] = token
    return table


def decoded(ids: Column, ranks: dict[bytes, int], spark: SparkSession) -> Column:
    """The bytes of each list of ids."""
    shared = spark.sparkContext.broadcast(token_table(ranks))

    @F.arrow_udf(T.BinaryType())
    def bytes_of(lists: pa.Array) -> pa.Array:
        token = shared.value.__getitem__
        return pa.array([b"".join(map(token, x.as_py() or ())) for x in lists], pa.binary())

    return bytes_of(ids)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids, and its bytes decoded from them, as counts and digests."""
    import public_tokenizers

    ranks = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = encode(documents(spark, folder), ranks, public_tokenizers.PATTERN, back=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
