"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of 64 bits link when at most ``distance`` bits differ. Bits that go together on a
bounded sample of fingerprints form one partition. With m partitions and thresholds t_1..t_m whose
sum is ``distance - m + 1``, any two linked fingerprints differ in at most t_i bits of some
partition i, whichever thresholds are chosen. So every fingerprint picks its own thresholds (-1 skips
a partition) by dynamic programming on the candidates that the sample predicts, probes the values
within t_i of its own, and candidates are verified on all 64 bits. The sample only steers the cost.

Equal fingerprints are one node from the start, so exact copies cost nothing. Values held by too many
fingerprints for one task are cut by further bits until they fit; a task hands on a forest of its
links, in which no node has more than three, rather than all pairs.

A null text is an empty one; a document without words has fingerprint zero. A null id takes part
like any other, its component gets the least id that is not null, or null. Repeated rows come back
as often as they came in. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhouse.llm.components import components
from meterhouse.llm.tables import documents, fresh
from meterhouse.session import write_and_read

SEED = 42
BITS = 64
SAMPLE = 1024  # fingerprints behind bit groups and cost estimates
VERIFY_COST = 0.05  # of a candidate against a probe
BUCKET_LIMIT = 65_536  # fingerprints of one value that a task takes
SHARD_ROWS = 200_000
PAIR_CHUNK = 4_000_000


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of the lower-cased word shingles, repeats included; all words if there are fewer."""
    found = text.encode("utf-8", "replace").lower().split()
    joined = b" ".join(found)
    if len(found) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)] if found else []
    else:
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist())
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans]
    return np.array(hashes, np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as a signed 64-bit number."""
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = np.ascontiguousarray(hashes[at : at + 65_536], "<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 4, *others: str) -> DataFrame:
    """doc_id, the signed 64-bit fingerprint of each row's whole text, and ``others``."""

    @F.arrow_udf(T.LongType())
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array(
            [fingerprint(shingle_hashes(t.as_py() or "", words)) for t in texts], pa.int64()
        )

    return docs.select("doc_id", simhash("text").alias("fp"), *others)


def bit_groups(sample: np.ndarray, parts: int) -> list[np.ndarray]:
    """Bit numbers of each partition: greedily, the bit that goes best with those taken."""
    left = list(range(BITS))
    if len(sample) > 1:
        bits = (sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
        centred = bits.astype(float) - bits.mean(axis=0)
        scale = np.sqrt((centred**2).sum(axis=0))
        tie = np.abs(centred.T @ centred) / np.maximum(np.outer(scale, scale), 1e-9)
    else:
        tie = np.zeros((BITS, BITS))
    groups = []
    for n in range(parts):
        size = len(left) // (parts - n)
        taken = [max(left, key=lambda b: tie[b, left].sum())]
        left.remove(taken[0])
        while len(taken) < size:
            best = max(left, key=lambda b: tie[b, taken].mean())
            taken.append(best)
            left.remove(best)
        groups.append(np.array(sorted(taken), np.uint64))
    return groups


def best_parts(rows: int, distance: int) -> int:
    """The number of partitions with the least expected work for ``rows`` even fingerprints."""

    def cost(parts: int) -> float:
        width, spare = BITS // parts, distance - parts + 1
        low, more = divmod(spare, parts)
        probes = sum(
            sum(math.comb(width, r) for r in range(low + (i < more) + 1)) for i in range(parts)
        )
        return probes * (1 + VERIFY_COST * rows / 2**width)

    return min(range(2, distance + 2), key=cost)


def mask_of(bits: np.ndarray) -> np.uint64:
    return np.bitwise_or.reduce(np.uint64(1) << bits)


def choose_thresholds(
    fps: np.ndarray, sample: np.ndarray, groups: list[np.ndarray], rows: int, distance: int
) -> np.ndarray:
    """Thresholds per fingerprint and partition, of sum distance - m + 1, with the least cost."""
    spare = distance - len(groups) + 1
    highest = spare + len(groups) - 1  # if all other partitions are skipped
    costs = []
    for bits in groups:
        mask = mask_of(bits)
        away = np.bitwise_count((fps[:, None] ^ sample[None, :]) & mask)
        probes, cost = 0, [np.zeros(len(fps))]
        for r in range(highest + 1):
            probes += math.comb(len(bits), r)
            near = (away <= r).sum(axis=1) / max(1, len(sample)) + probes / 2.0 ** len(bits)
            cost.append(probes + VERIFY_COST * rows * near)
        costs.append(np.stack(cost, axis=1))  # column t + 1
    # least[s]: cheapest way to reach the sum s - (partitions so far)
    least = np.full((len(fps), spare + len(groups) + 1), np.inf)
    least[:, 0] = 0
    taken = []
    for cost in costs:
        grown = np.full_like(least, np.inf)
        pick = np.zeros(least.shape, np.int8)
        for up in range(min(cost.shape[1], least.shape[1])):
            trial = least[:, : least.shape[1] - up] + cost[:, up : up + 1]
            better = trial < grown[:, up:]
            grown[:, up:][better] = trial[better]
            pick[:, up:][better] = up
        least = grown
        taken.append(pick)
    at = np.full(len(fps), spare + len(groups))
    chosen = np.zeros((len(fps), len(groups)), np.int8)
    for i in reversed(range(len(groups))):
        up = taken[i][np.arange(len(fps)), at]
        chosen[:, i] = up - 1
        at = at - up
    return chosen


def mixed(values: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of each value."""
    x = values + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bucket_rows(
    fps: np.ndarray, thresholds: np.ndarray, groups: list[np.ndarray]
) -> Iterator[pa.RecordBatch]:
    """One row for each fingerprint and partition to be found by, and one for each probed value."""
    for i, bits in enumerate(groups):
        mask = mask_of(bits)
        values = fps & mask
        used = np.full(len(fps), mask)
        every = np.full(len(fps), True)
        yield bucket_batch(mixed(values, i + 1), used, fps, every, thresholds[:, i] >= 0)
        for radius in range(1, int(thresholds[:, i].max(initial=-1)) + 1):
            wide = thresholds[:, i] >= radius
            yes = every[wide]
            for flips in combinations(np.uint64(1) << bits, radius):
                key = mixed(values[wide] ^ np.bitwise_or.reduce(np.array(flips)), i + 1)
                yield bucket_batch(key, used[wide], fps[wide], ~yes, yes)


BUCKET_SCHEMA = "key long, used long, fp long, data boolean, probes boolean"


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as the pairs (a, b), at most three for each node."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    order = np.lexsort((nodes, label))
    first = np.concatenate(([True], label[order][1:] != label[order][:-1]))
    begin = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    place = np.arange(len(order)) - begin
    parent = begin + (place - 1) // 2
    child = place > 0
    return nodes[order[child]], nodes[order[parent[child]]]


def linked_in_bucket(members: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect a large bucket: each member reached is compared with those not reached."""
    left, a, b = np.unique(members), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            pivot = queue.pop()
            near = np.bitwise_count(left ^ pivot) <= distance
            reached = left[near]
            if len(reached):
                left = left[~near]
                queue.extend(reached)
                a.append(np.full(len(reached), pivot))
                b.append(reached)
    none = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def linked_in_shard(
    key: np.ndarray, fp: np.ndarray, data: np.ndarray, probes: np.ndarray, distance: int
) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links between probing and found fingerprints of equal key."""
    order = np.argsort(key, kind="stable")
    key, fp, data, probes = key[order], fp[order], data[order], probes[order]
    cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else []
    group = np.repeat(np.arange(len(cut)), np.diff(np.append(cut, len(key))))
    n_data = np.bincount(group, data, len(cut)).astype(np.int64)
    n_probes = np.bincount(group, probes, len(cut)).astype(np.int64)
    large = n_data * n_probes > PAIR_CHUNK
    a, b = [], []
    for g in np.flatnonzero(large):
        x, y = linked_in_bucket(fp[group == g], distance)
        a.append(x)
        b.append(y)
    there = fp[data]
    begin = np.concatenate(([0], np.cumsum(n_data)))[:-1]
    asks = np.flatnonzero(probes & ~large[group])
    work = np.cumsum(n_data[group[asks]])
    at = 0
    while at < len(asks):
        done = work[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(work, done + PAIR_CHUNK, "right")))
        part = asks[at:to]
        count = n_data[group[part]]
        left = np.repeat(part, count)
        inner = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        x, y = fp[left], there[np.repeat(begin[group[part]], count) + inner]
        near = (np.bitwise_count(x ^ y) <= distance) & (x != y)
        a.append(x[near])
        b.append(y[near])
        at = to
    if not a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return forest(np.concatenate(a), np.concatenate(b))


def split_buckets(rows: DataFrame, distance: int, limit: int = BUCKET_LIMIT) -> DataFrame:
    """``rows`` with every key of more than ``limit`` members cut by further bits.

    Members of such a key that link agree in one of ``distance + 1`` groups of the bits not used yet,
    so the plain pigeonhole principle keeps all links.
    """
    whole = []
    while True:
        big = write_and_read(
            rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > limit), "hotkeys"
        ).select("key")
        if big.isEmpty():
            whole.append(rows)
            break
        whole.append(rows.join(big, "key", "left_anti"))

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                key, used, fp = (
                    batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64)
                    for i in range(3)
                )
                for mask in np.unique(used):
                    free = np.flatnonzero(
                        ~(mask >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
                    ).astype(np.uint64)
                    mine = used == mask
                    for j, bits in enumerate(np.array_split(free, distance + 1)):
                        more = mask_of(bits) if len(bits) else np.uint64(0)
                        yes = np.full(int(mine.sum()), True)
                        yield bucket_batch(
                            mixed(key[mine] ^ mixed(fp[mine] & more, j + 1), 7 + j),
                            np.full(len(yes), mask | more), fp[mine], yes, yes,
                        )

        hot = rows.join(big, "key", "left_semi").select("key", "used", "fp")
        rows = write_and_read(hot.mapInArrow(cut, BUCKET_SCHEMA).distinct(), "buckets")
    out = whole[0]
    for more in whole[1:]:
        out = out.unionByName(more)
    return out


def bucket_batch(key, used, fp, data, probes) -> pa.RecordBatch:
    arrays = [pa.array(x.view(np.int64)) for x in (key, used, fp)]
    return pa.RecordBatch.from_arrays(
        [*arrays, pa.array(data), pa.array(probes)], ["key", "used", "fp", "data", "probes"]
    )


def links(prints: DataFrame, distance: int = 4, limit: int = BUCKET_LIMIT) -> DataFrame:
    """(a, b): links that connect the same fingerprints of ``prints`` (distinct ``fp``) as all do."""
    total = prints.count()
    rows = prints.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    sample = np.array([r.fp for r in rows], np.int64).view(np.uint64)
    groups = bit_groups(sample, best_parts(total, distance))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), 2048):
                part = fps[at : at + 2048]
                chosen = choose_thresholds(part, sample, groups, total, distance)
                yield from bucket_rows(part, chosen, groups)

    def link(table: pa.Table) -> pa.Table:
        key, fp = (
            table.column(c).to_numpy().view(np.uint64) for c in ("key", "fp")
        )
        data, probes = (table.column(c).to_numpy() for c in ("data", "probes"))
        a, b = linked_in_shard(key, fp, data, probes, distance)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    buckets = split_buckets(
        write_and_read(prints.select("fp").mapInArrow(probe, BUCKET_SCHEMA), "buckets"),
        distance, limit,
    )
    shards = max(64, total * 24 // SHARD_ROWS)
    return (
        buckets.withColumn("shard", F.pmod("key", F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(link, "a long, b long")
    )


def groups_of(prints: DataFrame, distance: int = 4, limit: int = BUCKET_LIMIT) -> DataFrame:
    """(fp, label, component_id) of each fingerprint in ``prints`` (doc_id, fp), a written table.

    ``label`` is the least fingerprint of the component, ``component_id`` its least id.
    """
    nodes = write_and_read(
        prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints"
    )
    found = components(links(nodes, distance, limit))
    labelled = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )
    labelled = write_and_read(labelled, "labelled")
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    joined = labelled.join(write_and_read(least, "least"), "label")
    return write_and_read(joined.select("fp", "label", "component_id"), "components")


def near_duplicates(
    docs: DataFrame, words: int = 4, distance: int = 4, limit: int = BUCKET_LIMIT
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fp, component_id (least id reachable)."""
    prints = write_and_read(fingerprints(docs, words), "prints")
    groups = groups_of(prints, distance, limit).drop("label")
    return prints.join(groups, "fp").select("doc_id", "fp", "component_id")


def one_of_each(
    docs: DataFrame, words: int = 4, distance: int = 4, limit: int = BUCKET_LIMIT
) -> DataFrame:
    """Rows of ``docs`` with the least id of their component, one row of each, with their columns.

    Null ids come last; among rows of equal id the one with the least hash of all columns stays, and of
    wholly equal rows one.
    """
    row_hash = fresh(docs, "row")
    hashed = docs.withColumn(row_hash, F.xxhash64(*[docs[c] for c in docs.columns]))
    keyed = hashed.select("doc_id", "text", F.col(row_hash).alias("hash"))
    prints = write_and_read(fingerprints(keyed, words, "hash"), "prints")
    groups = groups_of(prints, distance, limit).select("fp", "label")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash"))
    counted = write_and_read(
        prints.join(groups, "fp")
        .groupBy("label", "doc_id", "hash")
        .agg(F.count("*").alias("copies")),
        "rows",
    )
    chosen = write_and_read(
        counted.groupBy("label").agg(first.alias("first")).select("label", "first.*"), "chosen"
    )
    same = [hashed["doc_id"].eqNullSafe(chosen["doc_id"]), hashed[row_hash] == chosen["hash"]]
    kept = hashed.join(chosen, same, "left_semi")
    if not counted.where("copies > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", row_hash])
    return kept.drop(row_hash)


def hex_of(fp: str):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document: four words, four bits."""
    found = near_duplicates(documents(spark, folder))
    return found.select("doc_id", hex_of("fp").alias("fingerprint"), "component_id")
