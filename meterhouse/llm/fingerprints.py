"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs at line ends, long ones further at the first sentence end after ``SHORTEST``
characters, or after twice as many. A paragraph's digest is 48 bits of hash and a 16-bit checksum of them. The fingerprint adds
every distinct digest to one cell in each of three rows of cells: a count and an exclusive or. The cells of
two versions are subtracted; a cell left with one digest, known by count, place and checksum, gives that
digest away, which is then taken out of its other cells, and so on until all cells are empty. The digests
found are those in which the versions differ, and with the counts they give the likeness: digests in both
over digests in either.

Where the cells are too few for the difference, the digests are dealt to shards by further bits and every
shard gets cells of its own, four times as many shards at each retry; a difference that resists all retries
is taken from the digests themselves.

All of it is DataFrame expressions in the row. Texts are shuffled once by id, to meet the document before
them; the order of ids is worked out on ids alone, by ranges. A null or empty text has no digests, an empty
fingerprint, and likeness 1 to another such. Rows of equal id and text are one document, worked out once, and
each gets its result; rows of equal id and different text follow each other in the order of their hashes, null
ids come first. A document alone is its own next one. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterhouse.llm.tables import documents
from meterhouse.session import write_and_read

SHORTEST = 100  # characters
PARAGRAPH = rf"[^\n]{{1,{SHORTEST}}}[^\n.!?]{{0,{SHORTEST}}}[.!?]*"
ROW_BITS = 4
ROW = 1 << ROW_BITS  # cells
ROWS = 3
SHARD_KEYS = 24  # digests of both versions that a shard should have at the first retry
LEAST_EMPTY = 4  # cells; in 48 cells, as many as 40 digests leave empty
ROUNDS = 24
LOW = (1 << 48) - 1


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def numbers(n: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n - 1))


def digest(paragraph: Column) -> Column:
    return bound(F.xxhash64(paragraph).bitwiseAND(F.lit(LOW)), with_checksum)


def with_checksum(low: Column) -> Column:
    return low.bitwiseOR(F.shiftleft(F.xxhash64(low), 48))


def digests(text: Column) -> Column:
    """Distinct digests of the paragraphs of ``text``."""
    paragraphs = F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(paragraphs, digest))


def spots(shifts_bits: list[tuple[int, int]]) -> Column:
    """(mask, want) of all values of ``bits`` bits from each ``shift`` on, as a constant."""
    rows = [
        F.struct(
            F.lit((1 << bits) - 1 << shift).cast("long").alias("mask"),
            F.lit(value << shift).cast("long").alias("want"),
        )
        for shift, bits in shifts_bits
        for value in range(1 << bits)
    ]
    return F.array(*rows)


def at_spot(key: Column, spot: Column) -> Column:
    return key.bitwiseAND(spot["mask"]) == spot["want"]


CELLS = [(row * ROW_BITS, ROW_BITS) for row in range(ROWS)]


def cell(count: Column, mixed: Column) -> Column:
    return F.struct(count.alias("n"), mixed.alias("x"))


def sketch(keys: Column) -> Column:
    """The cells of ``keys``, row after row; a row's keys are dealt in two steps."""
    half = ROW_BITS // 2

    def contents(mine: Column) -> Column:
        mixed = F.aggregate(mine, F.lit(0).cast("long"), lambda x, k: x.bitwiseXOR(k))
        return cell(F.size(mine), mixed)

    def cells(shift: int) -> Column:
        return F.flatten(
            F.transform(
                spots([(shift + half, ROW_BITS - half)]),
                lambda high: bound(
                    F.filter(keys, lambda k: at_spot(k, high)),
                    lambda some: F.transform(
                        spots([(shift, half)]),
                        lambda low: bound(F.filter(some, lambda k: at_spot(k, low)), contents),
                    ),
                ),
            )
        )

    return F.concat(*[cells(shift) for shift, _ in CELLS])


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(
        left, right, lambda a, b: cell(a["n"] - b["n"], a["x"].bitwiseXOR(b["x"]))
    )


def peel(cells: Column) -> Column:
    """The number of digests that differ, from subtracted cells; null if some cannot be recovered."""

    every = spots(CELLS)

    def holds_one(c: Column) -> Column:
        low = c["x"].bitwiseAND(F.lit(LOW))
        return (F.abs(c["n"]) == 1) & (with_checksum(low) == c["x"])

    def single(cells: Column) -> Column:
        """Cells that hold one digest, at its place; others are null."""
        return F.zip_with(
            cells, every, lambda c, spot: F.when(holds_one(c) & at_spot(c["x"], spot), c)
        )

    def without(cells: Column, found: Column) -> Column:
        return F.zip_with(
            cells,
            every,
            lambda c, spot: F.aggregate(
                F.filter(found, lambda p: at_spot(p["x"], spot)),
                c,
                lambda left, p: cell(left["n"] - p["n"], left["x"].bitwiseXOR(p["x"])),
            ),
        )

    def step(s: Column) -> Column:
        found = F.array_distinct(F.filter(single(s["cells"]), lambda c: c.isNotNull()))
        return bound(
            found,
            lambda f: F.struct(
                without(s["cells"], f).alias("cells"),
                (s["found"] + F.size(f)).alias("found"),
                (F.size(f) > 0).alias("more"),
            ),
        )

    start = F.struct(cells.alias("cells"), F.lit(0).alias("found"), F.lit(True).alias("more"))
    return F.aggregate(
        numbers(ROUNDS),
        start,
        lambda s, _: F.when(s["more"], step(s)).otherwise(s),
        lambda s: F.when(
            F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["x"] == 0)), s["found"]
        ),
    )


def shards(keys: Column, bits: Column) -> Column:
    """``keys`` dealt to 2^bits shards, in two steps."""

    def power(n: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), n)

    def dealt(some: Column, step: Column, use: Callable[[Column], Column]) -> Column:
        """``use`` of each part of ``some``; step: (size, unit) of the number that deals them."""
        return F.transform(
            F.sequence(F.lit(0).cast("long"), step["size"] - 1),
            lambda at: bound(
                F.struct(
                    ((step["size"] - 1) * step["unit"]).alias("mask"),
                    (at * step["unit"]).alias("want"),
                ),
                lambda spot: bound(F.filter(some, lambda k: at_spot(k, spot)), use),
            ),
        )

    first = F.floor((bits + 1) / 2).cast("int")
    unit = 1 << ROWS * ROW_BITS
    steps = F.struct(
        F.struct(power(first).alias("size"), F.lit(unit).cast("long").alias("unit")).alias("first"),
        F.struct(
            power(bits - first).alias("size"), (power(first) * F.lit(unit)).alias("unit")
        ).alias("second"),
    )
    return bound(
        steps,
        lambda step: F.flatten(
            dealt(keys, step["first"], lambda some: dealt(some, step["second"], lambda part: part))
        ),
    )


def difference(
    left: Column, right: Column, left_cells: Column, right_cells: Column
) -> Column:
    """The number of digests in one of two sets only, from their cells or from larger ones."""
    load = (F.size(left) + F.size(right)) / F.lit(SHARD_KEYS)
    least = F.greatest(F.ceil(F.log2(F.greatest(load, F.lit(1.0)))).cast("int"), F.lit(1))

    def retry(more: int) -> Column:
        bits = least + more
        peeled = F.zip_with(
            shards(left, bits), shards(right, bits), lambda a, b: peel(subtract(sketch(a), sketch(b)))
        )
        return F.aggregate(peeled, F.lit(0), lambda total, n: total + n)

    def unless_full(cells: Column) -> Column:
        """With hardly a cell empty there is no hope, and larger cells are tried at once."""
        empty = F.filter(cells, lambda c: (c["n"] == 0) & (c["x"] == 0))
        return F.when(F.size(empty) >= LEAST_EMPTY, peel(cells))

    return F.coalesce(
        bound(subtract(left_cells, right_cells), unless_full),
        retry(0),
        retry(2),
        retry(4),
        F.size(F.array_except(left, right)) + F.size(F.array_except(right, left)),
    )


def likeness(left: Column, right: Column, left_cells: Column, right_cells: Column) -> Column:
    """Digests in both over digests in either; 1 if neither has any."""

    def of(differing: Column) -> Column:
        total = F.size(left) + F.size(right)
        return F.when(total == 0, F.lit(1.0)).otherwise(
            (total - differing) / (total + differing)
        )

    return bound(difference(left, right, left_cells, right_cells), of)


def cells_text(cells: Column) -> Column:
    """Cells as text: the count's lowest two bytes and the mixed digest, in hex."""

    def digits(value: Column, n: int) -> Column:
        return F.lpad(F.lower(F.hex(value)), n, "0")

    return F.array_join(
        F.transform(
            cells,
            lambda c: F.concat(digits(c["n"].bitwiseAND(F.lit(65535)), 4), digits(c["x"], 16)),
        ),
        "",
    )


def with_next(keys: DataFrame) -> DataFrame:
    """Adds (next_id, next_hash) to distinct (doc_id, hash, need) rows: the row after, in a ring.

    Rows are put into ranges; the neighbour is found within a range, and a range's last row takes the
    first row of the next range. Only one row for each range meets in one place.
    """
    ranged = keys.repartitionByRange("doc_id", "hash").withColumn("part", F.spark_partition_id())
    ranged = write_and_read(ranged, "ranges")
    row = F.struct(F.col("doc_id").alias("next_id"), F.col("hash").alias("next_hash"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash")]
    # (has an id, id, hash) orders like the rows, null ids first
    first = F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", "hash"))
    firsts = ranged.groupBy("part").agg(first.alias("first"))
    ring = Window.orderBy("part")
    every = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select(
        "part",
        F.coalesce(F.lead("first").over(ring), F.first("first").over(every)).alias("first"),
    ).select(
        "part",
        F.struct(
            F.col("first.doc_id").alias("next_id"), F.col("first.hash").alias("next_hash")
        ).alias("after"),
    )
    inner = ranged.withColumn("inner", F.lead(row).over(Window.partitionBy("part").orderBy(*order)))
    return (
        inner.join(F.broadcast(after), "part")  # one row for each range partition
        .withColumn("next", F.coalesce("inner", "after"))
        .select("doc_id", "hash", "need", "next.*")
    )


def named_rows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text, hash) of every row, and a written table that counts equal rows."""
    text = F.coalesce("text", F.lit(""))
    named = docs.select("doc_id", text.alias("text")).withColumn("hash", F.xxhash64("text"))
    need = F.floor(F.length("text") / 4).cast("int")
    keys = named.select("doc_id", "hash", need.alias("need"))
    counted = keys.groupBy("doc_id", "hash", "need").agg(F.count("*").alias("n"))
    return named, write_and_read(counted, "keys")


def versions(named: DataFrame, counted: DataFrame) -> DataFrame:
    """(doc_id, hash, n_chars, edited, keys, edited_keys, next_keys) of every document.

    ``named`` has no equal rows.
    """
    links = write_and_read(with_next(counted.drop("n")), "links")
    # Digests come after the shuffle of the texts and no column is renamed before it, so the two joins
    # share that shuffle.
    links = links.withColumnsRenamed({"doc_id": "own_id", "hash": "own_hash"})
    to_next = [named["doc_id"].eqNullSafe(links["next_id"]), named["hash"] == links["next_hash"]]
    starts = named.join(links, to_next).select(
        "own_id", "own_hash", "need",
        digests(F.col("text")).alias("next_keys"),
        F.substring(F.col("text"), F.lit(1), F.col("need")).alias("start"),
    )
    to_own = [named["doc_id"].eqNullSafe(starts["own_id"]), named["hash"] == starts["own_hash"]]
    kept = F.substring(named["text"], F.lit(1), F.length(named["text"]) - F.col("need"))
    joined = named.join(starts, to_own).select(
        named["doc_id"], named["hash"], named["text"], F.concat(kept, "start").alias("edited"), "next_keys"
    )
    return joined.select(
        "doc_id",
        "hash",
        F.length("text").cast("long").alias("n_chars"),
        "edited",
        digests(F.col("text")).alias("keys"),
        digests(F.col("edited")).alias("edited_keys"),
        "next_keys",
    )


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row and its edited text, and what they say of their likeness."""
    named, counted = named_rows(docs)
    repeated = not counted.where("n > 1").isEmpty()
    rows = versions(named.dropDuplicates(["doc_id", "hash"]) if repeated else named, counted)
    for kind in ("", "edited_", "next_"):
        rows = rows.withColumn(f"{kind}cells", sketch(F.col(f"{kind}keys")))
    near = {
        kind: likeness(*[F.col(c) for c in ("keys", f"{kind}_keys", "cells", f"{kind}_cells")])
        for kind in ("edited", "next")
    }
    found = rows.select(
        "doc_id",
        "hash",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        cells_text(F.col("cells")).alias("fingerprint"),
        cells_text(F.col("edited_cells")).alias("edited_fingerprint"),
        near["edited"].alias("near_edited"),
        near["next"].alias("near_next"),
    )
    if repeated:  # every one of equal rows gets what was worked out once
        each = named.select(F.col("doc_id").alias("own_id"), F.col("hash").alias("own_hash"))
        found = write_and_read(found, "fingerprints")
        same = found["doc_id"].eqNullSafe(each["own_id"]) & (found["hash"] == each["own_hash"])
        found = each.join(found, same).drop("own_id", "own_hash")
    return found.drop("hash")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents, compared with their edited texts and with the next document."""
    return compared(documents(spark, folder))
