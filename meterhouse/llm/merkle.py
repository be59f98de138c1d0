"""Merkle manifest of a dataset: a content-addressed graph of digests, and proofs by descending it.

Every row is a leaf. Per part (here the language, null first, then by UTF-8 bytes) the leaves ascend by
their order columns, null first; while several nodes remain, every two consecutive ones become their
hash, a last one alone too. What remains is the part's subroot, and the subroots become the root alike.
A hash is the lowercase hex sha256 of its inputs, concatenated; digests enter as hex text and are kept
as 32 bytes.

* **Building.** Leaves are numbered through ranges of their order, so no part is sorted in one place.
  Runs of 2**LEVELS nodes are folded in one task and become one node each, round by round. Each run
  leaves a record per inner node, digest to children, in a store addressed by the run's top digest.
* **Proofs.** Requests start at the root. In each round, the digits of a rank lead from an address
  down through the records of its run, collecting the children that are not selected. Requests that
  share an address and digits are answered once, whatever their number, so neither the root nor a part
  with most of the rows is a hot key. The collected segments, reversed, are the proof.

Repeated rows are leaves of their own; rows with a null id come first in their part. Every tree, one of
a single leaf included, is defined; an empty table has no root and gives no rows.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterhouse.session import write_and_read

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 9  # levels that one task folds or descends: runs of 512 nodes
TOP = "top"  # the tree of the subroots

RECORD = "struct<digest: binary, children: array<binary>>"
STEP = "struct<sibling: binary, left: boolean>"
RUN_SCHEMA = f"tree string, rank long, address binary, height int, levels int, records array<{RECORD}>"
STEP_SCHEMA = f"address binary, digits long, child binary, segment array<{STEP}>"
ARROW_RECORDS = pa.list_(pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))]))
ARROW_STEPS = pa.list_(pa.struct([("sibling", pa.binary()), ("left", pa.bool_())]))


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_of(*values: Column) -> Column:
    """Digest of the values of a row: each ``-`` if null, else its bytes' number, ``:`` and itself."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def node_of(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def part_key(part: Column) -> Column:
    """A part's name as text that orders null first, then by bytes; never null itself."""
    return F.coalesce(F.concat(F.lit("="), part.cast("string")), F.lit(""))


def number(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``rank`` within ``tree`` by ``order``, and ``n``, the rows of the tree; a written table.

    Rows are dealt into ranges of (tree, order) and numbered there; each range then adds the rows that
    earlier ranges hold of the tree. Equal rows are told apart by where they were read, so that any
    number of them spreads over ranges.
    """
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    by = ["tree", *order, "place"]
    ranged = rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in by])
    ranged = write_and_read(ranged.withColumn("range", F.spark_partition_id()), "ranges")
    counts = write_and_read(
        ranged.groupBy("tree", "range").agg(F.count("*").alias("rows")), "range-counts"
    )
    tree = Window.partitionBy("tree")
    before = tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "tree",
        "range",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
        F.sum("rows").over(tree).alias("n"),
    )
    inside = Window.partitionBy("tree", "range").orderBy(
        *[F.col(c).asc_nulls_first() for c in [*order, "place"]]
    )
    placed = ranged.withColumn("inside", F.row_number().over(inside)).join(offsets, ["tree", "range"])
    placed = placed.withColumn("rank", F.col("before") + F.col("inside") - 1)
    return write_and_read(placed.drop("range", "place", "before", "inside"), "ranked")


def height_of(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1)))


def run_folder(most: int):
    """Folds one run of nodes to its top node, with a record of every node formed on the way."""

    def fold(keys: tuple, table: pa.Table) -> pa.Table:
        rows = table.select(["rank", "digest"]).to_pylist()
        nodes = [row["digest"] for row in sorted(rows, key=lambda r: r["rank"])]
        height = table["height"][0].as_py()
        levels, records = min(most, height), {}
        for _ in range(levels):
            runs = [nodes[i : i + 2] for i in range(0, len(nodes), 2)]
            nodes = [node_of(run) for run in runs]
            records |= zip(nodes, runs, strict=True)
        listed = [{"digest": d, "children": c} for d, c in records.items()]
        return pa.table({
            "tree": pa.array([keys[0].as_py()], pa.string()),
            "rank": pa.array([keys[1].as_py()], pa.int64()),
            "address": pa.array(nodes, pa.binary()),
            "height": pa.array([height - levels], pa.int32()),
            "levels": pa.array([levels], pa.int32()),
            "records": pa.array([listed], ARROW_RECORDS),
        })

    return fold


def grow(nodes: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, list[DataFrame]]:
    """Roots (tree, address, rounds) of the trees in ``nodes`` (tree, rank, digest, n), and their stores.

    The store of a round holds (address, levels, records) of its runs, once for each address.
    """
    nodes = nodes.select("tree", "rank", "digest", height_of(F.col("n")).alias("height"))
    highest = nodes.agg(F.max("height").alias("height")).first().height or 0
    alone = nodes.where("height = 0")
    roots = alone.select("tree", F.col("digest").alias("address"), F.lit(0).alias("rounds"))
    stores = []
    for done in range(-(-highest // levels)):
        runs = write_and_read(
            nodes.where("height > 0")
            .withColumn("run", F.shiftright("rank", levels))
            .groupBy("tree", "run")
            .applyInArrow(run_folder(levels), RUN_SCHEMA),
            "runs",
        )
        once = runs.groupBy("address").agg(
            F.first("levels").alias("levels"), F.first("records").alias("records")
        )
        stores.append(write_and_read(once, "store"))
        nodes = runs.select("tree", "rank", F.col("address").alias("digest"), "height")
        top = nodes.where("height = 0")
        roots = roots.unionByName(
            top.select("tree", F.col("digest").alias("address"), F.lit(done + 1).alias("rounds"))
        )
    return write_and_read(roots, "roots"), stores


def descend_run(keys: tuple, asked: pa.Table, store: pa.Table) -> pa.Table:
    """For each string of digits, the node it leads to and the children passed by, from the top down."""
    address = keys[0].as_py()
    records = {r["digest"]: r["children"] for r in store["records"][0].as_py()}
    levels = store["levels"][0].as_py()
    nodes, segments = [], []
    for digits in asked["digits"].to_pylist():
        node, segment = address, []
        for level in reversed(range(levels)):
            children, digit = records[node], digits >> level & 1
            other = children[1 - digit] if len(children) == 2 else None
            node = children[digit]
            segment.append({"sibling": other, "left": digit == 1})
        nodes.append(node)
        segments.append(segment)
    return pa.table({
        "address": pa.array([address] * len(nodes), pa.binary()),
        "digits": asked["digits"],
        "child": pa.array(nodes, pa.binary()),
        "segment": pa.array(segments, ARROW_STEPS),
    })


def descend(
    requests: DataFrame, starts: DataFrame, stores: list[DataFrame], levels: int = LEVELS
) -> DataFrame:
    """``requests`` (tree, rank, ...) with ``reached``, the leaf's digest, and ``path`` from the top.

    ``starts`` has (tree, address, rounds, subroot, path): where requests of a tree begin, and the path
    that led there. Both are written tables. Requests of no tree or beyond its leaves are not asked.
    """
    alone = starts.where("rounds = 0").select("tree", "address", "subroot", "path")
    done = requests.join(alone, "tree")
    reach = None
    for round_ in reversed(range(len(stores))):
        begin = starts.where(F.col("rounds") == round_ + 1).select(
            "tree", F.lit(0).cast("long").alias("up"), "address", "subroot", "path"
        )
        reach = begin if reach is None else reach.unionByName(begin)
        prefix = F.shiftright("rank", levels * round_) if round_ else F.col("rank")
        wanted = requests.withColumn("prefix", prefix)
        if round_:
            wanted = wanted.select("tree", "prefix").distinct()
        own = wanted.columns
        led = write_and_read(
            wanted.withColumn("up", F.shiftright("prefix", levels))
            .withColumn("digits", F.col("prefix").bitwiseAND(F.lit((1 << levels) - 1)))
            .join(reach, ["tree", "up"]),
            "requests",
        )
        asked = led.select("address", "digits").distinct().groupBy("address")
        steps = asked.cogroup(stores[round_].groupBy("address")).applyInArrow(descend_run, STEP_SCHEMA)
        reach = led.join(steps, ["address", "digits"]).select(
            *own,
            F.col("child").alias("address"),
            "subroot",
            F.concat("path", "segment").alias("path"),
        )
        if round_:
            reach = write_and_read(reach.withColumnRenamed("prefix", "up"), "reached")
    if reach is not None:
        done = reach.drop("prefix").unionByName(done)
    return done.withColumnRenamed("address", "reached")


class Manifest(NamedTuple):
    """A built manifest: numbered leaves, where the proofs of each part start, its stores, the root."""

    leaves: DataFrame
    starts: DataFrame
    stores: list[DataFrame]
    root: str | None


def build(leaves: DataFrame, order: list[str], levels: int = LEVELS) -> Manifest:
    """Manifest of ``leaves`` (tree, leaf and further columns), a written table.

    The numbered leaves have rank and n, the leaves of their tree, besides.
    """
    ranked = number(leaves, [*order, "leaf"])
    roots, stores = grow(ranked.withColumnRenamed("leaf", "digest"), levels)
    subroots = roots.select(
        F.lit(TOP).alias("tree"), F.col("tree").alias("part"), F.col("address").alias("digest"),
        F.col("rounds").alias("part_rounds"),
    )
    tops = number(subroots, ["part"])
    top, top_stores = grow(tops, levels)
    root = top.select(hex_of(F.col("address")).alias("root")).first()
    nothing = F.array().cast(f"array<{STEP}>")
    begin = top.select("*", F.col("address").alias("subroot"), nothing.alias("path"))
    found = descend(tops.select("tree", "rank", "part", "part_rounds"), begin, top_stores, levels)
    starts = found.select(
        F.col("part").alias("tree"),
        F.col("reached").alias("address"),
        F.col("part_rounds").alias("rounds"),
        F.col("reached").alias("subroot"),
        "path",
    )
    return Manifest(ranked, write_and_read(starts, "starts"), stores, root and root.root)


def prove(made: Manifest, requests: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``requests``, some or all of the numbered leaves, with subroot, reached and path.

    A path is (sibling, whether it stands left), from the root to the leaf, with a null sibling where a
    node was hashed alone; ``reached`` is the digest in which it ends.
    """
    return descend(requests, made.starts, made.stores, levels)


def siblings_of(path: Column) -> Column:
    """Siblings as hex text, leaf first."""
    known = F.filter(F.reverse(path), lambda s: s["sibling"].isNotNull())
    return F.transform(known, lambda s: hex_of(s["sibling"]))


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` give, as hex text."""

    def up(node: Column, step: Column) -> Column:
        other = hex_of(step["sibling"])
        joined = F.when(step["left"], F.concat(other, node)).otherwise(F.concat(node, other))
        return F.sha2(F.coalesce(joined, node), 256)

    return F.aggregate(F.reverse(path), hex_of(leaf), up)


def tampered_leaf(docs: DataFrame) -> Column:
    """Leaf of a row after tampering: where 7 divides the id's crc32, ``n_chars`` is one more."""
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    values = [docs[c] if c != "n_chars" else more for c in FIELDS]
    return F.when(touched, leaf_of(*values)).otherwise(F.col("leaf"))


def proofs_of(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Leaf, roots and proof of every row of ``docs``, and what its proof gives after tampering."""
    docs = docs.select(*FIELDS)
    docs = docs.withColumn("leaf", leaf_of(*[docs[c] for c in FIELDS]))
    shown = tampered_leaf(docs).alias("shown")
    leaves = write_and_read(docs.select("doc_id", part_key(docs["lang"]).alias("tree"), "leaf", shown), "leaves")
    made = build(leaves, ["doc_id"], levels)
    path = F.col("path")
    return (
        prove(made, made.leaves.drop("n"), levels)
        .select(
            "doc_id",
            hex_of(F.col("leaf")).alias("leaf"),
            hex_of(F.col("subroot")).alias("subroot"),
            F.lit(made.root).cast("string").alias("root"),
            F.sha2(F.array_join(siblings_of(path), ""), 256).alias("proof_sha256"),
            folded(F.col("shown"), path).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents, parts by language."""
    return proofs_of(spark.read.parquet(f"{folder}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, n_chars, c.leaf, c.shown
  FROM documents, LATERAL (SELECT
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END AS a,
    CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END AS b,
    CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS l,
    CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS n,
    CASE WHEN n_chars IS NULL THEN '-' ELSE strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) END AS m,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS t) AS f,
  LATERAL (SELECT sha256(a || b || l || n || t) AS leaf, sha256(a || b || l || m || t) AS shown) AS c),
langs AS (
  SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) AS tree FROM (SELECT DISTINCT lang FROM docs)),
leaves AS (
  SELECT doc_id, leaf, shown, tree,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank
  FROM docs JOIN langs ON docs.lang IS NOT DISTINCT FROM langs.lang),
low AS (
  SELECT 0 AS level, tree, rank, leaf AS node, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  UNION ALL
  SELECT any_value(level) + 1, tree, rank // 2, sha256(string_agg(node, '' ORDER BY rank)), (any_value(n) + 1) // 2
  FROM low WHERE n > 1 GROUP BY tree, rank // 2),
subroots AS (SELECT tree, node AS subroot, level AS height FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, tree - 1 AS rank, subroot AS node, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, rank // 2, sha256(string_agg(node, '' ORDER BY rank)), (any_value(n) + 1) // 2
  FROM high WHERE n > 1 GROUP BY rank // 2),
steps AS (
  SELECT d.tree, d.rank, l.level, l.rank % 2 AS side, s.node AS sibling
  FROM leaves AS d JOIN low AS l ON l.tree = d.tree AND l.rank = d.rank >> l.level AND l.n > 1
  LEFT JOIN low AS s ON s.tree = l.tree AND s.level = l.level AND s.rank = xor(l.rank, 1)
  UNION ALL
  SELECT d.tree, d.rank, height + l.level, l.rank % 2, s.node
  FROM leaves AS d JOIN subroots ON subroots.tree = d.tree
  JOIN high AS l ON l.rank = (d.tree - 1) >> l.level AND l.n > 1
  LEFT JOIN high AS s ON s.level = l.level AND s.rank = xor(l.rank, 1)),
paths AS (
  SELECT tree, rank, sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof_sha256,
    list(CASE WHEN sibling IS NULL THEN '-' WHEN side = 1 THEN 'L' || sibling ELSE 'R' || sibling END
      ORDER BY level) AS path
  FROM steps GROUP BY tree, rank),
folds AS (
  SELECT leaves.*, coalesce(path, []) AS path, coalesce(proof_sha256, sha256('')) AS proof_sha256,
    (SELECT any_value(node) FROM high WHERE n = 1) AS root, xor(list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384)
        ELSE c >> 1 END), 4294967295) % 7 = 0 AS tampered
  FROM leaves LEFT JOIN paths USING (tree, rank))
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM (SELECT *, list_reduce(list_prepend(CASE WHEN tampered THEN shown ELSE leaf END, path),
    lambda node, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || node WHEN 'R' THEN node || s[2:] ELSE node END))
    AS folded_root FROM folds) JOIN subroots USING (tree)
"""
