"""The manifest against trees folded by hand, for parts of every size."""

import hashlib
import zlib

import pytest
from compare import connect, difference, duck_rows, spark_rows
from conftest import SMALL

from meterhouse.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, tree string, rank int, path string, leaf int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    values = [row.doc_id, row.source, row.lang, None if row.n_chars is None else row.n_chars + more, row.text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(levels, at):
    found = []
    for level in levels[:-1]:
        found.append((level[at ^ 1], at & 1) if at ^ 1 < len(level) else (None, 0))
        at >>= 1
    return found


def by_hand(rows):
    parts = {}
    for r in rows:
        parts.setdefault(r.lang, []).append(r)
    langs = sorted(parts, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        parts[lang].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        trees[lang] = levels_of([leaf(r) for r in parts[lang]])
    top = levels_of([trees[x][-1][0] for x in langs])
    out = []
    for n, lang in enumerate(langs):
        for at, r in enumerate(parts[lang]):
            path = siblings(trees[lang], at) + siblings(top, n)
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            node = leaf(r, 1 if hit else 0)
            for s, left in path:
                node = h(node) if s is None else h(s, node) if left else h(node, s)
            proof = h(*[s for s, _ in path if s is not None])
            root = top[-1][0]
            out.append((r.doc_id, leaf(r), trees[lang][-1][0], root, proof, node, node == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [[1], [2, 1], [3, 5, 1, 9], [1] * 11, [37, 4]])
def test_trees_of_every_size(spark, sizes):
    rows, n = [], 0
    for part, size in enumerate(sizes):
        for _ in range(size):
            rows.append((n, f"tëxt {n}" if n % 5 else None, "fêz"[: part % 4] + str(part) if part else None, "", n, "t", 1, "p", 0))
            n += 1
    docs = spark.createDataFrame(rows, SCHEMA)
    for levels in (2, merkle.LEVELS):
        found = [tuple(r) for r in merkle.proofs_of(docs, levels).collect()]
        assert sorted(found, key=str) == by_hand(docs.collect())


def test_null_and_repeated_rows(spark):
    row = (7, "same", "en", None, 4, "t", 1, "p", 0)
    rows = [row] * 40 + [(None, None, None, None, None, None, None, None, None)] * 3
    rows += [(7, "other", "en", None, None, "t", 1, "p", 0), (None, "", "en", "s", 0, "t", 1, "p", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = [tuple(r) for r in merkle.proofs_of(docs, 2).collect()]
    assert sorted(found, key=str) == by_hand(docs.collect())
    assert merkle.proofs_of(docs.limit(0)).collect() == []


def test_some_requests_only(spark):
    docs = spark.createDataFrame([(n, str(n), "en", "s", n, "t", 1, "p", 0) for n in range(50)], SCHEMA)
    leaves = docs.select("doc_id", merkle.part_key(docs["lang"]).alias("tree"), merkle.leaf_of(docs["doc_id"]).alias("leaf"))
    made = merkle.build(leaves, ["doc_id"], 2)
    asked = made.leaves.where("doc_id in (3, 49)")
    found = merkle.prove(made, asked, 2).collect()
    assert sorted(r.doc_id for r in found) == [3, 49]
    assert all(r.reached == r.leaf and len(r.path) == 6 for r in found)


def test_query_equals_sql(spark):
    duck = duck_rows(connect(SMALL), merkle.ORACLE)
    rows = spark_rows(merkle.query(spark, SMALL))
    assert difference(rows, duck) is None
    assert 0 < sum(not r[-1] for r in rows[1]) < len(rows[1]) / 4
