"""Operators that shuffle, against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from compare import connect, difference, duck_rows, spark_rows
from conftest import SMALL

import corpus_pipeline
from meterhouse.llm import bpe, catalog, fingerprints, simhash, substrings
from meterhouse.llm.components import components

public_tokenizers = pytest.importorskip("public_tokenizers")
LONG = "le mot " * 50_000
SCHEMA = "doc_id long, text string, block long, hash string, label int, copies int"


@pytest.fixture(scope="module")
def awkward(spark):
    rnd = random.Random(4)
    base = " ".join(rnd.choice(["alpha", "beta", "gamma", "delta"]) + str(rnd.randrange(50)) for _ in range(80))
    texts = ["", None, base, base, base.upper() + " end", "short one", "x\n\n y. Z!", LONG, base[:300], "é\U0001f600 ö"]
    rows = [(n, t, n, "h", 1, 2) for n, t in enumerate(texts)]
    rows += [rows[2], (None, base, 0, None, None, 0), (None, None, 0, None, None, 0), (5, "other", 1, "", 1, 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "block")


@pytest.fixture(scope="module")
def written(spark, awkward, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "t")
    awkward.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, name):
    mine = spark_rows(catalog.QUERIES[name](spark, SMALL))
    assert difference(mine, duck_rows(connect(SMALL), catalog.ORACLES[name])) is None


def reference_encoding():
    import tiktoken

    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    whole = tiktoken.Encoding(
        "whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return ranks, whole


def test_words_encode_as_in_the_library():
    ranks, whole = reference_encoding()
    cut = bpe.PreTokens(public_tokenizers.PATTERN)
    rnd = random.Random(7)
    texts = ["ab" * 5_000, " " * 3_000 + "x", "'s 'S it's", "\x1c\x1f a\xa0b　c", "a՘b \U0003d001"]
    for top in (0x80, 0x500, 0x10000, 0x110000):
        for _ in range(200):
            codes = [rnd.choice([rnd.randrange(top), 32, 65, 49, 10]) for _ in range(30)]
            texts.append("".join(chr(c) for c in codes if not 0xD800 <= c < 0xE000))
    for text in texts:
        ids = [i for w in cut(text) for i in bpe.encode_word(w.encode(), ranks)]
        assert ids == whole.encode_ordinary(text)


@pytest.mark.parametrize("block_chars", [1, 500, 10_000_000])
def test_bpe_rows(spark, written, block_chars):
    ranks, whole = reference_encoding()
    coded = bpe.encode(written, ranks, public_tokenizers.PATTERN, block_chars)
    rows = coded.withColumn("bytes", bpe.decoded(coded["ids"], ranks, spark)).collect()
    expected = [
        (r.doc_id, whole.encode_ordinary(r.text or ""), (r.text or "").encode())
        for r in written.collect()
    ]
    assert sorted([(r.doc_id, r.ids, bytes(r.bytes)) for r in rows], key=str) == sorted(expected, key=str)
    there = bpe.encode(written, ranks, public_tokenizers.PATTERN, block_chars, back=True).collect()
    assert sorted([(r.doc_id, r.ids, bytes(r.bytes)) for r in there], key=str) == sorted(expected, key=str)
    assert all(bytes(r.packed) == np.array(r.ids, "<u4").tobytes() for r in there)
    assert bpe.encode(written.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def brute_repeats(rows, window):
    found = {}
    for n, (_, text) in enumerate(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        for i in range(len(words) - window + 1):
            found.setdefault(tuple(words[i : i + window]), []).append((n, i))
    gone = {(n, i + j) for places in found.values() if len(places) > 1 for n, i in places for j in range(window)}
    out = []
    for n, (doc_id, text) in enumerate(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        kept = [w for i, w in enumerate(words) if (n, i) not in gone]
        out.append((doc_id, len(words), len(words) - len(kept), " ".join(kept)))
    return out


@pytest.mark.parametrize("window,block_chars", [(35, 1), (35, 10_000), (4, 600), (5, 10_000_000)])
def test_repeats_equal_brute_force(spark, written, window, block_chars):
    mine = substrings.remove_repeats(written, window, block_chars).collect()
    expected = brute_repeats([(r.doc_id, r.text) for r in written.collect()], window)
    assert sorted([tuple(r) for r in mine], key=str) == sorted(expected, key=str)
    assert substrings.remove_repeats(written.limit(0)).count() == 0


def brute_components(prints, distance):
    """Least index reachable for each of a list of fingerprints."""
    values = np.array(prints, np.int64).view(np.uint64)
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= distance) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("limit", [20, 65_536])
def test_links_of_clusters_equal_brute_force(spark, limit):
    rnd = random.Random(limit)
    values = {rnd.getrandbits(64) for _ in range(60)}
    for _ in range(3):  # groups whose members differ by a few bits, one of them in the same bits always
        centre, bits = rnd.getrandbits(64), rnd.sample(range(64), 24)
        for _ in range(150):
            values.add(centre ^ sum(1 << b for b in rnd.sample(bits, rnd.randrange(7))))
    prints = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    label = {r.node: r.label for r in components(simhash.links(df, 4, limit)).collect()}
    expected = {p: prints[r] for p, r in zip(prints, brute_components(prints, 4))}
    assert {p: label.get(p, p) for p in prints} == expected


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def test_near_duplicates_equal_brute_force(awkward):
    rows = sorted(awkward.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    prints = [plain_fingerprint(r.text) for r in rows]
    roots = brute_components(prints, 4)
    expected = [(r.doc_id, p, rows[root].doc_id) for r, p, root in zip(rows, prints, roots)]
    mine = simhash.near_duplicates(awkward).collect()
    assert sorted([tuple(r) for r in mine], key=str) == sorted(expected, key=str)
    assert simhash.near_duplicates(awkward.limit(0)).count() == 0
    kept = simhash.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(rows[root].doc_id for root in set(roots))
    assert simhash.one_of_each(awkward.limit(0)).count() == 0


def test_near_dedup_stage_keeps_one_of_each_component(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    roots = brute_components([plain_fingerprint(r.text) for r in rows], 4)
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(rows[root].doc_id for root in set(roots))


def test_fingerprints(spark, awkward):
    named, counted = fingerprints.named_rows(awkward)
    rows = fingerprints.versions(named.dropDuplicates(["doc_id", "hash"]), counted).collect()
    texts = {(r.doc_id, r.text or "") for r in awkward.collect()}
    signed = lambda t: xxhash.xxh64_intdigest(t.encode(), 42) - (1 << 64) * (
        xxhash.xxh64_intdigest(t.encode(), 42) >> 63
    )
    ring = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, signed(x[1])))
    expected = []
    for (doc_id, text), (_, after) in zip(ring, ring[1:] + ring[:1]):
        n = len(text) // 4
        expected.append((doc_id, len(text), text[: len(text) - n] + after[:n]))
    assert sorted([(r.doc_id, r.n_chars, r.edited) for r in rows], key=str) == sorted(expected, key=str)
    found = fingerprints.compared(awkward).collect()
    assert len(found) == awkward.count() > len(rows)
    of = {(r.doc_id, hashlib.sha256(e.encode()).hexdigest()): n for r in rows for n, e in [(r.n_chars, r.edited)]}
    assert {(r.doc_id, r.edited_sha256): r.n_chars for r in found} == of
    assert fingerprints.compared(awkward.limit(0)).count() == 0


def test_likeness_is_that_of_the_digest_sets(spark, tmp_path):
    rnd = random.Random(1)
    lines = [f"line {rnd.getrandbits(40)}" for _ in range(600)]
    texts = [None, "", lines[0], "\n".join(lines[:5]), "\n".join(lines[3:60]), "\n".join(lines[:600]),
             "\n".join(lines[300:]), "\n".join(lines[:600]), "a" * 5000, "same. same. same."]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    rows = {r.doc_id: r for r in fingerprints.query(spark, str(tmp_path)).collect()}

    def pieces(text):
        return set(re.findall(fingerprints.PARAGRAPH, text))

    def like(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    for i, text in enumerate(texts):
        text, after = text or "", texts[(i + 1) % len(texts)] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[i].near_edited == pytest.approx(like(pieces(text), pieces(edited)))
        assert rows[i].near_next == pytest.approx(like(pieces(text), pieces(after)))
    assert rows[5].fingerprint == rows[7].fingerprint != rows[6].fingerprint
    assert rows[0].fingerprint == rows[1].fingerprint


def test_pipeline_stages(spark, written, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = kept
        kept = stage(spark, kept, SMALL)
        if name != "tokens":
            assert kept.columns == docs.columns
            assert kept.select("doc_id").subtract(before.select("doc_id")).isEmpty()
        kept.write.parquet(str(tmp_path / str(n)))
        kept = spark.read.parquet(str(tmp_path / str(n)))
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(whole.collect()) == sorted(kept.collect())
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0
    rows = written.withColumnRenamed("block", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, rows, SMALL).count() <= rows.count()
