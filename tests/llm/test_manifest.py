"""Merkle manifests against a tree built level by level."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from samples_llm import HERE, LONG, given

from rateflow.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string, key string, place int, n int"


def joined(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row, more=0):
    n_chars = None if row["n_chars"] is None else row["n_chars"] + more
    texts = ["-" if v is None else str(v) for v in (row["doc_id"], row["source"], row["lang"], n_chars, row["text"])]
    nulls = [v is None for v in (row["doc_id"], row["source"], row["lang"], n_chars, row["text"])]
    return joined(*["-" if null else f"{len(t.encode())}:{t}" for t, null in zip(texts, nulls)])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([joined(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def beside(levels, place):
    out = []
    for level in levels[:-1]:
        other = place ^ 1
        out.append((level[other] if other < len(level) else None, other & 1))
        place >>= 1
    return out


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[name] = tree([leaf(r) for r in groups[name]])
    top = tree([trees[n][-1][0] for n in names])
    root, out = top[-1][0], []
    for k, name in enumerate(names):
        for i, row in enumerate(groups[name]):
            proof = beside(trees[name], i) + beside(top, k)
            tampered = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            node = leaf(row, int(tampered))
            for other, right in proof:
                node = joined(node) if other is None else joined(node, other) if right else joined(other, node)
            subroot = trees[name][-1][0]
            proof = joined(*[other for other, _ in proof if other])
            out.append((row["doc_id"], leaf(row), subroot, root, proof, node, node == root))
    return Counter(out)


def checked(df):
    columns = "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    return Counter(tuple(r) for r in manifest.manifest_check(df).select(*columns).collect())


def awkward(spark):
    rows = [(i, "s", "en", 5, f"text {i}", "x", "k", 1, 2) for i in range(37)]
    rows += [(i, None, None, None, None, "x", "k", 1, 2) for i in range(40, 45)]
    rows += [(50, "s", "de", 1, "", "x", "k", 1, 2), (51, "", "", 0, LONG, "x", "k", 1, 2), (52, "é", "ё", 1, "日本", "x", "k", 1, 2)]
    # Equal ids, equal rows, no id.
    rows += [(3, "t", "en", 5, "other", "x", "k", 1, 2)] + [(60, "s", "fr", 1, "a", "x", "k", 1, 2)] * 3
    rows += [(None, "s", "fr", 1, "b", "x", "k", 1, 2), (None, None, None, 7, "b", "x", "k", 1, 2)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("bits", [10, 2, 1])
def test_manifest_awkward_rows(spark, monkeypatch, bits):
    """Small builders take several rounds; the result is the same."""
    monkeypatch.setattr(manifest, "BITS", bits)
    df = awkward(spark)
    assert checked(df) == expected(df.collect())


def test_manifest_tables_without_tree(spark):
    df = awkward(spark)
    assert manifest.manifest_check(df.limit(0)).count() == 0
    lone = df.where("doc_id = 50")
    assert checked(lone) == expected(lone.collect())
    assert checked(lone).total() == 1


@pytest.mark.skipif(not HERE, reason="the given tables are not here")
def test_manifest_given_table(spark):
    docs = given(spark, "documents")
    assert checked(docs) == expected(docs.collect())


@pytest.mark.parametrize("leaves", [1, 2, 3, 5, 8, 13, 64, 100])
def test_positions_follow_from_sizes(leaves):
    """Every node stands where its address says, up to the height that a builder climbs."""
    nodes = [hashlib.sha256(str(i).encode()).digest() for i in range(leaves)]
    for height in {manifest.height_of(leaves), 7}:
        log = manifest.append_log(nodes, height)
        level, below = 0, nodes
        seen = set()
        while level <= height:
            for place, node in enumerate(below):
                at = manifest.position(level, place, leaves)
                assert log[at] == node
                seen.add(at)
            level, below = level + 1, [manifest.hashed(*below[i : i + 2]) for i in range(0, len(below), 2)]
        assert seen == set(range(len(log)))


def test_proof_of_a_changed_row_fails(spark):
    """The proof ties every field; the siblings alone lead from a leaf to the root."""
    df = awkward(spark)
    rows = df.select("lang", "doc_id", "text", manifest.digest(F.col("doc_id"), F.col("text")).alias("digest"))
    made = manifest.build(rows, "lang", "doc_id", ["text"])
    for row in made.proofs().collect():
        assert manifest.fold(bytes(row["digest"]), bytes(row["siblings"]), row["sides"]) == made.root
        assert manifest.fold(hashlib.sha256(b"").digest(), bytes(row["siblings"]), row["sides"]) != made.root
