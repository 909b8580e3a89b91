"""Joins on pairs, repeated passages and near vectors against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples_llm import HERE, LONG, documents, given, prose

from rateflow.llm import embeddings, jaccard, passages
from rateflow.llm.arrays import ngrams, sliding
from rateflow.llm.graph import components


def smallest(links, ids):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text):
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
    return frozenset([tuple(words)] if 0 < len(words) < 5 else [tuple(words[j : j + 5]) for j in range(len(words) - 4)])


def expected_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for x, a in enumerate(ids)
        for b in ids[x + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    component = smallest(links, ids)
    return {i: (len(sets[i]), component[i]) for i in ids}


def groups_of(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def edited(text, *places):
    words = text.split()
    for p in places:
        words[p] = f"edit{p}"
    return " ".join(words)


def test_components(spark):
    links = [(5, 3), (3, 9), (9, 1), (20, 21), (7, 7), (30, 31), (31, 32), (32, 30)]
    found = components(spark.createDataFrame(links, "a long, b long").repartition(4))
    want = {5: 1, 3: 1, 9: 1, 1: 1, 20: 20, 21: 20, 30: 30, 31: 30, 32: 30}
    assert {r["id"]: r["component"] for r in found.collect()} == want
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).repartition(7)
    assert {r["component"] for r in components(chain).collect()} == {0}
    assert components(chain.limit(0)).count() == 0


def test_jaccard_awkward_rows(spark):
    base = prose(1, 120)
    texts = [base, base, edited(base, 50), edited(base, 10, 30, 50, 70, 90), None, "", " \n\t", "a b", "A  b", "a b c", LONG, LONG + " x"]
    texts += [edited(base, 50).upper(), prose(2, 120), "w " * 300, "w " * 200]
    df = documents(spark, texts)
    assert groups_of(jaccard.jaccard_components(df)) == expected_groups(enumerate(texts))
    assert jaccard.jaccard_components(df.limit(0)).count() == 0
    twice = jaccard.jaccard_components(df.union(df)).collect()
    assert len(twice) == 2 * len(texts) and {r["component_id"] for r in twice if r["doc_id"] == 2} == {0}
    nameless = documents(spark, [base, base, None], [None, 4, None])
    assert {(r["doc_id"], r["component_id"]) for r in jaccard.jaccard_components(nameless).collect()} == {(None, 4), (4, 4), (None, None)}


@pytest.mark.parametrize("sizes", [(2, 2, 500), (3, 5, 20_000), (10, 3, 400)])
def test_jaccard_large_buckets_and_tiles(spark, monkeypatch, sizes):
    """Small limits take the ways of large groups: trees, stars, tiles and queries to all tiles."""
    bucket, largest, tile = sizes
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", bucket)
    monkeypatch.setattr(jaccard, "LARGEST_BUCKET", largest)
    monkeypatch.setattr(jaccard, "TILE_SHINGLES", tile)
    base = prose(3, 90)
    texts = [edited(base, i % 80, (7 * i) % 80) for i in range(30)]
    chain = [edited(base, *range(0, 3 * i, 3)) for i in range(8)]
    shared = [prose(10 + i, 40) + " " + prose(4, 50) for i in range(12)]
    texts += chain + shared + [prose(60 + i, 90) for i in range(5)]
    assert groups_of(jaccard.jaccard_components(documents(spark, texts))) == expected_groups(enumerate(texts))


@pytest.mark.parametrize("template", [True, False])
def test_jaccard_tiles_stay_bounded(spark, monkeypatch, template):
    """Variants that only their template links, and that nothing links: every tile of every pass is bounded."""
    monkeypatch.setattr(jaccard, "TILE_SHINGLES", 800)
    base = prose(3, 120)
    texts = [edited(base, *(3 + 5 * i + 37 * j for j in range(3) if 3 + 5 * i + 37 * j < 116)) for i in range(23)]
    texts += [edited(base, 7 + i, 40 + 2 * i, 90 + i) for i in range(20)] + [base] * template
    tiled, largest = jaccard._tiled, []

    def seen(docs, members):
        sizes = members.join(documents(spark, texts).select("doc_id", F.lit(1).alias("n")), "doc_id")
        largest.append(sizes.groupBy("family", "tile").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0])
        return tiled(docs, members)

    monkeypatch.setattr(jaccard, "_tiled", seen)
    assert groups_of(jaccard.jaccard_components(documents(spark, texts))) == expected_groups(enumerate(texts))
    # Two parts of about 7 sets each, and the hubs; sets fall into parts by their hash.
    assert len(largest) > 1 and max(largest) <= 27


@pytest.mark.skipif(not HERE, reason="the given tables are not here")
def test_jaccard_given_table(spark):
    df = given(spark, "documents")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert groups_of(jaccard.jaccard_components(df)) == expected_groups(rows)


def test_count_vectors_never_hide_a_link():
    pick = np.random.default_rng(5)
    for size in (8, 60, 700):
        a = np.unique(pick.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate((a[: int(size * 0.9)], pick.integers(0, 2**63, size // 20).astype(np.uint64))))
        packed = [
            np.minimum(jaccard.count_vector(s, jaccard.groups_for(len(s))), 255).astype(np.uint8).tobytes() for s in (a, b)
        ]
        assert jaccard.linked(a, b) and jaccard.bound(*packed, len(a), len(b))
        assert jaccard.join_tile([a, b]) and not jaccard.join_tile([a, np.unique(pick.integers(0, 2**63, size).astype(np.uint64))])


def expected_passages(rows, window=35):
    words = [(t or "").encode().split() for _, t in rows]
    met = Counter(tuple(w[j : j + window]) for w in words for j in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for j in range(len(w) - window + 1):
            if met[tuple(w[j : j + window])] > 1:
                gone.update(range(j, j + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages_of(df):
    found = passages.remove_repeats(df).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    return sorted((tuple(r) for r in found), key=repr)


def test_passages_awkward_rows(spark):
    part = prose(5, 60)
    texts = [part + " " + prose(6, 20), prose(7, 33) + "\n" + part, part.upper(), None, "", " \x0b ", prose(8, 34), prose(8, 34)]
    texts += [prose(9, 80), prose(9, 80), "w " * 100, "w " * 35, "x y " * 40, LONG, "a b " * 36, prose(5, 47), prose(11, 34) + " end"]
    texts += [" ".join(prose(5, 60).split()[20:56]) + " tail", prose(20 + 1, 500)]
    rows = list(enumerate(texts))
    df = documents(spark, texts)
    assert passages_of(df) == expected_passages(rows)
    assert passages_of(df.limit(0)) == []
    assert passages_of(df.union(df)) == expected_passages(rows + rows)
    mixed = documents(spark, [part, part + " more", None], [None, 1, 1])
    assert passages_of(mixed) == expected_passages([(None, part), (1, part + " more"), (1, None)])


def test_passages_hot_context_is_split(spark, monkeypatch):
    """No shard gets more words of one context than it may hold; what repeats is found all the same."""
    monkeypatch.setattr(passages, "SHARD_WORDS", 800)
    part, longer = prose(5, 25), prose(6, 37)
    texts = [prose(100 + i, 20) + " " + part + " " + prose(200 + i % 25, 20) for i in range(30)]
    texts += [prose(300 + i, 9) + " " + longer + " " + prose(400 + i, 9) for i in range(30)]
    texts += [prose(500, 50), prose(500, 45) + " end", texts[0], "w " * 90, None]
    df = documents(spark, texts)
    search, most = type(df).mapInArrow, []

    def seen(self, function, schema):
        if function is passages._search_shards:
            words = self.groupBy("context").agg(F.sum(F.octet_length("words") / 6).alias("n"))
            most.append(words.agg(F.max("n")).first()[0])
        return search(self, function, schema)

    monkeypatch.setattr(type(df), "mapInArrow", seen)
    assert passages_of(df) == expected_passages(list(enumerate(texts)))
    assert most and most[0] <= 800


@pytest.mark.skipif(not HERE, reason="the given tables are not here")
def test_passages_given_table(spark):
    df = given(spark, "documents")
    assert passages_of(df) == expected_passages([(r["doc_id"], r["text"]) for r in df.collect()])


def test_index_counts_against_brute_force():
    pick = np.random.default_rng(3)
    texts = [pick.integers(1, 5, n) for n in (50, 40, 60, 36)]
    weights = [1, 2, 1, 1]
    index = passages.FMIndex(texts, weights)
    for length in (1, 3, 6):
        patterns = np.stack([t[j : j + length] for t in texts for j in range(5)])
        want = [
            sum(w * sum((t[k : k + length] == p).all() for k in range(len(t) - length + 1)) for t, w in zip(texts, weights))
            for p in patterns
        ]
        assert index.counts(patterns, enough=0).tolist() == want
    assert sliding(np.array([5, 1, 4, 2, 3]), 3, np.minimum).tolist() == [1, 1, 2]
    assert len(ngrams(np.zeros(3, np.uint64), 5)) == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, id int, h1 string").repartition(3)


def expected_vectors(rows):
    unit = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = np.array(v, np.float32).astype(float)
            unit[i] = v / np.sqrt(v @ v)
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    counts = Counter(x for pair in links for x in pair)
    component = smallest(links, [i for i, _ in rows])
    return {i: (counts[i], component[i], component[i] == i) for i, _ in rows}


def test_embeddings_against_brute_force(spark, monkeypatch):
    pick = np.random.default_rng(7)
    rows = [(i, pick.standard_normal(16).astype(np.float32).tolist()) for i in range(40)]
    rows += [(100 + i, (np.array(rows[i % 5][1]) + 0.02 * pick.standard_normal(16)).tolist()) for i in range(60)]
    rows += [(200 + i, rows[0][1]) for i in range(7)] + [(300, [2 * x for x in rows[0][1]])]
    rows += [(400, None), (401, [0.0] * 16), (402, [1.0, None] + [0.0] * 14), (403, [float("nan")] * 16), (404, [float("inf")] * 16)]
    rows += [(405, []), (406, [1.0, 2.0]), (407, [1.0, 2.001]), (408, [-x for x in rows[0][1]]), (409, [1e-30] * 16), (410, [1e30] * 16)]
    for block in (1000, 9):
        monkeypatch.setattr(embeddings, "BLOCK", block)
        found = embeddings.near_duplicates(vectors(spark, rows)).collect()
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found}
        assert len(found) == len(rows) and got == expected_vectors(rows)
    assert embeddings.near_duplicates(vectors(spark, rows).limit(0)).count() == 0


def test_embeddings_repeated_and_null_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, None), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (3, [0.0, 0.0]), (None, [1.0, 1.0]), (None, None)]
    found = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    got = sorted(((r["vec_id"], r["n_links"]) for r in found), key=repr)
    assert got == sorted([(1, 1), (1, 0), (2, 1), (3, 0), (3, 0), (None, 0), (None, 0)], key=repr)


def test_embedding_plan_grows_slowly():
    small, large = embeddings.plan(10_000), embeddings.plan(100_000_000)
    assert small[0] < large[0] < 2.5 * small[0] and large[1] < 8 * small[1]
    near = embeddings.collision(np.sqrt(0.1))
    assert all(1 - (1 - near**k) ** t >= 0.98 for k, t in (small, large))
