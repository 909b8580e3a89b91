"""Segmentations, token shards, the pipeline and the queries."""

import json
import math
from collections import Counter
from itertools import pairwise
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples_llm import HERE, LONG, SF, documents, prose

import corpus_pipeline
from rateflow.llm import jaccard, pii, segmentation, shards, toxicity
from rateflow.llm.queries import ORACLE, PIECES, QUERIES, RANKS

TEXTS = ["ab cd", "", None, "Hello  wörld\n\nx▁y 漢字😀\t.", " lead ", "a", "\n", " ", "the" + "x" * 300, "\x00\x1c q", "e" * 5000]
needs_files = pytest.mark.skipif(not Path(PIECES).exists(), reason="the public vocabularies are not here")


def flat(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in data])))


def drawn(texts, k, vocabulary, seed=0):
    """Samples of each text as lists of ``ids, log, value, score``, best first."""
    keys = segmentation.mix(np.arange(len(texts), dtype=np.uint64) + np.uint64(seed))
    out = [[] for _ in texts]
    for doc, _, ids, bounds, log, value, score in segmentation.encode_texts(*flat(texts), keys, k, vocabulary):
        for i, d in enumerate(doc):
            out[d].append((tuple(ids[bounds[i] : bounds[i + 1]]), log[i], value[i], score[i]))
    return out


@needs_files
def test_segmentations_round_trip(spark):
    df = documents(spark, [*TEXTS, LONG, prose(1, 200)])
    rows = segmentation.decode(segmentation.encode(df, PIECES, k=3), PIECES).collect()
    texts = dict(enumerate([*TEXTS, LONG, prose(1, 200)]))
    assert {r["doc_id"] for r in rows} == set(texts)
    assert all(r["decoded"] == (texts[r["doc_id"]] or "") for r in rows)
    counts = Counter(r["doc_id"] for r in rows)
    assert counts[1] == counts[2] == 1 and counts[3] == 3 and counts[11] == 3
    assert len({(r["doc_id"], tuple(r["ids"])) for r in rows}) == len(rows)
    assert segmentation.encode(df.limit(0), PIECES).count() == 0
    again = segmentation.encode(df.repartition(5), PIECES, k=3).select("doc_id", "sample", "ids").collect()
    assert {(r["doc_id"], r["sample"]): r["ids"] for r in again} == {(r["doc_id"], r["sample"]): r["ids"] for r in rows}


@needs_files
def test_segmentations_are_drawn_without_replacement():
    """First samples by their probability, pairs as drawn in turn without replacement."""
    vocabulary = segmentation.load_vocabulary(PIECES, alpha=0.3)
    count = 20_000
    samples = drawn(["the cat"] * count, 3, vocabulary)
    logs = {ids: log for s in samples for ids, log, *_ in s}
    first, pairs = Counter(s[0][0] for s in samples), Counter((s[0][0], s[1][0]) for s in samples)
    for ids, n in first.most_common(8):
        p = math.exp(logs[ids])
        assert abs(n / count - p) < 5 * math.sqrt(p / count)
    for (a, b), n in pairs.most_common(12):
        p = math.exp(logs[a]) * math.exp(logs[b]) / (1 - math.exp(logs[a]))
        assert abs(n / count - p) < 5 * math.sqrt(p / count)
    assert all(x[2] >= y[2] for s in samples for x, y in pairwise(s))


@needs_files
def test_segmentations_of_small_lattices_are_all_found():
    vocabulary = segmentation.load_vocabulary(PIECES, alpha=0.1)

    def every(points, ways=((),)):
        pieces = {p: i for p, i in known.items() if points.startswith(p)}
        return {(i, *rest) for p, i in pieces.items() for rest in every(points[len(p) :])} if points else {()}

    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    known = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i))}
    want = every("▁cats")
    found = drawn(["cats"], 200, vocabulary)[0]
    assert {ids for ids, *_ in found} == want and len(found) == len(want)
    assert abs(sum(math.exp(log) for _, log, *_ in found) - 1) < 1e-9
    assert all(score == 1 for *_, score in found)


@needs_files
def test_inclusion_scores_are_unbiased():
    """Weights p / inclusion of the samples sum to 1 on average, as for any estimate of this kind."""
    vocabulary = segmentation.load_vocabulary(PIECES, alpha=0.2)
    samples = drawn(["a cat sat"] * 4000, 4, vocabulary)
    sums = [sum(math.exp(log) / score for _, log, _, score in s) for s in samples]
    assert abs(np.mean(sums) - 1) < 5 * np.std(sums) / math.sqrt(len(sums))


def test_slots_are_a_permutation():
    for total in (1, 2, 5, 64, 1000, 4097):
        slots = shards.permute(np.arange(total), total, 12)
        assert sorted(slots.tolist()) == list(range(total))
    assert shards.permute(np.arange(1000), 1000, 1).tolist() != shards.permute(np.arange(1000), 1000, 2).tolist()


@needs_files
def test_shards_round_trip_and_resume(spark, tmp_path):
    texts = [*TEXTS, prose(1, 900), prose(2, 50), prose(2, 50), LONG]
    df = documents(spark, texts).union(documents(spark, [prose(5, 30)] * 2, [77, None]).union(documents(spark, ["twin " * 40] * 2, [78, 78])))
    path = f"file://{tmp_path}/shards"
    found = shards.write_shards(df, path, RANKS, key=3, length=64, shard_slots=50)
    rows = sorted(found.collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in rows] == list(range(len(rows)))
    read = list(shards.read_slots(path, 0, 10**6, length=64, shard_slots=50))
    ranks = shards.load_ranks(RANKS)
    assert [(d, c, len(t)) for d, c, t in read] == [(r["doc_id"] if r["doc_id"] is not None else -1, r["chunk"], r["n_tokens"]) for r in rows]
    for i, text in enumerate(texts):
        parts = sorted((c, shards.decode(t, ranks)) for d, c, t in read if d == i)
        assert b"".join(p for _, p in parts).decode() == (text or "")
    assert sum(d == 78 for d, *_ in read) == 2 * len({c for d, c, _ in read if d == 78})
    assert [x[:2] for x in shards.read_slots(path, 47, 6, length=64, shard_slots=50)] == [x[:2] for x in read[47:53]]
    files = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "shards").iterdir()}
    lost = min(files)
    (tmp_path / "shards" / lost).write_bytes(b"half")
    again = shards.write_shards(df, path, RANKS, key=3, length=64, shard_slots=50)
    assert again.exceptAll(found).count() == 0
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "shards").iterdir()}
    assert {n for n in files if after[n] != files[n]} == {lost} and set(after) == set(files)
    assert shards.write_shards(df.limit(0), f"{path}-none", RANKS).count() == 0


@needs_files
@pytest.mark.skipif(not HERE, reason="the given tables are not here")
def test_pipeline_stages_by_brute_force(spark):
    """Each stage does what its operator says, on its own input; the last one's ids give the texts back."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    inputs = [docs]
    for _, function in corpus_pipeline.STAGES:
        inputs.append(function(spark, inputs[-1], SF).persist())
    assert all(df.columns == docs.columns for df in inputs[:-1])
    tables = [{r["doc_id"]: r["text"] for r in df.collect()} for df in inputs[:-1]]
    trained = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scored = toxicity.score(docs, trained)
    assert set(tables[1]) == {r["doc_id"] for r in scored.where("predicted = 0").collect()}
    groups = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(inputs[1]).collect()}
    assert set(tables[2]) == {i for i, c in groups.items() if i == c}
    assert set(tables[3]) == set(tables[4]) <= set(tables[2])
    weights = pii.train(inputs[3])
    assert tables[4] == {i: pii.masked_text(t, pii.find(t, weights)[1]) for i, t in tables[3].items()}
    decoded = segmentation.decode(inputs[-1], PIECES).select("doc_id", "decoded").collect()
    assert {(r["doc_id"], r["decoded"]) for r in decoded} == set(tables[4].items())
    assert corpus_pipeline.run(spark, SF).count() == inputs[-1].count()
    for df in inputs[1:]:
        df.unpersist()


def test_pipeline_awkward_rows(spark):
    texts = [None, "", prose(1, 40), prose(1, 40), LONG, "mail a@b.org"]
    df = documents(spark, texts).union(documents(spark, ["x y z", "x y z", None, None], [50, 50, None, None]))
    kept = corpus_pipeline.one_of_each_group(spark, df, None)
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert kept.columns == df.columns and ids[2] == 1 and ids[3] == 0 and ids[50] == 1 and ids[0] == ids[1] == 1
    masked = corpus_pipeline.mask_personal_data(spark, df, None)
    assert masked.count() == df.count() and masked.columns == df.columns
    assert corpus_pipeline.one_of_each_group(spark, df.limit(0), None).count() == 0


CONTRACT = {
    "op1_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op2_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op5_embedding_near_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op8_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op9_ngram_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op10_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
}


@needs_files
@pytest.mark.skipif(not HERE, reason="the given tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_over_its_table(spark, name):
    found = QUERIES[name](spark, SF)
    if name in CONTRACT:
        assert found.columns[: len(CONTRACT[name])] == CONTRACT[name]
        table = "embeddings" if "vec_id" in found.columns else "documents"
        assert found.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name == "op3_sentencepiece":
        assert found.where(~F.col("exact")).count() == 0
    assert found.count() > 0
    json.loads(found.schema.json())


def test_every_number_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(ORACLE) <= set(QUERIES)
