"""Rows that share an id or have none, and outputs of other runs."""

from pathlib import Path

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from samples_llm import documents, prose

from rateflow.llm import decontamination, licenses, shards
from rateflow.llm.queries import RANKS
from rateflow.llm.rows import rows_with_ids, unused

needs_files = pytest.mark.skipif(not Path(RANKS).exists(), reason="the public vocabularies are not here")


def kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_rows_get_ids_of_their_own(spark):
    df = documents(spark, list("abcdef"), [1, 1, 2, None, None, -5])
    rows, own, shared = rows_with_ids(df)
    found = rows.collect()
    assert len({r["doc_id"] for r in found}) == 6 and all(r["doc_id"] is not None for r in found)
    assert {(r["doc_id"], r[own]) for r in found if r["doc_id"] > -6} == {(2, 2), (-5, -5)}
    assert sorted(r["text"] for r in found) == list("abcdef") and shared.count() == 4
    alone, own, shared = rows_with_ids(df.where("doc_id < 0 or doc_id = 2").withColumn("own_id", F.lit(1)))
    assert shared is None and own == "own_id_" and {r[own] for r in alone.collect()} == {2, -5}
    assert rows_with_ids(df.limit(0))[0].count() == 0
    assert unused(["toxicity_score", "a"], "toxicity_") == "toxicity__"


def test_one_of_each_group_judges_rows(spark):
    """A unique text stays though another row of its id is a copy; ids of copies decide as before."""
    copied, unique, other = prose(1, 60), prose(2, 60), prose(3, 60)
    df = documents(spark, [copied, copied, unique, other, other, other, None, None, ""], [1, 5, 5, 7, 7, None, None, 9, 9])
    assert kept(corpus_pipeline.one_of_each_group(spark, df, None)) == sorted(
        [(1, copied), (5, unique), (7, other), (None, None), (9, None), (9, "")], key=str
    )
    plain = documents(spark, [copied, copied, unique], [4, 3, 8])
    got = corpus_pipeline.one_of_each_group(spark, plain, None)
    assert kept(got) == [(3, copied), (8, unique)] and got.columns == plain.columns
    assert corpus_pipeline.one_of_each_group(spark, df.limit(0), None).count() == 0


def test_contaminated_rows_go_one_by_one(spark):
    item = prose(11, 40)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    clean, bad = prose(12, 50), f"{prose(13, 10)} {item} {prose(14, 10)}"
    df = documents(spark, [clean, bad, clean + " x", bad, bad, None, ""], [1, 1, None, None, 3, 4, 4])
    left = decontamination.without_contaminated(df, benchmark)
    assert kept(left) == sorted([(1, clean), (None, clean + " x"), (4, None), (4, "")], key=str) and left.columns == df.columns


@pytest.mark.parametrize("words", [64, 65, 70, 300])
def test_templates_of_any_length(spark, words):
    template = " ".join(f"term{i}" for i in range(words))
    df = documents(spark, [f"{prose(5, 40)} {template} {prose(6, 40)}", prose(7, 90), None, ""], [1, 2, 3, 4])
    found = licenses.find_licenses(df, {"own": template, "short": "some other words of few"}).collect()
    assert [(r["doc_id"], r["license"], r["containment"], r["first_word"]) for r in found] == [(1, "own", 1.0, 40)]


@needs_files
def test_shards_of_other_documents_are_not_kept(spark, tmp_path):
    path = f"file://{tmp_path}/shards"
    read = lambda: {x[0] for x in shards.read_slots(path, 0, 10**6, length=32, shard_slots=20)}
    texts = [prose(i, 40) for i in range(5)]
    for ids, key in ((range(5), 1), (range(100, 105), 1), (range(100, 105), 2)):
        found = shards.write_shards(documents(spark, texts, list(ids)), path, RANKS, key=key, length=32, shard_slots=20)
        assert {r["doc_id"] for r in found.collect()} == read() == set(ids)
        slots = {r["slot"]: (r["doc_id"], r["chunk"]) for r in found.collect()}
        told = [x[:2] for x in shards.read_slots(path, 0, 10**6, length=32, shard_slots=20)]
        assert told == [slots[i] for i in range(len(slots))]
    fewer = shards.write_shards(documents(spark, texts[:1], [9]), path, RANKS, key=2, length=32, shard_slots=20)
    assert read() == {9} and len(list((tmp_path / "shards").glob("shard-*"))) == 1 and fewer.count() > 0
