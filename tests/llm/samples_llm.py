"""Small tables with awkward rows, and the given tables at the smallest size."""

import random
from pathlib import Path

SF = "/root/testdata/sf0.001"
HERE = Path(SF).exists()
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(40_000))
CLASHING = "row long, weight int, score double, set_id long, sample int, n_words long, item_id long, key string, count long"


def documents(spark, texts, ids=None):
    """Rows ``doc_id, text`` and columns with the names that operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, 1, 2, 0.5, 3, 4, 5, 6, "k", 7) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHING}").repartition(3)


def given(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def prose(seed, words):
    pick = random.Random(seed)
    return " ".join(pick.choice("the of and in to was for with that on at by".split()) + str(pick.randrange(400)) for _ in range(words))
