"""Repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples_llm import HERE, documents, given, prose

from rateflow.llm import suffixes


def expected(rows, length=200):
    texts = [(text or "").encode() for _, text in rows]
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), text in zip(rows, texts):
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if counts[text[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def found(df):
    made = suffixes.remove_repeats(df).withColumn("kept", F.sha2("kept", 256))
    rows = made.collect()
    assert all(sum(s["stop"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in rows)
    assert all(len(r["spans"]) == r["n_spans"] for r in rows)
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept"]) for r in rows)


def awkward():
    pick = random.Random(5)
    text = lambda letters, n: "".join(pick.choice(letters) for _ in range(n))
    own = lambda n: text("abcdé qrstuvw", n)
    passage = text("abcdefghij klmnop", 260)
    texts = [None, "", " \n", "x" * 199, "y" * 200, "z" * 201, "w" * 500]
    texts += [own(300) + passage + own(300), own(10) + passage[:200], passage[5:205] + own(50), passage[5:204] + own(50)]
    texts += ["same text " * 30] * 3 + ["same text " * 30 + "!", "日本語" * 100, "x日本語" * 80]
    # Many texts whose own words stand beside one passage: one context, many contents.
    texts += [own(20) + passage[30:240] + own(20) for _ in range(30)]
    return texts + [prose(7, 9000), prose(8, 200) + "\n" + prose(7, 9000)[500:3000]]


def test_repeats_awkward_rows(spark):
    texts = awkward()
    df = documents(spark, [*texts, "same text " * 30, "y" * 200, None], [*range(len(texts)), None, 3, None])
    assert found(df) == expected([(r["doc_id"], r["text"]) for r in df.collect()])
    assert suffixes.remove_repeats(df.limit(0)).count() == 0


def test_repeats_cut_contexts(spark, monkeypatch):
    """Contexts larger than a shard are cut into shorter runs, down to whole windows."""
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 1500)
    texts = awkward()
    df = documents(spark, texts)
    assert found(df) == expected(list(enumerate(texts)))


@pytest.mark.skipif(not HERE, reason="the given tables are not here")
def test_repeats_given_table(spark):
    docs = given(spark, "documents")
    assert found(docs) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def common_prefixes(symbols, order):
    twice = np.concatenate((symbols, symbols))
    rotation = lambda i: twice[i : i + len(symbols)]
    out = []
    for a, b in zip(order[:-1], order[1:]):
        differ = np.flatnonzero(rotation(a) != rotation(b))
        out.append(int(differ[0]) if len(differ) else len(symbols))
    return np.array(out)


@pytest.mark.parametrize("seed", range(20))
def test_borders_part_by_common_prefix(seed):
    """The rounds settle exactly the borders whose common prefix is shorter than the bound."""
    pick = np.random.default_rng(seed)
    base = pick.integers(1, 2 + seed % 4, 40)
    symbols = np.concatenate([base, [0], base[5:30], [0], pick.integers(1, 4, 30), [0], base[10:], [0]]).astype(np.uint16)
    for length in (1, 3, 8, 20):
        transform = suffixes.Transform(symbols, length)
        apart = suffixes.parted(transform, length)
        assert (apart[1:-1] == (common_prefixes(symbols, transform.order) < length)).all()
