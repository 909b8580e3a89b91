"""Alignment of two tokenizers and its counts against a plain count."""

import hashlib
import json
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from samples_llm import HERE, LONG, documents, given

from rateflow.llm import alignment, perfect_hash
from rateflow.llm.queries import BYTE_BPE, PIECES

pytestmark = pytest.mark.skipif(not Path(BYTE_BPE).exists(), reason="the public vocabularies are not here")
TEXTS = [
    None, "", " ", "  ", "a  b", "x\n\ny z", " lead", "trail ", "▁ literal", "a▁b", "<|endoftext|> <s> <0x41>",
    "日本語 テスト 한국어 \U0001f600 é", "\t tab", "a\x00b c", "\x1c x", "w x y", "  z", " " * 50 + "a", "it's I'LL we've",
    "same text", "same text", "Á combining   nbsp", "tail\n", "​ zero", LONG,
]


def expected(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(BYTE_BPE)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    alphabet = alignment._byte_alphabet()
    spelled = {i: alignment.byte_level(t, alphabet) for t, i in first.get_vocab().items()}

    def piece(i):
        name = second.id_to_piece(i)
        return bytes([int(name[3:-1], 16)]) if second.is_byte(i) else name.replace("▁", " ").encode()

    made, counts = [], Counter()
    for doc_id, text in rows:
        a, b = (first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(spelled[i] for i in a) != whole or b"".join(map(piece, b)) != whole:
            a, b = [], []
        ends = np.cumsum([len(spelled[i]) for i in a]).tolist(), np.cumsum([len(piece(i)) for i in b]).tolist()
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            to, other = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            groups.append(",".join(map(str, a[i:to])) + "|" + ",".join(map(str, b[j:other])))
            links.append((a[to - 1], b[other - 1]))
            i, j = to, other
        counts.update(links)
        made.append((doc_id, len(a), len(b), ";".join(groups), links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return Counter(
        (doc_id, a, b, len(links), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), hashlib.sha256(g.encode()).hexdigest())
        for doc_id, a, b, g, links in made
    )


def aligned(df):
    made = alignment.align(df, BYTE_BPE, PIECES).withColumn("groups", F.sha2("groups", 256))
    return Counter(tuple(r) for r in made.select("doc_id", *alignment.MADE, *alignment.COUNTED, "groups").collect())


@pytest.fixture(scope="module")
def wanted():
    return expected([*enumerate(TEXTS), (None, "same text")])


def test_alignment_awkward_rows(spark, wanted):
    df = documents(spark, [*TEXTS, "same text"], [*range(len(TEXTS)), None])
    assert aligned(df) == wanted
    assert alignment.align(df.limit(0), BYTE_BPE, PIECES).count() == 0
    assert {r["groups"] for r in alignment.align(df.where("text is null"), BYTE_BPE, PIECES).collect()} == {""}


def test_alignment_in_parts(spark, monkeypatch, wanted):
    """Small limits: many cells, a deep tree of vectors, parts of the counts, units forgotten."""
    monkeypatch.setattr(perfect_hash, "CELL_KEYS", 100)
    monkeypatch.setattr(perfect_hash, "FAN", 2)
    monkeypatch.setattr(alignment, "PART_BYTES", 6_000)
    monkeypatch.setattr(alignment, "CACHE_UNITS", 5)
    monkeypatch.setattr(alignment, "HELD_PAIRS", 3)
    df = documents(spark, [*TEXTS, "same text"], [*range(len(TEXTS)), None]).repartition(7)
    assert aligned(df) == wanted


def test_alignment_forgets_rare_units(spark, monkeypatch):
    """Small limits and slices of one text: common units stay with their counts, rare ones go."""
    monkeypatch.setattr(alignment, "CACHE_UNITS", 8)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 1)
    monkeypatch.setattr(alignment, "HELD_PAIRS", 3)
    texts = [t for i in range(4) for t in [*TEXTS, f"été the the été of rare{i} ünit{i}", "w x w x"]]
    assert aligned(documents(spark, texts).coalesce(2)) == expected([*enumerate(texts)])


@pytest.fixture(scope="module")
def vocabularies():
    return alignment.Vocabularies(Path(BYTE_BPE).read_text(encoding="utf-8"), Path(PIECES).read_bytes())


def test_common_units_are_aligned_once(monkeypatch, vocabularies):
    monkeypatch.setattr(alignment, "CACHE_UNITS", 100)
    units, met = alignment.Units(vocabularies), Counter()
    align = units._align
    monkeypatch.setattr(units, "_align", lambda new, alone: (met.update(new), align(new, alone)))
    for i in range(20):
        rare = " ".join(f"w{i}x{j}" for j in range(40))
        alignment._laid(pa.record_batch({"text": [f"the été {rare}", "the été", None, ""]}), units)
        if units.full():
            units.forget()
        assert len(units.number) <= 100
    assert (met["the"], met["été"], met["w0x0"]) == (1, 1, 1)


def test_units_beyond_characters_go(monkeypatch, vocabularies):
    monkeypatch.setattr(alignment, "CACHE_CHARS", 100)
    units = alignment.Units(vocabularies)
    alignment._laid(pa.record_batch({"text": [" ".join(["x" * 90, "ab", "ab", "x" * 90, "ab", "y" * 90])]}), units)
    assert units.full()
    units.forget()
    assert list(units.number) == ["ab"] and not units.full()


def test_units_of_texts():
    texts = [t for t in TEXTS if t] + ["a\x1f b", "a\u3000 b", "a \x85b", "x \n", "\u00a0 x y"]
    split = alignment._split(pa.array([None, "", *texts]))
    assert split.to_pylist() == [[], [], *map(alignment.UNIT.split, texts)]


@pytest.mark.parametrize(("last", "one_way"), [(["ab", "c"], True), (["a", "bc"], False)])
def test_ranks_need_one_way_to_merge(last, one_way):
    """Beside an earlier merge of a and b, those of ``a bc`` never meet: abc is two tokens, but one by rank."""
    from tokenizers import Tokenizer

    told = json.loads(Path(BYTE_BPE).read_text(encoding="utf-8"))
    alphabet = [*alignment._byte_alphabet()]
    told["model"]["vocab"] = {t: i for i, t in enumerate([*alphabet, "ab", "bc", "abc"])}
    told["model"]["merges"], told["added_tokens"] = [["a", "b"], ["b", "c"], last], []
    told = json.dumps(told)
    assert (alignment._ranked(told, Tokenizer.from_str(told)) is not None) == one_way


def test_characters_encoded_by_rank(vocabularies):
    """They are split alike beside letters, digits, signs and gaps."""
    first = vocabularies.first
    chars = [c for c in map(chr, range(0x3000)) if vocabularies.by_rank([c])[0]]
    assert {"a", "é", "ß", "ж"} < set(chars)
    texts = [x.format(c) for c in chars for x in ("a{0}b", "{0}{0}", " {0}1", "1{0}a", ". {0}.", "a {0}\n", "{0}'s", "'{0}", "  {0} a")]
    wanted = [e.ids for e in first.encode_batch_fast(texts, add_special_tokens=False)]
    assert [vocabularies.ranked.encode_ordinary(t) for t in texts] == wanted


@pytest.mark.skipif(not HERE, reason="the given tables are not here")
def test_alignment_given_table(spark):
    docs = given(spark, "documents")
    assert aligned(docs) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 20_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).choice(1 << 31, n, replace=False).astype(np.int64)
    sizes, words = perfect_hash.build(keys)
    numbers = perfect_hash.Lookup(1, [0], [sizes], [words]).numbers(keys)
    assert sorted(numbers) == list(range(n))
    assert sum(sizes) <= 6 * n + 64 * 8


def test_counts_verify_their_keys(spark):
    rows = [(part, key, 1 + key % 3) for part in range(9) for key in range(part, 400, 3)]
    parts = spark.createDataFrame(rows, "part long, key long, n long").repartition(4)
    table, cells = perfect_hash.counted(parts)
    counts = perfect_hash.Counts([r.asDict() for r in table.collect()], cells)
    wanted = Counter()
    for _, key, n in rows:
        wanted[key] += n
    asked = np.arange(1000)
    assert counts.of(asked).tolist() == [wanted[k] for k in asked.tolist()]
    best = perfect_hash.best_counts(table, lambda keys: keys % 7, 7)
    assert best.tolist() == [max(n for k, n in wanted.items() if k % 7 == g) for g in range(7)]
