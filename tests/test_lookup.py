import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from samples import ratings

from rateflow.functions.messages import ANSWER_HEADER, ANSWER_NONE
from rateflow.operators import answer, answers, find_by_date, find_by_name, joins, route
from rateflow.operators.lookup import names_holding
from rateflow.operators.ordering import numbered
from rateflow.schema import REQUESTS


def names(df):
    return sorted(r.name for r in df.collect())


def banks(spark):
    return ratings(
        spark, ("Банк-А",), ("БАНК 100%_x",), ("банк 100 x",), ("Other", "A", "-", dt.date(2024, 1, 16)), (None,)
    )


def test_find_by_name(spark):
    assert names(find_by_name(banks(spark), "бАнК")) == ["БАНК 100%_x", "Банк-А", "банк 100 x"]
    assert names(find_by_name(banks(spark), "100%_x")) == ["БАНК 100%_x"]
    assert names(find_by_name(banks(spark), "100%x", wildcards=True)) == ["БАНК 100%_x", "банк 100 x"]
    assert names(find_by_name(banks(spark), "\\")) == []


@pytest.mark.parametrize("text, found", [("2024-01-16", 1), ("2024-13-45", 0), ("bank-a", 0)])
def test_find_by_date(spark, text, found):
    assert find_by_date(banks(spark), text).count() == found


@pytest.mark.parametrize(
    "text, kind",
    [
        ("2024-01-15", "date"),
        (" 2024-1-5 ", "date"),
        ("2024-13-45", "date"),
        ("2024-01", "date"),
        ("Банк-А", "name"),
        ("2024", "name"),
        ("", None),
        (None, None),
    ],
)
def test_route(spark, text, kind):
    assert spark.createDataFrame([(text,)], "t string").select(route(F.col("t"))).first()[0] == kind


def random_words(seed, number):
    rng = random.Random(seed)
    return sorted({"".join(rng.choices("abBАб %_", k=rng.randint(1, 12))) for _ in range(number)})


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_names_holding_equals_trying_every_pair(spark, monkeypatch, limit):
    monkeypatch.setattr(joins.broadcast_if_small, "__defaults__", (limit,))
    known = random_words(1, 300)
    needles = sorted({w.lower()[: 1 + n % 5] for n, w in enumerate(random_words(2, 150))} | {"zzz", "b"})
    found = names_holding(
        spark.createDataFrame([(n,) for n in known], "name string"),
        spark.createDataFrame([(n,) for n in needles], "needle string"),
    )
    assert sorted(tuple(r) for r in found.collect()) == sorted(
        (needle, name) for needle in needles for name in known if needle in name.lower()
    )


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_numbered_equals_counting_in_order(spark, monkeypatch, limit):
    monkeypatch.setattr(joins.broadcast_if_small, "__defaults__", (limit,))
    rng = random.Random(3)
    rows = [("hot" if n % 3 else f"g{rng.randint(0, 5)}", rng.randint(0, 50), n) for n in range(3000)]
    df = spark.createDataFrame(rows, "g string, v long, tie long")
    got = [tuple(r) for r in numbered(df, ["g"], ["v", "tie"]).collect()]
    place, want = {}, []
    for g, v, tie in sorted(rows):
        place[g] = place.get(g, 0) + 1
        want.append((g, v, tie, place[g]))
    assert sorted(got) == sorted(want)


def item(name, rating="A", day="2024-01-15"):
    return (
        f"\n<b>{name}</b>\n<i>rating</i>:             <b>{rating}</b>\n<i>prediction</i>:     -"
        f"\n<i>rating_date</i>:   {day}\n<i>observation</i>:  -\n<i>agency</i>:           X\n            "
    )


def ask(spark, df, *texts, **options):
    requests = spark.createDataFrame(list(enumerate(texts)), REQUESTS)
    found = answers(df, requests, **options).collect()
    return {(r.req_id, r.part): r.text for r in found}


def test_answers(spark):
    df = ratings(spark, ("A & B",), ("A & B",), ("Банк-А", "B"), ("Other", "A", "-", dt.date(2024, 1, 16)))
    got = ask(spark, df, "2024-01-15", "a & b", "банк-а", "none such", "2024-13-45", "", "A & B")
    double = item("A &amp; B") + item("A &amp; B")
    assert got == {
        (0, 0): ANSWER_HEADER + double + item("Банк-А", "B"),
        (1, 0): ANSWER_HEADER + double,
        (2, 0): ANSWER_HEADER + item("Банк-А", "B"),
        (3, 0): ANSWER_NONE,
        (4, 0): ANSWER_NONE,
        (6, 0): ANSWER_HEADER + double,
    }


def test_a_long_answer_comes_in_parts(spark):
    df = ratings(spark, *[("Hot",)] * 25, *[(f"Hot {n:02}",) for n in range(20)], ("Cold",))
    got = ask(spark, df, "hot", "cold", items_per_part=10)
    parts = [got[(0, part)] for part in range(5)]
    whole = ANSWER_HEADER + item("Hot") * 25 + "".join(item(f"Hot {n:02}") for n in range(20))
    assert "".join(parts) == whole
    assert max(part.count("<i>agency</i>") for part in parts) == 10
    assert got[(1, 0)] == ANSWER_HEADER + item("Cold") and len(got) == 6


def test_answers_without_requests(spark):
    assert ask(spark, ratings(spark, ("A",))) == {}


def test_one_answer(spark):
    found = answer(ratings(spark, ("A",), ("B",)), "a")
    assert [tuple(r) for r in found.collect()] == [(0, ANSWER_HEADER + item("A"))]
