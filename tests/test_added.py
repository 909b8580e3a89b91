"""What arrives later is added to stored days, seen at once and never twice."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from samples import DAY as DATE
from samples import cards, listing, pages, ratings

from rateflow.plans import run_day
from rateflow.plans.backfill import store_days
from rateflow.schema import AGENCY_RATING_TABLE, AGENCY_TABLE, DATE_TABLE, DAY, RATINGS, STATS
from rateflow.sinks import added
from rateflow.sources import read_day, read_stats
from rateflow.sources.store import live_parts, read_table
from rateflow.streaming import arriving_pages, run_arrived
from rateflow.streaming.incremental import read_news, take_batch


def of_day(spark, *names, day=DATE):
    return ratings(spark, *[(n, "A", "-", day) for n in names]).withColumn(DAY, F.col("rat_date"))


def stored_bytes(root):
    sizes = {}
    for folder, _, names in os.walk(root):
        for name in names:
            if name.endswith(".parquet"):
                sizes[f"{folder}/{name}"] = os.path.getsize(f"{folder}/{name}")
    return sizes


def names(spark, store):
    return sorted(r.name for r in read_table(spark, store.ratings, RATINGS).collect())


def total(spark, store, table=DATE_TABLE):
    return sum(r.num_ratings for r in read_table(spark, store.stats(table), STATS[table]).collect())


def test_what_is_written_does_not_depend_on_the_day(spark, tmp_path):
    from rateflow.plans import Store

    written = []
    for rows in (10, 20_000):
        store = Store(str(tmp_path / f"store{rows}"))
        day = spark.range(rows).select(F.sha2(F.col("id").cast("string"), 256).alias("name"))
        day = day.select("name", *[F.lit(v).alias(c) for c, v in zip(RATINGS.fieldNames()[1:], ("A", "-", DATE, "-", "X"))])
        store_days(spark, day, store, DATE, DATE)
        before = stored_bytes(store.root)
        added.add_batch(of_day(spark, "new"), store, "one")
        after = stored_bytes(store.root)
        assert before.items() <= after.items()
        written.append(sum(after.values()) - sum(before.values()))
        assert read_day(spark, store.ratings, DATE).count() == rows + 1
        assert [tuple(r) for r in read_stats(spark, store.stats(AGENCY_TABLE), AGENCY_TABLE, DATE).collect()] == [("X", rows + 1)]
    assert written[0] == written[1]


def test_a_batch_is_seen_from_its_commit_on(spark, store, monkeypatch):
    first, more = listing(), cards(("Банк Ж", "B", "-", "-", "15.01.2024"), page_id=3)
    take_batch(pages(spark, *first), 0, store)
    commit = added._commit

    def die(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(added, "_commit", die)
    for _ in range(2):
        with pytest.raises(RuntimeError):
            take_batch(pages(spark, more), 1, store)
    assert len(names(spark, store)) == 6 and total(spark, store) == 6
    assert read_news(spark, store.news).where("kind = 'item'").count() == 6
    monkeypatch.setattr(added, "_commit", commit)
    for _ in range(2):
        take_batch(pages(spark, more), 1, store)
    assert len(names(spark, store)) == 7
    assert {t: total(spark, store, t) for t in STATS} == {t: 7 for t in STATS}
    assert read_news(spark, store.news).where("kind = 'item'").count() == 7


def test_stream_daily_run_and_lost_checkpoint_agree(spark, store, tmp_path):
    arrived = str(tmp_path / "arrived")

    def arrive(progress, *rows):
        if rows:
            pages(spark, *rows).write.mode("append").partitionBy("source").parquet(arrived)
        run_arrived(spark, arriving_pages(spark, arrived), store, str(tmp_path / progress))

    arrive("progress", *listing())
    arrive("progress", *listing("16.01.2024"))
    streamed = names(spark, store)
    run_day(spark, pages(spark, *listing(), *listing("16.01.2024")), store, "2024-01-15")
    assert {r[DAY].day for r in live_parts(spark, store.ratings)} == {16}
    assert names(spark, store) == streamed and total(spark, store) == 12
    arrive("another")
    assert names(spark, store) == streamed and total(spark, store) == 12
    assert {total(spark, store, t) for t in (AGENCY_TABLE, AGENCY_RATING_TABLE)} == {12}


def test_small_parts_are_merged(spark, store, monkeypatch):
    monkeypatch.setattr(added, "FAN", 3)
    store_days(spark, ratings(spark, ("old",)), store, DATE, DATE)
    other = dt.date(2024, 1, 16)
    for i in range(7):
        added.add_batch(of_day(spark, f"n{i}").unionByName(of_day(spark, f"m{i}", day=other)), store, f"b{i}")
    before = names(spark, store)
    assert len(live_parts(spark, store.ratings)) == 14
    base = {p for p in stored_bytes(store.ratings)}
    assert added.merge_added(spark, store) > 0
    # Each day's seven parts of one row are one part, and nothing of the day itself is written again.
    assert sorted((p[DAY].day, p["n"]) for p in live_parts(spark, store.ratings)) == [(15, 7), (16, 7)]
    assert {p for p in stored_bytes(store.ratings)} == base
    assert names(spark, store) == before and total(spark, store) == 15
    assert added.merge_added(spark, store) == 0
    kept = len(stored_bytes(f"{store.ratings}_added"))
    added.drop_retired(spark, store)
    assert len(stored_bytes(f"{store.ratings}_added")) < kept
    assert names(spark, store) == before and total(spark, store, AGENCY_TABLE) == 15
    # A day that is written whole keeps nothing of what was added to it.
    store_days(spark, ratings(spark, ("new",)), store, DATE, DATE)
    assert names(spark, store) == sorted(["new", *[f"m{i}" for i in range(7)]])
    assert total(spark, store) == 8


def test_parts_of_other_days_are_not_opened(spark, store):
    store_days(spark, ratings(spark, ("old",)), store, DATE, DATE)
    added.add_batch(of_day(spark, "a").unionByName(of_day(spark, "b", day=dt.date(2024, 1, 20))), store, "b")
    files = read_day(spark, store.ratings, DATE).inputFiles()
    assert len(files) >= 2 and not any("2024-01-20" in f for f in files)
