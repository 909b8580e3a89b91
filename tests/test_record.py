"""Runs that go on where the last one died, and what they leave behind."""

import os

import pytest
from pyspark.sql import functions as F
from samples import DAY as DATE
from samples import cards, listing, paired, pages

from rateflow.plans import backfill, run_day
from rateflow.plans.record import Record, fingerprint
from rateflow.schema import DATE_TABLE, DAY, OUTBOX, RATINGS, REJECTS, STATS
from rateflow.session import shared_dir
from rateflow.sources import read_day
from rateflow.sources.store import read_table


def staged(spark):
    folder = f"{shared_dir(spark)}/rateflow"
    return {name for name in os.listdir(folder)} if os.path.isdir(folder) else set()


def arrive(spark, path, *rows):
    pages(spark, *rows).write.mode("append").partitionBy("source").parquet(path)
    return spark.read.schema("source string, page_id long, html string").parquet(path)


def die(*_, **__):
    raise RuntimeError("lost")


def test_a_backfill_resumes_after_the_counts(spark, store, tmp_path, monkeypatch):
    import sys

    module = sys.modules["rateflow.plans.backfill"]
    arrived = arrive(spark, str(tmp_path / "pages"), *listing(), *listing("16.01.2024"))
    before = staged(spark)
    message = module.message_days
    with monkeypatch.context() as patch:
        patch.setattr(module, "message_days", die)
        with pytest.raises(RuntimeError):
            backfill(spark, arrived, store, "2024-01-15", "2024-01-16", resume=True)
    done = os.listdir(f"{store.root}/runs/{os.listdir(f'{store.root}/runs')[0]}")
    assert {name for name in done if not name.startswith(".")} == {"ratings", "counts"}
    with monkeypatch.context() as patch:
        patch.setattr(module, "extract", die)
        patch.setattr(module, "count_days", die)
        backfill(spark, arrived, store, "2024-01-15", "2024-01-16", resume=True)
    assert module.message_days is message
    assert read_table(spark, store.outbox, OUTBOX).where("kind = 'item'").count() == 12
    # What is staged goes with the job, whether it dies or not, and a whole run leaves no record.
    assert staged(spark) == before
    assert [n for n in os.listdir(f"{store.root}/runs") if not n.startswith(".")] == []
    # Other inputs are another run.
    more = arrive(spark, str(tmp_path / "pages"), cards(("Банк Ж", "B", "-", "-", "15.01.2024"), page_id=3))
    with monkeypatch.context() as patch:
        patch.setattr(module, "count_days", die)
        with pytest.raises(RuntimeError):
            backfill(spark, arrived, store, "2024-01-15", "2024-01-16", resume=True)
    backfill(spark, more.unionByName(more.limit(0)), store, "2024-01-15", "2024-01-16", resume=True)
    assert read_table(spark, store.ratings, RATINGS).count() == 13


def test_a_day_resumes_and_cleans_up(spark, store, monkeypatch):
    from rateflow.plans import daily

    before = staged(spark)
    with monkeypatch.context() as patch:
        patch.setattr(daily, "message_day", die)
        with pytest.raises(RuntimeError):
            run_day(spark, pages(spark, *listing()), store, "2024-01-15", resume=True)
    with monkeypatch.context() as patch:
        patch.setattr(daily, "ingest_day", die)
        with pytest.raises(RuntimeError):
            run_day(spark, pages(spark, *listing("16.01.2024")), store, "2024-01-15", resume=True)
        run_day(spark, pages(spark, *listing()), store, "2024-01-15", resume=True)
    assert read_day(spark, store.outbox, "2024-01-15", OUTBOX).count() == 8
    assert staged(spark) == before


def test_steps_are_done_once(spark, store):
    done = []
    for _ in range(2):
        Record(spark, store, "job", [1]).step("a", lambda: done.append("a"))
    Record(spark, store, "job", [2]).step("a", lambda: done.append("b"))
    record = Record(spark, store, "job", [1])
    record.close()
    record.step("a", lambda: done.append("c"))
    assert done == ["a", "b", "c"]
    some = pages(spark, *listing())
    assert fingerprint(some) == fingerprint(some.repartition(3)) != fingerprint(pages(spark, *listing("16.01.2024")))


def test_a_backfill_adds_to_the_rejects_of_a_day(spark, store):
    run_day(spark, pages(spark, paired(("A", "ruC"), page_id=1)), store, "2024-01-15")
    other = pages(spark, paired(("B", "a, b, c, d, e"), page_id=2), *listing())
    for _ in range(2):
        rejects = backfill(spark, other, store, "2024-01-14", "2024-01-15")
        assert sorted(r.reason for r in rejects.collect()) == ["parts: 1", "parts: 5"]
    assert sorted(r.reason for r in read_day(spark, store.rejects, "2024-01-15", REJECTS).collect()) == ["parts: 1", "parts: 5"]


def test_a_page_that_comes_late_is_found_by_its_arrival(spark, store, tmp_path):
    """The run of the 16th reads only what came that day and adds the 15th's late rating to its day."""
    late = cards(("Late", "B", "-", "-", "15.01.2024"), ("Day", "B", "-", "-", "16.01.2024"), page_id=9)
    came = pages(spark, *listing()).withColumn("arrived", F.lit(DATE))
    came = came.unionByName(pages(spark, late, listing()[0]).withColumn("arrived", F.lit("2024-01-16").cast("date")))
    came.write.partitionBy("arrived").parquet(str(tmp_path / "pages"))
    stored = spark.read.parquet(str(tmp_path / "pages"))
    for day in ("2024-01-15", "2024-01-16", "2024-01-16"):
        run_day(spark, stored, store, day, late=True)
    rows = read_table(spark, store.ratings, RATINGS).groupBy(DAY).count().collect()
    assert {str(r[DAY]): r["count"] for r in rows} == {"2024-01-15": 7, "2024-01-16": 1}
    counts = read_table(spark, store.stats(DATE_TABLE), STATS[DATE_TABLE]).collect()
    assert {str(r[DAY]): r.num_ratings for r in counts} == {"2024-01-15": 7, "2024-01-16": 1}
