"""Standing by issuer and the stored index of names."""

import datetime as dt
import random

from pyspark.sql import functions as F
from samples import DAY as DATE
from samples import listing, pages, ratings

from rateflow.operators import answers, changes
from rateflow.operators.changes import changes_of, next_standing
from rateflow.operators.lookup import names_holding
from rateflow.operators.name_index import extend_index, indexed_names, postings_of
from rateflow.plans import change_day, run_day
from rateflow.schema import CHANGES, RATINGS, REQUESTS, STANDING
from rateflow.session import remove, stage
from rateflow.sinks import write_day
from rateflow.sources import read_day
from rateflow.sources.store import read_table


def day(n):
    return dt.date(2024, 1, n)


def history(spark):
    pick = random.Random(3)
    rows = [
        (pick.choice(["A", "B", "C", None]), pick.choice(["r1", "r2", "out", None]), "-", day(pick.randint(1, 6)), "-", pick.choice(["X", "Y"]))
        for _ in range(120)
    ]
    return stage(ratings(spark, *rows, *rows[:20]), "history")


def told(df):
    return sorted(map(str, df.select(CHANGES.fieldNames()).collect()))


def test_days_folded_equal_the_history(spark):
    rows, standing, found = history(spark), spark.createDataFrame([], STANDING), []
    for n in range(1, 8):
        of_day = rows.where(F.col("rat_date") == day(n))
        found += told(changes_of(of_day, standing, ["out"]))
        standing = stage(next_standing(of_day, standing), "standing")
    assert sorted(found) == told(changes(rows, ["out"]))
    assert standing.count() == rows.select("agency", "name").distinct().count()


def test_a_day_reads_the_standing_and_no_older_ratings(spark, store):
    rows = history(spark)
    for n in range(1, 7):
        write_day(rows.where(F.col("rat_date") == day(n)), store.ratings, day(n))
    for n in (1, 2, 3, 3, 5, 6):
        # The fourth is skipped: what it held is not known to the fifth.
        change_day(spark, store, day(n))
        if n > 1:
            remove(spark, f"{store.ratings}/DT={day(n - 1)}")
    without = rows.where(F.col("rat_date") != day(4))
    assert told(read_table(spark, store.changes, CHANGES)) == told(changes(without))


NAMES = ["Банк Первый", "банк второй", "Bank-A", "ab", "a", "%x_", "Банк Первый", "ИСТ", "x" * 200, "", None]
NEEDLES = ["банк", "перв", "a", "ab", "%", "_", "st", "нк в", "x" * 150, "zzz", "bank-a", "ист", "кй"]


def test_index_finds_what_the_names_hold(spark, tmp_path):
    path = str(tmp_path / "index")
    names = ratings(spark, *[(n,) for n in NAMES])
    assert extend_index(spark, path, names.where("name like 'Б%'")) == 1
    assert extend_index(spark, path, names) == 8
    assert extend_index(spark, path, names) == 0
    needles = spark.createDataFrame([(n,) for n in NEEDLES], "needle string")
    distinct = names.select("name").where("name is not null").distinct()
    want = {tuple(r) for r in names_holding(distinct, needles).collect()}
    got = [tuple(r) for r in indexed_names(spark, path, needles).collect()]
    assert set(got) == want and len(got) == len(want) and want
    # Postings that a dead run has left twice change nothing.
    spark.read.parquet(f"{path}/postings").write.mode("append").partitionBy("bucket").parquet(f"{path}/postings2")
    spark.read.parquet(f"{path}/postings2").write.mode("append").partitionBy("bucket").parquet(f"{path}/postings")
    assert sorted(tuple(r) for r in indexed_names(spark, path, needles).collect()) == sorted(got)
    assert indexed_names(spark, str(tmp_path / "none"), needles).count() == 0


def test_lookup_opens_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "index")
    extend_index(spark, path, ratings(spark, *[(f"name {i} of {i * 7919}",) for i in range(300)]))
    grams = spark.createDataFrame([("nam",), ("791",)], "gram string")
    scan = postings_of(spark, path, grams)
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in text and "bucket#" in text.split("PartitionFilters")[1]
    assert len({r.bucket for r in scan.select("bucket").distinct().collect()}) <= 2


def test_answers_through_the_index(spark, tmp_path):
    path = str(tmp_path / "index")
    table = ratings(spark, ("Банк А",), ("Банк Б", "B"), ("other",), ("Банк А", "C", "-", day(3)))
    extend_index(spark, path, table)
    asked = spark.createDataFrame([(1, "банк"), (2, "x"), (3, "2024-01-15"), (4, ""), (5, "OTHER")], REQUESTS)
    plain = sorted(map(str, answers(table, asked).collect()))
    assert sorted(map(str, answers(table, asked, index=path).collect())) == plain


def test_daily_run_follows(spark, store):
    for n in (15, 15, 16):
        run_day(spark, pages(spark, *listing(f"{n}.01.2024")), store, f"2024-01-{n}", follow=True)
    events = read_table(spark, store.changes, CHANGES).groupBy("rat_date", "event").count().collect()
    assert sorted((r.rat_date.day, r.event, r["count"]) for r in events) == [(15, "assigned", 6), (16, "confirmed", 6)]
    needles = spark.createDataFrame([("банк",)], "needle string")
    assert indexed_names(spark, store.name_index, needles).count() == 6
    assert read_day(spark, store.ratings, DATE, RATINGS).count() == 6
