import datetime as dt

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from samples import ratings

from rateflow.operators import (
    base_counts,
    changes,
    count_by_agency,
    count_by_agency_rating,
    count_by_date,
    enforce_schema,
    roll_up,
    select_day,
    stamp,
    totals,
    union_feeds,
)
from rateflow.operators import ordering
from rateflow.schema import AGENCY_RATING_TABLE, AGENCY_TABLE, DATE_TABLE, RATINGS
from rateflow.session import stage

def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def dated(spark, *days):
    return ratings(spark, *[("B", "A", "-", dt.date(2024, 1, day)) for day in days])


@pytest.mark.parametrize("mode, days", [("on", [2]), ("until", [1, 2]), ("since", [2, 3])])
def test_select_day(spark, mode, days):
    kept = select_day(dated(spark, 1, 2, 3), "2024-01-02", mode)
    assert sorted(r.rat_date.day for r in kept.collect()) == days


def test_select_day_refuses_other_modes(spark):
    with pytest.raises(ValueError):
        select_day(dated(spark, 1), "2024-01-02", "after")


def sample(spark):
    day = dt.date(2024, 1, 2)
    return ratings(
        spark,
        ("a", "A", "-", day, "-", "X"),
        ("a", "A", "-", day, "-", "X"),
        ("", "B", "-", day, "-", "X"),
        (None, "A", "-", day, "-", "Y"),
        ("c", None, "-", None, "-", None),
    )


def test_counts_skip_null_names_and_keep_null_keys(spark):
    assert rows(count_by_agency(sample(spark))) == rows_of(("X", 3), ("Y", 0), (None, 1))
    assert rows(count_by_agency_rating(sample(spark))) == rows_of(
        ("X", "A", 2), ("X", "B", 1), ("Y", "A", 0), (None, None, 1)
    )
    assert rows(count_by_date(sample(spark))) == rows_of((dt.date(2024, 1, 2), 3), (None, 1))


def rows_of(*values):
    return sorted(values, key=repr)


def test_roll_up_equals_direct_counts(spark):
    base = base_counts(sample(spark))
    for table, direct in (
        (AGENCY_TABLE, count_by_agency),
        (AGENCY_RATING_TABLE, count_by_agency_rating),
        (DATE_TABLE, count_by_date),
    ):
        assert rows(roll_up(base, table)) == rows(direct(sample(spark)))


def test_stamp_and_totals(spark):
    stamped = stamp(count_by_agency(sample(spark)), "2024-01-02")
    assert dict(stamped.dtypes)["record_date"] == "date"
    assert {r.record_date for r in stamped.collect()} == {dt.date(2024, 1, 2)}
    twice = stamped.unionByName(stamped)
    assert rows(totals(twice, "agency")) == rows_of(("X", 6), ("Y", 0), (None, 2))


def test_union_matches_by_name_and_keeps_duplicates(spark):
    a = spark.createDataFrame([("n", "a")], "name string, agency string")
    b = spark.createDataFrame([("a", "n")], "agency string, name string")
    assert rows(union_feeds(a, b, a)) == [("n", "a")] * 3


def test_enforce_schema(spark):
    loose = spark.sql(
        "select 1 as agency, 2 as rating, timestamp'2024-01-02 03:04:05' as rat_date, "
        "'n' as name, 'p' as pred, 'o' as observation, 9 as other"
    )
    fixed = enforce_schema(loose)
    assert [(f.name, f.dataType) for f in fixed.schema] == [(f.name, f.dataType) for f in RATINGS]
    assert tuple(fixed.first()) == ("n", "2", "p", dt.date(2024, 1, 2), "o", "1")


def test_changes(spark):
    def day(n):
        return dt.date(2024, 1, n)

    history = ratings(
        spark,
        ("a", "A", "-", day(1)),
        ("a", "A", "up", day(2)),
        ("a", "B", "-", day(3)),
        ("a", "B", "-", day(3)),
        ("a", None, "-", day(4)),
        ("b", "A", "-", day(1)),
        ("a", "C", "-", day(1), "-", "Other"),
    )
    got = {(r.agency, r.name, r.rat_date.day): (r.previous, r.event, r.copies) for r in changes(history).collect()}
    assert got == {
        ("X", "a", 1): (None, "assigned", 1),
        ("X", "a", 2): ("A", "confirmed", 1),
        ("X", "a", 3): ("A", "changed", 2),
        ("X", "a", 4): ("B", "changed", 1),
        ("X", "b", 1): (None, "assigned", 1),
        ("Other", "a", 1): (None, "assigned", 1),
    }


def test_withdrawn_ratings(spark):
    day = lambda n: dt.date(2024, 1, n)
    history = ratings(spark, ("a", "A", "-", day(1)), ("a", "gone", "-", day(2)), ("a", "B", "-", day(3)), ("b", None, "-", day(1)))
    events = {(r.name, r.rat_date.day): r.event for r in changes(history, withdrawn=["gone"]).collect()}
    assert events == {("a", 1): "assigned", ("a", 2): "withdrawn", ("a", 3): "changed", ("b", 1): "assigned"}


def test_a_split_history_equals_the_window(spark, monkeypatch):
    rng = random.Random(5)
    history = ratings(
        spark,
        *[
            (
                "hot" if n % 3 else rng.choice(["a", "b", None]),
                rng.choice(["A", "B", "C", None]),
                str(n % 40),
                dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 60)),
            )
            for n in range(2000)
        ],
    )
    order = ["rat_date", "rating", "pred", "observation"]
    issuer = Window.partitionBy("agency", "name").orderBy(*order)
    merged = history.groupBy(*RATINGS.fieldNames()).agg(F.count("*").alias("copies"))
    opens, before = F.row_number().over(issuer) == 1, F.lag("rating").over(issuer)
    event = F.when(opens, "assigned").when(F.col("rating").eqNullSafe(before), "confirmed").otherwise("changed")
    plain = rows(merged.select("*", before.alias("previous"), event.alias("event")))
    assert rows(changes(history)) == plain
    monkeypatch.setattr(ordering, "SLOT_BYTES", 512)
    monkeypatch.setattr(ordering.slots_for, "__defaults__", (512,))
    monkeypatch.setattr("rateflow.operators.joins.broadcast_if_small.__defaults__", (0,))
    assert rows(changes(history)) == plain


def test_a_hot_group_takes_more_slots_than_shuffle_partitions(spark):
    hot = stage(spark.range(200_000).select(F.lit("hot").alias("name"), "id"), "hot")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = ordering.slots_for(hot, 20_000)
    assert wanted > 4 * least
    slots = hot.repartitionByRange(wanted, "name", "id").select(F.spark_partition_id().alias("slot")).distinct().count()
    assert slots > 4 * least
