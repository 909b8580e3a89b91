import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from samples import DAY, cards, grid, listing, paired, pages
from test_upload import Files

from rateflow.plans import Database, backfill, daily, run_day, upload_day
from rateflow.plans.backfill import message_days
from rateflow.schema import (
    AGENCY_JDBC_TYPES,
    AGENCY_RATING_JDBC_TYPES,
    AGENCY_RATING_TABLE,
    AGENCY_TABLE,
    DATE_TABLE,
    OUTBOX,
    RATINGS,
    RATINGS_JDBC_TYPES,
    RATINGS_TABLE,
    REJECTS,
    STATS,
)
from rateflow.sinks.jdbc import fitting, jdbc_options, too_wide
from rateflow.sources import count_jdbc_days, read_day, read_pages, read_stats
from rateflow.sources.jdbc import day_predicates
from rateflow.sources.store import read_table
from rateflow.streaming import arriving_pages, run_arrived
from rateflow.streaming.incremental import read_news, take_batch

RUN = "2024-01-15"


def outbox(spark, store, day=RUN):
    rows = read_day(spark, store.outbox, day, OUTBOX).orderBy("seq").collect()
    return [(r.kind, r.text) for r in rows]


def counts(spark, store, table, day=RUN):
    return sorted(tuple(r) for r in read_stats(spark, store.stats(table), table, day).collect())


def mixed(spark):
    other = [
        paired(("Old", "ruC, 14.01.2024"), ("Bad", "ruC"), page_id=2),
        grid(("New", "C", "-", "16.01.2024"), page_id=2),
    ]
    return pages(spark, *listing(), *other)


@pytest.mark.parametrize("one_file", [False, True])
def test_run_day(spark, store, one_file):
    for _ in range(2):
        run_day(spark, mixed(spark), store, RUN, one_file=one_file)
    assert read_day(spark, store.ratings, RUN).count() == 6
    assert [r.reason for r in read_day(spark, store.rejects, RUN, REJECTS).collect()] == ["parts: 1"]
    assert counts(spark, store, AGENCY_TABLE) == [("НКР", 2), ("НРА", 2), ("Эксперт РА", 2)]
    assert len(counts(spark, store, AGENCY_RATING_TABLE)) == 6
    assert counts(spark, store, DATE_TABLE) == [(DAY, 6)]
    messages = outbox(spark, store)
    assert [kind for kind, _ in messages] == ["header"] + ["item"] * 6 + ["summary"]
    assert messages[0][1] == "Credit ratings Updates on 2024-01-15:"
    assert messages[-1][1] == (
        "<i>Number of agencies ratings TODAY:</i>\n"
        "НКР - 2 набл.\nНРА - 2 набл.\nЭксперт РА - 2 набл.\n"
    )
    item = (
        '\n    <b>Банк "А"</b>\n    <i>rating</i>:             <b>ruA+</b>'
        "\n    <i>prediction</i>:     стабильный\n    <i>rating_date</i>:   2024-01-15"
        "\n    <i>observation</i>:  -\n    <i>agency</i>:           Эксперт РА\n    "
    )
    assert ("item", item) in messages


def test_a_run_reads_the_pages_of_its_day(spark, store, tmp_path):
    path = str(tmp_path / "pages")
    came = F.when(F.col("page_id") == 2, dt.date(2024, 1, 14)).otherwise(DAY)
    mixed(spark).withColumn("arrived", came).write.partitionBy("arrived").parquet(path)
    by_arrival = read_pages(spark, path, by_arrival=True)
    run_day(spark, by_arrival, store, RUN)
    assert read_day(spark, store.ratings, RUN).count() == 6
    assert read_day(spark, store.rejects, RUN, REJECTS).count() == 0
    text = by_arrival.where(F.col("arrived") == DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(arrived" in text
    run_day(spark, by_arrival, store, "2024-01-14")
    assert [r.reason for r in read_day(spark, store.rejects, "2024-01-14", REJECTS).collect()] == ["parts: 1"]


def test_a_day_that_becomes_empty(spark, store):
    run_day(spark, mixed(spark), store, RUN)
    run_day(spark, pages(spark), store, RUN)
    assert read_day(spark, store.ratings, RUN).count() == 0
    assert counts(spark, store, AGENCY_TABLE) == []
    assert outbox(spark, store) == [("none", "No updates on 2024-01-15")]


def test_other_modes_keep_other_dates_but_report_the_day(spark, store):
    run_day(spark, mixed(spark), store, RUN, mode="until")
    assert read_day(spark, store.ratings, RUN).count() == 7
    assert counts(spark, store, DATE_TABLE) == [(dt.date(2024, 1, 14), 1), (DAY, 6)]
    assert [kind for kind, _ in outbox(spark, store)].count("item") == 6


def test_strict_run_fails(spark, store):
    with pytest.raises(Exception, match="parts: 1"):
        run_day(spark, mixed(spark), store, RUN, strict=True)


def test_backfill_equals_single_runs(spark, store, tmp_path):
    from rateflow.plans import Store

    rejects = backfill(spark, mixed(spark), store, "2024-01-13", "2024-01-16")
    assert [r.reason for r in rejects.collect()] == ["parts: 1"]
    single = Store(str(tmp_path / "single"))
    for day in ("2024-01-13", "2024-01-14", "2024-01-15", "2024-01-16"):
        run_day(spark, mixed(spark), single, day)
        for table, schema in STATS.items():
            assert counts(spark, store, table, day) == counts(spark, single, table, day)
        assert sorted(outbox(spark, store, day)) == sorted(outbox(spark, single, day))
    assert outbox(spark, store, "2024-01-13") == [("none", "No updates on 2024-01-13")]
    backfill(spark, pages(spark), store, "2024-01-15", "2024-01-15")
    assert read_table(spark, store.ratings, RATINGS).count() == 2
    message_days(spark, store, "2024-01-15", "2024-01-15")
    assert outbox(spark, store) == [("none", "No updates on 2024-01-15")]


def test_stream_takes_new_records_once(spark, store, tmp_path):
    arrived, progress = str(tmp_path / "arrived"), str(tmp_path / "progress")

    def arrive(*rows):
        pages(spark, *rows).write.mode("append").partitionBy("source").parquet(arrived)
        run_arrived(spark, arriving_pages(spark, arrived), store, progress)

    first = listing()
    arrive(*first)
    arrive(first[0], cards(("Банк Ж", "B", "-", "-", "15.01.2024"), page_id=3), paired(("x", "y"), page_id=4))
    run_arrived(spark, arriving_pages(spark, arrived), store, progress)
    assert read_table(spark, store.ratings, RATINGS).count() == 7
    assert counts(spark, store, DATE_TABLE) == [(DAY, 7)]
    sent = read_news(spark, store.news).groupBy("batch", "kind").count().collect()
    assert sorted((r["batch"].rpartition("-")[2], r["kind"], r["count"]) for r in sent) == [
        *(("0", kind, n) for kind, n in (("header", 1), ("item", 6), ("summary", 1))),
        *(("1", kind, 1) for kind in ("header", "item", "summary")),
    ]
    # A repeated batch and a lost checkpoint, which reads every page again, change nothing.
    take_batch(pages(spark, first[0], cards(("Банк Ж", "B", "-", "-", "15.01.2024"), page_id=3)), 1, store)
    run_arrived(spark, arriving_pages(spark, arrived), store, str(tmp_path / "other"))
    assert read_table(spark, store.ratings, RATINGS).count() == 7
    assert read_news(spark, store.news).where("kind = 'item'").count() == 7
    rejects = read_news(spark, store.arrived_rejects, REJECTS)
    assert {r.reason for r in rejects.collect()} == {"parts: 1"}


def test_stream_and_daily_run_share_a_store(spark, store, tmp_path):
    arrived, progress = str(tmp_path / "arrived"), str(tmp_path / "progress")
    run_day(spark, mixed(spark), store, "2024-01-14")
    pages(spark, *listing()).write.mode("append").partitionBy("source").parquet(arrived)
    run_arrived(spark, arriving_pages(spark, arrived), store, progress)
    assert read_table(spark, store.ratings, RATINGS).count() == 7
    assert counts(spark, store, DATE_TABLE) == [(DAY, 6)]
    run_day(spark, mixed(spark), store, RUN)
    assert read_table(spark, store.ratings, RATINGS).count() == 7
    pages(spark, cards(("Банк Ж", "B", "-", "-", "15.01.2024"), page_id=3)).write.mode("append").partitionBy("source").parquet(arrived)
    run_arrived(spark, arriving_pages(spark, arrived), store, progress)
    assert counts(spark, store, DATE_TABLE) == [(DAY, 7)]


def test_upload_day(spark, store, monkeypatch):
    wide = paired(("W" * 129, "ruA, 15.01.2024"), ("V", "Q" * 130 + ", 15.01.2024"), page_id=5)
    everything = mixed(spark).unionByName(pages(spark, wide))
    sent, there = {}, {}

    def append(df, url, table, properties, types, connections):
        sent[table] = (df, types)

    def counted(spark, url, table, column, days, properties, connections):
        asked = there[table].where(F.col(column).isin(days))
        return asked.groupBy(F.col(column).alias("load_date")).agg(F.count("*").alias("present"))

    monkeypatch.setattr(daily, "append_jdbc", append)
    monkeypatch.setattr(daily, "count_jdbc_days", counted)
    base = Database("jdbc:any", {"user": "u"})
    run_day(spark, everything, store, RUN, database=base)
    assert {table: types for table, (_, types) in sent.items()} == {
        RATINGS_TABLE: RATINGS_JDBC_TYPES,
        AGENCY_TABLE: AGENCY_JDBC_TYPES,
        AGENCY_RATING_TABLE: AGENCY_RATING_JDBC_TYPES,
        DATE_TABLE: None,
    }
    for table in STATS:
        assert {r.record_date for r in sent[table][0].collect()} == {DAY}
    # What is sent and what is refused is what is stored, for ratings and for counts.
    assert sent[RATINGS_TABLE][0].columns == RATINGS.fieldNames()
    assert (sent[RATINGS_TABLE][0].count(), read_day(spark, store.refused, RUN).count()) == (6, 2)
    assert read_day(spark, store.ratings, RUN).count() == 8
    for table in STATS:
        refused = read_day(spark, store.refused_stats(table), RUN, STATS[table]).count()
        assert sent[table][0].count() + refused == read_stats(spark, store.stats(table), table, RUN).count()
        assert refused == (table == AGENCY_RATING_TABLE)
    # A repeated run adds nothing, and what an append has left half-way is not passed over.
    there.update({table: df for table, (df, _) in sent.items()})
    upload_day(spark, store, RUN, base, only_new=tuple(there))
    assert all(df.count() == 0 for df, _ in sent.values())
    there[AGENCY_TABLE] = there[AGENCY_TABLE].limit(1)
    with pytest.raises(daily.PartlyLoaded, match="1 of 3 rows of 2024-01-15"):
        upload_day(spark, store, RUN, base, only_new=(AGENCY_TABLE,))
    sent.clear()
    backfill(spark, everything, store, "2024-01-14", "2024-01-16", database=base)
    assert sent[RATINGS_TABLE][0].count() == 8
    assert {r.record_date.day for r in sent[DATE_TABLE][0].collect()} == {14, 15, 16}
    assert [r.reason for r in read_day(spark, store.rejects, "2024-01-16", REJECTS).collect()] == ["parts: 1"]


def test_a_day_is_uploaded_once_in_two_phases(spark, store, tmp_path):
    """Repeated runs, a backfill over the same days, and a late row of an old date."""
    root = str(tmp_path / "database")
    base = Database("", target=lambda table, columns: Files(f"{root}/{table}"))
    late = cards(("Late", "B", "-", "-", "10.01.2024"), page_id=7)
    for _ in range(2):
        run_day(spark, mixed(spark), store, RUN, database=base)
    run_day(spark, pages(spark, *listing("16.01.2024"), late), store, "2024-01-16", mode="until", database=base)
    loaded = {table: Files(f"{root}/{table}").days() for table in (RATINGS_TABLE, *STATS)}
    assert {day: len(rows) for day, rows in loaded[RATINGS_TABLE].items()} == {RUN: 6, "2024-01-16": 7}
    for table in STATS:
        stored = sorted(counts(spark, store, table) + counts(spark, store, table, "2024-01-16"), key=str)
        rows = [row for day in loaded[table].values() for row in day]
        assert sorted((tuple(row[:-1]) for row in rows), key=str) == sorted((tuple(json.loads(json.dumps(r, default=str))) for r in stored), key=str)
        assert {row[-1] for row in rows} == {RUN, "2024-01-16"}
    backfill(spark, mixed(spark), store, "2024-01-13", "2024-01-16", database=base)
    days = Files(f"{root}/{RATINGS_TABLE}").days()
    assert {day: len(rows) for day, rows in days.items()} == {"2024-01-14": 1, RUN: 6, "2024-01-16": 7}


def test_reads_of_days_are_planned(monkeypatch):
    one = [dt.date(2024, 1, n) for n in range(1, 11)]
    assert day_predicates("d", one, 3) == [
        "d BETWEEN DATE '2024-01-01' AND DATE '2024-01-04'",
        "d BETWEEN DATE '2024-01-05' AND DATE '2024-01-08'",
        "d BETWEEN DATE '2024-01-09' AND DATE '2024-01-10'",
    ]
    assert day_predicates("d", ["2024-01-05", "2024-01-01", "2024-01-01"], 8) == ["d BETWEEN DATE '2024-01-01' AND DATE '2024-01-01'", "d BETWEEN DATE '2024-01-05' AND DATE '2024-01-05'"]
    assert day_predicates("d", ["2024-01-05", "2024-01-01"], 1) == ["d IN (DATE '2024-01-01', DATE '2024-01-05')"]

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            return url, table, predicates, properties

    class Session:
        read = Reader()

    url, table, predicates, properties = count_jdbc_days(Session(), "u", "t", "d", one, {"user": "x"}, 2)
    assert table == (
        "(SELECT d AS load_date, COUNT(*) AS present FROM t "
        "WHERE d BETWEEN DATE '2024-01-01' AND DATE '2024-01-10' GROUP BY d) counted"
    )
    assert [p.split()[0] for p in predicates] == ["load_date", "load_date"] and properties == {"user": "x"}


def test_run_dates_are_read_on_entry(spark, store):
    with pytest.raises(ValueError):
        run_day(spark, mixed(spark), store, "15.01.2024")
    with pytest.raises(ValueError):
        backfill(spark, mixed(spark), store, "2024-01-01", "2024-13-01")


def test_jdbc_options_and_width(spark):
    assert jdbc_options("u", "t", {"driver": "d"}, "a INT", 8) == {
        "url": "u",
        "dbtable": "t",
        "batchsize": "10000",
        "driver": "d",
        "createTableColumnTypes": "a INT",
        "numPartitions": "8",
    }
    assert jdbc_options("u", "t") == {"url": "u", "dbtable": "t", "batchsize": "10000", "numPartitions": "8"}
    df = spark.createDataFrame([("a" * 128, "b", 1), ("c", "d" * 129, 2), (None, "e", 3)], "x string, y string, n int")
    assert sorted(r.n for r in fitting(df).collect()) == [1, 3]
    assert [r.n for r in too_wide(df).collect()] == [2]
    assert "u" not in repr(Database("jdbc:x", {"password": "u"})).replace("Database(url=", "")
