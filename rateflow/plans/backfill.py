"""Many past days in one job."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rateflow.functions.dates import parse_run_date
from rateflow.operators.counts import base_counts, roll_up
from rateflow.operators.digest import digest
from rateflow.operators.extract import extract
from rateflow.operators.normalize import accepted, normalize, rejected
from rateflow.plans.daily import upload_days
from rateflow.plans.record import record_of
from rateflow.schema import AGENCY_TABLE, DAY, OUTBOX, RATINGS, REJECTS, STATS
from rateflow.session import cleaned, stage
from rateflow.sinks.added import retire_days
from rateflow.sinks.store import replace_days, write_day
from rateflow.sources.store import read_day, read_days


def ratings_between(ratings, first, last):
    """Announcements of the range, each stored under its own date."""
    date = F.col("rat_date")
    within = ratings.where((date >= F.lit(first).cast("date")) & (date <= F.lit(last).cast("date")))
    return within.withColumn(DAY, date)


@cleaned
def store_days(spark, ratings, store, first, last):
    """Replace the range's days of the ratings and of the three count tables."""
    retire_days(spark, store, first, last)
    replace_days(ratings_between(ratings, first, last), store.ratings, first, last, RATINGS)
    count_days(spark, store, first, last)


@cleaned
def count_days(spark, store, first, last):
    """Recount the range's stored days: one pass over the ratings for all tables and days."""
    base = stage(base_counts(read_days(spark, store.ratings, first, last), DAY), "base")
    for table, schema in STATS.items():
        replace_days(roll_up(base, table, DAY), store.stats(table), first, last, schema, days=base)


@cleaned
def message_days(spark, store, first, last):
    """Messages of every calendar day of the range."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias(DAY)
    )
    ratings = read_days(spark, store.ratings, first, last)
    counts = read_days(spark, store.stats(AGENCY_TABLE), first, last, STATS[AGENCY_TABLE])
    # Messages come out of the day's own files, so they are written where they are made.
    replace_days(digest(ratings, counts, days), store.outbox, first, last, OUTBOX, shuffle=False, days=days)


def _add_rejects(spark, rows, store, day):
    """Rejects to those stored under the day; one that is there already is not stored twice."""
    try:
        rows = rows.unionByName(read_day(spark, store.rejects, day, REJECTS))
    except AnalysisException:
        pass
    write_day(stage(rows.distinct(), "rejects"), store.rejects, day)


@cleaned
def backfill(spark, pages, store, first, last, strict=False, shapes=None, database=None, only_new=(), resume=False):
    """All days from ``first`` to ``last``: ratings, counts, upload and messages.

    Returns the rejected rows; they belong to pages and not to a day, so they are added to
    the rejects of the last day of the range. Without ``database`` nothing is uploaded. With
    ``resume`` a run of the same inputs goes on where one that died has ended.
    """
    first, last = parse_run_date(first), parse_run_date(last)

    def read():
        rows = stage(normalize(extract(pages, shapes), strict), "rows")
        retire_days(spark, store, first, last)
        replace_days(ratings_between(accepted(rows), first, last), store.ratings, first, last, RATINGS)
        _add_rejects(spark, rejected(rows), store, last)

    record = record_of(spark, store, "backfill", pages, [first, last, strict, shapes], resume)
    record.step("ratings", read)
    record.step("counts", lambda: count_days(spark, store, first, last))
    if database is not None:
        record.step("upload", lambda: upload_days(spark, store, first, last, database, only_new))
    record.step("messages", lambda: message_days(spark, store, first, last))
    record.close()
    return read_day(spark, store.rejects, last, REJECTS)
