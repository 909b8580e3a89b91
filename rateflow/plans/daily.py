"""The daily run: extract, union, normalise, filter, store, count, upload, messages.

Each step reads what the step before stored, so any of them can be repeated alone.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rateflow.functions.dates import parse_run_date
from rateflow.operators.changes import changes_of, next_standing
from rateflow.operators.counts import base_counts, roll_up
from rateflow.operators.digest import digest
from rateflow.operators.extract import extract
from rateflow.operators.name_index import extend_index
from rateflow.operators.normalize import accepted, normalize, rejected
from rateflow.operators.select import day_condition
from rateflow.schema import (
    AGENCY_JDBC_TYPES,
    AGENCY_RATING_JDBC_TYPES,
    AGENCY_RATING_TABLE,
    AGENCY_TABLE,
    ARRIVED,
    DATE_JDBC_TYPES,
    DATE_TABLE,
    DAY,
    OUTBOX,
    RATINGS,
    RATINGS_JDBC_TYPES,
    RATINGS_TABLE,
    STANDING,
    STATS,
)
from rateflow.plans.record import record_of
from rateflow.session import cleaned, stage
from rateflow.sinks.added import add_batch, begin_tables, new_records, of_days, retire_days
from rateflow.sinks.jdbc import CONNECTIONS, append_jdbc, fitting, too_wide
from rateflow.sinks.store import replace_days, write_day
from rateflow.sinks.upload import upload
from rateflow.sources.jdbc import count_jdbc_days
from rateflow.sources.store import read_day, read_days, read_table


@dataclass(frozen=True)
class Store:
    """Where the stored tables are."""

    root: str

    @property
    def ratings(self):
        return f"{self.root}/ratings"

    @property
    def rejects(self):
        return f"{self.root}/rejects"

    @property
    def refused(self):
        return f"{self.root}/refused"

    @property
    def outbox(self):
        return f"{self.root}/outbox"

    @property
    def changes(self):
        return f"{self.root}/changes"

    @property
    def standing(self):
        return f"{self.root}/standing"

    @property
    def name_index(self):
        return f"{self.root}/name_index"

    @property
    def news(self):
        return f"{self.root}/news"

    @property
    def arrived_rejects(self):
        return f"{self.root}/arrived_rejects"

    def refused_stats(self, table):
        return f"{self.root}/refused_{table}"

    def stats(self, table):
        return f"{self.root}/{table}"


@dataclass(frozen=True)
class Database:
    """Where the uploads go. ``properties`` holds driver, user and password.

    ``target(table, columns)``, if given, names what takes a table's rows in two phases, for
    example a ``sinks.upload.DatabaseTable``; otherwise Spark appends over JDBC.
    """

    url: str
    properties: dict = field(default_factory=dict, repr=False)
    connections: int = CONNECTIONS
    target: Callable | None = field(default=None, repr=False)


@cleaned
def ingest_day(spark, pages, store, day, mode="on", strict=False, shapes=None, one_file=False, late=False):
    """Pages to the day's stored ratings and rejects.

    With ``late``, ratings of the pages that are dated before the day and not stored yet are
    added to the days of their dates.

    Of pages with a column ``arrived`` only those of the day are read: stored by it, a run
    scans one partition, and a day's rejects are of the pages that came that day.
    """
    if ARRIVED in pages.columns:
        pages = pages.where(F.col(ARRIVED) == F.lit(day).cast("date"))
    rows = normalize(extract(pages, shapes), strict)
    # Both tables come from one pass over the pages. Only rows of interest are staged, which
    # are few to a task, so they are first brought together to files of a sensible size.
    wanted, earlier = day_condition(day, mode), F.col("rat_date") < F.lit(day).cast("date")
    kept = rows.where(F.col("reason").isNotNull() | (wanted | earlier if late else wanted))
    kept = stage(kept.hint("rebalance"), "rows")
    retire_days(spark, store, day, day)
    write_day(accepted(kept).where(wanted), store.ratings, day, one_file)
    write_day(rejected(kept), store.rejects, day)
    if late:
        found = accepted(kept).where(earlier).withColumn(DAY, F.col("rat_date"))
        begin_tables(spark, store)
        dates = stage(found.select(DAY).distinct(), "dates")
        add_batch(stage(new_records(found, of_days(spark, store.ratings, dates)), "late"), store, f"late-{day}")


@cleaned
def count_day(spark, store, day):
    """The three count tables of a stored day, from one pass over its ratings."""
    base = stage(base_counts(read_day(spark, store.ratings, day)), "base")
    for table in STATS:
        write_day(roll_up(base, table), store.stats(table), day)


class PartlyLoaded(Exception):
    """A database table holds some rows of a day, but not as many as are stored."""


def _missing_days(spark, database, table, column, rows):
    """Days of ``rows`` that the database table has no row of yet.

    A day counts as loaded when it has exactly as many rows there as here. Any other number
    is what an append that died has left; that is an error, since rows cannot be told apart.
    The database counts, and only the days that are asked for.
    """
    here = stage(rows.groupBy(F.col(column).alias("day")).agg(F.count("*").alias("expected")), "days")
    # As many as the days of the run.
    days = [day for (day,) in here.where("day is not null").select("day").collect()]
    if not days:
        return here.select(F.col("day").alias(column)).limit(0)
    there = count_jdbc_days(spark, database.url, table, column, days, database.properties, database.connections)
    states = here.join(there, F.col("load_date") == F.col("day"), "left")
    states = stage(states.select("day", "expected", F.coalesce("present", F.lit(0)).alias("present")), "loaded")
    odd = states.where("present not in (0, expected)").orderBy("day").first()
    if odd:
        raise PartlyLoaded(f"{table} has {odd['present']} of {odd['expected']} rows of {odd['day']}")
    return states.where("present = 0").select(F.col("day").alias(column))


def upload_days(spark, store, first, last, database, only_new=()):
    """Append the ratings and stamped counts stored from ``first`` to ``last`` to the database.

    A table named in ``only_new`` must exist; days that it holds already are left out, so that
    a repeated run adds nothing. Rows with a text over the column width would fail the whole
    append; they go to the table's ``refused`` rows instead, ratings and counts alike.

    With a ``target`` in the database every day stored comes in once, however often a run of
    it is repeated: what is in is noted by the day it is stored under.
    """
    ratings = read_days(spark, store.ratings, first, last)
    uploads = [(RATINGS_TABLE, ratings, store.refused, RATINGS, RATINGS_JDBC_TYPES, "rat_date")]
    for table, types in (
        (AGENCY_TABLE, AGENCY_JDBC_TYPES),
        (AGENCY_RATING_TABLE, AGENCY_RATING_JDBC_TYPES),
        (DATE_TABLE, DATE_JDBC_TYPES),
    ):
        counts = read_days(spark, store.stats(table), first, last, STATS[table])
        uploads.append((table, counts, store.refused_stats(table), STATS[table], types, "record_date"))
    for table, rows, refused, schema, types, column in uploads:
        replace_days(too_wide(rows), refused, first, last, schema)
        rows = fitting(rows)
        if column == "record_date":
            rows = rows.withColumn("record_date", F.col(DAY))
        if database.target:
            upload(rows, database.target(table, types), first, last, database.connections)
            continue
        rows, types = rows.drop(DAY), None if table == DATE_TABLE else types
        if table in only_new:
            rows = rows.join(_missing_days(spark, database, table, column, rows), column, "left_semi").select(rows.columns)
        append_jdbc(rows, database.url, table, database.properties, types, database.connections)


def upload_day(spark, store, day, database, only_new=()):
    """The upload of one stored day."""
    upload_days(spark, store, day, day, database, only_new)


@cleaned
def message_day(spark, store, day):
    """The day's messages, to the outbox."""
    days = spark.range(1).select(F.lit(day).cast("date").alias(DAY))
    ratings = read_days(spark, store.ratings, day, day)
    counts = read_days(spark, store.stats(AGENCY_TABLE), day, day, STATS[AGENCY_TABLE])
    write_day(digest(ratings, counts, days).select(*OUTBOX.fieldNames()), store.outbox, day)


def standing_before(spark, store, day):
    """The last stored standing of a day before ``day``; nobody stands before the first."""
    try:
        stored = read_table(spark, store.standing, STANDING).where(F.col(DAY) < F.lit(day).cast("date"))
    except AnalysisException:
        return spark.createDataFrame([], STANDING)
    last = stored.agg(F.max(DAY)).first()[0]
    return read_day(spark, store.standing, last, STANDING) if last else stored.drop(DAY)


@cleaned
def change_day(spark, store, day, withdrawn=()):
    """The day's changes of ratings, and each issuer's standing after it.

    Reads the day and the standing before it, no older ratings. Days are taken in order; one
    that is stored again is to be followed by the days after it.
    """
    ratings = read_day(spark, store.ratings, day)
    standing = standing_before(spark, store, day)
    write_day(changes_of(ratings, standing, withdrawn), store.changes, day)
    write_day(next_standing(ratings, standing), store.standing, day)


@cleaned
def index_day(spark, store, day):
    """The day's new names, to the index that name lookups use."""
    return extend_index(spark, store.name_index, read_day(spark, store.ratings, day))


@cleaned
def run_day(
    spark, pages, store, day, mode="on", strict=False, shapes=None, one_file=False, database=None, only_new=(),
    follow=False, late=False, resume=False,
):
    """The whole chain for one day; without ``database`` nothing is uploaded.

    ``follow`` also stores the day's changes with the standing after it, and indexes its names.
    ``late`` adds ratings that came late to the days of their dates. With ``resume`` a run of
    the same inputs goes on where one that died has ended.
    """
    day = parse_run_date(day)
    record = record_of(spark, store, "day", pages, [day, mode, strict, shapes, one_file, late, follow], resume)
    record.step("ratings", lambda: ingest_day(spark, pages, store, day, mode, strict, shapes, one_file, late))
    record.step("counts", lambda: count_day(spark, store, day))
    if follow:
        record.step("changes", lambda: change_day(spark, store, day))
        record.step("names", lambda: index_day(spark, store, day))
    if database is not None:
        record.step("upload", lambda: upload_day(spark, store, day, database, only_new))
    record.step("messages", lambda: message_day(spark, store, day))
    record.close()
