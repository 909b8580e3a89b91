"""Counts of announcements.

Every count is a partial aggregate before its shuffle, so a key that holds a third of all
rows sends one row per task and not its rows.
"""

from pyspark.sql import functions as F

from rateflow.schema import AGENCY_RATING_TABLE, AGENCY_TABLE, DATE_TABLE, STATS

KEYS = {
    AGENCY_TABLE: ("agency",),
    AGENCY_RATING_TABLE: ("agency", "rating"),
    DATE_TABLE: ("rat_date",),
}


def count_by(ratings, *keys):
    """Named announcements per key; a null name is not counted, a null key is a group."""
    return ratings.groupBy(*keys).agg(F.count("name").alias("num_ratings"))


def count_by_agency(ratings):
    return count_by(ratings, "agency")


def count_by_agency_rating(ratings):
    return count_by(ratings, "agency", "rating")


def count_by_date(ratings):
    return count_by(ratings, "rat_date")


def base_counts(ratings, *by):
    """Counts at the finest grain the three tables need: one pass over the ratings."""
    return count_by(ratings, *by, "agency", "rating", "rat_date")


def roll_up(base, table, *by):
    """One of the three count tables from ``base_counts``."""
    keys = (*by, *KEYS[table])
    summed = base.groupBy(*keys).agg(F.sum("num_ratings").alias("num_ratings"))
    return summed.select(*STATS[table].fieldNames(), *by)


def stamp(counts, day):
    """Add the run date as ``record_date``; ``day`` is a date, its text, or a column."""
    return counts.withColumn("record_date", (day if hasattr(day, "cast") else F.lit(day)).cast("date"))


def totals(stats, *keys):
    """Accumulated counts over all stored days, for a dashboard."""
    return stats.groupBy(*keys).agg(F.sum("num_ratings").alias("num_ratings"))
