"""A day's messages: header, one per rating, summary."""

from pyspark.sql import functions as F

from rateflow.functions.messages import (
    DIGEST_HEADER,
    DIGEST_NONE,
    SUMMARY_HEADER,
    day_line,
    digest_item,
    summary_line,
)
from rateflow.operators.joins import broadcast_if_small
from rateflow.schema import DAY
from rateflow.session import stage

LAST = 2**63 - 1


def day_totals(ratings, days):
    """Number of ratings of each asked day, zero included."""
    counted = ratings.groupBy(DAY).agg(F.count(F.lit(1)).alias("n"))
    return days.join(counted, DAY, "left").select(DAY, F.coalesce("n", F.lit(0)).alias("n"))


def summary(agency_stats):
    """The summary text of each day; a day has one line per agency, so groups stay small."""
    lines = agency_stats.select(DAY, "agency", summary_line().alias("line"))
    return lines.groupBy(DAY).agg(
        F.concat(
            F.lit(SUMMARY_HEADER),
            F.expr("listagg(line, '') within group (order by agency nulls first)"),
        ).alias("text")
    )


def digest(ratings, agency_stats, days):
    """Messages of every day in ``days``: columns DT, seq, kind, text.

    ``ratings`` and ``agency_stats`` carry the stored day. Within a day ``seq`` is unique and
    puts the header first, then the ratings in stored order, then the summary. Ratings get it
    from their place in the scan: they are neither shuffled nor sorted, whatever share of all
    rows one day holds. The numbers are therefore increasing but not consecutive.
    """
    todays = ratings.where(F.col("rat_date") == F.col(DAY))
    counted = stage(day_totals(todays, days), "days")
    asked = broadcast_if_small(counted.select(DAY))
    empty = F.col("n") == 0
    opener = counted.select(
        DAY,
        F.lit(0).cast("bigint").alias("seq"),
        F.when(empty, "none").otherwise("header").alias("kind"),
        F.when(empty, day_line(DIGEST_NONE, DAY))
        .otherwise(day_line(DIGEST_HEADER, DAY))
        .alias("text"),
    )
    items = todays.join(asked, DAY, "left_semi").select(
        DAY,
        (F.monotonically_increasing_id() + 1).alias("seq"),
        F.lit("item").alias("kind"),
        digest_item().alias("text"),
    )
    closer = (
        summary(agency_stats)
        .join(counted.where(~empty), DAY, "left_semi")
        .select(DAY, F.lit(LAST).alias("seq"), F.lit("summary").alias("kind"), "text")
    )
    return opener.unionByName(items).unionByName(closer)
