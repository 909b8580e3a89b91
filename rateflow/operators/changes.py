"""News: how an issuer's rating moved between announcements."""

from pyspark.sql import functions as F

from rateflow.operators.joins import broadcast_if_small
from rateflow.operators.ordering import preceded
from rateflow.schema import RATING_COLUMNS
from rateflow.session import stage

ISSUER = ["agency", "name"]
ORDER = ["rat_date", "rating", "pred", "observation"]


def _merged(ratings):
    return stage(ratings.groupBy(*RATING_COLUMNS).agg(F.count(F.lit(1)).alias("copies")), "merged")


def _told(known, withdrawn):
    """What each announcement means, given the rating before it and whether it is the first."""
    event = (
        F.when(F.col("rating").isin(list(withdrawn)), "withdrawn")
        .when(F.col("opens"), "assigned")
        .when(F.col("rating").eqNullSafe(F.col("previous")), "confirmed")
        .otherwise("changed")
    )
    return known.withColumn("event", event).drop("opens")


def changes(ratings, withdrawn=()):
    """Each distinct announcement with the issuer's rating before it and what that means.

    ``event`` is ``assigned`` for the first rating an agency gives an issuer, ``changed`` or
    ``confirmed`` afterwards, and ``withdrawn`` wherever the rating is one of the texts in
    ``withdrawn``. Announcements of one day are ordered by rating, outlook and
    observation. Equal announcements are one row with their number in ``copies``, counted
    before the shuffle, so repeats do not make a group large, and a long history is split
    over tasks.
    """
    return _told(preceded(_merged(ratings), ISSUER, ORDER, "rating"), withdrawn)


def _with_standing(rows, standing):
    """``rows`` with ``stood``, the issuer's standing, null for one that has none."""
    held = standing.select(*[F.col(c).alias(f"_{c}") for c in ISSUER], F.struct("rating").alias("stood"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ISSUER]
    return rows.join(broadcast_if_small(held), same, "left").drop(*[f"_{c}" for c in ISSUER])


def changes_of(ratings, standing, withdrawn=()):
    """``changes`` for new announcements, none older than what ``standing`` was made of.

    ``standing`` has the last rating of each issuer, ``agency, name, rating``. No older
    announcement is read. Fold it with ``next_standing`` from one day to the next.
    """
    known = _with_standing(preceded(_merged(ratings), ISSUER, ORDER, "rating"), standing)
    before = F.when(F.col("opens"), F.col("stood.rating")).otherwise(F.col("previous"))
    known = known.withColumn("previous", before).withColumn("opens", F.col("opens") & F.col("stood").isNull())
    return _told(known.drop("stood"), withdrawn)


def next_standing(ratings, standing):
    """The standing after ``ratings``: their last rating of an issuer, else the one that stood."""
    last = ratings.groupBy(*ISSUER).agg(F.max_by(F.struct("rating"), F.struct(*ORDER)).alias("now"))
    both = last.unionByName(standing.select(*ISSUER, F.struct("rating").alias("stood")), allowMissingColumns=True)
    # At most two rows an issuer, so a group is small whatever its history.
    merged = both.groupBy(*ISSUER).agg(F.max("now").alias("now"), F.max("stood").alias("stood"))
    return merged.select(*ISSUER, F.coalesce("now", "stood")["rating"].alias("rating"))
