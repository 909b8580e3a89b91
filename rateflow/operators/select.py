"""Which announcements a run keeps."""

from pyspark.sql import functions as F


def day_condition(day, mode="on"):
    """The test an announcement has to pass: ``on`` the day, up to it (``until``) or from it
    on (``since``)."""
    date = F.col("rat_date")
    limit = F.lit(day).cast("date")
    if mode == "on":
        return date == limit
    if mode == "until":
        return date <= limit
    if mode == "since":
        return date >= limit
    raise ValueError(f"mode must be on, until or since, not {mode!r}")


def select_day(ratings, day, mode="on"):
    """Announcements of a day, or up to it, or from it on."""
    return ratings.where(day_condition(day, mode))
