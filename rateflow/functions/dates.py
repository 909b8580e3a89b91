"""Date expressions."""

import datetime as dt

from pyspark.sql import functions as F

_DAY_MONTH_YEAR = r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"


def dots_to_dashes(text):
    """Every dot becomes a dash."""
    return F.replace(text, F.lit("."), F.lit("-"))


def parse_day(text):
    """Date of ``d-M-yyyy`` text, null when it is no such date."""
    return F.when(text.rlike(_DAY_MONTH_YEAR), F.try_to_date(text, "d-M-yyyy"))


def parse_run_date(text):
    """Date of ``yyyy-MM-dd`` text; other text is an error. A date is taken as it is."""
    return text if isinstance(text, dt.date) else dt.datetime.strptime(text, "%Y-%m-%d").date()


def format_day(day):
    """A date as ``yyyy-MM-dd`` text."""
    return F.date_format(day, "yyyy-MM-dd")
