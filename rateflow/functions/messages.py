"""Message texts."""

from pyspark.sql import functions as F

from rateflow.functions.dates import format_day
from rateflow.functions.text import escape_html, or_absent

# The wording and spacing of every message.
ITEM_LINES = (
    ("<b>", "name", "</b>"),
    ("<i>rating</i>:             <b>", "rating", "</b>"),
    ("<i>prediction</i>:     ", "pred", ""),
    ("<i>rating_date</i>:   ", "rat_date", ""),
    ("<i>observation</i>:  ", "observation", ""),
    ("<i>agency</i>:           ", "agency", ""),
)
DIGEST_INDENT = "    "
DIGEST_END = "\n    "
LOOKUP_INDENT = ""
LOOKUP_END = "\n            "
DIGEST_HEADER = "Credit ratings Updates on %s:"
DIGEST_NONE = "No updates on %s"
SUMMARY_HEADER = "<i>Number of agencies ratings TODAY:</i>\n"
SUMMARY_LINE = "%s - %s набл.\n"
ANSWER_HEADER = "Доступные рейтинги:"
ANSWER_NONE = "Нет рейтинга"


def _item(indent, end):
    parts = []
    for before, column, behind in ITEM_LINES:
        value = format_day("rat_date") if column == "rat_date" else escape_html(F.col(column))
        parts += [F.lit(f"\n{indent}{before}"), or_absent(value), F.lit(behind)]
    return F.concat(*parts, F.lit(end))


def digest_item():
    """One rating as it stands in a day's digest."""
    return _item(DIGEST_INDENT, DIGEST_END)


def lookup_item():
    """One rating as it stands in the answer to a lookup."""
    return _item(LOOKUP_INDENT, LOOKUP_END)


def day_line(template, day):
    """A header or "nothing" line for a day."""
    return F.format_string(template, format_day(day))


def summary_line():
    """One agency's line of the day's summary."""
    return F.format_string(
        SUMMARY_LINE, or_absent(escape_html(F.col("agency"))), F.col("num_ratings").cast("string")
    )
