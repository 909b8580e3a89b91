from rateflow.operators.changes import changes
from rateflow.operators.counts import (
    base_counts,
    count_by,
    count_by_agency,
    count_by_agency_rating,
    count_by_date,
    roll_up,
    stamp,
    totals,
)
from rateflow.operators.digest import day_totals, digest, summary
from rateflow.operators.extract import extract, extract_cards, extract_grid, extract_paired
from rateflow.operators.lookup import answer, answers, find_by_date, find_by_name, route
from rateflow.operators.normalize import (
    accepted,
    composite,
    enforce_schema,
    normalize,
    rejected,
    union_feeds,
)
from rateflow.operators.select import select_day

__all__ = [
    "accepted",
    "answer",
    "answers",
    "base_counts",
    "changes",
    "composite",
    "count_by",
    "count_by_agency",
    "count_by_agency_rating",
    "count_by_date",
    "day_totals",
    "digest",
    "enforce_schema",
    "extract",
    "extract_cards",
    "extract_grid",
    "extract_paired",
    "find_by_date",
    "find_by_name",
    "normalize",
    "rejected",
    "roll_up",
    "route",
    "select_day",
    "stamp",
    "summary",
    "totals",
    "union_feeds",
]
