from rateflow.sources.archive import extract_archive, read_archive
from rateflow.sources.jdbc import count_jdbc_days, read_jdbc, read_jdbc_days
from rateflow.sources.store import read_day, read_days, read_stats
from rateflow.sources.pages import read_pages

__all__ = [
    "count_jdbc_days",
    "extract_archive",
    "read_archive",
    "read_day",
    "read_days",
    "read_jdbc",
    "read_jdbc_days",
    "read_pages",
    "read_stats",
]
