from rateflow.plans.backfill import backfill
from rateflow.plans.daily import (
    Database,
    Store,
    change_day,
    count_day,
    index_day,
    ingest_day,
    message_day,
    run_day,
    upload_day,
)

__all__ = [
    "Database",
    "Store",
    "backfill",
    "change_day",
    "count_day",
    "index_day",
    "ingest_day",
    "message_day",
    "run_day",
    "upload_day",
]
