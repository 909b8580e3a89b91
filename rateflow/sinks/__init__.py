from rateflow.sinks.jdbc import append_jdbc, fitting, too_wide
from rateflow.sinks.store import replace_days, write_day, write_days
from rateflow.sinks.upload import DatabaseTable, upload

__all__ = ["DatabaseTable", "append_jdbc", "fitting", "replace_days", "too_wide", "upload", "write_day", "write_days"]
