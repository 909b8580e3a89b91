"""Appending to database tables."""

from functools import reduce

from pyspark.sql import functions as F

from rateflow.schema import TEXT_WIDTH


def _wide(df):
    checks = [F.length(c) > TEXT_WIDTH for c, kind in df.dtypes if kind == "string"]
    return F.coalesce(reduce(lambda a, b: a | b, checks, F.lit(False)), F.lit(False))


def fitting(df):
    """Rows whose texts fit the declared column width."""
    return df.where(~_wide(df))


def too_wide(df):
    """Rows with a text the database would refuse."""
    return df.where(_wide(df))


CONNECTIONS, BATCH_ROWS = 8, 10_000


def jdbc_options(url, table, properties=None, column_types=None, connections=CONNECTIONS):
    """Writer options of one append."""
    options = {"url": url, "dbtable": table, "batchsize": str(BATCH_ROWS), **(properties or {})}
    if column_types:
        options["createTableColumnTypes"] = column_types
    if connections:
        options["numPartitions"] = str(connections)
    return options


def append_jdbc(df, url, table, properties=None, column_types=None, connections=CONNECTIONS):
    """Append rows, creating the table with ``column_types`` when it is missing.

    ``connections`` bounds how many tasks write at once. An append is not idempotent: a run
    that is repeated adds its rows again, see ``plans.daily.upload_day``.
    """
    options = jdbc_options(url, table, properties, column_types, connections)
    df.write.mode("append").format("jdbc").options(**options).save()
