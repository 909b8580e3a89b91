"""Writing stored tables by day."""

from pyspark.errors import AnalysisException

from rateflow.schema import DAY, by_day
from rateflow.sources.store import read_days

def write_day(df, path, day, one_file=False):
    """Replace one day of a stored table; a day without rows becomes empty, not stale.

    ``one_file`` brings the day to one task, which writes a single file whatever its size.
    """
    if one_file:
        df = df.repartition(1)
    df.write.mode("overwrite").parquet(f"{path}/{DAY}={day}")


def write_days(df, path, *by, shuffle=True):
    """Replace the day partitions present in ``df``, which carries the day; keep all others.

    ``by`` names the partition columns, the day alone if not given. Rows are rebalanced by
    them: small days share a task, a large one is split over several. Without ``shuffle``
    every task writes the days it has, for rows that come from a table stored by day.
    """
    by = by or (DAY,)
    df = df.hint("rebalance", *by) if shuffle else df
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def _stored_days(spark, path, first, last, schema):
    """Days of the range a table holds; a table not written yet holds none."""
    try:
        stored = read_days(spark, path, first, last, schema)
    except AnalysisException:
        return []
    return [day for (day,) in stored.select(DAY).distinct().collect()]


def replace_days(df, path, first, last, schema, shuffle=True, days=None):
    """Make the days from ``first`` to ``last`` of a stored table exactly ``df``.

    A dynamic overwrite touches only days that have rows, so a stored day of the range that
    has none now is emptied on its own. There are at most as many as days in the range.
    ``days`` is a table with the days of ``df``, for a ``df`` that is dear to work out twice.
    """
    spark = df.sparkSession
    before = _stored_days(spark, path, first, last, schema)
    write_days(df.select(*by_day(schema).fieldNames()), path, shuffle=shuffle)
    if not before:
        return
    now = {day for (day,) in (df if days is None else days).select(DAY).distinct().collect()}
    empty = spark.createDataFrame([], schema)
    for day in before:
        if day not in now:
            write_day(empty, path, day)
