"""Stored tables, partitioned by day.

Readers open the table's root with a fixed schema and filter on the day: the filter prunes
partitions, and a day that was never written is empty instead of an error.

What arrives later is kept beside a table, in ``<table>_added`` by batch and day. The log of
the store says which of these parts count: a batch's parts do from its one commit on, until a
later commit retires them. Readers put the table and its live parts together.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rateflow.schema import DAY, RATINGS, STATS, by_day

BATCH = "batch"
ADD, RETIRE = "add", "retire"
# A commit's rows: the part ``of`` and day that it adds, with its rows, or retires. A batch
# without parts has one row without a day.
LOG = T.StructType(
    [
        T.StructField("op", T.StringType()),
        T.StructField("of", T.StringType()),
        T.StructField(DAY, T.DateType()),
        T.StructField("n", T.LongType()),
        T.StructField(BATCH, T.StringType()),
    ]
)


def log_path(path):
    """The log of the store that the table ``path`` belongs to."""
    return f"{path.rstrip('/').rsplit('/', 1)[0]}/added_log"


def read_log(spark, path):
    """All commits of the store of ``path``; none has been made where there is no log."""
    try:
        return spark.read.schema(LOG).parquet(log_path(path))
    except AnalysisException:
        return spark.createDataFrame([], LOG)


def live_parts(spark, path, first=None, last=None):
    """Parts added and not retired, as rows ``of, DT, n``, of the days from ``first`` to ``last``.

    Merging keeps their number to a few for each day.
    """
    log = read_log(spark, path).where(F.col(DAY).isNotNull())
    if first is not None:
        log = log.where(F.col(DAY).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    ops = F.collect_set("op")
    states = log.groupBy("of", DAY).agg(ops.alias("ops"), F.max("n").alias("n"))
    return states.where(~F.array_contains("ops", RETIRE)).select("of", DAY, "n").collect()


def committed(spark, path):
    """Names of the batches whose commit was made."""
    return read_log(spark, path).where(F.col("op") == ADD).select(F.col("of").alias(BATCH)).distinct()


def added(spark, path, schema, parts):
    """The rows of some parts of a table, with the day."""
    stored = T.StructType([*by_day(schema).fields, T.StructField(BATCH, T.StringType())])
    folders = [f"{path}_added/{BATCH}={part['of']}/{DAY}={part[DAY]}" for part in parts]
    rows = spark.read.schema(stored).option("basePath", f"{path}_added").parquet(*folders)
    return rows.drop(BATCH)


def summed(counts):
    """Counts of equal keys added up."""
    keys = [c for c in counts.columns if c != "num_ratings"]
    rows = counts.groupBy(*keys).agg(F.sum("num_ratings").alias("num_ratings"))
    return rows.select(counts.columns)


def read_table(spark, path, schema, first=None, last=None):
    """A whole stored table; ``first`` and ``last`` only spare the listing of other days' parts."""
    stored = spark.read.schema(by_day(schema)).parquet(path)
    parts = live_parts(spark, path, first, last)
    if not parts:
        return stored
    everything = stored.unionByName(added(spark, path, schema, parts))
    return summed(everything) if schema in STATS.values() else everything


def read_day(spark, path, day, schema=RATINGS):
    """One day of a stored table, without the partition column."""
    return read_table(spark, path, schema, day, day).where(F.col(DAY) == F.lit(day).cast("date")).drop(DAY)


def read_days(spark, path, first, last, schema=RATINGS):
    """The days from ``first`` to ``last`` of a stored table, with the partition column."""
    day = F.col(DAY)
    return read_table(spark, path, schema, first, last).where(
        (day >= F.lit(first).cast("date")) & (day <= F.lit(last).cast("date"))
    )


def read_stats(spark, path, table, day):
    """One day of a count table."""
    return read_day(spark, path, day, STATS[table])
