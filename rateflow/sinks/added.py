"""Adding to stored days without writing them again.

A batch writes its rows and their counts beside the tables and then makes one commit, which
shows all of them at once. What a batch writes depends on what it brings and not on the days
it adds to. Parts of like size are merged when there are FAN of them, so a row is written
again as often as the logarithm of what is added.

One writer at a time works on a store; readers need not wait.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rateflow.operators.counts import base_counts, roll_up
from rateflow.schema import DAY, RATING_COLUMNS, RATINGS, STATS, by_day
from rateflow.session import remove, stage
from rateflow.sources.store import ADD, BATCH, LOG, RETIRE, added, committed, live_parts, log_path, read_log, read_table, summed

FAN = 8


def is_committed(spark, store, batch):
    return not committed(spark, store.ratings).where(F.col(BATCH) == batch).isEmpty()


def _write(rows, path, batch):
    """Writes a batch's part of a table; one that was left without a commit is replaced."""
    rows.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(f"{path}_added/{BATCH}={batch}")


def _commit(spark, store, batch, rows):
    """One file, so that the commit is seen as a whole."""
    rows = rows.select(*[f.name for f in LOG.fields if f.name != BATCH])
    rows.coalesce(1).write.mode("overwrite").parquet(f"{log_path(store.ratings)}/{BATCH}={batch}")


def of_days(spark, path, days):
    """Stored ratings of the given days; their list prunes the scan at run time. It is bounded
    by the calendar, four-digit years making fewer than 3.7 million."""
    return read_table(spark, path, RATINGS).join(F.broadcast(days), DAY, "left_semi")


def new_records(ratings, stored):
    """Distinct announcements that are not stored yet; both have the day."""
    fresh = ratings.dropDuplicates([*RATING_COLUMNS, DAY])
    same = [fresh[c].eqNullSafe(stored[c]) for c in RATING_COLUMNS if c != "rat_date"]
    return fresh.join(stored, [fresh[DAY] == stored[DAY], *same], "left_anti")


def begin_tables(spark, store):
    """Gives tables without a folder one to be read from."""
    for path, schema in ((store.ratings, RATINGS), *((store.stats(t), s) for t, s in STATS.items())):
        try:
            spark.read.schema(by_day(schema)).parquet(path)
        except AnalysisException:
            empty = spark.createDataFrame([], by_day(schema))
            empty.write.mode("append").partitionBy(DAY).parquet(path)


def add_batch(ratings, store, batch):
    """Adds distinct new ratings, which carry their day, with the counts they make.

    ``batch`` names them; a batch that is committed is not added again.
    """
    spark = ratings.sparkSession
    if is_committed(spark, store, batch):
        return
    ratings = ratings.select(*RATINGS.fieldNames(), DAY)
    base = stage(base_counts(ratings, DAY), "base")
    _write(ratings, store.ratings, batch)
    for table in STATS:
        _write(roll_up(base, table, DAY), store.stats(table), batch)
    days = ratings.groupBy(DAY).agg(F.count(F.lit(1)).alias("n"))
    itself = spark.range(1).select(F.lit(None).cast("date").alias(DAY), F.lit(0).cast("long").alias("n"))
    rows = days.unionByName(itself).select(F.lit(ADD).alias("op"), F.lit(batch).alias("of"), DAY, "n")
    _commit(spark, store, batch, rows)


def _retired(spark, parts):
    rows = [(RETIRE, part["of"], part[DAY], 0, "") for part in parts]
    return spark.createDataFrame(rows, LOG)


def retire_days(spark, store, first, last):
    """The days from ``first`` to ``last`` are about to be written whole: nothing is added to them any more."""
    parts = live_parts(spark, store.ratings, first, last)
    if parts:
        _commit(spark, store, f"replaced-{uuid.uuid4().hex}", _retired(spark, parts))


def _tier(n):
    tier = 0
    while n >= FAN:
        n, tier = n // FAN, tier + 1
    return tier


def _full(parts):
    """Parts of days that have FAN or more of like size."""
    groups = {}
    for part in parts:
        groups.setdefault((part[DAY], _tier(part["n"])), []).append(part)
    return [part for group in groups.values() if len(group) >= FAN for part in group]


def merge_added(spark, store):
    """Merges parts until no day has FAN of like size; returns how many were merged.

    The merged part and the retirement of what it holds are one commit.
    """
    merged = 0
    while full := _full(live_parts(spark, store.ratings)):
        batch = f"merged-{uuid.uuid4().hex}"
        _write(added(spark, store.ratings, RATINGS, full), store.ratings, batch)
        for table, schema in STATS.items():
            _write(summed(added(spark, store.stats(table), schema, full)), store.stats(table), batch)
        sizes = {}
        for part in full:
            sizes[part[DAY]] = sizes.get(part[DAY], 0) + part["n"]
        rows = [(ADD, batch, day, n, "") for day, n in sizes.items()]
        _commit(spark, store, batch, spark.createDataFrame(rows, LOG).unionByName(_retired(spark, full)))
        merged += len(full)
    return merged


def drop_retired(spark, store):
    """Removes the files of retired parts; for a time without readers that began before."""
    log = read_log(spark, store.ratings)
    for row in log.where(F.col("op") == RETIRE).select("of", DAY).distinct().collect():
        for path in (store.ratings, *(store.stats(table) for table in STATS)):
            remove(spark, f"{path}_added/{BATCH}={row['of']}/{DAY}={row[DAY]}")
