"""Order inside groups of any size.

A window brings a whole group to one task. Here the rows are range-partitioned by group and
order instead, so a hot group spreads over as many partitions ("slots") as its size needs,
and what crosses a slot's border is carried by a table of one row per group and slot.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from rateflow.operators.joins import broadcast_if_small
from rateflow.session import stage


SLOT_BYTES = 64 * 1024 * 1024


def slots_for(stored, target=SLOT_BYTES):
    """Partitions for a stored table, by the size of its files: a hot group is spread over as
    many as it needs, whatever ``spark.sql.shuffle.partitions`` says."""
    size = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-size // target))


def _slotted(df, group, order):
    """``df`` sorted, with each row's ``_slot`` and its increasing position ``_at``.

    The sorted rows are written to the shared folder: what is read from them more than once
    then agrees on the borders.
    """
    df = stage(df, "unsorted")
    placed = (
        df.repartitionByRange(slots_for(df), *group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumn("_slot", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id())
    )
    return stage(placed, "sorted")


def _joined(placed, spans, group):
    """Rows with the columns of their group's slot; null group keys match each other."""
    keys = [*group, "_slot"]
    others = [c for c in spans.columns if c not in keys]
    spans = broadcast_if_small(spans.select(*[F.col(c).alias(f"_of_{c}") for c in keys], *others))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys]
    return placed.join(spans, same).drop(*[f"_of_{c}" for c in keys])


def numbered(df, group, order, name="item_no"):
    """Add the 1-based place of each row in its group; ``order`` must be unique in it."""
    placed = _slotted(df, group, order)
    spans = placed.groupBy(*group, "_slot").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = Window.partitionBy(*group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    shifts = spans.select(*group, "_slot", (before - F.col("_first") + 1).alias("_shift"))
    place = (F.col("_at") + F.col("_shift")).alias(name)
    return _joined(placed, shifts, group).select(*df.columns, place)


def preceded(df, group, order, column, previous="previous", opens="opens"):
    """Add ``column`` of the row before in the group, and whether there is none before.

    Inside a slot that is a window; the first row of a slot takes it from the slot before.
    """
    placed = _slotted(df, group, order)
    spans = placed.groupBy(*group, "_slot").agg(F.max_by(column, "_at").alias("_last"))
    slots = Window.partitionBy(*group).orderBy("_slot")
    borders = spans.select(
        *group,
        "_slot",
        F.lag("_last").over(slots).alias("_border"),
        (F.row_number().over(slots) == 1).alias("_start"),
    )
    inside = Window.partitionBy(*group, "_slot").orderBy("_at")
    rows = placed.withColumn("_nth", F.row_number().over(inside)).withColumn(
        "_lag", F.lag(column).over(inside)
    )
    first = F.col("_nth") == 1
    return _joined(rows, borders, group).select(
        *df.columns,
        F.when(first, F.col("_border")).otherwise(F.col("_lag")).alias(previous),
        (first & F.col("_start")).alias(opens),
    )
