"""Rows told apart where their doc_id does not."""

from pyspark.sql import functions as F

from rateflow.operators.joins import broadcast_if_small
from rateflow.session import stage


def unused(columns, name):
    """``name``, lengthened until no column begins with it."""
    while any(c.startswith(name) for c in columns):
        name += "_"
    return name


def rows_with_ids(documents):
    """``documents`` with a doc_id for each row, the name of the column with the given one, and a list.

    Rows that share their doc_id or have none get new ones below all others; the list has these
    ``doc_id`` with ``own_id``, the given one. It is None where every row has its own doc_id.
    """
    own = unused(documents.columns, "own_id")
    ids = documents.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null")
    ids = stage(ids.select(F.col("doc_id").alias("shared_id")), "ids")
    if ids.isEmpty():
        return documents.withColumn(own, F.col("doc_id")), own, None
    ids = broadcast_if_small(ids)
    same = F.col("doc_id").eqNullSafe(F.col("shared_id"))
    least = documents.agg(F.min("doc_id")).first()[0] or 0
    alike = documents.join(ids, same, "left_semi").withColumn(own, F.col("doc_id"))
    alike = alike.withColumn("doc_id", F.lit(least - 1).cast("long") - F.monotonically_increasing_id())
    # Staged, so that a row has the same number whenever it is read.
    alike = stage(alike, "alike")
    rest = documents.join(ids, same, "left_anti").withColumn(own, F.col("doc_id"))
    return rest.unionByName(alike), own, alike.select("doc_id", F.col(own).alias("own_id"))
