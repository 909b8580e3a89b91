"""A stored index of the pieces of names, so that a lookup reads only what it needs.

Each distinct name is cut once, when it first comes, into its pieces of one to three
characters. The postings are stored by a hash bucket of the piece; a table of requests opens
the buckets of its own pieces and no others.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rateflow.operators.joins import broadcast_if_small
from rateflow.session import stage

PIECE = 3
BUCKETS = 64
NAMES = T.StructType([T.StructField("name", T.StringType())])
POSTINGS = T.StructType(
    [
        T.StructField("gram", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)


def pieces(text, size):
    """Distinct substrings of ``size`` characters; a shorter text yields none."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    found = F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size))))
    return F.when(F.length(text) >= size, found)


def _bucket(gram):
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int").alias("bucket")


def _read(spark, path, schema):
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def extend_index(spark, path, names):
    """Add the names that the index at ``path`` does not have; returns how many these are.

    Postings come first and the list of names last: what a run that died in between has left
    is written again, and lookups take equal postings once.
    """
    known = _read(spark, f"{path}/names", NAMES)
    names = names.select("name").where(F.col("name").isNotNull()).distinct()
    new = stage(names.join(known, "name", "left_anti"), "names")
    low = F.lower(F.col("name"))
    empty = F.array().cast("array<string>")
    grams = F.concat(empty, *[F.coalesce(pieces(low, n), empty) for n in range(1, PIECE + 1)])
    postings = new.select(F.explode(grams).alias("gram"), "name").select("gram", "name", _bucket(F.col("gram")))
    postings.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(f"{path}/postings")
    new.write.mode("append").parquet(f"{path}/names")
    return new.count()


def postings_of(spark, path, grams):
    """Postings in the buckets of ``grams``; their numbers, BUCKETS at most, prune the scan."""
    buckets = [b for (b,) in grams.select(_bucket(F.col("gram"))).distinct().collect()]
    return _read(spark, f"{path}/postings", POSTINGS).where(F.col("bucket").isin(buckets))


def indexed_names(spark, path, needles):
    """Pairs of a lower-cased ``needle`` and an indexed name that holds it.

    A needle is looked up by its piece with the fewest names, and these are checked in full.
    """
    size = F.least(F.length("needle"), F.lit(PIECE))
    of_needle = needles.select("needle", F.explode(pieces(F.col("needle"), size)).alias("gram"))
    of_needle = stage(of_needle.where(F.col("gram") != ""), "pieces")
    wanted = of_needle.select("gram").distinct()
    held = postings_of(spark, path, wanted).join(broadcast_if_small(wanted), "gram", "left_semi")
    shared = stage(held.groupBy("gram").agg(F.count(F.lit(1)).alias("names")), "shared")
    # A needle with a piece that no name has matches none, and its piece finds none.
    weighed = of_needle.join(broadcast_if_small(shared), "gram", "left")
    rarest = F.min_by("gram", F.struct(F.coalesce("names", F.lit(0)), "gram")).alias("gram")
    chosen = stage(weighed.groupBy("needle").agg(rarest), "chosen")
    found = postings_of(spark, path, chosen).join(broadcast_if_small(chosen), "gram")
    return found.where(F.contains(F.lower(F.col("name")), F.col("needle"))).select("needle", "name").distinct()
