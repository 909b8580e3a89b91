"""New records only, from page files as they arrive."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rateflow.operators.counts import base_counts, roll_up
from rateflow.operators.digest import digest
from rateflow.operators.extract import extract
from rateflow.operators.normalize import accepted, normalize, rejected
from rateflow.schema import AGENCY_TABLE, DAY, OUTBOX, PAGES, REJECTS
from rateflow.session import stage, working
from rateflow.sinks.added import add_batch, begin_tables, is_committed, merge_added, new_records, of_days
from rateflow.sinks.store import write_days
from rateflow.sources.store import BATCH, committed


def read_news(spark, path, schema=OUTBOX):
    """Messages or rejects of committed micro-batches, each with its batch."""
    days = [T.StructField(DAY, T.DateType())] if schema is OUTBOX else []
    stored = T.StructType([*schema.fields, *days, T.StructField(BATCH, T.StringType())])
    return spark.read.schema(stored).parquet(path).join(committed(spark, path), BATCH, "left_semi")


def arriving_pages(spark, path, files_per_batch=None):
    """Page files in Parquet as a stream."""
    reader = spark.readStream.schema(PAGES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def take_batch(pages, batch_id, store, shapes=None):
    """One micro-batch: extract, tell and add what is new.

    New ratings, their counts, messages and rejects are written under the batch's name and
    seen from its one commit on. Days are not written again, whatever they hold. A batch that
    is repeated after its commit changes nothing; before it, it replaces what it had left.
    """
    spark = pages.sparkSession
    name = batch_key(spark, batch_id)
    if not is_committed(spark, store, name):
        with working(spark):
            _take(spark, pages, name, store, shapes)


def _take(spark, pages, name, store, shapes):
    batch = F.lit(name).alias(BATCH)
    rows = stage(normalize(extract(pages, shapes)), "rows")
    write_days(rejected(rows).select(*REJECTS.fieldNames(), batch), store.arrived_rejects, BATCH)
    found = accepted(rows).withColumn(DAY, F.col("rat_date"))
    days = stage(found.select(DAY).distinct(), "days")
    begin_tables(spark, store)
    fresh = stage(new_records(found, of_days(spark, store.ratings, days)), "fresh")
    counts = roll_up(base_counts(fresh, DAY), AGENCY_TABLE, DAY)
    news = digest(fresh, counts, fresh.select(DAY).distinct())
    write_days(news.select(*OUTBOX.fieldNames(), DAY, batch), store.news, BATCH)
    add_batch(fresh, store, name)


def batch_key(spark, batch_id):
    """Names a batch by its query and number: a new or lost checkpoint begins another query,
    whose batches replace nothing of an earlier one."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
    return f"{query}-{batch_id}"


def run_arrived(spark, pages, store, checkpoint, shapes=None):
    """Process everything that has arrived, then stop. Run it again for later arrivals.

    At the end what many small batches have added to a day is merged.
    """
    query = (
        pages.writeStream.foreachBatch(lambda df, batch_id: take_batch(df, batch_id, store, shapes))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    merge_added(spark, store)
