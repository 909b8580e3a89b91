"""What a job has done, so that a run after a crash goes on where the last one ended."""

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rateflow.session import exists, mark, remove


def fingerprint(df):
    """A digest of what ``df`` reads: its files with their sizes and times, or else its rows."""
    try:
        files = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        rows = files.distinct()
    except AnalysisException:
        rows = df
    state = rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first()
    return [str(value) for value in state]


class Record:
    """The steps of one job that are done, kept in the store under the job's inputs.

    A run with the same inputs passes over them; a run that ends well leaves no record, so the
    next one does everything again.
    """

    def __init__(self, spark, store, job, inputs):
        key = hashlib.sha256(json.dumps(inputs, default=str, sort_keys=True).encode()).hexdigest()[:16]
        self.spark, self.folder = spark, f"{store.root}/runs/{job}-{key}"

    def step(self, name, work):
        """Do ``work`` unless it is done; it may be done twice, but is never passed over undone."""
        if not exists(self.spark, f"{self.folder}/{name}"):
            work()
            mark(self.spark, f"{self.folder}/{name}")

    def close(self):
        remove(self.spark, self.folder)


class NoRecord:
    """Every step is done."""

    def step(self, name, work):
        work()

    def close(self):
        pass


def record_of(spark, store, job, pages, inputs, resume):
    """The record of a job that is to be resumed; reading the inputs' state costs a pass over their files."""
    if not resume:
        return NoRecord()
    return Record(spark, store, job, [*inputs, fingerprint(pages)])
