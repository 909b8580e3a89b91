"""Session settings and the shared working folder."""

import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import SparkSession

# AQE sizes shuffle partitions at run time, so one setting serves a laptop and a cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def build_session(name="rateflow", master=None, **settings):
    """A session with the library's settings; ``settings`` wins over them."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark):
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A session without the setting uses a folder below its warehouse, which its executors share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getCheckpointDir()
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    return named.rstrip("/")


_working = ContextVar("working", default=None)


def fresh_dir(spark, label):
    """A path in the shared folder, or in the running job's part of it, that nothing has used yet."""
    return f"{_working.get() or f'{shared_dir(spark)}/rateflow'}/{label}-{uuid.uuid4().hex}"


def _files(spark, path):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark, path):
    files, path = _files(spark, path)
    return files.exists(path)


def mark(spark, path):
    """Make an empty file."""
    files, path = _files(spark, path)
    files.create(path, True).close()


def remove(spark, path):
    """Remove a file or folder, if it is there."""
    files, path = _files(spark, path)
    files.delete(path, True)


@contextmanager
def working(spark):
    """What is staged inside lies in one folder, which goes at the end, however it ends."""
    folder = f"{shared_dir(spark)}/rateflow/job-{uuid.uuid4().hex}"
    token = _working.set(folder)
    try:
        yield
    finally:
        _working.reset(token)
        remove(spark, folder)


def cleaned(job):
    """What the job stages is removed when it ends, so its result must not read it.

    Inside another such job that is left to the outer one.
    """

    @wraps(job)
    def run(spark, *args, **kwargs):
        if _working.get():
            return job(spark, *args, **kwargs)
        with working(spark):
            return job(spark, *args, **kwargs)

    return run


def stage(df, label):
    """Write ``df`` to the shared folder and return the table read back.

    Everything planned on the result starts from those files, so a lost executor costs a
    re-read and never a second run of what came before.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
