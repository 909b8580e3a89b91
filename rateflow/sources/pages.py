"""Stored listing pages."""

from pyspark.sql import types as T

from rateflow.schema import ARRIVED, PAGES


def read_pages(spark, path, by_arrival=False):
    """Pages in Parquet; with ``by_arrival`` stored by the day they came, which prunes the scan."""
    schema = T.StructType([*PAGES.fields, T.StructField(ARRIVED, T.DateType())]) if by_arrival else PAGES
    return spark.read.schema(schema).parquet(path)
