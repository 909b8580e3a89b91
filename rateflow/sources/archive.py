"""Saved pages as numbered text files."""

from pyspark.sql import functions as F

from rateflow.operators.extract import extract_paired
from rateflow.schema import AGENCY_PAIRS

# The numbers of the archive's files.
FIRST_FILE, LAST_FILE = 2, 15
FILE_NUMBER = r"(?:^|/)([0-9]+)\.txt$"


def read_archive(spark, path, first=FIRST_FILE, last=LAST_FILE, number=FILE_NUMBER):
    """One page per ``<n>.txt`` file with ``first <= n <= last``, ``n`` as the page id.

    ``number`` finds ``n`` in the file path: an archive that Spark wrote by partition has it
    in the folder name. The range is tested on the file listing, before a file is opened.
    """
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt", recursiveFileLookup=True)
    place = F.regexp_extract(F.col("_metadata.file_path"), number, 1).try_cast("bigint")
    return files.where(place.between(first, last)).select(
        F.lit(AGENCY_PAIRS).alias("source"), place.alias("page_id"), F.col("value").alias("html")
    )


def extract_archive(spark, path, first=FIRST_FILE, last=LAST_FILE, number=FILE_NUMBER):
    """Rows of all archive pages in one job."""
    return extract_paired(read_archive(spark, path, first, last, number))
