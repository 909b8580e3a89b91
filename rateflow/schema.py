"""Table schemas and fixed values shared by every module."""

from pyspark.sql import types as T

# Names, separators and widths that stored tables must keep as they are.
ABSENT = "-"
TEXT_WIDTH = 128
AGENCY_PAIRS = "Эксперт РА"
AGENCY_GRID = "НКР"
AGENCY_CARDS = "НРА"
RATINGS_TABLE = "credit_ratings"
AGENCY_TABLE = "agencies_stats"
AGENCY_RATING_TABLE = "agencies_stats_full"
DATE_TABLE = "ratings_date_stats"
RATINGS_JDBC_TYPES = (
    "name VARCHAR(128), rating VARCHAR(128), pred VARCHAR(128), rat_date DATE, "
    "observation VARCHAR(128), agency VARCHAR(128)"
)
AGENCY_JDBC_TYPES = "agency VARCHAR(128), num_ratings INT, record_date DATE"
AGENCY_RATING_JDBC_TYPES = (
    "agency VARCHAR(128), rating VARCHAR(128), num_ratings INT, record_date DATE"
)
DATE_JDBC_TYPES = "rat_date DATE, num_ratings BIGINT, record_date DATE"

DAY = "DT"
ARRIVED = "arrived"

PAGES = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("html", T.StringType()),
    ]
)

RATINGS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("rating", T.StringType()),
        T.StructField("pred", T.StringType()),
        T.StructField("rat_date", T.DateType()),
        T.StructField("observation", T.StringType()),
        T.StructField("agency", T.StringType()),
    ]
)

# What an extractor yields: one row per listing entry, the date still as text.
# ``reason`` is null for a usable row and says what is wrong otherwise.
EXTRACTED = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("row", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("rating", T.StringType()),
        T.StructField("pred", T.StringType()),
        T.StructField("rat_date", T.StringType()),
        T.StructField("observation", T.StringType()),
        T.StructField("agency", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)

REJECTS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("row", T.IntegerType()),
        T.StructField("reason", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)

STANDING = T.StructType(
    [
        T.StructField("agency", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("rating", T.StringType()),
    ]
)

CHANGES = T.StructType(
    [
        *RATINGS.fields,
        T.StructField("copies", T.LongType()),
        T.StructField("previous", T.StringType()),
        T.StructField("event", T.StringType()),
    ]
)

AGENCY_STATS = T.StructType(
    [
        T.StructField("agency", T.StringType()),
        T.StructField("num_ratings", T.LongType()),
    ]
)

AGENCY_RATING_STATS = T.StructType(
    [
        T.StructField("agency", T.StringType()),
        T.StructField("rating", T.StringType()),
        T.StructField("num_ratings", T.LongType()),
    ]
)

DATE_STATS = T.StructType(
    [
        T.StructField("rat_date", T.DateType()),
        T.StructField("num_ratings", T.LongType()),
    ]
)

STATS = {
    AGENCY_TABLE: AGENCY_STATS,
    AGENCY_RATING_TABLE: AGENCY_RATING_STATS,
    DATE_TABLE: DATE_STATS,
}

OUTBOX = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

REQUESTS = T.StructType(
    [
        T.StructField("req_id", T.LongType()),
        T.StructField("text", T.StringType()),
    ]
)

RATING_COLUMNS = RATINGS.fieldNames()


def by_day(schema):
    """The schema of a stored table: its columns and the day partition."""
    return T.StructType(list(schema.fields) + [T.StructField(DAY, T.DateType())])
