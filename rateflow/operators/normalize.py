"""From extracted text rows to the ratings table."""

from functools import reduce

from pyspark.sql import functions as F

from rateflow.functions.dates import dots_to_dashes, parse_day
from rateflow.functions.text import split_parts
from rateflow.schema import ABSENT, RATINGS, REJECTS


def composite(df, column):
    """Split ``rating[, observation][, outlook], date`` text into its columns.

    Two to four parts are read; any other number leaves them null and names the number in
    ``part_fault``. The parts pass through a generator of one row, so that a filter on them
    does not take a copy of the splitting along.
    """
    split = F.struct(split_parts(F.col(column)).alias("parts"))
    parts = df.select("*", F.inline(F.array(split)))
    known = F.size("parts").isin(2, 3, 4)

    def part(index):
        return F.when(known, F.try_element_at("parts", F.lit(index)))

    return parts.select(
        *df.columns,
        part(1).alias("rating"),
        F.when(F.size("parts") == 2, ABSENT).otherwise(part(-2)).alias("pred"),
        part(-1).alias("rat_date"),
        F.when(F.size("parts") == 4, part(2)).when(known, ABSENT).alias("observation"),
        F.when(~known, F.concat(F.lit("parts: "), F.size("parts").cast("string"))).alias("part_fault"),
    )


def normalize(rows, strict=False):
    """Turn the date text of extracted rows into a date.

    Strict: any row with a fault fails the job. Otherwise the row keeps its ``reason`` and
    goes to the rejects.
    """
    dated = rows.withColumn("day", parse_day(dots_to_dashes(F.col("rat_date"))))
    unread = F.col("reason").isNull() & F.col("day").isNull()
    fault = F.when(unread, F.concat(F.lit("unreadable date: "), F.coalesce("rat_date", F.lit("none"))))
    dated = dated.select(
        *[c for c in rows.columns if c not in ("rat_date", "reason", "raw")],
        F.col("day").alias("rat_date"),
        F.coalesce("reason", fault).alias("reason"),
        F.coalesce("raw", F.when(unread, F.concat_ws(" | ", "name", "rating", "pred", "rat_date"))).alias("raw"),
    )
    if not strict:
        return dated
    # A filter, because an unused column that raises would be pruned away.
    sound = F.when(F.col("reason").isNotNull(), F.raise_error(F.col("reason")).cast("boolean"))
    return dated.where(sound.otherwise(F.lit(True)))


def accepted(rows):
    """The ratings among normalised rows."""
    return enforce_schema(rows.where(F.col("reason").isNull()))


def rejected(rows):
    """The rows that could not be read, with the reason."""
    return rows.where(F.col("reason").isNotNull()).select(*REJECTS.fieldNames())


def enforce_schema(df, *extra):
    """The six rating columns in order and type, then any ``extra`` columns as they are."""
    columns = ((field.name, field.dataType.simpleString()) for field in RATINGS)
    return df.selectExpr(*[f"cast({name} as {kind}) as {name}" for name, kind in columns], *extra)


def union_feeds(*feeds):
    """All rows of all feeds, columns matched by name, duplicates kept."""
    return reduce(lambda left, right: left.unionByName(right), feeds)
