"""Lookups by date and by part of a name, one at a time or as a table of requests."""

from pyspark.sql import functions as F

from rateflow.functions.messages import ANSWER_HEADER, ANSWER_NONE, lookup_item
from rateflow.operators.joins import broadcast_if_small
from rateflow.operators.name_index import indexed_names
from rateflow.operators.ordering import numbered
from rateflow.schema import RATING_COLUMNS, REQUESTS
from rateflow.session import stage

_DATE_TEXT = r"^\s*[0-9]{4}-[0-9]{1,2}(-[0-9]{1,2})?\s*$"
_GRAM = 3
ITEMS_PER_PART = 50


def find_by_date(ratings, text):
    """Announcements of the day typed as ``text``; none when it is no date."""
    return ratings.where(F.col("rat_date") == F.lit(text).try_cast("date"))


def find_by_name(ratings, text, wildcards=False):
    """Announcements whose name holds ``text``, whatever the case.

    ``wildcards`` leaves ``%``, ``_`` and ``\\`` their LIKE meaning.
    """
    name, needle = F.lower(F.col("name")), F.lower(F.lit(text))
    if wildcards:
        return ratings.where(F.like(name, F.concat(F.lit("%"), needle, F.lit("%"))))
    return ratings.where(F.contains(name, needle))


def route(text):
    """``date`` for text written like a date, ``name`` for other text, null for none."""
    return F.when(text.rlike(_DATE_TEXT), "date").when(text != "", "name")


def _grams(text, size):
    """Distinct substrings of ``size`` characters; a shorter text yields none."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    pieces = F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size))))
    return F.when(F.length(text) >= size, pieces)


def names_holding(names, needles):
    """Pairs of a needle and a name whose lower-cased form contains it.

    ``names`` has ``name``, ``needles`` has lower-cased non-empty ``needle``; both distinct.
    Instead of trying every needle on every name, each needle is represented by the one of
    its three-character pieces that the fewest names share, and joined on equality with the
    pieces of the names; the few candidates are then checked in full. A needle shorter than
    that is its own piece.
    """
    size = F.least(F.length("needle"), F.lit(_GRAM))
    lengths = [r[0] for r in needles.select(size.alias("size")).distinct().collect()]
    low = F.lower(F.col("name"))
    empty = F.array().cast("array<string>")
    pieces = F.concat(empty, *[F.coalesce(_grams(low, n), empty) for n in sorted(lengths)])
    spread = names.select("name", F.explode(pieces).alias("gram"))

    of_needle = needles.select(
        "needle", F.explode(F.array_distinct(_grams(F.col("needle"), size))).alias("gram")
    )
    wanted = broadcast_if_small(of_needle.select("gram").distinct())
    shared = stage(
        spread.join(wanted, "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("names")),
        "shared",
    )
    # The inner join drops a piece that no name has; a needle with one cannot match.
    weighed = of_needle.join(broadcast_if_small(shared), "gram", "left")
    chosen = (
        weighed.groupBy("needle")
        .agg(
            F.min_by("gram", F.struct(F.coalesce("names", F.lit(0)), "gram")).alias("gram"),
            F.min(F.coalesce("names", F.lit(0))).alias("names"),
        )
        .where(F.col("names") > 0)
        .select("needle", "gram")
    )
    return (
        spread.join(broadcast_if_small(chosen), "gram")
        .where(F.contains(low, F.col("needle")))
        .select("needle", "name")
    )


def _matches(ratings, keys, index):
    """Ratings found by each (route, key); names through the index at the path, if there is one."""
    days = keys.where(F.col("route") == "date").select(
        "route", "key", F.col("key").cast("date").alias("rat_date")
    )
    by_date = ratings.join(broadcast_if_small(days), "rat_date")
    needles = keys.where(F.col("route") == "name").select(F.col("key").alias("needle"))
    if index:
        pairs = indexed_names(ratings.sparkSession, index, needles)
    else:
        names = stage(ratings.select("name").where(F.col("name").isNotNull()).distinct(), "names")
        pairs = names_holding(names, needles)
    pairs = stage(pairs, "pairs")
    by_name = ratings.join(broadcast_if_small(pairs), "name").select(
        *ratings.columns, F.lit("name").alias("route"), F.col("needle").alias("key")
    )
    return by_date.unionByName(by_name)


def answers(ratings, requests, items_per_part=ITEMS_PER_PART, index=None):
    """The answer to every request, in parts: columns req_id, part, text.

    The parts of a request, joined in order, are its whole message; a message of up to
    ``items_per_part`` ratings is one part. No part holds more, so a request that matches
    a third of all rows is many rows and never one text. Ratings are listed by date, agency
    and name. A request without text gets no answer. ``index`` is the path of an index that
    has the names of the ratings; without one they are cut into pieces for these requests.
    """
    kind = route(F.col("text"))
    day = F.trim("text").try_cast("date").cast("string")
    asked = requests.select(
        "req_id",
        kind.alias("route"),
        F.when(kind == "date", day).otherwise(F.lower("text")).alias("key"),
    ).where(F.col("route").isNotNull())
    keys = stage(asked.select("route", "key").where(F.col("key").isNotNull()).distinct(), "keys")
    # Equal announcements need an order too: their place in the scan keeps them apart.
    placed = ratings.select(*RATING_COLUMNS, F.monotonically_increasing_id().alias("place"))
    found = numbered(
        _matches(placed, keys, index),
        ["route", "key"],
        ["rat_date", "agency", "name", "rating", "pred", "observation", "place"],
    )
    part = F.floor((F.col("item_no") - 1) / items_per_part).cast("bigint")
    parts = (
        found.select("route", "key", part.alias("part"), "item_no", lookup_item().alias("item"))
        .groupBy("route", "key", "part")
        .agg(F.expr("listagg(item, '') within group (order by item_no)").alias("items"))
    )
    opening = F.when(F.col("part") == 0, ANSWER_HEADER).otherwise("")
    return asked.join(parts, ["route", "key"], "left").select(
        "req_id",
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce(F.concat(opening, F.col("items")), F.lit(ANSWER_NONE)).alias("text"),
    )


def answer(ratings, text, items_per_part=ITEMS_PER_PART, index=None):
    """The answer to one text, in parts: columns part, text."""
    requests = ratings.sparkSession.createDataFrame([(0, text)], REQUESTS)
    return answers(ratings, requests, items_per_part, index).drop("req_id")
