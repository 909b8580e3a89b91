"""Tables in a database."""

import datetime as dt


def read_jdbc(spark, url, table, properties=None, split=None):
    """A database table.

    Unsplit, Spark reads it over one connection. ``split`` is (column, lower, upper, number):
    that many connections read ranges of a date, time or number column; rows outside the
    bounds and nulls are still read, by the outermost ranges.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {}))
    if split:
        column, lower, upper, number = split
        reader = reader.options(
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(number),
        )
    return reader.load()


def _as_date(day):
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day))


def day_predicates(column, days, parts):
    """Conditions that share out ``days`` in order, one for each of at most ``parts`` connections.

    Days that follow each other are one range, others are listed; together the conditions
    hold on just these days.
    """
    days = sorted({_as_date(day) for day in days})
    size = max(1, -(-len(days) // parts))
    out = []
    for own in (days[at : at + size] for at in range(0, len(days), size)):
        if (own[-1] - own[0]).days == len(own) - 1:
            out.append(f"{column} BETWEEN DATE '{own[0]}' AND DATE '{own[-1]}'")
        else:
            out.append(f"{column} IN ({', '.join(f"DATE '{day}'" for day in own)})")
    return out


def read_jdbc_days(spark, url, table, column, days, properties=None, connections=8):
    """The rows of some days of a database table, read over as many connections; others stay there."""
    predicates = day_predicates(column, days, connections)
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})


def grouped_days(table, column, days):
    """What counts a table's rows by day in the database, as a derived table ``day, present``."""
    days = sorted(_as_date(day) for day in days)
    within = f"WHERE {column} BETWEEN DATE '{days[0]}' AND DATE '{days[-1]}'"
    return f"(SELECT {column} AS load_date, COUNT(*) AS present FROM {table} {within} GROUP BY {column}) counted"


def count_jdbc_days(spark, url, table, column, days, properties=None, connections=8):
    """``load_date, present``: how many rows a database table has of each of ``days``.

    The database counts; a day comes back as one row.
    """
    return read_jdbc_days(spark, url, grouped_days(table, column, days), "load_date", days, properties, connections)
