"""Uploads in two phases: tasks fill a staging table, one commit moves it in.

Spark's Python data source interface gives the two phases: every task writes its rows to the
staging table under the name of its attempt, and the one commit on the driver takes the rows
of just those attempts that Spark counts. A ledger beside the table has the days that are in
it. Moving the rows and noting their days is one transaction, so a task that dies half-way, a
second attempt of a task, a commit that is lost and a run that is repeated leave every row once.
"""

import sys
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import TaskContext, cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from rateflow.schema import DAY

CONNECTIONS, BATCH_ROWS = 8, 10_000
LOAD_DAY, PART, ATTEMPT = "load_day", "load_part", "load_attempt"

# Writers are sent to workers by value, so these need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Written(WriterCommitMessage):
    """What one attempt of a task has put into the staging table."""

    part: int
    attempt: str
    rows: int


@dataclass(frozen=True)
class DatabaseTable:
    """A table of a database, reached by ``connect``, a function that workers can call and that
    returns a DB-API connection. ``columns`` are the names and types as declared; ``mark`` is
    the driver's parameter mark."""

    connect: Callable
    table: str
    columns: str
    mark: str = "?"

    @property
    def names(self):
        """Names of ``columns``; a comma inside brackets belongs to a type."""
        depth, parts = 0, [""]
        for c in self.columns:
            depth += (c == "(") - (c == ")")
            if c == "," and not depth:
                parts.append("")
            else:
                parts[-1] += c
        return [p.split()[0] for p in parts]

    @property
    def ledger(self):
        return f"{self.table}_loads"

    def staging(self, run):
        return f"{self.table}_load_{run}"

    def _do(self, *statements):
        """Runs statements in one transaction."""
        connection = self.connect()
        try:
            cursor = connection.cursor()
            for statement in statements:
                cursor.execute(statement)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    def begin(self, run):
        """Makes an empty staging table; what an earlier run of this name has left goes."""
        self._do(f"DROP TABLE IF EXISTS {self.staging(run)}")
        self._do(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({self.columns})",
            f"CREATE TABLE IF NOT EXISTS {self.ledger} ({LOAD_DAY} DATE PRIMARY KEY, num_rows BIGINT)",
            f"CREATE TABLE {self.staging(run)} ({self.columns}, {LOAD_DAY} DATE, {PART} INT, {ATTEMPT} VARCHAR(64))",
        )

    def write(self, run, part, attempt, rows):
        """Puts an attempt's ``rows``, tuples of the columns and the day, into the staging table."""
        names = [*self.names, LOAD_DAY, PART, ATTEMPT]
        marks = ", ".join([self.mark] * len(names))
        insert = f"INSERT INTO {self.staging(run)} ({', '.join(names)}) VALUES ({marks})"
        connection, written, held = self.connect(), 0, []
        try:
            cursor = connection.cursor()
            for row in rows:
                held.append((*row, part, attempt))
                if len(held) == BATCH_ROWS:
                    cursor.executemany(insert, held)
                    written, held = written + len(held), []
            if held:
                cursor.executemany(insert, held)
            connection.commit()
            return written + len(held)
        finally:
            connection.close()

    def publish(self, run, written):
        """Moves the rows of the attempts ``written`` in, but for days that the ledger has."""
        if written:
            counted = " OR ".join(f"({PART} = {w.part} AND {ATTEMPT} = '{w.attempt}')" for w in written)
            new = f"({counted}) AND {LOAD_DAY} NOT IN (SELECT {LOAD_DAY} FROM {self.ledger})"
            names, staged = ", ".join(self.names), self.staging(run)
            self._do(
                f"INSERT INTO {self.table} ({names}) SELECT {names} FROM {staged} WHERE {new}",
                f"INSERT INTO {self.ledger} ({LOAD_DAY}, num_rows) "
                f"SELECT {LOAD_DAY}, COUNT(*) FROM {staged} WHERE {new} GROUP BY {LOAD_DAY}",
            )
        self.discard(run)

    def discard(self, run):
        self._do(f"DROP TABLE IF EXISTS {self.staging(run)}")


class Upload(DataSourceArrowWriter):
    """The two phases of one run into ``target``."""

    def __init__(self, target, run):
        self.target, self.run = target, run
        # Attempts are counted by application; a task of one that is gone must not look like ours.
        self.nonce = uuid.uuid4().hex[:16]

    def write(self, iterator):
        task = TaskContext.get()
        return self.write_attempt(iterator, task.partitionId(), task.taskAttemptId())

    def write_attempt(self, batches, part, number):
        attempt = f"{self.nonce}-{number}"
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        return Written(part, attempt, self.target.write(self.run, part, attempt, rows))

    def commit(self, messages):
        self.target.publish(self.run, [m for m in messages if m is not None and m.rows])

    def abort(self, messages):
        self.target.discard(self.run)


def run_name(first, last):
    """One name for every run of the same days, so that a repeat clears what a dead one left."""
    return f"{first}_{last}".replace("-", "")


def upload(rows, target, first, last, connections=CONNECTIONS):
    """Bring ``rows``, which carry their day, into ``target``; each day once, however often it runs.

    ``target`` has ``begin``, ``write``, ``publish`` and ``discard`` as ``DatabaseTable`` has
    them. At most ``connections`` tasks write at once.
    """
    spark, run = rows.sparkSession, run_name(first, last)
    writer, label = Upload(target, run), f"upload_{uuid.uuid4().hex}"

    class Source(DataSource):
        @classmethod
        def name(cls):
            return label

        def writer(self, schema, overwrite):
            return writer

    target.begin(run)
    spark.dataSource.register(Source)
    rows = rows.select(*[c for c in rows.columns if c != DAY], F.col(DAY).alias(LOAD_DAY))
    rows.coalesce(connections).write.format(label).mode("append").save()
