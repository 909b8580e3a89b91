"""Two-phase uploads, shown on files that stand in for a database."""

import datetime as dt
import json
import os
import sys
import threading
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from samples import ratings

from rateflow.schema import AGENCY_JDBC_TYPES, DAY, RATINGS_JDBC_TYPES
from rateflow.sinks.upload import DatabaseTable, Upload, Written, run_name, upload

# The stand-in goes to workers that do not have this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
DATES = [dt.date(2024, 1, n) for n in (15, 16, 17)]


@dataclass(frozen=True)
class Files:
    """A table as one file that is replaced as a whole, with staged rows in files of their own."""

    root: str
    dies: str = ""

    @property
    def table(self):
        return Path(self.root, "table.json")

    def staged(self, run):
        return Path(self.root, f"load_{run}")

    def begin(self, run):
        self.discard(run)
        self.staged(run).mkdir(parents=True)

    def write(self, run, part, attempt, rows):
        n = 0
        with open(self.staged(run) / f"{part}_{attempt}", "w") as out:
            for row in rows:
                if self.dies and n == 2 and not os.path.exists(self.dies):
                    Path(self.dies).touch()
                    raise OSError("the task died")
                out.write(json.dumps(row, default=str) + "\n")
                out.flush()
                n += 1
        return n

    def publish(self, run, written):
        days = self.days()
        for w in written:
            for line in (self.staged(run) / f"{w.part}_{w.attempt}").read_text().splitlines():
                *row, day = json.loads(line)
                if day not in self.days():
                    days.setdefault(day, []).append(row)
        new = self.table.with_suffix(".new")
        new.write_text(json.dumps(days))
        os.replace(new, self.table)
        self.discard(run)

    def discard(self, run):
        if self.staged(run).exists():
            for path in self.staged(run).iterdir():
                path.unlink()
            self.staged(run).rmdir()

    def days(self):
        return json.loads(self.table.read_text()) if self.table.exists() else {}

    def names(self):
        return sorted(row[0] for rows in self.days().values() for row in rows)


def dated(spark, n=30):
    rows = ratings(spark, *[(f"n{i:02}", "A", "-", DATES[i % 3]) for i in range(n)])
    return rows.withColumn(DAY, F.col("rat_date")).repartition(4)


ALL = [f"n{i:02}" for i in range(30)]


def test_rows_come_once_however_often_it_runs(spark, tmp_path):
    target = Files(str(tmp_path))
    for _ in range(2):
        upload(dated(spark), target, DATES[0], DATES[-1])
        assert target.names() == ALL
    assert not target.staged(run_name(DATES[0], DATES[-1])).exists()
    # A run of other days that overlaps, and one that reaches further.
    upload(dated(spark).where(F.col(DAY) == DATES[1]), target, DATES[1], DATES[1])
    late = ratings(spark, ("late",)).withColumn(DAY, F.lit(dt.date(2024, 1, 18)))
    upload(dated(spark).unionByName(late), target, DATES[0], dt.date(2024, 1, 18))
    assert target.names() == ["late", *ALL]


def test_a_day_counts_by_its_run_and_not_by_its_dates(spark, tmp_path):
    """One late row of an old date does not stand in the way of later runs."""
    target = Files(str(tmp_path))
    upload(dated(spark), target, DATES[0], DATES[-1])
    again = ratings(spark, ("old", "A", "-", DATES[0]), ("new", "A", "-", dt.date(2024, 1, 18)))
    upload(again.withColumn(DAY, F.lit(dt.date(2024, 1, 18))), target, "2024-01-18", "2024-01-18")
    assert target.names() == [*ALL, "new", "old"]


def test_a_task_that_dies_half_way_leaves_nothing(spark, tmp_path):
    target = Files(str(tmp_path), dies=str(tmp_path / "died"))
    with pytest.raises(Exception, match="the task died"):
        upload(dated(spark), target, DATES[0], DATES[-1])
    assert target.names() == []
    upload(dated(spark), target, DATES[0], DATES[-1])
    assert target.names() == ALL


def test_only_the_attempts_that_count_are_moved_in(tmp_path):
    """Two attempts of a task run beside each other, one more dies; Spark counts one of them."""
    target, run = Files(str(tmp_path), dies=str(tmp_path / "died")), "r"
    writer = Upload(target, run)
    target.begin(run)
    batch = pa.RecordBatch.from_pydict({"name": [f"n{i}" for i in range(5)], DAY: ["2024-01-15"] * 5})
    with pytest.raises(OSError):
        writer.write_attempt([batch], 0, 0)
    told = {}
    tasks = [threading.Thread(target=lambda i=i: told.update({i: writer.write_attempt([batch], 0, i)})) for i in (1, 2)]
    for task in tasks:
        task.start()
    for task in tasks:
        task.join()
    other = writer.write_attempt([batch.slice(0, 0)], 1, 3)
    # A task of an application that is gone writes on.
    Upload(target, run).write_attempt([batch], 0, 1)
    writer.commit([told[2], other, None])
    assert target.names() == [f"n{i}" for i in range(5)]
    # The commit's answer was lost, and the run is repeated.
    again = Upload(target, run)
    target.begin(run)
    again.commit([again.write_attempt([batch], 0, 7)])
    assert target.names() == [f"n{i}" for i in range(5)]


class Connection:
    """Keeps what it is asked; a statement that holds ``fails`` raises."""

    def __init__(self, log, fails):
        self.log, self.fails = log, fails

    def cursor(self):
        return self

    def execute(self, statement):
        self.log.append(statement)
        if self.fails and self.fails in statement:
            raise RuntimeError("refused")

    def executemany(self, statement, rows):
        self.log.append((statement, list(rows)))

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def test_statements_of_a_database():
    log = []
    table = DatabaseTable(lambda: Connection(log, ""), "agencies_stats", AGENCY_JDBC_TYPES)
    assert table.names == ["agency", "num_ratings", "record_date"]
    assert DatabaseTable(None, "t", "a DECIMAL(3, 1), b INT").names == ["a", "b"]
    assert DatabaseTable(None, "t", RATINGS_JDBC_TYPES).names[-1] == "agency"
    table.begin("1")
    assert log[-2:] == ["commit", "close"] and "agencies_stats_load_1" in log[-3]
    log.clear()
    assert table.write("1", 3, "x-9", iter([("A", 2, "d", "d")])) == 1
    assert log == [
        (
            "INSERT INTO agencies_stats_load_1 (agency, num_ratings, record_date, load_day, load_part, load_attempt) VALUES (?, ?, ?, ?, ?, ?)",
            [("A", 2, "d", "d", 3, "x-9")],
        ),
        "commit",
        "close",
    ]
    log.clear()
    table.publish("1", [Written(3, "x-9", 1), Written(4, "x-2", 5)])
    moved, noted, *rest = log
    both = "((load_part = 3 AND load_attempt = 'x-9') OR (load_part = 4 AND load_attempt = 'x-2'))"
    new = f"FROM agencies_stats_load_1 WHERE {both} AND load_day NOT IN (SELECT load_day FROM agencies_stats_loads)"
    assert moved == f"INSERT INTO agencies_stats (agency, num_ratings, record_date) SELECT agency, num_ratings, record_date {new}"
    assert noted.endswith(f"SELECT load_day, COUNT(*) {new} GROUP BY load_day")
    # The rows and the ledger are one transaction; the staging table goes after it.
    assert rest == ["commit", "close", "DROP TABLE IF EXISTS agencies_stats_load_1", "commit", "close"]


def test_a_refused_commit_is_rolled_back():
    log = []
    table = DatabaseTable(lambda: Connection(log, "_loads (load_day, num_rows)"), "t", "a INT")
    with pytest.raises(RuntimeError):
        table.publish("1", [Written(0, "x", 1)])
    assert log[-2:] == ["rollback", "close"] and "commit" not in log
