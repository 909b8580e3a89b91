import datetime as dt
import glob

from pyspark.sql import functions as F
from samples import ratings

from rateflow.schema import DAY, RATINGS
from rateflow.sinks import replace_days, write_day, write_days
from rateflow.sources import read_day, read_days
from rateflow.sources.store import read_table


def day(n):
    return dt.date(2024, 1, n)


def dated(spark, *rows):
    """Rows given as (name, day of the month)."""
    df = ratings(spark, *[(name, "A", "-", day(n)) for name, n in rows])
    return df.withColumn(DAY, F.col("rat_date"))


def content(df):
    return sorted((r.name, r.rat_date.day) for r in df.collect())


def files(path, n):
    return glob.glob(f"{path}/{DAY}={day(n)}/*.parquet")


def test_write_days_replaces_only_days_present(spark, tmp_path):
    path = str(tmp_path / "t")
    write_days(dated(spark, ("a", 1), ("b", 2), ("c", 3)), path)
    write_days(dated(spark, ("x", 2), ("y", 2)), path)
    assert content(read_table(spark, path, RATINGS)) == [("a", 1), ("c", 3), ("x", 2), ("y", 2)]
    assert len(files(path, 2)) == 1


def test_replace_days_empties_days_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        replace_days(dated(spark, ("a", 1), ("b", 2), ("c", 9)), path, day(1), day(9), RATINGS)
    replace_days(dated(spark, ("z", 3)), path, day(1), day(5), RATINGS)
    assert content(read_table(spark, path, RATINGS)) == [("c", 9), ("z", 3)]
    replace_days(dated(spark), path, day(1), day(9), RATINGS)
    assert read_table(spark, path, RATINGS).count() == 0


def test_write_day_empty_and_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    write_day(dated(spark, ("a", 1)).drop(DAY), path, day(1))
    write_day(dated(spark, ("b", 2)).drop(DAY), path, day(2))
    write_day(dated(spark).drop(DAY), path, day(1))
    assert content(read_table(spark, path, RATINGS)) == [("b", 2)]
    assert read_day(spark, path, day(1)).columns == RATINGS.fieldNames()
    assert read_day(spark, path, day(7)).count() == 0
    assert content(read_days(spark, path, "2024-01-01", "2024-01-31")) == [("b", 2)]


def test_one_file_is_one_file(spark, tmp_path):
    many = dated(spark, *[(str(n), 1) for n in range(100)]).drop(DAY).repartition(4)
    path = str(tmp_path / "t")
    write_day(many, path, day(1), one_file=True)
    assert len(files(path, 1)) == 1
    write_day(many, path, day(2))
    assert len(files(path, 2)) == 4
    assert read_table(spark, path, RATINGS).count() == 200


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        hot = spark.range(60_000, numPartitions=8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("name"),
            F.lit("A").alias("rating"),
            F.lit("-").alias("pred"),
            F.when(F.col("id") % 3 == 0, F.lit(day(2))).otherwise(
                F.date_add(F.lit(day(3)), (F.col("id") % 20).cast("int"))
            ).alias("rat_date"),
            F.lit("-").alias("observation"),
            F.lit("X").alias("agency"),
        )
        path = str(tmp_path / "t")
        write_days(hot.withColumn(DAY, F.col("rat_date")), path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    assert len(files(path, 2)) > 1
    assert read_table(spark, path, RATINGS).count() == 60_000
