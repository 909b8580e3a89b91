from pyspark.sql import functions as F

from rateflow.operators.joins import broadcast_if_small, measured_bytes


def test_measured_bytes_counts_what_collections_hold(spark):
    text = F.lit("x" * 1000)
    rows = spark.range(10).select(
        F.array_repeat(text, 5).alias("texts"),
        F.sequence(F.lit(1), F.lit(100)).alias("numbers"),
        text.cast("binary").alias("raw"),
        F.array(F.struct(text.alias("a"), F.lit(1).alias("b"))).alias("pairs"),
        F.create_map(F.lit("k"), text).alias("map"),
        F.struct(F.array(text).alias("inner")).alias("deep"),
        F.lit(None).cast("array<string>").alias("nothing"),
    )
    least = {"texts": 50_000, "numbers": 8_000, "raw": 10_000, "pairs": 10_000, "map": 10_000, "deep": 10_000, "nothing": 0}
    for name, size in least.items():
        assert size <= measured_bytes(rows.select(name)) <= 1.1 * size + 2_000, name
    assert measured_bytes(rows) >= sum(least.values())
    assert measured_bytes(rows.limit(0)) == 0


def test_arrays_over_the_limit_are_not_broadcast(spark):
    large = spark.range(10).select("id", F.array_repeat(F.lit("x" * 1000), 5).alias("texts"))
    plan = lambda limit: spark.range(5).join(broadcast_if_small(large, limit), "id")._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" in plan(100_000) and "strategy=broadcast" not in plan(10_000)
