"""What the physical plans must and must not hold."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F
from samples import listing, pages, ratings

from rateflow.operators import (
    accepted,
    base_counts,
    count_by_agency,
    digest,
    extract,
    extract_cards,
    extract_grid,
    extract_paired,
    find_by_date,
    find_by_name,
    normalize,
    roll_up,
)
from rateflow.schema import AGENCY_TABLE, DAY, PAGES, RATINGS
from rateflow.session import shared_dir
from rateflow.sinks import write_days
from rateflow.sources import read_day, read_pages
from rateflow.sources.store import read_table


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "ratings")
    write_days(ratings(spark, ("a",), ("b",)).withColumn(DAY, F.col("rat_date")), path)
    return path


@pytest.fixture(scope="module")
def page_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "pages")
    pages(spark, *listing()).write.partitionBy("source").parquet(path)
    return path


def test_a_day_is_a_pruned_scan(spark, stored):
    text = plan(count_by_agency(read_day(spark, stored, "2024-01-15")))
    assert "PartitionFilters: [isnotnull(DT" in text
    assert "ReadSchema: struct<name:string,agency:string>" in text
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_lookups_reach_the_scan(spark, stored):
    table = spark.read.schema(RATINGS).parquet(stored)
    assert "EqualTo(rat_date,2024-01-15)" in plan(find_by_date(table, "2024-01-15"))
    by_name = plan(find_by_name(table, "A"))
    assert "Contains(lower(name" in by_name and "Exchange" not in by_name


@pytest.mark.parametrize("take", [extract_paired, extract_grid, extract_cards])
def test_extraction_is_one_narrow_pass(spark, page_path, take):
    text = plan(accepted(normalize(take(read_pages(spark, page_path)))))
    assert "Exchange" not in text and "Python" not in text and "Join" not in text
    assert text.count("FileScan") == 1 and "ReadSchema: struct<html:string>" in text
    # Comments and scripts are removed from each page once.
    assert text.count("!--.*?-->") == 1


def test_all_sources_are_one_pass(spark, page_path):
    text = plan(extract(read_pages(spark, page_path)))
    assert text.count("FileScan") == 1 and "Exchange" not in text and "Union" not in text
    assert text.count("!--.*?-->") == 1


def test_a_micro_batch_is_read_once(spark, page_path, tmp_path):
    seen = []

    def take(batch, _):
        seen.append(plan(extract(batch)))

    stream = spark.readStream.schema(PAGES).parquet(page_path).writeStream.foreachBatch(take)
    stream.option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start().awaitTermination()
    assert [text.count("Scan") for text in seen] == [1]


def test_digest_items_are_not_shuffled(spark, stored):
    df = read_table(spark, stored, RATINGS)
    messages = digest(df, roll_up(base_counts(df, DAY), AGENCY_TABLE, DAY), df.select(DAY).distinct())
    text = plan(messages.where(F.col("kind") == "item"))
    assert "Exchange hashpartitioning" not in text and "Sort" not in text


def test_shared_folder_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert PAGES.fieldNames() == ["source", "page_id", "html"]
