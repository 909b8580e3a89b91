"""The given tables seen as ratings, and listing pages rendered from them."""

from functools import reduce

from pyspark.sql import functions as F

from rateflow.functions.text import escape_html
from rateflow.operators.extract import CARD_DATE_CLASS, CARDS_CLASS, GRID_TABLE_ID, HEADER_SPANS
from rateflow.schema import AGENCY_CARDS, AGENCY_GRID, AGENCY_PAIRS

ROWS_PER_PAGE = 40


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ratings(df, **columns):
    return df.select(
        *[
            columns[c].alias(c)
            for c in ("name", "rating", "pred", "rat_date", "observation", "agency")
        ]
    )


def order_ratings(spark, sf_dir):
    """Orders as announcements: the customer is the issuer."""
    third = F.col("o_orderkey") % 3
    return _ratings(
        table(spark, sf_dir, "orders"),
        name=F.concat(F.lit("Customer#"), F.col("o_custkey").cast("string")),
        rating=F.col("o_orderpriority"),
        pred=F.col("o_orderstatus"),
        rat_date=F.col("o_orderdate").cast("date"),
        observation=F.when(third == 2, "watch").otherwise("-"),
        agency=F.concat(F.lit("A"), third.cast("string")),
    )


def line_ratings(spark, sf_dir):
    """Order lines as announcements, for counts over the largest table."""
    return _ratings(
        table(spark, sf_dir, "lineitem"),
        name=F.col("l_partkey").cast("string"),
        rating=F.col("l_linestatus"),
        pred=F.lit("-"),
        rat_date=F.col("l_shipdate").cast("date"),
        observation=F.lit("-"),
        agency=F.col("l_returnflag"),
    )


def event_ratings(spark, sf_dir):
    """Events as announcements: few days, each with many announcements."""
    return _ratings(
        table(spark, sf_dir, "events"),
        name=F.concat(F.lit("User#"), F.col("user_id").cast("string")),
        rating=F.concat(F.lit("R"), (F.col("event_id") % 7).cast("string")),
        pred=F.col("props"),
        rat_date=F.col("ts").cast("date"),
        observation=F.lit("-"),
        agency=F.col("event_type"),
    )


def part_ratings(spark, sf_dir):
    """Parts as announcements: few names, each with many announcements."""
    return _ratings(
        table(spark, sf_dir, "part"),
        name=F.col("p_name"),
        rating=F.col("p_brand"),
        pred=F.col("p_type"),
        rat_date=F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")),
        observation=F.lit("-"),
        agency=F.concat(F.lit("A"), (F.col("p_partkey") % 3).cast("string")),
    )


def _page_day(key):
    return F.date_add(F.lit("2024-01-01").cast("date"), (F.col(key) % 90).cast("int"))


def customer_rows(spark, sf_dir):
    """What the paired-span pages announce."""
    kind = F.col("c_custkey") % 3
    rows = _ratings(
        table(spark, sf_dir, "customer").withColumn("key", F.col("c_custkey")),
        name=F.concat("c_name", F.lit(' & "Co" <'), F.col("c_nationkey").cast("string"), F.lit(">")),
        rating=F.col("c_mktsegment"),
        pred=F.when(kind == 0, "-").otherwise(F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))),
        rat_date=_page_day("c_custkey"),
        observation=F.when(kind == 2, "watch").otherwise("-"),
        agency=F.col("c_custkey"),
    )
    return rows.withColumnRenamed("agency", "key").withColumn("agency", F.lit(AGENCY_PAIRS))


def supplier_rows(spark, sf_dir):
    """What the six-cell pages announce."""
    rows = _ratings(
        table(spark, sf_dir, "supplier"),
        name=F.col("s_name"),
        rating=F.concat(F.lit("R"), (F.col("s_suppkey") % 7).cast("string")),
        pred=F.concat(F.lit("N"), F.col("s_nationkey").cast("string")),
        rat_date=_page_day("s_suppkey"),
        observation=F.lit("-"),
        agency=F.col("s_suppkey"),
    )
    return rows.withColumnRenamed("agency", "key").withColumn("agency", F.lit(AGENCY_GRID))


def part_rows(spark, sf_dir):
    """What the five-heading pages announce."""
    rows = _ratings(
        table(spark, sf_dir, "part"),
        name=F.col("p_name"),
        rating=F.col("p_brand"),
        pred=F.concat(F.lit("S"), F.col("p_size").cast("string")),
        rat_date=_page_day("p_partkey"),
        observation=F.col("p_type"),
        agency=F.col("p_partkey"),
    )
    return rows.withColumnRenamed("agency", "key").withColumn("agency", F.lit(AGENCY_CARDS))


def _pages(rows, fragment, head, tail, per_page):
    """Pages of up to ``per_page`` rows; keys are unique, so a page is bounded."""
    numbered = rows.select(
        F.col("agency").alias("source"),
        F.floor(F.col("key") / per_page).cast("bigint").alias("page_id"),
        F.struct(F.col("key"), fragment.alias("text")).alias("entry"),
    )
    entries = F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["text"])
    return numbered.groupBy("source", "page_id").agg(
        F.concat(F.lit(head), F.array_join(entries, "\n"), F.lit(tail)).alias("html")
    )


def _shown():
    return F.date_format("rat_date", "dd.MM.yyyy")


def paired_pages(rows, per_page=ROWS_PER_PAGE):
    detail = F.concat_ws(
        ", ",
        escape_html(F.col("rating")),
        F.when(F.col("observation") != "-", escape_html(F.col("observation"))),
        F.when(F.col("pred") != "-", escape_html(F.col("pred"))),
        _shown(),
    )
    fragment = F.concat(
        F.lit('<tr><td><span class="c"><a title="a>b" href="/x/'),
        F.col("key").cast("string"),
        F.lit('">'),
        escape_html(F.col("name")),
        F.lit("</a></span></td><td><span>\n  <b>"),
        detail,
        F.lit("</b>\n</span></td></tr>"),
    )
    head = (
        "<html><script>var t='<table><span>';</script><table><tr><td><span>decoy</span></td></tr>"
        "</table><!-- <table> --><table class='list'>"
        + "".join(f"<th><span>h{n}</span></th>" for n in range(HEADER_SPANS))
    )
    return _pages(rows, fragment, head, "</table><table><span>after</span></table></html>", per_page)


def grid_pages(rows, per_page=ROWS_PER_PAGE):
    fragment = F.concat(
        F.lit('<tr><td><a href="/ratings/issuers/'),
        F.col("key").cast("string"),
        F.lit('/">'),
        escape_html(F.col("name")),
        F.lit("</a></td><td><span>"),
        escape_html(F.col("rating")),
        F.lit("</span></td><td><span>"),
        escape_html(F.col("pred")),
        F.lit("</span></td><td></td><td>&nbsp;</td><td><a href='/ratings/press-releases/"),
        F.col("key").cast("string"),
        F.lit("/'>"),
        _shown(),
        F.lit("</a></td></tr>"),
    )
    head = (
        "<html><table><tr><td>menu</td></tr></table>"
        f'<table class="t" id="{GRID_TABLE_ID}"><thead><tr><th>Name</th></tr></thead>'
    )
    return _pages(rows, fragment, head, "</table><table><td>after</td></table></html>", per_page)


def card_pages(rows, per_page=ROWS_PER_PAGE):
    heading = [F.lit("<h2>more</h2>")]
    for column in ("name", "rating", "observation", "pred"):
        heading += [F.lit("<h2 class='h'>"), escape_html(F.col(column)), F.lit("</h2>")]
    fragment = F.concat(
        F.lit('<div class="card"><div>'),
        *heading,
        F.lit(f'</div><div class="{CARD_DATE_CLASS}"></div><div class="{CARD_DATE_CLASS}">'),
        _shown(),
        F.lit("</div></div>"),
    )
    head = f'<html><h2>Title</h2><div id="w"><div class="{CARDS_CLASS}">'
    tail = f'</div></div><h2>Foot</h2><div class="{CARD_DATE_CLASS}">01.01.2000</div></html>'
    return _pages(rows, fragment, head, tail, per_page)


def listing_pages(spark, sf_dir):
    """Pages of all three shapes."""
    return (
        paired_pages(customer_rows(spark, sf_dir))
        .unionByName(grid_pages(supplier_rows(spark, sf_dir)))
        .unionByName(card_pages(part_rows(spark, sf_dir)))
    )


def nested_pages(spark, sf_dir):
    """The same pages with elements of the entries' own tags inside each entry."""
    new = lambda html, *pairs: reduce(lambda text, p: F.replace(text, F.lit(p[0]), F.lit(p[1])), pairs, html)
    html = F.col("html")
    inner_table = "<td><table><tr><td>a</td><td>b</td></tr></table></td>"
    dated = F.regexp_replace(html, r"([0-9.]{10})</div>", "<div><div>$1</div></div></div>")
    nested = (
        F.when(
            F.col("source") == AGENCY_PAIRS,
            new(html, ("<span>\n  <b>", "<span>\n  <span><b><span></span>"), ("</b>\n</span>", "</b></span>\n</span>"), ('"c"><a', '"c"><span></span><a')),
        )
        .when(
            F.col("source") == AGENCY_GRID,
            new(html, ("<span>", "<span><span>"), ("</span>", "</span><span></span></span>"), ("<td></td>", inner_table)),
        )
        .otherwise(new(dated, ("<h2", "<h2 id='o'><h2"), ("</h2>", "</h2></h2>")))
    )
    return listing_pages(spark, sf_dir).withColumn("html", nested)


def stored_pages(spark, sf_dir, path):
    """The same pages written by source, as the jobs read them."""
    listing_pages(spark, sf_dir).write.partitionBy("source").parquet(path)
    return path
