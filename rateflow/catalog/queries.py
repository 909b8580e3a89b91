"""The queries, by name. Each takes a session and the folder of the given tables."""

from pyspark.sql import functions as F

from rateflow.catalog import views
from rateflow.functions import dates, html, text
from rateflow.functions.messages import digest_item, lookup_item
from rateflow.operators import (
    accepted,
    answers,
    changes,
    composite,
    count_by_agency,
    count_by_agency_rating,
    count_by_date,
    digest,
    extract,
    extract_cards,
    extract_grid,
    extract_paired,
    find_by_date,
    find_by_name,
    normalize,
    rejected,
    route,
    select_day,
    stamp,
    summary,
    totals,
    union_feeds,
)
from rateflow.operators.changes import changes_of, next_standing
from rateflow.operators.extract import CARDS_CLASS
from rateflow.operators.name_index import extend_index
from rateflow.plans import Store, backfill, run_day
from rateflow.plans.backfill import message_days, store_days
from rateflow.schema import (
    AGENCY_CARDS,
    AGENCY_GRID,
    AGENCY_PAIRS,
    AGENCY_RATING_STATS,
    AGENCY_RATING_TABLE,
    AGENCY_STATS,
    AGENCY_TABLE,
    DATE_STATS,
    DATE_TABLE,
    DAY,
    OUTBOX,
    RATING_COLUMNS,
    RATINGS,
    STANDING,
)
from rateflow.session import fresh_dir, stage
from rateflow.sinks import replace_days, write_day, write_days
from rateflow.sources import extract_archive, read_pages
from rateflow.sources.store import read_table
from rateflow.streaming import arriving_pages, run_arrived
from rateflow.streaming.incremental import read_news

RUN_DATE = "1996-09-17"
FIRST, LAST = "2023-12-25", "2024-02-05"
PAGE_FIRST, PAGE_LAST = "2024-01-01", "2024-04-15"


def _by_own_day(ratings):
    return ratings.withColumn(DAY, F.col("rat_date"))


def day_slice(spark, d):
    return select_day(views.order_ratings(spark, d), RUN_DATE)


def until(spark, d):
    return select_day(views.order_ratings(spark, d), RUN_DATE, "until")


def since(spark, d):
    return select_day(views.order_ratings(spark, d), RUN_DATE, "since")


def count_agency(spark, d):
    return count_by_agency(views.line_ratings(spark, d))


def count_agency_rating(spark, d):
    return count_by_agency_rating(views.line_ratings(spark, d))


def count_date(spark, d):
    events = views.table(spark, d, "events")
    return count_by_date(
        events.select(F.col("event_type").alias("name"), F.col("ts").cast("date").alias("rat_date"))
    )


def stamped(spark, d):
    return stamp(count_by_agency_rating(views.line_ratings(spark, d)), RUN_DATE)


def union_all(spark, d):
    feeds = [
        views.table(spark, d, name).select(F.col(column).alias("name"), F.lit(agency).alias("agency"))
        for name, column, agency in (
            ("customer", "c_name", "first"),
            ("supplier", "s_name", "second"),
            ("part", "p_name", "third"),
        )
    ]
    return union_feeds(*feeds)


def norm_date(spark, d):
    orders = views.table(spark, d, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "d.MM.yyyy").alias("shown")
    )
    dated = orders.withColumn("rat_date", dates.parse_day(dates.dots_to_dashes(F.col("shown"))))
    return dated.withColumn("iso", dates.format_day("rat_date"))


def composite_parts(spark, d):
    third = F.col("o_orderkey") % 3
    joined = F.concat_ws(
        " , ",
        "o_orderpriority",
        F.when(third == 2, "watch"),
        F.when(third != 0, F.col("o_orderstatus")),
        F.date_format("o_orderdate", "dd.MM.yyyy"),
    )
    parts = composite(views.table(spark, d, "orders").select("o_orderkey", joined.alias("detail")), "detail")
    day = dates.parse_day(dates.dots_to_dashes(F.col("rat_date")))
    return parts.select("o_orderkey", "rating", "pred", "observation", day.alias("rat_date"))


def _read(pages_of, rows_of, take):
    def query(spark, d):
        return accepted(normalize(take(pages_of(rows_of(spark, d)))))

    return query


def archive(spark, d):
    path = fresh_dir(spark, "archive")
    pages = views.paired_pages(views.customer_rows(spark, d), per_page=500)
    saved = pages.select(F.col("html").alias("value"), (F.col("page_id") + 2).alias("file"))
    saved.repartition("file").write.partitionBy("file").text(path)
    rows = extract_archive(spark, path, first=2, last=2**40, number=r"/file=([0-9]+)/")
    return accepted(normalize(rows))


def rejects(spark, d):
    """Every fourteenth customer has a detail text of six parts; every fifth page no table."""
    rows = views.customer_rows(spark, d)
    bad = F.when(F.col("key") % 14 == 0, "a, b, c").when(F.col("key") % 14 == 7, "watch")
    rows = rows.withColumn("observation", F.coalesce(bad, "observation"))
    rows = rows.withColumn("pred", F.when(F.col("key") % 14 == 0, "p").otherwise(F.col("pred")))
    pages = views.paired_pages(rows)
    html = F.when(F.col("page_id") % 5 == 4, F.replace("html", F.lit("table"), F.lit("div")))
    pages = pages.withColumn("html", F.coalesce(html, "html"))
    return (
        rejected(normalize(extract_paired(pages)))
        .groupBy("source", "page_id", "reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def all_rejects(spark, d):
    """Pages of every shape with every fault, by page number modulo 7.

    0 is of an unknown source, 1 lacks its container, 2 its entries, 3 has an element that
    stays open, 4 dates that are none, 5 no names, and 6 is sound. ``places`` adds up the
    places of the rows on their page.
    """
    kind = F.col("page_id") % 7
    swaps = {
        AGENCY_PAIRS: ("table", "span", "<span>\n", "<a title"),
        AGENCY_GRID: ("table", "td", "<td></td>", "/ratings/issuers/"),
        AGENCY_CARDS: (CARDS_CLASS, "h2", "<h2>more", "no names"),
    }

    def changed(container, entry, opening, name):
        new = lambda old, text: F.replace("html", F.lit(old), F.lit(text))
        twice = f"{opening[: opening.index('>') + 1]}{opening}" if ">" in opening else opening
        return (
            F.when(kind == 1, new(container, "x"))
            .when(kind == 2, new(entry, "b"))
            .when(kind == 3, new(opening, twice))
            .when(kind == 4, new(".2024", ".20x4"))
            .when(kind == 5, new(name, "<b title" if name.startswith("<") else "/other/"))
        )

    html = F.coalesce(*[F.when(F.col("source") == s, changed(*swap)) for s, swap in swaps.items()], "html")
    pages = views.listing_pages(spark, d).withColumn("html", html)
    pages = pages.withColumn("source", F.when(kind == 0, "other").otherwise(F.col("source")))
    found = rejected(normalize(extract(pages))).groupBy("source", "page_id", "reason")
    return found.agg(F.count(F.lit(1)).alias("n"), F.sum("row").alias("places"))


def links(spark, d):
    anchors = F.regexp_extract_all(
        html.visible(F.col("html")), F.lit(rf"(?is){html.opening('a')}"), 0
    )
    found = views.table(spark, d, "pages").select("page_id", F.posexplode(anchors).alias("pos", "tag"))
    href = text.decode_entities(html.attribute(F.col("tag"), "a", "href"))
    return found.select("page_id", "pos", href.alias("href")).select(
        "*", F.startswith("href", F.lit("/t")).alias("inside"), (F.col("pos") % 6).alias("cell")
    )


def page_headings(spark, d):
    heads = html.texts_of(html.elements(html.visible(F.col("html")), "h1"))
    return views.table(spark, d, "pages").select("page_id", F.posexplode(heads).alias("pos", "heading"))


def escaped(spark, d):
    coded = text.escape_html(F.col("text"))
    shown = F.concat(F.lit("<span><i>"), F.col("escaped"), F.lit("</i></span>"))
    return (
        views.table(spark, d, "documents")
        .select("doc_id", coded.alias("escaped"))
        .withColumn("restored", html.tag_text(shown))
    )


def name_search(spark, d):
    return find_by_name(views.part_ratings(spark, d), "WIDGET")


def name_wildcards(spark, d):
    return find_by_name(views.part_ratings(spark, d), "b%_dget", wildcards=True)


def name_literal(spark, d):
    marked = F.when(F.col("agency") == "A0", F.replace("name", F.lit(" "), F.lit("%"))).when(
        F.col("agency") == "A1", F.replace("name", F.lit(" "), F.lit("_"))
    )
    ratings = views.part_ratings(spark, d).withColumn("name", F.coalesce(marked, "name"))
    return find_by_name(ratings, "%Widget").unionByName(find_by_name(ratings, "_Widget"))


def date_lookup(spark, d):
    ratings = views.order_ratings(spark, d)
    return union_feeds(*[find_by_date(ratings, typed) for typed in (RUN_DATE, "1996-13-45", "Bank-A")])


def routed(spark, d):
    typed = F.explode(
        F.array(F.date_format("o_orderdate", "yyyy-M-d"), F.col("o_orderpriority"), F.col("o_orderstatus"))
    )
    texts = views.table(spark, d, "orders").select("o_orderkey", typed.alias("text"))
    return texts.withColumn("route", route(F.col("text")))


def item_messages(spark, d):
    ratings = views.order_ratings(spark, d)
    return ratings.select(
        "agency", "name", "rat_date", digest_item().alias("digest"), lookup_item().alias("lookup")
    )


def _digest(ratings, days):
    ratings = _by_own_day(ratings)
    counts = ratings.groupBy(DAY, "agency").agg(F.count("name").alias("num_ratings"))
    return digest(ratings, counts, days).select(DAY, "kind", "text")


def day_digests(spark, d):
    ratings = views.order_ratings(spark, d)
    return _digest(ratings, ratings.select(F.col("rat_date").alias(DAY)).distinct())


def empty_digests(spark, d):
    ratings = views.order_ratings(spark, d)
    ends = ratings.agg(F.min("rat_date").alias("a"), F.max("rat_date").alias("z"))
    week = F.expr("interval 7 days")
    days = ends.select(
        F.explode(F.sequence((F.col("a") - week).cast("date"), (F.col("z") + week).cast("date"))).alias(DAY)
    )
    return _digest(ratings, days).where(F.col("kind") == "none")


def day_summaries(spark, d):
    lines = _by_own_day(views.line_ratings(spark, d))
    return summary(lines.groupBy(DAY, "agency").agg(F.count("name").alias("num_ratings")))


def indexed_answers(spark, d):
    """The same answers from an index that has taken the names in two turns."""
    index = fresh_dir(spark, "index")
    ratings = views.part_ratings(spark, d)
    for names in (ratings.where("agency = 'A0'"), ratings):
        extend_index(spark, index, names)
    return batch_answers(spark, d, index)


def batch_answers(spark, d, index=None):
    ratings = views.part_ratings(spark, d)
    words = ratings.select(F.explode(F.split("name", " ")).alias("text"))
    asked = (
        words.select(F.upper("text").alias("text"))
        .unionByName(words.select(F.substring("text", 1, 2).alias("text")))
        .unionByName(ratings.select(dates.format_day("rat_date").alias("text")))
        .unionByName(views.table(spark, d, "nation").select(F.col("n_name").alias("text")))
        .unionByName(ratings.select(F.concat(F.date_format("rat_date", "yyyy"), F.lit("-13-45")).alias("text")))
        .distinct()
    )
    requests = asked.select(F.xxhash64("text").alias("req_id"), "text")
    found = answers(ratings, requests, items_per_part=20, index=index)
    return found.join(requests.withColumnRenamed("text", "request"), "req_id").drop("req_id")


def store_roundtrip(spark, d):
    path = fresh_dir(spark, "ratings")
    ratings = _by_own_day(views.event_ratings(spark, d))
    write_days(ratings, path)
    again = ratings.withColumn("rating", F.lower("rating")).where(
        F.col(DAY).between("2024-01-10", "2024-01-20") & (F.dayofmonth(DAY) != 15)
    )
    replace_days(again, path, "2024-01-10", "2024-01-20", RATINGS)
    day = select_day(views.event_ratings(spark, d), "2024-01-25")
    write_day(day.withColumn("rating", F.lit("one file")), path, "2024-01-25", one_file=True)
    return read_table(spark, path, RATINGS)


def stored_stats(spark, d):
    store = Store(fresh_dir(spark, "stats"))
    store_days(spark, views.event_ratings(spark, d), store, FIRST, LAST)

    def total(name, schema, *keys):
        stored = totals(read_table(spark, store.stats(name), schema), *keys)
        first = F.col(keys[0]).cast("string").alias("first_key")
        second = F.col(keys[1]) if len(keys) > 1 else F.lit("")
        return stored.select(F.lit(name).alias("stats"), first, second.alias("second_key"), "num_ratings")

    return union_feeds(
        total(AGENCY_TABLE, AGENCY_STATS, "agency"),
        total(AGENCY_RATING_TABLE, AGENCY_RATING_STATS, "agency", "rating"),
        total(DATE_TABLE, DATE_STATS, "rat_date"),
    )


def daily_run(spark, d):
    root = fresh_dir(spark, "daily")
    pages = read_pages(spark, views.stored_pages(spark, d, f"{root}/pages"))
    store = Store(root)
    run_day(spark, pages, store, "2024-02-10", one_file=True)
    return read_table(spark, store.outbox, OUTBOX).select(DAY, "kind", "text")


def backfilled(spark, d):
    root = fresh_dir(spark, "backfill")
    pages = read_pages(spark, views.stored_pages(spark, d, f"{root}/pages"))
    store = Store(root)
    backfill(spark, pages, store, PAGE_FIRST, PAGE_LAST)
    return read_table(spark, store.stats(AGENCY_RATING_TABLE), AGENCY_RATING_STATS)


def _streamed(spark, d):
    """Pages arrive in two waves; the second repeats the paired pages of the first."""
    root = fresh_dir(spark, "stream")
    store = Store(root)
    pages = read_pages(spark, views.stored_pages(spark, d, f"{root}/pages"))
    odd = F.col("page_id") % 2 == 1
    for wave in (pages.where(~odd), pages.where(odd | (F.col("source") == AGENCY_PAIRS))):
        wave.write.mode("append").partitionBy("source").parquet(f"{root}/arrived")
        run_arrived(spark, arriving_pages(spark, f"{root}/arrived"), store, f"{root}/progress")
    return store


def streamed(spark, d):
    return read_table(spark, _streamed(spark, d).ratings, RATINGS).select(*RATING_COLUMNS)


def streamed_news(spark, d):
    """Items told of each day, over all batches, beside the day's stored count."""
    store = _streamed(spark, d)
    told = read_news(spark, store.news).where("kind = 'item'").groupBy(DAY).agg(F.count(F.lit(1)).alias("told"))
    stored = read_table(spark, store.stats(DATE_TABLE), DATE_STATS).select(DAY, "num_ratings")
    return told.join(stored, DAY)


def rating_changes(spark, d):
    return changes(views.order_ratings(spark, d))


def standing_changes(spark, d):
    """The history a period at a time, each knowing only the standing after the one before."""
    ratings = views.order_ratings(spark, d)
    ends = ratings.select(F.percentile_approx(F.unix_date("rat_date"), [0.25, 0.5, 0.75])).first()[0]
    standing, found, before = spark.createDataFrame([], STANDING), [], -(2**31)
    for end in [*ends, 2**31 - 1]:
        period = ratings.where((F.unix_date("rat_date") > before) & (F.unix_date("rat_date") <= end))
        found.append(changes_of(period, standing))
        standing, before = stage(next_standing(period, standing), "standing"), end
    return union_feeds(*found)


def _outbox(spark, d):
    store = Store(fresh_dir(spark, "outbox"))
    store_days(spark, views.event_ratings(spark, d), store, FIRST, LAST)
    message_days(spark, store, FIRST, LAST)
    return read_table(spark, store.outbox, OUTBOX)


def outbox(spark, d):
    return _outbox(spark, d).select(DAY, "kind", "text")


def outbox_order(spark, d):
    """What stands first and last among a day's messages."""
    ends = F.min_by("kind", "seq").alias("first_kind"), F.max_by("kind", "seq").alias("last_kind")
    return _outbox(spark, d).groupBy(DAY).agg(*ends, F.count(F.lit(1)).alias("n"))


def nested_shapes(spark, d):
    """Pages whose entries hold elements of the tag that entries are made of."""
    return accepted(normalize(extract(views.nested_pages(spark, d))))


def all_shapes(spark, d):
    """Three sources in one job, counted by agency and day."""
    rows = accepted(normalize(extract(views.listing_pages(spark, d))))
    return rows.groupBy("agency", "rat_date").agg(F.count("name").alias("num_ratings"))


QUERIES = {
    "q_day_slice": day_slice,
    "q_until": until,
    "q_since": since,
    "q_count_agency": count_agency,
    "q_count_agency_rating": count_agency_rating,
    "q_count_date": count_date,
    "q_stamp": stamped,
    "q_union_feeds": union_all,
    "q_norm_date": norm_date,
    "q_composite": composite_parts,
    "q_pairs": _read(views.paired_pages, views.customer_rows, extract_paired),
    "q_grid6": _read(views.grid_pages, views.supplier_rows, extract_grid),
    "q_cards5": _read(views.card_pages, views.part_rows, extract_cards),
    "q_shapes": all_shapes,
    "q_nested": nested_shapes,
    "q_archive": archive,
    "q_rejects": rejects,
    "q_rejects_all": all_rejects,
    "q_links": links,
    "q_headings": page_headings,
    "q_escape": escaped,
    "q_name_search": name_search,
    "q_name_wildcards": name_wildcards,
    "q_name_literal": name_literal,
    "q_date_lookup": date_lookup,
    "q_route": routed,
    "q_item_msg": item_messages,
    "q_digest": day_digests,
    "q_digest_empty": empty_digests,
    "q_summary": day_summaries,
    "q_answers": batch_answers,
    "q_answers_index": indexed_answers,
    "q_roundtrip": store_roundtrip,
    "q_stats_store": stored_stats,
    "q_day_run": daily_run,
    "q_backfill": backfilled,
    "q_stream": streamed,
    "q_stream_news": streamed_news,
    "q_change": rating_changes,
    "q_change_standing": standing_changes,
    "q_outbox": outbox,
    "q_outbox_order": outbox_order,
}
