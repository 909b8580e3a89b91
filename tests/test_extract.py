import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import cards, grid, listing, paired, pages

from rateflow.catalog import views
from rateflow.operators import (
    accepted,
    composite,
    extract,
    extract_cards,
    extract_grid,
    extract_paired,
    normalize,
    rejected,
)
from rateflow.operators.extract import CARDS_CLASS
from rateflow.schema import AGENCY_CARDS, AGENCY_GRID, AGENCY_PAIRS, RATINGS
from rateflow.sources import extract_archive, read_archive


def read(spark, take, *rows):
    return normalize(take(pages(spark, *rows)))


def good(df):
    return sorted(tuple(r) for r in accepted(df).collect())


def reasons(df):
    return sorted(r.reason for r in rejected(df).collect())


DAY = dt.date(2024, 1, 15)


def test_all_three_shapes(spark):
    rows = normalize(extract(pages(spark, *listing())))
    assert accepted(rows).dtypes == [(f.name, f.dataType.simpleString()) for f in RATINGS]
    assert good(rows) == sorted(
        [
            ('Банк "А"', "ruA+", "стабильный", DAY, "-", AGENCY_PAIRS),
            ("Банк-Б", "ruB", "-", DAY, "-", AGENCY_PAIRS),
            ("Банк В", "BBB.ru", "позитивный", DAY, "-", AGENCY_GRID),
            ("Банк Г", "A.ru", "-", DAY, "-", AGENCY_GRID),
            ("Банк Д", "AA", "стабильный", DAY, "-", AGENCY_CARDS),
            ("Банк Е", "A", "-", DAY, "да", AGENCY_CARDS),
        ]
    )
    assert rejected(rows).count() == 0


@pytest.mark.parametrize(
    "detail, rating, pred, observation, fault",
    [
        ("ruA+, 15.01.2024", "ruA+", "-", "-", None),
        ("ruA+, стабильный, 15.01.2024", "ruA+", "стабильный", "-", None),
        ("ruA+, под наблюдением, стабильный, 15.01.2024", "ruA+", "стабильный", "под наблюдением", None),
        ("ruA+", None, None, None, "parts: 1"),
        ("a,b,c,d,15.01.2024", None, None, None, "parts: 5"),
    ],
)
def test_composite(spark, detail, rating, pred, observation, fault):
    row = composite(spark.createDataFrame([(detail,)], "detail string"), "detail").first()
    assert (row.rating, row.pred, row.observation, row.part_fault) == (rating, pred, observation, fault)
    assert row.rat_date == (None if fault else "15.01.2024")


def test_paired_header_and_odd_span(spark):
    source, page_id, html = paired(("A", "r, 15.01.2024"))
    odd = html.replace("</table>", "<span>left over</span></table>")
    assert len(good(read(spark, extract_paired, (source, page_id, odd)))) == 1
    header_only = paired()
    rows = read(spark, extract_paired, header_only)
    assert reasons(rows) == ["no entries"] and accepted(rows).count() == 0


def test_paired_faults(spark):
    left_open = paired(("A", "r, <span>15.01.2024"))
    no_table = (AGENCY_PAIRS, 2, "<table></table>")
    no_link = (AGENCY_PAIRS, 3, paired(("A", "r, 15.01.2024"))[2].replace("<a ", "<b "))
    bad_date = paired(("A", "r, 15.13.2024"), ("B", "r, 15.01.2024"))
    rows = read(spark, extract_paired, left_open, no_table, no_link, bad_date, (AGENCY_PAIRS, 4, None))
    assert reasons(rows) == [
        "missing name",
        "nested or open span",
        "no second table",
        "no second table",
        "unreadable date: 15.13.2024",
    ]
    assert [r[0] for r in good(rows)] == ["B"]
    assert rejected(rows).where("reason = 'nested or open span'").first().raw == left_open[2]


def test_entries_are_cut_at_depth_zero(spark):
    wrap = lambda tag, text: f"<{tag} class='w'><{tag}></{tag}>{text}<b>!</b></{tag}>"
    spans = paired(("A", f"r, {wrap('span', wrap('span', '15.01.2024')).replace('<b>!</b>', '')}"), ("B", "r, 15.01.2024"))
    cells = grid(("C", "<span>r</span>1", "p", "15.01.2024"))[2]
    inner = "<td><table><tr><td>x</td><td><td></td></td></tr></table></td>"
    cells = (AGENCY_GRID, 1, cells.replace("<td></td><td></td>", inner + "<td></td>"))
    heads = cards(("<h2>D</h2>", "<h2>a</h2><h2>b</h2>", "-", "-", "<div>15.01.2024</div>"))
    rows = normalize(extract(pages(spark, spans, cells, heads)))
    assert reasons(rows) == []
    assert [(r[0], r[1]) for r in good(rows)] == [("A", "r"), ("B", "r"), ("C", "r1"), ("D", "ab")]


@pytest.mark.parametrize("tag, shape", [("span", paired), ("td", grid), ("h2", cards)])
def test_only_tags_that_do_not_pair_up_are_faults(spark, tag, shape):
    entry = {"span": ("A", "r, 15.01.2024"), "td": ("A", "r", "-", "15.01.2024"), "h2": ("A", "r", "-", "-", "15.01.2024")}[tag]
    source, _, html = shape(entry)
    at = html.index(f"<{tag}", html.index("issuers-table") if tag == "td" else html.index("jet-") if tag == "h2" else html.index("h7"))
    texts = {1: html[:at] + f"<{tag}>" + html[at:], 2: html[:at] + f"</{tag}>" + html[at:], 3: html[:at] + f"</{tag}><{tag}>" + html[at:]}
    nine = f"<{tag}>" * 12 + f"</{tag}>" * 12
    texts[4] = html[:at] + nine + html[at:]
    rows = normalize(extract(pages(spark, *[(source, n, text) for n, text in texts.items()])))
    assert {r.page_id for r in rejected(rows).where("reason like 'nested or open%'").collect()} == set(texts)


def test_broken_pages_take_one_pass(spark):
    """Thousands of open elements, and thousands inside one, neither overflow nor take long."""
    spans = "<span>x" * 20_000
    full = "<span>" + "<span>y</span><i>z</i>" * 20_000 + "</span>"
    head = "<table></table><table>" + "<span>h</span>" * 8
    rows = [(AGENCY_PAIRS, 1, f"{head}{spans}</table>"), (AGENCY_PAIRS, 2, f"{head}{full}<span>r, 15.01.2024</span></table>")]
    rows.append((AGENCY_PAIRS, 3, f"{head}{spans}{'</span>' * 20_000}</table>"))
    assert len(reasons(normalize(extract(pages(spark, *rows))))) == 3


def test_grid_missing_and_moved_cells(spark):
    moved = grid(("A", "r", "p", "15.01.2024"))[2].replace(
        "<td></td><td></td>", '<td><a href="/ratings/press-releases/9">15.01.2024</a></td><td></td>'
    ).replace('<td><a href="/ratings/press-releases/2">15.01.2024</a></td>', "<td></td>")
    other_link = grid(("A", "r", "p", "15.01.2024"))[2].replace("/ratings/issuers/", "/other/")
    linked_rating = grid(("A", "<a href='/r'>r</a>", "p", "15.01.2024"))[2]
    cut_row = grid(("A", "r", "p", "15.01.2024"))[2].replace("</table>", "<td></td></table>")
    rows = read(
        spark,
        extract_grid,
        *[(AGENCY_GRID, n, html) for n, html in enumerate([moved, other_link, linked_rating, cut_row])],
        (AGENCY_GRID, 9, "<table id='other'><td></td></table>"),
    )
    assert [r[0] for r in good(rows)] == ["A", "A"]
    assert reasons(rows) == [
        "missing name",
        "missing name, rating, pred, rat_date",
        "missing rating",
        "no issuers table",
    ]


def test_grid_text_is_kept_as_written(spark):
    rows = read(spark, extract_grid, grid((" <b>A</b>\n", " r ", "p", "15.01.2024")))
    assert good(rows)[0][:2] == (" A\n", " r ")


def test_cards_count_mismatch_rejects_the_page(spark):
    row = ("A", "r", "-", "p", "15.01.2024")
    short = cards(row, ("B", "r", "-", "p", ""), page_id=7)
    rows = read(spark, extract_cards, cards(row), short)
    assert [r[0] for r in good(rows)] == ["A"]
    assert [(r.page_id, r.reason) for r in rejected(rows).collect()] == [
        (7, "cards and dates differ in number")
    ]


def test_no_page_vanishes(spark):
    unknown = ("other", 8, "<p>x</p>"), (None, 9, "<p>x</p>")
    moved = [
        (AGENCY_PAIRS, 1, paired(("A", "r, 15.01.2024"))[2].replace("span", "b")),
        (AGENCY_GRID, 2, grid(("A", "r", "p", "15.01.2024"))[2].replace("td", "li")),
        (AGENCY_CARDS, 3, f'<div class="{CARDS_CLASS}"><h3>A</h3></div>'),
    ]
    rows = read(spark, extract, *unknown, *moved, *listing())
    assert reasons(rows) == ["no entries"] * 3 + ["unknown source"] * 2
    assert {r.page_id for r in rejected(rows).collect()} == {1, 2, 3, 8, 9}
    assert accepted(rows).count() == 6


def test_empty_pages(spark):
    rows = normalize(extract(pages(spark)))
    assert accepted(rows).count() == 0 and rejected(rows).count() == 0


def test_strict_fails_on_the_first_fault(spark):
    rows = normalize(extract_paired(pages(spark, paired(("A", "r, 5.1.24")))), strict=True)
    with pytest.raises(Exception, match="unreadable date: 5.1.24"):
        accepted(rows).count()
    fine = normalize(extract_paired(pages(spark, paired(("A", "r, 5.1.2024")))), strict=True)
    assert accepted(fine).count() == 1


def test_archive_range(spark, tmp_path):
    for number in (1, 2, 9, 15, 16):
        page = paired((f"Bank {number}", "r, 15.01.2024"))[2]
        (tmp_path / f"{number}.txt").write_text(page, encoding="utf-8")
    (tmp_path / "notes.txt").write_text("x")
    (tmp_path / "3.html").write_text("x")
    assert sorted(r.page_id for r in read_archive(spark, str(tmp_path)).collect()) == [2, 9, 15]
    names = [r[0] for r in good(normalize(extract_archive(spark, str(tmp_path))))]
    assert names == ["Bank 15", "Bank 2", "Bank 9"]


texts = st.text(
    st.characters(exclude_categories=["Cs", "Cc", "Z"], exclude_characters=","), min_size=1, max_size=20
)
announcements = st.lists(
    st.tuples(texts, texts, texts, st.dates(dt.date(1990, 1, 1), dt.date(2099, 12, 31)), texts),
    min_size=1,
    max_size=12,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(announcements)
def test_rendering_then_reading_gives_the_rows_back(spark, rows):
    plain = [tuple(row) + ("a", key) for key, row in enumerate(rows)]
    df = spark.createDataFrame(
        plain, "name string, rating string, pred string, rat_date date, observation string, agency string, key long"
    )
    for agency, render, take, fixed in (
        (AGENCY_PAIRS, views.paired_pages, extract_paired, ()),
        (AGENCY_GRID, views.grid_pages, extract_grid, ("observation",)),
        (AGENCY_CARDS, views.card_pages, extract_cards, ()),
    ):
        given_rows = df.withColumn("agency", F.lit(agency))
        # A page cannot show an outlook or status that looks like "nothing given".
        for column in ("pred", "observation"):
            given_rows = given_rows.withColumn(
                column, F.when(F.col(column) == "-", "x").otherwise(F.col(column))
            )
        for column in fixed:
            given_rows = given_rows.withColumn(column, F.lit("-"))
        read_rows = accepted(normalize(take(render(given_rows, per_page=5))))
        assert good_rows(read_rows) == good_rows(given_rows.select(*RATINGS.fieldNames()))


def good_rows(df):
    return sorted(tuple(r) for r in df.collect())
