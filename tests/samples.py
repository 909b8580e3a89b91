"""Small inputs shared by the tests."""

import datetime as dt

from rateflow.operators.extract import CARD_DATE_CLASS, CARDS_CLASS
from rateflow.schema import AGENCY_CARDS, AGENCY_GRID, AGENCY_PAIRS, PAGES, RATINGS

DAY = dt.date(2024, 1, 15)


def ratings(spark, *rows):
    """Rows given as (name, rating, pred, date, observation, agency) with defaults."""
    default = ("Bank", "A", "-", DAY, "-", "X")
    return spark.createDataFrame([tuple(row) + default[len(row):] for row in rows], RATINGS)


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), PAGES)


def paired(*entries, page_id=1):
    spans = "".join(
        f"<span><a href='/x'>{name}</a></span><span>{detail}</span>" for name, detail in entries
    )
    header = "".join(f"<span>h{n}</span>" for n in range(8))
    return (AGENCY_PAIRS, page_id, f"<table></table><table>{header}{spans}</table>")


def grid(*rows, page_id=1):
    cells = "".join(
        f'<tr><td><a href="/ratings/issuers/1">{name}</a></td><td><span>{rating}</span></td>'
        f"<td><span>{pred}</span></td><td></td><td></td>"
        f'<td><a href="/ratings/press-releases/2">{date}</a></td></tr>'
        for name, rating, pred, date in rows
    )
    return (AGENCY_GRID, page_id, f'<table id="issuers-table">{cells}</table>')


def cards(*rows, page_id=1):
    body = "".join(
        f"<div><h2>x</h2><h2>{name}</h2><h2>{rating}</h2><h2>{obs}</h2><h2>{pred}</h2>"
        f'<div class="{CARD_DATE_CLASS}"></div><div class="a {CARD_DATE_CLASS}">{date}</div></div>'
        for name, rating, obs, pred, date in rows
    )
    return (AGENCY_CARDS, page_id, f'<div class="{CARDS_CLASS}">{body}</div><h2>end</h2>')


def listing(date="15.01.2024"):
    """One page of each source, two rows each, all of one date."""
    return [
        paired(("Банк &quot;А&quot;", f"ruA+, стабильный, {date}"), ("Банк-Б", f"ruB, {date}")),
        grid(("Банк В", "BBB.ru", "позитивный", date), ("Банк Г", "A.ru", "-", date)),
        cards(("Банк Д", "AA", "-", "стабильный", date), ("Банк Е", "A", "да", "-", date)),
    ]
