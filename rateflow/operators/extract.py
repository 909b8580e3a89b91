"""Listing pages to rows.

Each extractor is a narrow map over pages: no shuffle, no Python worker. A page is cut into
an array of small entries which one generator turns into rows; texts are then worked out per
row as plain columns. A page or row that does not fit the expected shape comes out with a
``reason`` instead of being dropped.
"""

from pyspark.sql import functions as F

from rateflow.functions.html import (
    after,
    attribute,
    balanced,
    count_opening,
    elements_having,
    first,
    having,
    opening,
    tag_texts,
    texts_of,
    visible,
    whole_elements,
)
from rateflow.functions.text import strip
from rateflow.operators.normalize import composite
from rateflow.schema import ABSENT, AGENCY_CARDS, AGENCY_GRID, AGENCY_PAIRS, EXTRACTED

# What marks the parts of a listing page.
HEADER_SPANS = 8
GRID_TABLE_ID = "issuers-table"
ISSUER_LINK = "/ratings/issuers/"
RELEASE_LINK = "/ratings/press-releases/"
CARDS_CLASS = (
    "jet-listing-grid__items grid-col-desk-1 grid-col-tablet-1 grid-col-mobile-1 "
    "jet-listing-grid--712"
)
CARD_DATE_CLASS = "jet-listing-dynamic-field__content"


PAIRED, GRID, CARDS = "paired", "grid", "cards"
SPAN_STRIDE, GRID_STRIDE, CARD_STRIDE = 2, 6, 5
# What a shape's entries stand in.
ENTRY_TAGS = "span", "td", "h2"


def _choice(only=None):
    """What picks one of three expressions: the shape ``only``, known here, or the page's own."""

    def by_shape(paired, grid, cards):
        if only:
            return {PAIRED: paired, GRID: grid, CARDS: cards}[only]
        shape = F.col("shape")
        return F.when(shape == PAIRED, paired).when(shape == GRID, grid).when(shape == CARDS, cards)

    return by_shape


def _rows(pages, size, entry):
    """One row per entry of a sound page, one row with the fault of any other page."""
    pages = pages.withColumn("size", size)
    fault = F.coalesce("fault", F.when(F.col("size") < 1, F.lit("no entries")))
    pages = pages.withColumn("fault", fault)
    entries = F.when(F.col("fault").isNull(), F.transform(F.sequence(F.lit(0), F.col("size") - 1), entry))
    # An outer generator, because for an inner one Spark adds a filter "has entries" below it
    # that works the entries out a second time.
    entries = F.explode_outer(entries).alias("entry")
    rows = pages.select("source", "page_id", "html", "shape", "agency", "fault", entries)
    rows = rows.where(F.col("entry").isNotNull() | F.col("fault").isNotNull())
    html = F.when(F.col("fault").isNotNull(), F.col("html")).alias("html")
    return rows.select("source", "page_id", "shape", "agency", "fault", html, "entry.*")


def _shaped(rows):
    """The columns every extractor ends with."""
    columns = ((field.name, field.dataType.simpleString()) for field in EXTRACTED)
    return rows.selectExpr(*[f"cast({name} as {kind}) as {name}" for name, kind in columns])


def _with_texts(rows, keep=(), **columns):
    """Add the text content of HTML columns under the given names.

    They pass through a generator of one row: a later filter on them stays above it instead
    of being pushed down together with a copy of everything they are made of.
    """
    return rows.select(
        "source", "page_id", "fault", "html", "row", *keep, F.inline(F.array(tag_texts(columns)))
    )


def _missing(*names):
    """A reason that names the required columns without a value."""
    absent = F.concat_ws(", ", *[F.when(F.col(n).isNull(), F.lit(n)) for n in names])
    return F.when(absent != "", F.concat(F.lit("missing "), absent))


def _cut(pages, by_shape):
    """The part of each page that holds its entries, in pieces, and what is wrong with it.

    Pairs stand in the spans of the second table, a linked name and then comma-separated
    details; a grid in the cells of the issuers table; cards in the headings of the listing
    container, with their dates beside them.
    """
    seen = F.col("seen")
    tail = by_shape(
        after(seen, opening("table"), 2),
        after(seen, having("table", "id", GRID_TABLE_ID)),
        after(seen, having("div", "class", CARDS_CLASS)),
    )
    body, tail_col = F.col("body"), F.col("tail")
    none = F.lit(None).cast("array<string>")
    stamps = elements_having(body, "div", "class", CARD_DATE_CLASS)
    dates = F.filter(texts_of(stamps), lambda text: text != "")
    table = balanced(tail_col, "table")
    pages = pages.withColumn("seen", visible(F.col("html")))
    cut = pages.withColumn("tail", tail).withColumn("body", by_shape(table, table, balanced(tail_col, "div")))
    cut = cut.withColumn("pieces", by_shape(*[whole_elements(body, tag) for tag in ENTRY_TAGS]))
    cut = cut.withColumn("dates", by_shape(none, none, dates))
    taken = F.array_join("pieces", "")
    outside = by_shape(*[count_opening(body, tag) != count_opening(taken, tag) for tag in ENTRY_TAGS])
    differ = by_shape(F.lit(False), F.lit(False), F.size("pieces") / CARD_STRIDE != F.size("dates"))
    fault = (
        F.when(F.col("shape").isNull(), F.lit("unknown source"))
        .when(body.isNull(), by_shape(*map(F.lit, ("no second table", "no issuers table", "no listing container"))))
        .when(
            outside,
            by_shape(*map(F.lit, ("nested or open span", "nested or open cell", "nested or open heading"))),
        )
        .when(differ, F.lit("cards and dates differ in number"))
    )
    return cut.withColumn("fault", fault)


def _entries(pages, by_shape):
    """A row for each entry, with the pieces of the page that it is made of."""
    pieces = F.col("pieces")
    size = by_shape(
        F.floor((F.size(pieces) - HEADER_SPANS) / SPAN_STRIDE).cast("int"),
        F.ceil(F.size(pieces) / GRID_STRIDE).cast("int"),
        F.size("dates"),
    )

    def parts(i):
        heads = F.slice(pieces, CARD_STRIDE * i + 2, F.lit(CARD_STRIDE - 1))
        return by_shape(
            F.slice(pieces, HEADER_SPANS + SPAN_STRIDE * i + 1, F.lit(SPAN_STRIDE)),
            F.slice(pieces, GRID_STRIDE * i + 1, F.lit(GRID_STRIDE)),
            F.concat(heads, F.array(F.get("dates", i))),
        )

    return _rows(_cut(pages, by_shape), size, lambda i: F.struct(i.alias("row"), parts(i).alias("shown")))


def _linked(rows, by_shape):
    """Add the links of a grid's cells: each link's target and the link."""
    links, none = F.transform("shown", lambda cell: first(cell, "a")), F.lit(None).cast("array<string>")
    rows = rows.withColumn("links", by_shape(none, links, none))
    pair = F.transform("links", lambda link: F.struct(attribute(link, "a", "href").alias("href"), link.alias("link")))
    return rows.withColumn("linked", pair)


def _read(pages, only=None):
    """Rows of pages of any shape, or of the shape ``only``, each page read and cut once.

    In a grid, name and date are told by the prefix of their link; rating and outlook stand
    in cells 1 and 2 when these hold no link. Cards and dates are matched by position alone,
    so a page where they differ in number is reported whole: any pairing would be a guess.
    """
    by_shape = _choice(only)
    rows = _linked(_entries(pages, by_shape), by_shape)
    part = lambda i: F.get("shown", F.lit(i))

    def linked(prefix):
        return F.get(F.filter("linked", lambda x: F.startswith(x["href"], F.lit(prefix))), F.lit(0))["link"]

    def cell(at):
        return F.when(F.get("links", F.lit(at)).isNull(), first(part(at), "span"))

    none = F.lit(None).cast("string")
    rows = _with_texts(
        rows,
        keep=["shape", "agency", "shown"],
        shown_name=by_shape(first(part(0), "a"), linked(ISSUER_LINK), part(0)),
        shown_rating=by_shape(none, cell(1), part(1)),
        shown_observation=by_shape(none, none, part(2)),
        shown_pred=by_shape(none, cell(2), part(3)),
        shown_date=by_shape(none, linked(RELEASE_LINK), none),
        detail=by_shape(part(1), none, none),
    )
    rows = composite(rows.withColumn("detail", strip("detail")), "detail")
    rows = rows.withColumn("name", F.col("shown_name"))
    texts = {
        "rating": by_shape(F.col("rating"), F.col("shown_rating"), F.col("shown_rating")),
        "pred": by_shape(F.col("pred"), F.col("shown_pred"), F.col("shown_pred")),
        "observation": by_shape(F.col("observation"), F.lit(ABSENT), F.col("shown_observation")),
        "rat_date": by_shape(F.col("rat_date"), F.col("shown_date"), part(CARD_STRIDE - 1)),
    }
    rows = rows.withColumns(texts)
    lacking = by_shape(
        F.coalesce(_missing("name"), F.col("part_fault")), _missing("name", "rating", "pred", "rat_date"), none
    )
    rows = rows.withColumn("reason", F.coalesce("fault", lacking))
    raw = F.coalesce("html", by_shape(F.col("detail"), F.array_join("shown", ""), none))
    return _shaped(rows.withColumn("raw", F.when(F.col("reason").isNotNull(), raw)))


def _of_one(pages, shape, agency):
    return _read(pages.select("source", "page_id", "html", F.lit(shape).alias("shape"), F.lit(agency).alias("agency")), shape)


def extract_paired(pages, agency=AGENCY_PAIRS):
    """Second table of the page, spans in pairs: a linked name, then comma-separated details."""
    return _of_one(pages, PAIRED, agency)


def extract_grid(pages, agency=AGENCY_GRID):
    """Cells of the issuers table, six to a row."""
    return _of_one(pages, GRID, agency)


def extract_cards(pages, agency=AGENCY_CARDS):
    """Headings of the listing container, five to a card, and its dates by ordinal."""
    return _of_one(pages, CARDS, agency)


SHAPES = {AGENCY_PAIRS: PAIRED, AGENCY_GRID: GRID, AGENCY_CARDS: CARDS}


def extract(pages, shapes=None):
    """Rows of all sources, each page read once and cut once.

    ``shapes`` maps the value of ``source``, which is the agency, to the shape of its pages. A page
    of another source, or of none, is reported whole.
    """
    shapes = SHAPES if shapes is None else shapes
    shape = F.coalesce(*[F.when(F.col("source") == name, F.lit(s)) for name, s in shapes.items()])
    return _read(pages.select("source", "page_id", "html", shape.alias("shape"), F.col("source").alias("agency")))
