import html
import random
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from rateflow.functions import (
    attribute,
    balanced,
    decode_entities,
    dots_to_dashes,
    escape_html,
    format_day,
    or_absent,
    parse_day,
    parse_run_date,
    split_parts,
    strip,
    tag_text,
    visible,
)


def value(spark, text, make):
    return spark.createDataFrame([(text,)], "t string").select(make(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "text, plain",
    [
        ("no references", "no references"),
        ("Банк &amp; Ко", "Банк & Ко"),
        ("&amp;lt;", "&lt;"),
        ("&quot;А&quot;&nbsp;&laquo;Б&raquo;", '"А"\xa0«Б»'),
        ("&#1041;&#x430;&#X43d;к", "Банк"),
        ("&#128512;", "😀"),
        ("&#150;", "–"),
        ("&#0;&#xD800;&#99999999999999999999;", "���"),
        ("AT&T & Co &unknown; &", "AT&T & Co &unknown; &"),
        ("&lt b &copy.", "< b ©."),
        ("&amp;&amp;", "&&"),
        ("", ""),
        (None, None),
    ],
)
def test_decode_entities(spark, text, plain):
    assert value(spark, text, decode_entities) == plain


def test_references_equal_the_standard_decoder(spark):
    """All names with and without semicolon, numbers of every kind, and random texts of pieces of both."""
    pick = random.Random(4)
    names = sorted(html5)
    numbers = [0, 1, 9, 11, 13, 31, 65, 127, 128, 129, 150, 160, 0xD7FF, 0xD800, 0xFDD0, 0xFFFE, 0xFFFF, 0x1F600, 0x1FFFE, 0x10FFFF, 0x110000, 10**25]
    pieces = [f"&{n}" for n in names[::9]] + [f"&#{n}{e}" for n in numbers for e in ("", ";")] + [f"&#x{n:x};" for n in numbers]
    pieces += ["&", "&&", "&;", "&#;", "&#x;", "&copyright;", "&notit;", "&notin", "&amp;lt;", "&AMP", "&Xyz;", "&a b;", "текст", "é", "1", ";", " ", "\n", "x" * 40]
    texts = [f"a&{n}b" for n in names] + ["".join(pick.choice(pieces) for _ in range(pick.randint(1, 8))) for _ in range(1500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", decode_entities(F.col("t")).alias("plain")).collect()
    wrong = [(r.t, r.plain, html.unescape(r.t)) for r in rows if r.plain != html.unescape(r.t)]
    assert len(rows) == len(texts) and wrong == []


def test_strip_drops_any_white_space(spark):
    assert value(spark, "\r\n\t\xa0  a b \x1f\n", strip) == "a b"


def test_split_parts_trims_each(spark):
    assert value(spark, " a ,\nb,, c\t", split_parts) == ["a", "b", "", "c"]


def test_escape_html(spark):
    assert value(spark, "<b>&amp;", escape_html) == "&lt;b&gt;&amp;amp;"


def test_absent(spark):
    assert value(spark, None, or_absent) == "-"


def test_tag_text_keeps_white_space_and_bare_angles(spark):
    assert value(spark, '<b title="a>b"> x </b><br/>1 < 2 &gt; 0<!x>', tag_text) == " x 1 < 2 > 0"


def test_visible_drops_comments_scripts_styles(spark):
    page = "a<!-- <b> -->b<SCRIPT x='1'>var t='</p>';</script >c<style>p{}</style>d<scripted>e"
    assert value(spark, page, visible) == "abcd<scripted>e"


def test_balanced_stops_at_the_matching_end(spark):
    page = "<div>a<div>b</div><DIV>c</DIV>d</div>e</div>"
    assert value(spark, page, lambda c: balanced(c, "div")) == "<div>a<div>b</div><DIV>c</DIV>d"


def test_balanced_takes_the_rest_of_an_open_element(spark):
    assert value(spark, "<div>a<div>b</div>c", lambda c: balanced(c, "div")) == "<div>a<div>b</div>c"


@pytest.mark.parametrize(
    "tag, href",
    [
        ('<a href="/x y">', "/x y"),
        ("<A class='b>c' HREF = '/x'>", "/x"),
        ("<a href=/x>", "/x"),
        ("<a data-href='/no' title=\" href='/no'\" href='/x'>", "/x"),
        ("<a name='x'>", None),
        ("<a href=''>", None),
    ],
)
def test_attribute(spark, tag, href):
    assert value(spark, tag, lambda c: attribute(c, "a", "href")) == href


@pytest.mark.parametrize(
    "text, day",
    [
        ("15.01.2024", "2024-01-15"),
        ("5.1.2024", "2024-01-05"),
        ("5-1.2024", "2024-01-05"),
        ("5.1.24", None),
        ("31.02.2024", None),
        ("2024-01-15", None),
        (" 15.01.2024", None),
        ("", None),
        (None, None),
    ],
)
def test_day_text(spark, text, day):
    assert value(spark, text, lambda c: format_day(parse_day(dots_to_dashes(c)))) == day


def test_run_date():
    assert str(parse_run_date("2024-01-15")) == "2024-01-15"
    assert parse_run_date(parse_run_date("2024-01-15")) == parse_run_date("2024-01-15")
