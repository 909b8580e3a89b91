"""Expressions over HTML text.

Elements are cut where their depth is zero again: a pattern takes the elements of the same
tag inside along. It knows a bounded number of levels, so the extractors check that every
opening tag of the element they read lies in an element, and report the page when it does not.
"""

import re

from pyspark.sql import functions as F

from rateflow.functions.text import decode_entities

# The rest of a tag after its name; quoted values may hold ">".
_TAG_REST = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>"""
_ANY_TAG = rf"(?s)<[/!?]?[a-zA-Z]{_TAG_REST}|<[/!?]?[a-zA-Z][^>]*>"
_HIDDEN = r"(?is)<(?:!--.*?-->|script[\s>].*?</script\s*>|style[\s>].*?</style\s*>)"


# Elements of one tag in each other that are followed; more are no listing.
LEVELS = 8


def opening(tag):
    """Pattern of an opening tag."""
    return rf"<{tag}(?=[\s>/]){_TAG_REST}"


def closing(tag):
    """Pattern of a closing tag."""
    return rf"</{tag}(?=[\s>])[^>]*>"


def content(tag, levels=LEVELS):
    """Pattern of what stands up to the closing tag that belongs here.

    Elements of the tag inside are taken whole, in each other up to ``levels`` deep. Every
    part is taken once and never given back, so the pattern runs over a text in one pass.
    """
    other = rf"[^<]++|<(?!/?{tag}[\s/>])"
    inside = rf"(?:{other})*+"
    for _ in range(levels):
        inside = rf"(?:{other}|{opening(tag)}{inside}{closing(tag)})*+"
    return inside


def element(tag, begins=None, levels=LEVELS):
    """Pattern of an element with the elements of the same tag inside it; ``begins`` narrows its opening tag."""
    narrowed = rf"(?={begins})" if begins else ""
    return rf"(?is){narrowed}{opening(tag)}{content(tag, levels)}{closing(tag)}"


def having(tag, name, value):
    """Pattern at the start of an opening tag whose attribute is exactly ``value``."""
    spaced = r"\s+".join(re.escape(word) for word in value.split())
    return rf"""<{tag}(?=\s)[^>]*?\s{name}\s*=\s*(?:"\s*{spaced}\s*"|'\s*{spaced}\s*'|{spaced}(?=[\s>]))"""


def having_word(tag, name, word):
    """Pattern at the start of an opening tag whose attribute holds ``word``."""
    word = rf"""(?:[^"'>]*\s)?{re.escape(word)}(?:\s[^"'>]*)?"""
    return rf"""<{tag}(?=\s)[^>]*?\s{name}\s*=\s*(?:"{word}"|'{word}'|{word}(?=[\s>]))"""


def visible(html):
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, _HIDDEN, "")


def after(html, start, nth=1):
    """The page from the n-th match of ``start`` on; null when there are fewer."""
    pieces = F.split(F.concat(F.lit(" "), html), rf"(?is)(?={start})", nth + 1)
    return F.get(pieces, F.lit(nth))


def balanced(html, tag):
    """Cut ``html``, which begins with an opening ``tag``, at the matching closing tag.

    Walks the pieces between tags of that name once, keeping depth and length only.
    """
    pieces = F.split(html, rf"(?i)(?=</?{tag}[\s>/])")

    def step(seen, piece):
        closing = piece.startswith("</")
        last = closing & (seen["depth"] == 1)
        depth = seen["depth"] + F.when(closing, -1).otherwise(1)
        grown = F.struct(
            F.when(last, 0).otherwise(depth).alias("depth"),
            (seen["size"] + F.when(last, 0).otherwise(F.length(piece))).alias("size"),
            last.alias("closed"),
        )
        return F.when(seen["closed"], seen).otherwise(grown)

    start = F.struct(
        F.lit(0).alias("depth"), F.lit(0).alias("size"), F.lit(False).alias("closed")
    )
    return F.substring(html, F.lit(1), F.aggregate(pieces, start, step, lambda end: end["size"]))


def elements(html, tag):
    """The elements of a tag in page order, those inside others within them."""
    return F.regexp_extract_all(html, F.lit(element(tag)), 0)


def elements_having(html, tag, name, word):
    """The elements of a tag whose attribute holds ``word``."""
    return F.regexp_extract_all(html, F.lit(element(tag, having_word(tag, name, word))), 0)


def count_opening(html, tag):
    """How many elements of the tag the text opens."""
    return F.regexp_count(html, F.lit(rf"(?is){opening(tag)}"))


def count_closing(html, tag):
    """How many elements of the tag the text closes."""
    return F.regexp_count(html, F.lit(rf"(?is){closing(tag)}"))


def whole_elements(html, tag):
    """The elements of a tag, none at all where some tag stays open or closes nothing.

    Where the numbers differ the page is not searched, so a broken one costs one pass too.
    """
    found = F.when(count_opening(html, tag) == count_closing(html, tag), elements(html, tag))
    return F.coalesce(found, F.array().cast("array<string>"))


def first(html, tag):
    """The first element of a tag, or null."""
    return F.regexp_substr(html, F.lit(element(tag)))


def attribute(html, tag, name):
    """Value, as written, of an attribute of the opening ``tag`` that ``html`` begins with."""
    before = rf"""(?:[^>"'\s]++|\s++(?!{name}\s*=)|"[^"]*+"|'[^']*+')*+"""
    value = r"""("[^"]*"|'[^']*'|[^\s>"']+)"""
    found = F.regexp_extract(html, rf"(?is)^<{tag}(?=[\s>/]){before}\s+{name}\s*=\s*{value}", 1)
    return F.nullif(F.btrim(found, F.lit("\"'")), F.lit(""))


def without_tags(html):
    """The text between tags, character references still coded."""
    return F.regexp_replace(html, _ANY_TAG, "")


def tag_text(html):
    """Text content: tags dropped, character references decoded, white space kept."""
    return decode_entities(without_tags(html))


def texts_of(htmls):
    """The text content of each element of an array."""
    return F.transform(F.transform(htmls, without_tags), decode_entities)


def tag_texts(columns):
    """The text content of several columns as one struct.

    One lambda over an array of them keeps the plan small: the expression stands in it once.
    """
    texts = texts_of(F.array(*columns.values()))
    return F.struct(*[F.get(texts, F.lit(i)).alias(name) for i, name in enumerate(columns)])
