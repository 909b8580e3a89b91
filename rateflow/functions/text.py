"""Text expressions: trimming, splitting, entities."""

import json
from html.entities import html5, name2codepoint

import xxhash
from pyspark.sql import functions as F

from rateflow.schema import ABSENT

_BLANK = r"[\s\x1c-\x1f]"
# What may follow an ampersand: a number, or a name of up to 31 characters with its semicolon.
_NUMBER = r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
_NAMED = r"^[^\t\n\f <&#;]{1,31};"
_FREQUENT = ["quot;", "amp;", "lt;", "gt;", "nbsp;", "laquo;", "raquo;", "mdash;", "ndash;"]
_COMMON = ["quot", "lt", "gt", "nbsp", "amp"]
# Characters that no number stands for.
_CONTROLS = "[\\x01-\\x08\\x0b\\x0e-\\x1f\\x7f-\\x9f\\ufdd0-\\ufdef]"


def _key(name):
    """What ``xxhash64`` gives for a name: the table has numbers, so plans do not list the names."""
    return str(int.from_bytes(xxhash.xxh64(name.encode(), seed=42).digest(), "big", signed=True))


def _entity_table():
    """Text by reference: names with their semicolon, the frequent ones first because a map is
    searched in order, and numbers 128-159, which stand for windows-1252 characters on the web."""
    names = {name: html5[name] for name in _FREQUENT}
    for code in range(128, 160):
        names[f"#{code}"] = bytes([code]).decode("cp1252", errors="ignore") or chr(code)
    names.update((name, value) for name, value in html5.items() if name.endswith(";"))
    return json.dumps({_key(name): value for name, value in names.items()})


_ENTITIES = _entity_table()
# Names that count without a semicolon, too: the longest that a text begins with is meant.
_BARE = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
_BARE_NAME = f"^(?:{'|'.join(_BARE)})"


def strip(text):
    """Drop leading and trailing white space of any kind, line ends included."""
    return F.regexp_replace(text, rf"(?U)^{_BLANK}+|{_BLANK}+\z", "")


def split_parts(text):
    """Comma-separated parts, each trimmed."""
    return F.transform(F.split(text, ","), strip)


def or_absent(value):
    """The value, or the stored sign for "nothing given"."""
    return F.coalesce(value, F.lit(ABSENT))


def _named(chunk):
    """What followed an ampersand, and the reference it begins with ('' for none) in three forms."""
    return F.struct(
        chunk.alias("chunk"),
        F.regexp_extract(chunk, _NUMBER, 0).alias("digits"),
        F.regexp_extract(chunk, _NAMED, 0).alias("name"),
        F.regexp_extract(chunk, _BARE_NAME, 0).alias("bare"),
    )


def _numbered(part):
    """The character number of ``#65`` and ``#x41``; null for a name, 0 for nonsense."""
    digits = F.regexp_replace(part["digits"], "^#[xX]?0*|;", "")
    base16 = part["digits"].rlike("^#[xX]")
    # More than eight digits are no character, and would be too many for conv().
    digits = F.when(F.length(digits) <= 8, digits)
    number = F.when(base16, F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint")
    number = F.when(part["digits"] != "", F.coalesce(number, F.lit(0)))
    return F.struct(*[part[c].alias(c) for c in ("chunk", "digits", "name", "bare")], number.alias("number"))


def _valued(part):
    """The reference's text, null when it stands for none, and what it is written as."""
    number = part["number"]
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    coded = F.lpad(F.hex(F.when(valid, number).otherwise(0xFFFD)), 8, "0")
    char = F.decode(F.unhex(coded), "UTF-32")
    # The last two of every plane are no characters.
    none = char.rlike(_CONTROLS) | (valid & (number.bitwiseAND(0xFFFE) == 0xFFFE))
    by_number = F.when(number.isNotNull(), F.when(none, "").otherwise(char))
    known = F.from_json(F.lit(_ENTITIES), "map<string,string>")
    listed = F.when(number.isNotNull(), F.concat(F.lit("#"), number.cast("string"))).otherwise(part["name"])
    value = F.coalesce(F.try_element_at(known, F.xxhash64(listed).cast("string")), by_number)
    bare = F.try_element_at(known, F.xxhash64(F.concat(part["bare"], F.lit(";"))).cast("string"))
    written = F.when(number.isNotNull(), part["digits"]).when(value.isNotNull(), part["name"]).otherwise(part["bare"])
    return F.struct(part["chunk"].alias("chunk"), written.alias("written"), F.coalesce(value, bare).alias("value"))


def _joined(part, i):
    rest = F.substring(part["chunk"], F.length(part["written"]) + 1, F.length(part["chunk"]))
    decoded = F.coalesce(F.concat(part["value"], rest), F.concat(F.lit("&"), part["chunk"]))
    return F.when(i == 0, part["chunk"]).otherwise(decoded)


def _decoded(text):
    """``text`` with any references decoded."""
    parts = F.transform(F.transform(F.transform(F.split(text, "&"), _named), _numbered), _valued)
    return F.array_join(F.transform(parts, _joined), "")


def decode_entities(text):
    """Replace named and numeric character references, each once, from left to right, as web pages mean them.

    Texts that hold only the most frequent ones take plain replacements, ``&amp;`` last.
    """
    plain = text
    for name in _COMMON:
        plain = F.replace(plain, F.lit(f"&{name};"), F.lit(chr(name2codepoint[name])))
    others = text.rlike(rf"&(?!(?:{'|'.join(_COMMON)});)")
    return F.when(~text.contains("&"), text).when(~others, plain).otherwise(_decoded(text))


def escape_html(text):
    """Make a value safe inside an HTML message."""
    for plain, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text
