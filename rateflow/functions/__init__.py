from rateflow.functions.dates import dots_to_dashes, format_day, parse_day, parse_run_date
from rateflow.functions.html import (
    attribute,
    balanced,
    element,
    elements,
    tag_text,
    tag_texts,
    texts_of,
    visible,
)
from rateflow.functions.messages import digest_item, lookup_item, summary_line
from rateflow.functions.text import decode_entities, escape_html, or_absent, split_parts, strip

__all__ = [
    "attribute",
    "balanced",
    "decode_entities",
    "digest_item",
    "dots_to_dashes",
    "element",
    "elements",
    "escape_html",
    "format_day",
    "lookup_item",
    "or_absent",
    "parse_day",
    "parse_run_date",
    "split_parts",
    "strip",
    "summary_line",
    "tag_text",
    "tag_texts",
    "texts_of",
    "visible",
]
