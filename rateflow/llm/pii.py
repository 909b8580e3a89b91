"""Personal data by a semi-Markov conditional random field over candidate spans.

Patterns of fixed form find the base spans, which always stay. A more generous generator
proposes further whole spans (numbers without a country code, spelled-out addresses); the
field scores each candidate by features of the whole span and dynamic programming over
entities of bounded length chooses boundaries and kinds together. It is trained here, on
snippets of the given documents whose base spans are the labels.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rateflow.llm.arrays import batch, small_batches

# The kinds in their order and the forms of the base spans.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Further candidates, by the kind they may be.
LOOSE = (
    ("phone", re.compile(r"(?<![0-9A-Za-z+])\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z+])00[1-9][0-9]{0,2}[\x20.-][0-9][0-9\x20.-]{5,14}[0-9](?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20.-]{1,2}[0-9]{4}){3}(?![0-9])")),
    (
        "email",
        re.compile(
            r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,40}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,40}"
            r"(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]{1,20}|\.[A-Za-z0-9-]{1,20}){1,4}"
        ),
    ),
)
LONGEST = 96
FEATURES = (
    "email",
    "ip",
    "card",
    "phone",
    "card:luhn",
    "card:digits",
    "phone:plus",
    "phone:digits",
    "phone:grouped",
    "email:at",
    "email:dots",
    "ip:parts",
    "edge:word",
    "edge:digit",
    "after:same",
)
SNIPPETS = 4000
SNIPPET_SIDE = 60


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d)
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def digits_of(text):
    return [c for c in text if "0" <= c <= "9"]


def _emails(text):
    at, last = text.find("@"), 0
    while at >= 0:
        found = DOMAIN.match(text, at + 1)
        begin = at
        if found:
            while begin > last and text[begin - 1] in LOCAL:
                begin -= 1
            if begin < at:
                yield begin, found.end(), True
                last = found.end()
        at = text.find("@", max(at + 1, last))


def _ips(text):
    for run in DOTTED.finditer(text):
        parts = run.group().split(".")
        if len(parts) < 4:
            continue
        ends = np.cumsum([len(p) + 1 for p in parts]) + run.start() - 1
        for i in range(0, len(parts) - 3, 4):
            begin = run.start() if i == 0 else int(ends[i - 1]) + 1
            small = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[i : i + 4])
            yield begin, int(ends[i + 3]), small


def _cards(text):
    for run in CARD.finditer(text):
        digits = digits_of(run.group())
        yield run.start(), run.end(), 16 <= len(digits) <= 19 and luhn(digits)


def _phones(text):
    for run in PHONE.finditer(text):
        yield run.start(), run.end(), 8 <= len(digits_of(run.group())) <= 15


def matches(text):
    """Matches of the base forms as ``kind, start, end, passed``, by kind, then start."""
    has_digit = any(d in text for d in "0123456789")
    finders = (("email", _emails, "@" in text), ("ip", _ips, has_digit), ("card", _cards, has_digit))
    for kind, find, possible in (*finders, ("phone", _phones, "+" in text)):
        if possible:
            for begin, end, passed in find(text):
                yield kind, begin, end, passed


def candidates(text):
    """Spans that may be personal data: the base matches, good or not, and looser forms."""
    found = {(k, a, b): ok for k, a, b, ok in matches(text)}
    for kind, form in LOOSE:
        if kind != "email" or "at" in text:
            for m in form.finditer(text):
                found.setdefault((kind, *m.span()), False)
    return found


def span_features(text, kind, begin, end):
    """Features of a whole candidate span, as positions in ``FEATURES`` with values."""
    span = text[begin:end]
    digits = digits_of(span)
    on = {kind: 1.0}
    if kind == "card":
        on["card:luhn"] = 1.0 if luhn(digits) else -1.0
        on["card:digits"] = 1.0 if 16 <= len(digits) <= 19 else -1.0
    elif kind == "phone":
        on["phone:plus"] = 1.0 if span.startswith("+") else 0.0
        on["phone:digits"] = 1.0 if 8 <= len(digits) <= 15 else -1.0
        on["phone:grouped"] = 1.0 if re.search(r"[0-9]{3}[)\x20.-]+[0-9]{3}[\x20.-][0-9]{4}$", span) else 0.0
    elif kind == "email":
        on["email:at"] = 1.0 if re.search(r"@|[\[(]at[\])]", span) else -1.0
        on["email:dots"] = 1.0 if re.search(r"[.]|dot", span.rpartition("@")[2]) else -1.0
    else:
        on["ip:parts"] = 1.0 if all(int(p or 0) <= 255 for p in span.split(".") if len(p) < 9) else -1.0
    before, after = text[begin - 1 : begin], text[end : end + 1]
    on["edge:word"] = float(before.isalpha()) + float(after.isalpha())
    on["edge:digit"] = float(before.isdigit()) + float(after.isdigit())
    return on


def decode(text, spans, weights):
    """The best set of spans that do not overlap: ``kind, start, end`` by start.

    The state after a span is its kind; a gap costs nothing. Spans over ``LONGEST``
    characters are no candidates, so each step looks back over bounded entities.
    """
    spans = sorted((s for s in spans if s[2] - s[1] <= LONGEST), key=lambda s: (s[2], s[1]))
    ends = [s[2] for s in spans]
    # best[i] is the best score of the first i spans, with the last kind and the way there.
    best = [(0.0, None, ())]
    for i, (kind, begin, end) in enumerate(spans):
        before = int(np.searchsorted(ends[:i], begin, side="right"))
        score, last, way = best[before]
        own = sum(weights.get(n, 0.0) * v for n, v in span_features(text, kind, begin, end).items())
        own += weights.get("after:same", 0.0) * (last == kind)
        taken = (score + own, kind, (way, spans[i]))
        best.append(taken if taken[0] > best[-1][0] else best[-1])
    chosen, way = [], best[-1][2]
    while way:
        way, span = way
        chosen.append(span)
    return chosen[::-1]


def fit(snippets, rounds=8):
    """Averaged structured perceptron over snippets; the labels are their base spans.

    Returns weights by feature. Without snippets every weight is 0 and nothing is added.
    """
    weights, totals, step = dict.fromkeys(FEATURES, 0.0), dict.fromkeys(FEATURES, 0.0), 0
    prepared = [(text, candidates(text)) for text in snippets]
    for _ in range(rounds):
        for text, found in prepared:
            gold = decode(text, [s for s, ok in found.items() if ok], {k: 1.0 for k in KINDS})
            guess = decode(text, list(found), weights)
            step += 1
            if gold != guess:
                for sign, spans in ((1.0, gold), (-1.0, guess)):
                    last = None
                    for span in spans:
                        for name, value in span_features(text, *span).items():
                            weights[name] += sign * value
                            totals[name] += sign * value * step
                        weights["after:same"] += sign * (last == span[0])
                        totals["after:same"] += sign * (last == span[0]) * step
                        last = span[0]
    return {n: weights[n] - totals[n] / max(1, step + 1) for n in FEATURES}


def find(text, weights):
    """Base spans and all spans of a text, each as ``kind, start, end`` by kind, then start."""
    possible = "@" in text or "[at]" in text or "(at)" in text or any(d in text for d in "0123456789")
    if not possible:
        return [], []
    found = candidates(text)
    base = [s for s, ok in found.items() if ok]
    fixed = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in fixed]
    reach = np.maximum.accumulate([b for _, b in fixed]) if fixed else []
    more = []
    for span in decode(text, list(found), weights):
        at = int(np.searchsorted(starts, span[2], side="left"))
        if not at or reach[at - 1] <= span[1]:
            more.append(span)
    order = {k: i for i, k in enumerate(KINDS)}
    by_kind = lambda s: (order[s[0]], s[1], s[2])
    return sorted(base, key=by_kind), sorted({*base, *more}, key=by_kind)


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _snippets(batches):
    for rows in batches:
        out = []
        for text in rows.column("text").to_pylist():
            for _, begin, end, _ in matches(text or ""):
                if end - begin <= LONGEST:
                    out.append(text[max(0, begin - SNIPPET_SIDE) : end + SNIPPET_SIDE])
        yield batch(text=pa.array(out, pa.string()))


def train(documents, snippets=SNIPPETS):
    """Weights learned from at most ``snippets`` snippets around matches, picked by their hash."""
    found = documents.where(F.col("text").rlike("[0-9@]")).select("text").mapInArrow(_snippets, "text string")
    picked = found.distinct().orderBy(F.xxhash64("text"), "text").limit(snippets)
    return fit([r["text"] for r in picked.collect()])


RESULT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _detect(weights, kept):
    def run(batches):
        for rows in batches:
            counts, hashes, spans = [], [], []
            for text in rows.column("text").to_pylist():
                base, every = find(text or "", weights)
                kinds = [s[0] for s in base]
                counts.append([kinds.count(k) for k in KINDS])
                hashes.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(every))
            counts = np.array(counts, np.int64).reshape(-1, len(KINDS))
            numbers = {f"n_{k}": counts[:, i] for i, k in enumerate(KINDS)}
            rest = {n: rows.column(n) for n in kept}
            yield batch(**rest, **numbers, base_sha256=pa.array(hashes, pa.string()), spans=pa.array(spans, pa.string()))

    return run


def detect(documents, weights):
    """``doc_id`` with the counts and hash of base spans and with all spans, for every row.

    Offsets are code points, ends exclusive. A null or empty text has no spans. Repeated rows
    give repeated rows. Other columns are not read.
    """
    small_batches(documents.sparkSession)
    rows = documents.select("doc_id", "text")
    schema = StructType([rows.schema["doc_id"], *_schema(rows)])
    return rows.mapInArrow(_detect(weights, ["doc_id"]), schema)


def _schema(rows):
    return [StructField(f.name, f.dataType) for f in rows.sparkSession.createDataFrame([], RESULT).schema]


def masked_text(text, spans):
    """The text with each span replaced by its kind in brackets, overlapping ones as one."""
    out, at = [], 0
    for kind, begin, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if begin >= at:
            out += [text[at:begin], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask(documents, weights):
    """``documents`` with every span of ``text`` masked; columns as they are, null stays null.

    ``n_chars``, where there is one, counts the new text.
    """

    def run(batches):
        for rows in batches:
            texts = [t if t is None else masked_text(t, find(t, weights)[1]) for t in rows.column("text").to_pylist()]
            rest = {n: rows.column(n) for n in rows.schema.names}
            yield batch(**{**rest, "text": pa.array(texts, pa.string())})

    changed = documents.mapInArrow(run, documents.schema)
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.length("text").cast(kind))
    return changed
