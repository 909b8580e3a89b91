"""Secrets by character Markov models, in DataFrame functions only.

Fixed forms find the base spans, which always stay. Long tokens of letters and digits are
further candidates: the log-likelihood of a first-order model of random strings against one
of ordinary identifiers decides. Both are trained here, on the values of base spans and on
the words of the same documents.
"""

from pyspark.sql import functions as F

# The kinds in their order and the forms of the base spans.
ASSIGN = (
    r"(?i:(?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# Further candidates: tokens with a digit and a letter.
TOKEN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,200}(?![A-Za-z0-9+/_-])"
WORD = r"[A-Za-z][A-Za-z0-9_-]{3,}"
KINDS = ("assign", "access", "hex", "random")
# A token is a secret from this mean log-likelihood ratio a character on.
RATIO = 0.5
# Characters are 7-bit codes; a pair of them is one of 2^14.
PAIRS = 128 * 128
SMOOTH = 0.5
# Bounds of the labelled samples: values, and documents whose words are ordinary.
SAMPLE = 20_000
SAMPLE_DOCUMENTS = 2_000


_SPANS = "array<struct<start:int,stop:int,value:string>>"


def _once(column):
    """A generator of one row, so that what follows reads the value and does not repeat it."""
    return F.explode(F.array(column))


def _pieces(text, form, possible):
    """Matches of ``form`` and the pieces of the text around them; null where none is possible."""
    found = F.regexp_extract_all(text, F.lit(form), F.lit(0))
    return F.when(possible & text.rlike(form), F.struct(F.split(text, form, -1).alias("around"), found.alias("found")))


def _located(pieces):
    """Start, end and value of each match, in code points."""
    steps = F.arrays_zip(
        F.slice(pieces["around"], 1, F.size(pieces["found"])).alias("before"), pieces["found"].alias("value")
    )

    def step(done, pair):
        last = F.coalesce(F.try_element_at(done, F.lit(-1))["stop"], F.lit(0))
        start = last + F.length(pair["before"])
        stop = start + F.length(pair["value"])
        return F.concat(done, F.array(F.struct(start.alias("start"), stop.alias("stop"), pair["value"].alias("value"))))

    return F.coalesce(F.aggregate(steps, F.array().cast(_SPANS), step), F.array().cast(_SPANS))


def _values(text, form, group=0):
    return F.regexp_extract_all(text, F.lit(form), F.lit(group))


def _pair_codes(value):
    """Codes of neighbouring characters of a value, other than 7-bit ones as 127."""
    code = lambda i: F.least(F.ascii(F.substr(value, i, F.lit(1))), F.lit(127))
    last = F.length(value) - 1
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: code(i) * 128 + code(i + 1))


def train(documents, sample=SAMPLE):
    """Log-likelihood ratio of each pair of neighbouring characters, as an array of 2^14 numbers.

    The labelled samples are picked by hash: at most ``sample`` values of base spans as random
    strings, and as ordinary ones the words of at most ``SAMPLE_DOCUMENTS`` documents without
    any, ``sample`` of each. Without either kind every ratio is 0.
    """
    text = F.col("text")
    suspect = text.rlike(f"{HEX}|{ACCESS}|{ASSIGN}")
    strings = F.concat(
        F.filter(_values(text, ASSIGN, 1), lambda v: F.length(v) >= 8), _values(text, ACCESS), _values(text, HEX)
    )
    documents = documents.select("text").where("text is not null")
    random = documents.where(suspect).select(F.explode(strings).alias("value")).distinct()
    random = random.orderBy(F.xxhash64("value"), "value").limit(sample)
    # The texts are drawn by their hashes alone, which are small enough to be sorted in one task.
    mark = F.xxhash64("text").alias("mark")
    drawn = documents.where(~suspect).select(mark).distinct().orderBy("mark").limit(SAMPLE_DOCUMENTS)
    words = documents.select("text", mark).join(F.broadcast(drawn), "mark", "left_semi")
    words = words.select(F.explode(F.slice(_values(text, WORD), 1, sample)).alias("value"))
    counts = []
    for label, values in (("random", random), ("ordinary", words.distinct())):
        pairs = values.select(F.explode(_pair_codes(F.col("value"))).alias("pair"))
        counts.append(pairs.groupBy("pair").count().select("pair", "count", F.lit(label).alias("label")))
    table = [[0] * PAIRS, [0] * PAIRS]
    for row in counts[0].union(counts[1]).collect():
        table[row["label"] == "random"][row["pair"]] = row["count"]
    return _ratios(*table)


def _ratios(ordinary, random):
    import math

    if not sum(ordinary) or not sum(random):
        return [0.0] * PAIRS
    out = []
    for first in range(128):
        sides = [t[first * 128 : first * 128 + 128] for t in (ordinary, random)]
        totals = [sum(s) + SMOOTH * 128 for s in sides]
        out += [
            math.log((sides[1][i] + SMOOTH) / totals[1]) - math.log((sides[0][i] + SMOOTH) / totals[0])
            for i in range(128)
        ]
    return out


def detect(documents, ratios):
    """``doc_id`` with counts and hash of the base spans and all spans, for every row.

    Offsets are code points, ends exclusive; spans are listed by start, then kind. A random
    token stays out where it overlaps a base span. A null or empty text has no spans,
    repeated rows give repeated rows, other columns are not read.
    """
    spark = documents.sparkSession
    model = spark.createDataFrame([(ratios,)], "ratios array<double>")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select("doc_id", text.alias("text"))
    forms = {
        "assign": (ASSIGN, F.col("text").rlike("[:=]")),
        "access": (ACCESS, F.contains("text", F.lit("AKIA"))),
        "hex": (HEX, F.col("text").rlike("[0-9a-f]{32}")),
        "random": (TOKEN, F.col("text").rlike("[0-9]")),
    }
    pieces = rows
    for kind, (form, possible) in forms.items():
        pieces = pieces.select("*", _once(_pieces(F.col("text"), form, possible)).alias(kind))
    pieces = pieces.drop("text")
    for kind in forms:
        pieces = pieces.select(*[c for c in pieces.columns if c != kind], _once(_located(F.col(kind))).alias(kind))
    kept = pieces.join(F.broadcast(model)).select(
        "doc_id",
        F.filter("assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 1)) >= 8).alias("assign"),
        "access",
        "hex",
        F.filter("random", lambda s: _ratio(s["value"]) >= RATIO).alias("random"),
    )
    ranked = [_ranked(kind, i) for i, kind in enumerate(KINDS)]
    base = F.array_sort(F.concat(*ranked[:3]))
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]]
    found = kept.select("doc_id", *counts, _once(base).alias("base"), ranked[3].alias("random"))
    apart = F.filter("random", lambda s: ~F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    every = F.array_sort(F.concat("base", apart))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(every).alias("spans")
    )


def _ranked(kind, rank):
    """A kind's spans with what they are sorted by first."""
    return F.transform(
        kind, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["stop"].alias("stop"), F.lit(kind).alias("kind"))
    )


def _ratio(value):
    """Mean ratio of a value's pairs, by the model's array in the column ``ratios``."""
    total = F.aggregate(_pair_codes(value), F.lit(0.0), lambda done, pair: done + F.get("ratios", pair))
    return total / F.greatest(F.lit(1), F.length(value) - 1)


def _listed(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
