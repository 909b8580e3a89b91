"""Benchmark decontamination by templates, in DataFrame functions only.

Numbers, names and units become typed placeholders; windows of the resulting template are
joined by hash with the benchmark's. A document holds an item when enough of the item's
windows lie on one diagonal and its slots are filled consistently: one value of the item
always stands for one value of the document, so changed parameters do not hide a question.
"""

from pyspark.sql import functions as F

from rateflow.llm.rows import rows_with_ids
from rateflow.operators.joins import broadcast_if_small
from rateflow.session import stage

WINDOW = 8
# Share of an item's windows that must lie on one diagonal.
COVERED = 0.5
# Unit words that follow a number.
UNITS = (
    "km m cm mm mi ft in kg g mg lb lbs oz l ml s ms min h hr hrs hour hours minute minutes second "
    "seconds day days week weeks month months year years meter meters metre metres kilometer "
    "kilometers mile miles foot feet inch inches gram grams kilogram kilograms pound pounds liter "
    "liters litre litres dollar dollars cent cents euro euros percent degree degrees kmh mph"
).split()
NUMBER, NAME, UNIT = "", "", ""
_NUMBER = r"\p{N}+(?:[.,]\p{N}+)*"


def _marked(text):
    """The text with a mark before each name and each unit.

    A name is a capitalised word after a word or comma, so not the first of a sentence; a
    word in capitals only is an ordinary word.
    """
    text = F.regexp_replace(text, f"[{NUMBER}{NAME}{UNIT}]", " ")
    text = F.regexp_replace(text, r"(?<=[\p{L}\p{N},;])\x20(?=\p{Lu}\p{Ll})", f" {NAME}")
    unit = rf"(?<=\p{{N}})\x20?(?=(?i:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?!\p{{L}}))"
    return F.regexp_replace(text, unit, f" {UNIT}")


def _values(marked):
    """Tokens as they stand; placeholders begin with their mark or a digit."""
    return F.regexp_extract_all(marked, F.lit(rf"[{NAME}{UNIT}]?\p{{L}}+|{_NUMBER}"), F.lit(0))


def _template(marked):
    """The same tokens with placeholders in place of their values, in lower case."""
    typed = F.regexp_replace(marked, rf"([{NAME}{UNIT}])\p{{L}}+", "$1")
    typed = F.regexp_replace(typed, _NUMBER, NUMBER)
    return F.regexp_extract_all(F.lower(typed), F.lit(rf"[{NUMBER}{NAME}{UNIT}]|\p{{L}}+"), F.lit(0))


def _typed(value):
    """The template's token of one value."""
    mark = F.substring(value, 1, 1)
    number = F.when(value.rlike(r"^\p{N}"), NUMBER).otherwise(F.lower(value))
    return F.when(mark.isin(NAME, UNIT), mark).otherwise(number)


def _windows(tokens, size):
    last = F.size(tokens) - size
    places = F.when(last >= 0, F.sequence(F.lit(0), last))
    return F.transform(places, lambda i: F.xxhash64(F.slice(tokens, i + 1, F.lit(size))))


def _once(column):
    """A generator of one row, so that what follows reads the value and does not repeat it."""
    return F.explode(F.array(column))


def _exploded(rows, key, size):
    tokens = rows.select(key, _once(_template(_marked(F.col("text")))).alias("tokens"))
    windows = tokens.select(key, _windows(F.col("tokens"), size).alias("windows"))
    return windows.select(key, F.posexplode("windows").alias(f"{key}_at", "window"))


def contaminated(documents, benchmark, window=WINDOW, covered=COVERED):
    """Table ``doc_id, item_id, n_windows, n_matched, n_slots, exact``: one row per pair found.

    ``n_windows`` counts the item's windows, ``n_matched`` those on the pair's best diagonal;
    ``n_slots`` counts slots in matched windows, ``exact`` says that all their values are equal
    but for case. Null, empty and short texts and items of
    fewer tokens than a window match nothing, and rows without an id cannot be reported.
    A repeated doc_id is one document here. Only ids and texts are read.
    """
    documents = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    known = _exploded(items, "item_id", window)
    sizes = known.groupBy("item_id").agg((F.max("item_id_at") + 1).alias("n_windows"))
    known = broadcast_if_small(known.dropDuplicates(["item_id", "item_id_at", "window"]))
    matches = _exploded(documents, "doc_id", window).join(known, "window")
    matches = matches.withColumn("shift", F.col("doc_id_at") - F.col("item_id_at"))
    diagonals = matches.groupBy("doc_id", "item_id", "shift").agg(F.count_distinct("item_id_at").alias("n_matched"))
    found = diagonals.join(broadcast_if_small(sizes), "item_id").where(F.col("n_matched") >= covered * F.col("n_windows"))
    return _consistent(documents, items, stage(found, "matches"), window)


def _consistent(documents, items, found, window):
    """Pairs whose aligned slots map each of the item's values to one value, best diagonal each.

    Only slots in matched windows count, and case does not: beyond them the document goes on
    with its own text.
    """
    texts = documents.join(broadcast_if_small(found), "doc_id")
    sides = texts.select("doc_id", "item_id", "shift", "n_windows", "n_matched", _once(_values(_marked(F.col("text")))).alias("mine"))
    theirs = items.select("item_id", _once(_values(_marked(F.col("text")))).alias("theirs"))
    sides = sides.join(broadcast_if_small(theirs), "item_id")
    first = F.greatest(F.lit(0), -F.col("shift"))
    length = F.least(F.size("theirs") - first, F.size("mine") - F.col("shift") - first)
    pairs = F.arrays_zip(
        F.slice("theirs", first + 1, length).alias("theirs"),
        F.slice("mine", first + F.col("shift") + 1, length).alias("mine"),
    )
    slot = rf"^[{NAME}{UNIT}\p{{N}}]"
    sides = sides.withColumn("pairs", _once(pairs))
    same = F.transform("pairs", lambda p: F.when(_typed(p["theirs"]) == _typed(p["mine"]), "1").otherwise("0"))
    sides = sides.withColumn("same", _once(F.array_join(same, "")))

    def matched(i):
        # Every window among these places holds place i.
        start = F.greatest(F.lit(0), i - (window - 1))
        return F.contains(F.substr("same", start + 1, i + window - start), F.lit("1" * window))

    slots = F.filter("pairs", lambda p, i: p["theirs"].rlike(slot) & p["mine"].rlike(slot) & matched(i))
    lowered = F.transform(slots, lambda p: F.struct(F.lower(p["theirs"]).alias("theirs"), F.lower(p["mine"]).alias("mine")))
    sides = sides.withColumn("slots", _once(lowered)).withColumn("n_slots", F.size("slots"))
    sides = sides.withColumn("slots", F.array_distinct("slots"))
    sides = sides.where(F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda p: p["theirs"]))))
    exact = F.forall("slots", lambda p: p["theirs"] == p["mine"])
    best = F.max_by(F.struct("n_windows", "n_matched", "n_slots", exact.alias("exact")), F.struct("n_matched", -F.col("shift")))
    return sides.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def without_contaminated(documents, benchmark):
    """``documents`` without the rows that hold a benchmark item; columns as they are.

    Rows that share an id are judged each by its own text, and so are rows without one.
    """
    rows, own, _ = rows_with_ids(documents)
    found = contaminated(rows, benchmark).select("doc_id").distinct()
    clean = rows.join(broadcast_if_small(stage(found, "matches")), "doc_id", "left_anti")
    return clean.withColumn("doc_id", F.col(own)).select(documents.columns)
