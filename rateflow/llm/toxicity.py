"""Toxicity by two Kneser-Ney character models that share their lower orders.

Texts are folded to an alphabet of 30 symbols, so five symbols are one of 30^5 codes and
every table below has at most four times that many rows, whatever the corpus. Five-symbol
counts are kept for each class over all labelled training rows; the fourth order counts distinct
continuations in each class, the orders below pool both classes. A text's evidence is the
log-likelihood of the toxic model minus that of the ordinary one.
"""

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from rateflow.llm.arrays import batch, flat, slices, small_batches
from rateflow.operators.joins import broadcast_if_small
from rateflow.session import stage

ORDER = 5
SYMBOLS = 30
DISCOUNT = 0.75
WINDOW = 24
# Two halves of the training rows and two classes.
MARKS = 4
# Calibration uses at most so many labelled rows.
CALIBRATION_ROWS = 20_000
FEATURES = ("mean_ratio", "peak_ratio", "strong_share")
STRONG = 8.0


def _fold_table():
    """Bytes as symbols: letters 1-26, digits 27, bytes beyond ASCII 28, white space 0, rest 29."""
    table = np.full(256, 29, np.int32)
    table[128:] = 28
    table[[32, *range(9, 14)]] = 0
    table[48:58] = 27
    for i in range(26):
        table[[65 + i, 97 + i]] = i + 1
    return table


FOLD = _fold_table()


def symbols(data, offsets):
    """Symbols of texts and where each begins: a gap around each, runs of gaps as one."""
    lengths = np.diff(offsets)
    shifted = offsets + 2 * np.arange(len(offsets))
    out = np.zeros(shifted[-1], np.int32)
    place = np.arange(len(data)) + np.repeat(2 * np.arange(len(lengths)) + 1, lengths)
    folded = FOLD[data]
    # Marks are no part of a word: "word***" and "word" read alike.
    folded[folded == 29] = 0
    out[place] = folded
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    keep[shifted[:-1]] = True
    before = np.concatenate(([0], np.cumsum(keep)))
    return out[keep], before[shifted]


def codes(values, order):
    count = max(0, len(values) - order + 1)
    out = np.zeros(count, np.int32)
    for j in range(order):
        out = out * SYMBOLS + values[j : j + count]
    return out


def _inside(begins, order, total):
    """Marks the n-grams that lie in one text."""
    keep = np.ones(max(0, total - order + 1), bool)
    for back in range(1, order):
        at = begins[1:-1] - back
        keep[at[(at >= 0) & (at < len(keep))]] = False
    return keep


def _count(batches):
    """Five-symbol counts of each class and half, summed within the task."""
    held, size = [], 0
    for rows in slices(batches):
        values, begins = symbols(*flat(rows.column("text")))
        marks = rows.column("mark").to_numpy(zero_copy_only=False).astype(np.int64)
        keep = _inside(begins, ORDER, len(values))
        grams = codes(values, ORDER)[keep].astype(np.int64)
        label = np.repeat(marks, np.diff(begins))[: len(keep)][keep]
        found, counts = np.unique(grams * MARKS + label, return_counts=True)
        held.append((found, counts))
        size += len(found)
        if size > 2_000_000:
            held = [_merge(held)]
            size = len(held[0][0])
            if size > 2_000_000:
                yield _counted(held[0])
                held, size = [], 0
    if held:
        yield _counted(_merge(held))


def _merge(parts):
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, weights=np.concatenate([c for _, c in parts])).astype(np.int64)


def _counted(part):
    keys, counts = part
    return batch(gram=(keys // MARKS).astype(np.int32), mark=(keys % MARKS).astype(np.int32), n=counts)


def ngram_counts(labelled):
    """Table ``gram, mark, n`` over all rows of ``labelled(text, mark)``; marks are below ``MARKS``."""
    rows = labelled.select("text", F.col("mark").cast("long").alias("mark"))
    counted = rows.mapInArrow(_count, "gram int, mark int, n long")
    return counted.groupBy("gram", "mark").agg(F.sum("n").alias("n"))


def _level(counts, below):
    """Kneser-Ney at one order: probabilities of all its n-grams and back-off of each context."""
    table = counts.reshape(-1, SYMBOLS)
    total = table.sum(1)
    back = np.where(total > 0, DISCOUNT * (table > 0).sum(1) / np.maximum(total, 1), 1.0)
    high = np.maximum(table - DISCOUNT, 0) / np.maximum(total, 1)[:, None]
    return (high + back[:, None] * below.reshape(-1, SYMBOLS)[np.arange(len(table)) % (below.size // SYMBOLS)]).ravel(), back


def _distinct(grams, order):
    """How many different symbols come before each run of ``order`` symbols."""
    longer = np.unique(grams % SYMBOLS ** (order + 1))
    return np.bincount(longer % SYMBOLS**order, minlength=SYMBOLS**order).astype(np.float64)


def build_model(grams, ordinary, toxic):
    """Log-likelihood ratios: of n-grams met in training, and of backing off from a context.

    Orders 1 to 3 pool the classes. Built on the driver from the counts, of which there are
    at most 30^5; returns plain arrays, fit for a broadcast.
    """
    order = np.argsort(grams)
    grams = np.asarray(grams, np.int64)[order]
    shared = np.full(SYMBOLS, 1 / SYMBOLS)
    for size in (1, 2, 3):
        shared, _ = _level(_distinct(grams, size), shared)
    parent, suffix = grams // SYMBOLS, grams % SYMBOLS**4
    logs = []
    for counts in (np.asarray(ordinary, float)[order], np.asarray(toxic, float)[order]):
        fourth, _ = _level(_distinct(grams[counts > 0], 4), shared)
        total = np.bincount(parent, weights=counts, minlength=SYMBOLS**4)
        types = np.bincount(parent, weights=counts > 0, minlength=SYMBOLS**4)
        back = np.where(total > 0, DISCOUNT * types / np.maximum(total, 1), 1.0)
        high = np.maximum(counts - DISCOUNT, 0) / np.maximum(total, 1)[parent]
        fifth = high + back[parent] * fourth[suffix]
        logs.append([np.log(p).astype(np.float32) for p in (fifth, fourth, back)])
    fifth, fourth, back = (t - o for o, t in zip(*logs))
    return {"grams": grams.astype(np.int32), "fifth": fifth, "fourth": fourth, "back": back}


class Ratios:
    """The model's tables laid out for lookup by code."""

    def __init__(self, model):
        self.fourth, self.back = model["fourth"], model["back"]
        self.fifth = np.full(SYMBOLS**ORDER, np.nan, np.float16)
        self.fifth[model["grams"]] = model["fifth"]

    def __call__(self, values):
        """Ratio of each symbol from the fifth of ``values`` on."""
        grams = codes(values, ORDER)
        found = self.fifth[grams].astype(np.float32)
        new = np.flatnonzero(np.isnan(found))
        found[new] = self.back[grams[new] // SYMBOLS] + self.fourth[grams[new] % SYMBOLS**4]
        return found


def features(ratios, values, begins):
    """For each text: mean ratio, highest ratio sum of a window, share of strong windows."""
    out = np.zeros((len(begins) - 1, len(FEATURES)))
    if len(values) < ORDER:
        return out
    keep = _inside(begins, ORDER, len(values))
    ratio = np.where(keep, ratios(values), 0).astype(np.float64)
    sums = np.concatenate(([0.0], np.cumsum(ratio)))
    edges = np.minimum(begins, len(ratio))
    lengths = np.maximum(1, np.diff(begins) - ORDER + 1)
    out[:, 0] = np.diff(sums[edges]) / lengths
    ends = np.minimum(np.arange(len(ratio)) + WINDOW, np.repeat(edges[1:], np.diff(edges)))
    windows = sums[ends] - sums[:-1]
    filled = np.flatnonzero(np.diff(edges) > 0)
    out[filled, 1] = np.maximum.reduceat(windows, edges[:-1][filled]) / WINDOW
    out[filled, 2] = np.add.reduceat((windows > STRONG).astype(float), edges[:-1][filled]) / lengths[filled]
    return out


def _measure(model, kept, prefix=""):
    def run(batches):
        ratios = Ratios(model.value)
        for rows in slices(batches):
            found = features(ratios, *symbols(*flat(rows.column("text"))))
            evidence = {f"{prefix}{n}": found[:, i] for i, n in enumerate(FEATURES)}
            yield batch(**{n: rows.column(n) for n in kept}, **evidence)

    return run


def fit_logistic(x, y, rounds=50, ridge=1e-3):
    """Newton's method on standardised inputs; returns a weight for each input and a constant."""
    if not len(y) or y.min() == y.max():
        rate = y.mean() if len(y) else 0.0
        rate = min(max(rate, 1e-3), 1 - 1e-3)
        return np.append(np.zeros(x.shape[1]), np.log(rate / (1 - rate)))
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack(((x - mean) / spread, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, z.T @ (p - y) / len(y) + ridge * w)
        w -= np.clip(step, -5, 5)
    return np.append(w[:-1] / spread, w[-1] - (w[:-1] * mean / spread).sum())


def _models(counts):
    """The model of all counts, and those of the first and of the second half."""
    grams, where = np.unique(counts["gram"].to_numpy(np.int64), return_inverse=True)
    table = np.zeros((MARKS, len(grams)))
    table[counts["mark"].to_numpy(np.int64), where] = counts["n"]
    whole = build_model(grams, table[0] + table[2], table[1] + table[3])
    return whole, build_model(grams, table[0], table[1]), build_model(grams, table[2], table[3])


def train(documents, labels, folds=(1, 2, 3, 4)):
    """The model and the weights of its evidence.

    ``labels(doc_id, toxic)`` and ``documents(doc_id, text)``; the fold of a row is
    crc32(doc_id as text) mod 5, and fold 0 is never read here. Null labels are left out. The
    weights are fitted on evidence from the model of the other half of the folds, so that no
    row is judged by counts of its own.
    """
    spark = documents.sparkSession
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    known = labels.where("toxic in (0, 1) and doc_id is not null").select("doc_id", "toxic", fold.alias("fold"))
    known = known.groupBy("doc_id", "fold").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("fold").isin(list(folds)))
    half = (F.col("fold") > folds[len(folds) // 2 - 1]).cast("int")
    known = stage(known.select("doc_id", "toxic", (2 * half + F.col("toxic")).alias("mark")), "labels")
    texts = documents.select("doc_id", "text")
    whole, *halves = _models(ngram_counts(texts.join(broadcast_if_small(known), "doc_id")).toPandas())
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION_ROWS)
    kept = texts.join(F.broadcast(drawn), "doc_id").select("toxic", "mark", "text")
    schema = "toxic int, " + ", ".join(f"{n} double" for n in FEATURES)
    evidence = []
    for first, other in ((0, halves[1]), (2, halves[0])):
        measure = _measure(spark.sparkContext.broadcast(other), ["toxic"])
        mine = kept.where(F.col("mark").between(first, first + 1)).select("toxic", "text")
        evidence.append(mine.mapInArrow(measure, schema))
    found = evidence[0].union(evidence[1]).toPandas()
    weights = fit_logistic(found[list(FEATURES)].to_numpy(), found["toxic"].to_numpy(float))
    return spark.sparkContext.broadcast(whole), weights


def score(documents, trained, keep_text=False, prefix=""):
    """``documents`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on), after ``prefix``.

    Every row gets a score from its text alone; a null or empty one has no evidence and gets
    that of the constant. Columns named like the two are replaced; ``text`` is only returned
    with ``keep_text``, where a null comes back as null.
    """
    small_batches(documents.sparkSession)
    shared, weights = trained
    names = f"{prefix}score", f"{prefix}predicted"
    rest = documents.drop(*names)
    kept = [f for f in rest.schema.fields if keep_text or f.name != "text"]
    schema = StructType([*kept, *[StructField(f"evidence {n}", DoubleType()) for n in FEATURES]])
    found = rest.mapInArrow(_measure(shared, [f.name for f in kept], "evidence "), schema)
    evidence = [F.col(f"`evidence {n}`") * float(w) for n, w in zip(FEATURES, weights)]
    value = 1 / (1 + F.exp(-sum(evidence, F.lit(float(weights[-1])))))
    scored = found.select(*[f"`{f.name}`" for f in kept], value.alias(names[0]))
    return scored.withColumn(names[1], (F.col(f"`{names[0]}`") >= 0.5).cast("int"))
