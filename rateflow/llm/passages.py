"""Removal of repeated passages by compressed FM-indexes of shards.

Every window of 35 words has an anchor, its least five-word hash, and a context of 20 words
on the anchor's longer side; equal windows have equal contexts, so the context names the
shard's group. Neighbouring windows with one context are a run. Runs whose context is met
once cannot repeat and end there. The words of the others go to shards; each shard builds an
FM-index, and backward search over its wavelet tree counts every window of the runs that
stream past it. Occurrences carry the number of runs, and of equal texts, they stand for.
The runs of a context with more words than a shard holds are split into their windows, which
meet by the hash of all their words instead.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rateflow.llm.arrays import batch, flat, mix, ngrams, signed, slices, sliding, small_batches, word_hashes, word_spans
from rateflow.operators.joins import broadcast_if_small
from rateflow.session import stage

WINDOW = 35
ANCHOR = 5
CONTEXT = 20
# Words that one shard indexes, about.
SHARD_WORDS = 400_000


def _chain(grams, step, count):
    """Hash of ``count`` hashes of ``grams`` that are ``step`` apart."""
    out = np.zeros(max(0, len(grams) - step * (count - 1)), np.uint64)
    for j in range(count):
        out = out * np.uint64(0xD1342543DE82EF95) + grams[j * step : j * step + len(out)]
    return mix(out)


def runs_of(hashes, before):
    """Runs of windows with one context: ``text, start, count, context, content`` arrays.

    ``hashes`` are the words of texts end to end, ``before`` where each begins.
    """
    total = len(hashes) - WINDOW + 1
    if total < 1:
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    five = ngrams(hashes, ANCHOR)
    twenty, window = _chain(five, ANCHOR, CONTEXT // ANCHOR), _chain(five, ANCHOR, WINDOW // ANCHOR)
    span = WINDOW - ANCHOR + 1
    least = sliding(five, span, np.minimum)
    text = np.repeat(np.arange(len(before) - 1), np.diff(before))
    starts = np.flatnonzero(text[:total] == text[WINDOW - 1 :])
    if not len(starts):
        return [starts] * 3 + [np.zeros(0, np.uint64)] * 2
    # The first place of the least hash in each window, found from one to the next.
    wanted = least[starts]
    edge = np.zeros(span - 1, np.uint64)
    chosen = np.flatnonzero(sliding(np.concatenate((edge, least, edge)), span, np.maximum) == five)
    at = np.searchsorted(chosen, starts)
    open_ = np.flatnonzero(five[chosen[at]] != wanted)
    while len(open_):
        at[open_] += 1
        open_ = open_[five[chosen[at[open_]]] != wanted[open_]]
    anchor = chosen[at]
    left = anchor - starts >= (WINDOW - ANCHOR) // 2
    place = np.where(left, anchor - (CONTEXT - ANCHOR), anchor)
    context = mix(twenty[place] + left.astype(np.uint64) + np.uint64(1))
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (
        (starts[1:] != starts[:-1] + 1)
        | (text[starts[1:]] != text[starts[:-1]])
        | (place[1:] != place[:-1])
        | (left[1:] != left[:-1])
    )
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(starts)))
    last = first + count - 1
    content = mix(window[starts[first]] * np.uint64(3) + window[starts[last]] * np.uint64(5) + count.astype(np.uint64))
    of = text[starts[first]]
    return of, starts[first] - before[of], count, context[first], content


def _emit_runs(batches):
    """Runs on their way to meet others of their context.

    Contexts met twice in a slice are known to be shared: their runs travel anywhere, and one
    herald goes in their place. So a hot context brings one row a slice to its task.
    """
    for rows in slices(batches):
        data, offsets = flat(rows.column("text"))
        starts, ends, before = word_spans(data, offsets)
        of, start, count, context, content = runs_of(word_hashes(data, starts, ends), before)
        row, weight = rows.column("row").to_numpy()[of], rows.column("weight").to_numpy()[of]
        _, first, where, met = np.unique(context, return_index=True, return_inverse=True, return_counts=True)
        known = (met > 1)[where]
        heralds = first[met > 1]
        route = np.where(known, mix(content + row.view(np.uint64) + start.astype(np.uint64)), context)
        weight = np.where(known & (weight == 1), MARKED, weight)
        ends_ = np.full(len(heralds), HERALD)
        yield batch(
            route=signed(np.concatenate((route, context[heralds]))),
            context=signed(np.concatenate((context, context[heralds]))),
            content=signed(np.concatenate((content, content[heralds]))),
            row=np.concatenate((row, row[heralds])),
            start=np.concatenate((start, start[heralds])).astype(np.int32),
            n=np.concatenate((count, count[heralds])).astype(np.int32),
            weight=np.concatenate((weight, ends_)).astype(np.int32),
        )


RUN = "route long, context long, content long, row long, start int, n int, weight int"
# Weights that say something else: a run known to be shared, and a herald.
MARKED, HERALD = 1 << 20, 1 << 21


def _shared(batches):
    """Runs whose context is met more than once; rows come sorted by route."""
    held = None
    for rows in batches:
        if not rows.num_rows:
            continue
        # Of the batch before, only its last row is open.
        whole = pa.Table.from_batches([held, rows] if held is not None else [rows]).combine_chunks()
        context, weight = (whole.column(c).to_numpy() for c in ("route", "weight"))
        same = context[1:] == context[:-1]
        keep = weight > 1
        keep[1:] |= same
        keep[:-1] |= same
        last = whole.num_rows - 1
        # A kept last row is marked by its weight, so that a lone follower is kept with it.
        found = keep[:last]
        if last:
            yield from whole.slice(0, last).filter(pa.array(found)).to_batches()
        held = whole.slice(last)
        if keep[last] and weight[last] < 2:
            held = held.set_column(6, "weight", pa.array([MARKED], pa.int32()))
        held = held.to_batches()[0]
    if held is not None and held.column(6)[0].as_py() != 1:
        yield held


def _run_words(batches):
    """The words of the runs listed for each text, 6 bytes of hash a word."""
    for rows in slices(batches):
        data, offsets = flat(rows.column("text"))
        starts, ends, before = word_spans(data, offsets)
        packed = word_hashes(data, starts, ends).view(np.uint8).reshape(-1, 8)[:, :6]
        out = {n: [] for n in ("context", "content", "weight", "words")}
        for i, runs in enumerate(rows.column("runs").to_pylist()):
            for run in runs:
                begin = before[i] + run["start"]
                out["words"].append(packed[begin : begin + run["n"] + WINDOW - 1].tobytes())
                for name in ("context", "content", "weight"):
                    out[name].append(run[name])
        yield batch(
            context=pa.array(out["context"], pa.int64()),
            content=pa.array(out["content"], pa.int64()),
            weight=pa.array(out["weight"], pa.int64()),
            words=pa.array(out["words"], pa.binary()),
        )


def _run_windows(batches):
    """The windows of the runs listed for each text: their places in the run and hashes."""
    for rows in slices(batches):
        data, offsets = flat(rows.column("text"))
        starts, ends, before = word_spans(data, offsets)
        windows = _chain(ngrams(word_hashes(data, starts, ends), ANCHOR), ANCHOR, WINDOW // ANCHOR)
        runs = [(before[i] + r["start"], r) for i, listed in enumerate(rows.column("runs").to_pylist()) for r in listed]
        number = np.array([r["n"] for _, r in runs], np.int64)
        at = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        begin = np.repeat(np.array([b for b, _ in runs], np.int64), number)
        fixed = {n: np.repeat(np.array([r[n] for _, r in runs], np.int64), number) for n in ("context", "content", "weight")}
        yield batch(**fixed, at=at.astype(np.int32), window=signed(windows[begin + at]))


class WaveletMatrix:
    """Rank over symbols: a bit vector for each bit of a symbol, packed, with counts by block."""

    def __init__(self, symbols, size):
        self.levels = []
        for bit in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            ones = ((symbols >> bit) & 1).astype(bool)
            packed = np.packbits(np.append(ones, np.zeros(-len(ones) % 64 + 64, bool)), bitorder="little").view(np.uint64)
            blocks = np.concatenate(([0], np.cumsum(np.bitwise_count(packed)))).astype(np.int64)
            zeros = len(ones) - int(ones.sum())
            self.levels.append((bit, packed, blocks, zeros))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))
        self.base = self._follow(np.arange(size), np.zeros(size, np.int64))

    def _follow(self, symbols, at):
        for bit, packed, blocks, zeros in self.levels:
            word = at >> 6
            below = packed[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            ones = blocks[word] + np.bitwise_count(below)
            at = np.where((symbols >> bit) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols, at):
        """How often each symbol comes before each place."""
        return self._follow(symbols, at) - self.base[symbols]


class FMIndex:
    """Index of texts of symbols from 1 on, 0 after each; a text stands for ``weight`` of them."""

    def __init__(self, texts, weights):
        lengths = np.array([len(t) for t in texts])
        ends = np.cumsum(lengths + 1)
        joined = np.zeros(ends[-1], np.int64)
        inside = np.ones(ends[-1], bool)
        inside[ends - 1] = False
        joined[inside] = np.concatenate(texts)
        order = self._sorted(joined, int(lengths.max()) + 1)
        size = int(joined.max()) + 1
        self.tree = WaveletMatrix(joined[order - 1], size)
        self.begin = np.concatenate(([0], np.cumsum(np.bincount(joined, minlength=size))))
        weight = np.repeat(np.asarray(weights, np.int64), lengths + 1)
        self.weight = np.concatenate(([0], np.cumsum(weight[order])))
        self.rows = len(joined)

    @staticmethod
    def _sorted(joined, depth):
        """Suffixes in the order of their first ``depth`` symbols, by doubling."""
        rank, covered = joined, 1
        while True:
            after = np.zeros(len(rank), np.int64)
            if covered < len(rank):
                after[:-covered] = rank[covered:] + 1
            key = rank * (int(rank.max()) + 2) + after
            order = np.argsort(key, kind="stable")
            steps = key[order][1:] != key[order][:-1]
            rank = np.empty(len(key), np.int64)
            rank[order] = np.concatenate(([0], np.cumsum(steps)))
            covered *= 2
            if covered >= depth or steps.all():
                return order

    def counts(self, patterns, enough=2):
        """Weighted occurrences of each row of ``patterns``, read from the end; -1 are gaps in front.

        A search ends where fewer than ``enough`` are left.
        """
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.rows)
        active = np.arange(len(patterns))
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbols = patterns[active, column]
            active, symbols = active[symbols >= 0], symbols[symbols >= 0]
            if not len(active):
                break
            low[active] = self.begin[symbols] + self.tree.rank(symbols, low[active])
            high[active] = self.begin[symbols] + self.tree.rank(symbols, high[active])
            active = active[self.weight[high[active]] - self.weight[low[active]] >= enough]
        return self.weight[high] - self.weight[low]


def repeated_windows(runs, weights):
    """For each run of word hashes, which of its windows occur twice or more in the shard."""
    lengths = np.array([len(r) for r in runs])
    known, coded = np.unique(np.concatenate(runs), return_inverse=True)
    coded = np.split(coded.ravel() + 1, np.cumsum(lengths)[:-1])
    index = FMIndex(coded, weights)
    grid = np.full((len(runs), lengths.max()), -1, np.int64)
    for i, run in enumerate(coded):
        grid[i, len(grid[i]) - len(run) :] = run
    marks = [np.zeros(n - WINDOW + 1, bool) for n in lengths]
    # A run that repeats as a whole needs no search for each of its windows.
    whole = index.counts(grid) >= 2
    for i in np.flatnonzero(whole):
        marks[i][:] = True
    rest = [(i, j) for i in np.flatnonzero(~whole) for j in range(lengths[i] - WINDOW + 1)]
    if rest:
        found = index.counts(np.stack([coded[i][j : j + WINDOW] for i, j in rest])) >= 2
        for (i, j), mark in zip(rest, found):
            marks[i][j] = mark
    return marks


def _search_shards(batches):
    """Rows come sorted by shard and context; an index holds whole contexts up to a size."""
    held, size = [], 0

    def close():
        runs = [np.frombuffer(w, np.uint8).reshape(-1, 6) for *_, w in held]
        wide = [np.zeros((len(r), 8), np.uint8) for r in runs]
        for full, run in zip(wide, runs):
            full[:, :6] = run
        marks = repeated_windows([f.view(np.uint64).ravel() for f in wide], [w for _, _, w, _ in held])
        out = []
        for (context, content, _, _), mark in zip(held, marks):
            edges = np.flatnonzero(np.diff(np.concatenate(([0], mark.view(np.int8), [0]))))
            out += [(context, content, a, b) for a, b in zip(edges[::2], edges[1::2])]
        table = np.array(out, np.int64).reshape(-1, 4)
        return batch(
            context=table[:, 0], content=table[:, 1], first=table[:, 2].astype(np.int32), stop=table[:, 3].astype(np.int32)
        )

    last = None
    for rows in batches:
        for context, content, weight, words in zip(*(c.to_pylist() for c in rows.columns)):
            if size > SHARD_WORDS and context != last:
                yield close()
                held, size = [], 0
            held.append((context, content, weight, words))
            size += len(words) // 6
            last = context
    if held:
        yield close()


def _finish(batches):
    """Counts and the hash of what is kept, given each text's repeated windows."""
    for rows in slices(batches):
        texts = rows.column("text").to_pylist()
        out = {n: [] for n in ("n_words", "n_removed", "kept_sha256", "kept")}
        for text, copied, spans in zip(texts, rows.column("copied").to_pylist(), rows.column("spans").to_pylist()):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            gone = np.zeros(len(words) + 1, np.int64)
            if copied and len(words) >= WINDOW:
                spans = [{"first": 0, "stop": len(words) - WINDOW + 1}]
            for span in spans or ():
                gone[span["first"]] += 1
                gone[span["stop"] + WINDOW - 1] -= 1
            covered = np.cumsum(gone)[:-1] > 0
            kept = b" ".join([w for w, c in zip(words, covered) if not c]) if covered.any() else b" ".join(words)
            out["n_words"].append(len(words))
            out["n_removed"].append(int(covered.sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept)
        yield batch(
            doc_id=rows.column("doc_id"),
            n_words=pa.array(out["n_words"], pa.int64()),
            n_removed=pa.array(out["n_removed"], pa.int64()),
            kept_sha256=pa.array(out["kept_sha256"], pa.string()),
            kept_text=pa.array(out["kept"], pa.binary()).cast(pa.string()),
        )


def remove_repeats(documents):
    """Table ``doc_id, n_words, n_removed, kept_sha256, kept_text``, one row per row.

    Words are runs of characters other than space and U+0009 to U+000D. Each word covered by
    a window of 35 words that also starts anywhere else, in this row or another, is removed;
    windows are judged on the input. Equal texts repeat each other, also in rows with one id.
    A null, empty or short text has no windows and keeps its words. Other columns are not read.
    """
    small_batches(documents.sparkSession)
    rows = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    texts = rows.select("row", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest")).where("digest is not null")
    equal = texts.groupBy("digest").agg(F.count("*").alias("copies"), F.min("row").alias("lead")).where("copies > 1")
    equal = stage(texts.join(equal, "digest").select("row", "lead").distinct(), "equal")
    rows = rows.join(broadcast_if_small(equal), "row", "left").withColumn("copied", F.col("lead").isNotNull())
    single = rows.where("lead is null or lead = row")
    weighed = single.select("row", "text", F.when(F.col("copied"), 2).otherwise(1).alias("weight"))
    runs = weighed.mapInArrow(_emit_runs, RUN).repartition("route").sortWithinPartitions("route")
    shared = stage(runs.mapInArrow(_shared, RUN).where(F.col("weight") != HERALD).drop("route"), "runs")
    shared = shared.withColumn("weight", F.when(F.col("weight") == MARKED, 1).otherwise(F.col("weight")))
    found = stage(_repeated(weighed, shared), "repeats")
    spans = shared.select("context", "content", "row", "start").distinct().join(found, ["context", "content"])
    spans = spans.select("row", (F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("stop")).alias("stop"))
    spans = spans.groupBy("row").agg(F.collect_list(F.struct("first", "stop")).alias("spans"))
    spans = stage(spans, "spans")
    touched = broadcast_if_small(spans.select("row"))
    plain = rows.join(touched, "row", "left_anti").withColumn("spans", F.lit(None).cast("array<struct<first:int,stop:int>>"))
    changed = rows.join(touched, "row", "left_semi").join(spans, "row")
    columns = ["doc_id", "text", "copied", "spans"]
    schema = StructType(
        [
            documents.schema["doc_id"],
            StructField("n_words", LongType()),
            StructField("n_removed", LongType()),
            StructField("kept_sha256", StringType()),
            StructField("kept_text", StringType()),
        ]
    )
    return plain.select(columns).union(changed.select(columns)).mapInArrow(_finish, schema)


def _repeated(weighed, shared):
    """``context, content, first, stop``: stretches of windows that repeat, for each run content."""
    distinct = shared.groupBy("context", "content").agg(
        F.sum("weight").alias("weight"), F.min(F.struct("row", "start", "n")).alias("at")
    )
    distinct = stage(distinct, "distinct")
    # A context whose words don't fit a shard is split.
    large = distinct.groupBy("context").agg(F.sum(F.col("at.n") + WINDOW - 1).alias("words"))
    large = stage(large.where(F.col("words") > SHARD_WORDS).select("context"), "large")
    if large.isEmpty():
        return _in_shards(weighed, distinct)
    large = broadcast_if_small(large)
    whole = _in_shards(weighed, distinct.join(large, "context", "left_anti"))
    return whole.union(_by_windows(weighed, distinct.join(large, "context", "left_semi")))


def _with_runs(weighed, distinct):
    """``text, runs``: each text that a run is read from, with its runs."""
    run = F.struct("at.start", "at.n", "context", "content", "weight")
    listed = distinct.groupBy(F.col("at.row").alias("row")).agg(F.collect_list(run).alias("runs"))
    listed = stage(listed, "listed")
    texts = weighed.select("row", "text").join(broadcast_if_small(listed.select("row")), "row", "left_semi")
    return texts.join(listed, "row").select("text", "runs")


def _in_shards(weighed, distinct):
    words = _with_runs(weighed, distinct).mapInArrow(_run_words, "context long, content long, weight long, words binary")
    words = words.repartition("context").sortWithinPartitions("context", "content")
    return words.mapInArrow(_search_shards, "context long, content long, first int, stop int")


def _by_windows(weighed, distinct):
    """The same for contexts of any size; windows of one context and one hash are equal."""
    schema = "context long, content long, weight long, at int, window long"
    windows = stage(_with_runs(weighed, distinct).mapInArrow(_run_windows, schema), "windows")
    met = windows.groupBy("context", "window").agg(F.sum("weight").alias("n")).where("n > 1")
    met = broadcast_if_small(stage(met.select("context", "window"), "met"))
    found = windows.join(met, ["context", "window"])
    return found.select("context", "content", F.col("at").alias("first"), (F.col("at") + 1).alias("stop"))
