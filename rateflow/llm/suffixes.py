"""Removal of repeated byte strings by suffix arrays of shards.

Every window of LENGTH bytes has an anchor, its least eight bytes by hash, and a context of
CONTEXT bytes on the anchor's longer side. Equal windows have equal contexts, so contexts name
the shards; neighbouring windows with one anchor and context are a run. Runs whose context is
met once cannot repeat and end there. The bytes of the others, each distinct run once with the
number of runs it stands for, are sorted in shards. There intervals of the Burrows-Wheeler
transform are extended backwards breadth first: strings of one more byte each round settle
where neighbours in the suffix array part, so common prefixes come out by increasing length,
and the rounds stop at LENGTH. Neighbours that have not parted by then repeat each other.

A context with more bytes than a shard holds is cut into shorter runs, whose windows share
nearly all their bytes, and these are routed by what they share: at last by whole windows,
which are all alike.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from rateflow.llm.arrays import batch, flat, mix, signed, slices, sliding, small_batches
from rateflow.operators.joins import broadcast_if_small
from rateflow.session import stage

LENGTH = 200
GRAM = 8
CONTEXT = 96
# Bytes that one shard sorts, about.
SHARD_BYTES = 1 << 20
# Windows that share their anchor by so many places are cut apart where a context is too large.
WIDTHS = (16, 1)
_SPAN = LENGTH - GRAM + 1
_FACTOR = np.uint64(0xD1342543DE82EF95)


def grams(data):
    """A hash of the eight bytes from every place on; equal only for equal bytes."""
    out = data.astype(np.uint64)
    for step in (1, 2, 4):
        out = out[:-step] | (out[step:] << np.uint64(8 * step))
    return mix(out)


def _chain(hashes, places, count):
    """Hash of ``count`` times eight bytes from each of ``places`` on."""
    out = np.zeros(len(places), np.uint64)
    for j in range(count):
        out = out * _FACTOR + hashes[places + GRAM * j]
    return mix(out)


def _anchors(hashes, starts):
    """The first place of the least hash in each window."""
    least = sliding(hashes, _SPAN, np.minimum)
    edge = np.zeros(_SPAN - 1, np.uint64)
    chosen = np.flatnonzero(sliding(np.concatenate((edge, least, edge)), _SPAN, np.maximum) == hashes)
    wanted = least[starts]
    at = np.searchsorted(chosen, starts)
    open_ = np.flatnonzero(hashes[chosen[at]] != wanted)
    while len(open_):
        at[open_] += 1
        open_ = open_[hashes[chosen[at[open_]]] != wanted[open_]]
    return chosen[at]


def runs_of(data, offsets):
    """Runs of windows in texts that lie end to end: ``text, start, count, context, content``."""
    number = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    if not number.sum():
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    text = np.repeat(np.arange(len(number)), number)
    starts = np.arange(number.sum()) + np.repeat(offsets[:-1] - (np.cumsum(number) - number), number)
    hashes = grams(data)
    anchor = _anchors(hashes, starts)
    left = anchor - starts >= CONTEXT
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (left[1:] != left[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(starts)))
    text, anchor, left, begin = text[first], anchor[first], left[first], starts[first]
    place = np.where(left, anchor - (CONTEXT - GRAM), anchor)
    context = mix(_chain(hashes, place, CONTEXT // GRAM) + left.astype(np.uint64) + np.uint64(1))
    whole = LENGTH // GRAM
    content = _chain(hashes, begin, whole) * np.uint64(3) + _chain(hashes, begin + count - 1, whole) * np.uint64(5)
    return text, begin - offsets[text], count, context, mix(content + count.astype(np.uint64))


RUN = "digest binary, start int, n int, context long, content long, weight int"


def _emit_runs(batches):
    for rows in slices(batches):
        of, start, count, context, content = runs_of(*flat(rows.column("text")))
        yield batch(
            digest=rows.column("digest").take(pa.array(of)),
            start=start.astype(np.int32),
            n=count.astype(np.int32),
            context=signed(context),
            content=signed(content),
            weight=rows.column("weight").to_numpy()[of],
        )


PIECE = "context long, content long, weight long, bytes binary"


def _run_bytes(batches):
    """The bytes of the runs listed for each text."""
    for rows in slices(batches):
        out = {n: [] for n in ("context", "content", "weight", "bytes")}
        for text, runs in zip(rows.column("text").to_pylist(), rows.column("runs").to_pylist()):
            text = text.encode("utf-8", "surrogatepass")
            for run in runs:
                out["bytes"].append(text[run["start"] : run["start"] + run["n"] + LENGTH - 1])
                for name in ("context", "content", "weight"):
                    out[name].append(run[name])
        yield _pieces(out)


def _pieces(out):
    return batch(**{n: pa.array(v, pa.binary() if n == "bytes" else pa.int64()) for n, v in out.items()})


def sorted_rotations(symbols, depth):
    """Places of ``symbols`` by the order of their first ``depth`` symbols or more, read in a circle.

    As many symbols, and then as many ranks, as fit 64 bits are sorted at a time.
    """
    n = len(symbols)
    present = np.flatnonzero(np.bincount(symbols))
    codes = np.zeros(int(present[-1]) + 1, np.uint64)
    codes[present] = np.arange(len(present))
    rank, bits, covered = codes[symbols], max(1, (len(present) - 1).bit_length()), 1
    while True:
        key, taken = rank.copy(), 64 // bits
        for j in range(1, taken):
            key <<= np.uint64(bits)
            key |= np.roll(rank, -covered * j)
        covered *= taken
        order = np.argsort(key)
        ordered = key[order]
        steps = ordered[1:] != ordered[:-1]
        if covered >= depth or steps.all():
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = np.concatenate(([0], np.cumsum(steps)))
        bits = max(1, int(rank[order[-1]]).bit_length())


class Transform:
    """The Burrows-Wheeler transform of a circle of symbols, with what a step backwards needs."""

    def __init__(self, symbols, depth):
        n = len(symbols)
        self.order = sorted_rotations(symbols, depth)
        last = symbols[self.order - 1]
        by_symbol = np.argsort(last, kind="stable").astype(np.int32)
        self.back = np.empty(n, np.int32)
        self.back[by_symbol] = np.arange(n, dtype=np.int32)
        same = last[by_symbol[1:]] == last[by_symbol[:-1]]
        # Where the same symbol stands last before and first after each place.
        self.before, self.after = np.full(n, -1, np.int32), np.full(n, n, np.int32)
        self.before[by_symbol[1:][same]] = by_symbol[:-1][same]
        self.after[by_symbol[:-1][same]] = by_symbol[1:][same]

    def extended(self, low, high):
        """All intervals that the strings of disjoint intervals have with one more symbol in front.

        In an interval the first place of a symbol gives the lower end of its extension and
        the last place the upper one. Extensions are disjoint, so in order they pair up.
        """
        sizes = high - low
        skipped = np.cumsum(sizes, dtype=np.int32) - sizes
        at = np.arange(sizes.sum(), dtype=np.int32) + np.repeat(low - skipped, sizes)
        begins = at[self.before[at] < np.repeat(low, sizes)]
        ends = at[self.after[at] >= np.repeat(high, sizes)]
        return np.sort(self.back[begins]), np.sort(self.back[ends]) + 1


def parted(transform, length):
    """For each border in the order of rotations whether those beside it share fewer than ``length`` symbols.

    An interval whose upper end is not known yet tells it, and only such are extended on.
    """
    n = len(transform.order)
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    low, high = np.array([0], np.int32), np.array([n], np.int32)
    for _ in range(length):
        low, high = transform.extended(low, high)
        new = ~known[high]
        low, high = low[new], high[new]
        known[high] = True
        if not len(low):
            break
    return known


def repeated_windows(texts, weights):
    """Stretches ``text, first, stop`` of windows that start more than once among ``texts``.

    ``texts`` are byte strings of a window or more; one with a weight over 1 stands for others.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    stops = np.cumsum(sizes + 1)
    begins = stops - sizes - 1
    symbols = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.uint16) + np.uint16(1)
    symbols[stops - 1] = 0
    transform = Transform(symbols, LENGTH)
    apart = parted(transform, LENGTH)
    marks = np.zeros(len(symbols) + 1, np.int8)
    marks[transform.order] = ~apart[:-1] | ~apart[1:]
    # What begins less than a window before a text's end is none; a heavy text repeats as a whole.
    windows = np.zeros(len(symbols) + 1, np.int32)
    windows[begins] += 1
    windows[stops - LENGTH] -= 1
    inside = np.cumsum(windows)[:-1] > 0
    heavy = np.repeat(np.asarray(weights) > 1, sizes + 1)
    marks[:-1] = inside & (heavy | (marks[:-1] > 0))
    edges = np.flatnonzero(np.diff(marks, prepend=np.int8(0)))
    of = np.searchsorted(stops, edges[::2], "right")
    return of, edges[::2] - begins[of], edges[1::2] - begins[of]


FOUND = "context long, content long, first int, stop int"


def _search_shards(batches):
    """Rows come sorted by context; a shard holds whole contexts up to a size."""
    held, size = [], 0

    def close():
        of, first, stop = repeated_windows([b for *_, b in held], [w for _, _, w, _ in held])
        context, content = (np.array([h[i] for h in held], np.int64)[of] for i in (0, 1))
        return batch(context=context, content=content, first=first.astype(np.int32), stop=stop.astype(np.int32))

    last = None
    for rows in batches:
        for context, content, weight, text in zip(*(c.to_pylist() for c in rows.columns)):
            if size > SHARD_BYTES and context != last:
                yield close()
                held, size = [], 0
            held.append((context, content, weight, text))
            size += len(text) + 1
            last = context
    if held:
        yield close()
    pa.default_memory_pool().release_unused()


def _hash(*parts):
    return int.from_bytes(hashlib.blake2b(b"|".join(parts), digest_size=8).digest(), "little", signed=True)


def _cut(width):
    """Pieces cut where the windows' distance from the anchor passes a multiple of ``width``.

    The windows of a cut piece share all but ``width`` - 1 bytes; these name its context.
    """

    def run(batches):
        for rows in batches:
            out = {n: [] for n in ("of_context", "of_content", "at", "context", "content", "weight", "bytes")}
            for context, content, weight, text in zip(*(c.to_pylist() for c in rows.columns)):
                anchor = int(np.argmin(grams(np.frombuffer(text[:LENGTH], np.uint8))))
                windows, at = len(text) - LENGTH + 1, 0
                while at < windows:
                    group = (anchor - at) // width
                    stop = min(windows, anchor - group * width + 1)
                    piece = text[at : stop + LENGTH - 1]
                    shared = text[anchor - group * width : anchor - (group + 1) * width + 1 + LENGTH]
                    out["context"].append(_hash(shared, b"%d/%d" % (group, width)))
                    out["content"].append(_hash(piece))
                    for name, value in (("of_context", context), ("of_content", content), ("at", at), ("weight", weight), ("bytes", piece)):
                        out[name].append(value)
                    at = stop
            yield _pieces(out)

    return run


def _found(pieces, sizes, widths=WIDTHS):
    """Stretches of repeated windows of distinct ``pieces``; ``sizes`` has the bytes by context."""
    large = stage(sizes.where(F.col("size") > SHARD_BYTES).select("context"), "large")
    if not widths or large.isEmpty():
        return _in_shards(pieces)
    large = broadcast_if_small(large)
    whole = _in_shards(pieces.join(large, "context", "left_anti"))
    columns = pieces.columns
    cut = pieces.join(large, "context", "left_semi").select(columns)
    cut = stage(cut.mapInArrow(_cut(widths[0]), f"of_context long, of_content long, at long, {PIECE}"), "cut")
    again = cut.groupBy("context", "content").agg(F.sum("weight").alias("weight"), F.first("bytes").alias("bytes"))
    again = stage(again, "again")
    sizes = again.groupBy("context").agg(F.sum(F.octet_length("bytes")).alias("size"))
    found = stage(_found(again, sizes, widths[1:]), "found")
    found = cut.drop("bytes", "weight").join(broadcast_if_small(found), ["context", "content"])
    moved = [(F.col(c) + F.col("at")).cast("int").alias(c) for c in ("first", "stop")]
    return whole.union(found.select(F.col("of_context").alias("context"), F.col("of_content").alias("content"), *moved))


def _in_shards(pieces):
    pieces = pieces.select("context", "content", "weight", "bytes").repartition("context")
    return pieces.sortWithinPartitions("context", "content").mapInArrow(_search_shards, FOUND)


def _finish(batches):
    """What is left of each text, given the stretches of its repeated windows."""
    for rows in slices(batches):
        out = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "spans", "kept")}
        copied = rows.column("copied").to_pylist()
        for text, alike, found in zip(rows.column("text").to_pylist(), copied, rows.column("found").to_pylist()):
            text = (text or "").encode("utf-8", "surrogatepass")
            found = [{"first": 0, "stop": len(text) - LENGTH + 1}] * (len(text) >= LENGTH) if alike else found or []
            spans, kept, at = [], [], 0
            for first, stop in sorted((f["first"], f["stop"] + LENGTH - 1) for f in found):
                if spans and first <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], stop)
                else:
                    spans.append([first, stop])
            for first, stop in spans:
                kept.append(text[at:first])
                at = stop
            kept = b"".join([*kept, text[at:]])
            out["n_bytes"].append(len(text))
            out["n_removed"].append(len(text) - len(kept))
            out["n_spans"].append(len(spans))
            out["spans"].append([{"start": a, "stop": b} for a, b in spans])
            out["kept"].append(kept)
        types = {"spans": pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), "kept": pa.binary()}
        yield batch(doc_id=rows.column("doc_id"), **{n: pa.array(v, types.get(n, pa.int64())) for n, v in out.items()})


def remove_repeats(documents):
    """Table ``doc_id, n_bytes, n_removed, n_spans, spans, kept``, one row per row.

    Texts are read as UTF-8. Each byte covered by a string of 200 bytes that also starts
    anywhere else, in this row or another, is removed; strings are judged on the input, never
    reach over a text's end, and overlaps count. ``spans`` are the maximal removed runs,
    ``kept`` is the bytes that stay. Equal texts repeat each other, also in rows with one id
    or none. A null, empty or shorter text keeps its bytes. Other columns are not read.
    """
    small_batches(documents.sparkSession)
    rows = documents.select("doc_id", "text", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"))
    copies = rows.where("digest is not null").groupBy("digest")
    copies = copies.agg(F.count("*").alias("copies"), F.min("doc_id").alias("lead")).where("copies > 1")
    copies = broadcast_if_small(stage(copies.select("digest", "lead", F.lit(True).alias("copied")), "copies"))
    rows = rows.join(copies, "digest", "left").withColumn("copied", F.coalesce("copied", F.lit(False)))
    # Of equal texts the rows with the least id speak for all.
    leads = rows.where(~F.col("copied") | F.col("doc_id").eqNullSafe(F.col("lead")))
    weighed = leads.select("digest", "text", F.when(F.col("copied"), 2).otherwise(1).alias("weight"))
    weighed = weighed.where(F.octet_length("text") >= LENGTH)
    runs = stage(weighed.mapInArrow(_emit_runs, RUN), "runs")
    met = runs.groupBy("context").agg(F.sum("weight").alias("times")).where("times > 1").select("context")
    shared = stage(runs.join(broadcast_if_small(stage(met, "met")), "context", "left_semi"), "shared")
    distinct = shared.groupBy("context", "content").agg(
        F.sum("weight").alias("weight"), F.min(F.struct("digest", "start", "n")).alias("at")
    )
    distinct = stage(distinct, "distinct")
    sizes = distinct.groupBy("context").agg(F.sum(F.col("at.n") + LENGTH).alias("size"))
    run = F.struct("at.start", "at.n", "context", "content", "weight")
    listed = stage(distinct.groupBy("at.digest").agg(F.collect_list(run).alias("runs")), "listed")
    told = broadcast_if_small(listed.select("digest"))
    pieces = weighed.select("digest", "text").join(told, "digest", "left_semi").join(listed, "digest").select("text", "runs")
    found = stage(_found(pieces.mapInArrow(_run_bytes, PIECE).dropDuplicates(["context", "content"]), sizes), "found")
    own = shared.where("weight = 1").select("context", "content", "digest", "start")
    ends = [(F.col("start") + F.col(c)).alias(c) for c in ("first", "stop")]
    spans = own.join(broadcast_if_small(found), ["context", "content"]).select("digest", *ends)
    spans = stage(spans.groupBy("digest").agg(F.collect_list(F.struct("first", "stop")).alias("found")), "spans")
    touched = broadcast_if_small(spans.select("digest", F.lit(True).alias("touched")))
    rows = rows.select("doc_id", "text", "digest", "copied").join(touched, "digest", "left")
    changed = rows.where("touched").join(spans, "digest")
    plain = rows.where("touched is null").withColumn("found", F.lit(None).cast(spans.schema["found"].dataType))
    columns = ["doc_id", "text", "copied", "found"]
    span = ArrayType(StructType([StructField("start", LongType()), StructField("stop", LongType())]))
    counts = [StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    schema = StructType([documents.schema["doc_id"], *counts, StructField("spans", span), StructField("kept", BinaryType())])
    return plain.select(columns).union(changed.select(columns)).mapInArrow(_finish, schema)
