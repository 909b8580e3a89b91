"""Texts of Arrow batches as flat arrays: bytes, words, hashes and word n-grams.

Python functions here run inside ``mapInArrow``: Spark splits the rows over tasks, numpy
works through one slice of a batch at a time, so a task holds a few megabytes of text.
"""

import sys
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
BATCH_ROWS = 1000
# The characters that separate words: space and U+0009 to U+000D.
GAP = np.zeros(256, bool)
GAP[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15


def small_batches(spark):
    """Lets Arrow batches hold fewer rows than by default: rows of texts can be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def kept(name, make):
    """What ``make`` gives, made once a worker process and kept under ``name``.

    Functions reach the workers by value, so the globals of their modules do not last.
    """
    store = sys.modules.setdefault("_kept_by_workers", ModuleType("_kept_by_workers")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def mix(values):
    """64-bit finaliser: close inputs give unrelated outputs."""
    x = values.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(batches, column="text", limit=SLICE_BYTES):
    """The batches again, in slices of about ``limit`` bytes of ``column``.

    A text longer than the limit is a slice of its own. Nulls stay; ``flat`` reads them as ''.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        begun, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(begun, i - begun)
                begun, held = i, 0
            held += size
        yield batch.slice(begun)
    # Workers stay for other tasks: what this one no longer uses goes back to the system.
    pa.default_memory_pool().release_unused()


def flat(column):
    """A string column as its bytes and the offset of each text; a null is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def word_spans(data, offsets):
    """Byte start and end of each word, and the number of words before each text."""
    solid = ~GAP[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | first[1:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | first[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def _powers(count):
    powers = np.full(count, np.uint64(_BASE))
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def word_hashes(data, starts, ends):
    """A 64-bit hash of each word: a polynomial in its bytes, then ``mix``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    out = np.empty(len(starts), np.uint64)
    # Blocks of words keep the helpers small beside one very long text.
    cuts = np.unique(np.searchsorted(starts, np.arange(starts[0], ends[-1] + SLICE_BYTES, SLICE_BYTES)))
    powers = _powers(int((ends - starts).max()))
    for a, b in zip(cuts[:-1], cuts[1:]):
        lengths = ends[a:b] - starts[a:b]
        edges = np.concatenate(([0], np.cumsum(lengths)))
        within = np.arange(edges[-1]) - np.repeat(edges[:-1], lengths)
        values = data[within + np.repeat(starts[a:b], lengths)].astype(np.uint64) + np.uint64(1)
        out[a:b] = np.add.reduceat(values * powers[within], edges[:-1])
        out[a:b] += lengths.astype(np.uint64) << np.uint64(56)
    return mix(out)


def ngrams(hashes, size):
    """Hash of every run of ``size`` hashes; runs over a text's end are the caller's to drop."""
    count = max(0, len(hashes) - size + 1)
    out = np.zeros(count, np.uint64)
    for j in range(size):
        out = out * np.uint64(_BASE) + hashes[j : j + count]
    return mix(out)


def sliding(values, width, pick):
    """``pick`` (np.minimum or np.maximum) over every ``width`` consecutive values."""
    out, covered = values, 1
    while covered < width:
        step = min(covered, width - covered)
        out = pick(out[:-step], out[step:])
        covered += step
    return out


def batch(**columns):
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()],
        names=list(columns),
    )


def signed(values):
    """Unsigned 64-bit values as Spark's long."""
    return values.view(np.int64)
