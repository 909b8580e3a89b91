"""Minimal perfect hashing of distinct 64-bit keys, and dense vectors that it indexes.

Keys are dealt to cells by their hash. In a cell each level is a bit vector twice as long as
the keys that are left: a key alone on its bit stays there, the others go on to the next
level. A key's number is the count of bits before its own, so a cell's keys take the numbers
from 0 to n - 1. Each number keeps its key, against which what is looked up is verified.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rateflow.llm.arrays import batch, mix
from rateflow.session import stage

CELL_KEYS = 1 << 16
# Vectors that one task adds up.
FAN = 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def cell_of(keys, cells):
    return (mix(keys.view(np.uint64) + _STEP) % np.uint64(cells)).astype(np.int64)


def _bit(keys, level, sizes):
    seed = np.uint64((level + 2) * int(_STEP) % 2**64)
    return (mix(keys.view(np.uint64) + seed) % sizes.astype(np.uint64)).astype(np.int64)


def build(keys):
    """Sizes of the levels and their bits, in 64-bit words, for distinct ``keys``."""
    sizes, words, rest = [], [], keys
    while len(rest):
        size = -(-2 * len(rest) // 64) * 64
        at = _bit(rest, len(sizes), np.full(len(rest), size))
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        rest = rest[~alone[at]]
    return sizes, np.concatenate(words) if words else np.zeros(0, np.uint64)


class Lookup:
    """Functions of some cells of ``cells`` side by side; numbers count on from cell to cell."""

    def __init__(self, cells, numbers, sizes, words):
        self.cells = cells
        self.local = np.full(cells, -1)
        self.local[numbers] = np.arange(len(numbers))
        depth = max((len(s) for s in sizes), default=0)
        self.sizes = np.ones((len(sizes), depth), np.int64)
        self.begin = np.full((len(sizes), depth), -1)
        at = 0
        for i, own in enumerate(sizes):
            self.sizes[i, : len(own)] = own
            self.begin[i, : len(own)] = at + np.cumsum(own) - own
            at += sum(own)
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def numbers(self, keys):
        """The number of each key; -1 where there is none, anything for a key not built in."""
        out = np.full(len(keys), -1)
        cell = self.local[cell_of(keys, self.cells)]
        open_ = np.flatnonzero(cell >= 0)
        for level in range(self.sizes.shape[1]):
            own = cell[open_]
            begin = self.begin[own, level]
            open_, own, begin = open_[begin >= 0], own[begin >= 0], begin[begin >= 0]
            if not len(open_):
                break
            at = begin + _bit(keys[open_], level, self.sizes[own, level])
            bit = np.uint64(1) << (at & 63).astype(np.uint64)
            word = self.words[at >> 6]
            hit = (word & bit) != 0
            below = np.bitwise_count(word & (bit - np.uint64(1)))
            out[open_[hit]] = (self.before[at >> 6] + below)[hit]
            open_ = open_[~hit]
        return out


def _build_cell(key, rows):
    keys = rows.column("key").to_numpy()
    sizes, words = build(keys)
    placed = np.zeros(len(keys), np.int64)
    placed[Lookup(1, [0], [sizes], [words]).numbers(keys)] = keys
    return pa.table(
        {
            "cell": pa.array([key[0].as_py()], pa.int64()),
            "sizes": pa.array([sizes], pa.list_(pa.int64())),
            "words": pa.array([words.tobytes()], pa.binary()),
            "keys": pa.array([placed.tobytes()], pa.binary()),
        }
    )


FUNCTION = "cell long, sizes array<bigint>, words binary, keys binary"


def _cells(cells):
    def run(batches):
        for rows in batches:
            yield rows.append_column("cell", pa.array(cell_of(rows.column("key").to_numpy(), cells)))

    return run


def _dense(left, right):
    """The counts of some parts as one vector, by the number of each verified key."""
    if not right.num_rows or not left.num_rows:
        raise ValueError("keys and functions do not belong together")
    own = right.to_pylist()[0]
    known = np.frombuffer(own["keys"], np.int64)
    keys = left.column("key").to_numpy()
    numbers = Lookup(1, [0], [own["sizes"]], [np.frombuffer(own["words"], np.uint64)]).numbers(keys)
    if (numbers < 0).any() or (known[numbers] != keys).any():
        raise ValueError("a key is not in the function")
    vector = np.zeros(len(known), np.int64)
    np.add.at(vector, numbers, left.column("n").to_numpy())
    return _vector(own["of"], own["to"], vector)


def _vector(cell, lane, vector):
    columns = {"cell": pa.array([cell], pa.int64()), "lane": pa.array([lane], pa.int64())}
    return pa.table({**columns, "vector": pa.array([vector.tobytes()], pa.binary())})


VECTOR = "cell long, lane long, vector binary"


def _add(key, rows):
    vectors = rows.column("vector").to_pylist()
    total = np.frombuffer(vectors[0], np.int64).copy()
    for vector in vectors[1:]:
        total += np.frombuffer(vector, np.int64)
    return _vector(key[0].as_py(), key[1].as_py(), total)


def counted(parts):
    """Functions of the distinct keys in ``part, key, n`` with the sum of ``n`` of each key.

    A row for each cell: ``cell, sizes, words, keys, vector``; ``keys`` and ``vector`` are
    8-byte integers in the order of the keys' numbers. Also returns the number of cells.
    Vectors of FAN parts are added up in one task, then FAN of these sums, until one is left.
    """
    parts = stage(parts, "parts")
    distinct = stage(parts.select("key").distinct(), "distinct")
    cells = max(1, -(-distinct.count() // CELL_KEYS))
    keyed = distinct.mapInArrow(_cells(cells), "key long, cell long")
    functions = stage(keyed.groupBy("cell").applyInArrow(_build_cell, FUNCTION), "functions")
    rows = parts.mapInArrow(_cells(cells), "part long, key long, n long, cell long")
    rows = stage(rows.withColumn("lane", F.floor(F.col("part") / FAN)), "dealt")
    lanes = rows.select(F.col("cell").alias("of"), F.col("lane").alias("to")).distinct()
    lanes = lanes.join(functions, F.col("of") == F.col("cell")).drop("cell")
    vectors = rows.groupBy("cell", "lane").cogroup(lanes.groupBy("of", "to")).applyInArrow(_dense, VECTOR)
    vectors = stage(vectors, "vectors")
    while (vectors.agg(F.max("lane")).first()[0] or 0) > 0:
        vectors = vectors.withColumn("lane", F.floor(F.col("lane") / FAN))
        vectors = stage(vectors.groupBy("cell", "lane").applyInArrow(_add, VECTOR), "vectors")
    return stage(functions.join(vectors.drop("lane"), "cell"), "counted"), cells


def _best(groups):
    """For each group of keys its largest count; ``groups`` maps keys to group numbers."""

    def run(batches):
        for rows in batches:
            for keys, vector in zip(rows.column("keys").to_pylist(), rows.column("vector").to_pylist()):
                found, at = np.unique(groups(np.frombuffer(keys, np.int64)), return_inverse=True)
                most = np.zeros(len(found), np.int64)
                np.maximum.at(most, at, np.frombuffer(vector, np.int64))
                yield batch(of=found, most=most)

    return run


def best_counts(table, groups, size):
    """The largest count of each of ``size`` groups, as one array: 8 bytes a group."""
    most = table.mapInArrow(_best(groups), "of long, most long").groupBy("of").agg(F.max("most").alias("most"))
    out = np.zeros(size, np.int64)
    for row in most.collect():
        out[row["of"]] = row["most"]
    return out


class Counts:
    """Counts of keys from some rows of a ``counted`` table."""

    def __init__(self, rows, cells):
        words = [np.frombuffer(r["words"], np.uint64) for r in rows]
        self.hash = Lookup(cells, [r["cell"] for r in rows], [r["sizes"] for r in rows], words)
        joined = lambda name: np.frombuffer(b"".join(r[name] for r in rows), np.int64)
        self.keys, self.vector = joined("keys"), joined("vector")

    def of(self, keys):
        """The count of each key, 0 for one that is not here."""
        numbers = self.hash.numbers(keys)
        out = np.zeros(len(keys), np.int64)
        here = np.flatnonzero(numbers >= 0)
        here = here[self.keys[numbers[here]] == keys[here]]
        out[here] = self.vector[numbers[here]]
        return out
