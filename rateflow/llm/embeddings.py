"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors are brought to unit length; a table's key is a tuple of random projections, shifted
and cut into cells. Vectors that share a key in any table are compared by their cosine in
double precision. A pair counts in the first table where it meets, so no pair is listed to
be told apart from itself. Equal vectors are one, with their number.
"""

from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rateflow.llm.arrays import batch, mix, small_batches
from rateflow.llm.graph import components
from rateflow.session import stage

COSINE = 0.95
CELL = 2.0
# Chance that a pair exactly at the threshold meets in some table; closer pairs meet more often.
RECALL = 0.98
SEED = 20_240_501
BLOCK = 1000


def collision(distance, cell=CELL):
    """Chance that two vectors so far apart share a cell of one projection."""
    c = cell / distance
    tail = 0.5 * (1 - erf(c / sqrt(2)))
    return 1 - 2 * tail - 2 / (sqrt(2 * pi) * c) * (1 - exp(-c * c / 2))


def plan(count, cosine=COSINE, recall=RECALL):
    """Projections a table and tables, for ``count`` vectors: unrelated ones share few keys."""
    near, far = collision(sqrt(2 - 2 * cosine)), collision(sqrt(2))
    width = max(4, ceil(0.8 * log(max(count, 2)) / -log(far)))
    return width, ceil(log(1 - recall) / log(1 - near**width))


def _usable():
    """Can a vector be compared: no nulls, all finite, not all zero?"""
    vector = F.col("embedding").cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(fine & some, F.lit(False))


def _units(column):
    """Vectors of one length as rows of unit length, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    # A first scaling keeps squares of very large and very small numbers in range.
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _by_size(rows):
    """Parts of a batch whose vectors have one length."""
    sizes = np.array(rows.column("embedding").value_lengths())
    for size in np.unique(sizes):
        yield int(size), rows.filter(pa.array(sizes == size))


def table_keys(units, width, tables):
    """A 32-bit key of each vector in each table."""
    size = units.shape[1]
    random = np.random.default_rng((SEED, size))
    directions = random.standard_normal((size, width * tables))
    shifts = random.uniform(0, CELL, width * tables)
    cells = np.floor((units @ directions + shifts) / CELL).astype(np.int64).view(np.uint64)
    keys = np.full((len(units), tables), size, np.uint64)
    for j in range(width):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + cells[:, j::width])
    return (keys >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _keyed(width, tables):
    def run(batches):
        for rows in batches:
            for _, part in _by_size(rows):
                keys = table_keys(_units(part.column("embedding")), width, tables)
                ids = np.repeat(part.column("id").to_numpy(), tables)
                number = np.tile(np.arange(tables, dtype=np.int32), len(keys))
                yield batch(id=ids, number=number, key=keys.ravel())

    return run


def _labels(linked):
    """The least index that each row of a symmetric link matrix reaches."""
    label = np.arange(len(linked))
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], len(label)).min(1, initial=len(label)))
        least = np.minimum(least, least[least])
        if (least == label).all():
            return label
        label = least


def compare(units, keys, number, mine, other, cosine=COSINE):
    """Links that first meet in table ``number`` between two blocks, given by their rows."""
    found = units[mine] @ units[other].T >= cosine
    if mine is other:
        np.fill_diagonal(found, False)
    for earlier in range(number):
        if not found.any():
            break
        found &= keys[mine, earlier][:, None] != keys[other, earlier][None, :]
    return found


def _compare_blocks(width, tables, cosine):
    """Rows come sorted by table, key and pair of blocks; one pair of blocks is held at a time."""

    def close(group):
        rows = pa.Table.from_batches(group).combine_chunks().to_batches()[0]
        ids, copies, side = (rows.column(c).to_numpy() for c in ("id", "copies", "side"))
        number = rows.column("number")[0].as_py()
        units = _units(rows.column("embedding"))
        keys = table_keys(units, width, tables)
        left = np.flatnonzero(side == 0)
        right = left if rows.column("one")[0].as_py() == rows.column("two")[0].as_py() else np.flatnonzero(side == 1)
        found = compare(units, keys, number, left, right, cosine)
        links = np.zeros(len(ids), np.int64)
        links[left] += found @ copies[right]
        if right is not left:
            links[right] += found.T @ copies[left]
        whole = np.zeros((len(ids), len(ids)), bool)
        whole[np.ix_(left, right)] = found
        label = _labels(whole | whole.T) if found.any() else np.arange(len(ids))
        touched = links > 0
        return batch(id=ids[touched], other=ids[label][touched], links=links[touched])

    def run(batches):
        last, group = None, []
        for rows in batches:
            if not rows.num_rows:
                continue
            columns = [rows.column(c).to_numpy() for c in ("number", "key", "one", "two", "size")]
            change = np.zeros(rows.num_rows, bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            begins = np.flatnonzero(change).tolist()
            for a, b in zip([0, *begins], [*begins, rows.num_rows]):
                this = tuple(c[a] for c in columns)
                if group and this != last:
                    yield close(group)
                    group = []
                last = this
                group.append(rows.slice(a, b - a))
        if group:
            yield close(group)

    return run


def near_duplicates(vectors, cosine=COSINE):
    """Table ``vec_id, n_links, component_id, kept``, one row per row of ``vectors``.

    ``n_links`` counts the other rows found at a cosine of at least ``cosine``,
    ``component_id`` is the smallest vec_id reachable by links. Vectors that are null, empty,
    zero or hold null or non-finite numbers link with nothing, and so do vectors of unequal
    length. Equal vectors all link, whatever their number. Other columns are not read.
    """
    small_batches(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    marks = F.xxhash64("embedding"), F.xxhash64(F.reverse("embedding"))
    usable = rows.where(_usable()).select("vec_id", "embedding", marks[0].alias("h1"), marks[1].alias("h2"))
    members = stage(usable.select("vec_id", "h1", "h2"), "members")
    distinct = usable.groupBy("h1", "h2").agg(F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    distinct = stage(distinct.withColumn("id", F.xxhash64("h1", "h2")), "distinct")
    width, tables = plan(distinct.count(), cosine)
    source = distinct.select("id", "embedding")
    keyed = stage(source.mapInArrow(_keyed(width, tables), "id long, number int, key int"), "keys")
    sizes = keyed.groupBy("number", "key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n"))
    met = keyed.join(sizes.where("n > 1").drop("n"), ["number", "key"])
    met = met.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # Each vector goes to every pair of blocks that holds its own.
    pair = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(
            F.least("block", j).alias("one"), F.greatest("block", j).alias("two"), F.when(j < F.col("block"), 1).otherwise(0).alias("side")
        ),
    )
    met = met.select("id", "number", "key", F.explode(pair).alias("p")).select("id", "number", "key", "p.*")
    full = met.join(distinct.select("id", "copies", "embedding"), "id").withColumn("size", F.size("embedding"))
    order = ["number", "key", "one", "two", "size"]
    full = full.repartition(*order).sortWithinPartitions(*order)
    found = full.mapInArrow(_compare_blocks(width, tables, cosine), "id long, other long, links long")
    found = stage(found, "links")
    groups = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    groups = groups.withColumnsRenamed({"component": "group"})
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    known = distinct.select("h1", "h2", "id", "copies").join(links, "id", "left").join(groups, "id", "left")
    known = known.select("h1", "h2", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("group", "id").alias("group"))
    known = members.join(known, ["h1", "h2"])
    least = known.groupBy("group").agg(F.min("vec_id").alias("component_id"))
    linked = known.join(least, "group").select("vec_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    alone = rows.where(~_usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
