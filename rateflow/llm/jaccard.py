"""N-gram Jaccard join: count vectors in an R-tree, behind a lossless routing.

A document is its set of distinct five-word shingles. Equal sets are one set. Sets that may
link are routed together by the prefixes that any two sets with the required overlap must
share; pairs whose summed coordinate minima of count vectors are too low are left out, and
what remains connected is a family. Each family, in tiles of bounded size, is joined through
an R-tree over its count vectors, and surviving pairs are verified on their exact sets.

Routing is needed because an R-tree over all documents prunes too little: in few groups the
counts of unrelated texts are alike, in many groups every bounding box meets every other.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rateflow.llm.arrays import LOWER, batch, flat, mix, ngrams, signed, slices, small_batches, word_hashes, word_spans
from rateflow.llm.graph import components
from rateflow.operators.joins import broadcast_if_small
from rateflow.session import stage

WORDS = 5
# Link when SHARE_UP * intersection >= SHARE * union.
SHARE, SHARE_UP = 75, 100
# Shingles met in so many sets of one task are put last in the common order.
COMMON = 2
COMMON_TOTAL = 2
# Buckets up to this many sets give all their pairs; larger ones are joined through an R-tree.
SMALL_BUCKET = 10
# Beyond so many sets a bucket gives a star that is not pruned: all its sets are one family.
LARGEST_BUCKET = 20_000
# Shingles that a task of the first pass holds before it counts them.
KEYS_HELD = 1_500_000
TILE_SHINGLES = 400_000
# Sets of a family that are compared with all of it before what stays apart is cut into blocks.
HUBS = 8
# Numbers in the count vectors of one tile; beyond, its vectors get fewer groups.
TILE_COUNTS = 16_000_000
LEAF = 16


def shingle_sets(data, offsets, words=WORDS):
    """Sorted distinct shingle hashes of each text, end to end, and where each set begins."""
    lowered = LOWER[data]
    starts, ends, before = word_spans(lowered, offsets)
    hashes = word_hashes(lowered, starts, ends)
    counts = np.diff(before)
    number = np.where(counts >= words, counts - words + 1, (counts > 0).astype(np.int64))
    edges = np.concatenate(([0], np.cumsum(number)))
    out = np.empty(edges[-1], np.uint64)
    for size in range(1, words):
        short = np.flatnonzero(counts == size)
        if len(short):
            out[edges[short]] = mix(ngrams(hashes, size)[before[short]] + np.uint64(size))
    long = np.flatnonzero(counts >= words)
    if len(long):
        place = np.arange(edges[-1]) - np.repeat(edges[:-1], number)
        inside = np.repeat(counts >= words, number)
        out[inside] = ngrams(hashes, words)[(place + np.repeat(before[:-1], number))[inside]]
    for a, b in zip(edges[long], edges[long + 1]):
        out[a:b].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[edges[:-1][number > 0]] = True
    kept = np.concatenate(([0], np.cumsum(fresh)))
    return out[fresh], kept[edges]


def set_ids(shingles, edges):
    """One id per set, equal for equal sets; 0 for empty ones."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(shingles + np.uint64(1)))))
    sizes = np.diff(edges).astype(np.uint64)
    return signed(np.where(sizes > 0, mix(sums[edges[1:]] - sums[edges[:-1]] + sizes), np.uint64(0)))


def groups_for(size):
    """Number of token groups for sets of ``size``: about four shingles a group."""
    return 1 << max(3, int(size // 4).bit_length())


def count_vector(shingles, groups):
    return np.bincount((shingles & np.uint64(groups - 1)).astype(np.int64), minlength=groups)


def needed(a, b):
    """Least overlap of two linked sets of sizes ``a`` and ``b``."""
    return -(-SHARE * (a + b) // (SHARE + SHARE_UP))


def linked(a, b):
    both = len(np.intersect1d(a, b, assume_unique=True))
    return SHARE_UP * both >= SHARE * (len(a) + len(b) - both)


def _describe(batches):
    """A row for each document; a row for each prefix shingle met in several sets of the task."""
    seen, keys = set(), []
    for rows in slices(batches):
        shingles, edges = shingle_sets(*flat(rows.column("text")))
        ids, sizes = set_ids(shingles, edges), np.diff(edges)
        vectors = []
        for i, n in enumerate(sizes):
            mine = shingles[edges[i] : edges[i + 1]]
            vectors.append(np.minimum(count_vector(mine, groups_for(n)), 255).astype(np.uint8).tobytes() if n else b"")
            if n and ids[i] not in seen:
                seen.add(ids[i])
                keys.append(mine[: n // 2 + 1].copy())
        none = np.full(len(ids), None)
        yield batch(
            doc_id=rows.column("doc_id"), set_id=ids, n_shingles=sizes, counts=vectors, met=_longs(none)
        )
        if sum(map(len, keys)) > KEYS_HELD:
            yield _common(keys)
            keys = []
    if keys:
        yield _common(keys)


def _longs(values):
    return pa.array(list(values), pa.int64())


def _common(keys):
    found, met = np.unique(np.concatenate(keys), return_counts=True)
    found, met = found[met >= COMMON], met[met >= COMMON]
    empty = _longs([None] * len(found))
    return batch(
        doc_id=empty, set_id=signed(found), n_shingles=empty, counts=pa.array([None] * len(found), pa.binary()), met=met
    )


def _prefixes(common):
    """Every set of the task with the shingles of its prefix, common ones last in the order."""

    def run(batches):
        late = common.value
        seen = set()
        for rows in slices(batches):
            shingles, edges = shingle_sets(*flat(rows.column("text")))
            ids, sizes = set_ids(shingles, edges), np.diff(edges)
            new = np.array([n > 0 and not (i in seen or seen.add(i)) for i, n in zip(ids, sizes)], bool)
            last = _member(shingles, late)
            before = np.concatenate(([0], np.cumsum(~last)))
            first, of = edges[:-1], np.repeat(np.arange(len(sizes)), sizes)
            early = before[:-1] - before[first][of]
            place = np.arange(len(shingles)) - first[of]
            total = (before[edges[1:]] - before[first])[of]
            rank = np.where(last, total + place - early, early)
            keep = (rank <= sizes[of] - -(-SHARE * sizes[of] // SHARE_UP)) & new[of]
            yield batch(key=signed(shingles[keep]), set_id=ids[of][keep])

    return run


def _member(values, ordered):
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _bucket_pairs(batches):
    """Pairs of the sets that share a key; rows come sorted by key and set.

    A small bucket gives all its pairs. A larger one gives its sets as rows ``key, set``,
    marked as members; only the first few sets of a bucket are ever held.
    """
    held_key, held, count, last = None, np.zeros(0, np.int64), 0, None
    for rows in batches:
        keys, sets = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1])
        if len(keys) and count and (keys[0], sets[0]) == (held_key, last):
            fresh[0] = False
        keys, sets = keys[fresh], sets[fresh]
        if not len(keys):
            continue
        last = sets[-1]
        # The held sets of an unfinished bucket stand before this batch's, so one rule serves both.
        carried = len(held) if count and keys[0] == held_key else 0
        if carried:
            keys, sets = np.concatenate((np.full(carried, held_key), keys)), np.concatenate((held, sets))
        begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        bucket = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(keys))))
        rank = np.arange(len(keys)) - begins[bucket]
        new = np.arange(len(keys)) >= carried
        rank[new & (bucket == 0)] += count - carried if carried else 0
        a, b, member = [], [], []

        def give(left, right, marked):
            a.append(left)
            b.append(right)
            member.append(np.full(len(left), marked))

        for back in range(1, min(SMALL_BUCKET, len(keys))):
            at = np.flatnonzero(new[back:] & (bucket[back:] == bucket[:-back]) & (rank[back:] < SMALL_BUCKET)) + back
            give(sets[at - back], sets[at], False)
        far = np.flatnonzero(new & (rank >= SMALL_BUCKET))
        give(keys[far], sets[far], True)
        for i in far[rank[far] == SMALL_BUCKET]:
            first = slice(begins[bucket[i]], begins[bucket[i]] + SMALL_BUCKET)
            give(keys[first], sets[first], True)
        yield batch(a=np.concatenate(a), b=np.concatenate(b), member=np.concatenate(member))
        held_key, first, count = keys[-1], begins[-1], int(rank[-1]) + 1
        held = sets[first : first + min(count, SMALL_BUCKET)].copy()


def _bounded(batches):
    """Pairs whose summed coordinate minima reach the overlap that a link needs."""
    for rows in batches:
        sizes = [rows.column(c).to_numpy() for c in ("n_a", "n_b")]
        vectors = [rows.column(c).to_pylist() for c in ("counts_a", "counts_b")]
        keep = [bound(*v, *n) for v, n in zip(zip(*vectors), zip(*sizes))]
        yield rows.select(["a", "b"]).filter(batch(k=np.array(keep, bool)).column(0))


def unpacked(vector, size):
    """A packed count vector; a byte of 255 stands for any count up to the set's size."""
    counts = np.frombuffer(vector, np.uint8).astype(np.int64)
    return np.where(counts == 255, size, counts)


def folded(counts, groups):
    return counts.reshape(-1, groups).sum(0)


def bound(a, b, size_a, size_b):
    """Can two sets link, by their packed count vectors?"""
    if SHARE_UP * min(size_a, size_b) < SHARE * max(size_a, size_b):
        return False
    groups = min(len(a), len(b))
    a, b = folded(unpacked(a, size_a), groups), folded(unpacked(b, size_b), groups)
    return int(np.minimum(a, b).sum()) >= needed(size_a, size_b)


class RTree:
    """Points of one tile, packed by size and then by counts; every node knows its maxima."""

    def __init__(self, points, sizes):
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes))
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > LEAF:
            high, least, most = self.levels[-1]
            cuts = np.arange(0, len(high), LEAF)
            self.levels.append(
                (np.maximum.reduceat(high, cuts), np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts))
            )

    def search(self, point, size, skip=None):
        """Positions whose overlap with ``point`` may be enough; ``skip(level, nodes)`` marks others."""
        nodes = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            high, least, most = self.levels[level]
            near = (SHARE_UP * most[nodes] >= SHARE * size) & (SHARE_UP * size >= SHARE * least[nodes])
            if skip is not None:
                near &= ~skip(level, nodes)
            nodes = nodes[near]
            overlap = np.minimum(high[nodes], point).sum(1)
            nodes = nodes[overlap >= needed(size, least[nodes])]
            if level:
                below = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
                nodes = below[below < len(self.levels[level - 1][0])]
        return self.order[nodes]


def tree_links(points, sizes, confirm, queries=None, across=False):
    """Pairs that connect all points that ``confirm(i, j)`` links among those the tree finds.

    What is connected already is not looked at again, single points and whole nodes alike.
    With ``queries``, only pairs that hold one of them are looked at, and with ``across`` only
    pairs of one of them and another point.
    """
    inside = np.flatnonzero(~queries) if across else np.arange(len(sizes))
    if not len(inside):
        return []
    tree = RTree(points[inside], sizes[inside])
    # The group of every point: first those in the tree, in its order.
    place = np.empty(len(sizes), np.int64)
    place[inside[tree.order]] = np.arange(len(inside))
    if across:
        place[queries] = np.arange(len(inside), len(sizes))
    groups = np.arange(len(sizes))

    def skip(level, nodes):
        mine = groups[place[i]]
        if level == 0:
            return groups[nodes] == mine
        known = groups[: len(inside)]
        cuts = np.arange(0, len(known), LEAF**level)
        return ((np.minimum.reduceat(known, cuts) == mine) & (np.maximum.reduceat(known, cuts) == mine))[nodes]

    links = []
    for i in range(len(sizes)) if queries is None else np.flatnonzero(queries):
        for j in inside[tree.search(points[i], sizes[i], skip)]:
            one, other = groups[place[i]], groups[place[j]]
            if one != other and confirm(i, j):
                groups[groups == max(one, other)] = min(one, other)
                links.append((i, j))
    return links


def join_tile(sets, queries=None):
    """Links that connect what is linked among ``sets``, verified on the sets themselves.

    With ``queries``, what is linked between these and the others.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    groups = min(groups_for(sizes.max()), 4096, 1 << max(3, (TILE_COUNTS // len(sets)).bit_length() - 1))
    points = np.empty((len(sets), groups), np.int32)
    for i, one in enumerate(sets):
        points[i] = count_vector(one, groups)
    return tree_links(points, sizes, lambda i, j: linked(sets[i], sets[j]), queries, queries is not None)


def join_bucket(vectors, sizes):
    """Pairs that connect what may be linked in a bucket, by packed count vectors alone.

    Sets have groups by their size; each class is joined with itself and the next finer one,
    whose sets are folded to it. Linked sets are never further apart.
    """
    widths = np.array([len(v) for v in vectors])
    links = []
    for groups in np.unique(widths):
        mine = np.flatnonzero((widths == groups) | (widths == 2 * groups))
        points = np.stack([folded(unpacked(vectors[i], sizes[i]), groups) for i in mine])
        found = tree_links(points, sizes[mine], lambda i, j: True, widths[mine] == groups)
        links += [(mine[i], mine[j]) for i, j in found]
    return links


def _join_buckets(batches):
    """Rows come sorted by key; one bucket is held at a time, as its packed vectors."""
    key, ids, vectors, sizes = None, [], [], []

    def close():
        found = join_bucket(vectors, np.array(sizes, np.int64)) if len(ids) > 1 else []
        pairs = np.array([(ids[i], ids[j]) for i, j in found], np.int64).reshape(-1, 2)
        return batch(a=pairs[:, 0], b=pairs[:, 1])

    for rows in batches:
        columns = (rows.column(c).to_pylist() for c in ("key", "set_id", "counts", "n_shingles"))
        for new, set_id, counts, size in zip(*columns):
            if new != key:
                if key is not None:
                    yield close()
                key, ids, vectors, sizes = new, [], [], []
            ids.append(set_id)
            vectors.append(counts)
            sizes.append(size)
    if key is not None:
        yield close()


def _join_tiles(batches):
    """Rows come sorted by family and tile; one tile is held at a time, as its sets."""
    key, ids, sets, query = None, [], [], []

    def close():
        links = join_tile(sets, np.array(query) if any(query) else None) if len(sets) > 1 else []
        found = np.array([(ids[i], ids[j]) for i, j in links], np.int64).reshape(-1, 2)
        return batch(a=found[:, 0], b=found[:, 1])

    for rows in slices(batches):
        shingles, edges = shingle_sets(*flat(rows.column("text")))
        actual = set_ids(shingles, edges)
        columns = (rows.column(c).to_pylist() for c in ("family", "tile", "set_id", "query"))
        for i, (family, tile, set_id, asks) in enumerate(zip(*columns)):
            if (family, tile) != key:
                if key is not None:
                    yield close()
                key, ids, sets, query = (family, tile), [], [], []
            # A repeated doc_id may bring another text; the same set is taken once.
            if actual[i] == set_id and set_id not in ids[-1:]:
                ids.append(set_id)
                sets.append(shingles[edges[i] : edges[i + 1]].copy())
                query.append(asks)
    if key is not None:
        yield close()


def _tiled(documents, members):
    """Links found within each tile of ``members(family, tile, set_id, doc_id, query)``."""
    texts = documents.where("text is not null").select("doc_id", "text")
    rows = texts.join(broadcast_if_small(members), "doc_id").select("family", "tile", "set_id", "query", "text")
    rows = rows.repartition("family", "tile").sortWithinPartitions("family", "tile", "set_id")
    return rows.mapInArrow(_join_tiles, "a long, b long")


def _near_in_small(pairs, sets):
    pairs = pairs.where("not member").select("a", "b")
    for side in "ab":
        mine = sets.select(
            F.col("set_id").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("counts").alias(f"counts_{side}")
        )
        pairs = pairs.join(mine, side)
    return pairs.mapInArrow(_bounded, "a long, b long")


def _near_in_large(pairs, sets):
    members = pairs.where("member").select(F.col("a").alias("key"), F.col("b").alias("set_id"))
    largest = members.groupBy("key").agg(F.count("*").alias("n"), F.min("set_id").alias("hub"))
    largest = broadcast_if_small(stage(largest.where(F.col("n") > LARGEST_BUCKET), "largest"))
    star = members.join(largest, "key").select(F.col("hub").alias("a"), F.col("set_id").alias("b")).where("a != b")
    rest = members.join(largest, "key", "left_anti").join(sets, "set_id")
    rest = rest.select("key", "set_id", "counts", "n_shingles").repartition("key").sortWithinPartitions("key")
    return star.union(rest.mapInArrow(_join_buckets, "a long, b long"))


def _families(documents, sets, common):
    """Sets that candidate pairs connect: ``family, set_id, doc_id, n_shingles, tile, tiles``."""
    routed = documents.select("text").mapInArrow(_prefixes(common), "key long, set_id long")
    routed = routed.repartition("key").sortWithinPartitions("key", "set_id")
    pairs = routed.mapInArrow(_bucket_pairs, "a long, b long, member boolean")
    pairs = stage(pairs.distinct(), "pairs")
    near = components(_near_in_small(pairs, sets).union(_near_in_large(pairs, sets)))
    members = near.withColumnsRenamed({"id": "set_id", "component": "family"})
    members = members.join(sets.select("set_id", "doc_id", "n_shingles"), "set_id")
    total = members.groupBy("family").agg(F.ceil(F.sum("n_shingles") / TILE_SHINGLES).alias("tiles"))
    members = members.join(total, "family")
    tile = F.pmod(F.xxhash64("set_id"), F.col("tiles"))
    return stage(members.select("family", "set_id", "doc_id", "n_shingles", tile.alias("tile"), "tiles"), "families")


def _verified(documents, families):
    """Links that connect every pair of sets with enough overlap.

    The smallest set of a family, its id, stands in each of the family's tiles. Where more
    than a tile stays apart from a family's main group, the sets with most links of several
    groups are queries against all its tiles. What is apart then is cut into blocks, and each
    block meets each part of the family on its own, so no tile holds more than two parts.
    """
    hub = F.col("set_id") == F.col("family")
    everywhere = families.where(hub).withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    members = families.where(~hub).union(everywhere.select(families.columns))
    columns = ["family", F.col("tile").cast("long").alias("tile"), "set_id", "doc_id"]
    links = stage(_tiled(documents, members.select(*columns, F.lit(False).alias("query"))), "links")
    large = families.where("tiles > 1")
    if large.isEmpty():
        return links
    parts = _parts(large, links)
    crowded = parts.where("blocks > 1").select("family").distinct()
    if not crowded.isEmpty():
        hubs = _hubs(parts.join(crowded, "family", "left_semi"), links)
        asking = hubs.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).where("at != tile")
        asking = asking.withColumn("tile", F.col("at")).select(*columns, F.lit(True).alias("query"))
        others = large.join(crowded, "family", "left_semi").select(*columns, F.lit(False).alias("query"))
        links = links.union(stage(_tiled(documents, asking.union(others)), "links"))
        parts = _parts(large, links)
    met = _met(parts)
    if met.isEmpty():
        return links
    return links.union(stage(_tiled(documents, met), "links"))


def _parts(large, links):
    """``large`` with what is apart from a family's largest group, cut into ``blocks``, the rest into ``rests``."""
    joined = components(links).withColumnsRenamed({"id": "set_id", "component": "group"})
    rows = large.join(joined, "set_id", "left").withColumn("group", F.coalesce("group", "set_id"))
    sizes = rows.groupBy("family", "group").agg(F.sum("n_shingles").alias("n"))
    main = sizes.groupBy("family").agg(
        F.max_by("group", F.struct("n", "group")).alias("main"), F.sum("n").alias("total"), F.max("n").alias("most")
    )
    parts = (F.ceil((F.col("total") - F.col("most")) / TILE_SHINGLES), F.ceil(F.col("most") / TILE_SHINGLES))
    main = main.select("family", "main", parts[0].alias("blocks"), parts[1].alias("rests")).where("blocks > 0")
    rows = rows.join(main, "family").withColumn("apart", F.col("group") != F.col("main"))
    return stage(rows.drop("main"), "parts")


def _hubs(parts, links):
    """The sets with most links in their groups, at most ``HUBS`` a family."""
    ends = links.select(F.explode(F.array("a", "b")).alias("set_id")).groupBy("set_id").agg(F.count("*").alias("degree"))
    rows = parts.select("family", "set_id", "doc_id", "tile", "tiles", "group").join(ends, "set_id")
    rows = rows.withColumn("one", F.struct("degree", "set_id", "doc_id", "tile", "tiles"))
    best = rows.groupBy("family", "group").agg(F.max("one").alias("one"))
    # Few groups by few hashes, so that no list grows with the family.
    best = best.groupBy("family", F.pmod(F.xxhash64("group"), F.lit(8 * HUBS)).alias("share")).agg(F.max("one").alias("one"))
    best = best.groupBy("family").agg(F.slice(F.sort_array(F.collect_list("one"), False), 1, HUBS).alias("most"))
    return stage(best.select("family", F.explode("most").alias("one")).select("family", "one.*"), "hubs")


def _met(parts):
    """Rows for tiles of two parts of a family of which one is a block of sets apart, or of one such block alone."""
    block = F.pmod(F.xxhash64("set_id", F.lit(1)), F.when(F.col("apart"), F.col("blocks")).otherwise(F.col("rests")))
    parts = parts.withColumn("all", F.col("blocks") + F.col("rests"))
    parts = parts.withColumn("mine", F.when(F.col("apart"), block).otherwise(F.col("blocks") + block))
    last = F.when(F.col("apart"), F.col("all")).otherwise(F.col("blocks")) - 1
    rows = parts.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    tile = F.least("mine", "other") * F.col("all") + F.greatest("mine", "other")
    return rows.select("family", tile.alias("tile"), "set_id", "doc_id", (F.col("mine") < F.col("other")).alias("query"))


def jaccard_components(documents):
    """Table ``doc_id, n_shingles, component_id``, one row per row of ``documents``.

    Documents link when 100 * intersection >= 75 * union of their shingle sets; the component
    is the smallest doc_id reachable. A null, empty or blank text has the empty set and links
    with nothing. Equal sets are linked whatever their number. A row without doc_id has no
    component of its own and takes that of its links. Other columns are not read.
    """
    spark = documents.sparkSession
    small_batches(spark)
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, set_id long, n_shingles long, counts binary, met long"
    described = stage(documents.mapInArrow(_describe, schema), "sets")
    rows = described.where("met is null")
    sets = rows.where("n_shingles > 0").groupBy("set_id")
    sets = sets.agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("counts").alias("counts"))
    sets = stage(sets.where("doc_id is not null"), "sets")
    met = described.where("met is not null").groupBy("set_id").agg(F.sum("met").alias("met"))
    common = _most_met(met, spark)
    families = _families(documents, sets, common)
    joined = components(_verified(documents, families))
    joined = stage(joined.withColumnsRenamed({"id": "set_id", "component": "group"}), "groups")
    rows = rows.select("doc_id", "n_shingles", "set_id").join(joined, "set_id", "left")
    empty = F.col("n_shingles") == 0
    rows = rows.withColumn("group", F.coalesce("group", "set_id"))
    least = rows.where(~empty).groupBy("group").agg(F.min("doc_id").alias("component_id"))
    known = rows.where(~empty).join(least, "group").select("doc_id", "n_shingles", "component_id")
    return known.union(rows.where(empty).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _most_met(met, spark, limit=1_000_000):
    """The shingles to put last, sorted: at most ``limit``, 8 MB. Any choice gives right results,
    since all sets use the same order; a good one keeps buckets small."""
    top = met.where(F.col("met") >= COMMON_TOTAL).orderBy(F.desc("met"), "set_id").limit(limit)
    found = top.select("set_id").toPandas()["set_id"].to_numpy(np.int64)
    return spark.sparkContext.broadcast(np.sort(found.view(np.uint64)))
