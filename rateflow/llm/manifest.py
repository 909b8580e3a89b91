"""Merkle manifest of a table, kept as postorder append logs.

Rows are leaves, numbered within their group. Aligned builders take 2^BITS consecutive leaves
each and append every node to their log as it completes, so a subtree's nodes end with its
root. The roots of a group's builders are the leaves of its next round, until one is left;
the groups' roots are built into the manifest's root in the same way. Where a node stands in
a log follows from the size of the subtrees before it, so a proof reads its siblings by
address and no tree is searched or held.
"""

import hashlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm.arrays import small_batches
from rateflow.operators.joins import broadcast_if_small
from rateflow.operators.ordering import numbered
from rateflow.session import stage

# A builder takes this many levels: 1,024 leaves.
BITS = 10
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ALONE, LEFT, RIGHT = "-", "L", "R"
TAMPERED_ONE_IN = 7


def hashed(*nodes):
    """Digest of a node from its children's, which are hashed as lower-case hex text."""
    return hashlib.sha256("".join(n.hex() for n in nodes).encode()).digest()


def height_of(leaves):
    return (leaves - 1).bit_length()


def position(level, place, leaves):
    """Where the node ``place`` of ``level`` stands in the log of a tree of ``leaves``.

    Before leaf j complete subtrees hold 2j - popcount(j) nodes; a node follows its last leaf
    by as many nodes as it stands above it.
    """
    last = min((place + 1) << level, leaves) - 1
    return 2 * last - last.bit_count() + level


def append_log(leaves, height):
    """All nodes of the tree in the order in which they complete, the root last."""
    log, waiting, last = [], [None] * (height + 1), len(leaves) - 1
    for at, node in enumerate(leaves):
        log.append(node)
        level, place = 0, at
        while level < height and (place & 1 or at == last):
            node = hashed(waiting[level], node) if place & 1 else hashed(node)
            log.append(node)
            level, place = level + 1, place >> 1
        waiting[level] = node
    return log


def siblings(log, place, leaves, height):
    """The siblings of a leaf from below, joined, and on which side each level has one."""
    found, sides = [], []
    for level in range(height):
        other = (place >> level) ^ 1
        if other << level < leaves:
            at = DIGEST * position(level, other, leaves)
            found.append(log[at : at + DIGEST])
            sides.append(RIGHT if other & 1 else LEFT)
        else:
            sides.append(ALONE)
    return b"".join(found), "".join(sides)


def fold(start, found, sides):
    """The root that a leaf and its siblings give."""
    node, at = start, 0
    for side in sides:
        if side == ALONE:
            node = hashed(node)
            continue
        other = found[at : at + DIGEST]
        at += DIGEST
        node = hashed(other, node) if side == LEFT else hashed(node, other)
    return node


def _levels(n):
    """Levels that a builder climbs in a round of ``n`` leaves."""
    return height_of(n) if n <= 1 << BITS else BITS


LOG = "key string, block long, n long, leaves int, log binary, root binary"


def _append(key, rows):
    name, block, n = (k.as_py() for k in key)
    leaves = rows.sort_by("place").column("digest").to_pylist()
    log = append_log(leaves, _levels(n))
    values = {"key": name, "block": block, "n": n, "leaves": len(leaves), "log": b"".join(log), "root": log[-1]}
    types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    return pa.table({k: pa.array([v], t) for (k, v), t in zip(values.items(), types)})


def build_logs(nodes):
    """Logs of every round over ``key, place, digest``; ``place`` counts a key's rows from 0."""
    counts = nodes.groupBy("key").agg(F.count("*").alias("n"))
    nodes = nodes.select("key", "place", "digest").join(broadcast_if_small(counts), "key")
    logs = []
    while True:
        nodes = nodes.withColumn("block", F.shiftright("place", BITS))
        logs.append(stage(nodes.groupBy("key", "block", "n").applyInArrow(_append, LOG), "log"))
        more = logs[-1].where(F.col("n") > 1 << BITS)
        if more.isEmpty():
            return logs
        n = F.ceil(F.col("n") / (1 << BITS)).cast("long").alias("n")
        nodes = more.select("key", F.col("block").alias("place"), F.col("root").alias("digest"), n)


def roots(logs):
    """``key, digest``: the root of each key's tree."""
    tops = [log.where(F.col("n") <= 1 << BITS).select("key", F.col("root").alias("digest")) for log in logs]
    out = tops[0]
    for top in tops[1:]:
        out = out.union(top)
    return out


def _read(batches):
    """Siblings of the nodes of each block, followed by those of the block's root.

    Rows come sorted by block and place; a block's first row, at place -1, brings its log.
    """
    entry, mask = None, (1 << BITS) - 1
    for rows in batches:
        places = rows.column("place").to_pylist()
        begins = [i for i, place in enumerate(places) if place < 0]
        found, sides = [], []
        for i, place in enumerate(places):
            if place < 0:
                entry = rows.column("entry")[i].as_py()
                height = _levels(entry["n"])
                continue
            own, on = siblings(entry["log"], place & mask, entry["leaves"], height)
            found.append(own + entry["above"])
            sides.append(on + entry["above_sides"])
        if begins:
            rows = rows.filter(pc.greater_equal(rows.column("place"), 0))
        rows = rows.drop_columns(["block", "entry"])
        yield rows.append_column("siblings", pa.array(found, pa.binary())).append_column("sides", pa.array(sides, pa.string()))


def paths(nodes, logs, above=None):
    """``nodes`` with ``siblings`` and ``sides``, read from the logs from the top down.

    ``nodes`` has ``key, place``; ``above`` has ``key, siblings, sides`` of the keys' roots.
    """
    nothing = (F.lit(b"").alias("above"), F.lit("").alias("above_sides"))
    upper = None
    for i, log in reversed(list(enumerate(logs))):
        top = log.where(F.col("n") <= 1 << BITS).select("key", "block", "n", "leaves", "log")
        if above is None:
            top = top.select("*", *nothing)
        else:
            ends = above.select("key", F.col("siblings").alias("above"), F.col("sides").alias("above_sides"))
            top = top.join(broadcast_if_small(ends), "key")
        if upper is not None:
            lower = log.where(F.col("n") > 1 << BITS).select("key", "block", "n", "leaves", "log")
            top = top.union(lower.join(upper, ["key", "block"]).select(top.columns))
        if not i:
            return _along(nodes, top)
        # The blocks of the round below are this round's leaves.
        blocks = logs[i - 1].where(F.col("n") > 1 << BITS).select("key", F.col("block").alias("place"))
        upper = stage(_along(blocks, top), "paths").select(
            "key", F.col("place").alias("block"), F.col("siblings").alias("above"), F.col("sides").alias("above_sides")
        )


def _along(nodes, logs):
    entry = F.struct("n", "leaves", "log", "above", "above_sides").alias("entry")
    logs = logs.select("key", "block", F.lit(-1).cast("long").alias("place"), entry)
    both = nodes.withColumn("block", F.shiftright("place", BITS)).unionByName(logs, allowMissingColumns=True)
    both = both.repartition("key", "block").sortWithinPartitions("key", "block", "place")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    return both.mapInArrow(_read, f"{fields}, siblings binary, sides string")


def canonical(columns):
    """The text that a leaf hashes: of each value its UTF-8 length, ``:`` and itself; ``-`` for a null."""
    texts = [c.cast("string") for c in columns]
    return F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


def digest(*columns):
    return F.unhex(F.sha2(canonical(columns), 256))


@dataclass
class Manifest:
    """``leaves`` has ``key, place``, the group and the digest of each row; ``logs`` and ``top``
    are the groups' and the root's logs by round; ``subroots`` has ``key, place, digest``."""

    leaves: DataFrame
    logs: list
    subroots: DataFrame
    top: list
    root: bytes

    def proofs(self):
        """``leaves`` with the siblings up to the root and the sides they stand on."""
        tops = self.subroots.select(F.lit("").alias("key"), "place", F.col("key").alias("group"))
        above = stage(paths(tops, self.top), "above").select(F.col("group").alias("key"), "siblings", "sides")
        return paths(self.leaves, self.logs, above)


def build(rows, group, order, carried=()):
    """The manifest of ``rows``, which have ``digest``; ``carried`` columns stay with the leaves.

    A group's leaves ascend by ``order`` and then by digest, nulls first; groups ascend by
    their UTF-8 bytes, the null group first. Equal rows are leaves each. A table without rows
    has no root.
    """
    key = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group))).alias("key")
    rows = rows.select(key, F.col(order).alias("order"), "digest", *carried)
    placed = numbered(rows, ["key"], ["order", "digest"], "place")
    leaves = stage(placed.withColumn("place", F.col("place") - 1).drop("order"), "leaves")
    logs = build_logs(leaves)
    ends = numbered(roots(logs).withColumn("all", F.lit("")), ["all"], ["key"], "place")
    subroots = stage(ends.select("key", (F.col("place") - 1).alias("place"), "digest"), "subroots")
    top = build_logs(subroots.select(F.lit("").alias("key"), "place", "digest"))
    root = roots(top).first()
    return Manifest(leaves, logs, subroots, top, bytes(root["digest"]) if root else None)


def _fold_rows(batches):
    for rows in batches:
        steps = zip(*(rows.column(c).to_pylist() for c in ("start", "siblings", "sides")))
        folded = pa.array([fold(*step) for step in steps], pa.binary())
        yield rows.append_column("folded", folded).drop_columns(["start"])


def folded(rows):
    """``rows`` without ``start`` and with ``folded``: the root that it and the proof give."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "start")
    return rows.mapInArrow(_fold_rows, f"{fields}, folded binary")


def manifest_check(documents):
    """One row per row: its leaf, its proof and whether the root follows from what is there.

    A leaf hashes ``doc_id, source, lang, n_chars, text``. Where 7 divides the CRC-32 of the
    decimal doc_id the row checked has one more in ``n_chars``, so it must fail; a null
    ``n_chars`` stays, and a null doc_id is never tampered with. Nulls in any column are
    leaves like others, equal rows as often as they are there; other columns are not read.
    """
    small_batches(documents.sparkSession)
    field = {name: F.col(name) for name in FIELDS}
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_ONE_IN == 0
    altered = {**field, "n_chars": F.col("n_chars") + 1}
    rows = documents.select(
        "lang",
        "doc_id",
        digest(*field.values()).alias("digest"),
        F.when(touched, digest(*altered.values())).alias("tampered"),
        F.col("doc_id").alias("of"),
    )
    made = build(rows, "lang", "doc_id", ["tampered", "of"])
    proven = made.proofs().withColumn("start", F.coalesce("tampered", "digest"))
    subroots = made.subroots.select("key", F.col("digest").alias("subroot"))
    checked = folded(proven).join(broadcast_if_small(subroots), "key")
    text = lambda c: F.lower(F.hex(c))
    root = F.lit(made.root.hex() if made.root else None).cast("string")
    return checked.select(
        F.col("of").alias("doc_id"),
        text("digest").alias("leaf"),
        text("subroot").alias("subroot"),
        root.alias("root"),
        F.sha2(text("siblings"), 256).alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (text("folded") == root).alias("verified"),
    )
