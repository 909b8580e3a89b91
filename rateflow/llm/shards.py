"""Token sequences in training order, as binary shards of fixed stride.

Texts become token ids, cut into sequences of one length. Sequences are numbered by document,
and a keyed Feistel network with cycle-walking turns a number into a slot: a permutation of
exactly as many slots as there are sequences. A shard is a range of slots; it is written by
one task, in slot order, under a name of its own that becomes final when it is whole. So a
run that is repeated skips what is there, and a reader may begin at any slot.
"""

import array
import base64
import json
import sys
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from rateflow.llm.arrays import batch, mix, slices, small_batches
from rateflow.operators.joins import broadcast_if_small
from rateflow.session import stage

LENGTH = 256
# Slots a shard, 16 MiB of tokens.
SHARD_SLOTS = 1 << 15
ROUNDS = 6
HEADER = np.dtype([("doc_id", "<i8"), ("chunk", "<u4"), ("n_tokens", "<u4")])
# Fixed value: how the public vocabulary splits a text before it merges bytes.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_ranks(path):
    """Token bytes by id of a vocabulary file with one base64 token and its id a line."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    out = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    if len(out) > 1 << 16:
        raise ValueError("ids of two bytes are written; the vocabulary is larger")
    return out


def encoding(ranks):
    """The vocabulary's encoder; a worker process builds it once and keeps it by its content."""
    import tiktoken
    from tiktoken.registry import ENCODINGS

    name = f"ranks-{zlib.crc32(b' '.join(ranks))}-{len(ranks)}"
    if name not in ENCODINGS:
        known = {token: i for i, token in enumerate(ranks) if token}
        ENCODINGS[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=known, special_tokens={})
    return ENCODINGS[name]


def permute(numbers, total, key, rounds=ROUNDS):
    """Slots of ``numbers``: a permutation of 0 to ``total`` - 1 that ``key`` chooses.

    A Feistel network permutes the next power of four; what falls outside walks on.
    """
    half = np.uint64(max(1, (max(1, int(total) - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mix(np.arange(rounds, dtype=np.uint64) + mix(np.array([key % 2**64], np.uint64)))
    out = np.asarray(numbers).astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> half, out[walking] & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        out[walking] = (left << half) | right
        walking = walking[out[walking] >= np.uint64(total)]
    return out.astype(np.int64)


def _count(ranks):
    def run(batches):
        encode = encoding(ranks.value).encode_ordinary
        for rows in slices(batches):
            sizes = [len(encode(t)) if t else 0 for t in rows.column("text").to_pylist()]
            yield batch(row=rows.column("row"), doc_id=rows.column("doc_id"), n_tokens=np.array(sizes, np.int64))

    return run


def _numbered(counts, length):
    """The number of each row's first sequence, in the order of doc_id and row; and how many there are.

    Rows are range-partitioned; totals of partitions, one number each, give the offsets.
    """
    # Staged first: the sampling for a range partitioning would encode every text again.
    ranged = stage(counts, "counts").repartitionByRange("doc_id", "row").withColumn("part", F.spark_partition_id())
    ranged = ranged.withColumn("n", F.ceil(F.col("n_tokens") / length))
    ranged = stage(ranged, "ranged")
    parts = ranged.groupBy("part").agg(F.sum("n").alias("all"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part").orderBy("doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(F.broadcast(parts), "part")
    first = (F.col("offset") + F.coalesce(F.sum("n").over(within), F.lit(0))).cast("long")
    total = ranged.agg(F.sum("n")).first()[0] or 0
    # Rows alike in id and text are numbered apart, so each takes its own share.
    placed = placed.select("row", first.alias("first")).groupBy("row").agg(F.collect_list("first").alias("firsts"))
    return placed, int(total)


def _packed(ids):
    """Ids as two bytes each, the lower one first."""
    numbers = array.array("H", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


def _cut(ranks, length, total, key):
    """A row for each sequence: its slot and packed tokens."""

    def run(batches):
        encode = encoding(ranks.value).encode_ordinary
        for rows in slices(batches):
            firsts = rows.column("firsts").to_pylist()
            ids = rows.column("doc_id").to_pylist()
            numbers, owners, chunks, tokens = [], [], [], []
            for doc_id, text, begins in zip(ids, rows.column("text").to_pylist(), firsts):
                packed = _packed(encode(text))
                for chunk, at in enumerate(range(0, len(packed), 2 * length)):
                    for first in begins:
                        numbers.append(first + chunk)
                        owners.append(doc_id)
                        chunks.append(chunk)
                        tokens.append(packed[at : at + 2 * length])
            yield batch(
                slot=permute(np.array(numbers, np.int64), total, key),
                doc_id=pa.array(owners, pa.int64()),
                chunk=np.array(chunks, np.int32),
                tokens=pa.array(tokens, pa.binary()),
            )

    return run


def shard_name(path, shard):
    return f"{path}/shard-{shard:08d}.bin"


def _begin(path, state):
    """Prepares ``path`` for a run: shards of another run go, those of this one stay.

    The record is written when they are gone, so shards beside a record are of its run.
    """
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path)
    store.create_dir(root, recursive=True)
    record, wanted = f"{root}/{RECORD}", json.dumps(state, sort_keys=True).encode()
    if store.get_file_info(record).type != fs.FileType.NotFound:
        with store.open_input_file(record) as file:
            if file.read() == wanted:
                return
        store.delete_file(record)
    for file in store.get_file_info(fs.FileSelector(root)):
        if file.base_name.startswith("shard-"):
            store.delete_file(file.path)
    with store.open_output_stream(f"{record}.new") as out:
        out.write(wanted)
    store.move(f"{record}.new", record)


def _write(path, length, total, shard_slots):
    """Writes whole shards; rows come sorted by slot. Gives where each sequence is."""
    from pyarrow import fs

    stride = HEADER.itemsize + 2 * length

    def run(batches):
        store, root = fs.FileSystem.from_uri(path)
        store.create_dir(root, recursive=True)
        current, out, temporary = None, None, None

        def finish():
            if out is not None:
                out.close()
                store.move(temporary, shard_name(root, current))

        for rows in batches:
            slots = rows.column("slot").to_numpy()
            shards = slots // shard_slots
            for shard in np.unique(shards):
                part = rows.filter(pa.array(shards == shard))
                if shard != current:
                    finish()
                    current, out = shard, None
                    size = stride * min(shard_slots, total - int(shard) * shard_slots)
                    there = store.get_file_info(shard_name(root, shard))
                    if there.type == fs.FileType.NotFound or there.size != size:
                        temporary = f"{shard_name(root, shard)}.{uuid.uuid4().hex}"
                        out = store.open_output_stream(temporary)
                if out is not None:
                    out.write(_records(part, length))
            sizes = pc.binary_length(rows.column("tokens")).to_numpy()
            yield batch(
                slot=slots,
                shard=shards,
                byte_offset=slots % shard_slots * stride,
                doc_id=rows.column("doc_id"),
                chunk=rows.column("chunk"),
                n_tokens=(sizes // 2).astype(np.int32),
            )
        finish()

    return run


def _records(rows, length):
    record = np.dtype([("head", HEADER), ("tokens", "<u2", (length,))])
    out = np.zeros(rows.num_rows, record)
    out["head"]["doc_id"] = rows.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
    out["head"]["chunk"] = rows.column("chunk").to_numpy()
    tokens = rows.column("tokens")
    sizes = pc.binary_length(tokens).to_numpy() // 2
    own = np.frombuffer(b"".join(tokens.to_pylist()), "<u2")
    place = np.arange(len(own)) + np.repeat(length * np.arange(len(sizes)) - (np.cumsum(sizes) - sizes), sizes)
    filled = np.zeros(rows.num_rows * length, "<u2")
    filled[place] = own
    out["tokens"] = filled.reshape(-1, length)
    out["head"]["n_tokens"] = sizes
    return out.tobytes()


RECORD = "written.json"
MANIFEST = "slot long, shard long, byte_offset long, doc_id long, chunk int, n_tokens int"


def write_shards(documents, path, ranks_file, key=0, length=LENGTH, shard_slots=SHARD_SLOTS):
    """Writes ``documents`` to ``path`` and returns where each sequence is.

    The result has a row for each sequence: ``slot, shard, byte_offset, doc_id, chunk,
    n_tokens``. Null and empty texts have none. A sequence shorter than ``length`` is filled
    with 0; a null doc_id is written as -1. Equal rows are written as often as they are
    there. The same documents, key and sizes give the same files, so a repeated run skips the
    shards that are whole; a run of anything else removes them first. Other columns are not read.
    """
    small_batches(documents.sparkSession)
    ranks = documents.sparkSession.sparkContext.broadcast(load_ranks(ranks_file))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    counts = rows.mapInArrow(_count(ranks), "row long, doc_id long, n_tokens long").where("n_tokens > 0")
    placed, total = _numbered(counts, length)
    # Of equal rows one writes for all.
    placed = stage(placed, "placed")
    marks = [F.sum(F.xxhash64(*both).cast("decimal(38,0)")) for both in (("row", "firsts"), ("firsts", "row"))]
    state = [str(v) for v in placed.withColumn("firsts", F.array_sort("firsts")).agg(F.count("*"), *marks).first()]
    vocabulary = zlib.crc32(b" ".join(ranks.value))
    _begin(path, {"rows": state, "key": key, "length": length, "shard_slots": shard_slots, "vocabulary": vocabulary})
    repeated = placed.where(F.size("firsts") > 1)
    alike = rows.join(broadcast_if_small(repeated.select("row")), "row", "left_semi").dropDuplicates(["row"])
    firsts = placed.where(F.size("firsts") == 1).select("row", F.element_at("firsts", 1).alias("first"))
    single = rows.join(broadcast_if_small(firsts), "row").select("doc_id", "text", F.array("first").alias("firsts"))
    rows = single.union(alike.join(repeated, "row").select("doc_id", "text", "firsts"))
    cut = rows.mapInArrow(_cut(ranks, length, total, key), "slot long, doc_id long, chunk int, tokens binary")
    shards = max(1, -(-total // shard_slots))
    cut = cut.repartition(shards, F.expr(f"slot div {shard_slots}")).sortWithinPartitions("slot")
    return stage(cut.mapInArrow(_write(path, length, total, shard_slots), MANIFEST), "manifest")


def read_slots(path, start, count, length=LENGTH, shard_slots=SHARD_SLOTS):
    """Sequences from a slot on, in order, as ``doc_id, chunk, tokens``: what a trainer reads."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path)
    record = np.dtype([("head", HEADER), ("tokens", "<u2", (length,))])
    slot = start
    while slot < start + count:
        shard, place = divmod(slot, shard_slots)
        if store.get_file_info(shard_name(root, shard)).type == fs.FileType.NotFound:
            return
        with store.open_input_file(shard_name(root, shard)) as file:
            file.seek(place * record.itemsize)
            data = file.read(min(shard_slots - place, start + count - slot) * record.itemsize)
        for row in np.frombuffer(data, record):
            yield int(row["head"]["doc_id"]), int(row["head"]["chunk"]), row["tokens"][: row["head"]["n_tokens"]]
            slot += 1
        if slot % shard_slots:
            return


def decode(tokens, ranks):
    return b"".join(ranks[t] for t in tokens)
