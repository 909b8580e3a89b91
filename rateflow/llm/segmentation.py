"""SentencePiece encoding by Gumbel top-k over the segmentation lattice, and decoding.

Every text is a lattice of vocabulary pieces. A segmentation's log-probability is perturbed
with Gumbel noise, and a best-first search emits the k segmentations with the largest
perturbed values, so they are distinct and drawn without replacement. The perturbed value of
a node of the search tree is the largest below it: a path keeps it, and what branches off a
path has an independent value, cut off at it. So the frontier is the branches along the paths
found so far, and its best entry gives the next segmentation. Noise is a function of the seed
and of the row's key.

Pieces do not reach over a space or a line break, so a text is a row of units and equal units
share their lattice. Characters without a piece are spelled in bytes; decoding gives every
text back exactly.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from rateflow.llm.arrays import batch, flat, mix, ngrams, slices, small_batches, word_hashes

SPACE = "▁"
# Stands for a literal U+2581, which no piece may cover.
LITERAL = 0x110001
SLICE = 1 << 20
# Units up to so many characters are summed in plain numbers, scaled; longer ones as logarithms.
PLAIN = 100
_SCALE = 4.0
TABLE_BITS = 18
_STEP = 0x9E3779B97F4A7C15


def load_vocabulary(model_file, alpha=1.0, offset=10.0):
    """Pieces of a SentencePiece model as plain arrays, fit for a broadcast.

    A piece's log-probability is -alpha * log(offset + rank): the file's own scores are ranks.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    surface, by_length, bytes_at = [], {}, np.full(256, -1, np.int64)
    scores = np.array([model.get_score(i) for i in range(size)])
    logs = -alpha * np.log(offset + np.maximum(0, -scores))
    lowest = float(logs.min())
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_at[int(piece[3:-1], 16)] = i
            surface.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            surface.append(b"")
        else:
            surface.append(piece.replace(SPACE, " ").encode())
            by_length.setdefault(len(piece), []).append((piece, i))
    hashes, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for length, pieces in by_length.items():
        points = np.frombuffer("".join(p for p, _ in pieces).encode("utf-32-le"), np.uint32)
        hashes.append(_rolled(points.astype(np.uint64).reshape(-1, length)))
        ids.append(np.array([i for _, i in pieces]))
    if (bytes_at < 0).any():
        raise ValueError("the model has no byte pieces, so not every text can be encoded")
    hashes, ids = np.concatenate(hashes), np.concatenate(ids).astype(np.int32)
    return {
        "hashes": hashes,
        "ids": ids,
        "logs": logs[ids],
        "slots": _slots(hashes),
        "longest": max(by_length, default=0),
        "bytes": bytes_at,
        "byte_log": lowest,
        "surface": surface,
    }


def _slots(hashes):
    """Tables from parts of a hash to its place; what a table has no room for is in the next."""
    tables, left, shift = [], np.arange(len(hashes)), 64 - TABLE_BITS
    while len(left):
        slots, first = np.unique((hashes[left] >> np.uint64(shift)) % np.uint64(1 << TABLE_BITS), return_index=True)
        table = np.full(1 << TABLE_BITS, -1, np.int32)
        table[slots.astype(np.int64)] = left[first]
        tables.append((shift, table))
        left = np.delete(left, first)
        shift = (shift - 9) % (64 - TABLE_BITS)
    return tables


def _places(values, vocabulary):
    """The place of each hash among the vocabulary's, or -1."""
    found = np.full(len(values), -1, np.int64)
    for shift, table in vocabulary["slots"]:
        at = table[((values >> np.uint64(shift)) & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)]
        hit = np.flatnonzero(at >= 0)
        hit = hit[vocabulary["hashes"][at[hit]] == values[hit]]
        found[hit] = at[hit]
    return found


def _rolled(rows):
    out = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        out = out * np.uint64(_STEP) + column + np.uint64(1)
    return mix(out)


def split_units(data, offsets):
    """Units of UTF-8 texts, each with a space before it as the model expects.

    A unit is a space and what follows it up to the next space or line break, a line break,
    or what follows a line break. Returns the bytes with those spaces, where units begin and
    end, and the number of units before each text. An empty text has none.
    """
    lengths = np.diff(offsets)
    filled = (lengths > 0).astype(np.int64)
    shifted = np.concatenate(([0], np.cumsum(lengths + filled)))
    out = np.full(shifted[-1], 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(shifted[:-1] + filled - offsets[:-1], lengths)] = data
    start = (out == 32) | (out == 10)
    start[1:] |= out[:-1] == 10
    start[shifted[:-1][lengths > 0]] = True
    starts = np.flatnonzero(start)
    return out, starts, np.append(starts[1:], len(out)), np.searchsorted(starts, shifted)


def distinct_units(data, starts, ends):
    """The text of distinct units end to end, their lengths, and the number of each unit."""
    _, first, number = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    begins, sizes = starts[first], (ends - starts)[first]
    before = np.concatenate(([0], np.cumsum(sizes)))
    place = np.arange(before[-1]) + np.repeat(begins - before[:-1], sizes)
    own = data[place]
    heads = np.concatenate(([0], np.cumsum((own & 0xC0) != 0x80)))
    text = own.tobytes().decode("utf-8", "surrogatepass")
    return text, np.diff(heads[before]), number.ravel()


def _from_ends(total, edges, source, target, far, values, step, gather):
    """Sums over all ways from each node to its unit's end, nearest nodes first."""
    far = far[edges]
    steps = np.cumsum(np.bincount(far, minlength=1))
    # Sorting 16-bit numbers takes linear time.
    order = np.argsort(far.astype(np.uint16) if len(steps) <= 1 << 16 else far, kind="stable")
    edges, values = edges[order], values[order]
    for a, b in zip(steps[:-1], steps[1:]):
        here = source[edges[a:b]]
        begins = np.flatnonzero(np.concatenate(([True], here[1:] != here[:-1])))
        total[here[begins]] = gather.reduceat(step(values[a:b], total[target[edges[a:b]]]), begins)
    return total


class Lattice:
    """The lattices of distinct units: nodes are places between characters, edges are pieces."""

    def __init__(self, text, lengths, vocabulary):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        points = np.where(points == ord(SPACE), LITERAL, np.where(points == 32, ord(SPACE), points))
        units = len(lengths)
        before = np.concatenate(([0], np.cumsum(lengths)))
        self.roots = before[:-1] + np.arange(units)
        # Numbers of nodes and edges fit 32 bits: a slice is a few megabytes.
        node = (np.arange(len(points)) + np.repeat(np.arange(units), lengths)).astype(np.int32)
        left = np.repeat(before[1:], lengths) - np.arange(len(points))
        values = points.astype(np.uint64)
        sources, targets, pieces, logs = [], [], [], []
        known = np.zeros(len(points), bool)
        rolled = np.zeros(len(points), np.uint64)
        at = np.arange(len(points))
        for length in range(1, vocabulary["longest"] + 1):
            at = at[left[at] >= length]
            rolled[at] = rolled[at] * np.uint64(_STEP) + values[at + length - 1] + np.uint64(1)
            found = _places(mix(rolled[at]), vocabulary)
            hit = np.flatnonzero(found >= 0)
            sources.append(node[at[hit]])
            targets.append(node[at[hit]] + length)
            pieces.append(vocabulary["ids"][found[hit]])
            logs.append(vocabulary["logs"][found[hit]])
            if length == 1:
                known[at[hit]] = True
        rare = np.flatnonzero(~known)
        real = np.where(points[rare] == LITERAL, ord(SPACE), points[rare])
        spelled = 1 + (real > 0x7F) + (real > 0x7FF) + (real > 0xFFFF)
        sources.append(node[rare])
        targets.append(node[rare] + 1)
        pieces.append((-1 - real).astype(np.int32))
        logs.append(spelled * vocabulary["byte_log"])
        source = np.concatenate(sources)
        order = np.argsort(source, kind="stable")
        self.target, self.piece = np.concatenate(targets)[order], np.concatenate(pieces)[order]
        source, log = source[order], np.concatenate(logs)[order]
        count = len(points) + units
        self.first = np.searchsorted(source, np.arange(count + 1))
        self._weigh(source, log, left, node, count)

    def _weigh(self, source, log, left, node, count):
        """Turns weights into the chance of each edge given its node, by sums from the ends."""
        distance = np.zeros(count, np.int32)
        distance[node] = left
        self.end = distance == 0
        far = distance[source]
        lengths = distance[self.roots]
        long = np.repeat(lengths > PLAIN, lengths + 1)[source]
        self.log = np.empty(len(source))
        edges = np.flatnonzero(~long)
        # A factor for each character keeps plain sums in range.
        scaled = np.exp(log[edges] + _SCALE * (far - distance[self.target])[edges])
        total = _from_ends(np.ones(count), edges, source, self.target, far, scaled, np.multiply, np.add)
        self.log[edges] = np.log(scaled * total[self.target[edges]] / total[source[edges]])
        edges = np.flatnonzero(long)
        total = _from_ends(np.zeros(count), edges, source, self.target, far, log[edges], np.add, np.logaddexp)
        self.log[edges] = log[edges] + total[self.target[edges]] - total[source[edges]]
        self.chance = np.exp(self.log)
        with np.errstate(divide="ignore"):
            self.rest = np.log1p(-np.minimum(self.chance, 1.0))
        # A sole edge leaves nothing; rounding may say otherwise.
        self.rest[np.diff(self.first)[source] == 1] = -np.inf

    def draw(self, node, uniform, barred=None):
        """An edge from each node by its chance; ``barred`` marks edges by place that are out."""
        edge, rest = self.first[node].copy(), uniform.copy()
        active = np.arange(len(node))
        last = self.first[node + 1] - 1
        chosen = edge.copy()
        while len(active):
            here = edge[active]
            chance = self.chance[here]
            open_ = np.ones(len(active), bool)
            if barred is not None:
                open_ = (barred[active] >> (here - self.first[node[active]]).astype(np.uint64)) & np.uint64(1) == 0
                chance = np.where(open_, chance, 0.0)
            chosen[active[open_]] = here[open_]
            rest[active] -= chance
            go = ((rest[active] >= 0) | ~open_) & (here < last[active])
            active = active[go]
            edge[active] += 1
        return chosen


def _uniform(keys, use, number):
    """Uniform numbers in (0, 1), a function of keys, what they are for and a running number."""
    state = mix(keys + np.uint64(use * _STEP % 2**64) + (number.astype(np.uint64) << np.uint64(20)))
    return ((state >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _below(location, limit, uniform):
    """Gumbel noise at ``location``, given that it is below ``limit``."""
    with np.errstate(over="ignore", divide="ignore"):
        return location - np.log(np.exp(np.minimum(location - limit, 700)) - np.log(uniform))


class Search:
    """The search over the texts of one slice, all texts taking each step together.

    Uses of noise are told apart by 8 times the round plus what it is for: the root 0, an
    edge 1, a branch 2, which edge a branch takes 3, what is left of a branch 4.
    """

    def __init__(self, lattice, unit_of, unit_edges, keys, k):
        self.lattice, self.unit_of, self.edges, self.keys, self.k = lattice, unit_of, unit_edges, keys, k
        self.frontier, self.paths = None, []

    def tails(self, round_, doc, unit, node, prefix):
        """Paths from a node of a unit to the text's end: elements by text, in reading order.

        ``node`` -1 stands for the unit's root, or for nothing where there is no unit.
        """
        length = self.edges[doc + 1] - unit
        of = np.repeat(np.arange(len(doc)), length)
        begins = np.concatenate(([0], np.cumsum(length)))
        place = np.arange(begins[-1]) + (unit - self.edges[doc] - begins[:-1])[of]
        at = self.lattice.roots[self.unit_of[place + self.edges[doc][of]]]
        started = np.flatnonzero((length > 0) & (node >= 0))
        at[begins[:-1][started]] = node[started]
        keys = self.keys[doc][of]
        active = np.flatnonzero(~self.lattice.end[at])
        rows, edges, step = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        while len(active):
            chance = _uniform(keys[active] + np.uint64(step), 8 * round_ + 1, place[active])
            edge = self.lattice.draw(at[active], chance)
            rows.append(active)
            edges.append(edge)
            at[active] = self.lattice.target[edge]
            active = active[~self.lattice.end[at[active]]]
            step += 1
        rows, edges = np.concatenate(rows), np.concatenate(edges)
        order = np.argsort(rows, kind="stable")
        rows, edges = rows[order], edges[order]
        of = of[rows]
        bounds = np.searchsorted(of, np.arange(len(doc) + 1))
        sums = np.concatenate(([0.0], np.cumsum(self.lattice.log[edges])))
        shift = prefix - sums[bounds[:-1]]
        return of, place[rows], edges, sums[:-1] + shift[of], bounds, sums[bounds[1:]] + shift

    def branches(self, round_, doc, of, place, edge, before, bounds, value, skipped):
        """The best branches off the given elements of paths, as entries of the frontier.

        No more than k of a path can ever be wanted.
        """
        rest = before + self.lattice.rest[edge]
        element = np.arange(len(of)) + (skipped - bounds[:-1])[of]
        noise = _uniform(self.keys[doc][of], 8 * round_ + 2, element)
        with np.errstate(invalid="ignore"):
            worth = np.where(np.isfinite(rest), _below(rest, value[of], noise), -np.inf)
        filled = np.flatnonzero(np.diff(bounds))
        picked = [np.zeros(0, np.int64)]
        left = worth.copy()
        for _ in range(self.k if len(filled) else 0):
            top = np.full(len(doc), -np.inf)
            top[filled] = np.maximum.reduceat(left, bounds[:-1][filled])
            at = np.flatnonzero((left == top[of]) & (left > -np.inf))
            at = at[np.concatenate(([True], of[at][1:] != of[at][:-1]))] if len(at) else at
            picked.append(at)
            left[at] = -np.inf
        at = np.concatenate(picked)
        node = np.searchsorted(self.lattice.first, edge[at], side="right") - 1
        return {
            "doc": doc[of[at]],
            "value": worth[at],
            "rest": rest[at],
            "before": before[at],
            "place": place[at],
            "node": node,
            "barred": np.uint64(1) << (edge[at] - self.lattice.first[node]).astype(np.uint64),
            "path": np.full(len(at), len(self.paths)),
            "element": element[at],
        }

    def first_paths(self):
        doc = np.arange(len(self.keys))
        value = -np.log(-np.log(_uniform(self.keys, 0, np.zeros(len(doc), np.int64))))
        start = self.edges[:-1], np.full(len(doc), -1), np.zeros(len(doc))
        of, place, edge, before, bounds, total = self.tails(0, doc, *start)
        self.frontier = self.branches(0, doc, of, place, edge, before, bounds, value, np.zeros(len(doc), np.int64))
        self.paths.append({"edge": edge, "bounds": bounds, "doc": doc, "log": total, "value": value})

    def best(self):
        """The frontier's best entry of each text that has one."""
        f = self.frontier
        order = np.lexsort((-f["value"], f["doc"]))
        docs = f["doc"][order]
        return order[np.concatenate(([True], docs[1:] != docs[:-1]))] if len(order) else order

    def next_paths(self, round_):
        f, at = self.frontier, self.best()
        if not len(at):
            return False
        doc, value, node, kept = (f[n][at] for n in ("doc", "value", "node", "element"))
        keys, first = self.keys[doc], self.lattice.first
        share = np.exp(f["rest"][at] - f["before"][at])
        edge = self.lattice.draw(node, _uniform(keys, 8 * round_ + 3, kept) * share, f["barred"][at])
        # What is left of the branch without the edge taken.
        barred = f["barred"][at] | (np.uint64(1) << (edge - first[node]).astype(np.uint64))
        full = (np.uint64(1) << (first[node + 1] - first[node]).astype(np.uint64)) - np.uint64(1)
        gone = np.exp(f["before"][at] + self.lattice.log[edge] - f["rest"][at])
        with np.errstate(divide="ignore", invalid="ignore"):
            rest = f["rest"][at] + np.log1p(-np.minimum(gone, 1.0))
            rest[barred == full] = -np.inf
            again = _below(rest, value, _uniform(keys, 8 * round_ + 4, kept))
        prefix = f["before"][at] + self.lattice.log[edge]
        path, unit, target = f["path"][at], f["place"][at] + self.edges[doc], self.lattice.target[edge]
        f["value"][at] = np.where(np.isfinite(rest), again, -np.inf)
        f["rest"][at], f["barred"][at] = rest, barred
        of, place, tail, before, bounds, total = self.tails(round_, doc, unit, target, prefix)
        more = self.branches(round_, doc, of, place, tail, before, bounds, value, kept + 1)
        parts, sizes = [], kept + 1 + np.diff(bounds)
        for i in range(len(doc)):
            old = self.paths[path[i]]
            begin = old["bounds"][np.searchsorted(old["doc"], doc[i])]
            parts += [old["edge"][begin : begin + kept[i]], edge[i : i + 1], tail[bounds[i] : bounds[i + 1]]]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        self.paths.append({"edge": np.concatenate(parts), "bounds": bounds, "doc": doc, "log": total, "value": value})
        open_ = f["value"] > -np.inf
        self.frontier = {n: np.concatenate((f[n][open_], more[n])) for n in f}
        return True


def _keys(column, seed):
    """A number for each row key; nulls and texts have one too."""
    if pa.types.is_integer(column.type) and not column.null_count:
        values = column.to_numpy().astype(np.int64).view(np.uint64)
    else:
        texts = ["" if v is None else str(v) for v in column.to_pylist()]
        values = np.array([int(ngrams(np.frombuffer(t.encode().ljust(1), np.uint8).astype(np.uint64), max(1, len(t.encode())))[0]) for t in texts], np.uint64)
    return mix(values + np.uint64(seed))


def encode_texts(data, offsets, keys, k, vocabulary):
    """Samples of UTF-8 texts, best perturbed value first: ``doc, sample, ids, bounds, log, value, score``."""
    data, starts, ends, edges = split_units(data, offsets)
    text, lengths, number = distinct_units(data, starts, ends)
    lattice = Lattice(text, lengths, vocabulary)
    search = Search(lattice, number, edges, keys, k)
    search.first_paths()
    for round_ in range(1, k):
        if not search.next_paths(round_):
            break
    limit = np.full(len(keys), -np.inf)
    at = search.best()
    limit[search.frontier["doc"][at]] = search.frontier["value"][at]
    out = []
    for sample, path in enumerate(search.paths):
        ids, bounds = _spelled(lattice.piece[path["edge"]], path["bounds"], vocabulary)
        with np.errstate(over="ignore"):
            score = -np.expm1(-np.exp(np.minimum(path["log"] - limit[path["doc"]], 700)))
        out.append((path["doc"], sample, ids, bounds, path["log"], path["value"], score))
    return out


def _spelled(pieces, bounds, vocabulary):
    """Piece ids with characters that have none replaced by the ids of their bytes."""
    points = -1 - pieces
    rare = pieces < 0
    width = np.where(rare, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), 1)
    edges = np.concatenate(([0], np.cumsum(width)))
    out = np.repeat(pieces, width)
    for i in np.flatnonzero(rare):
        spelled = chr(points[i]).encode("utf-8", "surrogatepass")
        out[edges[i] : edges[i + 1]] = vocabulary["bytes"][np.frombuffer(spelled, np.uint8)]
    return out.astype(np.int32), edges[bounds]


SAMPLE = [
    StructField("sample", IntegerType()),
    StructField("ids", ArrayType(IntegerType(), False)),
    StructField("log_prob", DoubleType()),
    StructField("perturbed", DoubleType()),
    StructField("inclusion", DoubleType()),
]


def encode(documents, model_file, k=2, seed=0, key="doc_id", text="text"):
    """Up to ``k`` distinct segmentations of each text, as rows ``sample, ids, log_prob, perturbed, inclusion``.

    Columns but ``text`` are kept, those with names of the new ones are replaced. Rows come
    best perturbed value first; ``inclusion`` is the chance of being among the k given the
    next perturbed value. A text with fewer segmentations gives fewer rows, each with
    inclusion 1; an empty or null text gives one row without ids. Equal keys and texts give
    equal rows.
    """
    small_batches(documents.sparkSession)
    vocabulary = documents.sparkSession.sparkContext.broadcast(load_vocabulary(model_file))
    kept = [f for f in documents.schema.fields if f.name != text and f.name not in {s.name for s in SAMPLE}]
    names = [f.name for f in kept]

    def run(batches):
        for rows in slices(batches, text, SLICE):
            keys = _keys(rows.column(key), seed)
            samples = encode_texts(*flat(rows.column(text)), keys, k, vocabulary.value)
            for doc, sample, ids, bounds, log, value, score in samples:
                same = rows.select(names).take(pa.array(doc))
                yield batch(
                    **{n: same.column(n) for n in names},
                    sample=np.full(len(doc), sample, np.int32),
                    ids=pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)),
                    log_prob=log,
                    perturbed=value,
                    inclusion=score,
                )

    needed = documents.select(*[f"`{n}`" for n in dict.fromkeys([*names, key, text])])
    return needed.mapInArrow(run, StructType([*kept, *SAMPLE]))


class Decoder:
    """Texts of pieces, laid end to end."""

    def __init__(self, surface):
        self.bytes = np.frombuffer(b"".join(surface), np.uint8)
        self.sizes = np.array([len(piece) for piece in surface])
        self.begins = np.cumsum(self.sizes) - self.sizes

    def __call__(self, ids, bounds):
        """Bytes of id sequences end to end, without the model's first space, and their offsets."""
        sizes = self.sizes[ids]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        data = self.bytes[np.arange(ends[-1]) + np.repeat(self.begins[ids] - ends[:-1], sizes)]
        offsets = ends[bounds]
        keep = np.ones(len(data), bool)
        keep[offsets[:-1][np.diff(offsets) > 0]] = False
        return data[keep], np.concatenate(([0], np.cumsum(keep)))[offsets]


def decode(encoded, model_file, ids="ids", out="decoded"):
    """``encoded`` with the text of each row's ids in ``out``; null ids give null."""
    surface = encoded.sparkSession.sparkContext.broadcast(load_vocabulary(model_file)["surface"])
    rest = encoded.drop(out)

    def run(batches):
        decoder = Decoder(surface.value)
        for rows in batches:
            column = rows.column(ids)
            bounds = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())))
            data, offsets = decoder(column.flatten().to_numpy(), bounds)
            texts = pa.StringArray.from_buffers(
                len(column), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data), _validity(column)
            )
            yield batch(**{n: rows.column(n) for n in rows.schema.names}, **{out: texts})

    return rest.mapInArrow(run, StructType([*rest.schema.fields, StructField(out, StringType())]))


def _validity(column):
    if not column.null_count:
        return None
    return pa.py_buffer(np.packbits(column.is_valid().to_numpy(zero_copy_only=False), bitorder="little"))
