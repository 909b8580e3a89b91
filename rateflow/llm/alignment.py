"""Alignment of two tokenizers over a corpus, and how often it links their ids.

Both encodings of a text are laid over its bytes. Offsets where both end a token cut the
tokens into groups; the two tokens that end there are linked. The first pass over the
documents counts linked id pairs in every task; a minimal perfect hash of the distinct pairs
indexes dense count vectors, which are added up as a tree. The second pass aligns the
documents again and looks their pairs up.

Neither tokenizer joins a space between two other characters with what stands before it, so
a text is a row of units that begin there, and each task encodes and aligns a unit once.
"""

import json
import os
import re
import zlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F

from rateflow.llm import perfect_hash
from rateflow.llm.arrays import batch, kept, slices, small_batches
from rateflow.llm.shards import PATTERN

UNIT = re.compile(r"(?<=\S) (?=\S)")
# Texts that are empty or have a space at an end or beside other white space, for Arrow.
_WHITE = "[" + "".join(f"\\x{{{i:x}}}" for i in range(0x3001) if chr(i).isspace()) + "]"
ODD = f"^$|^ | $|{_WHITE} | {_WHITE}"
# Characters whose kinds all versions of Unicode agree on: ASCII, Latin and Cyrillic letters.
AGREED = re.compile("[\x00-\x7f\xc0-\u024f\u0400-\u045f]*")
# Bytes of texts that are split and looked up at a time.
SLICE_BYTES = 1 << 21
# A task forgets its rarer units beyond so many, or so many characters.
CACHE_UNITS, CACHE_CHARS = 200_000, 1 << 25
# Characters of units that are encoded as one text.
JOINED_CHARS = 1 << 10
# Pairs that a task holds before it writes them.
HELD_PAIRS = 1 << 21
# Functions and counts that a task of the second pass holds; more are looked up part by part.
PART_BYTES = 64 * 1024 * 1024


def _byte_alphabet():
    """Characters that stand for bytes in a byte-level vocabulary: printable ones for
    themselves, the others in order from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


def byte_level(token, alphabet):
    if all(c in alphabet for c in token):
        return bytes(alphabet[c] for c in token)
    return token.encode()


def _ranked(byte_bpe, first):
    """An encoder by merge ranks, if the file is a byte-level one whose ids are these ranks.

    Every token must encode to itself: then there is one way to merge it, and ranks, which allow
    any pair that makes a token, lead to the tokens that the listed pairs lead to.
    """
    import tiktoken

    told = json.loads(byte_bpe)
    model, split = told["model"], told.get("pre_tokenizer") or {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges") or ()]
    ids = model["vocab"]
    plain = not any(told.get(k) for k in ("normalizer", "truncation", "padding")) and not model.get("dropout")
    by_rank = all(ids.get("".join(m)) == 256 + i for i, m in enumerate(merges))
    level = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    if not (plain and level and by_rank and model.get("type", "BPE") == "BPE") or model.get("ignore_merges"):
        return None
    ids = {t: i for t, i in ids.items() if i < 256 + len(merges)}
    if any([x.id for x in first.model.tokenize(t)] != [i] for t, i in ids.items()):
        return None
    alphabet = _byte_alphabet()
    ranks = {byte_level(t, alphabet): i for t, i in ids.items()}
    return tiktoken.Encoding("by-rank", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Vocabularies:
    """Both tokenizers with the bytes of every id; a worker process builds them once."""

    def __init__(self, byte_bpe, pieces):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(byte_bpe)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.ranked = _ranked(byte_bpe, self.first)
        alphabet = _byte_alphabet()
        known = self.first.get_vocab(with_added_tokens=True)
        self.first_bytes = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            self.first_bytes[i] = byte_level(token, alphabet)
        names = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.second_bytes = [
            bytes([int(n[3:-1], 16)]) if self.second.is_byte(i) else n.replace("▁", " ").encode()
            for i, n in enumerate(names)
        ]
        if any(re.search("[^▁]▁", n) for n in names):
            raise ValueError("pieces reach over a space, so texts have no units")
        self.first_size, self.second_size = (np.array([len(b) for b in x]) for x in (self.first_bytes, self.second_bytes))
        n = len(self.first_bytes)
        # What a token adds to a group's text: inside its side and at its end.
        self.written = [f"{i}{end}" for i in range(n) for end in ",|"] + [f"{i}{end}" for i in range(len(names)) for end in ",;"]
        self.second_at = 2 * n

    def by_rank(self, texts):
        """Of each text whether its first side is encoded by merge rank."""
        return [False] * len(texts) if self.ranked is None else [m is not None for m in map(AGREED.fullmatch, texts)]

    def encode_first(self, texts):
        """Ids of the first side. Where ids are merge ranks the same merges are looked up by rank,
        which is quicker; only for characters that all versions split alike."""
        ranked = self.by_rank(texts)
        others = [t for t, r in zip(texts, ranked) if not r]
        others = iter(self.first.encode_batch_fast(others, add_special_tokens=False) if others else ())
        return [self.ranked.encode_ordinary(t) if r else next(others).ids for t, r in zip(texts, ranked)]

    def pair(self, first, second):
        return first * len(self.second_bytes) + second

    def second_of(self, pairs):
        return pairs % len(self.second_bytes)


def _vocabularies(shared):
    byte_bpe, pieces = shared.value
    name = f"alignment-{zlib.crc32(byte_bpe.encode())}-{zlib.crc32(pieces)}"
    return kept(name, lambda: Vocabularies(byte_bpe, pieces))


class Units:
    """Aligned units of one task: numbers by unit, and of each its tokens, groups or links.

    Groups are kept where ``counts`` are given, links where they are yet to be counted.
    """

    def __init__(self, vocabularies, counts=None, best=None):
        self.vocabularies, self.counts, self.best = vocabularies, counts, best
        self.number, self.groups, self.links = {}, [], np.zeros(0, np.int64)
        # Columns: whole, tokens of either side, groups, links, best links, sum of counts.
        self.table = np.zeros((0, 7), np.int64)
        # How often each unit was met since the last time that units were forgotten; its characters.
        self.met, self.chars = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def full(self):
        return len(self.number) > CACHE_UNITS or self.chars.sum() > CACHE_CHARS

    def forget(self):
        """Forgets the units met once, and of the others the rarer ones beyond half of the limits."""
        order = np.argsort(-self.met, kind="stable")[: CACHE_UNITS // 2]
        order = order[(self.met[order] > 1) & (np.cumsum(self.chars[order]) <= CACHE_CHARS // 2)]
        stay = np.zeros(len(self.met), bool)
        stay[order] = True
        self.links = self.links[np.repeat(stay, self.table[:, 4])] if self.counts is None else self.links
        self.groups = list(compress(self.groups, stay.tolist()))
        self.number = {u: i for i, u in enumerate(compress(self.number, stay.tolist()))}
        self.table, self.chars = self.table[stay], self.chars[stay]
        self.met = np.zeros(len(order), np.int64)

    def meet(self, numbers):
        self.met += np.bincount(numbers, minlength=len(self.met))

    def numbers(self, units, alone=()):
        """The number of each of some distinct units; unknown ones are aligned first, those ``alone``
        by themselves."""
        new = [u for u in units if u not in self.number]
        if new:
            self._align(new, [u for u in new if u in alone] if alone else [])
        return np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))

    def _encoded(self, lists):
        """Lists of units, joined by spaces, with the tokens of either side, end to end.

        A list that is not given back byte by byte is halved, down to the unit at fault.
        """
        v = self.vocabularies
        texts = [" ".join(own) for own in lists]
        encoded = v.encode_first([" " + t for t in texts])
        for own, text, ids, other in zip(lists, texts, encoded, v.second.encode(texts, num_threads=1)):
            text = (" " + text).encode()
            whole = b"".join(map(v.first_bytes.__getitem__, ids)) == text
            whole = whole and b"".join(map(v.second_bytes.__getitem__, other)) == text
            if whole:
                yield own, [len(u.encode()) + 1 for u in own], ids, other
            elif len(own) > 1:
                yield from self._encoded([own[: len(own) // 2], own[len(own) // 2 :]])
            else:
                yield own, [0], [], []

    def _align(self, units, alone):
        v = self.vocabularies
        joined = list(self._encoded(_joinable(units, dict.fromkeys(alone), v.by_rank)))
        units = [u for own, *_ in joined for u in own]
        sizes = np.array([n for _, own, *_ in joined for n in own], np.int64)
        ids, other = (np.concatenate([np.array(x[side], np.int64) for x in joined]) for side in (2, 3))
        ends, other_ends = np.cumsum(v.first_size[ids]), np.cumsum(v.second_size[other])
        here = np.zeros((2, sizes.sum() + 1), bool)
        here[0, ends], here[1, other_ends], here[:, 0] = True, True, True
        bounds = np.cumsum(sizes)
        if not here[:, bounds].all():
            raise ValueError("a token reaches over the end of a unit")
        last, other_last = here[1, ends], here[0, other_ends]
        closing, other_closing = np.flatnonzero(last), np.flatnonzero(other_last)
        pairs = v.pair(ids[closing], other[other_closing])
        table = np.zeros((len(units), 7), np.int64)
        table[:, 0] = sizes > 0
        table[:, 1] = np.diff(np.searchsorted(ends, bounds, "right"), prepend=0)
        table[:, 2] = np.diff(np.searchsorted(other_ends, bounds, "right"), prepend=0)
        table[:, 3] = np.diff(np.searchsorted(ends[closing], bounds, "right"), prepend=0)
        table[:, 4] = table[:, 3]
        chars = np.fromiter(map(len, units), np.int64, len(units))
        if self.counts is None:
            self.links = np.concatenate((self.links, pairs))
        else:
            n = self.counts.of(pairs)
            of = np.repeat(np.arange(len(units)), table[:, 4])
            best = (n > 0) & (n == self.best[v.second_of(pairs)])
            table[:, 5] = np.bincount(of, best, len(units)).astype(np.int64)
            np.add.at(table[:, 6], of, n)
            groups = self._groups(ids, other, last, other_last, table[:, 1] + table[:, 2])
            chars += np.fromiter(map(len, groups), np.int64, len(groups))
            self.groups += groups
        self.number.update(zip(units, range(len(self.number), len(self.number) + len(units))))
        self.table, self.chars = np.concatenate((self.table, table)), np.concatenate((self.chars, chars))
        self.met = np.concatenate((self.met, np.zeros(len(units), np.int64)))

    def _groups(self, ids, other, last, other_last, tokens):
        """Each unit's groups, written out; the units have so many ``tokens`` of both sides."""
        v = self.vocabularies
        # Groups in a row: the first side's tokens of a group come before the second's.
        closing, other_closing = np.flatnonzero(last), np.flatnonzero(other_last)
        group, other_group = np.cumsum(last) - last, np.cumsum(other_last) - other_last
        place = np.arange(len(ids)) + np.concatenate(([0], other_closing + 1))[group]
        other_place = np.arange(len(other)) + (closing + 1)[other_group] if len(other) else np.zeros(0, np.int64)
        codes = np.zeros(len(ids) + len(other), np.int64)
        codes[place] = 2 * ids + last
        codes[other_place] = v.second_at + 2 * other + other_last
        written = list(map(v.written.__getitem__, codes.tolist()))
        stops = np.cumsum(tokens).tolist()
        return ["".join(written[begin:stop])[:-1] for begin, stop in zip([0, *stops], stops)]


def _split(texts):
    """The units of each text, as a column of lists; spaces beside other white space stay inside them."""
    lists = pc.split_pattern(texts, " ")
    odd = pc.fill_null(pc.match_substring_regex(texts, ODD), True)
    odd = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    if not len(odd):
        return lists
    own = [UNIT.split(t) if t else [] for t in texts.take(pa.array(odd)).to_pylist()]
    at = np.arange(len(texts))
    at[odd] = len(texts) + np.arange(len(odd))
    return pa.concat_arrays([lists, pa.array(own, lists.type)]).take(pa.array(at))


def _joinable(units, alone, by_rank):
    """Units in lists of about JOINED_CHARS, of those encoded ``by_rank`` or not; those ``alone``
    are not joined."""
    lists = [[u] for u in alone]
    units = [u for u in units if u not in alone] if alone else units
    ranked = by_rank(units)
    for kind in (list(compress(units, ranked)), [u for u, r in zip(units, ranked) if not r]):
        cuts = np.cumsum([len(u) + 1 for u in kind]) // JOINED_CHARS
        begins = [*np.flatnonzero(np.diff(cuts, prepend=-1)).tolist(), len(kind)]
        lists += [kind[a:b] for a, b in zip(begins, begins[1:])]
    return lists


def _laid(rows, units):
    """Of the texts of ``rows``: their units end to end, as places in an array of distinct ones'
    numbers; that array; where each text's units begin and the last ones end; which texts are whole."""
    lists = _split(rows.column("text"))
    stops = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    bounds = np.concatenate(([0], stops))
    coded = lists.flatten().dictionary_encode()
    distinct, places = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
    some = np.diff(bounds) > 0
    # Only a text's first unit can begin with white space, and only its last one end with it.
    ends = np.unique(places[np.concatenate((bounds[:-1][some], bounds[1:][some] - 1))])
    ends = map(distinct.__getitem__, ends.tolist())
    alone = {u for u in ends if not u or u[0].isspace() or u[-1].isspace()}
    numbers = units.numbers(distinct, alone)
    whole = some.copy()
    whole[some] = np.minimum.reduceat(units.table[numbers, 0][places], bounds[:-1][some]) > 0 if some.any() else False
    units.meet(numbers[places[np.repeat(whole, np.diff(bounds))]])
    return places, numbers, bounds, whole


def _count_pairs(shared):
    """Linked pairs of a task's texts with how often they are linked, as ``part, key, n``."""

    def run(batches):
        units = Units(_vocabularies(shared))
        part = TaskContext.get().partitionId()
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

        def gather():
            held.append((units.links, np.repeat(units.met, units.table[:, 4])))
            pairs, n = (np.concatenate(x) for x in zip(*held))
            pairs, n = pairs[n > 0], n[n > 0]
            found, at = np.unique(pairs, return_inverse=True)
            total = np.zeros(len(found), np.int64)
            np.add.at(total, at, n)
            held[:] = [(found, total)]

        def out():
            pairs, n = held.pop()
            held.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
            return batch(part=np.full(len(pairs), part, np.int64), key=pairs, n=n)

        for rows in slices(batches, limit=SLICE_BYTES):
            _laid(rows, units)
            if units.full():
                gather()
                units.forget()
                if len(held[0][0]) > HELD_PAIRS:
                    yield out()
        gather()
        yield out()

    return run


COUNTED = ("n_best", "count_sum")
MADE = ("n_a", "n_b", "n_groups", "n_links")


def _look_up(shared, counts, cells, best, columns, first):
    """``columns`` of every row with what one part of the pairs adds to the counts."""

    def run(batches):
        units = Units(_vocabularies(shared), perfect_hash.Counts(counts.value, cells), best.value)
        for rows in slices(batches, limit=SLICE_BYTES):
            places, numbers, bounds, whole = _laid(rows, units)
            sums = np.zeros((rows.num_rows, 7), np.int64)
            begins = bounds[:-1][np.diff(bounds) > 0]
            for i in range(1, 7) if len(begins) else ():
                sums[np.diff(bounds) > 0, i] = np.add.reduceat(units.table[numbers, i][places], begins)
            sums[~whole] = 0
            out = {c: rows.column(c) for c in columns}
            if first:
                out.update(zip(MADE, sums[:, 1:5].T))
                groups = pa.array(list(map(units.groups.__getitem__, numbers.tolist())), pa.string())
                groups = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), groups.take(pa.array(places)))
                out["groups"] = pc.if_else(pa.array(whole), pc.binary_join(groups, ";"), "")
                out.update(zip(COUNTED, sums[:, 5:].T))
            else:
                before = [rows.column(c).to_numpy() for c in COUNTED]
                out.update({c: b + s for c, b, s in zip(COUNTED, before, sums[:, 5:].T)})
            if units.full():
                units.forget()
            yield batch(**{c: np.ascontiguousarray(x) if isinstance(x, np.ndarray) else x for c, x in out.items()})

    return run


def _parts(table):
    """Lists of cells whose functions and counts together fit PART_BYTES."""
    size = sum(F.octet_length(c) for c in ("words", "keys", "vector"))
    lists, held = [[]], 0
    for cell, n in table.select("cell", size).orderBy("cell").collect():
        if held and held + n > PART_BYTES:
            lists, held = [*lists, []], 0
        lists[-1].append(cell)
        held += n
    return lists


def align(documents, byte_bpe_file, piece_file, carried=("doc_id",)):
    """Each row's alignment: ``carried``, ``n_a, n_b, n_groups, n_links, groups, n_best, count_sum``.

    ``groups`` lists the ids, ``a1,a2|b1;a3|b2,b3``. A pair's count is how many links of all
    rows hold it; ``n_best`` is a row's links with the highest count of their second id, and
    ``count_sum`` adds up the counts of its links. Texts that are null or empty, or that one
    of the tokenizers does not give back byte by byte, have no tokens: zeros and ''. Equal
    rows count as often as they are there; columns that are not carried are not read.

    The counts are used from memory in parts of PART_BYTES; with more, documents are aligned
    once for each part.
    """
    spark = documents.sparkSession
    small_batches(spark)
    with open(byte_bpe_file, encoding="utf-8") as a, open(piece_file, "rb") as b:
        shared = spark.sparkContext.broadcast((a.read(), b.read()))
    rows = documents.select(*carried, "text")
    table, cells = perfect_hash.counted(rows.select("text").mapInArrow(_count_pairs(shared), "part long, key long, n long"))
    vocabularies = _vocabularies(shared)
    size = len(vocabularies.second_bytes)
    # 8 bytes for each id of the second vocabulary.
    best = perfect_hash.best_counts(table, lambda keys: keys % size, size)
    best = spark.sparkContext.broadcast(best)
    own = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carried)
    made = ", ".join([*(f"{c} long" for c in MADE), "groups string"])
    sums = ", ".join(f"{c} long" for c in COUNTED)
    lists = _parts(table)
    for i, part in enumerate(lists):
        # A part is read by the driver and sent to the tasks: PART_BYTES, or one cell.
        counts = spark.sparkContext.broadcast([r.asDict() for r in table.where(F.col("cell").isin(part)).collect()])
        columns = [*carried, *(() if i == len(lists) - 1 else ("text",))]
        schema = ", ".join([own, *(["text string"] if "text" in columns else []), made, sums])
        columns += [*MADE, "groups"] if i else []
        rows = rows.mapInArrow(_look_up(shared, counts, cells, best, columns, i == 0), schema)
    return rows
