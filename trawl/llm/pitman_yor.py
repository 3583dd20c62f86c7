"""Hierarchical Pitman-Yor language model over words.

A word is drawn from the restaurant of its context: the word before it. Contexts whose last
two bytes agree share a parent restaurant, parents that end in the same byte share a
grandparent, and all of those share the root. The root's base is diffuse, so a dish opened
there is always a new word: unknown words are one event, whose probability is that of a new
table at the root.

Seating is sampled by Gibbs sweeps of the Chinese restaurant process: tables of a restaurant
are customers of its parent. The restaurants of words and those above them take turns. Above
(``sample``), given the numbers of tables of the sweep before, words are independent, so a
sweep is one distributed pass over the vocabulary; draws depend on names alone, so a pass
replays the earlier sweeps. Below (``seat_words``), (word, context) pairs are gathered by
context, where a restaurant's tables are known and each dish brings its parent's
probability; a pair seen once has one table and is only counted. The seated pairs go back to
their words, and the restaurants above are sampled again on the new customers. The first
customers of a dish are seated one by one, later ones in blocks that grow by a tenth.
Predictive probabilities are averaged over the sweeps after the first.

Work is shared out by chunks of documents, kept as numbers of words in a table bucketed by
chunk, so that a chunk meets what is told to it without being moved. All (word, context)
pairs travel once, as sorted hashes of 64 bits with the chunk's counts (``count_pairs``); a
chunk is told which of its pairs occur nowhere, once or more often in all training rows, and
which of them it is to pass on, so that each is passed on by one chunk. A pair that occurs
once has one table whatever the sweep: it reaches its word as a customer of the suffix, and
its context as a number. Only the other pairs are sent by name, seated, and asked for.

What chunks know of a word is merged in a tree, at most ``FAN_IN`` parts at a time, so that
no word is gathered from all chunks at once. Totals of contexts are a table, joined to the
words. Probabilities return to the chunks by word. Neither the vocabulary nor its pairs are
gathered anywhere; the largest row is that of the word with the most distinct neighbours that
it follows more than once. The driver sees numbers of tables by byte suffix (at most 66000,
whatever the corpus). Shuffle files go as soon as a table is written from them, and tables as
soon as nothing reads them any more.

Defined cases: null text is empty and has the end token alone; repeated rows count and are
scored as often as they occur; without training rows the unknown word has probability
one; rows with a null id are scored under it and not learnt from by a fold of the id; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm.common import parts_of, stored
from trawl.storage import scratch_path, write_bucketed

END = b""
# Suffixes of two bytes and of one: the restaurants above those of the words.
CONTEXTS, PARENTS = 1 << 16, 1 << 8
HASH_BITS = 48
# Text bytes that close a chunk.
CHUNK_BYTES = 24 << 20
# Parts of one word merged at a time, and rows of a merged group.
FAN_IN, MERGED_ROWS = 64, 200_000
# Pairs of words counted, seated, or brought back to their words, in one group.
SEATED_PAIRS = 1_000_000
# Rows that a task holds before it seals them.
HELD_ROWS, HELD_BYTES = 200_000, 64 << 20
# Values of sealed cells that are not split into bytes of equal rank otherwise.
WIDTHS = {"asked": "<u2", "suffixes": "<u2", "singles": "<u8", "counts": "<u8", "parent": "<f4", "parent_p": "<f4", "log_p": "<f4", "excess": "<f4", "root_p": "<f4"}
# How often a pair or word occurs in training rows, two standing for any more; whether its
# chunk passes it on; whether no other chunk has it.
OFTEN, OWNED, ALONE = 2, 4, 8
# Words that occur once and in one chunk, by the suffix they follow. No token has a blank.
LONERS = b" "
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
STRENGTH = 1.0
SINGLE_SEATS = 64
SWEEPS = 3
U = np.uint64

CHUNK_ROW = pa.schema([
    ("chunk", pa.int64()), ("part", pa.int32()), ("doc", pa.list_(pa.int64())), ("learn", pa.binary()), ("lengths", pa.binary()),
    ("ids", pa.binary()), ("learnt", pa.int64()), ("spelled", pa.binary()), ("sizes", pa.binary()), ("words", pa.int64()),
])
CHUNK_COLUMNS = "chunk long, part int, doc array<long>, learn binary, lengths binary, ids binary, learnt long, spelled binary, sizes binary, words long"
KEY_COLUMNS = "bucket long, chunk long, keys binary, counts binary"
CODE_COLUMNS = "chunk long, bucket long, codes binary, often binary"
ENTRY_COLUMNS = "bucket long, part long, entries binary"
ASKED_COLUMNS = "bucket long, asked binary"
WORD_COLUMNS = "bucket long, part long, word binary, contexts binary, counts binary, suffixes binary, singles binary, after long, c long"
NAMED_COLUMNS = "word binary, contexts binary, counts binary, suffixes binary, singles binary, c long, dish long"
SEATED_COLUMNS = "word binary, contexts binary, counts binary, suffixes binary, singles binary, c long, tables binary, excess binary"
UPPER_COLUMNS = "word binary, contexts binary, counts binary, c long"
TOLD_COLUMNS = "bucket long, told binary"
ANSWER_COLUMNS = "chunk long, answers binary"


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def draw(names: np.ndarray, sweep: int, step: int) -> np.ndarray:
    """Uniform numbers that depend on name, sweep and step alone, not on partitioning."""
    return (mix(names + U((sweep * 1_000_003 + step) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> U(11)) * (1.0 / (1 << 53))


def seat(customers: np.ndarray, opening: np.ndarray, discount: float, names: np.ndarray, sweep: int) -> np.ndarray:
    """Sampled number of tables for each dish.

    ``opening`` is the weight of a new table: (strength + discount x tables) x parent's
    probability of the dish. With n seated at t tables, old tables weigh n - discount x t.
    """
    order = np.argsort(-customers, kind="stable")
    left, weight, name = customers[order], opening[order], names[order]
    tables = np.minimum(left, 1).astype(float)
    seated, step, active = 1, 0, len(left)
    while True:
        block = 1 if seated < SINGLE_SEATS else max(1, seated // 10)
        active = int(np.searchsorted(-left[:active], -seated, side="left"))  # more customers than seated
        if not active:
            break
        size = np.minimum(block, left[:active] - seated)
        new = weight[:active] / (weight[:active] + seated - discount * tables[:active])
        expected = size * new
        tables[:active] += np.minimum(np.floor(expected) + (draw(name[:active], sweep, step) < expected % 1), size)
        seated, step = seated + block, step + 1
    out = np.empty(len(tables))
    out[order] = tables
    return out


def discount_of(once: float, twice: float) -> float:
    """Discount from the numbers of dishes seen once and twice."""
    return float(np.clip(once / (once + 2 * twice), 0.1, 0.95)) if once else 0.5


def context_of(word: bytes) -> int:
    """The suffix that a context shares its parent by. The last byte leads, so that suffixes
    with one parent are neighbours in order."""
    return (word[-1] << 8 | (word[-2] if len(word) > 1 else 0)) if word else 0


def context_id(word: bytes) -> int:
    """The word as a context: its suffix, then a hash of the whole word, so that contexts
    with one parent are neighbours in order."""
    return context_of(word) << HASH_BITS | xxhash.xxh3_64_intdigest(word) >> 64 - HASH_BITS


def flat(blobs: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of binary cells in one array, and the number of values of each cell."""
    blobs = blobs.cast(pa.large_binary())
    offsets = np.frombuffer(blobs.buffers()[1], dtype=np.int64)[blobs.offset : blobs.offset + len(blobs) + 1]
    data = blobs.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return raw.view(dtype), np.diff(offsets) // np.dtype(dtype).itemsize


def cells(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The reverse of ``flat``."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]) * values.dtype.itemsize
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), data]).cast(pa.binary())


def packed(values: np.ndarray) -> bytes:
    """Values in one compressed cell, byte by byte of all, as high bytes are much alike."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(cell: bytes, dtype) -> np.ndarray:
    """The reverse of ``packed``."""
    planes = pa.decompress(cell[8:], decompressed_size=int.from_bytes(cell[:8], "little"), codec="zstd", asbytes=True)
    return np.frombuffer(planes, dtype=np.uint8).reshape(np.dtype(dtype).itemsize, -1).T.ravel().view(dtype)


def together(column, dtype) -> np.ndarray:
    """The values of packed cells in one array."""
    return np.concatenate([np.zeros(0, dtype), *(unpacked(x, dtype) for x in column.to_pylist())])


def sealed(table: pa.Table) -> bytes:
    """Rows without nulls in one compressed cell."""
    columns = []
    for name, column in zip(table.column_names, table.columns):
        column = column.combine_chunks()
        if pa.types.is_binary(column.type):
            values, sizes = flat(column, np.uint8)
            columns.append((name, packed(sizes.astype("<i4")), packed(values.view(WIDTHS.get(name, "u1")))))
        else:
            values = column.to_numpy()
            columns.append((name, values.dtype.str, packed(values)))
    return pickle.dumps(columns)


def opened(cell: bytes) -> pa.Table:
    """The reverse of ``sealed``."""
    return pa.table({
        name: pa.array(unpacked(values, kind)) if isinstance(kind, str) else cells(unpacked(values, WIDTHS.get(name, "u1")), unpacked(kind, "<i4") // np.dtype(WIDTHS.get(name, "u1")).itemsize)
        for name, kind, values in pickle.loads(cell)})


def unsealed(column: pa.ChunkedArray) -> pa.Table:
    """The rows of all sealed cells."""
    return pa.concat_tables([opened(x) for x in column.to_pylist()])


def shared_out(table: pa.Table, keys: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The rows of each key, sealed."""
    order = np.argsort(keys, kind="stable")
    table, keys = table.take(pa.array(order)).combine_chunks(), keys[order]
    first = np.flatnonzero(opens(keys)) if len(keys) else np.zeros(0, dtype=np.int64)
    for at, n in zip(first, np.diff(first, append=len(keys))):
        yield int(keys[at]), sealed(table.slice(at, n))


def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in tables of some size."""
    kept, rows, size = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= HELD_ROWS or size >= HELD_BYTES:
            yield pa.Table.from_batches(kept)
            kept, rows, size = [], 0, 0
    if kept:
        yield pa.Table.from_batches(kept)


def opens(*keys: np.ndarray) -> np.ndarray:
    """Where sorted keys differ from those before."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


class Chunk:
    """Documents of one task until their text reaches the bound."""

    def __init__(self, number: int) -> None:
        self.number, self.held = number, 0
        # A new word takes the next number.
        self.places: dict[bytes, int] = defaultdict(count().__next__)
        self.docs, self.learn, self.ids = [], [], []

    def add(self, doc, text: str | None, learn: bool) -> None:
        tokens = (text or "").encode("utf-8", "replace").lower().split()
        tokens.append(END)
        self.ids.append(np.fromiter(map(self.places.__getitem__, tokens), dtype=np.int32, count=len(tokens)))
        self.docs.append(doc)
        self.learn.append(learn)
        self.held += len(text or "")

    def rows(self) -> Iterator[pa.RecordBatch]:
        """Documents as numbers of words, and the words."""
        lengths = np.array([len(x) for x in self.ids])
        for at in range(0, len(lengths), 512):
            ids, learn = self.ids[at : at + 512], np.array(self.learn[at : at + 512])
            yield self._batch(
                part=[at], doc=[self.docs[at : at + 512]], learn=[packed(learn.astype(np.uint8))], lengths=[packed(lengths[at : at + 512])],
                ids=[packed(np.concatenate(ids))], learnt=[int(lengths[at : at + 512][learn].sum())])
        words = list(self.places)
        for at in range(0, len(words), 50_000):
            part = words[at : at + 50_000]
            yield self._batch(
                part=[at], words=[len(part)], spelled=[packed(np.frombuffer(b"".join(part), np.uint8))], sizes=[packed(np.array([len(w) for w in part], dtype="<i4"))])

    def _batch(self, **columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        columns["chunk"] = np.full(n, self.number)
        return pa.RecordBatch.from_arrays([
            pa.nulls(n, f.type) if f.name not in columns else x if isinstance(x := columns[f.name], pa.Array) else pa.array(x, f.type) for f in CHUNK_ROW
        ], schema=CHUNK_ROW)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 24
    chunk = Chunk(number)
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            piece = batch.slice(at, 512)
            for doc, text, learn in zip(*(piece.column(c).to_pylist() for c in ("doc", "text", "train"))):
                chunk.add(doc, text, learn)
                if chunk.held >= CHUNK_BYTES:
                    yield from chunk.rows()
                    number += 1
                    chunk = Chunk(number)
    if chunk.docs:
        yield from chunk.rows()


class Contents:
    """A chunk read back: its documents, its words, and its (word, context) pairs in order."""

    def __init__(self, table: pa.Table, scored: bool = False) -> None:
        texts, words = (table.filter(pc.is_valid(table.column(c))).sort_by("part") for c in ("ids", "words"))
        self.number = table.column("chunk")[0].as_py()
        self.docs = pa.concat_arrays([x.flatten() for x in texts.column("doc").chunks])
        self.learn, self.lengths = together(texts.column("learn"), np.uint8) > 0, together(texts.column("lengths"), "<i8")
        spelled, sizes = together(words.column("spelled"), np.uint8), together(words.column("sizes"), "<i4")
        self.words = cells(spelled, sizes)
        ends = np.cumsum(sizes, dtype=np.int64)
        digests = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.words.to_pylist()), dtype=U, count=len(sizes))
        # ``context_id`` of every word.
        suffixes = np.zeros(len(sizes), dtype=U)
        suffixes[sizes > 0] = spelled[ends[sizes > 0] - 1].astype(U) << U(8)
        suffixes[sizes > 1] |= spelled[ends[sizes > 1] - 2].astype(U)
        self.names, self.contexts = digests, suffixes << U(HASH_BITS) | digests >> U(64 - HASH_BITS)
        # Every document closes with the end token, which is also what its first word follows.
        ids = together(texts.column("ids"), "<i4")
        keys = ids.astype(np.int64)
        keys *= len(sizes)
        keys += np.roll(ids, 1)
        order = np.argsort(keys)
        keys = keys[order]
        new = opens(keys)
        self.place = np.empty(len(ids), dtype=np.int32)
        self.place[order] = np.cumsum(new, dtype=np.int32) - 1
        pairs = keys[new]
        del keys, order, new
        self.word = (pairs // len(sizes)).astype(np.int32)
        self.before = (pairs - self.word * np.int64(len(sizes))).astype(np.int32)
        del pairs
        trained = np.repeat(self.learn, self.lengths)
        self.counts = np.bincount(self.place[trained], minlength=len(self.word))
        self.c = np.bincount(ids[trained], minlength=len(sizes))
        del ids, trained
        if not scored:
            del self.place
        self.keys = np.concatenate([mix(self.names[self.word] + mix(self.contexts)[self.before]), mix(self.names)])
        self.order = np.argsort(self.keys).astype(np.int32)
        self.keys = self.keys[self.order]

    def coded(self, codes: pa.Table) -> None:
        """Takes what ``_codes`` found out about the pairs and words."""
        del self.keys, self.counts
        codes = codes.sort_by("bucket")
        flags = np.empty(len(self.order), dtype=np.uint8)
        flags[self.order] = together(codes.column("codes"), np.uint8)
        n = np.zeros(len(flags), dtype="<u8")
        n[self.order[flags[self.order] & ~np.uint8(ALONE) == OFTEN | OWNED]] = together(codes.column("often"), "<u8")
        own, flags = flags[len(self.word) :], flags[: len(self.word)]
        self.times, self.owned = flags & 3, (flags & OWNED) > 0
        # Words that nobody has to be told of: unknown ones, and known ones that occur here alone.
        self.loner = own == 1 | OWNED | ALONE
        self.asks, self.passed = ~self.loner & (own & 3 > 0), ~self.loner & (self.c > 0)
        # Pairs that occur more than once, by word and context.
        often = np.flatnonzero(self.times == OFTEN)
        self.often = often[np.lexsort((self.contexts[self.before[often]], self.word[often]))]
        self.often_n = n[self.often]
        del n, self.order
        # All words with the suffixes they follow.
        suffixes = (self.contexts >> U(HASH_BITS)).astype(np.int64)
        self.uppers, upper = np.unique(self.word.astype(np.int64) << 16 | suffixes[self.before], return_inverse=True)
        self.upper = upper.astype(np.int32)

    def listed(self, word: np.ndarray, values: np.ndarray, dtype: str) -> pa.Array:
        """A cell for each word, of values in the order of words."""
        return cells(values.astype(dtype), np.bincount(word, minlength=len(self.words)))

    def entries(self) -> tuple[pa.Table, pa.Table]:
        """What the chunk passes on of its words, and of its loners."""
        own = self.owned[self.often]
        often = self.often[own]
        once = self.owned & (self.times == 1)
        singles = np.bincount(self.upper[once], minlength=len(self.uppers))
        alone = self.loner[self.uppers >> 16]
        suffixes, n = np.unique(self.uppers[alone & (singles > 0)] & CONTEXTS - 1, return_counts=True)
        loners = pa.table({
            "word": pa.array([LONERS], pa.binary()), "contexts": pa.array([b""], pa.binary()), "counts": pa.array([b""], pa.binary()),
            "suffixes": cells(suffixes.astype("<u2"), [len(n)]), "singles": cells(n.astype("<u8"), [len(n)]), "after": [0], "c": [int(n.sum())]})
        some = np.flatnonzero(singles)
        words = pa.Table.from_arrays([
            self.words,
            self.listed(self.word[often], self.contexts[self.before[often]], "<u8"), self.listed(self.word[often], self.often_n[own], "<u8"),
            self.listed(self.uppers[some] >> 16, self.uppers[some] & CONTEXTS - 1, "<u2"), self.listed(self.uppers[some] >> 16, singles[some], "<u8"),
            pa.array(np.bincount(self.before[once], minlength=len(self.words))), pa.array(self.c),
        ], loners.column_names)
        return words.filter(pa.array(self.passed)), loners

    def asked(self) -> pa.Table:
        """What the chunk asks about words."""
        return pa.Table.from_arrays([
            pa.array(np.full(len(self.words), self.number)), pa.array(np.arange(len(self.words))), self.words,
            self.listed(self.uppers >> 16, self.uppers & CONTEXTS - 1, "<u2"),
            self.listed(self.word[self.often], self.contexts[self.before[self.often]], "<u8"),
        ], ["chunk", "place", "word", "asked", "exact"])

    def answered(self, model: Model) -> np.ndarray:
        """Probabilities of the suffixes of words that it does not ask about."""
        quiet = self.uppers[~self.asks[self.uppers >> 16]]
        word, suffix = quiet >> 16, quiet & CONTEXTS - 1
        # Single precision, as the answers to what it asks have come through.
        with np.errstate(divide="ignore"):
            p = 10 ** np.log10(model.unseen(suffix)).astype("<f4").astype(float)
        # The only pair of a word that occurs once.
        single = self.uppers[np.bincount(self.upper[self.owned & (self.times == 1)], minlength=len(self.uppers)) > 0]
        single = single[self.loner[single >> 16]]
        if not len(single):
            return p
        one, none = np.ones(len(single), dtype=np.int64), pa.array([b""] * len(single), pa.binary())
        known = pa.RecordBatch.from_arrays(
            [self.words.take(pa.array(single >> 16)), cells((single & CONTEXTS - 1).astype("<u2"), one), cells(one.astype("<u8"), one), pa.array(one)],
            ["word", "contexts", "counts", "c"])
        told = Told(pa.Table.from_batches([next(_predict(model)(iter([known])))]).append_column("total", pa.array(one)).append_column("pairs", none).append_column("excess", none))
        p[self.loner[word]] = told.parent(model, np.searchsorted(single >> 16, word[self.loner[word]]), suffix[self.loner[word]])
        return p


def _entries(buckets: int, groups: int):
    """What a chunk passes on, by buckets of words."""

    def run(chunk: pa.Table, codes: pa.Table) -> pa.Table:
        contents = Contents(chunk)
        contents.coded(codes)
        words, loners = contents.entries()
        rows = [*shared_out(words, (contents.names[contents.passed] % U(buckets)).astype(np.int64)), (0, sealed(loners))]
        return pa.table({
            "bucket": [x for x, _ in rows], "part": pa.array(np.full(len(rows), int(mix(np.array([contents.number], dtype=U))[0] % U(groups)))),
            "entries": pa.array([x for _, x in rows], pa.binary())})

    return run


def _asked(buckets: int):
    """What a chunk asks, by buckets of words."""

    def run(chunk: pa.Table, codes: pa.Table) -> pa.Table:
        contents = Contents(chunk)
        contents.coded(codes)
        rows = list(shared_out(contents.asked().filter(pa.array(contents.asks)), (contents.names[contents.asks] % U(buckets)).astype(np.int64)))
        return pa.table({"bucket": pa.array([x for x, _ in rows], pa.int64()), "asked": pa.array([x for _, x in rows], pa.binary())})

    return run


def _keys(buckets: int):
    """The pairs and words of a chunk as sorted hashes, by ranges of them."""

    def run(table: pa.Table) -> pa.Table:
        chunk = Contents(table)
        bounds = np.searchsorted((chunk.keys >> U(32)) * U(buckets) >> U(32), np.arange(buckets + 1).astype(U))
        counts = np.concatenate([chunk.counts, chunk.c])[chunk.order].astype("<u8")
        some = np.flatnonzero(np.diff(bounds))
        parts = [slice(bounds[i], bounds[i + 1]) for i in some]
        return pa.table({
            "bucket": pa.array(some), "chunk": pa.array(np.full(len(some), chunk.number)),
            "keys": pa.array([packed(np.diff(chunk.keys[x], prepend=U(0))) for x in parts], pa.binary()),
            "counts": pa.array([packed(counts[x]) for x in parts], pa.binary()),
        })

    return run


def _codes(table: pa.Table) -> pa.Table:
    """What each chunk is told about its pairs and words in a range of hashes."""
    table = table.sort_by("chunk")
    keys = [np.cumsum(unpacked(x, "<u8"), dtype=U) for x in table.column("keys").to_pylist()]
    counts = together(table.column("counts"), "<u8").astype(np.int64)
    sizes = [len(x) for x in keys]
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    new = opens(keys[order])
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    n = np.add.reduceat(counts[order], first)
    times = np.empty(len(keys), dtype=np.int64)
    times[order] = n[group]
    # The first chunk that learns a pair passes it on.
    trained = np.flatnonzero(counts[order] > 0)
    owned = np.zeros(len(keys), dtype=bool)
    owned[order[trained[opens(group[trained])]] if len(trained) else []] = True
    alone = np.zeros(len(keys), dtype=bool)
    alone[order[first[np.diff(first, append=len(keys)) == 1]]] = True
    codes = (np.minimum(times, OFTEN) | OWNED * owned | ALONE * alone).astype(np.uint8)
    told = []
    for end, size in zip(np.cumsum(sizes), sizes):
        part = slice(end - size, end)
        told.append((packed(codes[part]), packed(times[part][codes[part] & ~np.uint8(ALONE) == OFTEN | OWNED].astype("<u8"))))
    return pa.table({
        "chunk": table.column("chunk"), "bucket": table.column("bucket"),
        "codes": pa.array([x for x, _ in told], pa.binary()), "often": pa.array([x for _, x in told], pa.binary())})


def count_pairs(chunks: DataFrame, pairs: int) -> DataFrame:
    """What chunks are told about their pairs and words."""
    keys = chunks.groupBy("chunk").applyInArrow(_keys(parts_of(chunks.sparkSession, pairs, SEATED_PAIRS)), KEY_COLUMNS)
    return released(keys.groupBy("bucket").applyInArrow(_codes, CODE_COLUMNS), "codes")


def released(df: DataFrame, label: str) -> DataFrame:
    """``stored``, of which no shuffle files remain."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, "false")
    conf.set(CLEAN_UP, "true")
    try:
        return stored(df, label)
    finally:
        conf.set(CLEAN_UP, before)


def erase(df: DataFrame) -> None:
    """Delete the files of a table of ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _summed(word: np.ndarray, keys: pa.Array, values: pa.Array, dtype: str, words: int) -> tuple[pa.Array, pa.Array]:
    """Cells of keys with their summed values, one for each word, of cells that many rows have."""
    keys, sizes = flat(keys, dtype)
    values = flat(values, "<u8")[0].astype(np.int64)
    word = np.repeat(word, sizes)
    order = np.lexsort((keys, word))
    word, keys = word[order], keys[order]
    first = np.flatnonzero(opens(word, keys)) if len(keys) else np.zeros(0, dtype=np.int64)
    sums = np.add.reduceat(values[order], first) if len(first) else values
    sizes = np.bincount(word[first], minlength=words)
    return cells(keys[first], sizes), cells(sums.astype("<u8"), sizes)


def _merge_entries(table: pa.Table) -> pa.Table:
    return _merge(unsealed(table.column("entries")), table.column("bucket")[0].as_py(), table.column("part")[0].as_py())


def _merge_parts(table: pa.Table) -> pa.Table:
    return _merge(table, table.column("bucket")[0].as_py(), table.column("part")[0].as_py())


def _merge(table: pa.Table, bucket: int, part: int) -> pa.Table:
    """One row per word of a group, with the sums of what chunks know of it."""
    coded = table.column("word").combine_chunks().dictionary_encode()
    row_word, words = coded.indices.to_numpy(), len(coded.dictionary)
    contexts, counts = _summed(row_word, table.column("contexts").combine_chunks(), table.column("counts").combine_chunks(), "<u8", words)
    suffixes, singles = _summed(row_word, table.column("suffixes").combine_chunks(), table.column("singles").combine_chunks(), "<u2", words)
    totals = {}
    for c in ("after", "c"):
        totals[c] = np.zeros(words, dtype=np.int64)
        np.add.at(totals[c], row_word, table.column(c).to_numpy())
    return pa.table({
        "bucket": pa.array(np.full(words, bucket)), "part": pa.array(np.full(words, part)), "word": coded.dictionary, "contexts": contexts, "counts": counts, "suffixes": suffixes, "singles": singles, **totals,
    })


def merged_words(by_chunk, spark: SparkSession, rows: int, chunks: int) -> DataFrame:
    """Every training word: ``contexts`` and ``counts`` of the pairs seen more than once,
    ``suffixes`` and ``singles`` of the others, and how many of those it is the context of
    (``after``)."""
    buckets, groups = parts_of(spark, rows, MERGED_ROWS), -(-chunks // FAN_IN)
    entries = by_chunk.applyInArrow(_entries(buckets, groups), ENTRY_COLUMNS)
    words = released(entries.groupBy("bucket", "part").applyInArrow(_merge_entries, WORD_COLUMNS), "words")
    while groups > 1:
        last, groups = words, -(-groups // FAN_IN)
        words = released(last.withColumn("part", F.pmod("part", F.lit(groups))).groupBy("bucket", "part").applyInArrow(_merge_parts, WORD_COLUMNS), "words")
        erase(last)
    return words.drop("bucket", "part")


@dataclass
class Totals:
    """Numbers of tables after a sweep, by context and by parent; customers follow from them."""

    tables: np.ndarray
    parent_tables: np.ndarray

    @property
    def parent_customers(self) -> np.ndarray:
        return self.tables.reshape(PARENTS, -1).sum(axis=1)

    @property
    def root_customers(self) -> float:
        return float(self.parent_tables.sum())


@dataclass
class Model:
    """Discounts from the contexts to the root, customers by context, and the sweeps so far."""

    discounts: tuple[float, float, float]
    customers: np.ndarray
    words: int
    sweeps: list[Totals]

    def shares(self, totals: Totals) -> tuple[np.ndarray, np.ndarray, float]:
        """Probability of a new table by context, by parent, and at the root."""
        two, one, root = self.discounts
        return (
            (STRENGTH + two * totals.tables) / (STRENGTH + self.customers),
            (STRENGTH + one * totals.parent_tables) / (STRENGTH + totals.parent_customers),
            (STRENGTH + root * self.words) / (STRENGTH + totals.root_customers),
        )

    def unseen(self, contexts: np.ndarray) -> np.ndarray:
        """Average probability of the unknown word after each context."""
        found = np.zeros(len(contexts))
        for totals in self.sweeps[2:]:
            own, parent, root = self.shares(totals)
            found += own[contexts] * parent[contexts >> 8] * root
        return found / len(self.sweeps[2:])


class Seating:
    """The words of one batch with their (word, context) and (word, parent) dishes."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.words = batch.column("word")
        contexts, self.sizes = flat(batch.column("contexts"), "<u2")
        self.contexts = contexts.astype(np.int64)
        self.counts = flat(batch.column("counts"), "<u8")[0].astype(np.int64)
        n = len(self.sizes)
        word = np.repeat(np.arange(n), self.sizes)
        keys = word * PARENTS + (self.contexts >> 8)
        opens = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
        self.group = np.cumsum(opens) - 1
        self.group_word, self.group_parent = word[opens], self.contexts[opens] >> 8
        name = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.words.to_pylist()), dtype=U, count=n)
        self.names = mix(name[word] + self.contexts.astype(U))
        self.group_names = mix(name[self.group_word] + (self.group_parent + CONTEXTS).astype(U))
        # Before the first sweep every dish has one table.
        self._count(np.ones(len(self.counts)), np.ones(len(self.group_word)))

    def _count(self, tables: np.ndarray, group_tables: np.ndarray) -> None:
        self.tables, self.group_tables = tables, group_tables
        self.group_customers = np.bincount(self.group, tables, len(group_tables))
        self.root_customers = np.bincount(self.group_word, group_tables, len(self.words))

    def probabilities(self, model: Model, totals: Totals) -> tuple[np.ndarray, np.ndarray]:
        """Of the dishes at the root and at the parents."""
        _, share, _ = model.shares(totals)
        root = (self.root_customers - model.discounts[2]) / (STRENGTH + totals.root_customers)
        own = (self.group_customers - model.discounts[1] * self.group_tables) / (STRENGTH + totals.parent_customers[self.group_parent])
        return root, own + share[self.group_parent] * root[self.group_word]

    def sweep(self, model: Model, totals: Totals, number: int) -> None:
        two, one, _ = model.discounts
        root, parent = self.probabilities(model, totals)
        tables, many = np.ones(len(self.counts)), self.counts > 1
        tables[many] = seat(
            self.counts[many], ((STRENGTH + two * totals.tables[self.contexts]) * parent[self.group])[many], two, self.names[many], number)
        customers = np.bincount(self.group, tables, len(self.group_word))
        group_tables, many = np.ones(len(customers)), customers > 1
        group_tables[many] = seat(
            customers[many], ((STRENGTH + one * totals.parent_tables[self.group_parent]) * root[self.group_word])[many], one, self.group_names[many], number)
        self._count(tables, group_tables)


def _sum_tables(model: Model):
    """One pass: replays the sweeps so far and adds up the tables of the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, parents, seen = np.zeros(CONTEXTS), np.zeros(PARENTS), False
        for batch in batches:
            if not batch.num_rows:
                continue
            seating, seen = Seating(batch), True
            for number, totals in enumerate(model.sweeps):
                seating.sweep(model, totals, number + 1)
            tables += np.bincount(seating.contexts, seating.tables, CONTEXTS)
            parents += np.bincount(seating.group_parent, seating.group_tables, PARENTS)
        if seen:
            yield _sums(np.concatenate([tables, parents]))

    return run


def _sums(values: np.ndarray) -> pa.RecordBatch:
    keys = np.flatnonzero(values)
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values[keys])], ["key", "n"])


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Customers by context, and how many dishes of each level have one or two."""
    customers, few, seen = np.zeros(CONTEXTS), np.zeros(6), False
    for batch in batches:
        if batch.num_rows:
            s, seen = Seating(batch), True
            customers += np.bincount(s.contexts, s.counts, CONTEXTS)
            few += [(x == n).sum() for x in (s.counts, s.group_customers, s.root_customers) for n in (1, 2)]
    if seen:
        yield _sums(np.concatenate([customers, few]))


def _added(words: DataFrame, run, size: int) -> np.ndarray:
    """Sums by key over all tasks; there are ``size`` keys at most."""
    values = np.zeros(size)
    for key, n in words.mapInArrow(run, "key long, n double").groupBy("key").agg(F.sum("n")).collect():
        values[key] = n
    return values


def sample(words: DataFrame, sweeps: int, loners: np.ndarray) -> Model:
    """Sweeps over the vocabulary; the first entry is the seating before them. ``loners`` are
    other words, each with one customer, by context: those have one table at all times."""
    facts = _added(words, _sum_counts, CONTEXTS + 6)
    facts[:CONTEXTS] += loners
    few = facts[CONTEXTS:]
    few[::2] += loners.sum()
    model = Model(tuple(discount_of(few[i], few[i + 1]) for i in (0, 2, 4)), facts[:CONTEXTS], words.count() + int(loners.sum()), [])
    for _ in range(sweeps + 1):
        sums = _added(words, _sum_tables(model), CONTEXTS + PARENTS)
        sums += np.concatenate([loners, loners.reshape(PARENTS, -1).sum(axis=1)])
        model.sweeps.append(Totals(sums[:CONTEXTS], sums[CONTEXTS:]))
    return model


def _predict(model: Model):
    """Averaged log10 probability of every known (word, suffix) pair; those of parents and root by sweep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            s = Seating(batch)
            mean, parents, roots = np.zeros(len(s.counts)), [], []
            for number in range(1, len(model.sweeps)):
                s.sweep(model, model.sweeps[number - 1], number)
                if number < 2:
                    continue
                totals = model.sweeps[number]
                root, parent = s.probabilities(model, totals)
                own = (s.counts - model.discounts[0] * s.tables) / (STRENGTH + model.customers[s.contexts])
                mean += own + model.shares(totals)[0][s.contexts] * parent[s.group]
                parents.append(parent)
                roots.append(root)
            kept = len(roots)
            groups = np.bincount(s.group_word, minlength=len(s.words))
            yield pa.RecordBatch.from_arrays([
                s.words, batch.column("c"), batch.column("contexts"), cells(np.log10(mean / kept).astype("<f4"), s.sizes),
                cells(s.group_parent.astype(np.uint8), groups), cells(np.column_stack(parents).astype("<f4").ravel(), groups * kept),
                cells(np.column_stack(roots).astype("<f4").ravel(), np.full(len(s.words), kept)),
            ], ["word", "c", "contexts", "log_p", "parents", "parent_p", "root_p"])

    return run


def _answer(model: Model):
    """Log10 probabilities of the (word, suffix) pairs that chunks ask for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares = [model.shares(t) for t in model.sweeps[2:]]
        kept = len(shares)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                yield answers(batch.slice(at, 2000))

    def answers(rows: pa.RecordBatch) -> pa.RecordBatch:
        shares = [model.shares(t) for t in model.sweeps[2:]]
        kept = len(shares)
        asked, sizes = flat(rows.column("asked"), "<u2")
        asked, row = asked.astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)
        filled = {c: pc.fill_null(rows.column(c), b"") for c in ("contexts", "log_p", "parents", "parent_p", "root_p")}
        held, held_sizes = flat(filled["contexts"], "<u2")
        parents, parent_sizes = flat(filled["parents"], np.uint8)
        log_p = model.unseen(asked)
        known = held_sizes > 0
        if known.any():
            root = np.zeros((len(sizes), kept))
            root[known] = flat(filled["root_p"], "<f4")[0].reshape(-1, kept)
            below = np.column_stack([share[1][asked >> 8] for share in shares]) * root[row]
            found, at = find(np.repeat(np.arange(len(sizes)), parent_sizes) * PARENTS + parents, row * PARENTS + (asked >> 8))
            below[found] = flat(filled["parent_p"], "<f4")[0].reshape(-1, kept)[at]
            unseen = np.mean([share[0][asked] * below[:, i] for i, share in enumerate(shares)], axis=0)
            log_p = np.where(known[row], unseen, log_p)
        with np.errstate(divide="ignore"):
            log_p = np.log10(log_p)
        found, at = find(np.repeat(np.arange(len(sizes)), held_sizes) * CONTEXTS + held, row * CONTEXTS + asked)
        log_p[found] = flat(filled["log_p"], "<f4")[0][at]
        return pa.RecordBatch.from_arrays(
            [rows.column("chunk"), rows.column("place"), pc.fill_null(rows.column("c"), 0), cells(log_p.astype("<f4"), sizes)], ["chunk", "place", "c", "log_p"])

    return run


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are among the sorted ``keys``, and where those are."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=bool), np.zeros(0, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    found = keys[at] == wanted
    return found, at[found]


class Pairs:
    """The (word, context) pairs of a batch of words, and what they are above the words."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.batch = batch
        self.contexts, self.sizes = flat(batch.column("contexts"), "<u8")
        self.counts = flat(batch.column("counts"), "<u8")[0].astype(np.int64)
        self.word = np.repeat(np.arange(len(self.sizes)), self.sizes)
        suffixes, sizes = flat(batch.column("suffixes"), "<u2")
        self.singles = flat(batch.column("singles"), "<u8")[0]
        keys = np.concatenate([
            self.word << 16 | (self.contexts >> U(HASH_BITS)).astype(np.int64), np.repeat(np.arange(len(sizes)), sizes) << 16 | suffixes.astype(np.int64)])
        self.uppers, group = np.unique(keys, return_inverse=True)
        self.group, self.single_group = group[: len(self.word)], group[len(self.word) :]

    def names(self) -> np.ndarray:
        return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.batch.column("word").to_pylist()), dtype=U, count=len(self.sizes))

    def above(self) -> pa.RecordBatch:
        """The words with their suffixes; the tables of the pairs are the customers."""
        tables = np.ones(len(self.counts))
        if "tables" in self.batch.schema.names:
            tables = flat(self.batch.column("tables"), "<u8")[0]
        customers = np.bincount(self.group, tables, len(self.uppers)) + np.bincount(self.single_group, self.singles, len(self.uppers))
        sizes = np.bincount(self.uppers >> 16, minlength=len(self.sizes))
        return pa.RecordBatch.from_arrays([
            self.batch.column("word"), cells((self.uppers & CONTEXTS - 1).astype("<u2"), sizes), cells(customers.astype("<u8"), sizes), self.batch.column("c"),
        ], ["word", "contexts", "counts", "c"])


def _above(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield Pairs(batch).above()


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words with the number that their pairs know them by."""
    for batch in batches:
        columns = ("word", "contexts", "counts", "suffixes", "singles", "c")
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(Pairs(batch).names().view(np.int64))], [*columns, "dish"])


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many pairs there are, and how many occur once and twice."""
    for batch in batches:
        counts, singles = (flat(batch.column(c), "<u8")[0] for c in ("counts", "singles"))
        yield _sums(np.array([len(counts) + singles.sum(), (counts == 1).sum() + singles.sum(), (counts == 2).sum()], dtype=float))


def _dishes(model: Model):
    """Pairs seen more than once with their parent's probability; the others as numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            pairs = Pairs(batch)
            log_p = flat(next(_predict(model)(iter([pairs.above()]))).column("log_p"), "<f4")[0]
            many = pairs.counts > 1
            once, n = np.unique(pairs.contexts[~many], return_counts=True)
            after = batch.column("after").to_numpy()
            followed = batch.column("word").filter(pa.array(after > 0)).to_pylist()
            once = np.concatenate([once, np.fromiter(map(context_id, followed), dtype=U, count=len(followed))])
            n = np.concatenate([n, after[after > 0]])
            context = np.concatenate([pairs.contexts[many], once]).view(np.int64)
            dish = pairs.names()[pairs.word[many]].view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(context), pa.array(np.concatenate([dish, np.zeros_like(n)]), mask=np.arange(len(context)) >= len(dish)),
                pa.array(np.concatenate([pairs.counts[many], n])), pa.array(np.concatenate([log_p[pairs.group[many]], np.zeros(len(n), "<f4")])),
            ], ["context", "dish", "n", "log_p"])

    return run


def _seat_contexts(discount: float, sweeps: int):
    """Sweeps over the restaurants of a group of contexts.

    Gives each pair its tables and their mean, and, without a dish, each context's mean.
    """

    def run(table: pa.Table) -> pa.Table:
        contexts, at = np.unique(table.column("context").to_numpy(), return_inverse=True)
        many = table.column("dish").is_valid().to_numpy()
        n, p = table.column("n").to_numpy(), 10 ** table.column("log_p").to_numpy().astype(float)
        once = np.bincount(at[~many], n[~many], len(contexts))
        at, n, p, dish = at[many], n[many], p[many], table.column("dish").drop_null().to_numpy()
        names = mix(dish.view(U) + mix(contexts.view(U))[at])
        tables, mean = np.ones(len(n)), np.zeros(len(n))
        for number in range(1, sweeps + 1):
            total = once + np.bincount(at, tables, len(contexts))
            tables = seat(n, (STRENGTH + discount * total[at]) * p, discount, names, number)
            if number > 1:
                mean += tables / (sweeps - 1)
        return pa.table({
            "context": np.concatenate([contexts[at], contexts]), "dish": pa.array(np.concatenate([dish, contexts]), mask=np.arange(len(at) + len(contexts)) >= len(at)),
            "tables": np.concatenate([tables, np.zeros(len(contexts))]).astype(np.int64),
            "mean": np.concatenate([mean, once + np.bincount(at, mean, len(contexts))]),
        })

    return run


def _take_back(discount: float):
    """Words with the tables of their pairs, and the customers less the discounts."""

    def run(words: pa.Table, seated: pa.Table) -> pa.Table:
        words = words.combine_chunks()
        batch = words.to_batches()[0]
        pairs = Pairs(batch)
        tables, mean = np.ones(len(pairs.counts)), np.ones(len(pairs.counts))
        many = np.flatnonzero(pairs.counts > 1)
        own = many[np.lexsort((pairs.contexts[many], pairs.names()[pairs.word[many]]))]
        order = np.lexsort((seated.column("context").to_numpy().view(U), seated.column("dish").to_numpy().view(U)))
        tables[own], mean[own] = seated.column("tables").to_numpy()[order], seated.column("mean").to_numpy()[order]
        columns = {c: words.column(c) for c in ("word", "contexts", "counts", "suffixes", "singles", "c")}
        return pa.table(columns | {"tables": cells(tables.astype("<u8"), pairs.sizes), "excess": cells((pairs.counts - discount * mean).astype("<f4"), pairs.sizes)})

    return run


def loners_of(words: DataFrame) -> np.ndarray:
    """How many words of ``LONERS`` there are, by suffix."""
    found = np.zeros(CONTEXTS)
    for suffixes, singles in words.where(F.col("word") == F.lit(bytearray(LONERS))).select("suffixes", "singles").collect():
        found[np.frombuffer(suffixes, "<u2")] += np.frombuffer(singles, "<u8")
    return found


def seat_words(words: DataFrame, sweeps: int = SWEEPS, loners: np.ndarray | None = None) -> tuple[DataFrame, DataFrame, float]:
    """Seats the customers of all words: the words with the ``tables`` and the ``excess`` of
    their pairs, ``own, total`` tables by context, and the discount. Pairs seen once may be
    given by ``suffixes``, ``singles`` and ``after`` instead, ``loners`` by their number alone."""
    spark = words.sparkSession
    loners = np.zeros(CONTEXTS) if loners is None else loners
    none = {"suffixes": F.lit(bytearray()), "singles": F.lit(bytearray()), "after": F.lit(0).cast("long")}
    words = words.withColumns({c: x for c, x in none.items() if c not in words.columns})
    pairs, once, twice = _added(words, _count_pairs, 3) + [loners.sum(), loners.sum(), 0]
    discount = discount_of(once, twice)
    above = stored(words.mapInArrow(_above, UPPER_COLUMNS), "above")
    first = sample(above, 2, loners)
    erase(above)
    lent = spark.sparkContext.broadcast(first)

    def dishes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _dishes(lent.value)(batches)

    groups = parts_of(spark, int(pairs - once), SEATED_PAIRS)
    asked = words.mapInArrow(dishes, "context long, dish long, n long, log_p float")
    seated = released(asked.groupBy(F.pmod(F.xxhash64("context"), F.lit(groups)).alias("bucket")).applyInArrow(
        _seat_contexts(discount, sweeps), "context long, dish long, tables long, mean double"), "seated")
    back = words.drop("after").mapInArrow(_named, NAMED_COLUMNS).groupBy(F.pmod("dish", F.lit(groups)).alias("bucket")).cogroup(
        seated.where("dish IS NOT NULL").groupBy(F.pmod("dish", F.lit(groups)).alias("bucket")))
    totals = stored(seated.where("dish IS NULL").select(F.col("context").alias("own"), F.col("mean").alias("total")), "totals")
    words = released(back.applyInArrow(_take_back(discount), SEATED_COLUMNS), "words")
    erase(seated)
    return words, totals, discount


def _owns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words, and each as a context."""
    for batch in batches:
        own = np.fromiter(map(context_id, batch.column("word").to_pylist()), dtype=U, count=batch.num_rows).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(own)], ["word", "own"])


def _predict_words(model: Model, buckets: int):
    """What ``_predict`` gives, the excess of the pairs and the total as a context, by buckets of words."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                pairs = Pairs(batch)
                told = next(_predict(model)(iter([pairs.above()])))
                yield pa.RecordBatch.from_arrays(
                    [*told.columns, batch.column("contexts"), batch.column("excess"), batch.column("total"), pa.array(pairs.names() % U(buckets))],
                    [*told.schema.names, "pairs", "excess", "total", "bucket"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in held(told(batches)):
            rows = list(shared_out(table.drop_columns(["bucket"]), table.column("bucket").to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())], ["bucket", "told"])

    return run


class Told:
    """What is told of the words of a bucket, as sorted keys that all chunks' questions are looked up in."""

    def __init__(self, table: pa.Table) -> None:
        table = table.combine_chunks()
        self.words = table.column("word").combine_chunks()
        self.c, self.total = table.column("c").to_numpy(), table.column("total").to_numpy()
        self.uppers, self.log_p = self._keys(table, "contexts", "<u2", CONTEXTS), self._flat(table, "log_p", "<f4")[0]
        self.parents = self._keys(table, "parents", np.uint8, PARENTS)
        self.root_p = self._flat(table, "root_p", "<f4")[0].reshape(len(self.words), -1)
        self.parent_p = self._flat(table, "parent_p", "<f4")[0].reshape(-1, self.root_p.shape[1])
        pairs, sizes = self._flat(table, "pairs", "<u8")
        self.contexts, place = np.unique(pairs, return_inverse=True)
        self.pairs = np.repeat(np.arange(len(sizes)), sizes) << 32 | place
        self.excess = self._flat(table, "excess", "<f4")[0]

    @staticmethod
    def _flat(table: pa.Table, column: str, dtype) -> tuple[np.ndarray, np.ndarray]:
        return flat(table.column(column).combine_chunks(), dtype)

    def _keys(self, table: pa.Table, column: str, dtype, size: int) -> np.ndarray:
        values, sizes = self._flat(table, column, dtype)
        return np.repeat(np.arange(len(sizes)), sizes) * size + values

    def answers(self, model: Model, asks: pa.Table) -> pa.Table:
        asks = asks.combine_chunks()
        word = pc.index_in(asks.column("word"), self.words).to_numpy()
        asked, sizes = self._flat(asks, "asked", "<u2")
        asked, row = asked.astype(np.int64), np.repeat(word, sizes).astype(np.int64)
        parent = self.parent(model, row, asked)
        exact, exact_sizes = self._flat(asks, "exact", "<u8")
        excess = np.zeros(len(exact), dtype="<f4")
        known, place = find(self.contexts, exact)
        have, at = find(self.pairs, np.repeat(word, exact_sizes)[known].astype(np.int64) << 32 | place)
        excess[np.flatnonzero(known)[have]] = self.excess[at]
        return pa.table({
            "place": asks.column("place"), "c": self.c[word], "total": self.total[word],
            "excess": cells(excess, exact_sizes), "parent": cells(parent.astype("<f4"), sizes)})

    def parent(self, model: Model, row: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Probabilities of words after suffixes."""
        p = np.empty(len(asked))
        found, at = find(self.uppers, row * CONTEXTS + asked)
        p[found] = 10 ** self.log_p[at].astype(float)
        p[~found] = self._unseen(model, asked[~found], row[~found])
        return p

    def _unseen(self, model: Model, asked: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Of suffixes that the word was not seen after: new tables, by what is known above."""
        shares = [model.shares(t) for t in model.sweeps[2:]]
        below = np.column_stack([share[1][asked >> 8] for share in shares]) * self.root_p[row]
        found, at = find(self.parents, row * PARENTS + (asked >> 8))
        below[found] = self.parent_p[at]
        # Single precision, as the probabilities of seen suffixes have come through.
        return 10 ** np.log10(np.mean([share[0][asked] * below[:, i] for i, share in enumerate(shares)], axis=0)).astype("<f4").astype(float)


def _answer_words(lent: Broadcast):
    """The parent's probability of the suffixes, and the excess of the pairs, that chunks ask for in a bucket."""

    def run(asked: pa.Table, told: pa.Table) -> pa.Table:
        rows = []
        if asked.num_rows:
            known = Told(unsealed(told.column("told")))
            for asks in held(x for cell in asked.column("asked").to_pylist() for x in opened(cell).to_batches()):
                rows += shared_out(known.answers(lent.value, asks), asks.column("chunk").to_numpy())
        return pa.table({"chunk": pa.array([x for x, _ in rows], pa.int64()), "answers": pa.array([x for _, x in rows], pa.binary())})

    return run


def _score(lent: Broadcast, total: int, discount: float):
    """Sums over the tokens of a chunk's documents."""

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        chunk = Contents(table, scored=True)
        chunk.coded(told.filter(pc.is_valid(told.column("codes"))))
        sealed_answers = told.column("answers").drop_null()
        # A word that occurs once has one table.
        c, tables = chunk.loner.astype(np.int64), chunk.loner.astype(float)
        # A pair seen once has one table.
        excess = np.where(chunk.times == 1, 1 - discount, 0).astype("<f4")
        parent, asked = np.empty(len(chunk.uppers), dtype="<f4"), chunk.asks[chunk.uppers >> 16]
        if len(sealed_answers):
            answers = unsealed(sealed_answers).sort_by("place")
            place = answers.column("place").to_numpy()
            c[place], tables[place] = answers.column("c").to_numpy(), answers.column("total").to_numpy()
            excess[chunk.often] = flat(answers.column("excess").combine_chunks(), "<f4")[0]
            parent[asked] = flat(answers.column("parent").combine_chunks(), "<f4")[0]
            del answers
        parent[~asked] = chunk.answered(lent.value)
        parent = parent[chunk.upper]
        del chunk.upper, chunk.uppers
        # A word follows as often as it occurs, so its count is its customers as a context.
        log_p = np.log10((excess + (STRENGTH + discount * tables)[chunk.before] * parent) / (STRENGTH + c)[chunk.before])
        count = c[chunk.word]
        base = np.log10((count + 0.5) / (total + 0.5 * (lent.value.words + 1)))
        starts = np.cumsum(chunk.lengths) - chunk.lengths
        sums = {name: np.add.reduceat(x[chunk.place], starts) for name, x in (("n_known", (count > 0).astype(np.int64)), ("base_score", base), ("score", log_p))}
        return pa.table({"doc": chunk.docs, "held_out": ~chunk.learn, "n_tokens": chunk.lengths, **sums})

    return run


def fit_and_score(docs: DataFrame, train: Column, key: str = "doc_id", text_col: str = "text", sweeps: int = SWEEPS) -> DataFrame:
    """Learn from the rows where ``train`` holds and score all rows.

    Returns ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``, the model's log10 probability of the text.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    spark = docs.sparkSession
    # Groups by chunk then need no exchange, in as many tasks as if they had one.
    chunks = write_bucketed(rows.mapInArrow(_chunks, CHUNK_COLUMNS), scratch_path(spark, "chunks"), "chunks", parts_of(spark, 0, 1), "chunk", "part")
    facts = chunks.agg(
        F.coalesce(F.sum("words"), F.lit(0)).alias("rows"), F.coalesce(F.sum("learnt"), F.lit(0)).alias("total"), F.countDistinct("chunk").alias("chunks")).first()
    codes = count_pairs(chunks, facts.total)
    by_chunk = chunks.groupBy("chunk").cogroup(codes.groupBy("chunk"))
    merged = merged_words(by_chunk, spark, facts.rows, max(1, facts.chunks))
    loners = loners_of(merged)
    words, totals, discount = seat_words(merged.where(F.col("word") != F.lit(bytearray(LONERS))), max(2, sweeps), loners)
    erase(merged)
    above = stored(words.mapInArrow(_above, UPPER_COLUMNS), "above")
    model = sample(above, max(2, sweeps), loners)
    erase(above)
    lent = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _predict_words(lent.value, buckets)(batches)

    buckets = parts_of(spark, facts.rows, MERGED_ROWS)
    # The totals meet the bare words, so that the rows with pairs are shuffled by word once.
    owned = words.select("word").mapInArrow(_owns, "word binary, own long").join(totals, "own").drop("own")
    told = words.withColumn("counts", F.lit(bytearray())).join(owned, "word", "left").mapInArrow(predict, TOLD_COLUMNS)
    asked = by_chunk.applyInArrow(_asked(buckets), ASKED_COLUMNS)
    answers = asked.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(_answer_words(lent), ANSWER_COLUMNS)
    told = answers.unionByName(codes, allowMissingColumns=True)
    scored = chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        _score(lent, int(facts.total), discount), "doc long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        F.col("doc").alias(key), "held_out", "n_tokens", "n_known", F.lit(facts.total).cast("long").alias("train_tokens"), "base_score", "score")
