"""Exact Jaccard self-join on word shingles by partitioning the universe of shingles.

Pairs with similarity at least t differ in at most H shingles, and H is fixed by size
bands: sizes l .. l/t form a band, and similar sets lie in one band or in neighbours. For
a band, shingles are hashed into m > H segments; two similar sets agree on at least one
whole segment (pigeonhole), so a set is indexed by one signature for each segment, once
for its own band and once for the band below. Empty segments are alike in very many sets;
with a tenth more segments than H most sets have more than H filled ones, one of which
must agree, and index those alone. A set with fewer indexes its empty segments as well.

Cost-based allocation: signatures held by one set alone cost nothing further. Sets sharing
one are verified against the bucket's smallest id first; only buckets that still hold
several components go on. Of these, a bucket is tried pair by pair across components
inside the task that reads it, in cells of bounded size. For a bucket over ``HEAVY``
members that costs more than its neighbourhoods: the segment is not used (allocation 0);
each of its z such segments is made up for by two filled ones with allocation 2, the first
ones in order, where sets are joined when one segment equals the other with one shingle
removed. Sum of allocations > H, so no pair is lost. Sets with too many heavy segments
for that stay in their heavy buckets.

A pair is tried on sketches first: the parity of the number of shingles in each of about
as many cells as the set has shingles. Cells of odd difference are no more than the
shingles that differ, so a pair with more of them than similarity allows is none, and no
similar pair is lost. What remains is verified on the shingle sets of the whole texts.
Inside a bucket the sketches are folded to a few bytes and tried before a pair leaves it,
so a group of texts just below the limit costs no rows. Equal sets are grouped by a
128-bit digest beforehand, and equal sets within a task send their signatures once.

Signatures go straight from the text into their only shuffle and are read in order, so a
bucket is never held as a whole.

Defined cases: null text, empty text or text without a word has an empty set and no links;
fewer words than a shingle are one shingle; repeated rows are equal sets; rows with a null
id have their size, no links and a null component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import stored
from trawl.llm.components import components
from trawl.operators.keyed import is_small

# Estimated, not measured: testing a row of a bucket costs some 15 ns a member and segment,
# its one-deletion neighbourhoods some 200 us. Beyond this many members they should be cheaper.
HEAVY = 8192
# Rows of a bucket that meet in one task, and rows tested at once against a cell.
BLOCK = 4096
TESTED_ROWS = 256
# Sketches inside buckets are folded to this many bytes; slices of texts hold about so many.
SMALL_BYTES = 128
SLICE_BYTES = 1 << 20
SENT_ROWS = 100_000
# Most ids (8 bytes each) broadcast to pick the texts to verify; beyond it, a shuffle.
BROADCAST_IDS = 500_000
CACHED_WORDS = 100_000
# Signatures keep 48 bits: chance meetings are rare and are verified.
SIGNATURE = (1 << 48) - 1
LEAST_CELLS = 64
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class WordHashes(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@dataclass(frozen=True)
class Rule:
    """Shingle length in words and the least similarity as a fraction."""

    words: int = 3
    num: int = 9
    den: int = 10
    edges: np.ndarray = field(default=None, compare=False)

    def __post_init__(self) -> None:
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(edges[-1] * self.den // self.num + 1)
        object.__setattr__(self, "edges", np.array(edges))

    def shingles(self, text: str, hashes: WordHashes) -> np.ndarray:
        """Sorted distinct shingle hashes of the whole text."""
        words = text.encode("utf-8", "replace").lower().split()
        if not words:
            return np.zeros(0, dtype=U)
        if len(words) < self.words:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=U)
        own = np.fromiter(map(hashes.__getitem__, words), dtype=U, count=len(words))
        span = len(own) - self.words + 1
        total = own[:span]
        for k in range(1, self.words):
            total = mix(total * U(0x9E3779B97F4A7C15) + own[k : k + span])
        return np.unique(total)

    def similar(self, a: np.ndarray, b: np.ndarray) -> bool:
        if min(len(a), len(b)) * self.den < max(len(a), len(b)) * self.num:
            return False
        common = len(np.intersect1d(a, b, assume_unique=True))
        return common > 0 and self.den * common >= self.num * (len(a) + len(b) - common)

    def most_apart(self, a: int, b: int) -> int:
        """The most shingles in which similar sets of these sizes differ; -1: not similar."""
        if min(a, b) * self.den < max(a, b) * self.num:
            return -1
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def instances(self, size: int) -> list[tuple[int, int, int]]:
        """The (band, most differences, segments) under which a set of this size is indexed."""
        band = int(np.searchsorted(self.edges, size, side="right")) - 1
        found = []
        for k in (band - 1, band):
            if k >= 0:
                differ = int(self.edges[k + 1] - 1) * (self.den - self.num) // self.num
                if differ:  # without a difference only equal sets are similar
                    found.append((k, differ, differ + 2 + differ // 10))
        return found


def segment_sums(shingles: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum of mixed hashes and number of shingles by segment; and each shingle's segment."""
    place = ((shingles >> U(20)) % U(segments)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    ends = np.searchsorted(place[order], np.arange(segments + 1))
    running = np.concatenate([np.zeros(1, dtype=U), np.cumsum(mix(shingles)[order])])
    return running[ends[1:]] - running[ends[:-1]], np.diff(ends), place


def signature(sums: np.ndarray, counts: np.ndarray, segment: np.ndarray, band: int) -> np.ndarray:
    tag = segment.astype(U) * U(0xD6E8FEB86659FD93) + counts.astype(U) * U(0xA0761D6478BD642F) + U(band)
    return (mix(sums + mix(tag)) & U(SIGNATURE)).view(np.int64)


def indexed_segments(counts: np.ndarray, differ: int) -> np.ndarray:
    """The filled segments if they are more than the differences, else all."""
    filled = np.flatnonzero(counts)
    return filled if len(filled) > differ else np.arange(len(counts))


def signatures(shingles: np.ndarray, rule: Rule) -> np.ndarray:
    parts = []
    for band, differ, segments in rule.instances(len(shingles)) if len(shingles) else []:
        sums, counts, _ = segment_sums(shingles, segments)
        at = indexed_segments(counts, differ)
        parts.append(signature(sums[at], counts[at], at, band))
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def allocated(shingles: np.ndarray, rule: Rule, heavy: set[int]) -> Iterator[tuple[str, int]]:
    """Entries of a set with heavy signatures: (role, key).

    Role ``whole`` keys meet role ``less`` keys (one shingle removed); ``heavy`` keys meet
    each other. Segments with allocation 2 are the shortest run from the first one on that
    holds 2z filled ones. Of two sets the shorter run counts for both.
    """
    for band, differ, segments in rule.instances(len(shingles)):
        sums, counts, place = segment_sums(shingles, segments)
        own = signature(sums, counts, np.arange(segments), band)
        indexed = indexed_segments(counts, differ)
        least = 0 if len(indexed) == segments else 1  # empty segments are keys where they are indexed
        hot = [s for s in own[indexed].tolist() if s in heavy]
        if not hot:
            continue
        filled = np.flatnonzero(counts)
        if 2 * len(hot) > len(filled):
            take = segments
            yield from (("heavy", s) for s in hot)
        else:
            take = int(filled[2 * len(hot) - 1]) + 1
        yield from (("whole", s) for s in own[:take][counts[:take] >= least].tolist())
        kept = (place < take) & (counts[place] > least)
        inside, at = shingles[kept], place[kept]
        if len(at):
            less = signature(sums[at] - mix(inside), counts[at] - 1, at, band)
            yield from (("less", s) for s in np.unique(less).tolist())


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of the cells; their number is a power of two, so that sketches fold."""
    cells = max(LEAST_CELLS, 1 << (len(shingles) - 1).bit_length()) if len(shingles) else LEAST_CELLS
    odd = np.bincount((shingles & U(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def odd_cells(a: bytes, b: bytes) -> int:
    """Cells in which two sketches differ, the larger one folded to the smaller one's size."""
    x, y, bits = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * max(len(a), len(b))
    if len(a) < len(b):
        x, y = y, x
    while bits > 8 * min(len(a), len(b)):
        bits //= 2
        x = (x >> bits) ^ (x & ((1 << bits) - 1))
    return (x ^ y).bit_count()


def folded(parities: bytes, most: int) -> bytes:
    """A sketch of at most ``most`` bytes; differences can only fall."""
    while len(parities) > most:
        half = len(parities) // 2
        value = int.from_bytes(parities[:half], "little") ^ int.from_bytes(parities[half:], "little")
        parities = value.to_bytes(half, "little")
    return parities


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts in slices of about ``SLICE_BYTES`` of text, however large a batch is."""
    for batch in batches:
        ids, texts = batch.column("id"), batch.column("text")
        weights = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
        at = 0
        while at < batch.num_rows:
            before = int(weights[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(weights, before + SLICE_BYTES, side="right")))
            yield ids.slice(at, end - at), [text or "" for text in texts.slice(at, end - at).to_pylist()]
            at = end


def _index(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for ids, texts in _slices(batches):
            sizes, digests, sketches = [], [], []
            for text in texts:
                shingles = rule.shingles(text, hashes)
                sizes.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                sketches.append(sketch(shingles))
            small = [folded(x, SMALL_BYTES) for x in sketches]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary()), pa.array(small, pa.binary())],
                ["id", "size", "digest", "sketch", "small"])

    return run


def _signed(rule: Rule):
    """(id, sig) for every indexed segment, straight into the shuffle; a set that the task
    has just sent is not sent again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sent = WordHashes(), set()
        for ids, texts in _slices(batches):
            parts, counts = [np.zeros(0, dtype=np.int64)], []
            for text in texts:
                shingles = rule.shingles(text, hashes)
                digest = xxhash.xxh3_128_digest(shingles.tobytes())
                parts.append(parts[0] if digest in sent else signatures(shingles, rule))
                counts.append(len(parts[-1]))
                if len(sent) >= CACHED_WORDS:
                    sent.clear()
                sent.add(digest)
            rows = pa.array(np.repeat(np.arange(len(counts)), counts))
            yield pa.RecordBatch.from_arrays([ids.take(rows), pa.array(np.concatenate(parts), pa.int64())], ["id", "sig"])

    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in order of (sig, id): every row but the first of a bucket, with that one."""
    last, hub = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, ids = batch.column("sig").to_numpy(), batch.column("id")
        opens = np.concatenate([[last is None or sig[0] != last], sig[1:] != sig[:-1]])
        first = np.maximum.accumulate(np.where(opens, np.arange(len(sig)), -1))
        rest = np.flatnonzero(~opens)
        if len(rest):
            hubs = ids.take(pa.array(np.maximum(first[rest], 0)))
            if first[rest[0]] < 0:  # the bucket began in an earlier batch
                hubs = pc.if_else(pa.array(first[rest] < 0), hub, hubs)
            yield pa.RecordBatch.from_arrays([batch.column("sig").take(pa.array(rest)), ids.take(pa.array(rest)), hubs], ["sig", "id", "hub"])
        last = sig[-1]
        if first[-1] >= 0:
            hub = ids[int(first[-1])]


def _may_be_similar(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("size_a", "size_b", "sketch_a", "sketch_b"))
            keep = [odd_cells(x, y) <= rule.most_apart(m, n) for m, n, x, y in zip(*columns)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verify(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last = WordHashes(), (None, None)
        for batch in batches:
            keep = []
            for a, b, text_a, text_b in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))):
                if last[0] != b:
                    last = (b, rule.shingles(text_b or "", hashes))
                keep.append(rule.similar(rule.shingles(text_a or "", hashes), last[1]))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _as_batch(rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["id", "top", "role", "key"])


def _allocate(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            types = [batch.schema.field("id").type] * 2 + [pa.string(), pa.int64()]
            rows: list[tuple] = []
            for node, top, text, heavy in zip(*(batch.column(c).to_pylist() for c in ("id", "top", "text", "heavy"))):
                rows += ((node, top, role, key) for role, key in allocated(rule.shingles(text or "", hashes), rule, set(heavy)))
                if len(rows) >= SENT_ROWS:
                    yield _as_batch(rows, types)
                    rows = []
            if rows:
                yield _as_batch(rows, types)

    return run


def _texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of some ids. Few ids are broadcast after a count; many are shuffled."""
    few = is_small(ids, BROADCAST_IDS)
    return texts.join(F.broadcast(ids) if few else ids, "id", "left_semi")


def verified(pairs: DataFrame, indexed: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose sets are similar, by their sketches first."""
    left, right = (indexed.select(F.col("id").alias(x), F.col("size").alias(f"size_{x}"), F.col("sketch").alias(f"sketch_{x}")) for x in "ab")
    schema = pairs.schema
    pairs = stored(pairs.join(left, "a").join(right, "b").mapInArrow(_may_be_similar(rule), schema).distinct(), "pairs")
    ids = stored(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct(), "ids")
    chosen = stored(_texts_of(texts, ids), "texts")
    left = chosen.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = chosen.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(_verify(rule), schema)


def _fold_rows(words: np.ndarray, width: int) -> np.ndarray:
    """Sketches as rows of 64-bit words, folded to ``width`` words."""
    while words.shape[1] > width:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


class Cell:
    """Rows of one cell: of one bucket, or of two blocks of a large one."""

    def __init__(self, rule: Rule, ids: np.ndarray, tops: np.ndarray, sides: np.ndarray, sizes: np.ndarray, sketches: list[bytes]):
        self.rule, self.ids, self.tops, self.sides, self.sizes = rule, ids, tops, sides, sizes
        widths = np.array([len(x) // 8 for x in sketches])
        self.kinds = [(int(w), at, np.frombuffer(b"".join(sketches[i] for i in at), dtype=U).reshape(len(at), w))
                      for w in np.unique(widths) for at in [np.flatnonzero(widths == w)]]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of pairs across components and sides that may be similar, a few rows at a time."""
        if not (self.tops != self.tops[0]).any():
            return
        for k, (width, left, x) in enumerate(self.kinds):
            for other, right, y in self.kinds[k:]:
                y = _fold_rows(y, width)
                for start in range(0, len(left), TESTED_ROWS):
                    yield self._near(left[start : start + TESTED_ROWS], x[start : start + TESTED_ROWS], right, y, width == other)

    def _near(self, i: np.ndarray, x: np.ndarray, j: np.ndarray, y: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        apart = np.zeros((len(i), len(j)), dtype=np.int32)
        for w in range(x.shape[1]):
            apart += np.bitwise_count(x[:, w, None] ^ y[None, :, w])
        m, n, num, den = self.sizes[i][:, None], self.sizes[j][None, :], self.rule.num, self.rule.den
        near = (apart <= (m + n) * (den - num) // (den + num)) & (np.minimum(m, n) * den >= np.maximum(m, n) * num)
        near &= self.tops[i][:, None] != self.tops[j][None, :]
        sides = self.sides[i][:, None], self.sides[j][None, :]
        near &= (sides[0] != sides[1]) | (sides[0] == 0)
        if same:
            near &= i[:, None] < j[None, :]
        a, b = np.nonzero(near)
        return i[a], j[b]


def _tested(rule: Rule):
    """From rows in order of (key, cell): the pairs of a cell whose sketches allow similarity."""
    def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        column = {c: rows.column(c).to_numpy() for c in ("id", "top", "side", "size")}
        ids = rows.column("id").combine_chunks()
        cell = Cell(rule, column["id"], column["top"], column["side"], column["size"], rows.column("small").to_pylist())
        for a, b in cell.pairs():
            if len(a):
                low = column["id"][a] < column["id"][b]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.where(low, a, b))), ids.take(pa.array(np.where(low, b, a)))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, cells = batch.column("key").to_numpy(), batch.column("cell").to_numpy()
            opens = np.flatnonzero((keys[1:] != keys[:-1]) | (cells[1:] != cells[:-1])) + 1
            if last is not None and last != (keys[0], cells[0]):
                yield from found(pa.Table.from_batches(waiting))
                waiting = []
            edges = [0, *opens.tolist()]
            for start, end in zip(edges, edges[1:]):
                yield from found(pa.Table.from_batches([*waiting, batch.slice(start, end - start)]))
                waiting = []
            waiting.append(batch.slice(edges[-1]))
            last = keys[-1], cells[-1]
        if waiting:
            yield from found(pa.Table.from_batches(waiting))

    return run


def _candidates(rows: DataFrame, indexed: DataFrame, rule: Rule, block: int) -> DataFrame:
    """Pairs (a, b) of one key and different components whose sketches allow similarity.

    ``rows``: key, id, top, role; ``whole`` rows meet ``less`` rows, others meet each other.
    A bucket is dealt by id into blocks of about ``block`` rows, and a row goes to the
    cells of its block with every other, so no task holds more than two blocks. Pairs are
    tested inside the cell on small sketches; only those that may be similar leave it.
    """
    id_type = rows.schema["id"].dataType.simpleString()
    rows = rows.withColumn("mate", F.expr("CASE role WHEN 'whole' THEN 'less' WHEN 'less' THEN 'whole' ELSE role END"))
    counts = stored(rows.groupBy("key", "role").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), "blocks")
    others = counts.select("key", F.col("role").alias("mate"), F.col("blocks").alias("mates"))
    # A key without a mate meets nothing and goes no further.
    dealt = rows.join(counts, ["key", "role"]).join(others, ["key", "mate"]).join(indexed.select("id", "size", "small"), "id")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = dealt.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, mates - 1)")))
    alone = F.col("role") == F.col("mate")
    low, high = F.least("own", "other"), F.greatest("own", "other")
    cell = F.when(alone, low.cast("long") * F.col("blocks") + high).when(F.col("role") == "whole", F.col("own").cast("long") * F.col("mates") + F.col("other"))
    cell = cell.otherwise(F.col("other").cast("long") * F.col("blocks") + F.col("own"))
    side = F.when(alone & (F.col("own") == F.col("other")), 0).when(F.when(alone, F.col("own") < F.col("other")).otherwise(F.col("role") == "whole"), 1).otherwise(2)
    placed = placed.select("key", cell.alias("cell"), side.alias("side"), "id", "top", "size", "small")
    sent = placed.repartition("key", "cell").sortWithinPartitions("key", "cell")
    return sent.mapInArrow(_tested(rule), f"a {id_type}, b {id_type}").distinct()


def similar_components(
    docs: DataFrame, key: str = "doc_id", text_col: str = "text", words: int = 3, num: int = 9, den: int = 10,
    heavy_members: int = HEAVY, block: int = BLOCK,
) -> DataFrame:
    """One row per document: ``key``, ``n_shingles``, ``component_id`` (smallest id reachable)."""
    rule = Rule(words, num, den)
    every = docs.select(F.col(key).alias("id"), F.col(text_col).alias("text"))
    texts = every.where(F.col("id").isNotNull())
    id_type = texts.schema["id"].dataType.simpleString()
    indexed = stored(every.mapInArrow(_index(rule), f"id {id_type}, size long, digest binary, sketch binary, small binary"), "index")
    filled = indexed.where("size > 0 AND id IS NOT NULL")
    classes = stored(filled.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"), "classes")
    equal = filled.select("id", "digest").join(classes, "digest").select(F.col("id").alias("a"), F.col("first").alias("b")).where("a <> b")

    entries = texts.mapInArrow(_signed(rule), f"id {id_type}, sig long").repartition("sig").sortWithinPartitions("sig", "id")
    members = stored(entries.mapInArrow(_buckets, f"sig long, id {id_type}, hub {id_type}").where("id <> hub"), "members")
    stars = members.select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    links = stored(equal.union(verified(stars, filled, texts, rule)), "verified")
    found = stored(components(links), "components")

    more = _remaining(members, found, filled, texts, rule, heavy_members, block)
    if more is not None:
        late = stored(verified(more, filled, texts, rule), "verified")
        if not late.isEmpty():
            found = stored(components(links.union(late)), "components")
    named = indexed.select("id", "size").join(found.withColumnRenamed("node", "id"), "id", "left")
    return named.select(
        F.col("id").alias(key), F.col("size").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"),
    )


def _remaining(
    members: DataFrame, found: DataFrame, indexed: DataFrame, texts: DataFrame, rule: Rule, heavy_members: int, block: int,
) -> DataFrame | None:
    """Pairs still to be tried: same bucket, different components, neither the hub."""
    tops = found.select(F.col("node").alias("id"), F.col("component").alias("top"))
    ends = members.join(tops, "id", "left").withColumn("top", F.coalesce("top", "id"))
    mixed = stored(ends.groupBy("sig").agg(F.min("top").alias("low"), F.max("top").alias("high"), F.count("*").alias("n"))
                   .where("low <> high").select("sig", "n"), "mixed")
    if mixed.isEmpty():
        return None
    open_rows = stored(ends.select("sig", "id", "top").join(mixed, "sig"), "open")
    light = open_rows.where(F.col("n") <= heavy_members).select(F.col("sig").alias("key"), "id", "top", F.lit("light").alias("role"))
    heavy = open_rows.where(F.col("n") > heavy_members)
    if heavy.isEmpty():
        return _candidates(light, indexed, rule, block)
    marked = stored(heavy.groupBy("id", "top").agg(F.collect_set("sig").alias("heavy")), "heavy")
    with_text = _texts_of(texts, marked.select("id")).join(marked, "id")
    id_type = texts.schema["id"].dataType.simpleString()
    entries = with_text.select("id", "top", "text", "heavy").mapInArrow(_allocate(rule), f"id {id_type}, top {id_type}, role string, key long").distinct()
    entries = stored(entries.select("key", "id", "top", "role").union(light), "allocated")
    return _candidates(entries, indexed, rule, block)


def keep_one(docs: DataFrame, key: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The document with the smallest id of every component; rows with a null id stay.

    Repeated rows with one id and text are reduced to one. Rows with one id and different
    texts are documents of their own, so each is dropped for its own text alone.
    """
    digest = F.coalesce(F.unhex(F.md5(F.col(text_col).cast("binary"))), F.lit(b""))
    named = docs.where(F.col(key).isNotNull())
    texts = named.select(F.col(key).alias("id"), digest.alias("digest")).groupBy("id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    if not texts.where("low <> high").isEmpty():
        return _keep_one_text(docs, key, text_col, words, num, den)
    groups = similar_components(docs, key, text_col, words, num, den)
    kept = stored(groups.where(F.col(key) == F.col("component_id")).select(key).distinct(), "kept")
    named = docs.where(F.col(key).isNotNull()).join(kept, key, "left_semi").dropDuplicates([key])
    return named.select(docs.columns).unionByName(docs.where(F.col(key).isNull()))


def _keep_one_text(docs: DataFrame, key: str, text_col: str, words: int, num: int, den: int) -> DataFrame:
    """``keep_one`` where ids repeat with other texts: rows are numbered and compared by number."""
    named = docs.where(F.col(key).isNotNull()).dropDuplicates([key, text_col])
    rows = stored(named.withColumn("row_number_", F.monotonically_increasing_id()), "numbered")
    groups = similar_components(rows, "row_number_", text_col, words, num, den)
    firsts = groups.join(rows.select("row_number_", key), "row_number_").groupBy("component_id").agg(F.min(F.struct(key, "row_number_")).alias("first"))
    kept = stored(firsts.select("first.row_number_"), "kept")
    return rows.join(kept, "row_number_", "left_semi").select(docs.columns).unionByName(docs.where(F.col(key).isNull()))
