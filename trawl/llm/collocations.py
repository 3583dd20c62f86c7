"""Phrases of a corpus that occur together more often than their parts suggest, by SON.

The documents are cut into shards, runs of a bounded number of words, which are written
once as word numbers with their vocabulary. Each shard is then mined completely: it counts
all its phrases of a size and reports those that reach its own support, the global one
lowered in proportion to the shard's share of the language's words, rounded up. A phrase
that reaches the global support reaches it in one shard at least. Small shares round up to
a support of one, where a union alone would hold every phrase; so the reports carry their
counts and a phrase is a candidate only if they, with the most that silent shards can hold
back, may reach the global support. Longer phrases are mined only where both shorter ones
in them are candidates. In the end all candidates are counted exactly in all shards, word
for word.

Candidates travel to the shards as a bitmap of hashes. Its size follows their number up to
``MOST_BITS``; a fuller bitmap lets more phrases through to the exact count and loses none.

Reports are hashes with counts, one a shard and phrase at most, so the most frequent
phrase is shuffled as many times as there are shards. Hot words meet their phrases in
plain joins of written tables, which Spark can split.

Defined cases: a null language is ``und``; null and empty texts hold no words; repeated
rows count again; phrases never cross a break or a text's end; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import stored
from trawl.operators.keyed import BROADCAST_ROWS, is_small

# Words of one shard: what a task holds at a time.
SHARD_WORDS = 2_000_000
# Long texts are read in pieces of about this many bytes, cut at breaks.
SEGMENT_BYTES = 4 << 20
# Bits of the hashes of phrases; the fewer, the less is shuffled. Equal hashes of different
# phrases only make candidates.
HASH_BITS = 48
# Most bits of a bitmap of candidates, 64 MB.
MOST_BITS = 1 << 29
# Languages whose sizes every task holds; shards of further ones report every phrase.
KNOWN_LANGUAGES = 10_000
# Rows of one language that are ranked in one task.
RANKED_ROWS = 200_000

BREAKS = b".,;:!?\n\x0b\x0c\r"
_table = bytearray(range(256))
for _b in range(ord("A"), ord("Z") + 1):
    _table[_b] = _b + 32
for _b in BREAKS:
    _table[_b] = 10
_table[9] = 32
TABLE = bytes(_table)
# A break between words; no word holds a full stop.
BREAK = b"."


def word_runs(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words with ``BREAK`` between pieces, a bounded run at a time."""
    text, at = text.translate(TABLE), 0
    while at < len(text):
        end = text.find(b"\n", at + SEGMENT_BYTES)
        end = len(text) if end < 0 else end
        yield text[at:end].replace(b"\n", b" . ").split()
        at = end + 1


SHARDS = "shard string, lang string, words long, vocabulary binary, numbers binary"


def write_shards(docs: DataFrame) -> DataFrame:
    """One row per shard and language: its vocabulary, one word a line, and the places in
    it of all its words in order, 0 for a break."""

    def run(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0

        def numbered() -> defaultdict:
            place: defaultdict = defaultdict()
            place.default_factory = place.__len__
            place[BREAK] = 0
            return place

        places: dict[str, defaultdict] = defaultdict(numbered)
        found: dict[str, list] = defaultdict(list)
        held = 0

        def close():
            nonlocal held, number
            for lang, arrays in found.items():
                numbers = np.concatenate(arrays)
                yield [f"{part}-{number}", lang, int((numbers > 0).sum()), b"\n".join(places[lang]), numbers.tobytes()]
            places.clear()
            found.clear()
            held, number = 0, number + 1

        def batch_of(rows):
            columns = list(zip(*rows))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "lang", "words", "vocabulary", "numbers"])

        gap = np.zeros(1, dtype="<i4")
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
                for words in word_runs(text.as_py()):
                    if words:
                        found[lang] += [np.fromiter(map(places[lang].__getitem__, words), "<i4", len(words)), gap]
                        held += len(words)
                    if held >= SHARD_WORDS:
                        yield batch_of(close())
        if found:
            yield batch_of(close())

    texts = docs.where(F.length("text") > 0).select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    return stored(texts.mapInArrow(run, SHARDS), "word-shards")


def word_hashes(lang: str, vocabulary: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in vocabulary), np.uint64, len(vocabulary))


def mixed(*parts: np.ndarray) -> np.ndarray:
    """One hash of equally many hashes of words in order."""
    h = np.zeros(len(parts[0]), dtype=np.uint64)
    for part in parts:
        h = (h ^ part) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h >> np.uint64(64 - HASH_BITS)


class Bitmap:
    """Whether a hash may be among the given ones."""

    def __init__(self, bits: np.ndarray, width: int) -> None:
        self.bits, self.shift = bits, np.uint64(HASH_BITS - width)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bitmap_of(hashes: DataFrame) -> Bitmap:
    """A bitmap of the column ``h`` of a written table, made in slices by tasks."""
    width = max(16, min(MOST_BITS.bit_length() - 1, (16 * hashes.count()).bit_length()))
    slice_bits = max(3, width - 12)

    def run(batches):
        now, own = -1, np.zeros(1 << slice_bits, dtype=np.uint8)

        def packed():
            return pa.RecordBatch.from_pydict({"slice": pa.array([now], pa.int64()), "bits": pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())})

        for batch in batches:
            at = batch.column("at").to_numpy()
            cuts = np.flatnonzero(np.diff(at >> slice_bits, prepend=-1)).tolist() + [len(at)]
            for a, b in zip(cuts, cuts[1:]):
                if (this := int(at[a] >> slice_bits)) != now:
                    if now >= 0:
                        yield packed()
                    now = this
                    own[:] = 0
                own[at[a:b] & ((1 << slice_bits) - 1)] = 1
        if now >= 0:
            yield packed()

    at = F.shiftrightunsigned("h", HASH_BITS - width)
    placed = hashes.select(at.alias("at"), F.shiftright(at, slice_bits).alias("slice")).repartition("slice").sortWithinPartitions("at").select("at")
    bits = np.zeros(1 << (width - 3), dtype=np.uint8)
    size = 1 << (slice_bits - 3)
    for r in placed.mapInArrow(run, "slice long, bits binary").collect():  # no more than the bitmap's bytes
        bits[r.slice * size : (r.slice + 1) * size] |= np.frombuffer(r.bits, dtype=np.uint8)
    return Bitmap(bits, width)


class Shard:
    """Distinct phrases of one shard and language, as places in its vocabulary."""

    def __init__(self, lang: str, vocabulary: bytes, numbers: bytes) -> None:
        self.lang, self.words = lang, vocabulary.split(b"\n")
        self.numbers = np.frombuffer(numbers, dtype="<i4").astype(np.int64)
        self.hashes = word_hashes(lang, self.words)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.numbers, minlength=len(self.words))

    def pairs(self, words: Bitmap) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and second words, counts, and for each place its pair or -1."""
        good = words.may_hold(mixed(self.hashes))
        good[0] = False
        held = good[self.numbers]
        at = np.flatnonzero(held[:-1] & held[1:])
        key = self.numbers[at] * len(self.words) + self.numbers[at + 1]
        distinct, place, counts = np.unique(key, return_inverse=True, return_counts=True)
        pair_at = np.full(len(self.numbers), -1, dtype=np.int64)
        pair_at[at] = place
        return distinct // len(self.words), distinct % len(self.words), counts, pair_at

    def triples(self, words: Bitmap, pairs: Bitmap) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The three words and counts of triples whose two pairs may be candidates."""
        first, second, _, pair_at = self.pairs(words)
        good = np.concatenate([pairs.may_hold(mixed(self.hashes[first], self.hashes[second])), [False]])
        held = good[pair_at]
        at = np.flatnonzero(held[:-1] & held[1:])
        key = pair_at[at] * len(self.words) + self.numbers[at + 2]
        distinct, counts = np.unique(key, return_counts=True)
        pair = distinct // len(self.words)
        return first[pair], second[pair], distinct % len(self.words), counts


def shards_in(batches) -> Iterator[tuple[Shard, int]]:
    for batch in batches:
        for i in range(len(batch)):
            lang, words, vocabulary, numbers = (batch.column(c)[i].as_py() for c in ("lang", "words", "vocabulary", "numbers"))
            yield Shard(lang, vocabulary, numbers), words


def frequent_words(shards: DataFrame, least: int) -> DataFrame:
    """``lang, word, f, h`` of the words that occur ``least`` times in their language."""

    def count(batches):
        for shard, _ in shards_in(batches):
            counts = shard.word_counts()[1:]
            yield pa.RecordBatch.from_arrays([
                pa.array([shard.lang] * len(counts), pa.string()), pa.array(shard.words[1:], pa.binary()).cast(pa.string()),
                pa.array(mixed(shard.hashes[1:]).astype(np.int64)), pa.array(counts),
            ], ["lang", "word", "h", "f"])

    rows = shards.mapInArrow(count, "lang string, word string, h long, f long")
    summed = rows.groupBy("lang", "word").agg(F.sum("f").alias("f"), F.first("h").alias("h"))
    return stored(summed.where(F.col("f") >= least), "words")


def local_support(least: int, words: int, total: int | None) -> int:
    """The support of a shard with ``words`` of the language's ``total`` words."""
    return 1 if total is None else max(1, -(-least * words // total))


def candidate_hashes(shards: DataFrame, totals: dict[str, int], least: int, words: Bitmap, pairs: Bitmap | None = None) -> DataFrame:
    """``h`` of the pairs (of the triples, given ``pairs``) that may occur ``least`` times."""
    held = shards.sparkSession.sparkContext.broadcast((totals, words, pairs))
    codes = {lang: i for i, lang in enumerate(totals)}

    def mine(batches):
        totals, words, pairs = held.value
        for shard, n in shards_in(batches):
            least_here = local_support(least, n, totals.get(shard.lang))
            *places, counts = shard.pairs(words)[:3] if pairs is None else shard.triples(words, pairs)
            kept = counts >= least_here
            h = mixed(*[shard.hashes[p[kept]] for p in places])
            # What a shard that reports nothing may hold back is taken off here and added for all shards below.
            surplus = counts[kept] - (least_here - 1)
            code = np.full(len(h), codes.get(shard.lang, -1), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(h.astype(np.int64)), pa.array(surplus)], ["code", "h", "surplus"])

    spark = shards.sparkSession
    known = spark.createDataFrame([(codes[lang], lang, n) for lang, n in totals.items()], "code int, lang string, total long")
    back = F.expr(f"greatest(({least}L * words + total - 1) div total, 1L) - 1").alias("back")
    slack = shards.select("lang", "words").join(F.broadcast(known), "lang").groupBy("code").agg(F.sum(back).alias("slack"))
    mined = shards.mapInArrow(mine, "code int, h long, surplus long").repartition("h")
    summed = mined.groupBy("code", "h").agg(F.sum("surplus").alias("surplus"))
    reached = summed.join(F.broadcast(slack), "code", "left").where(F.col("surplus") + F.coalesce("slack", F.lit(0)) >= least)
    return stored(reached.select("h"), "candidates")


def exact_counts(shards: DataFrame, least: int, words: Bitmap, pairs: Bitmap, triples: Bitmap) -> DataFrame:
    """``lang, w1, w2, w3, a``: phrases that occur ``least`` times; ``w3`` of pairs is null."""
    held = shards.sparkSession.sparkContext.broadcast((words, pairs, triples))

    def count(batches):
        words, pairs, triples = held.value
        for shard, _ in shards_in(batches):
            spelled = pa.array(shard.words, pa.binary()).cast(pa.string())
            for places, counts, bitmap in (
                (*_places(shard.pairs(words)[:3]), pairs), (*_places(shard.triples(words, pairs)), triples),
            ):
                kept = np.flatnonzero(bitmap.may_hold(mixed(*[shard.hashes[p] for p in places])))
                for i in range(0, len(kept), 100_000):
                    part = kept[i : i + 100_000]
                    phrase = pc.binary_join_element_wise(*[spelled.take(pa.array(p[part])) for p in places], " ")
                    yield pa.RecordBatch.from_arrays([pa.array([shard.lang] * len(part), pa.string()), phrase, pa.array(counts[part])], ["lang", "phrase", "a"])

    # No word holds a blank, so the words come back from the phrase.
    rows = shards.mapInArrow(count, "lang string, phrase string, a long")
    summed = rows.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    w = F.split("phrase", " ")
    return stored(summed.select("lang", *[F.get(w, i).alias(f"w{i + 1}") for i in range(3)], "a"), "phrases")


def _places(found: tuple) -> tuple[list, np.ndarray]:
    *places, counts = found
    return places, counts


def strength(left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) without rounding on the way."""
    a = "CAST(a AS DECIMAL(15,0))"
    return F.expr(f"CAST(1000000BD * {a} * {a} AS DECIMAL(38,0)) div CAST(CAST({left} AS DECIMAL(18,0)) * CAST({right} AS DECIMAL(18,0)) AS DECIMAL(38,0))")


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases with ``l, r, score`` of their weakest cut."""

    def frequency(part: str, name: str) -> DataFrame:
        return words.select("lang", F.col("word").alias(part), F.col("f").alias(name))

    pairs, triples = phrases.where("w3 IS NULL"), phrases.where("w3 IS NOT NULL")
    two = pairs.join(frequency("w1", "l"), ["lang", "w1"]).join(frequency("w2", "r"), ["lang", "w2"])
    two = two.select("lang", "w1", "w2", "w3", "a", "l", "r", strength("l", "r").alias("score"))
    head = pairs.select("lang", "w1", "w2", F.col("a").alias("f12"))
    tail = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"))
    three = (
        triples.join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"])
        .join(frequency("w1", "f1"), ["lang", "w1"]).join(frequency("w3", "f3"), ["lang", "w3"])
        .withColumn("s1", strength("f1", "f23")).withColumn("s2", strength("f12", "f3"))
    )
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", "w1", "w2", "w3", "a",
        F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    return two.unionByName(three)


def without_contained(scores: DataFrame, phrases: DataFrame, percent: int) -> DataFrame:
    """Phrases that no longer one holds in ``percent`` of their occurrences."""
    triples = phrases.where("w3 IS NOT NULL")
    inside = triples.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a")
    longest = inside.groupBy("lang", F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2")).agg(F.max("a").alias("held"))
    pairs = scores.where("w3 IS NULL").join(longest, ["lang", "w1", "w2"], "left")
    kept = pairs.where(F.col("held").isNull() | (100 * F.col("held") < percent * F.col("a"))).drop("held")
    return kept.unionByName(scores.where("w3 IS NOT NULL"))


def first_rows(rows: DataFrame, group: str, order: list[Column], spread: Column, k: int) -> DataFrame:
    """The first ``k`` rows of each group with ``rank``, cut in ever fewer slices."""
    slices = -(-rows.count() // RANKED_ROWS)
    while slices > 1:
        by_slice = Window.partitionBy(group, F.pmod(spread, F.lit(slices))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(by_slice)).where(F.col("rank") <= k).drop("rank")
        slices = slices * k // RANKED_ROWS
    last = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(last).cast("long")).where(F.col("rank") <= k)


def collocations(docs: DataFrame, least: int = 10, first: int = 2000, percent: int = 50) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's strongest phrases."""
    shards = write_shards(docs)
    sizes = shards.groupBy("lang").agg(F.sum("words").alias("n"))
    totals = {r.lang: int(r.n) for r in sizes.orderBy(F.desc("n"), "lang").limit(KNOWN_LANGUAGES).collect()}
    words = frequent_words(shards, least)
    word_bits = bitmap_of(words.select("h"))
    pair_bits = bitmap_of(candidate_hashes(shards, totals, least, word_bits))
    triple_bits = bitmap_of(candidate_hashes(shards, totals, least, word_bits, pair_bits))
    phrases = exact_counts(shards, least, word_bits, pair_bits, triple_bits)
    scores = stored(without_contained(scored(phrases, words), phrases, percent), "scored")
    named = scores.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    top = first_rows(named, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], F.xxhash64("phrase"), first)
    if is_small(sizes, BROADCAST_ROWS):
        sizes = F.broadcast(sizes)
    return top.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
