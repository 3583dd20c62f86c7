"""Near-duplicate vectors by product quantisation, verified by exact cosine.

Coarse inverted lists come from k-means on a bounded sample; each vector's residual to its
list's centre is coded by subspaces. A vector searches its own list and every later list
whose border is no farther than the link radius. A link between two lists crosses their
border, so no link is lost, whatever directions the vectors vary in; it is found from the
earlier list and counts for both ends. Inside a list, distances in a few directions and of
what is left of the vectors in all others bound the true distance from below and leave out
most pairs; of the rest the asymmetric distance, a sum of table look-ups, less the stored
coding error, bounds it again; what may lie within the radius is compared by cosine in
double precision.

The search is exact, so its cost follows the data: vectors without structure lie near most
borders, and the pairs that are compared grow with the square of their number. What is
stored does not: the lists lie once in files of the shared folder, in their order and of
bounded size, and a task takes one file with some later ones and reads them from there.

Equal vectors stand as one with their number; a 128-bit digest tells them apart. A list
that holds most vectors is many files. A task returns link counts and a spanning forest of
its links, never its pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components
link with nothing; vectors of different lengths link with nothing; every row counts as a
vector, also repeated ones; a row with a null id links with nothing and belongs to no
component; an empty table gives an empty result; extra columns are ignored. Lengths of
which there are at most ``per_list`` different vectors are one list each and share a job,
so their number has no limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.llm.common import HASH_SPAN, stored
from trawl.llm.components import components
from trawl.llm.files import new_file, open_random
from trawl.operators.keyed import BROADCAST_ROWS, is_small
from trawl.storage import qualified, scratch_path

LEAST_COSINE = 0.95
# Vectors for each coarse list, the most lists, and sampled vectors for each list.
PER_LIST, MOST_LISTS, SAMPLED = 1000, 4096, 32
SUBSPACE, CODES = 8, 128
# Directions in which all pairs of two lists are compared.
DIRECTIONS = 20
# Vectors of a file at most, and their bytes in double precision; a task reads two at once.
BLOCK, BLOCK_BYTES = 16_384, 16 << 20
# Files that one task compares with another one, and files that a small table is cut into.
RUN, LEAST_FILES = 8, 16
# Pairs compared at once, and candidates whose cosine is taken at once.
COMPARED, RERANKED = 1 << 22, 1 << 16
# Vectors whose list is sought at once.
PLACED = 1024
# Rounding of squared distances, which decides the list of a vector between two centres.
SLACK = 1e-7
# Rounding of sums of squared distances (4 at most) in single precision.
SINGLE_SLACK = 1e-4


@dataclass
class Quantiser:
    """Centres of the lists, for each subspace (a slice) its code words, and orthonormal
    directions of large variance."""

    centres: np.ndarray
    words: list[np.ndarray]
    basis: np.ndarray
    radius: float

    def slices(self) -> list[slice]:
        d = self.centres.shape[1]
        return [slice(a, min(a + SUBSPACE, d)) for a in range(0, d, SUBSPACE)]

    def assign(self, unit: np.ndarray) -> np.ndarray:
        return nearest(unit, self.centres)

    def probes(self, unit: np.ndarray, own: int, later: np.ndarray) -> np.ndarray:
        """Which of the ``later`` lists (columns) each vector of the list ``own`` searches.

        It searches its own list and those whose border is within the radius: the squared
        distances to both centres differ by 2 x apart x the distance to the border.
        """
        border = squared(unit, self.centres[later]) - squared(unit, self.centres[own][None])
        apart = np.sqrt(squared(self.centres[own][None], self.centres[later]))
        return (border <= 2 * apart * self.radius + SLACK) | (later == own)

    def encode(self, unit: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the distance of each vector from what its codes stand for."""
        rest = unit - self.centres[lists]
        codes, error = np.empty((len(unit), len(self.words)), dtype=np.uint8), np.zeros(len(unit))
        for m, part in enumerate(self.slices()):
            gaps = squared(rest[:, part], self.words[m])
            codes[:, m] = gaps.argmin(axis=1)
            error += gaps[np.arange(len(unit)), codes[:, m]]
        return codes, np.sqrt(np.maximum(error, 0))

    def shadow(self, unit: np.ndarray) -> np.ndarray:
        """Coordinates in the basis and the length of what is left; distances of shadows
        are no larger than those of the vectors."""
        inside = unit @ self.basis
        left = np.sqrt(np.maximum((unit * unit).sum(1) - (inside * inside).sum(1), 0))
        return np.column_stack([inside, left]).astype(np.float32)

    def near(self, unit: np.ndarray, row: np.ndarray, which: int, codes: np.ndarray, error: np.ndarray) -> np.ndarray:
        """Which pairs may lie within the radius: of a query, named by its ``row``, and a
        coded vector of the list ``which``.

        Asymmetric distances in single precision; what that may lose is added to the reach.
        """
        rest, total = unit - self.centres[which], np.zeros(len(row), dtype=np.float32)
        for m, part in enumerate(self.slices()):
            total += squared(rest[:, part], self.words[m]).astype(np.float32)[row, codes[:, m]]
        return total <= ((self.radius + error) ** 2 + SINGLE_SLACK).astype(np.float32)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0)


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    parts = [squared(rows[at : at + PLACED], centres).argmin(axis=1) for at in range(0, len(rows), PLACED)]
    return np.concatenate([np.zeros(0, dtype=np.int64), *parts])


def k_means(rows: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = rows[rng.permutation(len(rows))[:k]].copy()
    for _ in range(rounds):
        near = nearest(rows, centres)
        sums, counts = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(sums, near, rows)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def directions(rows: np.ndarray, seed: int) -> np.ndarray:
    """Orthonormal columns near the directions in which ``rows`` vary most."""
    rest = rows - rows.mean(axis=0)
    start = np.random.default_rng(seed).normal(size=(rows.shape[1], min(DIRECTIONS, rows.shape[1])))
    return np.linalg.qr(rest.T @ (rest @ start) + 1e-9 * start)[0]


def train(sample: np.ndarray, lists: int, least: float = LEAST_COSINE, seed: int = 11) -> Quantiser:
    centres = k_means(sample, min(lists, len(sample)), seed)
    rest = sample - centres[nearest(sample, centres)]
    model = Quantiser(centres, [], directions(sample, seed), float(np.sqrt(2 - 2 * least)))
    model.words = [k_means(rest[:, part], min(CODES, len(rest)), seed + 1 + m) for m, part in enumerate(model.slices())]
    return model


def as_units(vectors: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    rows = np.frombuffer(b"".join(vectors.to_pylist()), dtype=kind).reshape(len(vectors), -1).astype("<f8")
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def forest(left: np.ndarray, right: np.ndarray, nodes: int) -> np.ndarray:
    """Smallest node reachable from each node by the links left-right."""
    label = np.arange(nodes)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _packed(kind: str):
    """Packs valid vectors as their components' bytes; others become null."""
    wanted = pa.float32() if kind == "<f4" else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            offsets = lists.offsets.to_numpy()
            values = lists.values.cast(wanted).fill_null(float("nan")).to_numpy().astype(kind) + np.dtype(kind).type(0)
            odd, some = (np.concatenate([[0], np.cumsum(x)]) for x in (~np.isfinite(values), values != 0))
            start, end = offsets[:-1], offsets[1:]
            valid = (odd[start] == odd[end]) & (some[start] < some[end]) & lists.is_valid().to_numpy(zero_copy_only=False)
            bits = pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
            places = pa.py_buffer((offsets * np.dtype(kind).itemsize).astype("<i4").tobytes())
            packed = pa.Array.from_buffers(pa.binary(), len(lists), [bits, places, pa.py_buffer(values.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("id"), packed], ["id", "vector"])

    return run


@dataclass
class Block:
    """Vectors of some lists, one list after the other."""

    lists: np.ndarray
    ids: np.ndarray
    number: np.ndarray
    unit: np.ndarray
    codes: np.ndarray
    error: np.ndarray
    shadow: np.ndarray
    links: np.ndarray = field(init=False)
    present: np.ndarray = field(init=False)
    ends: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.links = np.zeros(len(self.ids), dtype=np.int64)
        self.present, starts = np.unique(self.lists, return_index=True)
        self.ends = np.append(starts, len(self.lists))

    def parts(self) -> Iterator[tuple[int, int, int]]:
        """Every list with its first row and the one after its last."""
        return zip(self.present.tolist(), self.ends[:-1].tolist(), self.ends[1:].tolist())

    @classmethod
    def of(cls, model: Quantiser, kind: str, rows: pa.Table) -> Block:
        """From columns ``list``, ``id``, ``number``, ``vector``, and codes if there are."""
        unit, lists = as_units(rows.column("vector"), kind), rows.column("list").to_numpy()
        if "codes" in rows.column_names:
            codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), dtype=np.uint8).reshape(len(rows), -1)
            error = rows.column("error").to_numpy()
        else:
            codes, error = model.encode(unit, lists)
        return cls(lists, rows.column("id").to_numpy(), rows.column("number").to_numpy(), unit, codes, error, model.shadow(unit))


def _pairs(model: Quantiser, least: float, left: Block, right: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked rows of two blocks, or of one with itself, each pair once; a list of the
    right block is never earlier than one of the left."""
    reach = np.float32(model.radius**2 + SINGLE_SLACK)
    asking, held = (x.shadow for x in (left, right))
    squares = (held * held).sum(1)
    # A product of these rows is the squared distance less that of the asking one.
    held = np.column_stack([-2 * held, squares])
    asking, bars = np.column_stack([asking, np.ones(len(asking), np.float32)]), reach - (asking * asking).sum(1)
    for own, first, last in left.parts():
        later = [x for x in right.parts() if x[0] >= own]
        if not later:
            continue
        probes = model.probes(left.unit[first:last], own, np.array([x[0] for x in later]))
        for n, (which, begin, end) in enumerate(later):
            asked = first + np.flatnonzero(probes[:, n])
            step = max(1, COMPARED // (end - begin))
            for at in range(0, len(asked), step):
                some = asked[at : at + step]
                close = np.flatnonzero((asking[some] @ held[begin:end].T <= bars[some][:, None]).ravel())
                i, j = some[close // (end - begin)], begin + close % (end - begin)
                if left is right and which == own:
                    i, j = i[i < j], j[i < j]
                for k in range(0, len(i), RERANKED):
                    one, two = i[k : k + RERANKED], j[k : k + RERANKED]
                    rows, row = np.unique(one, return_inverse=True)
                    may = model.near(left.unit[rows], row, which, right.codes[two], right.error[two])
                    one, two = one[may], two[may]
                    linked = np.einsum("ij,ij->i", left.unit[one], right.unit[two]) >= least
                    if linked.any():
                        yield one[linked], two[linked]


def _search(model: Quantiser, least: float, left: Block, right: Block) -> tuple[np.ndarray, np.ndarray]:
    """Counts the links of both blocks; ids that a spanning forest of these links joins."""
    same = left is right
    ids = left.ids if same else np.concatenate([left.ids, right.ids])
    label = np.arange(len(ids))
    for i, j in _pairs(model, least, left, right):
        np.add.at(left.links, i, right.number[j])
        np.add.at(right.links, j, left.number[i])
        a, b = label[i], label[j if same else j + len(left.ids)]
        if (a != b).any():
            label = forest(a, b, len(ids))[label]
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return ids[moved], ids[label[moved]]


FOUND = "a long, b long, links long"


def _found(block: Block | None, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """Link counts of a block and joined ids as rows."""
    some = np.flatnonzero(block.links) if block else np.zeros(0, dtype=np.int64)
    ids, links = (block.ids[some], block.links[some]) if block else (some, some)
    return pa.table({
        "a": pa.array(np.concatenate([ids, a])), "b": pa.concat_arrays([pa.nulls(len(ids), pa.int64()), pa.array(b)]),
        "links": pa.concat_arrays([pa.array(links), pa.nulls(len(a), pa.int64())]),
    })


def _linked_inside(least: float, kind: str):
    """Link counts and forest links of all vectors of one length, as one list."""

    def run(table: pa.Table) -> pa.Table:
        model = train(as_units(table.column("vector"), kind), 1, least)
        block = Block.of(model, kind, table.append_column("list", pa.array(np.zeros(len(table), dtype=np.int32))).sort_by("id"))
        return _found(block, *_search(model, least, block, block))

    return run


def _counted(model: Quantiser, kind: str):
    """How many vectors of each list a task has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(model.centres), dtype=np.int64)
        for batch in batches:
            held += np.bincount(model.assign(as_units(batch.column("vector"), kind)), minlength=len(held))
        lists = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), pa.array(held[lists])], ["list", "n"])

    return run


def _dealt(model: Quantiser, kind: str, starts: np.ndarray, pieces: np.ndarray):
    """Vectors with their list and their file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = model.assign(as_units(batch.column("vector"), kind)) if batch.num_rows else np.zeros(0, dtype=np.int64)
            file = starts[lists] + batch.column("place").to_numpy() % pieces[lists]
            yield pa.RecordBatch.from_arrays(
                [pa.array(file, pa.int64()), pa.array(lists, pa.int32()), *(batch.column(c) for c in ("id", "number", "vector"))],
                ["file", "list", "id", "number", "vector"])

    return run


def _write(model: Quantiser, kind: str, folder: str):
    """One file of the index, with codes."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["list", "id", "number", "vector"]).sort_by([("list", "ascending"), ("id", "ascending")])
        codes, error = model.encode(as_units(rows.column("vector"), kind), rows.column("list").to_numpy())
        rows = rows.append_column("codes", pa.array([c.tobytes() for c in codes], pa.binary())).append_column("error", pa.array(error))
        file = table.column("file")[0].as_py()
        with new_file(folder, f"{file}.arrow") as out, pa.ipc.new_file(out, rows.schema) as writer:
            writer.write_table(rows)
        return pa.table({"file": pa.array([file], pa.int64())})

    return run


def _compare(model: Quantiser, kind: str, least: float, folder: str, files: np.ndarray):
    """Searches of one file in itself or some of the following ones."""

    def read(n: int) -> Block:
        with open_random(f"{folder}/{files[n]}.arrow") as source:
            return Block.of(model, kind, pa.ipc.open_file(source).read_all())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, begin, end in zip(*(batch.column(c).to_pylist() for c in ("one", "begin", "end"))):
                left = read(one)
                for n in range(begin, end):
                    right = left if n == one else read(n)
                    joined = _search(model, least, left, right)
                    yield from _found(None if right is left else right, *joined).to_batches()
                yield from _found(left, left.ids[:0], left.ids[:0]).to_batches()

    return run


def _linked(classes: DataFrame, count: int, least: float, per_list: int, block: int, kind: str) -> DataFrame:
    """Link counts (a, links) and forest links (a, b) between different vectors of one length."""
    spark = classes.sparkSession
    lists = max(1, min(MOST_LISTS, -(-count // per_list)))
    wanted = max(4096, SAMPLED * lists)
    place = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(HASH_SPAN))
    sample = classes.where(place <= F.lit(int(min(1.0, wanted / count) * HASH_SPAN))).orderBy("id").select("vector").collect()
    if not sample:
        sample = classes.orderBy("id").select("vector").limit(1).collect()
    units = as_units(pa.array([bytes(r.vector) for r in sample], pa.binary()), kind)
    model = train(units, lists, least)
    # As many rows as there are lists, of which there are MOST_LISTS at most.
    sizes = np.zeros(len(model.centres), dtype=np.int64)
    for r in classes.select("vector").mapInArrow(_counted(model, kind), "list int, n long").groupBy("list").agg(F.sum("n").alias("n")).collect():
        sizes[r.list] = r.n
    most = max(1, min(block, -(-count // LEAST_FILES), BLOCK_BYTES // (8 * units.shape[1])))
    starts, pieces = cut(sizes, most)
    folder = qualified(spark, scratch_path(spark, "lists"))
    dealt = classes.withColumn("place", F.pmod(F.xxhash64("id", F.lit("file")), F.lit(HASH_SPAN))).mapInArrow(
        _dealt(model, kind, starts, pieces), "file long, list int, id long, number long, vector binary")
    written = dealt.groupBy("file").applyInArrow(_write(model, kind, folder), "file long").collect()
    files = np.sort(np.array([r.file for r in written], dtype=np.int64))
    n = len(files)
    cores = spark.sparkContext.defaultParallelism
    run = max(1, min(RUN, n * (n + 1) // 2 // (8 * cores)))
    runs = spark.range(n).select(F.col("id").alias("one"), F.explode(F.sequence("id", F.lit(n - 1).cast("long"), F.lit(run).cast("long"))).alias("begin"))
    runs = runs.withColumn("end", F.least(F.col("begin") + run, F.lit(n).cast("long")))
    tasks = max(1, min(n * (n // run + 2) // 2, max(8 * cores, n * n // (2 * run * 4))))
    return runs.repartition(tasks).mapInArrow(_compare(model, kind, least, folder, files), FOUND)


def cut(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each list its first file and over how many it is spread. Files hold ``most``
    vectors: some whole lists that follow each other, or pieces of one."""
    starts, pieces = np.zeros(len(sizes), dtype=np.int64), np.maximum(1, -(-sizes // most))
    file, held = 0, 0
    for n, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            file, held = file + 1, 0
        starts[n] = file
        if pieces[n] > 1:
            file, held = file + int(pieces[n]), 0
        else:
            held += size
    return starts, pieces


def link_vectors(
    rows: DataFrame, key: str = "vec_id", vector_col: str = "embedding", least: float = LEAST_COSINE,
    per_list: int = PER_LIST, block: int = BLOCK,
) -> DataFrame:
    """One row per vector: ``key``, ``n_links``, ``component_id`` and ``kept``."""
    named = rows.select(F.col(key).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    given = named.where(F.col("id").isNotNull())
    kind = "<f4" if given.schema["vector"].dataType.elementType == T.FloatType() else "<f8"
    digest = F.substring(F.unhex(F.sha2("vector", 256)), 1, 16)
    packed = stored(
        given.mapInArrow(_packed(kind), "id long, vector binary").select(
            "id", F.monotonically_increasing_id().alias("row"), digest.alias("digest"), "vector"), "vectors")
    valid = packed.where(F.col("vector").isNotNull())
    classes = stored(
        valid.select("id", "row", "digest", F.length("vector").alias("width")).groupBy("digest").agg(
            F.min("id").alias("first"), F.min("row").alias("chosen"), F.count("*").alias("number"), F.max("width").alias("width")), "classes")
    counts = {r.width: r["count"] for r in classes.groupBy("width").count().where(F.col("count") > per_list).collect()}
    # Of equal vectors one row goes on. A common vector meets its class in place, or by a
    # shuffle whose hot keys Spark may split, as both sides are plain.
    repeated = classes.where("number > 1").select("digest", "first", "chosen", "number")
    repeated = F.broadcast(repeated) if is_small(repeated, BROADCAST_ROWS) else repeated
    known = [F.coalesce("first", "id").alias("id"), F.coalesce("number", F.lit(1)).alias("number")]
    different = valid.join(repeated, "digest", "left").where("chosen IS NULL OR chosen = row").select(*known, "vector")
    others = different.where(~F.length("vector").isin(list(counts))) if counts else different
    found = others.groupBy(F.length("vector")).applyInArrow(_linked_inside(least, kind), FOUND)
    for n, count in sorted(counts.items()):
        found = found.unionByName(_linked(different.where(F.length("vector") == n), count, least, per_list, block, kind))
    found = stored(found, "links")
    degrees = found.where(F.col("links").isNotNull()).groupBy("a").agg(F.sum("links").alias("links"))
    tops = components(found.where(F.col("b").isNotNull()).select("a", "b"))
    linked = stored(degrees.select(F.col("a").alias("first"), "links").join(tops.withColumnRenamed("node", "first"), "first"), "linked")
    members = valid.select("id", "digest").join(repeated, "digest", "left").select(
        F.col("id").alias("own"), *known).withColumnRenamed("id", "first").join(linked, "first", "left").select(
        F.col("own").alias("id"), (F.coalesce("links", F.lit(0)) + F.col("number") - 1).alias("n_links"), F.coalesce("component", "first").alias("component_id"))
    alone = packed.where(F.col("vector").isNull()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    nameless = named.where(F.col("id").isNull()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return members.unionByName(alone).unionByName(nameless).select(
        F.col("id").alias(key), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
