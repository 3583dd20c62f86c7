"""Packing token sequences into windows by Karmarkar-Karp multiway differencing.

A document's ids (with its end id) are cut into whole windows and a rest; the rest is cut
into pieces of at most ``cut`` ids. The pieces of a bounded group of documents are dealt
to k windows by differencing: partial partitions wait in a heap by imbalance, and the two
most unbalanced are merged with their sums opposed, largest on smallest. That leaves
near-equal windows. k starts at the least possible number and rises while the fullest
window exceeds the capacity.

Tasks pack what they read, so nothing is shuffled. A group closes once it has ``group``
rests and the ids of ``FULL_WINDOWS`` windows, so short texts do not close it half empty; a
rest has an id at least, which bounds the rests of a group.

Defined cases: null text is empty and gives its end id alone; repeated rows are packed as
often as they occur; an empty table gives no pieces; rows with a null id are packed under
that id; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.tokens import blocks, encoder_for

CAPACITY = 2048
# Sequences of one task are numbered from its partition's number times this.
TASK_SPAN = 1 << 40
# Windows' worth of ids that a group has at least before it is dealt.
FULL_WINDOWS = 64


def difference_partition(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of ``sizes`` dealt to ``k`` windows by largest differencing.

    A partial partition lists its non-empty windows as (sum, members), largest first; the
    others are empty, so its imbalance is its largest sum while any is empty.
    """
    heap = [(-size, i, [(size, [i])]) for i, size in enumerate(sizes)]
    if k == 1 or not heap:
        return [list(range(len(sizes)))][: len(sizes) or None] if heap else []
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        one, two = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        free = k - len(two)
        merged = one[:free]
        for i in range(free, k):
            total, members = two[k - 1 - i]
            if i < len(one):
                total, members = total + one[i][0], one[i][1] + members
            merged.append((total, members))
        merged.sort(key=lambda w: (-w[0], w[1][0]))
        gap = merged[0][0] - (merged[-1][0] if len(merged) == k else 0)
        heapq.heappush(heap, (-gap, tie, merged))
        tie += 1
    return [members for _, members in heap[0][2]]


def windows_for(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of at most ``capacity``; their number rises until the fullest one fits."""
    if not sizes:
        return []
    if max(sizes) > capacity:
        raise ValueError("a piece exceeds the capacity")
    k = -(-sum(sizes) // capacity)
    while True:
        dealt = difference_partition(sizes, k)
        if max(sum(sizes[i] for i in window) for window in dealt) <= capacity:
            return dealt
        k += max(1, k // 200)


class Packer:
    """Pieces of a stream of documents; the group of waiting rests is bounded."""

    def __init__(self, capacity: int, cut: int, group: int, first_sequence: int) -> None:
        self.capacity, self.cut, self.group = capacity, cut, group
        self.sequence = first_sequence
        self.waiting: list[tuple] = []
        self.documents = self.held = 0

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            yield doc, start, ids[start : start + self.capacity], len(ids), self.sequence, 0
            self.sequence += 1
        for start in range(whole, len(ids), self.cut):
            self.waiting.append((doc, start, ids[start : start + self.cut], len(ids)))
        self.documents += whole < len(ids)
        self.held += len(ids) - whole
        if self.documents >= self.group and self.held >= FULL_WINDOWS * self.capacity:
            yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        sizes = [len(piece[2]) for piece in self.waiting]
        for window in windows_for(sizes, self.capacity):
            offset = 0
            for i in sorted(window):
                doc, start, ids, total = self.waiting[i]
                yield doc, start, ids, total, self.sequence, offset
                offset += len(ids)
            self.sequence += 1
        self.waiting, self.documents, self.held = [], 0, 0


def pack(
    docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = 1, cut: int = 512, group: int = 256,
) -> DataFrame:
    """One row per piece: ``key``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``,
    ``offset`` and ``ids`` (unsigned little-endian four-byte ids).

    Sequences hold at most ``capacity`` ids and are to be padded to it by the reader.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text_col).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, key_type = encoder_for(tokenizer_path), None
        packer = Packer(capacity, cut, group, TaskContext.get().partitionId() * TASK_SPAN)

        def batch_of(pieces: list[tuple]) -> pa.RecordBatch:
            docs_, starts, ids, totals, sequences, offsets = zip(*pieces)
            numbers = [pa.array(x, pa.int64()) for x in (starts, [len(i) for i in ids], totals, sequences, offsets)]
            packed = pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(docs_, key_type), *numbers, packed], NAMES)

        for batch in batches:
            key_type = batch.schema.field("key").type
            keys = batch.column("key").to_pylist()
            for first, texts in blocks(batch.column("text").to_pylist()):
                pieces = []
                for i, data in enumerate(encoder.encode(texts)):
                    ids = np.append(np.frombuffer(data, dtype=encoder.dtype), np.array(end_id, dtype=encoder.dtype))
                    pieces.extend(packer.add(keys[first + i], ids))
                if pieces:
                    yield batch_of(pieces)
        if packer.waiting:
            yield batch_of(list(packer.flush()))

    schema = f"key {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


NAMES = ["key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
