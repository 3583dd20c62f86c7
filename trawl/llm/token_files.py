"""Token ids in Arrow files: fixed-size lists of equal length with masks.

The ids of all documents, in ascending order of their id, form one stream. Each shard is
an Arrow file whose record batches hold ``ids`` and ``mask`` as fixed-size lists of
``row_length``; only the last row of a shard is filled up, with mask false. So sequence i
of a shard is found by arithmetic and read without a copy. A second small Arrow file lists
the shard's documents with their first id and number of ids.

Shards are ranges of the document id, so their order is the order of the stream; tasks
write them, and the driver sees one row per shard.

Defined cases: null text is empty and gives the end id alone; repeated ids are ordered by
text; null ids come first; an empty table gives no shard; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm.common import parts_of
from trawl.llm.files import new_file, open_random
from trawl.llm.tokens import blocks, encoder_for

ROW_LENGTH = 2048
ROWS_PER_BATCH = 128
DOCS_PER_SHARD = 10_000


class ShardWriter:
    """Writes a stream of ids as rows of equal length, a bounded buffer at a time."""

    def __init__(self, out, dtype: np.dtype, row_length: int) -> None:
        self.length, self.dtype = row_length, dtype
        value = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(value, row_length)), ("mask", pa.list_(pa.bool_(), row_length))])
        self.writer = pa.ipc.new_file(out, self.schema)
        self.waiting: list[bytes] = []
        self.held = 0
        self.written = 0

    def add(self, data: bytes) -> None:
        self.waiting.append(data)
        self.held += len(data)
        if self.held >= ROWS_PER_BATCH * self.length * self.dtype.itemsize:
            self._write(last=False)

    def _write(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), dtype=self.dtype)
        per_batch = ROWS_PER_BATCH * self.length
        whole = len(ids) if last else len(ids) // per_batch * per_batch
        for at in range(0, whole, per_batch):
            part = ids[at : min(at + per_batch, whole)]
            rows = -(-len(part) // self.length)
            full = np.zeros(rows * self.length, dtype=self.dtype)
            full[: len(part)] = part
            mask = np.arange(len(full)) < len(part)
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (full, mask)]
            self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.written += whole
        self.waiting = [ids[whole:].tobytes()]
        self.held = len(self.waiting[0])

    def close(self) -> None:
        self._write(last=True)
        self.writer.close()


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, key: str = "doc_id", text_col: str = "text",
    end_id: int = 2, row_length: int = ROW_LENGTH,
) -> list[tuple[int, int, int]]:
    """Write the shards; returns (shard, documents, ids) of each, in order."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = parts_of(docs.sparkSession, docs.count(), DOCS_PER_SHARD)
    # The text's hash lets copies of one id fall into several ranges.
    ranged = rows.withColumn("place", F.xxhash64("text")).repartitionByRange(parts, "key", "place").sortWithinPartitions("key", "place", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        while first is not None and not first.num_rows:
            first = next(batches, None)
        if first is None:
            return
        encoder, shard = encoder_for(tokenizer_path), TaskContext.get().partitionId()
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        keys, sizes = [], []
        with new_file(folder, f"part-{shard:06d}.arrow") as out:
            writer = ShardWriter(out, encoder.dtype, row_length)
            batch = first
            while batch is not None:
                keys.append(batch.column("key"))
                for _, texts in blocks(batch.column("text").to_pylist()):
                    for data in encoder.encode(texts):
                        writer.add(data + end)
                        sizes.append(len(data) // encoder.dtype.itemsize + 1)
                batch = next(batches, None)
            writer.close()
        lengths = np.array(sizes, dtype=np.int64)
        index = pa.table({"key": pa.chunked_array(keys), "start": np.cumsum(lengths) - lengths, "length": lengths})
        with new_file(folder, f"part-{shard:06d}.docs.arrow") as out, pa.ipc.new_file(out, index.schema) as table:
            table.write_table(index)
        yield pa.RecordBatch.from_pydict({"shard": [shard], "docs": [len(sizes)], "ids": [int(lengths.sum())]})

    made = ranged.select("key", "text").mapInArrow(run, "shard long, docs long, ids long").collect()
    return sorted((r.shard, r.docs, r.ids) for r in made)


class ShardReader:
    """Random access to the rows and the id stream of one shard."""

    def __init__(self, folder: str, shard: int) -> None:
        self.file = pa.ipc.open_file(open_random(f"{folder}/part-{shard:06d}.arrow"))
        self.length = self.file.schema.field("ids").type.list_size
        self.at, self.batch = -1, None

    def sequence(self, row: int) -> tuple[np.ndarray, pa.Array]:
        """Ids of a row as a view of the file, and its mask."""
        batch = self._batch(row // ROWS_PER_BATCH)
        place = row % ROWS_PER_BATCH
        ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
        return ids[place * self.length : (place + 1) * self.length], batch.column("mask")[place]

    def _batch(self, i: int) -> pa.RecordBatch:
        if i != self.at:
            self.at, self.batch = i, self.file.get_batch(i)
        return self.batch

    def span(self, start: int, length: int) -> np.ndarray:
        """Ids start .. start + length of the shard's stream."""
        per_batch, parts, end = ROWS_PER_BATCH * self.length, [], start + length
        while start < end:
            ids = self._batch(start // per_batch).column("ids").flatten().to_numpy(zero_copy_only=True)
            part = ids[start % per_batch : min(end - start // per_batch * per_batch, per_batch)]
            parts.append(part)
            start += len(part)
        return np.concatenate(parts) if len(parts) != 1 else parts[0]


def read_token_files(
    spark: SparkSession, folder: str, shards: list[tuple[int, int, int]], key: str = "doc_id", key_type: str = "long",
) -> DataFrame:
    """One row per document: ``key``, ``start`` in the whole stream, ``n_tokens``, ``ids``.

    ``ids`` are unsigned little-endian four-byte ids, read from the files.
    """
    before, rows = 0, []
    for shard, _, ids in shards:
        rows.append((shard, before))
        before += ids
    schema = f"key {key_type}, start long, n_tokens long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, base in zip(batch.column("shard").to_pylist(), batch.column("base").to_pylist()):
                reader = ShardReader(folder, shard)
                index = pa.ipc.open_file(open_random(f"{folder}/part-{shard:06d}.docs.arrow")).read_all()
                for part in index.to_batches(max_chunksize=512):
                    starts, lengths = part.column("start").to_pylist(), part.column("length").to_pylist()
                    ids = [reader.span(s, n).astype("<u4").tobytes() for s, n in zip(starts, lengths)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("key"), pa.array([base + s for s in starts], pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())],
                        ["key", "start", "n_tokens", "ids"])

    listed = spark.createDataFrame(rows, "shard long, base long").repartition(max(1, len(rows)))
    return listed.mapInArrow(run, schema).withColumnRenamed("key", key)
