"""Reading, sampling and scratch tables that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.storage import scratch_path

HASH_SPAN = 1 << 62
# Texts of a batch that are Python strings at once.
HELD_TEXTS = 128


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only_null_free(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def ascii_lower(value: Column) -> Column:
    """Lower-case A-Z alone; ``lower`` would also change other scripts."""
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(key: str, folds: int) -> Column:
    """Fold of a row: crc32 of its id written as text, modulo ``folds``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    It cuts lineage: a lost executor costs its running tasks, not earlier stages.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, key: str, group: str, per_group: int) -> DataFrame:
    """About ``per_group`` rows of each group, chosen by a hash of ``key``.

    The threshold follows the counted size of the group, so no sort and no shuffle is
    needed and the sample is the same whatever the partitioning. Groups are labels, of
    which there are few; more than 1000 is an error.
    """
    counts = df.groupBy(group).count().limit(1001).collect()
    if len(counts) > 1000:
        raise ValueError(f"{group} has over 1000 values; it is no label")
    place = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(HASH_SPAN))
    keep = F.lit(False)
    for row in counts:
        if row[group] is not None:
            share = min(1.0, per_group / row["count"])
            keep = keep | ((F.col(group) == F.lit(row[group])) & (place <= F.lit(int(share * HASH_SPAN))))
    return df.where(keep)


def texts_of(texts: pa.Array) -> Iterator[str | None]:
    """The texts of an Arrow batch, of which only some are copied out of it at once."""
    for at in range(0, len(texts), HELD_TEXTS):
        yield from texts.slice(at, HELD_TEXTS).to_pylist()


def parts_of(spark: SparkSession, rows: int, rows_per_part: int) -> int:
    """Enough parts for their size, and no fewer than the session's shuffles use."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_part))
