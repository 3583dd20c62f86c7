"""Small keyed-table helpers shared by readers and jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Most rows of a narrow table that are sent to every executor, about 100 MB there.
BROADCAST_ROWS = 1_000_000


def is_small(df: DataFrame, max_rows: int) -> bool:
    """Count ``df`` to decide whether it may be broadcast."""
    return df.count() <= max_rows


def parts_for(spark: SparkSession, rows: int, rows_per_part: int) -> int:
    """Enough parts for their size, and at least one for each core."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_part))


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in ``order``.

    An aggregate rather than a window: copies of a key are reduced before the shuffle,
    so a key with very many copies costs one row per task.
    """
    values = [c for c in df.columns if c not in keys and c not in order]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), F.struct(*order)).alias("__last"))
        .select(*keys, "__last.*")
    )
