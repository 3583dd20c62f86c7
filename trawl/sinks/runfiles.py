"""Ranked run files: ``qid Q0 docno rank score Exp``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the run format.
SECOND_FIELD = "Q0"
RUN_TAG = "Exp"


def run_line(score: Column) -> Column:
    return F.concat_ws(
        " ",
        F.col("qid").cast("string"), F.lit(SECOND_FIELD), F.col("docno"),
        F.col("rank").cast("string"), score.cast("string"), F.lit(RUN_TAG),
    )


def write_runs(
    ranked: DataFrame, path: str, by: list[str], score: str, mode: str = "overwrite"
) -> None:
    """Write one directory of run lines per value of ``by``, in topic and rank order.

    ``mode="append"`` adds to an existing run instead of replacing it.
    """
    ordered = ranked.repartitionByRange(*by, "qid", "rank").sortWithinPartitions(
        *by, "qid", "rank"
    )
    ordered.select(*by, run_line(F.col(score)).alias("value")).write.partitionBy(
        *by
    ).mode(mode).text(path)
