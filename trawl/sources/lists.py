"""Line-oriented inputs: stop list, topics, relevance judgements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.operators.keyed import keep_last

LINE_ORDER = ["file", "start", "seq"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines with their place, so that "the last one wins" is defined."""
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("seq"),
        )
        .where(F.trim("value") != "")
    )


def read_stop_list(spark: SparkSession, path: str) -> list[str]:
    """The words of a stop list, one per line, case kept.

    They end up as a literal hash set inside expressions: the list is the user's own and
    does not grow with the collection.
    """
    lines = spark.read.option("lineSep", "\n").text(path).where("value <> ''").distinct()
    return sorted(row.value for row in lines.collect())


def read_stop_table(spark: SparkSession, path: str) -> DataFrame:
    """The words of a stop list of any size, one per row in ``word``, case kept.

    Cleaning, analysis and indexing take it in place of a list and join it.
    """
    lines = spark.read.option("lineSep", "\n").text(path).where("value <> ''")
    return lines.select(F.col("value").alias("word")).distinct()


def dropped_topics(spark: SparkSession, path: str) -> DataFrame:
    """Number of lines per file that are no topic: no dot, or no number before it."""
    number = F.trim(F.get(F.split("value", r"\."), F.lit(0))).try_cast("int")
    bad = ~F.contains("value", F.lit(".")) | number.isNull()
    return read_lines(spark, path).where(bad).groupBy("file").agg(F.count("*").alias("dropped"))


def dropped_qrels(spark: SparkSession, path: str) -> DataFrame:
    """Number of lines per file with fewer than four fields, or without numbers."""
    fields = _fields()
    number = F.get(fields, F.lit(0)).try_cast("int").isNull() | F.get(fields, F.lit(3)).try_cast("int").isNull()
    return read_lines(spark, path).where(number).groupBy("file").agg(F.count("*").alias("dropped"))


def _fields():
    return F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """``number.text`` lines; the text ends at the second dot. Not cleaned yet.

    Other lines are left out; ``dropped_topics`` counts them.
    """
    parts = F.split("value", r"\.")
    topics = read_lines(spark, path).select(
        F.trim(F.get(parts, F.lit(0))).try_cast("int").alias("qid"),
        F.get(parts, F.lit(1)).alias("text"),
        *LINE_ORDER,
    )
    return keep_last(topics.where("text IS NOT NULL AND qid IS NOT NULL"), ["qid"], LINE_ORDER)


def read_qrels(spark: SparkSession, path: str) -> DataFrame:
    """``qid unused docno label`` lines, any blanks between; the last label wins.

    The table is long, so it serves lookups by topic and by document alike. Lines of
    another form are left out; ``dropped_qrels`` counts them.
    """
    qrels = read_lines(spark, path).select(_fields().alias("f"), *LINE_ORDER)
    qrels = qrels.where(F.size("f") >= 4).select(
        F.col("f")[0].try_cast("int").alias("qid"),
        F.col("f")[2].alias("docno"),
        F.col("f")[3].try_cast("int").alias("label"),
        *LINE_ORDER,
    ).where("qid IS NOT NULL AND label IS NOT NULL")
    return keep_last(qrels, ["qid", "docno"], LINE_ORDER)
