"""Tagged document collections.

A collection file holds many blocks::

    <DOC>
    <DOCNO> AP890101-0001 </DOCNO>
    <TEXT>
    ...
    </TEXT>
    </DOC>

The reader uses the closing tag as record separator, so a file is split across tasks
like any text file however large it is, and no row ever holds more than one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.operators.keyed import BROADCAST_ROWS, is_small

BLOCK_END = "\n</DOC>"

# The tags are recognised at the start of a line only; the document id is
# the 13 characters from column 8 of its line.
DOCNO_LINE = r"(?md)^<DOCNO>.(.{1,13})"
TEXT_SECTION = r"(?mds)^<TEXT>[^\n]*\n(.*?)(?:^</TEXT>|\z)"

# File names of compressed collections, whose size says nothing about their text.
COMPRESSED = r"\.(gz|gzip|bz2|deflate|lz4|snappy|zst)$"
BOM_BYTES = 3

POSITION = ["file", "start", "seq"]


def block_docno(block: Column) -> Column:
    ids = F.regexp_extract_all(block, F.lit(DOCNO_LINE), F.lit(1))
    return F.try_element_at(ids, F.lit(-1))


def block_text(block: Column) -> Column:
    """All TEXT sections of a block in order, newlines turned into blanks."""
    sections = F.regexp_extract_all(block, F.lit(TEXT_SECTION), F.lit(1))
    return F.translate(F.array_join(sections, ""), "\n", " ")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """One row per block, with its place in the collection.

    ``seq`` depends on how files are split into tasks, so write the result once before
    using it more than once.
    """
    raw = spark.read.option("lineSep", BLOCK_END).text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("_metadata.file_size").alias("file_size"),
        F.octet_length("value").cast("long").alias("n_bytes"),
        (F.trim(F.translate("value", "\r\n\t", "   ")) == "").alias("blank"),
        block_docno(F.col("value")).alias("docno"),
        block_text(F.col("value")).alias("text"),
    )


def unclosed_tails(blocks: DataFrame, path: str) -> DataFrame:
    """Places of file-final blocks with an id that no closing tag follows.

    Most files end in blank lines after a closing tag, and their last row has no id. Of
    the others, a plain file tells by its size: the separators are not part of the rows,
    so one whose every block is closed is exactly one separator per row longer than its
    rows, and one with an open tail is one separator shorter than that; a byte-order mark
    is taken off before a row is made. Any other file (a compressed one) is asked for its
    last line: the files concerned are read once more.
    """
    splits = blocks.groupBy("file", "start").agg(
        F.max(F.struct("seq", F.col("docno").isNotNull().alias("has_id"))).alias("end"),
        F.sum("n_bytes").alias("n_bytes"),
        F.count("*").alias("n_rows"),
        F.max("file_size").alias("file_size"),
    )
    files = splits.groupBy("file").agg(
        F.max(F.struct("start", "end.seq", "end.has_id")).alias("last"),
        (
            F.sum("n_bytes") + F.sum("n_rows") * len(BLOCK_END) - F.max("file_size")
        ).alias("excess"),
    )
    ends = files.where("last.has_id").select("file", "last.start", "last.seq", "excess")
    packed = F.lower("file").rlike(COMPRESSED) | ~F.col("excess").isin([e - b for e in (0, len(BLOCK_END)) for b in (0, BOM_BYTES)])
    ends = ends.withColumn("packed", packed)
    open_by_size = ends.where(~F.col("packed") & (F.col("excess") > 0))
    asked = [r.file for r in ends.where("packed").select("file").collect()]  # names that the driver has listed before
    if not asked:
        return open_by_size.select("file", "start", "seq")
    lines = blocks.sparkSession.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("seq"), F.rtrim(F.translate("value", "\r", "")).alias("line"),
    ).where(F.col("_metadata.file_path").isin(asked) & (F.col("line") != ""))
    final = lines.groupBy("file").agg(F.max_by("line", F.struct("start", "seq")).alias("line"))
    open_by_line = ends.where("packed").join(final.where(F.col("line") != BLOCK_END.strip()).select("file"), "file", "left_semi")
    return open_by_size.unionByName(open_by_line).select("file", "start", "seq")


def keep_documents(blocks: DataFrame, path: str) -> DataFrame:
    """The closed blocks of the collection at ``path`` that carry an id, the last one of
    each id.

    "Last" is by file path, then by place in the file. Decisions are taken on the
    narrow place and id columns only. Repeated ids are normally few and are broadcast
    against the blocks after a count; when they are not, the winners are matched by
    their place, which is unique per row, so that an id with very many copies does not
    gather in one task.
    """
    tails = unclosed_tails(blocks, path)
    if is_small(tails, BROADCAST_ROWS):
        tails = F.broadcast(tails)
    closed = blocks.where("docno IS NOT NULL").join(tails, POSITION, "left_anti")
    last = F.max(F.struct(*POSITION)).alias("last")
    by_id = closed.groupBy("docno").agg(last, F.count("*").alias("copies"))
    contested = by_id.where("copies > 1").select("docno", "last")
    if is_small(contested, BROADCAST_ROWS):
        kept = closed.join(F.broadcast(contested), "docno", "left").where(
            F.col("last").isNull() | (F.col("last") == F.struct(*POSITION))
        )
    else:
        kept = closed.join(by_id.select("last.*"), POSITION, "left_semi")
    return kept.select("docno", "text")


def blocks_without_id(blocks: DataFrame) -> DataFrame:
    """Number of non-blank blocks dropped for want of an id, per file."""
    return (
        blocks.where("docno IS NULL AND NOT blank")
        .groupBy("file")
        .agg(F.count("*").alias("dropped"))
    )
