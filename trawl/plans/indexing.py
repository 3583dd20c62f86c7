"""Index a collection: documents, postings, term statistics, collection statistics.

Layout. Documents and postings are hash-bucketed by document id into the same number of
buckets, postings sorted by term inside each file. The documents' text is shuffled once,
when it is written; everything keyed by document afterwards (postings, scores per topic
and document, joins with document lengths) reads the buckets and needs no exchange. The
only other shuffle is the per-term aggregate, which is reduced in each task first.

Updates. An update writes a segment: its documents and postings in the same buckets, the
ids that it replaces, and the changes of the term statistics. The earlier tables stay as
they are and are read with the replaced ids left out; a union of tables bucketed alike
needs no exchange either. Once segments are many or large, an update writes one whole
index instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl import schemas
from trawl.functions.scoring import Collection
from trawl.operators.keyed import BROADCAST_ROWS, is_small, keep_last, parts_for
from trawl.operators.postings import (
    StopWords,
    build_postings,
    clean_documents,
    exact_vocabulary,
    length_statistics,
    term_statistics,
)
from trawl.sources.corpus import keep_documents, read_blocks
from trawl.storage import bucket_by_bucket, drop_tables, open_bucketed, scratch_path, write_bucketed

# A bucket is one task: its tokens, and its documents times the topics, are grouped in memory.
DOCUMENTS_PER_BUCKET = 10_000
BYTES_PER_BUCKET = 16 << 20
# An update merges all segments beyond so many, or if it replaces or adds this share.
MOST_SEGMENTS = 8
MERGE_SHARE = 0.2
# Registers of the stored vocabulary sketch are 2 to this power: a standard error of 0.7 %.
SKETCH_LG = 14


@dataclass(frozen=True)
class Index:
    """The tables of an index and the settings they were built with."""

    path: str
    documents: DataFrame
    postings: DataFrame
    terms: DataFrame
    stats: DataFrame
    stop_words: StopWords
    stem: bool
    buckets: int
    segments: int = 0

    @property
    def spark(self) -> SparkSession:
        return self.documents.sparkSession

    def sketches(self) -> DataFrame:
        """``sketch``: of the vocabulary of the whole index and of each segment."""
        paths, path = [], self.path
        while path:
            paths.append(f"{path}/sketch")
            path = _settings(self.spark, path).base
        return self.spark.read.schema("sketch binary").parquet(*paths)

    def collection(self) -> Collection:
        """The statistics row as numbers, to be folded into scoring expressions."""
        row = self.stats.first()
        return Collection(row.n_docs, row.avg_dl, row.sum_dl, row.vocab)


def build_index(
    raw: DataFrame,
    path: str,
    stop_words: StopWords,
    stem: bool = True,
    buckets: int | None = None,
    order: str | None = None,
) -> Index:
    """Index ``docno, text`` rows under ``path``.

    Of rows with one id the last by the column ``order`` counts; without that column a
    repeated id is an error. ``buckets`` sets the size of every later task on documents or
    postings. By default it follows from the number and the bytes of the documents, and of
    cores.
    """
    spark = raw.sparkSession
    raw = _last_by(raw, order)
    buckets = buckets or buckets_for(raw)
    documents = write_bucketed(
        clean_documents(raw.repartition(buckets, "docno"), stop_words),
        path, "documents", buckets, "docno", "docno",
    )
    _fail_on_repeated_ids(documents)
    write_bucketed(
        build_postings(documents, stop_words, stem),
        path, "postings", buckets, "docno", "term",
    )
    _write_settings(spark, path, buckets, stem, stop_words)
    return refresh_statistics(spark, path)


def buckets_for(raw: DataFrame) -> int:
    """Buckets that tasks can hold, by the number of documents and by their text."""
    size = raw.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    spark = raw.sparkSession
    return max(parts_for(spark, size.rows, DOCUMENTS_PER_BUCKET), parts_for(spark, size.bytes, BYTES_PER_BUCKET))


def _last_by(raw: DataFrame, order: str | None) -> DataFrame:
    """One row per id. Copies are reduced in each task before they are shuffled."""
    if order is None:
        return raw
    return keep_last(raw.select("docno", "text", order), ["docno"], [order])


def _fail_on_repeated_ids(documents: DataFrame) -> None:
    """Documents are partitioned by id, so the grouping needs no exchange."""
    repeated = documents.groupBy("docno").count().where("count > 1").first()
    if repeated:
        raise ValueError(f"{repeated.docno} occurs {repeated['count']} times; name the column that orders them")


def update_index(
    index: Index, raw: DataFrame, path: str, order: str | None = None, merge: bool | None = None
) -> Index:
    """A new index under ``path``: ``index`` with the ``docno, text`` rows of ``raw``
    added, replacing the documents of the same id. Repeated ids within ``raw`` are treated
    as ``build_index`` treats them.

    Only new documents are analyzed. By default they make a segment upon ``index``, whose
    files have to stay; what is written is in proportion to the update. With ``merge``,
    or after many or large segments, the new index stands alone.
    """
    if path.rstrip("/") == index.path.rstrip("/"):
        raise ValueError("an index cannot be updated in its own place")
    spark, n = index.spark, index.buckets
    if merge is None:
        merge = index.segments >= MOST_SEGMENTS or raw.count() > MERGE_SHARE * index.collection().n_docs
    if merge:
        return merge_segments(update_index(index, raw, scratch_path(spark, "segment"), order, merge=False), path)
    fresh = clean_documents(_last_by(raw, order).repartition(n, "docno"), index.stop_words)
    documents = write_bucketed(fresh, path, "documents", n, "docno", "docno")
    _fail_on_repeated_ids(documents)
    postings = write_bucketed(
        build_postings(documents, index.stop_words, index.stem), path, "postings", n, "docno", "term"
    )
    known = index.documents.select("docno", "doclength")
    removed = write_bucketed(
        known.join(documents.select("docno").hint("shuffle_hash"), "docno", "left_semi"), path, "removed", n, "docno", "docno"
    )
    _write_changes(index, documents, postings, removed, path)
    _write_settings(spark, path, n, index.stem, index.stop_words, index.path, index.segments + 1)
    return open_index(spark, path)


def _write_changes(index: Index, documents: DataFrame, postings: DataFrame, removed: DataFrame, path: str) -> None:
    """Statistics after an update, by taking off what goes and adding what comes."""
    spark = index.spark
    gone = index.postings.join(removed.select("docno").hint("shuffle_hash"), "docno", "left_semi")
    signed = postings.select("term", "tf", F.lit(1).alias("sign")).unionByName(gone.select("term", "tf", F.lit(-1).alias("sign")))
    summed = signed.groupBy("term").agg(
        F.sum("sign").alias("df"), F.sum(F.col("tf") * F.col("sign")).alias("ttf"), F.max("sign").alias("comes")
    )
    summed.sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/changes")
    changes = spark.read.parquet(f"{path}/changes")
    _write_sketch(changes.where("comes > 0"), path)
    side = changes.select("term", F.col("df").alias("more"))
    before = index.terms.join(F.broadcast(side) if is_small(side, BROADCAST_ROWS) else side, "term")
    known = before.agg(F.count("*").alias("old"), F.sum(F.when(F.col("df") + F.col("more") <= 0, 1).otherwise(0)).alias("lost")).first()
    came, went = (d.agg(F.count("*").alias("n"), F.coalesce(F.sum("doclength"), F.lit(0)).alias("dl")).first() for d in (documents, removed))
    was = index.collection()
    n_docs, sum_dl = was.n_docs + came.n - went.n, was.sum_dl + came.dl - went.dl
    vocab = was.vocab + changes.count() - known.old - (known.lost or 0)
    row = (n_docs, sum_dl / n_docs if n_docs else None, sum_dl, vocab)
    spark.createDataFrame([row], schemas.STATS).write.mode("overwrite").parquet(f"{path}/stats")


def merge_segments(index: Index, path: str) -> Index:
    """The same index under ``path`` as one, without segments. Nothing is analyzed again.

    A task writes one bucket from the files of that bucket.
    """
    spark, n = index.spark, index.buckets
    with bucket_by_bucket(spark):
        write_bucketed(index.documents, path, "documents", n, "docno", "docno")
        write_bucketed(index.postings, path, "postings", n, "docno", "term")
    _write_settings(spark, path, n, index.stem, index.stop_words)
    return refresh_statistics(spark, path)


def _write_sketch(terms: DataFrame, path: str) -> None:
    sketch = terms.agg(F.hll_sketch_agg("term", F.lit(SKETCH_LG)).alias("sketch"))
    sketch.write.mode("overwrite").parquet(f"{path}/sketch")


def sketched_vocabulary(index: Index) -> DataFrame:
    """Vocabulary size by the stored sketches: no postings or terms are read.

    After updates it counts every term that was ever indexed since the last merge.
    """
    return index.sketches().agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("vocab"))


def refresh_statistics(spark: SparkSession, path: str) -> Index:
    """Compute term and collection statistics from the written tables."""
    documents, postings = _open_tables(spark, path, _settings(spark, path).buckets)
    terms_path = f"{path}/terms"
    (
        term_statistics(postings)
        .sortWithinPartitions("term")
        .write.mode("overwrite")
        .parquet(terms_path)
    )
    terms = spark.read.schema(schemas.TERMS).parquet(terms_path)
    _write_sketch(terms, path)
    vocab = exact_vocabulary(terms).first()
    (
        length_statistics(documents)
        .withColumn("vocab", F.lit(vocab.vocab).cast("long"))
        .write.mode("overwrite")
        .parquet(f"{path}/stats")
    )
    return open_index(spark, path)


def index_corpus(
    spark: SparkSession,
    corpus: str,
    path: str,
    stop_words: StopWords,
    stem: bool = True,
    buckets: int | None = None,
    only: DataFrame | None = None,
) -> Index:
    """Index a directory of tagged files.

    Parsed blocks are written once before anything is decided about them, so a lost
    executor never changes which copy of a document wins. ``only`` restricts the index
    to the document ids of a judgement table.
    """
    return build_index(
        load_corpus(spark, corpus, only), path, stop_words, stem, buckets
    )


def load_corpus(
    spark: SparkSession, corpus: str, only: DataFrame | None = None
) -> DataFrame:
    """``docno, text`` of a directory of tagged files, one row per id."""
    staged = scratch_path(spark, "blocks")
    read_blocks(spark, corpus).write.parquet(staged)
    documents = keep_documents(spark.read.parquet(staged), corpus)
    if only is not None:
        documents = documents.join(only.select("docno").distinct(), "docno", "left_semi")
    return documents


def open_index(spark: SparkSession, path: str) -> Index:
    """Open an index written earlier, possibly by another session."""
    settings = _settings(spark, path)
    documents, postings = _open_tables(spark, path, settings.buckets)
    stats = spark.read.schema(schemas.STATS).parquet(f"{path}/stats")
    if settings.base:
        base = open_index(spark, settings.base)
        removed = open_bucketed(spark, path, "removed", schemas.REMOVED, settings.buckets, "docno", "docno").select("docno")
        # The ids of a bucket are hashed: neither sent to all tasks, nor are postings sorted by id.
        removed = removed.hint("shuffle_hash")
        documents = base.documents.join(removed, "docno", "left_anti").unionByName(documents)
        postings = base.postings.join(removed, "docno", "left_anti").unionByName(postings)
        changes = spark.read.schema(schemas.TERMS).parquet(f"{path}/changes")
        summed = base.terms.unionByName(changes).groupBy("term").agg(F.sum("df").alias("df"), F.sum("ttf").alias("ttf"))
        terms = summed.where("df > 0")
    else:
        terms = spark.read.schema(schemas.TERMS).parquet(f"{path}/terms")
    return Index(
        path=path,
        documents=documents,
        postings=postings,
        terms=terms,
        stats=stats,
        stop_words=spark.read.schema("word string").parquet(f"{path}/stop_words") if settings.stop_words is None else list(settings.stop_words),
        stem=settings.stem,
        buckets=settings.buckets,
        segments=settings.segments,
    )


def forget_index(spark: SparkSession, path: str) -> None:
    """Remove the tables of the index and of what it is a segment upon from the catalog."""
    base = _settings(spark, path).base
    drop_tables(spark, path, ("documents", "postings", "removed"))
    if base:
        forget_index(spark, base)


def _write_settings(
    spark: SparkSession, path: str, buckets: int, stem: bool, stop_words: StopWords,
    base: str | None = None, segments: int = 0,
) -> None:
    listed = not isinstance(stop_words, DataFrame)
    if not listed:
        stop_words.select("word").write.mode("overwrite").parquet(f"{path}/stop_words")
    settings = spark.range(1).select(
        F.lit(buckets).alias("buckets"),
        F.lit(stem).alias("stem"),
        (F.array(*[F.lit(w) for w in stop_words]) if listed else F.lit(None)).cast("array<string>").alias("stop_words"),
        F.lit(base).cast("string").alias("base"),
        F.lit(segments).alias("segments"),
    )
    settings.write.mode("overwrite").parquet(f"{path}/settings")


def _settings(spark: SparkSession, path: str):
    return spark.read.parquet(f"{path}/settings").first()


def _open_tables(spark: SparkSession, path: str, buckets: int):
    documents = open_bucketed(
        spark, path, "documents", schemas.DOCUMENTS, buckets, "docno", "docno"
    )
    postings = open_bucketed(
        spark, path, "postings", schemas.POSTINGS, buckets, "docno", "term"
    )
    return documents, postings
