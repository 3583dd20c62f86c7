"""Inputs of the engine, derived from the given tables.

Written inputs (index, tagged files, judgements, features) live in the session's shared
folder and are made once per application and input directory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl import build_index, merge_segments, open_index, update_index
from trawl.functions.cleaning import TOPIC_PREAMBLES
from trawl.functions.scoring import rounded
from trawl.operators.features import MODEL_FEATURES
from trawl.plans.indexing import Index
from trawl.plans.learning import feature_table, fit_and_predict, split_features
from trawl.plans.retrieval import retrieve
from trawl.storage import scratch_path

STOP_WORDS = (
    "the of and is in to that it le la les de et un der die und el los que".split()
)
SEED = 42
# Apostrophes, underscores and a lone combining mark, which the tables' texts lack.
MARKS = " o'clock's rock'n'roll __ _a1 _'b l’été’s \u0301 a\u0301'c__'"
POOL_DEPTH = 100
# Documents in each of the files that end in various ways.
DOCUMENTS_PER_FILE = 500

_made: dict[tuple[str, str, str], str] = {}


def made_once(
    spark: SparkSession, sf_dir: str, label: str, make: Callable[[str], None]
) -> str:
    """Path of a written input, made on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _made:
        tag = hashlib.md5(sf_dir.encode()).hexdigest()[:8]
        path = scratch_path(spark, f"{label}-{tag}")
        make(path)
        _made[key] = path
    return _made[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docno_of(doc_id: Column) -> Column:
    """Thirteen characters, as the fixed-width id column of a tagged file has."""
    return F.concat(F.lit("AP"), F.lpad(doc_id.cast("string"), 11, "0"))


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts, every third one followed by ``MARKS``."""
    documents = table(spark, sf_dir, "documents")
    marked = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(MARKS))).otherwise(F.col("text"))
    return documents.select(docno_of(F.col("doc_id")).alias("docno"), marked.alias("text"))


def scripted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts as they are, in letters of scripts without blanks, and with marks between
    letters and digits, by ``doc_id``."""
    documents = table(spark, sf_dir, "documents")
    text, kind = F.lower("text"), F.pmod("doc_id", F.lit(6))
    marked = F.translate(text, "aeo", "123")
    for blank, mark in ((" 1", ".1"), (" 2", ",2"), (" t", ":t"), (" s", ".s"), (" 3", "\u066b3")):
        marked = F.replace(marked, F.lit(blank), F.lit(mark))
    attached = text
    for plain, marks in (("a", "a\u0301"), (" b", "\u0301b"), ("e ", "e\u200d "), ("n", "n\u00ad"), ("o", "オ\u3099")):
        attached = F.replace(attached, F.lit(plain), F.lit(marks))
    written = (
        F.when(kind == 1, F.translate(text, "aeioutsn", "日本語中文のとカ"))
        .when(kind == 2, F.translate(text, "aeioustnr", "アイウエオストンー"))
        .when(kind == 3, F.translate(text, "aeiourst", "กขคงจ\u0e31\u0e34\u0e48"))
        .when(kind == 4, marked)
        .when(kind == 5, attached)
        .otherwise(F.concat("text", F.lit(MARKS)))
    )
    return documents.select(docno_of(F.col("doc_id")).alias("docno"), written.alias("text"))


def index(spark: SparkSession, sf_dir: str) -> Index:
    path = made_once(
        spark, sf_dir, "index",
        lambda p: build_index(raw_documents(spark, sf_dir), p, STOP_WORDS),
    )
    return open_index(spark, path)


def revised_index(spark: SparkSession, sf_dir: str) -> Index:
    """The index after every labelled document came in again with a changed text.

    The batch holds an outdated copy of each as well; the later one counts.
    """
    labelled = table(spark, sf_dir, "labels").select(
        docno_of(F.col("doc_id")).alias("docno")
    )
    revised = raw_documents(spark, sf_dir).join(labelled, "docno", "left_semi").withColumn(
        "text", F.concat(F.lit("Revised editions: "), F.col("text"))
    )
    outdated = revised.select("docno", F.lit("outdated").alias("text"), F.lit(1).alias("version"))
    batch = revised.withColumn("version", F.lit(2)).unionByName(outdated)
    path = made_once(
        spark, sf_dir, "revised",
        lambda p: update_index(index(spark, sf_dir), batch, p, order="version", merge=False),
    )
    return open_index(spark, path)


def merged_index(spark: SparkSession, sf_dir: str) -> Index:
    """The revised index with its segment merged."""
    path = made_once(spark, sf_dir, "merged", lambda p: merge_segments(revised_index(spark, sf_dir), p))
    return open_index(spark, path)


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics for retrieval: the whole benchmark text."""
    items = table(spark, sf_dir, "benchmark")
    return items.select(F.col("item_id").cast("int").alias("qid"), "text")


def tagged_files(spark: SparkSession, sf_dir: str, versions: int = 1) -> str:
    """The documents written as a directory of tagged text files.

    With two versions, every document is preceded by an outdated copy of itself.
    """

    def block(text: Column) -> Column:
        return F.concat(
            F.lit("<DOC>\n<DOCNO> "), F.col("docno"), F.lit(" </DOCNO>\n<TEXT>\n"),
            text, F.lit("\n</TEXT>\n</DOC>"),
        )

    def make(path: str) -> None:
        text = F.col("text")
        outdated = [block(F.concat(F.lit("outdated\n"), text))] * (versions - 1)
        blocks = F.concat_ws("\n", *outdated, block(text))
        raw_documents(spark, sf_dir).select(blocks.alias("value")).write.text(path)

    return made_once(spark, sf_dir, f"tagged{versions}", make)


def mixed_files(spark: SparkSession, sf_dir: str) -> str:
    """The documents in files that end in every way, plain, compressed or led by a
    byte-order mark: after a blank line, at the closing tag, or in an open block. Blocks
    have no section, one or two, or no id.
    """
    head = F.concat(F.lit("<DOC>\n<DOCNO> "), F.col("docno"), F.lit(" </DOCNO>\n"))
    section = lambda text: F.concat(F.lit("<TEXT>\n"), text, F.lit("\n</TEXT>"))
    text, half = F.col("text"), (F.length("text") / 2).cast("int")
    halves = F.concat(section(F.substr("text", F.lit(1), half)), F.lit("\n"), section(F.substr("text", half + 1, F.length("text"))))
    number = F.substring("docno", 3, 11).cast("long")
    shape = number % 5
    body = (
        F.when(shape == 0, F.lit("<HEAD>no section</HEAD>"))
        .when(shape == 1, F.concat(head, halves))
        .when(shape == 2, F.concat(F.lit("<DOC>\n"), section(text)))
        .otherwise(F.concat(head, section(text)))
    )
    body = F.when(shape == 0, F.concat(head, body)).otherwise(body)
    open_end = F.lit("\n<DOC>\n<DOCNO> AP99999999999 </DOCNO>\n<TEXT>\nnever closed")
    kinds = [(end, compression, mark) for end in ("blank", "tag", "open") for compression in ("none", "gzip") for mark in ("", "\ufeff")]

    def make(path: str) -> None:
        rows = raw_documents(spark, sf_dir).select(body.alias("body"), (number % len(kinds)).alias("kind"), number.alias("number"))
        parts = 2 + rows.count() // (DOCUMENTS_PER_FILE * len(kinds))
        for i, (end, compression, mark) in enumerate(kinds):
            own = rows.where(F.col("kind") == i).withColumn("part", F.pmod(F.xxhash64("number"), F.lit(parts)))
            # One row a file: everything up to where its last line separator begins.
            held = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "body"))), lambda b: b["body"]), "\n</DOC>\n")
            content = F.concat(F.lit(mark), held, *([F.lit("\n</DOC>"), open_end] if end == "open" else []))
            separator = {"blank": "\n</DOC>\n", "tag": "\n</DOC>", "open": "\n"}[end]
            whole = own.groupBy("part").agg(content.alias("value")).write.partitionBy("part").mode("append")
            whole.option("compression", compression).option("lineSep", separator).text(path)

    return made_once(spark, sf_dir, "mixed", make)


def stop_file(spark: SparkSession, sf_dir: str) -> str:
    """The stop words, one per line."""
    return made_once(
        spark, sf_dir, "stop",
        lambda p: spark.createDataFrame([(w,) for w in STOP_WORDS], "value string").write.text(p),
    )


def topic_file(spark: SparkSession, sf_dir: str) -> str:
    """``number. preamble text`` lines; the preambles take turns over the topics."""

    def make(path: str) -> None:
        preamble = F.element_at(
            F.array(*[F.lit(p) for p in TOPIC_PREAMBLES]), F.col("qid") % 5 + 1
        )
        line = F.concat(
            F.col("qid").cast("string"), F.lit("."), preamble,
            F.translate("text", "\n", " "),
        )
        topics(spark, sf_dir).select(line.alias("value")).write.text(path)

    return made_once(spark, sf_dir, "topics", make)


def judged_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judgements: every labelled document of the pool, and every labelled document
    once more for the topic its id falls on, whether or not it was retrieved.

    The pool is the top of the BM25 ranking. A document is relevant when its label says
    good quality and not toxic.
    """
    items = topics(spark, sf_dir)
    pool = retrieve(index(spark, sf_dir), items, ["okapi_bm"], POOL_DEPTH)
    labels = table(spark, sf_dir, "labels").select(
        docno_of(F.col("doc_id")).alias("docno"),
        "doc_id",
        ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int").alias("label"),
    )
    pooled = pool.join(labels, "docno").select("qid", "docno", "label")
    turns = F.pmod(F.col("doc_id"), F.lit(items.count())).cast("int")
    assigned = labels.withColumn("qid", turns).join(items.select("qid"), "qid")
    return pooled.unionByName(assigned.select("qid", "docno", "label")).distinct()


def qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = made_once(
        spark, sf_dir, "qrels",
        lambda p: judged_pairs(spark, sf_dir).write.parquet(p),
    )
    return spark.read.parquet(path)


def qrels_file(spark: SparkSession, sf_dir: str) -> str:
    """The judgements as ``qid 0 docno label`` lines."""

    def make(path: str) -> None:
        line = F.concat_ws(
            " ", F.col("qid").cast("string"), F.lit("0"), F.col("docno"),
            F.col("label").cast("string"),
        )
        qrels(spark, sf_dir).select(line.alias("value")).write.text(path)

    return made_once(spark, sf_dir, "qrels-text", make)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make(path: str) -> None:
        table = feature_table(
            index(spark, sf_dir), topics(spark, sf_dir), qrels(spark, sf_dir)
        )
        table.write.parquet(path)

    return spark.read.parquet(made_once(spark, sf_dir, "features", make))


def comparable_features(rows: DataFrame) -> DataFrame:
    """Feature rows with their scores rounded as the SQL rounds them."""
    return rows.withColumns({f: rounded(F.col(f), 6) for f in MODEL_FEATURES.values()})


def comparable_splits(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Training and test rows that the SQL has as well."""
    splits = split_features(features(spark, sf_dir), topics(spark, sf_dir), SEED)
    return {name: comparable_features(rows) for name, rows in splits.items()}


def predictions(spark: SparkSession, sf_dir: str, learner: str) -> DataFrame:
    """Predictions of one learner for both splits; fitted once."""

    def make(path: str) -> None:
        fit_and_predict(comparable_splits(spark, sf_dir), learner, SEED, path)

    return spark.read.parquet(made_once(spark, sf_dir, learner, make))
