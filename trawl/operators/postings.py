"""Postings, term statistics, collection statistics, topic terms."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from trawl.functions.analysis import analyze
from trawl.functions.cleaning import (
    bare_topic,
    blank_stop_words,
    clean_document,
    clean_topic,
    finish_document,
    finish_topic,
    raw_tokens,
    token_count,
)
from trawl.operators.keyed import BROADCAST_ROWS, is_small
from trawl.storage import written

# A list is folded into expressions; a table with a column ``word`` is joined.
StopWords = list[str] | DataFrame

FREQUENT_TERMS = 10_000
# Words of a table that are folded into expressions as a list is.
FOLDED_WORDS = 10_000


def clean_documents(raw: DataFrame, stop_words: StopWords) -> DataFrame:
    """``docno, text`` to cleaned ``docno, text, doclength``."""
    if isinstance(stop_words, DataFrame):
        kept = blank_listed(raw, "docno", F.col("text"), stop_words)
        cleaned = kept.select("docno", finish_document(F.col("text")).alias("text"))
    else:
        cleaned = raw.select("docno", clean_document(F.col("text"), stop_words).alias("text"))
    return cleaned.withColumn("doclength", token_count(F.col("text")))


def clean_topics(raw: DataFrame, stop_words: StopWords) -> DataFrame:
    if isinstance(stop_words, DataFrame):
        kept = blank_listed(raw, "qid", bare_topic(F.col("text")), stop_words)
        return kept.select("qid", finish_topic(F.col("text")).alias("text"))
    return raw.select("qid", clean_topic(F.col("text"), stop_words).alias("text"))


def blank_listed(rows: DataFrame, key: str, text: Column, stop_words: DataFrame) -> DataFrame:
    """``key, text`` with the tokens that ``stop_words`` lists replaced by nothing.

    Of a list only the words that the texts hold matter. The list meets the distinct tokens
    in a join that leaves these; they are folded into an expression, or sent to the tasks,
    and texts stay where they are. Words too many for that meet the distinct tokens of each
    row, and a row is joined with its own, by way of a written table so that it keeps its
    number.
    """
    listed = stop_words.select(F.col("word").alias("token")).distinct()
    heard = written(distinct_tokens(rows.select(text.alias("text"))).distinct().join(listed, "token"), "heard")
    count = heard.count()
    if count <= FOLDED_WORDS:
        return rows.select(key, blank_stop_words(text, sorted(r.token for r in heard.collect())).alias("text"))
    if count <= BROADCAST_ROWS:
        held = rows.sparkSession.sparkContext.broadcast(heard.toArrow().column("token").combine_chunks())
        return rows.select(key, F.array_join(blanking(held)(raw_tokens(text)), " ").alias("text"))
    numbered = written(rows.select(key, F.monotonically_increasing_id().alias("row"), text.alias("text")), "texts")
    own = distinct_tokens(numbered, "row").join(heard, "token").groupBy("row").agg(F.collect_list("token").alias("own"))
    whole = numbered.join(own, "row", "left")
    return whole.select(key, F.array_join(blanking_own(raw_tokens(F.col("text")), F.col("own")), " ").alias("text"))


def distinct_tokens(texts: DataFrame, *keys: str) -> DataFrame:
    """``keys, token``: every token of a row's ``text`` once."""
    return texts.select(*keys, F.explode(F.array_distinct(raw_tokens(F.col("text")))).alias("token"))


def blanking(held):
    """Tokens with those of a list sent to the tasks replaced by nothing."""
    @arrow_udf(T.ArrayType(T.StringType()))
    def blank(tokens: pa.Array) -> pa.Array:
        words = tokens.values
        kept = pc.if_else(pc.is_in(words, value_set=held.value), pa.scalar("", words.type), words)
        return pa.ListArray.from_arrays(pa.array(tokens.offsets.to_numpy()), kept, mask=tokens.is_null())

    return blank


@arrow_udf(T.ArrayType(T.StringType()))
def blanking_own(tokens: pa.Array, own: pa.Array) -> pa.Array:
    """Tokens with those of the row's own list replaced by nothing."""
    kept = []
    for words, listed in zip(tokens, own):
        gone = set(listed.as_py() or ())
        kept.append(None if not words.is_valid else ["" if w in gone else w for w in words.as_py()])
    return pa.array(kept, pa.list_(pa.string()))


def build_postings(
    documents: DataFrame, stop_words: StopWords, stem: bool = True
) -> DataFrame:
    """One row per document and term. The document length rides along, so that scoring
    needs no join with the documents.

    Over documents partitioned by ``docno`` this is a narrow job: the grouping needs no
    exchange.
    """
    tokens = analyze(documents, ["docno", "doclength"], "text", stop_words, stem)
    return tokens.groupBy("docno", "doclength", "term").agg(F.count("*").alias("tf"))


def build_positions(
    documents: DataFrame, stop_words: StopWords, stem: bool = True
) -> DataFrame:
    """Term vectors with the word positions of each term."""
    tokens = analyze(documents, ["docno"], "text", stop_words, stem)
    return tokens.groupBy("docno", "term").agg(
        F.count("*").alias("tf"),
        F.array_sort(F.collect_list("pos")).alias("positions"),
    )


def term_statistics(postings: DataFrame) -> DataFrame:
    """Document frequency and collection frequency of each term."""
    return postings.groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("ttf")
    )


def length_statistics(documents: DataFrame) -> DataFrame:
    """Document count, average and total document length; empty documents count."""
    return documents.agg(
        F.count("*").alias("n_docs"),
        F.avg("doclength").alias("avg_dl"),
        F.sum("doclength").alias("sum_dl"),
    )


def approximate_vocabulary(postings: DataFrame, rsd: float = 0.01) -> DataFrame:
    """Vocabulary size by a HyperLogLog sketch merged from all tasks."""
    return postings.agg(F.approx_count_distinct("term", rsd).alias("vocab"))


def exact_vocabulary(terms: DataFrame) -> DataFrame:
    return terms.agg(F.count("*").alias("vocab"))


def topic_terms(topics: DataFrame, stop_words: StopWords, stem: bool = True) -> DataFrame:
    """Analyzed terms of cleaned topics, with their multiplicity."""
    tokens = analyze(topics, ["qid"], "text", stop_words, stem)
    return tokens.groupBy("qid", "term").agg(F.count("*").alias("qtf"))


def term_vectors(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """Term vectors with term statistics; filter by ``docno`` for one document.

    A small vocabulary is broadcast. Otherwise the postings of frequent terms, which are
    most of the postings, meet their statistics by broadcast: at most
    ``FREQUENT_TERMS`` terms can each have more than that share of all postings. Only
    the rest is shuffled by term, and no term of the rest is large.
    """
    vectors = postings.select("docno", "term", "tf")
    if is_small(terms, BROADCAST_ROWS):
        return vectors.join(F.broadcast(terms), "term")
    n_postings = terms.agg(F.sum("df")).first()[0]
    frequent = F.col("df") > n_postings / FREQUENT_TERMS
    heads = F.broadcast(terms.where(frequent))
    tail = vectors.join(heads, "term", "left_anti").join(terms.where(~frequent), "term")
    return vectors.join(heads, "term").unionByName(tail)
