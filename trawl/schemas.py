"""Explicit schemas of every table the engine reads or writes."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("docno", T.StringType(), False),
    T.StructField("text", T.StringType()),
    T.StructField("doclength", T.LongType()),
])

POSTINGS = T.StructType([
    T.StructField("docno", T.StringType(), False),
    T.StructField("doclength", T.LongType()),
    T.StructField("term", T.StringType(), False),
    T.StructField("tf", T.LongType()),
])

REMOVED = T.StructType([
    T.StructField("docno", T.StringType(), False),
    T.StructField("doclength", T.LongType()),
])

TERMS = T.StructType([
    T.StructField("term", T.StringType(), False),
    T.StructField("df", T.LongType()),
    T.StructField("ttf", T.LongType()),
])

STATS = T.StructType([
    T.StructField("n_docs", T.LongType()),
    T.StructField("avg_dl", T.DoubleType()),
    T.StructField("sum_dl", T.LongType()),
    T.StructField("vocab", T.LongType()),
])

TOPICS = T.StructType([
    T.StructField("qid", T.IntegerType(), False),
    T.StructField("text", T.StringType()),
])

QRELS = T.StructType([
    T.StructField("qid", T.IntegerType(), False),
    T.StructField("docno", T.StringType(), False),
    T.StructField("label", T.IntegerType()),
])
