"""Every registered query, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.analysis import analyze, strip_possessive, words
from trawl.functions.scoring import Scorer, rounded
from trawl.functions.stemming import stem_words
from trawl.operators import forest
from trawl.operators.features import FEATURES, matched_term_sums, pair_lengths
from trawl.operators.learning import LEARNERS, predict
from trawl.operators.postings import (
    approximate_vocabulary,
    build_positions,
    clean_documents,
    clean_topics,
    exact_vocabulary,
    length_statistics,
    term_vectors,
    topic_terms,
)
from trawl.operators.scoring import candidates, match_postings, rank_all
from trawl.operators.splitting import held_out_topics, train_topics
from trawl.plans.indexing import load_corpus, sketched_vocabulary
from trawl.plans.retrieval import TOP_K, retrieve, weighed_terms
from trawl.sinks.runfiles import run_line, write_runs
from trawl.sources.lists import read_qrels, read_stop_list, read_stop_table, read_topics
from trawl.storage import scratch_path, written
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

BROWSE_SIZE = 10
# Depth of the query whose feature is the cut.
SHALLOW_K = 100


def ingest_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = load_corpus(spark, fx.tagged_files(spark, sf_dir))
    return clean_documents(raw, fx.STOP_WORDS)


def ingest_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed, marked and open-ended files of blocks of every shape."""
    return load_corpus(spark, fx.mixed_files(spark, sf_dir))


def ingest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document twice in the files; the later copy is the one kept."""
    raw = load_corpus(spark, fx.tagged_files(spark, sf_dir, versions=2))
    return clean_documents(raw, fx.STOP_WORDS)


def reindex_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.revised_index(spark, sf_dir).documents.select("docno", "doclength")


def reindex_term_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.revised_index(spark, sf_dir).terms


def merged_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.merged_index(spark, sf_dir).documents.select("docno", "doclength")


def merged_term_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.merged_index(spark, sf_dir).terms


def reindex_retrieve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrieval from an index with a segment upon it."""
    hits = retrieve(fx.revised_index(spark, sf_dir), fx.topics(spark, sf_dir), ["okapi_bm"], SHALLOW_K)
    return comparable(hits).drop("model")


def vocab_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact size after an update, and whether the stored sketches are within five
    percent of it."""
    index = fx.revised_index(spark, sf_dir)
    sketch = sketched_vocabulary(index).withColumnRenamed("vocab", "sketch")
    return close_to_exact(sketch, exact_vocabulary(index.terms))


def close_to_exact(sketch: DataFrame, exact: DataFrame) -> DataFrame:
    return sketch.withColumn("vocab", exact.scalar()).select(
        "vocab",
        (F.abs(F.col("sketch") - F.col("vocab")) <= 0.05 * F.col("vocab")).alias("close"),
    )


def judged_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = fx.qrels(spark, sf_dir)
    raw = load_corpus(spark, fx.tagged_files(spark, sf_dir), only=judged)
    return clean_documents(raw, fx.STOP_WORDS).select("docno", "doclength")


def clean_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_documents(fx.raw_documents(spark, sf_dir), fx.STOP_WORDS)


def stop_list_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cleaned by a stop list that comes from a file."""
    stop_words = read_stop_list(spark, fx.stop_file(spark, sf_dir))
    return clean_documents(fx.raw_documents(spark, sf_dir), stop_words)


def stop_list_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a joined stop list of any size: the stop words among as many words that
    no text holds as there are documents."""
    unheard = fx.raw_documents(spark, sf_dir).select(F.concat(F.lit("\u0001"), F.col("docno")).alias("word"))
    listed = read_stop_table(spark, fx.stop_file(spark, sf_dir)).unionByName(unheard)
    return clean_documents(fx.raw_documents(spark, sf_dir), listed)


def topic_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = read_topics(spark, fx.topic_file(spark, sf_dir))
    return clean_topics(parsed, fx.STOP_WORDS)


def qrels_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_qrels(spark, fx.qrels_file(spark, sf_dir))


def browse_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.index(spark, sf_dir).documents.orderBy("docno").limit(BROWSE_SIZE)


def doc_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.index(spark, sf_dir).documents.select("docno", "doclength")


def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_statistics(fx.index(spark, sf_dir).documents)


def vocab_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_vocabulary(fx.index(spark, sf_dir).terms)


def vocab_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact size, and whether the sketch is within five percent of it."""
    index = fx.index(spark, sf_dir)
    sketch = approximate_vocabulary(index.postings).withColumnRenamed("vocab", "sketch")
    return close_to_exact(sketch, exact_vocabulary(index.terms))


def analyze_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens per document before stemming, with how often each occurs."""
    documents = fx.index(spark, sf_dir).documents
    tokens = analyze(documents, ["docno"], "text", fx.STOP_WORDS, stem=False)
    return tokens.groupBy("docno", "term").agg(F.count("*").alias("n"))


def segment_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of texts in several scripts, with its place."""
    documents = fx.scripted_documents(spark, sf_dir)
    return documents.select("docno", F.posexplode(words(F.col("text"))).alias("pos", "word"))


def stem_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stem of every distinct word of the collection, possessives stripped."""
    documents = fx.index(spark, sf_dir).documents
    vocabulary = documents.select(F.explode(words(F.col("text"))).alias("word")).distinct()
    bare = vocabulary.withColumn("bare", strip_possessive(F.col("word")))
    return stem_words(bare, "bare", "stem")


def query_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_topics(fx.topics(spark, sf_dir), fx.STOP_WORDS)
    return topic_terms(cleaned, fx.STOP_WORDS)


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.index(spark, sf_dir).postings.select("docno", "term", "tf")


def postings_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = build_positions(fx.index(spark, sf_dir).documents, fx.STOP_WORDS)
    positions = F.array_join(F.transform("positions", lambda p: p.cast("string")), ",")
    return vectors.withColumn("positions", positions)


def term_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.index(spark, sf_dir).terms


def term_vector_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term vectors with term statistics, looked up for every judged document."""
    index = fx.index(spark, sf_dir)
    judged = fx.qrels(spark, sf_dir).select("docno").distinct()
    return term_vectors(index.postings.join(judged, "docno", "left_semi"), index.terms)


def match_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = fx.index(spark, sf_dir)
    weighed = weighed_terms(index, fx.topics(spark, sf_dir))
    return candidates(match_postings(index.postings, weighed))


def matched_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched-term sums of every judged pair; 0 where nothing matches."""
    index = fx.index(spark, sf_dir)
    pairs = fx.qrels(spark, sf_dir).select("qid", "docno")
    weighed = weighed_terms(index, fx.topics(spark, sf_dir))
    sums = matched_term_sums(pairs, weighed, index.postings, index.buckets)
    return pairs.join(sums, ["qid", "docno"], "left").na.fill(0)


def comparable(hits: DataFrame, digits: int = 6) -> DataFrame:
    """Hits with scores rounded as the SQL rounds them."""
    return hits.withColumn("score", rounded(F.col("score"), digits))


def retrieve_by(model: str, k: int = TOP_K) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        hits = retrieve(fx.index(spark, sf_dir), fx.topics(spark, sf_dir), [model], k)
        return comparable(hits).drop("model")

    return query


def retrieve_all_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(retrieve(fx.index(spark, sf_dir), fx.topics(spark, sf_dir)))


def tiny_scorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores far below a millionth: every one is a hit."""
    tiny = Scorer("tiny", match=lambda c: F.col("tf") / F.lit(1e9), digits=12)
    hits = retrieve(fx.index(spark, sf_dir), fx.topics(spark, sf_dir), [tiny])
    return comparable(hits, 12).drop("model")


def custom_scorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scorer given by the caller: length-damped term frequency times rarity."""
    damped = Scorer(
        "damped",
        match=lambda c: F.col("qtf") * F.log(1.0 + F.col("tf"))
        / F.sqrt(F.col("doclength").cast("double"))
        * F.log(1.0 + F.lit(c.n_docs) / F.col("df")),
    )
    hits = retrieve(fx.index(spark, sf_dir), fx.topics(spark, sf_dir), [damped])
    return comparable(hits).drop("model")


def run_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run lines of all models, as the run files hold them."""
    hits = retrieve_all_models(spark, sf_dir)
    score = F.col("score").cast("decimal(18,6)")
    return hits.select("model", run_line(score).alias("line"))


def run_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run lines, written as run files and read back."""
    hits = retrieve_all_models(spark, sf_dir)
    path = scratch_path(spark, "runs")
    write_runs(fixed_point(hits), path, ["model"], "score")
    return spark.read.text(path).select("model", F.col("value").alias("line"))


def run_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two disjoint sets of topics written one after the other into the same runs."""
    items, path = fx.topics(spark, sf_dir), scratch_path(spark, "runs")
    for mode, part in (("overwrite", items.where("qid % 2 = 0")), ("append", items.where("qid % 2 <> 0"))):
        hits = comparable(retrieve(fx.index(spark, sf_dir), part, ["okapi_bm"]))
        write_runs(fixed_point(hits), path, ["model"], "score", mode)
    return spark.read.text(path).select("model", F.col("value").alias("line"))


def fixed_point(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.col("score").cast("decimal(18,6)"))


def topic_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_topics(fx.topics(spark, sf_dir), fx.SEED)


def train_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = fx.topics(spark, sf_dir)
    return train_topics(items, held_out_topics(items, fx.SEED)).orderBy("qid")


def judged_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of every judged document, and whether it is indexed at all."""
    pairs = pair_lengths(fx.qrels(spark, sf_dir), fx.index(spark, sf_dir).documents)
    return pairs.select(
        "qid", "docno", "doclength", F.col("doclength").isNotNull().alias("indexed")
    )


def features_of(split: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = fx.comparable_splits(spark, sf_dir)[split]
        return rows if split == "train" else rows.drop("label")

    return query


def ranked_by(learner: str, split: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = fx.predictions(spark, sf_dir, learner).where(F.col("split") == split)
        rows = rows.withColumn("prediction", rounded(F.col("prediction"), 6))
        ranked = rank_all(rows, ["qid"], "prediction", fx.index(spark, sf_dir).buckets)
        return ranked.select("qid", "docno", "rank", "prediction")

    return query


# Forests that SQL can grow as well.
SMALL_FORESTS = {
    "classifier": forest.Plan(tuple(FEATURES), fx.SEED, trees=3, tries=3, depth=4),
    "regressor": forest.Plan(tuple(FEATURES), fx.SEED, trees=3, tries=len(FEATURES), depth=4),
}


def small_forest(kind: str) -> Query:
    """Test pairs ranked by a forest of a few shallow trees."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        splits = fx.comparable_splits(spark, sf_dir)
        model = forest.fit(splits["train"], SMALL_FORESTS[kind], kind == "classifier")
        rows = predict(model, splits["test"]).withColumn("prediction", rounded(F.col("prediction"), 6))
        return rank_all(written(rows, "small-forest"), ["qid"], "prediction", fx.index(spark, sf_dir).buckets)

    return query


def small_forest_run_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run files of the small forests, written and read back."""
    ranked = [small_forest(kind)(spark, sf_dir).withColumn("learner", F.lit(kind)) for kind in SMALL_FORESTS]
    path = scratch_path(spark, "small-runs")
    rows = reduce(DataFrame.unionByName, ranked).withColumn("score", F.col("prediction").cast("decimal(18,6)"))
    write_runs(rows, path, ["learner"], "score")
    return spark.read.text(path).select("learner", F.col("value").alias("line"))


def ltr_run_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run files of every learner and split, written and read back."""
    rows = reduce(
        DataFrame.unionByName,
        [fx.predictions(spark, sf_dir, learner) for learner in LEARNERS],
    )
    by = ["learner", "split"]
    buckets = fx.index(spark, sf_dir).buckets
    path = scratch_path(spark, "learned-runs")
    write_runs(rank_all(rows, [*by, "qid"], "prediction", buckets), path, by, "prediction")
    return spark.read.text(path).select(*by, F.col("value").alias("line"))


QUERIES: dict[str, Query] = {
    "ingest_tagged": ingest_tagged,
    "ingest_mixed": ingest_mixed,
    "ingest_upsert": ingest_upsert,
    "reindex_lengths": reindex_lengths,
    "reindex_term_stats": reindex_term_stats,
    "reindex_merged_lengths": merged_lengths,
    "reindex_merged_term_stats": merged_term_stats,
    "reindex_retrieve": reindex_retrieve,
    "topic_parse": topic_parse,
    "qrels_parse": qrels_parse,
    "browse_docs": browse_docs,
    "clean_docs": clean_docs,
    "stop_list_file": stop_list_file,
    "stop_list_table": stop_list_table,
    "doc_length": doc_length,
    "length_stats": length_stats,
    "vocab_exact": vocab_exact,
    "vocab_approx": vocab_approx,
    "vocab_sketched": vocab_sketched,
    "analyze_tokens": analyze_tokens,
    "segment_words": segment_words,
    "stem_vocab": stem_vocab,
    "query_terms": query_terms,
    "postings": postings,
    "postings_positions": postings_positions,
    "term_stats": term_stats,
    "term_vector_lookup": term_vector_lookup,
    "match_candidates": match_candidates,
    "matched_term_sums": matched_sums,
    "retrieve_okapi_tf": retrieve_by("okapi_tf"),
    "retrieve_tf_idf": retrieve_by("tf_idf"),
    "retrieve_bm25": retrieve_by("okapi_bm"),
    "retrieve_laplace": retrieve_by("laplace"),
    "retrieve_jm": retrieve_by("jm"),
    "retrieve_all_models": retrieve_all_models,
    "retrieve_top_k": retrieve_by("okapi_bm", SHALLOW_K),
    "custom_scorer": custom_scorer,
    "tiny_scorer": tiny_scorer,
    "run_lines": run_lines,
    "run_files": run_files,
    "run_append": run_append,
    "judged_only": judged_only,
    "topic_split": topic_split,
    "train_topics": train_split,
    "pair_lengths": judged_lengths,
    "feature_table_train": features_of("train"),
    "feature_table_test": features_of("test"),
    "ltr_rf_classifier_test": ranked_by("rf_classifier", "test"),
    "ltr_rf_classifier_train": ranked_by("rf_classifier", "train"),
    "ltr_rf_regressor_test": ranked_by("rf_regressor", "test"),
    "ltr_rf_regressor_train": ranked_by("rf_regressor", "train"),
    "ltr_linear_test": ranked_by("linear", "test"),
    "ltr_linear_train": ranked_by("linear", "train"),
    "ltr_run_files": ltr_run_files,
    "ltr_small_classifier": small_forest("classifier"),
    "ltr_small_regressor": small_forest("regressor"),
    "ltr_small_run_files": small_forest_run_files,
}
