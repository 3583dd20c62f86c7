"""Score every topic against the whole collection and keep the best documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from trawl.functions.scoring import MODELS, Scorer, scorer
from trawl.operators.postings import clean_topics, topic_terms
from trawl.operators.scoring import (
    match_postings,
    rank_hits,
    score_pairs,
    weigh_topic_terms,
    with_topic_sums,
)
from trawl.plans.indexing import Index

# Fixed value: hits kept per topic and model.
TOP_K = 15_000


def weighed_terms(index: Index, topics: DataFrame) -> DataFrame:
    """Terms of raw ``qid, text`` topics with their collection statistics.

    Kept in memory: a few rows per topic, used by several steps of one retrieval.
    """
    cleaned = clean_topics(topics, index.stop_words)
    terms = topic_terms(cleaned, index.stop_words, index.stem).persist()
    return weigh_topic_terms(terms, index.terms).persist()


def score(index: Index, weighed: DataFrame, models: Sequence[str | Scorer]) -> DataFrame:
    """Candidates with one score column per model."""
    scorers = [m if isinstance(m, Scorer) else scorer(m) for m in models]
    collection = index.collection()
    matches = match_postings(
        index.postings, weighed, with_topic_sums(weighed, scorers, collection)
    )
    return score_pairs(matches, scorers, collection)


def retrieve(
    index: Index,
    topics: DataFrame,
    models: Sequence[str | Scorer] = MODELS,
    k: int = TOP_K,
) -> DataFrame:
    """``qid, docno, model, score, rank``: the best ``k`` documents per topic and model.

    All models share one scan of the postings and one grouping.
    """
    scorers = [m if isinstance(m, Scorer) else scorer(m) for m in models]
    digits = {s.name: s.digits for s in scorers}
    scored = score(index, weighed_terms(index, topics), scorers)
    return rank_hits(scored, list(digits), k, index.buckets, digits)
