"""Ranked text retrieval and learning to rank, written as Spark DataFrame jobs."""

from trawl.plans.indexing import Index, build_index, index_corpus, merge_segments, open_index, update_index
from trawl.plans.learning import learn_and_rank
from trawl.plans.retrieval import retrieve

__all__ = [
    "Index",
    "build_index",
    "index_corpus",
    "learn_and_rank",
    "merge_segments",
    "open_index",
    "retrieve",
    "update_index",
]
