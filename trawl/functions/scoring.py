"""Retrieval models as column expressions, and the registry that names them.

A model is a :class:`Scorer`: an expression for one matched term, summed over the
matched terms of a (topic, document) pair, and optionally an expression summed over all
terms of the topic and one that combines both sums into the score. Columns in scope:

* ``match``: ``tf``, ``doclength``, ``qtf``, ``df``, ``ttf``;
* ``topic``: ``qtf``, ``df``, ``ttf``;
* ``total``: ``doclength``, and the two sums as arguments.

The smoothed language models are sums over every topic term, matched or not. Written as
"what an unmatched term would give" plus "what a match changes", only matched terms
need a row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Constants of the models.
OKAPI_TF_BASE = 0.5
OKAPI_TF_LENGTH = 1.5
BM25_K1 = 1.2
BM25_K2 = 100.0
BM25_B = 0.75
JM_LAMBDA = 0.5


@dataclass(frozen=True)
class Collection:
    """Collection statistics, one number each."""

    n_docs: int
    avg_dl: float
    sum_dl: int
    vocab: int


@dataclass(frozen=True)
class Scorer:
    name: str
    match: Callable[[Collection], Column]
    topic: Callable[[Collection], Column] | None = None
    total: Callable[[Collection, Column, Column], Column] | None = None
    # Decimal places by which hits are ordered; a scorer of small values asks for more.
    digits: int = 6

    def score(self, collection: Collection, matched: Column, topic: Column) -> Column:
        if self.total is None:
            return matched
        return self.total(collection, matched, topic)


_registry: dict[str, Scorer] = {}


def register(scorer: Scorer) -> Scorer:
    """Make a scorer available to retrieval under its name."""
    _registry[scorer.name] = scorer
    return scorer


def scorer(name: str) -> Scorer:
    if name not in _registry:
        raise KeyError(f"no scorer named {name!r}; registered: {sorted(_registry)}")
    return _registry[name]


def rounded(score: Column, digits: int) -> Column:
    """Scores that differ by the order of summation alone become equal."""
    return F.rint(score * 10.0**digits) / 10.0**digits


def _okapi_weight(c: Collection) -> Column:
    tf = F.col("tf")
    length = F.col("doclength") / F.lit(c.avg_dl)
    return tf / (tf + OKAPI_TF_BASE + OKAPI_TF_LENGTH * length)


def _okapi_tf(c: Collection) -> Column:
    return F.col("qtf") * _okapi_weight(c)


def _tf_idf(c: Collection) -> Column:
    return F.col("qtf") * _okapi_weight(c) * F.log(F.lit(c.n_docs) / F.col("df"))


def _okapi_bm(c: Collection) -> Column:
    tf, qtf = F.col("tf"), F.col("qtf")
    length = (1 - BM25_B) + BM25_B * F.col("doclength") / F.lit(c.avg_dl)
    idf = F.log((F.lit(c.n_docs) + 0.5) / (F.col("df") + 0.5))
    in_document = tf * (BM25_K1 + 1) / (tf + BM25_K1 * length)
    in_topic = qtf * (BM25_K2 + 1) / (qtf + BM25_K2)
    return idf * in_document * in_topic


def laplace() -> Scorer:
    def total(c: Collection, matched: Column, n_terms: Column) -> Column:
        return matched - n_terms * F.log(F.col("doclength") + F.lit(c.vocab))

    return Scorer(
        "laplace",
        match=lambda c: F.col("qtf") * F.log(F.col("tf") + 1.0),
        topic=lambda c: F.col("qtf").cast("double"),
        total=total,
    )


def jelinek_mercer(lam: float = JM_LAMBDA, name: str = "jm") -> Scorer:
    def background(c: Collection) -> Column:
        return (1 - lam) * F.col("ttf") / F.lit(float(c.sum_dl))

    def match(c: Collection) -> Column:
        in_document = lam * F.col("tf") / F.col("doclength")
        return F.col("qtf") * F.log(1 + in_document / background(c))

    return Scorer(
        name,
        match=match,
        topic=lambda c: F.col("qtf") * F.log(background(c)),
        total=lambda c, matched, unmatched: matched + unmatched,
    )


MODELS = ("okapi_tf", "tf_idf", "okapi_bm", "laplace", "jm")

register(Scorer("okapi_tf", _okapi_tf))
register(Scorer("tf_idf", _tf_idf))
register(Scorer("okapi_bm", _okapi_bm))
register(laplace())
register(jelinek_mercer())
