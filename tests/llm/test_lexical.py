"""The best documents against scores of all pairs in plain Python."""

import math
import random
import re
from collections import Counter

import pytest

from trawl.llm import lexical
from trawl.llm.lexical import search

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return WORD.findall((text or "").translate(LOWER))


def by_hand(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, query in asked.items():
        scores = []
        for i, c in held:
            m = 75 + (25 * sum(c.values()) * n) // length
            s = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, times in query.items() if t in c
            )
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def answer(spark, docs, items, k, parts=3):
    docs = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, rank int, item_id string").repartition(parts)
    items = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id int")
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in search(docs, items, k).collect()), key=repr)


def texts(seed, n):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    return [" ".join(draw.choices(vocabulary, weights, k=draw.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("tree_docs, block", [(20_000, 500_000), (7, 40)])
def test_same_as_all_pairs(spark, monkeypatch, tree_docs, block):
    monkeypatch.setattr(lexical, "TREE_DOCS", tree_docs)
    monkeypatch.setattr(lexical, "BLOCK_ENTRIES", block)
    docs = list(enumerate(texts(1, 300)))
    docs += [(1000 + i, docs[5][1]) for i in range(60)] + [(None, docs[5][1]), (3, docs[7][1]), (9, docs[5][1]), (9, docs[5][1])]
    docs += [(2000, None), (2001, ""), (2002, "...!"), (2003, "W1 w1,É;é w2_w3 " * 3000), (2004, "É"), (2005, "a\x00b\x7fc")]
    items = [(i, t + (" é É w2" if i % 3 else " " + t)) for i, t in enumerate(texts(2, 12))]
    items += [(50, None), (51, ""), (52, "unheard of"), (3, "w1 more of item three"), (None, "w9 w8"), (None, "w7"), (53, "a b"), (54, "É w2003")]
    assert answer(spark, docs, items, 5) == by_hand(docs, items, 5)


def test_long_lists_and_few_documents(spark):
    docs, items = list(enumerate(texts(3, 12))), list(enumerate(texts(4, 6)))
    assert answer(spark, docs, items, 20) == by_hand(docs, items, 20)


def test_trees_prune_but_lose_nothing(monkeypatch):
    """Fewer documents are scored than there are, and the result is that of scoring all."""
    import numpy as np

    draw = np.random.default_rng(5)
    n_docs, n_terms, k = 3000, 40, 10
    chance = 0.8 / (1 + np.arange(n_terms) / 3)
    held = draw.random((n_docs, n_terms)) < chance
    tf = draw.integers(1, 6, (n_docs, n_terms))
    m = draw.integers(75, 400, n_docs)
    starts = lexical._starts(held.sum(axis=1))
    ranks = np.nonzero(held)[1]
    tree = lexical.Tree(list(range(n_docs)), m, starts, ranks, tf[held], n_terms, k)
    scored = []
    plain = tree.score
    monkeypatch.setattr(tree, "score", lambda *a: scored.append(a[0]) or plain(*a))
    query, weights = np.array([2, 8, 20, 31, 39]), np.array([300, 900, 2000, 2500, 3000])
    got = tree.search(query, weights, [], k)
    gains = np.where(held, lexical.gain(tf, m[:, None]), 0)
    want = sorted((-int(s), (False, i)) for i, s in enumerate((gains[:, query] * weights).sum(axis=1)))[:k]
    assert got == want and len(scored) < n_docs / 4


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "b")], [(1, "a")])])
def test_nothing_to_find(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    found = search(docs, items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []
