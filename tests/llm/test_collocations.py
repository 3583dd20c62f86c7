"""Phrases against counts of all n-grams in plain Python, for several cuts into shards."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from trawl.llm import collocations as module
from trawl.llm.collocations import collocations, local_support

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(docs, least, first, percent):
    f, total = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for size in (1, 2, 3):
                f.setdefault(lang, Counter()).update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        rows = []
        for p, a in counts.items():
            if len(p) < 2 or a < least:
                continue
            cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if not any(100 * b >= percent * a and p in (q[:2], q[1:]) for q, b in counts.items() if len(q) == 3 and len(p) == 2 and b >= least):
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, total[lang], -s) for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:first], 1)]
    return sorted(out)


def answer(spark, docs, *settings):
    rows = spark.createDataFrame([(i, t, lang, 5, "x") for i, (lang, t) in enumerate(docs)], "doc_id long, text string, lang string, n int, phrase string")
    return sorted(tuple(r) for r in collocations(rows.repartition(3), *settings).collect())


@pytest.fixture(scope="module")
def docs():
    draw = random.Random(8)
    vocabulary = [f"W{i}" if i % 7 else f"é{i}" for i in range(25)]
    weights = [1 / (i + 1) for i in range(25)]
    out = []
    for i in range(250):
        words = draw.choices(vocabulary, weights, k=draw.randint(0, 60))
        text = "".join(w + draw.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b", " \x01 "]) for w in words)
        out.append((draw.choice(["en", "en", "en", "de", None, "und", ""]), text))
    out += [("en", None), ("en", ""), ("de", "..;\n"), (None, " \t "), ("fr", "one two three. " * 12), ("fr", "a a a a a " * 30)]
    return out + [("en", "New York City hall! " * 40)] * 3


@pytest.mark.parametrize("shard, segment", [(2_000_000, 4 << 20), (700, 50), (50, 10)])
@pytest.mark.parametrize("least, first, percent", [(10, 2000, 50), (4, 30, 90)])
def test_same_as_counting_everything(spark, docs, monkeypatch, shard, segment, least, first, percent):
    monkeypatch.setattr(module, "SHARD_WORDS", shard)
    monkeypatch.setattr(module, "SEGMENT_BYTES", segment)
    assert answer(spark, docs, least, first, percent) == by_hand(docs, least, first, percent)


def test_unknown_languages_and_small_slices(spark, docs, monkeypatch):
    monkeypatch.setattr(module, "KNOWN_LANGUAGES", 1)
    monkeypatch.setattr(module, "RANKED_ROWS", 40)
    monkeypatch.setattr(module, "SHARD_WORDS", 500)
    assert answer(spark, docs, 5, 10, 50) == by_hand(docs, 5, 10, 50)


def test_a_full_bitmap_only_lets_more_through(spark, docs, monkeypatch):
    monkeypatch.setattr(module, "MOST_BITS", 1 << 16)
    monkeypatch.setattr(module.Bitmap, "may_hold", lambda self, hashes: np.ones(len(hashes), dtype=bool))
    assert answer(spark, docs, 10, 2000, 50) == by_hand(docs, 10, 2000, 50)


def test_local_supports_miss_no_frequent_phrase():
    draw = random.Random(1)
    for _ in range(300):
        sizes = [draw.randint(1, 1000) for _ in range(draw.randint(1, 15))]
        total, least = sum(sizes), draw.randint(1, 40)
        lowered = [local_support(least, n, total) for n in sizes]
        assert sum(s - 1 for s in lowered) < least and all(1 <= s <= least for s in lowered)


def test_bitmaps_hold_what_they_were_given(spark):
    draw = np.random.default_rng(3)
    hashes = draw.integers(0, 1 << module.HASH_BITS, 5000)
    bitmap = module.bitmap_of(spark.createDataFrame([(int(h),) for h in hashes], "h long"))
    assert bitmap.may_hold(hashes.astype(np.uint64)).all()
    assert bitmap.may_hold(draw.integers(0, 1 << module.HASH_BITS, 20_000).astype(np.uint64)).mean() < 0.1


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    found = collocations(docs)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and found.collect() == []
