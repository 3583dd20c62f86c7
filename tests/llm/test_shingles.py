"""The shingle join against comparing all pairs, and its defined cases."""

import random

import pytest

from pyspark.sql import functions as F

from trawl.llm import jaccard
from trawl.llm.jaccard import Rule, keep_one, similar_components

SCHEMA = "doc_id long, text string, n_shingles string, id int"


def by_brute_force(rows, words=3, num=9, den=10):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())

    sets = {i: shingles(t) for i, t, *_ in rows}
    links = {i: [] for i in sets}
    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            common = len(sets[i] & sets[j])
            if common and den * common >= num * len(sets[i] | sets[j]):
                links[i].append(j)
                links[j].append(i)
    seen = {}
    for start in ids:
        waiting = [start]
        while waiting:
            at = waiting.pop()
            if at not in seen:
                seen[at] = start
                waiting += links[at]
    return {i: (len(sets[i]), seen[i]) for i in ids}


def answer(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def varied(n, seed, vocabulary=400):
    """Texts of many sizes, each with some of its words changed in later ones."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    texts = []
    for i in range(n):
        if texts and rng.random() < 0.6:
            own = rng.choice(texts).split()
            for _ in range(rng.randrange(1 + len(own) // 12)):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.3:
                own = own[rng.randrange(3) :] + rng.choices(words, k=rng.randrange(3))
        else:
            own = rng.choices(words, k=rng.choice([1, 2, 3, 5, 9, 20, 40, 80, 150]))
        texts.append(" ".join(own) or "x")
    return [(i, t, "x", 1) for i, t in enumerate(texts)]


@pytest.mark.parametrize("heavy,block", [(1, 4096), (32, 4096), (1, 2), (8192, 3)])
@pytest.mark.parametrize("rule", [(3, 9, 10), (5, 4, 5)])
def test_same_as_all_pairs(spark, rule, heavy, block):
    rows = varied(250, seed=heavy)
    want = by_brute_force(rows, *rule)
    assert len({c for _, c in want.values()}) < 0.9 * len(rows)
    words, num, den = rule
    assert answer(similar_components(spark.createDataFrame(rows, SCHEMA), words=words, num=num, den=den, heavy_members=heavy, block=block)) == want


def test_similarity_at_the_limit(spark):
    # 19 of 20 words alike in a row of 12 shingles; 9/10 exactly links, less does not.
    base = [f"a{i}" for i in range(21)]
    rows = [(1, " ".join(base), "", 1), (2, " ".join(base[:-1]), "", 1), (3, " ".join(base[2:]), "", 1), (4, " ".join(base[3:]), "", 1)]
    assert answer(similar_components(spark.createDataFrame(rows, SCHEMA))) == by_brute_force(rows)


def test_defined_cases(spark):
    long = " ".join(f"t{i % 5000}" for i in range(60_000))
    rows = [
        (5, None, None, None), (6, "", "", 1), (7, " \t\n\x0b\x0c\r", "", 1), (8, "One", "", 1), (9, "one", "", 1), (10, "one two", "", 1), (11, "ONE\ttwo", "", 1),
        (12, "É x y", "", 1), (13, "é x y", "", 1), (14, long, "", 1), (15, long + " end", "", 1), (16, "a b c", "", 1), (17, "a b c", "", 1),
    ]
    got = answer(similar_components(spark.createDataFrame(rows + [(None, "one", "", 1)], SCHEMA)))
    assert got.pop(None) == (1, None)
    assert got == by_brute_force(rows)
    assert got[9] == (1, 8) and got[13] == (1, 13) and got[15][1] == 14
    assert answer(similar_components(spark.createDataFrame([], SCHEMA))) == {}


def test_keep_one_keeps_rows_and_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(3, text, "a", 1), (2, text, "b", 2), (2, text, "b", 2), (4, "other text here", "c", 3), (None, text, "d", 4), (5, None, "e", 5)]
    got = keep_one(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "n_shingles", "id"]
    assert sorted((r.doc_id, r.n_shingles) for r in got.collect() if r.doc_id) == [(2, "b"), (4, "c"), (5, "e")]
    assert got.where("doc_id IS NULL").count() == 1


def test_keep_one_drops_rows_for_their_own_text(spark):
    copied, other, third = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, copied, "a", 1), (2, copied, "b", 1), (2, other, "c", 1), (2, other, "c", 1), (2, None, "d", 1), (3, other + " end", "e", 1), (4, third, "f", 1)]
    got = keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.n_shingles) for r in got) == [(1, "a"), (2, "c"), (2, "d"), (4, "f")]


def near_family(n, seed, changes):
    """Texts that differ from one text in a few words each: many pairs just miss the limit."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randrange(changes)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(30)}"
        out.append((i, " ".join(own), "x", 1))
    return out


@pytest.mark.parametrize("heavy,block", [(8192, 4096), (8192, 7), (5, 7)])
def test_a_family_around_the_limit(spark, heavy, block):
    rows = near_family(150, 3, 6)
    want = by_brute_force(rows)
    assert 5 < len({c for _, c in want.values()}) < len(rows)
    assert answer(similar_components(spark.createDataFrame(rows, SCHEMA), heavy_members=heavy, block=block)) == want


def test_few_pairs_leave_the_buckets(spark):
    """Pairs that differ too much are told apart inside the cell."""
    rule, rows = Rule(), near_family(300, 4, 12)
    texts = spark.createDataFrame([(i, t) for i, t, *_ in rows], "id long, text string")
    indexed = texts.mapInArrow(jaccard._index(rule), "id long, size long, digest binary, sketch binary, small binary").cache()
    bucket = texts.select(F.lit(1).cast("long").alias("key"), "id", F.col("id").alias("top"), F.lit("light").alias("role"))
    found = {(r.a, r.b) for r in jaccard._candidates(bucket, indexed, rule, 50).collect()}
    hashes = jaccard.WordHashes()
    sets = [rule.shingles(t, hashes) for _, t, *_ in rows]
    similar = {(a, b) for b in range(len(sets)) for a in range(b) if rule.similar(sets[a], sets[b])}
    assert similar <= found and len(found) < 2 * len(similar) + 50


def test_size_bands_hold_every_similar_pair():
    for num, den in ((9, 10), (4, 5)):
        rule = Rule(3, num, den)
        for size in range(1, 400):
            for other in range(size, size * den // num + 1):
                most = size + other - 2 * -(-num * (size + other) // (num + den))
                shared = set(rule.instances(size)) & set(rule.instances(other))
                assert most <= 0 or any(segments > differ >= most for _, differ, segments in shared)
