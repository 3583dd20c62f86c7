"""Near-duplicate vectors against all pairs, and their defined cases."""

import numpy as np
import pytest

from trawl.llm.near_vectors import cut, link_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def by_brute_force(rows):
    """(links, component) of every id by comparing all pairs."""
    def unit(v):
        if not v or None in v:
            return None
        v = np.array(v, dtype=float)
        return v / np.sqrt((v * v).sum()) if np.isfinite(v).all() and v.any() else None

    units = {i: unit(v) for i, v, *_ in rows}
    links = {i: [j for j, w in units.items() if j != i and w is not None and units[i] is not None and len(w) == len(units[i]) and units[i] @ w >= 0.95] for i in units}
    seen = {}
    for start in sorted(links):
        waiting = [start]
        while waiting:
            at = waiting.pop()
            if at not in seen:
                seen[at] = start
                waiting += links[at]
    return {i: (len(links[i]), seen[i], seen[i] == i) for i in links}


def answer(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def clusters(n, seed=1, noise=0.025, d=32):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (n // 6, d))
    return [(i, (centres[i % len(centres)] + rng.normal(0, noise * (1 + i % 8), d)).astype("float32").tolist(), 0, "x") for i in range(n)]


def test_links_are_those_of_all_pairs(spark):
    rows = clusters(600)
    want = by_brute_force(rows)
    assert sum(v[0] for v in want.values()) > 500
    assert answer(link_vectors(spark.createDataFrame(rows, SCHEMA), per_list=40, block=64)) == want


def test_one_group_of_copies_and_near_copies_is_whole(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(0, 1, 16)
    rows = [(i, centre.astype("float32").tolist(), 0, "") for i in range(300)]
    rows += [(1000 + i, (centre + rng.normal(0, 0.01, 16)).astype("float32").tolist(), 0, "") for i in range(200)]
    rows += [(5000 + i, rng.normal(0, 1, 16).astype("float32").tolist(), 0, "") for i in range(50)]
    assert answer(link_vectors(spark.createDataFrame(rows, SCHEMA), per_list=100, block=64)) == by_brute_force(rows)


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 0, ""), (2, [], 0, ""), (3, [0.0, 0.0], 0, ""), (4, [1.0, None], 0, ""), (5, [nan, 1.0], 0, ""), (6, [inf, 1.0], 0, ""),
        (7, [1.0, 1.0], 0, ""), (8, [2.0, 2.0], None, None), (9, [1.0, 1.0, 0.0], 0, ""), (10, [1e-30, 1e-30], 0, ""),
    ]
    got = answer(link_vectors(spark.createDataFrame(rows, SCHEMA)))
    assert got == by_brute_force(rows) and got[7] == (2, 7, True) and got[9] == (0, 9, True)


def test_repeated_ids_null_ids_and_no_rows(spark):
    rows = [(1, [1.0, 0.0], 0, ""), (1, [1.0, 0.0], 0, ""), (None, [1.0, 0.0], 0, "")]
    got = [tuple(r) for r in link_vectors(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == [(1, 1, 1, True)] * 2 + [(None, 0, None, None)]
    assert link_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("block", [2, 1000])
def test_blocks_do_not_change_the_result(spark, block):
    rows = clusters(60, seed=9)
    assert answer(link_vectors(spark.createDataFrame(rows, SCHEMA), per_list=20, block=block)) == by_brute_force(rows)


def test_low_rank_vectors_in_a_hot_cluster_keep_links_over_borders(spark):
    rng = np.random.default_rng(5)
    d, n = 384, 900
    plane, hot = rng.normal(0, 1, (4, d)) / np.sqrt(d), rng.normal(0, 1, d) / np.sqrt(d)
    close = hot + rng.normal(0, 0.35, (n // 3, 4)) @ plane
    rest = rng.normal(0, 1, (n - n // 3, d)) / np.sqrt(d)
    rows = [(i, v.astype("float32").tolist(), 0, "") for i, v in enumerate(np.concatenate([close, rest]))]
    want = by_brute_force(rows)
    assert sum(v[0] for v in want.values()) > 1000
    assert answer(link_vectors(spark.createDataFrame(rows, SCHEMA), per_list=20, block=64)) == want


def test_ragged_vectors_of_very_many_lengths(spark):
    rng = np.random.default_rng(7)
    rows = []
    for n in range(1, 90):
        centre = rng.normal(0, 1, n)
        rows += [(10 * n + i, (centre + rng.normal(0, 0.05, n)).astype("float32").tolist(), 0, "") for i in range(4)]
    rows += [(5000 + r[0], *r[1:]) for r in clusters(120, seed=11, d=40)]
    want = by_brute_force(rows)
    assert sum(v[0] for v in want.values()) > 800
    assert answer(link_vectors(spark.createDataFrame(rows, SCHEMA), per_list=30, block=64)) == want


def test_vectors_near_all_borders_are_not_stored_once_for_each_list(spark, monkeypatch):
    """Every list is searched by most vectors; what is shuffled stays a few times the vectors."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle"))

    rng = np.random.default_rng(13)
    n, d = 6000, 64
    rows = [(i, v, 0, "") for i, v in enumerate(rng.normal(0, 1, (n, d)).astype("float32").tolist())]
    vectors = spark.createDataFrame(rows, SCHEMA).cache()
    vectors.count()
    sizes = []

    def none(links):
        sizes.append(shuffled())
        return spark.createDataFrame([], "node long, component long")

    monkeypatch.setattr("trawl.llm.near_vectors.components", none)
    before = shuffled()
    link_vectors(vectors, per_list=200).collect()
    assert max(sizes) - before < 4 * n * d * 4


def test_files_hold_whole_lists_or_pieces_of_one():
    starts, pieces = cut(np.array([3, 0, 4, 25, 2, 8, 1]), 10)
    assert starts.tolist() == [0, 0, 0, 1, 4, 4, 5] and pieces.tolist() == [1, 1, 1, 3, 1, 1, 1]


def test_one_list_over_many_files_meets_itself_in_all_of_them(spark):
    rng = np.random.default_rng(17)
    centre = rng.normal(0, 1, 24)
    rows = [(i, (centre + rng.normal(0, 0.12 + 0.04 * (i % 5), 24)).astype("float32").tolist(), 0, "") for i in range(400)]
    want = by_brute_force(rows)
    assert sum(v[0] for v in want.values()) > 5000
    assert answer(link_vectors(spark.createDataFrame(rows, SCHEMA), per_list=390, block=30)) == want


@pytest.mark.parametrize("kind", ["array<double>", "array<int>"])
def test_components_of_other_types(spark, kind):
    rows = [(1, [1.0, 2.0, -3.0], 0, ""), (2, [2.0, 4.0, -6.0], 0, ""), (3, [1.0, 0.0, 3.0], 0, ""), (4, [0.0, 0.0, 0.0], 0, "")]
    frame = spark.createDataFrame(rows, SCHEMA.replace("array<float>", "array<double>"))
    assert answer(link_vectors(frame.withColumn("embedding", frame.embedding.cast(kind)))) == by_brute_force(rows)
