"""Shards against draws in plain Python; growth and weights move only what they may."""

import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F

from trawl.llm import sharding
from trawl.llm.sharding import even_tree, grown, place, read_shards, write_shards

TREE = {
    "a": {"x": {0: 1.0, 1: 2.0}, "y": {2: 1.0}},
    "b": {"x": {3: 1.0, 4: 0.0, 5: 3.0}, "z": {6: 0.5}},
    "empty": {"x": {7: 0.0}},
}


def draw(name, key, weight):
    number = int(hashlib.md5(f"{name}:{key}".encode()).hexdigest()[:12], 16)
    return -math.log((number + 0.5) / 16**12) / weight


def by_hand(key, tree):
    key = "" if key is None else str(key)
    regions = {r: sum(sum(s.values()) for s in racks.values()) for r, racks in tree.items()}
    region = min((draw(r, key, w), r) for r, w in regions.items() if w)[1]
    racks = {k: sum(s.values()) for k, s in tree[region].items()}
    rack = min((draw(f"{region}/{k}", key, w), k) for k, w in racks.items() if w)[1]
    return min((draw(f"{region}/{rack}/{s}", key, w), s) for s, w in tree[region][rack].items() if w)[1]


def places(spark, tree, n=4000):
    rows = spark.range(n).select("id", place(F.col("id"), tree).alias("shard")).collect()
    return {r.id: r.shard for r in rows}


def test_descent_is_that_of_the_draws(spark):
    rows = spark.createDataFrame([(None,), (-5,), *((i,) for i in range(500))], "id long")
    got = rows.select("id", place(rows.id, TREE).alias("shard")).collect()
    assert {r.id: r.shard for r in got} == {i: by_hand(i, TREE) for i in [None, -5, *range(500)]}


def test_shares_follow_weights(spark):
    found = list(places(spark, TREE, 20_000).values())
    total = 8.5
    for shard, weight in ((0, 1), (1, 2), (2, 1), (3, 1), (5, 3), (6, 0.5)):
        assert abs(found.count(shard) / len(found) - weight / total) < 0.015
    assert not {4, 7} & set(found)


def test_a_further_shard_takes_rows_only_into_itself(spark):
    trees = [even_tree(40)]
    for _ in range(3):
        trees.append(grown(trees[-1]))
    found = [places(spark, t) for t in trees]
    assert set(found[0].values()) == set(range(40))
    for n, (before, after) in enumerate(zip(found, found[1:]), start=40):
        moved = [k for k in before if before[k] != after[k]]
        assert moved and {after[k] for k in moved} == {n}


def test_a_weight_moves_rows_only_through_its_subtree(spark):
    heavier = {**TREE, "a": {**TREE["a"], "y": {2: 4.0}}}
    region = {0: "a", 1: "a", 2: "a", 3: "b", 4: "b", 5: "b", 6: "b"}
    before, after = places(spark, TREE), places(spark, heavier)
    moved = [k for k in before if before[k] != after[k]]
    assert moved and {region[after[k]] for k in moved} == {"a"}
    assert {after[k] for k in moved if region[before[k]] == "a"} == {2}


def test_bad_trees_are_refused():
    with pytest.raises(ValueError):
        sharding.levels_of({"a": {"x": {0: -1.0}}})
    with pytest.raises(ValueError):
        sharding.levels_of({"a": {"x": {0: 0.0}}})


@pytest.mark.parametrize("per_part", [20_000, 7])
def test_slots_number_whole_shards_in_order(spark, tmp_path, monkeypatch, per_part):
    monkeypatch.setattr(sharding, "ROWS_PER_PART", per_part)
    texts = [None, "", "a", "é" * 10, "x" * 200_000]
    rows = [(i, texts[i % 5], 1, 2) for i in range(200)] + [(3, "same", 1, 2)] * 100 + [(3, "other", 1, 2)] + [(None, t, 1, 2) for t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, slot int").repartition(5)
    schema = write_shards(docs, str(tmp_path / "shards"), TREE)
    back = read_shards(spark, str(tmp_path / "shards"), schema)
    assert set(back.columns) == {"doc_id", "text", "shard", "slot"}
    found = {}
    for r in back.collect():
        data = (r.text or "").encode()
        found.setdefault(r.shard, []).append((r.slot, (r.doc_id is not None, r.doc_id or 0, len(data), zlib.crc32(data)), r.doc_id, r.text))
    for shard, held in found.items():
        held.sort(key=lambda x: x[0])
        assert [x[0] for x in held] == list(range(len(held)))
        assert [x[1] for x in held] == sorted(x[1] for x in held)
        assert all(by_hand(x[2], TREE) == shard for x in held)
    whole = sorted(((x[2], x[3]) for held in found.values() for x in held), key=repr)
    assert whole == sorted(((r[0], r[1]) for r in rows), key=repr)


def test_no_rows(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    schema = write_shards(docs, str(tmp_path / "none"), TREE)
    assert read_shards(spark, str(tmp_path / "none"), schema).collect() == []
