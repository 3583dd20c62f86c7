"""Contamination against a plain scan, by every way of matching, and the pipeline."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trawl.llm import decontaminate
from trawl.llm.decontaminate import contamination, drop_contaminated, remove_spans

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, hits string, n_words int"
ITEM = " ".join(f"Q{i}" for i in range(20))
ITEMS = [(1, ITEM), (2, "short Item here"), (3, None), (4, ""), (5, "..."), (6, "q3 q4 q5"), (2, "short item, here!"), (10, "é É x")]
TEXTS = [
    None, "", "nothing of it", ITEM, f"a {ITEM} b", " ".join(f"q{i}" for i in range(12)), "a short item-here" * 1, "Short. ITEM! here", "é É x", "É é x",
    "q3 q4 q5 " * 4, " ".join(["w"] * 100) + " q3 q4 q5", " ".join(["w"] * 50) + " q3 q4 q5", "q3 " * 20_000 + ITEM, ITEM, "q3\x00q4\x7fq5", "q3 q4 q5 q3 q4 q5",
]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def by_brute_force():
    windows = set()
    for item, text in ITEMS:
        w = words(text)
        n = min(13, len(w))
        windows |= {(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1)} if n else set()
    out = {}
    for i, text in enumerate(TEXTS):
        w, hit, items = words(text), set(), set()
        for item, window in windows:
            for at in range(len(w) - len(window) + 1):
                if tuple(w[at : at + len(window)]) == window:
                    hit |= set(range(at, at + len(window)))
                    items.add(str(item))
        out[i] = (len(w), len(hit), sorted(items), bool(hit) and 20 * len(hit) >= len(w), [x for k, x in enumerate(w) if k not in hit])
    return out


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(TEXTS)], DOCS)
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


# In the expression, by broadcast hashes, by a shuffle; the last with the smallest blocks
# and no room for any other broadcast.
WAYS = {"set": (20_000, 4_000_000, 4096, 64 << 20), "hashes": (0, 4_000_000, 4096, 64 << 20), "shuffle": (0, 0, 4096, 64 << 20), "least": (0, 0, 1, -1)}


@pytest.fixture(params=WAYS)
def options(request, monkeypatch):
    set_grams, most_hashes, block, most_bytes = WAYS[request.param]
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", most_bytes)
    return {"set_grams": set_grams, "most_hashes": most_hashes}


def test_same_as_a_plain_scan(tables, options):
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in contamination(*tables, **options).collect()}
    assert got == {i: w[:4] for i, w in by_brute_force().items()}


def test_windows_meet_broadcast_hashes_where_their_text_lies(spark, tables):
    docs = tables[0].withColumn("__row", F.monotonically_increasing_id())
    kept = decontaminate._with_words(docs, "text")
    hashes = F.broadcast(spark.range(5).select(F.col("id").alias("hash")))
    windows = decontaminate._windows(kept, 13).withColumn("hash", F.xxhash64("gram"))
    plan = windows.join(hashes, "hash", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_words_and_rows_of_the_table_itself(spark, tables):
    docs = tables[0].withColumnRenamed("hits", "words").withColumn("gram", F.lit(1))
    assert contamination(docs, tables[1], set_grams=0).where("contaminated").count() == sum(w[3] for w in by_brute_force().values())
    assert drop_contaminated(docs, tables[1], set_grams=0).columns == docs.columns


def test_documents_and_spans_go(tables):
    want = by_brute_force()
    kept = drop_contaminated(*tables)
    assert kept.columns == tables[0].columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, w in want.items() if not w[3]]
    assert {r.doc_id for r in drop_contaminated(*tables, set_grams=0).collect()} == {r.doc_id for r in kept.collect()}
    assert {r.doc_id: r.clean_words for r in remove_spans(*tables).collect()} == {i: w[4] for i, w in want.items()}


def test_empty_tables(spark, tables):
    docs, items = tables
    assert contamination(docs.limit(0), items).collect() == []
    assert {r.n_hit for r in contamination(docs, items.limit(0)).collect()} == {0}


def test_pipeline_stages_keep_columns_and_decide(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, ids = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert all(b <= a for a, b in zip(ids, ids[1:])) and len(ids[3]) < len(ids[0])
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == ids[3]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).collect() == []
