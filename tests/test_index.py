import re

import pytest
from pyspark.sql import functions as F
from small import make_index, make_topics

from trawl import build_index, open_index, retrieve, storage, update_index
from trawl.operators import postings as postings_module
from trawl.operators.postings import (
    approximate_vocabulary,
    build_positions,
    build_postings,
    term_vectors,
)
from trawl.operators.scoring import bucket_of
from trawl.plans import indexing
from trawl.plans.indexing import forget_index, index_corpus
from trawl.plans.retrieval import MODELS, score, weighed_terms


def executed_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    return make_index(spark, str(tmp_path_factory.mktemp("index")), buckets=4)


def test_tables(index, rows):
    assert rows(index.documents, "docno", "doclength") == [
        ("d1", 4), ("d2", 5), ("d3", 2), ("d4", 0),
    ]
    assert ("d1", "apple", 2) in rows(index.postings, "docno", "term", "tf")
    assert rows(index.terms)[:3] == [("apple", 2, 3), ("banana", 2, 2), ("cherry", 2, 3)]


def test_empty_documents_count_in_the_statistics(index):
    assert index.stats.first().asDict() == {
        "n_docs": 4, "avg_dl": 11 / 4, "sum_dl": 11, "vocab": 6,
    }


def test_postings_add_up_to_the_tokens(index, rows):
    tf = sum(r[2] for r in rows(index.postings, "docno", "term", "tf"))
    assert tf == sum(r[2] for r in rows(index.terms, "term", "df", "ttf")) == 11


def test_positions(index, rows):
    vectors = build_positions(index.documents, [], stem=False)
    found = {(r.docno, r.term): (r.tf, r.positions) for r in vectors.collect()}
    assert found["d1", "apple"] == (2, [0, 2])
    assert found["d2", "elder"] == (1, [4])


def test_term_vector_lookup(index, rows):
    vector = term_vectors(index.postings.where("docno = 'd3'"), index.terms)
    assert rows(vector, "term", "tf", "df", "ttf") == [("apple", 1, 2, 3), ("fig", 1, 1, 1)]


def test_term_vectors_of_a_large_vocabulary(index, rows, monkeypatch):
    plain = rows(term_vectors(index.postings, index.terms), "docno", "term", "tf", "df", "ttf")
    monkeypatch.setattr(postings_module, "BROADCAST_ROWS", 0)
    for n_frequent in (1, 5, 1000):
        monkeypatch.setattr(postings_module, "FREQUENT_TERMS", n_frequent)
        vectors = term_vectors(index.postings, index.terms)
        assert rows(vectors, "docno", "term", "tf", "df", "ttf") == plain


def test_approximate_vocabulary(index):
    assert approximate_vocabulary(index.postings).first().vocab == 6


def test_an_index_reopens_after_its_tables_were_forgotten(spark, index, rows):
    before = rows(index.postings)
    forget_index(spark, index.path)
    again = open_index(spark, index.path)
    assert again.buckets == 4 and again.stop_words == [] and not again.stem
    assert rows(again.postings) == before
    plan = executed_plan(again.postings.groupBy("docno").count())
    assert "Exchange" not in plan


def test_slices_are_made_of_whole_buckets(index):
    name = F.col("_metadata.file_name")
    found = index.documents.select(
        bucket_of("docno", index.buckets).alias("computed"),
        F.regexp_extract(name, r"_(\d+)\.c\d+", 1).cast("int").alias("written"),
    ).collect()
    assert len({r.written for r in found}) > 1
    assert all(r.computed == r.written for r in found)


def test_postings_need_no_shuffle(index):
    plan = executed_plan(build_postings(index.documents, []))
    assert "Exchange" not in plan


def test_scoring_needs_no_shuffle_of_postings(spark, index):
    weighed = weighed_terms(index, make_topics(spark))
    plan = executed_plan(score(index, weighed, MODELS))
    scoring = plan[: plan.index("InMemoryRelation")]
    assert "BroadcastHashJoin" in scoring and "SortMergeJoin" not in scoring
    assert "Exchange hashpartitioning" not in scoring.split("BroadcastExchange")[0]


def test_topic_terms_reach_the_scan(spark, index):
    weighed = weighed_terms(index, make_topics(spark))
    plan = executed_plan(score(index, weighed, ["okapi_bm"]))
    assert re.search(r"PushedFilters: \[.*(In|EqualTo)\(term", plan)
    assert "text" not in re.search(r"ReadSchema: (\S+)", plan).group(1)


def test_stop_words_are_removed_twice_with_different_case_rules(spark, tmp_path, rows):
    index = make_index(
        spark, str(tmp_path / "i"), {"d1": "the The the, cat"}, stop_words=["the"]
    )
    assert rows(index.documents, "doclength") == [(3,)]
    assert rows(index.postings, "term", "tf") == [("cat", 1)]


def test_index_of_tagged_files(spark, tmp_path, rows):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "f").write_text(
        "<DOC>\n<DOCNO> AP890101-0001 </DOCNO>\n<TEXT>\nRunning dogs\n</TEXT>\n</DOC>\n"
        "<DOC>\n<DOCNO> AP890101-0002 </DOCNO>\n</DOC>\n"
    )
    index = index_corpus(spark, str(tmp_path / "c"), str(tmp_path / "i"), ["the"])
    assert rows(index.documents, "docno", "doclength") == [
        ("AP890101-0001", 2), ("AP890101-0002", 0),
    ]
    assert rows(index.terms, "term") == [("dog",), ("run",)]


@pytest.mark.parametrize("merge", [None, True, False])
@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_update_replaces_and_adds(spark, index, rows, tmp_path, monkeypatch, bound, merge):
    monkeypatch.setattr(indexing, "BROADCAST_ROWS", bound)
    raw = spark.createDataFrame(
        [("d1", "grape grape"), ("d5", "apple")], "docno string, text string"
    )
    updated = update_index(index, raw, str(tmp_path / "new"), merge=merge)
    assert updated.segments == (1 if merge is False else 0)
    assert rows(updated.documents, "docno", "doclength") == [
        ("d1", 2), ("d2", 5), ("d3", 2), ("d4", 0), ("d5", 1),
    ]
    assert ("apple", 2, 2) in rows(updated.terms) and ("grape", 1, 2) in rows(updated.terms)
    assert updated.collection().vocab == 7
    assert "Exchange hashpartitioning" not in executed_plan(updated.postings.groupBy("docno").count())
    with pytest.raises(ValueError):
        update_index(index, raw, index.path)


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_a_stop_table_of_any_size_equals_the_list(spark, tmp_path, rows, monkeypatch, bound):
    documents = {"d1": "the The the, cat  the", "d2": "", "d3": "the the", "d4": " dog\tof the\nhouse of ", "d5": "it's the cat's _the_"}
    stop = ["the", "of", "it"]
    unheard = spark.range(200_000).select(F.format_string("unheard%d", "id").alias("word"))
    table = spark.createDataFrame([(w,) for w in [*stop, "the"]], "word string").unionByName(unheard)
    topics = make_topics(spark, {1: "the cat of it", 2: "The dog", 3: ""})
    raw = spark.createDataFrame([*documents.items(), ("d6", None)], "docno string, text string")
    listed = build_index(raw, str(tmp_path / "list"), stop, buckets=2)
    monkeypatch.setattr(postings_module, "BROADCAST_ROWS", bound)
    build_index(raw, str(tmp_path / "table"), table, buckets=2)
    joined = open_index(spark, str(tmp_path / "table"))
    for name in ("documents", "postings", "terms"):
        assert sorted(map(str, getattr(joined, name).collect())) == sorted(map(str, getattr(listed, name).collect()))
    assert rows(postings_module.clean_topics(topics, table)) == rows(postings_module.clean_topics(topics, stop))
    assert rows(retrieve(joined, topics), "model", "qid", "docno", "rank") == rows(retrieve(listed, topics), "model", "qid", "docno", "rank")
    if bound:
        cleaned = postings_module.clean_documents(joined.documents, table)
        assert "Exchange hashpartitioning(docno" not in executed_plan(cleaned)


def test_segments_upon_segments_equal_a_whole_index(spark, tmp_path, rows):
    """Three updates: replaced, added, emptied and replaced again; terms vanish and return."""
    state = {f"d{i}": f"common w{i} w{i % 3}" for i in range(30)}
    updates = [
        {"d1": "w2 new", "d40": "common common"}, {"d1": "", "d2": "only here", "d41": "w1"}, {"d2": "w29 w2", "d40": "gone w1"},
    ]
    index = make_index(spark, str(tmp_path / "base"), state, buckets=3)
    for i, batch in enumerate(updates):
        state |= batch
        index = update_index(index, spark.createDataFrame(list(batch.items()), "docno string, text string"), str(tmp_path / f"u{i}"), merge=False)
        # Nothing but the update is written.
        assert spark.read.parquet(f"{index.path}/documents").count() == len(batch)
        assert spark.read.parquet(f"{index.path}/postings").count() < 3 * len(batch) + 1
    whole = make_index(spark, str(tmp_path / "whole"), state, buckets=3)
    merged = indexing.merge_segments(index, str(tmp_path / "merged"))
    assert index.segments == 3 and merged.segments == 0
    for found in (index, merged, open_index(spark, index.path)):
        for table in ("documents", "postings", "terms", "stats"):
            want = getattr(whole, table)
            assert rows(getattr(found, table), *want.columns) == rows(want)
    assert "Exchange hashpartitioning" not in executed_plan(index.postings.groupBy("docno").count())
    topics = make_topics(spark, {1: "common w1", 2: "w2 here", 3: "new"})
    hits = [rows(retrieve(i, topics, k=5), "model", "qid", "docno", "rank") for i in (index, whole)]
    assert hits[0] == hits[1]


def test_sketches_of_segments_are_united(spark, tmp_path):
    index = make_index(spark, str(tmp_path / "a"), {"d": " ".join(f"w{i}" for i in range(5000))}, buckets=2)
    assert abs(indexing.sketched_vocabulary(index).first().vocab - 5000) < 150
    batch = spark.createDataFrame([("e", " ".join(f"w{i}" for i in range(4000, 9000)))], "docno string, text string")
    updated = update_index(index, batch, str(tmp_path / "b"), merge=False)
    merged = indexing.merge_segments(updated, str(tmp_path / "c"))
    sizes = [indexing.sketched_vocabulary(i).first().vocab for i in (updated, merged)]
    assert all(abs(size - 9000) < 300 for size in sizes)


def test_the_last_of_repeated_ids_counts(spark, tmp_path, rows):
    raw = spark.createDataFrame(
        [("d1", "old", 1), ("d1", "new word", 2), ("d2", "two", 1)], "docno string, text string, v int"
    )
    first = build_index(raw, str(tmp_path / "a"), [], order="v")
    assert rows(first.documents, "docno", "doclength") == [("d1", 2), ("d2", 1)]
    batch = spark.createDataFrame([("d2", "now three words", 2), ("d2", "x", 1)], "docno string, text string, v int")
    second = update_index(first, batch, str(tmp_path / "b"), order="v")
    assert rows(second.documents, "docno", "doclength") == [("d1", 2), ("d2", 3)]
    assert second.collection().n_docs == 2
    with pytest.raises(ValueError):
        update_index(first, batch, str(tmp_path / "c"), merge=False)


def test_an_index_rebuilt_elsewhere_with_other_buckets_is_read_whole(spark, tmp_path):
    path = str(tmp_path / "index")
    many = {f"d{i}": "word" for i in range(50)}
    stale = make_index(spark, path, many, buckets=2)
    name = storage.table_name(storage.qualified(spark, path), "documents")
    make_index(spark, path, many, buckets=8)
    # What a session that built with two buckets still has in its catalog.
    spark.sql(f"DROP TABLE {name}")
    spark.sql(
        f"CREATE TABLE {name} (docno string, text string, doclength bigint) USING parquet"
        f" CLUSTERED BY (docno) SORTED BY (docno) INTO 2 BUCKETS LOCATION '{path}/documents'"
    )
    assert stale.buckets == 2
    opened = open_index(spark, path + "/")
    assert opened.buckets == 8 and opened.documents.count() == 50


def test_buckets_follow_the_text_and_the_number_of_documents(spark, monkeypatch):
    raw = spark.createDataFrame([("a", "x" * 600_000), ("b", "é" * 200_000), ("c", None)], "docno string, text string")
    least = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(indexing, "BYTES_PER_BUCKET", 10_000)
    assert indexing.buckets_for(raw) == 100
    assert indexing.buckets_for(raw.limit(0)) == least
    monkeypatch.setattr(indexing, "BYTES_PER_BUCKET", 1 << 30)
    assert indexing.buckets_for(raw) == least
    assert indexing.buckets_for(spark.range(indexing.DOCUMENTS_PER_BUCKET * 9).selectExpr("string(id) AS docno", "'' AS text")) == 9
    # A bucket's tokens, and its documents times 200 topics, are grouped in one task.
    assert indexing.DOCUMENTS_PER_BUCKET <= 20_000


def updated_index(spark, tmp_path):
    texts = {f"d{i}": f"common w{i % 7}" for i in range(60)}
    first = make_index(spark, str(tmp_path / "a"), texts, buckets=4)
    batch = spark.createDataFrame([(f"d{i}", "changed words") for i in range(30)], "docno string, text string")
    return update_index(first, batch, str(tmp_path / "b"), merge=False)


def test_replaced_ids_are_neither_sorted_nor_sent_to_all_tasks(spark, tmp_path):
    """However many they are: a bucket hashes its own."""
    index = updated_index(spark, tmp_path)
    for table in (index.documents, index.postings):
        plan = executed_plan(table)
        assert "ShuffledHashJoin" in plan and "Exchange" not in plan
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_a_merged_index_has_one_file_per_bucket(spark, tmp_path):
    indexing.merge_segments(updated_index(spark, tmp_path), str(tmp_path / "c"))
    for table in ("documents", "postings"):
        names = [p.name for p in (tmp_path / "c" / table).glob("part-*")]
        buckets = [re.search(r"_(\d{5})\.", n).group(1) for n in names]
        assert len(buckets) == len(set(buckets)) == 4
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"
