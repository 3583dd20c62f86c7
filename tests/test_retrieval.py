import pytest
from pyspark.sql import functions as F
from small import dense_scores, make_index, make_topics

from trawl import retrieve
from trawl.functions.scoring import MODELS, Scorer, jelinek_mercer, register, scorer
from trawl.operators import scoring
from trawl.plans.retrieval import weighed_terms


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    return make_index(spark, str(tmp_path_factory.mktemp("index")))


def as_dict(hits):
    return {(r.model, r.qid, r.docno): (round(r.score, 6), r.rank) for r in hits.collect()}


def ranked(scores, k=15_000):
    """Cut at k, then drop zeros, then rank, in plain Python."""
    out = {}
    for model, qid in {(m, q) for m, q, _ in scores}:
        hits = sorted(
            ((-s, d) for (m, q, d), s in scores.items() if (m, q) == (model, qid))
        )[:k]
        for rank, (s, d) in enumerate([h for h in hits if h[0] != 0], 1):
            out[model, qid, d] = (-s, rank)
    return out


@pytest.mark.parametrize("k", [1, 2, 15_000])
def test_five_models_by_hand(spark, index, k):
    got = as_dict(retrieve(index, make_topics(spark), k=k))
    expected = ranked(dense_scores(), k)
    assert got.keys() == expected.keys()
    for key, (score, rank) in expected.items():
        assert got[key] == (pytest.approx(score, abs=1.5e-6), rank), key


def test_zero_scores_are_dropped_after_the_cut(spark, tmp_path):
    documents = {"d1": "apple fig", "d2": "apple", "d3": "apple date"}
    index = make_index(spark, str(tmp_path / "i"), documents)
    topics = {1: "apple", 2: "apple fig"}
    hits = as_dict(retrieve(index, make_topics(spark, topics), ["tf_idf"], k=2))
    assert hits == ranked(
        {k: v for k, v in dense_scores(documents, topics).items() if k[0] == "tf_idf"}, 2
    )
    assert list(hits) == [("tf_idf", 2, "d1")]


def test_equal_scores_rank_by_document_id(spark, tmp_path):
    index = make_index(spark, str(tmp_path / "i"), {"b": "x y", "a": "x z", "c": "w"})
    hits = retrieve(index, make_topics(spark, {1: "x"}), ["okapi_bm"])
    assert [r.docno for r in hits.orderBy("rank").collect()] == ["a", "b"]


@pytest.mark.parametrize("salt_rows", [1, 5_000_000])
def test_salted_matching_gives_the_same_scores(spark, index, monkeypatch, salt_rows):
    topics = make_topics(spark)
    expected = as_dict(retrieve(index, topics))
    monkeypatch.setattr(scoring, "SALT_ROWS", salt_rows)
    monkeypatch.setattr(scoring, "TOPIC_ROWS", min(salt_rows, 1000))
    monkeypatch.setattr(scoring, "BROADCAST_ROWS", 0)
    got = as_dict(retrieve(index, topics))
    assert got.keys() == expected.keys()
    for key, (score, rank) in expected.items():
        assert got[key] == (pytest.approx(score, abs=1.5e-6), rank)


def test_many_terms_are_not_pushed_but_still_joined(spark, index, monkeypatch):
    expected = as_dict(retrieve(index, make_topics(spark)))
    monkeypatch.setattr(scoring, "PUSHED_TERMS", 1)
    assert as_dict(retrieve(index, make_topics(spark))) == expected


def test_cells_of_a_hot_term_are_bounded(spark, monkeypatch):
    """One term that all documents hold and very many topics ask for."""
    monkeypatch.setattr(scoring, "SALT_ROWS", 2000)
    monkeypatch.setattr(scoring, "TOPIC_ROWS", 50)
    postings = spark.range(3000).select(F.format_string("d%d", "id").alias("docno"), F.lit("hot").alias("term"), F.lit(1).alias("tf"))
    postings = postings.unionByName(postings.limit(3).withColumn("term", F.lit("rare")))
    weighed = spark.range(400).select(F.col("id").cast("int").alias("qid"), F.lit("hot").alias("term"), F.lit(1).alias("qtf"), F.lit(3000).alias("df"), F.lit(3000).alias("ttf"))
    weighed = weighed.unionByName(spark.createDataFrame([(1, "rare", 1, 3, 3)], weighed.schema))
    left, right = scoring.into_cells(postings, weighed)
    cell = ["term", "salt", "topic_salt"]
    sizes = left.groupBy(*cell).count().join(right.groupBy(*cell).agg(F.count("*").alias("topics")), cell)
    rows = sizes.withColumn("matches", F.col("count") * F.col("topics")).collect()
    assert len(rows) > 400 and max(r.matches for r in rows if r.term == "hot") < 3 * 2000
    assert sum(r.matches for r in rows) == 3000 * 400 + 3
    matched = scoring.salted_match(postings, weighed)
    assert matched.count() == matched.select("qid", "docno", "term").distinct().count() == 3000 * 400 + 3


def test_bins_never_fall(spark):
    values = sorted([0.0, -0.0, 1e-300, -1e-300, 5e-7, -5e-7, 1e300, -1e300, *(x * s / 7 for x in range(1, 500) for s in (-1.0, 1.0))])
    table = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    bins = [r.b for r in table.orderBy("i").select(scoring.score_bin(F.col("v")).alias("b")).collect()]
    assert bins == sorted(bins) and len(set(bins)) > 400


def test_few_rows_below_the_bar_are_shuffled(spark):
    hits = spark.range(200_000).select(
        F.lit("m").alias("model"), (F.col("id") % 2).cast("int").alias("qid"), F.format_string("d%07d", "id").alias("docno"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1000.0 - 300).alias("place"),
    ).unionByName(spark.createDataFrame([("m", 9, "x", 1.0)], "model string, qid int, docno string, place double"))
    kept = scoring.above_bars(hits, ["model", "qid"], "place", 500)
    counts = {r.qid: r["count"] for r in kept.groupBy("qid").count().collect()}
    assert counts[9] == 1 and all(500 <= counts[q] < 3000 for q in (0, 1))
    best = hits.where("qid = 0").orderBy(F.desc("place")).limit(500)
    assert best.join(kept, ["qid", "docno"], "left_anti").count() == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_cut_above_bars_equals_the_plain_one(spark, monkeypatch):
    scored = spark.range(3000).select(
        (F.col("id") % 3).cast("int").alias("qid"),
        F.format_string("d%05d", F.col("id")).alias("docno"),
        (F.col("id") * 7919 % 41 - 20).cast("double").alias("a"),
        (F.col("id") * 104729 % 977).cast("double").alias("b"),
    )
    plain = as_dict(scoring.rank_hits(scored, ["a", "b"], 50, parts=16))
    monkeypatch.setattr(scoring, "TOP_K_GROUP_ROWS", 10)
    barred = scoring.rank_hits(scored, ["a", "b"], 50, parts=16)
    assert as_dict(barred) == plain and len(plain) == 300


def test_the_cut_is_taken_before_the_shuffle(spark, index):
    plan = retrieve(index, make_topics(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_unknown_topic_terms_are_skipped(spark, index):
    weighed = weighed_terms(index, make_topics(spark))
    assert {(r.qid, r.term) for r in weighed.collect()} == {
        (1, "apple"), (1, "cherry"), (2, "banana"),
    }


def test_registered_and_ad_hoc_scorers(spark, index):
    register(Scorer("raw_tf", match=lambda c: F.col("qtf") * F.col("tf").cast("double")))
    hits = as_dict(retrieve(index, make_topics(spark), ["raw_tf"]))
    assert hits["raw_tf", 1, "d1"] == (3.0, 1)
    assert hits["raw_tf", 2, "d1"] == (2.0, 1)
    with pytest.raises(KeyError):
        scorer("nothing")


def test_smoothing_weight_is_a_parameter(spark, index):
    half, tenth = jelinek_mercer(), jelinek_mercer(0.1, name="jm_tenth")
    hits = as_dict(retrieve(index, make_topics(spark), [half, tenth]))
    expected = dense_scores()
    assert hits["jm", 1, "d1"][0] == pytest.approx(expected["jm", 1, "d1"], abs=1.5e-6)
    assert hits["jm_tenth", 1, "d1"][0] != hits["jm", 1, "d1"][0]


def test_all_models_have_scorers():
    assert [scorer(m).name for m in MODELS] == list(MODELS)


def test_topics_without_known_terms_give_nothing(spark, index):
    assert retrieve(index, make_topics(spark, {3: "zebra", 4: ""})).count() == 0


def test_bars_of_a_share_of_the_documents_keep_the_best(spark):
    hits = spark.range(40_000).select(
        F.lit("m").alias("model"), (F.col("id") % 2).cast("int").alias("qid"), F.format_string("d%07d", "id").alias("docno"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1000.0 - 300).alias("place"),
    ).unionByName(spark.createDataFrame([("m", 9, "x", 1.0)], "model string, qid int, docno string, place double"))
    kept = scoring.above_bars(hits, ["model", "qid"], "place", 500, 4)
    counts = {r.qid: r["count"] for r in kept.groupBy("qid").count().collect()}
    assert counts[9] == 1 and all(500 <= counts[q] < 5000 for q in (0, 1))
    best = hits.where("qid = 0").orderBy(F.desc("place")).limit(500)
    assert best.join(kept, ["qid", "docno"], "left_anti").count() == 0


def test_many_buckets_are_cut_by_bars_before_the_shuffle(spark, monkeypatch):
    scored = spark.range(3000).select(
        (F.col("id") % 3).cast("int").alias("qid"), F.format_string("d%05d", F.col("id")).alias("docno"),
        (F.col("id") * 104729 % 977).cast("double").alias("a"),
    )
    plain, used, bars = as_dict(scoring.rank_hits(scored, ["a"], 50, parts=16)), [], scoring.above_bars
    monkeypatch.setattr(scoring, "above_bars", lambda *a: used.append(a) or bars(*a))
    assert as_dict(scoring.rank_hits(scored, ["a"], 50, parts=8000)) == plain
    assert len(used) == 1
