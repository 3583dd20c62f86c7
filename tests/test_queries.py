"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from compare import connect, difference
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_same_as_sql(spark, db, name):
    ours = registered.queries()[name](spark, SF_DIR).toPandas()
    assert len(ours)
    assert difference(ours, db.sql(registered.oracle_sql()[name]).df()) is None


@pytest.mark.parametrize("name", sorted(q for q in registered.queries() if q.endswith(("_test", "_train")) and q.startswith("ltr")))
def test_learned_ranks_have_no_gaps(spark, name):
    ranked = registered.queries()[name](spark, SF_DIR)
    per_topic = ranked.groupBy("qid").agg(
        F.count("*").alias("n"), F.max("rank").alias("last"), F.countDistinct("rank").alias("ranks")
    )
    counts = per_topic.collect()
    assert counts and all(r.n == r.last == r.ranks for r in counts)


def test_learned_run_files_hold_every_pair_once_per_learner(spark):
    lines = registered.queries()["ltr_run_files"](spark, SF_DIR)
    pairs = registered.queries()["qrels_parse"](spark, SF_DIR).count()
    assert {r["count"] for r in lines.groupBy("learner").count().collect()} == {pairs}
    assert lines.where("NOT line RLIKE '^[0-9]+ Q0 AP[0-9]{11} [0-9]+ [-0-9.E]+ Exp$'").count() == 0


def test_every_query_is_checked_somehow():
    unchecked = set(QUERIES) - set(registered.oracle_sql())
    assert all(q.startswith("ltr_") for q in unchecked)
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).columns == ["qid", "docno", "score", "rank"]
