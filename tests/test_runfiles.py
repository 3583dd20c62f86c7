import pytest

from trawl.sinks.runfiles import write_runs


@pytest.fixture
def ranked(spark):
    return spark.createDataFrame(
        [("a", 2, "d1", 1, 0.5), ("a", 1, "d2", 2, 0.25), ("a", 1, "d1", 1, 1.5), ("b", 1, "d3", 1, 2.0)],
        "model string, qid int, docno string, rank bigint, score double",
    )


def lines(spark, path, model):
    return [r.value for r in spark.read.text(f"{path}/model={model}").collect()]


def test_lines_are_in_topic_and_rank_order(spark, ranked, tmp_path):
    path = str(tmp_path / "runs")
    write_runs(ranked, path, ["model"], "score")
    assert sorted(lines(spark, path, "a")) == [
        "1 Q0 d1 1 1.5 Exp", "1 Q0 d2 2 0.25 Exp", "2 Q0 d1 1 0.5 Exp",
    ]
    for part in (tmp_path / "runs" / "model=a").glob("part-*"):
        keys = [tuple(map(int, (l.split()[0], l.split()[3]))) for l in part.read_text().splitlines()]
        assert keys == sorted(keys)


def test_overwrite_replaces_and_append_adds(spark, ranked, tmp_path):
    path = str(tmp_path / "runs")
    write_runs(ranked, path, ["model"], "score")
    write_runs(ranked, path, ["model"], "score")
    assert len(lines(spark, path, "a")) == 3
    write_runs(ranked, path, ["model"], "score", mode="append")
    assert len(lines(spark, path, "a")) == 6
