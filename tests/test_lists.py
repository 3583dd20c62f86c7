from trawl.sources import lists


def test_stop_list_keeps_case(spark, tmp_path):
    (tmp_path / "stop").write_text("the\nThe\n\nof\n")
    assert lists.read_stop_list(spark, str(tmp_path / "stop")) == ["The", "of", "the"]


def test_stop_list_may_be_long(spark, tmp_path):
    (tmp_path / "stop").write_text("".join(f"w{i}\n" for i in range(120_000)))
    assert len(lists.read_stop_list(spark, str(tmp_path / "stop"))) == 120_000


def test_lines_of_another_form_are_counted(spark, tmp_path, rows):
    (tmp_path / "topics").write_text("1. one\nno number. x\n2 no dot\n")
    (tmp_path / "qrels").write_text("1 0 AP1 1\n1 0 AP2\nx 0 AP3 1\n1 0 AP4 y\n")
    assert rows(lists.read_topics(spark, str(tmp_path / "topics"))) == [(1, " one")]
    assert rows(lists.dropped_topics(spark, str(tmp_path / "topics")), "dropped") == [(2,)]
    assert rows(lists.read_qrels(spark, str(tmp_path / "qrels"))) == [(1, "AP1", 1)]
    assert rows(lists.dropped_qrels(spark, str(tmp_path / "qrels")), "dropped") == [(3,)]


def test_topic_text_ends_at_the_second_dot(spark, tmp_path, rows):
    (tmp_path / "topics").write_text(
        "85. Document will discuss U.S. policy\n\n 51.   Airbus Subsidies\n"
    )
    topics = lists.read_topics(spark, str(tmp_path / "topics"))
    assert rows(topics) == [(51, "   Airbus Subsidies"), (85, " Document will discuss U")]


def test_qrels_take_any_blanks_and_the_last_label(spark, tmp_path, rows):
    (tmp_path / "qrels").write_text(
        "51 0 AP1 0\n51\t0   AP2  1\n\n51 0 AP1 1\n52 0 AP1 0\n"
    )
    qrels = lists.read_qrels(spark, str(tmp_path / "qrels"))
    assert rows(qrels) == [(51, "AP1", 1), (51, "AP2", 1), (52, "AP1", 0)]


def test_the_last_label_wins_across_splits_of_a_large_file(spark, tmp_path, rows):
    (tmp_path / "qrels").write_text(
        "".join(f"{51 + i % 3} 0 AP{i % 7} {i}\n" for i in range(3000))
    )
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        qrels = lists.read_qrels(spark, str(tmp_path / "qrels"))
        got = rows(qrels)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)
    last = {(51 + i % 3, f"AP{i % 7}"): i for i in range(3000)}
    assert got == sorted((q, d, i) for (q, d), i in last.items())
