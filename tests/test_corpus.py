import pytest
from pyspark.sql import functions as F

from trawl.plans import indexing
from trawl.sources import corpus


def block(docno, *sections, end="\n</DOC>\n"):
    text = "".join(f"\n<TEXT>\n{s}\n</TEXT>" for s in sections)
    return f"<DOC>\n<DOCNO> {docno} </DOCNO>\n<HEAD>ignored</HEAD>{text}{end}"


ID = "AP8901{:02}-0001".format


def write(folder, name, content):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(content.encode())
    return str(folder)


def load(spark, path):
    return {r.docno: r.text for r in indexing.load_corpus(spark, path).collect()}


def test_sections_are_joined_and_other_tags_ignored(spark, tmp_path):
    path = write(
        tmp_path / "c", "f1",
        block(ID(1), "one\ntwo", "three") + block(ID(2)) + block(ID(3), "x"),
    )
    assert load(spark, path) == {ID(1): "one two three ", ID(2): "", ID(3): "x "}


@pytest.mark.parametrize("end", ["", "\n", "\n</TEXT>"])
def test_unclosed_last_block_is_dropped(spark, tmp_path, end):
    path = write(tmp_path / "c", "f1", block(ID(1), "kept") + block(ID(2), "lost", end=end))
    write(tmp_path / "c", "f2", block(ID(3), "kept too"))
    assert sorted(load(spark, path)) == [ID(1), ID(3)]


@pytest.mark.parametrize("mark", [b"", b"\xef\xbb\xbf"])
@pytest.mark.parametrize("pack", [None, "gz", "bz2"])
def test_ends_of_compressed_and_marked_files(spark, tmp_path, mark, pack):
    import bz2
    import gzip

    folder, want = tmp_path / "c d", {ID(9): "plain "}
    write(folder, "plain", block(ID(9), "plain"))
    ends = {1: "\n</DOC>", 2: "\n</DOC>\n", 3: "\n</DOC>\n\n \n", 4: "\n</TEXT>", 5: "", 6: "\n</DOC"}
    for i, end in ends.items():
        content = mark + (block(ID(10 + i), f"first {i}") + block(ID(i), "é last", end=end)).encode()
        packed = {None: bytes, "gz": gzip.compress, "bz2": bz2.compress}[pack](content)
        (folder / (f"f{i}" + (f".{pack}" if pack else ""))).write_bytes(packed)
        want |= {ID(10 + i): f"first {i} "} | ({ID(i): "é last "} if i < 4 else {})
    assert load(spark, str(folder)) == want


def test_closing_tag_at_the_very_end_counts(spark, tmp_path):
    path = write(tmp_path / "c", "f1", block(ID(1), "a") + block(ID(2), "b", end="\n</DOC>"))
    assert sorted(load(spark, path)) == [ID(1), ID(2)]


def test_unclosed_block_inside_a_file_runs_into_the_next(spark, tmp_path):
    path = write(tmp_path / "c", "f1", block(ID(1), "a", end="\n") + block(ID(2), "b"))
    assert load(spark, path) == {ID(2): "a b "}


def test_block_without_id_is_dropped_and_counted(spark, tmp_path):
    path = write(
        tmp_path / "c", "f1",
        block(ID(1), "a") + "<DOC>\n<TEXT>\nnobody\n</TEXT>\n</DOC>\n",
    )
    assert load(spark, path) == {ID(1): "a "}
    counted = corpus.blocks_without_id(corpus.read_blocks(spark, path)).collect()
    assert [r.dropped for r in counted] == [1]


def test_unclosed_section_keeps_its_text(spark, tmp_path):
    path = write(
        tmp_path / "c", "f1", f"<DOC>\n<DOCNO> {ID(1)} </DOCNO>\n<TEXT>\nabc\n</DOC>\n"
    )
    assert load(spark, path) == {ID(1): "abc"}


def test_tags_count_only_at_line_start(spark, tmp_path):
    path = write(tmp_path / "c", "f1", block(ID(1), "see </DOC> and </TEXT> and <TEXT> here"))
    assert load(spark, path) == {ID(1): "see </DOC> and </TEXT> and <TEXT> here "}


@pytest.mark.parametrize("bound", [0, 100_000])
def test_last_copy_of_an_id_wins(spark, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(corpus, "BROADCAST_ROWS", bound)
    hot = "".join(block(ID(1), f"copy {i}") for i in range(200))
    path = write(tmp_path / "c", "a", hot + block(ID(2), "b"))
    write(tmp_path / "c", "b", block(ID(3), "c") + block(ID(1), "first of b") + block(ID(1), "last"))
    assert load(spark, path) == {ID(1): "last ", ID(2): "b ", ID(3): "c "}


@pytest.mark.parametrize("split_bytes", ["997", "2048", "4096"])
def test_a_large_file_is_split_without_losing_blocks(spark, tmp_path, split_bytes):
    n = 400
    content = "".join(block(f"AP{i:011}", f"word{i} " * (i % 37)) for i in range(n))
    path = write(tmp_path / "c", "f1", content + block("AP99999999999", "open", end="\n"))
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        blocks = corpus.read_blocks(spark, path)
        assert blocks.rdd.getNumPartitions() > 4
        got = load(spark, path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)
    assert len(got) == n
    assert got["AP00000000036"].split() == ["word36"] * 36


def test_only_judged_documents(spark, tmp_path):
    path = write(tmp_path / "c", "f1", block(ID(1), "a") + block(ID(2), "b"))
    judged = spark.createDataFrame([(51, ID(2)), (52, ID(2))], "qid int, docno string")
    kept = indexing.load_corpus(spark, path, only=judged)
    assert [r.docno for r in kept.select(F.col("docno")).collect()] == [ID(2)]
