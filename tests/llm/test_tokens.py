"""Packing and token files against the tokenizer's ids of whole texts."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from trawl.llm.packing import CAPACITY, difference_partition, pack, windows_for
from trawl.llm.queries import tokenizer_path
from trawl.llm.token_files import ShardReader, read_token_files, write_token_files

SCHEMA = "doc_id long, text string, start string, ids int"
TEXTS = [
    "One two, three.", "", None, "  leading and   inner  blanks \n\n\t x ", "don't 1234 — ünïcode 日本語 \U0001F600!", "<|endoftext|> <s> </s>",
    "a <|endoftext|> b", "a  <|endoftext|>  b <|endoftext|>", "one\u00a0two \u2003 three", " lead", "trail ", " ",
    "word " * 9000, "x" * 5000, "One two, three.", "a\r\nb\x00c",
]


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], SCHEMA)


def test_pieces_hold_every_id_once_and_fit(docs, encode):
    rows = pack(docs, tokenizer_path(), group=3).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, text in enumerate(TEXTS):
        pieces = sorted(by_doc[i])
        ids = [x for p in pieces for x in p[1]]
        assert ids == [*encode(text), 1]
        assert [p[0] for p in pieces] == np.cumsum([0] + [p[3] for p in pieces])[:-1].tolist()
        assert {p[2] for p in pieces} == {len(ids)}
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= CAPACITY


def test_packing_an_empty_table(spark):
    assert pack(spark.createDataFrame([], SCHEMA), tokenizer_path()).collect() == []


@pytest.mark.parametrize("k", [1, 2, 3, 7])
def test_differencing_deals_every_piece_and_balances(k):
    rng = np.random.default_rng(k)
    sizes = rng.integers(1, 500, 200).tolist()
    dealt = difference_partition(sizes, k)
    assert sorted(i for w in dealt for i in w) == list(range(200))
    sums = [sum(sizes[i] for i in w) for w in dealt]
    assert len(sums) == k and max(sums) - min(sums) <= 5


def test_differencing_known_case():
    # 8, 7, 6, 5, 4 by two-way differencing gives sums 16 and 14.
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in difference_partition([8, 7, 6, 5, 4], 2)) == [14, 16]


def test_windows_rise_until_they_fit():
    sizes = [1500] * 5
    dealt = windows_for(sizes, 2048)
    assert len(dealt) == 5 and windows_for([], 10) == []
    with pytest.raises(ValueError):
        windows_for([11], 10)


def test_token_files_return_the_stream(spark, docs, encode, tmp_path):
    folder = str(tmp_path / "t")
    shards = write_token_files(docs, folder, tokenizer_path(), row_length=64)
    got = {r.doc_id: r for r in read_token_files(spark, folder, shards).collect()}
    start = 0
    for i, text in enumerate(TEXTS):
        ids = np.array([*encode(text), 2], "<u4")
        assert (got[i].start, got[i].n_tokens, zlib.crc32(got[i].ids)) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_sequences_are_views_of_equal_length(spark, docs, encode, tmp_path):
    folder = str(tmp_path / "t")
    shards = write_token_files(docs, folder, tokenizer_path(), row_length=32)
    stream = [x for t in TEXTS for x in [*encode(t), 2]]
    before = 0
    for shard, _, ids in shards:
        reader = ShardReader(folder, shard)
        kind = pa.ipc.open_file(f"{folder}/part-{shard:06d}.arrow").schema
        assert kind.field("ids").type.list_size == kind.field("mask").type.list_size == 32
        rows = -(-ids // 32)
        for row in {0, rows // 2, rows - 1}:
            values, mask = reader.sequence(row)
            kept = mask.as_py()
            assert len(values) == len(kept) == 32
            assert values[np.array(kept)].tolist() == stream[before + row * 32 : before + min(row * 32 + 32, ids)]
        before += ids


def test_token_files_of_repeated_and_null_ids_and_no_rows(spark, tmp_path):
    rows = [(None, "n", "", 1), (4, "b", "", 1), (4, "a", "", 1), (4, "a", "", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    back = read_token_files(spark, str(tmp_path / "a"), write_token_files(df, str(tmp_path / "a"), tokenizer_path()))
    got = sorted(((r.doc_id or -1, r.start, r.n_tokens) for r in back.collect()), key=lambda x: x[1])
    assert [g[0] for g in got] == [-1, 4, 4, 4] and [g[1] for g in got] == [0, 2, 4, 6]
    none = spark.createDataFrame([], SCHEMA)
    assert read_token_files(spark, str(tmp_path / "b"), write_token_files(none, str(tmp_path / "b"), tokenizer_path())).collect() == []


@pytest.mark.parametrize("length", [1, 9, 20])
def test_short_texts_fill_their_sequences(length):
    from trawl.llm.packing import Packer

    packer = Packer(2048, 512, 256, 0)
    pieces = [p for i in range(30_000) for p in packer.add(i, np.zeros(length, dtype=np.uint16))] + list(packer.flush())
    assert sorted(p[0] for p in pieces) == list(range(30_000))
    held = np.bincount([p[4] for p in pieces], [len(p[2]) for p in pieces])
    assert held.max() <= 2048 and len(held) <= 1.03 * -(-30_000 * length // 2048)
