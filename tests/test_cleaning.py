import random
import string

import pytest
from pyspark.sql import functions as F

from trawl.functions.cleaning import (
    DOCUMENT_PUNCTUATION,
    TOPIC_PUNCTUATION,
    clean_document,
    clean_topic,
    halve_blanks,
    token_count,
)
from trawl.operators import postings


def apply(spark, function, text, *args):
    frame = spark.createDataFrame([(text,)], "t string")
    return frame.select(function(F.col("t"), *args).alias("r")).first().r


def test_punctuation_sets():
    assert set(string.punctuation) - set(DOCUMENT_PUNCTUATION) == set("_-'")
    assert set(string.punctuation) - set(TOPIC_PUNCTUATION) == set("_-")


def test_stop_words_match_whole_raw_tokens(spark):
    text = "The the, the cat"
    assert apply(spark, clean_document, text, ["the"]).split() == ["the", "the", "cat"]


def test_document_keeps_apostrophe_hyphen_underscore(spark):
    assert apply(spark, clean_document, "cat's well-known a_b (x)", []) == "cat's well-known a_b x "


def test_topic_loses_the_apostrophe_before_stop_words(spark):
    text = "cat's well-known a_b s."
    assert apply(spark, clean_topic, text, ["s"]) == "cat well-known a_b "


def test_blanks_are_halved_once(spark):
    assert apply(spark, halve_blanks, "a   b    c") == "a  b  c"


def test_removed_words_leave_blanks(spark):
    assert apply(spark, clean_document, "a the the b", ["the"]) == "a  b"


def test_topic_preamble_is_cut_with_its_blanks(spark):
    text = "85 Document will discuss allegations"
    assert apply(spark, clean_topic, text, []) == "85allegations"
    assert apply(spark, clean_topic, " document will discuss x", []) == "document will discuss x"


def test_token_count(spark):
    assert apply(spark, token_count, "") == 0
    assert apply(spark, token_count, "   ") == 0
    assert apply(spark, token_count, " a  b ") == 2


def test_any_whitespace_separates(spark):
    assert apply(spark, clean_document, "\ta\x0bb\r\n c ", []) == "a b c"


def test_random_texts_against_plain_python(spark):
    draw = random.Random(11)
    pieces = ["the", "The", "of", "cat", "É", *string.punctuation, " ", "  ", "\n", "\t"]
    texts = ["".join(draw.choices(pieces, k=draw.randrange(0, 30))) for _ in range(400)]
    stop = ["the", "of"]

    def without_stop(text):
        return " ".join("" if w in stop else w for w in text.split())

    def blanked(text, kept):
        return "".join(" " if c in string.punctuation and c not in kept else c for c in text)

    def document(text):
        return blanked(without_stop(text).lower(), "_-'").replace("  ", " ")

    def topic(text):
        return without_stop(blanked(text, "_-")).replace("  ", " ").lower()

    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for row in frame.select(
        "i",
        clean_document(F.col("t"), stop).alias("d"),
        clean_topic(F.col("t"), stop).alias("q"),
    ).collect():
        assert (row.d, row.q) == (document(texts[row.i]), topic(texts[row.i]))


@pytest.mark.parametrize("folded, sent", [(10_000, 1_000_000), (0, 1_000_000), (0, 0)])
def test_texts_keep_their_place_under_a_list_longer_than_a_broadcast(spark, monkeypatch, folded, sent):
    """Words that no text holds do not count, and tokens do not travel."""
    monkeypatch.setattr(postings, "FOLDED_WORDS", folded)
    monkeypatch.setattr(postings, "BROADCAST_ROWS", sent)
    stop = ["the", "of", "", "l'été"]
    texts = ["the cat of the  house", "The l'été of", None, "", "  ", "the", "the the\tof\n cat ", "of", "a" * 300 + " the"]
    rows = [(None if i == 4 else i // 2, t) for i, t in enumerate(texts)]
    raw = spark.createDataFrame(rows, "docno int, text string")
    table = spark.createDataFrame([(w,) for w in [*stop, *stop, None, *(f"unheard{i}" for i in range(50))]], "word string")
    want = raw.select("docno", clean_document(F.col("text"), stop).alias("text"))
    got = postings.clean_documents(raw, table)
    assert sorted(map(tuple, got.select("docno", "text").collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange" in plan) == (sent == 0)
