"""Cleaning rules for documents and topics, as column expressions.

Documents and topics go through the same kinds of step in a different order:

* documents: stop words, lower case, punctuation, doubled blanks;
* topics: preamble phrases, punctuation, stop words, doubled blanks, lower case.

Stop words are matched case-sensitively on raw tokens in both.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which ASCII punctuation turns into a blank, and the phrases cut
# from the head of a topic (each with its leading and trailing blank).
DOCUMENT_PUNCTUATION = "!\"#$%&()*+,./:;<=>?@[\\]^`{|}~"
TOPIC_PUNCTUATION = "!\"#$%&'()*+,./:;<=>?@[\\]^`{|}~"
TOPIC_PREAMBLES = (
    " Document will discuss ",
    " Document will report ",
    " Document will include ",
    " Document must describe ",
    " Document must identify ",
)


def blank_out(text: Column, characters: str) -> Column:
    return F.translate(text, characters, " " * len(characters))


def squeeze(text: Column) -> Column:
    """Runs of whitespace become one blank; none at either end."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def raw_tokens(text: Column) -> Column:
    return F.split(squeeze(text), " ")


def blank_stop_words(text: Column, stop_words: list[str]) -> Column:
    """Replace tokens that are stop words by nothing, keeping the blanks around them."""
    tokens = raw_tokens(text)
    if not stop_words:
        return F.array_join(tokens, " ")
    return F.array_join(
        F.transform(tokens, lambda t: F.when(t.isin(stop_words), "").otherwise(t)), " "
    )


def halve_blanks(text: Column) -> Column:
    """One pass of two blanks to one, so three blanks leave two."""
    return F.replace(text, F.lit("  "), F.lit(" "))


def clean_document(text: Column, stop_words: list[str]) -> Column:
    return finish_document(blank_stop_words(text, stop_words))


def finish_document(text: Column) -> Column:
    """The steps after the stop words are gone."""
    return halve_blanks(blank_out(F.lower(text), DOCUMENT_PUNCTUATION))


def drop_preambles(text: Column) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p), F.lit("")), TOPIC_PREAMBLES, text)


def bare_topic(text: Column) -> Column:
    """The steps before the stop words go."""
    return blank_out(drop_preambles(text), TOPIC_PUNCTUATION)


def finish_topic(text: Column) -> Column:
    return F.lower(halve_blanks(text))


def clean_topic(text: Column, stop_words: list[str]) -> Column:
    return finish_topic(blank_stop_words(bare_topic(text), stop_words))


def token_count(text: Column) -> Column:
    """Number of whitespace-separated tokens; 0 for blank text."""
    return F.regexp_count(text, F.lit(r"\S+")).cast("long")
