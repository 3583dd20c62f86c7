"""The text analyzer: words, possessives, stop words, stems.

The steps after word splitting run on exploded rows rather than inside array
lambdas, so that they stay in whole-stage generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.stemming import stem_words
from trawl.operators.keyed import BROADCAST_ROWS, is_small

# Code points of the scripts that are written without blanks, and the marks
# that join letters, digits or both when one stands between two of them.
SINGLES = (
    r"\u2E80-\u2FD5\u3005\u3007\u3021-\u3029\u3038-\u303B\u3041-\u3096\u309D-\u309F"
    r"\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{1B001}-\x{1B11F}\x{20000}-\x{3FFFF}"
)
KATAKANA = r"\u3031-\u3035\u309B\u309C\u30A0-\u30FA\u30FC-\u30FF\u31F0-\u31FF\uFF66-\uFF9F"
SOUTHEAST = (
    r"\u0E01-\u0E3A\u0E40-\u0E4E\u0E80-\u0ECF\u0EDC-\u0EDF\u1000-\u103F\u1050-\u108F"
    r"\u109A-\u109F\u1780-\u17D3\u17D7\u17DC\u17DD\uA9E0-\uA9EF\uA9FA-\uA9FE\uAA60-\uAA7F"
)
BETWEEN_BOTH = r".\u2018\u2024\uFE52\uFF07\uFF0E"
BETWEEN_LETTERS = r":\u00B7\u0387\u055F\u05F4\u2027\uFE13\uFE55\uFF1A"
BETWEEN_DIGITS = (
    r",;\u037E\u0589\u060C\u060D\u066B\u066C\u07F8\u2044\uFE10\uFE14\uFE50\uFE54\uFF0C\uFF1B"
)

_PLAIN = rf"&&[^{SINGLES}{KATAKANA}{SOUTHEAST}]"
_INSIDE = rf"[\p{{L}}\p{{N}}\p{{M}}\p{{Pc}}{_PLAIN}]"
_LETTER = rf"[\p{{L}}{_PLAIN}]"
_TAIL = r"\p{M}[\p{Cf}&&[^\u200B]]"
# ASCII is tried first: testing a character against all those ranges takes longer.
_RUN = (
    rf"(?:[a-z0-9_]++|{_INSIDE})(?:[a-z0-9_]++"
    rf"|[\p{{L}}\p{{N}}\p{{M}}\p{{Pc}}\p{{Cf}}&&[^\u200B{SINGLES}{KATAKANA}{SOUTHEAST}]])*+"
)
_JOIN = (
    rf"['’](?={_INSIDE})"
    rf"|[{BETWEEN_BOTH}{BETWEEN_LETTERS}](?<=[\p{{L}}\p{{M}}\p{{Cf}}].)(?={_LETTER})"
    rf"|[{BETWEEN_BOTH}{BETWEEN_DIGITS}](?<=\p{{Nd}}.)(?=\p{{Nd}})"
)
# Letters, digits, combining marks and connectors, with marks between them; a run of
# Katakana or of a script whose words only a dictionary tells apart; one ideograph or
# Hiragana. Possessive repeats keep the matcher from recursing and from going back.
WORD = (
    r"(?![\x00-/:-@\[-^`{-\x7F])(?:"
    rf"{_RUN}(?:(?:{_JOIN}){_RUN})*+"
    rf"|[{KATAKANA}][{KATAKANA}{_TAIL}]*+"
    rf"|[{SOUTHEAST}][{SOUTHEAST}{_TAIL}]*+"
    rf"|[{SINGLES}][{_TAIL}]*+)"
)


def words(text: Column) -> Column:
    """The words of a text by Unicode word breaks; marks and connectors alone are none.

    An apostrophe joins any two letters, digits or connectors; a full stop or colon joins
    letters (``u.s.a``), a full stop, comma or semicolon digits (``3.5``, ``1,000``).
    Ideographs and Hiragana are words by themselves, runs of Katakana, Thai, Lao, Khmer and
    Myanmar one word each. Joiners and other format characters belong to the word before
    them. Pictographs are no words; connectors do not join Katakana.
    """
    runs = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return F.filter(runs, lambda run: run.rlike(r"[\p{L}\p{N}]"))


def strip_possessive(word: Column) -> Column:
    owned = word.endswith("'s") | word.endswith("’s")
    return F.when(owned, F.left(word, F.length(word) - 2)).otherwise(word)


def analyze(
    df: DataFrame, keys: list[str], text: str, stop_words: list[str] | DataFrame, stem: bool = True
) -> DataFrame:
    """One row per kept token: the ``keys``, its position ``pos`` and its ``term``.

    Stop words are a list, or a table with a column ``word`` that is joined instead.

    Positions count all words, so a removed stop word leaves a gap.
    """
    tokens = df.select(*keys, F.posexplode(words(F.col(text))).alias("pos", "word"))
    tokens = tokens.withColumn("word", strip_possessive(F.col("word")))
    if isinstance(stop_words, DataFrame):
        listed = stop_words.select("word")
        listed = F.broadcast(listed) if is_small(listed, BROADCAST_ROWS) else listed
        tokens = tokens.join(listed, "word", "left_anti")
    elif stop_words:
        tokens = tokens.where(~F.col("word").isin(stop_words))
    tokens = tokens.where(F.col("word") != "")
    if stem:
        tokens = stem_words(tokens, "word", "term")
    else:
        tokens = tokens.withColumnRenamed("word", "term")
    return tokens.select(*keys, "pos", "term")
