"""Porter stemming as a chain of projections.

The rules are those of the published algorithm (M. F. Porter, 1980) with the two
departures of its author's later implementations (``bli`` to ``ble``, ``logi`` to
``log``). Each step is one select over the previous step's column, so the chain runs
inside one generated stage, without a shuffle, a join or Python. Steps are single
replacements behind a cheap test of the ending: that keeps the generated method small
enough for the JVM to compile.

A ``y`` that acts as a consonant is written ``Y`` while stemming; after that a vowel is
simply one of ``aeiouy`` and the measure of a stem is a plain regular expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

C, V = "[^aeiouy]", "[aeiouy]"
# Stem of measure at least 1, at least 2.
MEASURE_1 = f"{C}*{V}+{C}.*?"
MEASURE_2 = f"{C}*{V}+{C}+{V}+{C}.*?"
# Stem of measure exactly 1 that ends consonant, vowel, consonant other than w, x, y.
SHORT = f"{C}+{V}[^aeiouywxY]"

# Suffix tables of steps 2, 3 and 4.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance",
    "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent", "eli": "e",
    "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate",
    "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous",
    "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic",
    "ful": "", "ness": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "sion", "tion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

# A step looks at the longest matching suffix only: a shorter one must not be taken when
# the longer one fails its measure. Of "sion" and "tion" step 4 cuts the last three.
GUARDED = {
    "ation": "(?<!iz)ation",
    "ment": "(?<!e)ment",
    "ent": "(?<!m)ent",
    "sion": "(?<=s)ion",
    "tion": "(?<=t)ion",
}


def _one_of(suffixes) -> str:
    return "|".join(GUARDED.get(s, s) for s in suffixes)


def _mark_consonant_y(word: Column) -> Column:
    marked = F.regexp_replace(word, "(^|[aeiou])y", "$1Y")
    marked = F.replace(marked, F.lit("yy"), F.lit("yY"))
    return F.when(F.contains(word, F.lit("y")), marked).otherwise(word)


def _plurals(word: Column) -> Column:
    cut = F.regexp_replace(word, "(ss|i)es$|([^s])s$", "$1$2")
    return F.when(word.endswith("s"), cut).otherwise(word)


def _past_and_gerund(word: Column) -> Column:
    """``eed``, ``ed``, ``ing``; a cut that needs tidying leaves a ``#``."""
    return (
        F.when(
            word.endswith("eed"), F.regexp_replace(word, f"^({MEASURE_1}ee)d$", "$1")
        )
        .when(
            word.endswith("ed") | word.endswith("ing"),
            F.regexp_replace(word, f"({V}.*)(?:ed|ing)$", "$1#"),
        )
        .otherwise(word)
    )


def _tidy_cut(word: Column) -> Column:
    with_e = F.regexp_replace(word, f"^({SHORT})#$|(at|bl|iz)#$", "$1$2e")
    bare = F.regexp_replace(with_e, r"([^aeiouylsz])\1#$|#$", "$1")
    return F.when(word.endswith("#"), bare).otherwise(word)


def _final_y(word: Column) -> Column:
    swapped = F.regexp_replace(word, f"({V}.*)[yY]$", "$1i")
    return F.when(word.endswith("y") | word.endswith("Y"), swapped).otherwise(word)


def _ends_like(word: Column, suffixes) -> Column:
    """Whether the last two letters are those of a suffix, which few words pass: the
    patterns of whole words take much longer."""
    ends = " ".join(sorted({s[-2:] for s in suffixes}))
    return F.contains(F.lit(f" {ends} "), F.concat(F.lit(" "), F.substring(word, -2, 2), F.lit(" ")))


def _suffix_after_measure_1(word: Column, suffixes) -> Column:
    suffix = F.regexp_extract(word, f"^{MEASURE_1}({_one_of(suffixes)})$", 1)
    return F.when(_ends_like(word, suffixes), suffix).otherwise("")


def _swap_suffix(word: Column, suffix: Column, table: dict[str, str]) -> Column:
    base = F.left(word, F.length(word) - F.length(suffix))
    entries = [F.lit(x) for pair in table.items() for x in pair]
    swapped = F.concat(base, F.element_at(F.create_map(*entries), suffix))
    return F.when(suffix != "", swapped).otherwise(word)


def _drop_suffix(word: Column) -> Column:
    cut = F.regexp_replace(word, f"^({MEASURE_2})(?:{_one_of(STEP_4)})$", "$1")
    return F.when(_ends_like(word, STEP_4), cut).otherwise(word)


def _final_e(word: Column) -> Column:
    cut = F.regexp_replace(word, f"^(?!{SHORT}e$)({MEASURE_1})e$", "$1")
    return F.when(word.endswith("e"), cut).otherwise(word)


def _final_ll(word: Column) -> Column:
    cut = F.regexp_replace(word, f"^({MEASURE_2})(?<=l)l$", "$1")
    return F.when(word.endswith("ll"), cut).otherwise(word)


def stem_words(df: DataFrame, word: str, stem: str) -> DataFrame:
    """Add the ``stem`` of a lower-case ``word`` column, which is dropped."""
    w, s = F.col("__w"), F.col("__s")
    out = df.withColumn("__w", _mark_consonant_y(F.col(word)))
    for step in (_plurals, _past_and_gerund, _tidy_cut, _final_y):
        out = out.withColumn("__w", step(w))
    for table in (STEP_2, STEP_3):
        out = out.withColumn("__s", _suffix_after_measure_1(w, table))
        out = out.withColumn("__w", _swap_suffix(w, s, table))
    for step in (_drop_suffix, _final_e, _final_ll):
        out = out.withColumn("__w", step(w))
    short = F.length(word) < 3
    kept = [c for c in df.columns if c != word]
    # Explode over one element: a filter on the stem must not be pushed down through
    # the chain, where it would be rewritten in terms of the word and grow with each
    # step.
    final = F.when(short, F.col(word)).otherwise(F.lower(w))
    return out.select(*kept, F.explode(F.array(final)).alias(stem))
