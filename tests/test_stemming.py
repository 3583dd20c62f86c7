import random
import re
from io import StringIO
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from trawl.functions import stemming
from trawl.functions.analysis import analyze
from trawl.functions.stemming import STEP_2, STEP_3, STEP_4, stem_words

# Examples of the published description, with the outcome of all steps.
TEXTBOOK = """caresses caress ponies poni ties ti caress caress cats cat feed feed
agreed agre plastered plaster bled bled motoring motor sing sing conflated conflat
troubled troubl sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz
failing fail filing file happy happi sky sky relational relat conditional condit
rational ration valenci valenc hesitanci hesit digitizer digit conformabli conform
radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam
predication predic operator oper feudalism feudal decisiveness decis hopefulness hope
callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl
triplicate triplic formative form formalize formal electriciti electr electrical electr
hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin
gyroscopic gyroscop adjustable adjust defensible defens irritant irrit
replacement replac adjustment adjust dependent depend adoption adopt homologou homolog
communism commun activate activ angulariti angular homologous homolog effective effect
bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll
say sai boy boi is is as as generalizations gener oscillators oscil""".split()


def stems(spark, words):
    frame = spark.createDataFrame([(w, w) for w in words], "w string, word string")
    return {r.w: r.stem for r in stem_words(frame, "word", "stem").collect()}


def test_textbook_words(spark):
    expected = dict(zip(TEXTBOOK[::2], TEXTBOOK[1::2]))
    assert stems(spark, expected) == expected


# --- a letter-by-letter account of the same rules ----------------------------------


def consonant(w, i):
    if w[i] == "y":
        return i == 0 or not consonant(w, i - 1)
    return w[i] not in "aeiou"


def measure(w):
    kinds = "".join("c" if consonant(w, i) else "v" for i in range(len(w)))
    return len(re.findall("v+c+", kinds))


def has_vowel(w):
    return any(not consonant(w, i) for i in range(len(w)))


def ends_short(w):
    return (
        len(w) >= 3
        and [consonant(w, len(w) - i) for i in (3, 2, 1)] == [True, False, True]
        and w[-1] not in "wxy"
    )


def doubled(w):
    return len(w) >= 2 and w[-1] == w[-2] and consonant(w, len(w) - 1)


def longest(w, suffixes):
    found = [s for s in suffixes if w.endswith(s)]
    return max(found, key=len) if found else None


def porter(w):
    if len(w) < 3:
        return w
    if w.endswith(("sses", "ies")):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if measure(w[:-3]) > 0 else w
    else:
        for suffix in ("ed", "ing"):
            if w.endswith(suffix) and has_vowel(w[: -len(suffix)]):
                w = w[: -len(suffix)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif doubled(w) and w[-1] not in "lsz":
                    w = w[:-1]
                elif measure(w) == 1 and ends_short(w):
                    w += "e"
                break
    if w.endswith("y") and has_vowel(w[:-1]):
        w = w[:-1] + "i"
    for table in (STEP_2, STEP_3):
        s = longest(w, table)
        if s and measure(w[: -len(s)]) > 0:
            w = w[: -len(s)] + table[s]
    s = longest(w, STEP_4)
    if s:
        base = w[: -3] if s in ("sion", "tion") else w[: -len(s)]
        w = base if measure(base) > 1 else w
    if w.endswith("e"):
        base = w[:-1]
        if measure(base) > 1 or (measure(base) == 1 and not ends_short(base)):
            w = base
    if w.endswith("l") and doubled(w) and measure(w) > 1:
        w = w[:-1]
    return w


def test_random_words_against_the_letterwise_account(spark):
    draw = random.Random(7)
    tails = [*STEP_2, *STEP_3, *STEP_4, "s", "ies", "sses", "ed", "ing", "eed", "e", "ll", "y", ""]
    letters = "aeiouybcdlmnrstzxw"
    words = set()
    while len(words) < 6000:
        head = "".join(draw.choice(letters) for _ in range(draw.randrange(0, 6)))
        words.add(head + draw.choice(tails) + draw.choice(tails))
    words.discard("")
    expected = {w: porter(w) for w in words}
    got = stems(spark, words)
    assert {w: (got[w], expected[w]) for w in words if got[w] != expected[w]} == {}


def test_accents_and_digits_are_consonants(spark):
    assert stems(spark, ["été", "1990s", "naïves"]) == {
        w: porter(w) for w in ["été", "1990s", "naïves"]
    }


def test_a_filter_on_stems_does_not_grow_the_plan(spark):
    frame = spark.createDataFrame([("a", "caresses")], "k string, word string")
    kept = stem_words(frame, "word", "stem").where("stem = 'caress'")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000
    assert kept.count() == 1


def test_the_generated_stage_is_small_enough_to_compile(spark):
    """The JVM leaves methods above 8000 bytes of bytecode uncompiled."""
    frame = spark.createDataFrame([("a", "some text")], "docno string, text string")
    job = analyze(frame, ["docno"], "text", ["the"]).groupBy("docno", "term").agg(F.count("*"))
    shown = StringIO()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with redirect_stdout(shown):
            job.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
    assert sizes and max(sizes) < 8000


def test_every_suffix_reaches_its_pattern(spark):
    """The test of the last two letters lets pass all that a pattern can match."""
    words = [stem + s for stem in ("", "a", "tr", "relat", "hesit", "vietnam") for s in [*STEP_2, *STEP_3, *STEP_4]]
    frame = spark.createDataFrame([(w,) for w in words], "w string")
    for table in (STEP_2, STEP_3, STEP_4):
        ends = frame.select("w", stemming._ends_like(F.col("w"), table).alias("may")).collect()
        assert all(r.may for r in ends if r.w.endswith(tuple(table)))
        assert not frame.select(stemming._ends_like(F.lit("the"), table).alias("may")).first().may
