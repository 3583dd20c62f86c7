from trawl.functions.analysis import analyze


def terms(spark, text, stop=(), stem=True):
    frame = spark.createDataFrame([(1, text)], "k int, text string")
    found = analyze(frame, ["k"], "text", list(stop), stem)
    return [r.term for r in found.orderBy("pos").collect()]


def test_words_keep_inner_apostrophes_and_underscores(spark):
    assert terms(spark, "o'neill well-known a_b 'quoted'", stem=False) == [
        "o'neill", "well", "known", "a_b", "quoted",
    ]


def test_possessive_goes_before_stop_words(spark):
    assert terms(spark, "The cat's the's dogs’s", ["the"], stem=False) == ["cat", "dogs"]


def test_stop_words_are_case_insensitive_here(spark):
    assert terms(spark, "The THE the cat", ["the"]) == ["cat"]


def test_positions_count_removed_words(spark):
    frame = spark.createDataFrame([(1, "the cat the dog")], "k int, text string")
    found = analyze(frame, ["k"], "text", ["the"]).collect()
    assert sorted((r.pos, r.term) for r in found) == [(1, "cat"), (3, "dog")]


def test_no_words(spark):
    assert terms(spark, " .. ") == []


def test_a_word_needs_a_letter_or_digit(spark):
    text = "____ \u0301 _1 _'_'x __''a '' a\u0301 _'_ 9"
    assert terms(spark, text, stem=False) == ["_1", "_'_'x", "a", "a\u0301", "9"]


def test_a_word_of_very_many_apostrophes(spark):
    text = "x" + "'0" * 100_000
    assert terms(spark, text + " y " + "_'" * 100_000, stem=False) == [text, "y"]


def test_marks_between_letters_or_digits_join_them(spark):
    text = "3.5 1,000 1;2 u.s.a. a:b l\u00b7l a,b 1:2 x.1 1.x .5 5. a..b"
    assert terms(spark, text, stem=False) == [
        "3.5", "1,000", "1;2", "u.s.a", "a:b", "l\u00b7l", "a", "b", "1", "2", "x", "1", "1", "x",
        "5", "5", "a", "b",
    ]


def test_scripts_without_blanks(spark):
    assert terms(spark, "日本語のテスト データベース。kanji漢字", stem=False) == [
        "日", "本", "語", "の", "テスト", "データベース", "kanji", "漢", "字",
    ]
    assert terms(spark, "ภาษาไทย ๑๒.๓ ລາວ ខ្មែរ မြန်မာ 한국어 \U00020000\U00020001", stem=False) == [
        "ภาษาไทย", "๑๒.๓", "ລາວ", "ខ្មែរ", "မြန်မာ", "한국어", "\U00020000", "\U00020001",
    ]


def test_format_characters_stay_with_the_word_before(spark):
    text = "か\u3099 co\u00adop a\u200d \u200db ｶ\uff9e \u200b x\u200by \U0001f600 \u2003"
    assert terms(spark, text, stem=False) == [
        "か\u3099", "co\u00adop", "a\u200d", "b", "ｶ\uff9e", "x", "y",
    ]


def test_very_long_words_of_mixed_letters(spark):
    text = "aé" * 100_000
    thai, marks = "กิ" * 100_000, "a.b:" * 100_000
    assert terms(spark, f"{text} {thai} {marks}", stem=False) == [text, thai, marks[:-1]]
