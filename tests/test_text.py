"""Golden strings of the text functions."""

import pytest
from pyspark.sql import functions as F

from voxlens.functions import answers, text
from voxlens.functions.vectors import cosine, softmax, top_label


def value(spark, fn, given):
    df = spark.createDataFrame([(given,)], "t string")
    return df.select(fn("t").alias("r")).first()["r"]


@pytest.mark.parametrize("fn, given, wanted", [
    (text.clean_review, "  정말 좋은\n폰!! ★ S24 Ultra ㅋㅋ ", "정말 좋은 폰!! s24 ultra"),
    (text.clean_review, None, ""),
    (text.clean_review, "★★", ""),
    (text.clean_basic, "Gut, 100점! S24_울트라", "gut 점 s_울트라"),
    (text.clean_basic, None, None),
    (text.hangul_only, "폰 good ㅋㅋ ㅏ 10", "폰  ㅋㅋ ㅏ "),
    (text.drop_emoticons, "폰😀 ok^^ ㅋㅋ", "폰 ok "),
    (text.flatten_lines, "a\nb\n\nc", "a b  c"),
    (text.clean_comment, "최고!! ㅋㅋㅋ a 폰, 화질 b2", "최고   , 화질 b2"),
    (text.clean_social, "와아아아아 😀 최고 https://www.ex.com/a?b=1 좋다  좋다♥", "와아아 최고 좋다 좋다"),
    (text.clean_social, "aaab 漢字 hmmmm!!!!", "aab hmm!!!!"),
    (text.clean_social, None, None),
    (text.ascii_only, "ok 폰😀 100%", "ok  100%"),
    (text.words, " a　b \t c\n", ["a", "b", "c"]),
    (text.words, "", []),
    (text.words, None, None),
    (text.word_tokens, "The 폰 화질 a über_2", ["the", "화질", "über_2"]),
])
def test_cleaners(spark, fn, given, wanted):
    assert value(spark, fn, given) == wanted


def test_one_letter_words_go_when_short_tokens_are_wanted(spark):
    assert value(spark, lambda c: text.word_tokens(c, 1), "펜 과 앱") == ["펜", "과", "앱"]


def test_grams(spark):
    assert value(spark, lambda c: text.grams(text.words(c), 2), "a b c") == ["a b", "b c"]
    assert value(spark, lambda c: text.grams(text.words(c), 3), "a b c d") == ["a b c", "b c d"]
    assert value(spark, lambda c: text.grams(text.words(c), 2), "a") == []
    assert value(spark, lambda c: text.grams(text.words(c), 2), "") == []


@pytest.mark.parametrize("given, wanted", [
    ("아이폰 16", "apple"), ("갤럭시 노트", "samsung"), ("아이폰보다 갤럭시", "both"), ("best phones", "neither"), (None, "neither"),
])
def test_brand(spark, given, wanted):
    from voxlens.wordlists import APPLE_WORDS, SAMSUNG_WORDS
    fn = lambda c: text.classify_brand(c, ("apple", APPLE_WORDS), ("samsung", SAMSUNG_WORDS))
    assert value(spark, fn, given) == wanted


@pytest.mark.parametrize("given, wanted", [
    ("만족 만족 별로", "positive"), ("만족 별로", "neutral"), ("별로 최악", "negative"), ("", "neutral"), (None, "neutral"),
])
def test_sentiment(spark, given, wanted):
    from voxlens.wordlists import NEGATIVE_WORDS, POSITIVE_WORDS
    fn = lambda c: text.lexicon_sentiment(text.words(c), POSITIVE_WORDS, NEGATIVE_WORDS)
    assert value(spark, fn, given) == wanted


def test_any_of_quotes_pattern_signs(spark):
    df = spark.createDataFrame([("a.b",), ("axb",), ("c+",), ("(d",)], "t string")
    found = df.where(F.col("t").rlike(text.any_of(["a.b", "c+", "(d"]))).collect()
    assert sorted(r["t"] for r in found) == ["(d", "a.b", "c+"]


@pytest.mark.parametrize("given, wanted", [
    ("화질, 음질,속도 , '배터리', 편집", True), ("화질, 음질, 속도, 배터리", False), ("화질, 음질, , 배터리, 편집", False),
    ("a,b,c,d,e,f", False), ("", False), (None, False), ("a,b,c,d,　", False),
])
def test_five_keywords(spark, given, wanted):
    assert value(spark, lambda c: answers.valid_keywords(answers.parse_keywords(c)), given) is wanted


def test_answer_parts(spark):
    assert value(spark, answers.last_line, "Here you are:\n\n a, b \n") == "a, b"
    assert value(spark, answers.parse_nested, "[['키워드 : 음질'], ['이어폰']]") == ["키워드 : 음질", "이어폰"]
    assert value(spark, answers.parse_flag, "Answer: 1") == 1
    assert value(spark, answers.parse_flag, None) == 0
    assert value(spark, answers.parse_flag, "") == 0


def test_prompt(spark):
    df = spark.createDataFrame([("게임", None)], "a string, b string")
    row = df.select(answers.build_prompt("{a}: {b}{a} {c", a="a", b="b").alias("p")).first()
    assert row["p"] == "게임: 게임 {c"


def test_scores(spark):
    df = spark.createDataFrame([([1.0, 1000.0, 2.0],)], "s array<double>")
    row = df.select(top_label("s", ["x", "y", "z"]).alias("b"), softmax("s").alias("p")).first()
    assert (row["b"]["label"], row["b"]["confidence"]) == ("y", 1.0)
    assert row["p"] == [0.0, 1.0, 0.0]
    zero = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert zero.select(cosine("a", "b").alias("c")).first()["c"] is None
