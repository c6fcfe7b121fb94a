"""Text cleaning and token functions: Column -> Column, all JVM-side.

The character classes are spelled out because ``\\w`` and ``\\s`` differ between
engines: here a word character is any letter, any number or ``_``, and white space
is the Unicode set.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxlens.wordlists import APPLE_WORDS, SAMSUNG_WORDS

SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
WORD = r"\p{L}\p{N}_"

# The character sets, URL form and emoji blocks of the cleaners.
REVIEW_DROP = rf"[^가-힣a-zA-Z0-9{SPACE}.,!?]"
HANGUL_DROP = rf"[^가-힣ㄱ-ㅎㅏ-ㅣ{SPACE}]"
EMOTICON_DROP = rf"[^가-힣0-9a-zA-Z{SPACE}]"
EMOJI = (
    r"\x{203C}\x{2049}\x{2139}\x{2194}-\x{21AA}\x{231A}-\x{23FF}\x{24C2}\x{25AA}-\x{25FE}"
    r"\x{2600}-\x{27BF}\x{2934}\x{2935}\x{2B05}-\x{2B55}\x{3030}\x{303D}\x{3297}\x{3299}"
    r"\x{200D}\x{20E3}\x{FE0F}\x{1F000}-\x{1FAFF}\x{E0020}-\x{E007F}"
)
SOCIAL_DROP = rf"[^ .,?!/@$%~％·∼()\x00-\x7Fㄱ-ㅣ가-힣{EMOJI}]+"
URL = (
    r"https?://(www\.)?[-a-zA-Z0-9@:%._+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b"
    r"([-a-zA-Z0-9()@:%_+.~#?&/=]*)"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"[{SPACE}]+", " "))


def any_of(words) -> str:
    """Regular expression that finds any of the words literally; of no words, nothing."""
    if not words:
        return "(?!)"
    return "|".join(re.sub(r"([^0-9A-Za-z_\s가-힣])", r"\\\1", w) for w in words)


def clean_review(c) -> Column:
    """Lower-case; keep Hangul, Latin, digits and sentence marks; one space; NULL gives ''."""
    return F.coalesce(_squeeze(F.regexp_replace(F.lower(_col(c)), REVIEW_DROP, "")), F.lit(""))


def clean_basic(c) -> Column:
    """Lower-case, without punctuation and without digits."""
    plain = F.regexp_replace(F.lower(_col(c)), f"[^{WORD}{SPACE}]", "")
    return F.regexp_replace(plain, r"\p{Nd}+", "")


def hangul_only(c) -> Column:
    return F.regexp_replace(_col(c), HANGUL_DROP, "")


def drop_emoticons(c) -> Column:
    return F.regexp_replace(_col(c), EMOTICON_DROP, "")


def flatten_lines(c) -> Column:
    return F.translate(_col(c), "\n", " ")


def clean_comment(c) -> Column:
    """Drop symbols except the comma, runs of initial consonants and one-letter words."""
    plain = F.regexp_replace(_col(c), f"[^{WORD}{SPACE},]", "")
    plain = F.regexp_replace(plain, "[ㄱ-ㅎ]{2,}", "")
    return F.regexp_replace(plain, f"(?<![{WORD}])[{WORD}](?![{WORD}])", "")


def clean_social(c) -> Column:
    """Disallowed runs to one space, no emoji, no links, no letter more than twice in a row."""
    plain = F.regexp_replace(_col(c), SOCIAL_DROP, " ")
    plain = F.regexp_replace(plain, f"[{EMOJI}]", "")
    plain = F.regexp_replace(plain, URL, "")
    plain = F.regexp_replace(plain, rf"([{WORD}])\1{{2,}}", "$1$1")
    return _squeeze(plain)


def ascii_only(c) -> Column:
    """Without emoji and any other character beyond ASCII."""
    return F.regexp_replace(_col(c), r"[^\x00-\x7F]+", "")


def drop_special(c) -> Column:
    return F.regexp_replace(_col(c).cast("string"), f"[^{WORD}{SPACE}]", "")


def has_special(c) -> Column:
    return _col(c).cast("string").rlike(f"[^{WORD}{SPACE}]")


def words(c) -> Column:
    """White-space pieces, empty ones dropped."""
    return F.filter(F.split(_col(c), f"[{SPACE}]+"), lambda w: w != "")


def word_tokens(c, min_len: int = 2) -> Column:
    """Lower-cased runs of word characters, at least ``min_len`` long."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(f"[{WORD}]{{{min_len},}}"), 0)


def join_words(c) -> Column:
    return F.array_join(_col(c), " ")


def min_length(c, n: int = 2) -> Column:
    return F.filter(_col(c), lambda w: F.length(w) >= n)


def without(c, stop) -> Column:
    """Token list without the listed words; repeats of other tokens stay."""
    stop = list(stop)
    return F.filter(_col(c), lambda w: ~w.isin(stop)) if stop else _col(c)


def grams(c, n: int) -> Column:
    """Sliding n-grams of a token list, joined by one space."""
    tokens = _col(c)
    if n == 1:
        return tokens
    # Shifted copies zipped position by position; no access into the array by index.
    size = F.size(tokens) - (n - 1)
    joined = F.slice(tokens, F.lit(1), F.greatest(size, F.lit(0)))
    for shift in range(1, n):
        following = F.slice(tokens, F.lit(shift + 1), F.greatest(size, F.lit(0)))
        joined = F.zip_with(joined, following, lambda a, b: F.concat_ws(" ", a, b))
    return joined


def classify_brand(c, first=("apple", APPLE_WORDS), second=("samsung", SAMSUNG_WORDS), case_sensitive: bool = True) -> Column:
    """Name of the brand whose words occur, ``both`` or ``neither``. NULL text is ``neither``."""
    text = _col(c) if case_sensitive else F.lower(_col(c))
    (name_a, words_a), (name_b, words_b) = first, second
    in_a = F.coalesce(text.rlike(any_of(words_a)), F.lit(False))
    in_b = F.coalesce(text.rlike(any_of(words_b)), F.lit(False))
    return (
        F.when(in_a & in_b, "both").when(in_a, name_a).when(in_b, name_b).otherwise("neither")
    )


def lexicon_sentiment(tokens, positive, negative) -> Column:
    """positive / negative by the larger number of listed words, neutral on a tie. The
    tokens are walked once: only the difference of the two counts matters."""
    positive, negative = list(positive), list(negative)
    balance = F.aggregate(
        F.coalesce(_col(tokens), F.array().cast("array<string>")), F.lit(0),
        lambda acc, w: acc + w.isin(positive).cast("int") - w.isin(negative).cast("int"),
    )
    names = F.array(F.lit("negative"), F.lit("neutral"), F.lit("positive"))
    return F.element_at(names, (F.signum(balance) + 2).cast("int"))


def lexicon_score(c, positive, negative) -> Column:
    """Struct of ``label``, the polarity with more listed words, and ``confidence``, its share
    of the listed words; neutral on a tie, 0.0 without any. The words are walked once."""
    tokens = F.coalesce(words(c), F.array().cast("array<string>"))

    def listed(w, names) -> Column:
        return w.isin(list(names)).cast("int") if names else F.lit(0)

    def result(acc) -> Column:
        pos, neg = acc["pos"], acc["neg"]
        label = F.when(pos > neg, "positive").when(pos < neg, "negative").otherwise("neutral")
        share = F.when(pos + neg > 0, F.greatest(pos, neg) / (pos + neg)).otherwise(F.lit(0.0))
        return F.struct(label.alias("label"), share.alias("confidence"))

    positive, negative = list(positive), list(negative)
    return F.aggregate(
        tokens, F.struct(F.lit(0).alias("pos"), F.lit(0).alias("neg")),
        lambda acc, w: F.struct((acc["pos"] + listed(w, positive)).alias("pos"), (acc["neg"] + listed(w, negative)).alias("neg")),
        result,
    )
