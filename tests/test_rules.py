"""Rules against plain loops over the same definition."""

import random
import re
import sys

import pytest
from pyspark.sql import functions as F

from moodwell.functions import rules
from moodwell.functions.chars import (
    LETTER,
    NO_CAPITAL,
    NO_LETTER,
    ODD_SPACE,
    SOLID,
    SPACE,
    WORD,
    is_blank,
    strip,
)

ALPHABET = list("aAbBzZ09_#@&;!?.-=|<> \t\n\r\x0b  éÉжЖ字") + [
    "#f4f", "#RT", "&amp;", "&lt;", "http://x", "www.y", "ok", "is", "....", "--", "||",
]


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(3000)]
    return spark.createDataFrame(list(enumerate(texts)), "i int, t string").cache()


def check(samples, column, expected):
    for row in samples.select("t", column.alias("got")).collect():
        assert row.got == expected(row.t), repr(row.t)


def test_strip(samples):
    check(samples, strip(F.col("t")), str.strip)


def test_is_blank(samples):
    check(samples, is_blank(F.col("t")), lambda t: not t.strip())


def test_collapse_whitespace(samples):
    check(samples, strip(rules.collapse_whitespace(F.col("t"))), lambda t: re.sub("[ \t\n]+", " ", t).strip())


def test_collapse_punct(samples):
    def runs(text):
        out, i = "", 0
        while i < len(text):
            j = i
            while j < len(text) and text[j] == text[i]:
                j += 1
            n = j - i
            limit = {"!": 1, "?": 1}.get(text[i], 3 if text[i] == "." and n > 3 else n)
            out, i = out + text[i] * min(n, limit), j
        return out

    check(samples, rules.collapse_punct(F.col("t")), runs)


def test_tidy(samples):
    def passes(text):
        text = re.sub("[-=*~_]{4,}", "", text)
        text = re.sub(r"[|/\\\\<>^]{3,}", "", text)
        text = re.sub("!{2,}", "!", text)
        return re.sub(r"\.{4,}", "...", re.sub(r"\?{2,}", "?", text))

    check(samples, rules.tidy(F.col("t")), passes)


def test_hashtags(samples):
    def walk(text):
        out, i = "", 0
        while i < len(text):
            j = i + 1
            while text[i] == "#" and j < len(text) and (text[j].isalnum() or text[j] == "_"):
                j += 1
            if j == i + 1:
                out, i = out + text[i], j
                continue
            tag = text[i + 1 : j]
            if tag.lower() not in rules.NOISE_TAGS:
                for k, char in enumerate(tag):
                    if k and "A" <= char <= "Z" and "a" <= tag[k - 1] <= "z":
                        out += " "
                    out += char
            i = j
        return out

    check(samples, rules.expand_hashtags(F.col("t")), walk)


def test_urls_and_mentions(samples):
    check(samples, rules.strip_urls(F.col("t")), lambda t: re.sub(r"(?i)https?://\S+|www\.\S+", "", t))
    check(samples, rules.strip_mentions(F.col("t")), lambda t: re.sub(r"@\w+", "", t))


def test_tokens_and_noise(samples):
    spaced = rules.single_spaced(strip(F.col("t")))
    check(samples, rules.token_count(spaced), lambda t: len(t.split()))
    check(
        samples,
        rules.noise_token_count(spaced),
        lambda t: sum(len(w) < 3 and w.lower() not in rules.SHORT_WORDS for w in t.split()),
    )


def test_letters_and_words(samples):
    check(samples, rules.letter_count(F.col("t")), lambda t: sum(map(str.isalpha, t)))
    check(samples, rules.capital_count(F.col("t")), lambda t: sum(c.isalpha() and c.isupper() for c in t))

    def words(text):
        return sum(any(map(str.isalpha, w)) for w in text.split())

    check(samples, rules.word_count(F.col("t")), words)
    check(samples, rules.has_words(F.col("t")), lambda t: words(t) >= 3)


def test_gibberish(samples):
    text = strip(F.col("t"))
    letters, spaced = rules.letter_count(text), rules.single_spaced(text)

    def expected(raw):
        text, tokens = raw.strip(), raw.split()
        share = sum(map(str.isalpha, text)) / max(1, len(text))
        noise = sum(len(w) < 3 and w.lower() not in rules.SHORT_WORDS for w in tokens)
        return (
            not text
            or (len(text) > 5 and share < 0.3)
            or (len(tokens) >= 3 and noise / len(tokens) > 0.7)
        )

    check(samples, rules.is_gibberish(spaced, letters, F.length(text)), expected)


def test_latin(spark):
    df = spark.createDataFrame(
        [("abc", True), ("abc абв", False), ("abcd абв", True), ("123", True), ("ªº", False), ("", True)],
        "t string, want boolean",
    )
    got = df.withColumn("got", rules.is_latin(F.col("t"), rules.letter_count(F.col("t"))))
    assert got.where("got <> want").count() == 0


def test_classes_agree_with_python_on_all_characters(spark):
    """Where they differ, the JVM does not know the character yet."""
    codes = [(c, chr(c)) for c in range(0, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame(
        [(t, t.isalnum() or t == "_", t.isspace(), t.isalpha(), t.isalpha() and t.isupper())
         for _, t in codes],
        "t string, word boolean, space boolean, letter boolean, upper boolean",
    )
    t = F.col("t")
    wrong = (
        (t.rlike(WORD) != F.col("word"))
        | (t.rlike(SPACE) != F.col("space"))
        | (t.rlike(SOLID) == F.col("space"))
        | (t.rlike(LETTER) != F.col("letter"))
        | (t.rlike(NO_LETTER) == F.col("letter"))
        | (t.rlike(NO_CAPITAL) == F.col("upper"))
        | (F.col("space") & (t != " ") & ~t.rlike(ODD_SPACE))
    )
    assert df.where(wrong & ~t.rlike(r"\p{Cn}")).count() == 0
