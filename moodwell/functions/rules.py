"""The cleaning rules, one column function each."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodwell.functions.chars import (
    LETTER,
    NO_CAPITAL,
    NO_LETTER,
    ODD_SPACE,
    SOLID,
    SPACE,
    WORD,
    latin_letters,
    strip,
    without,
)

# Hashtags that carry no meaning.
NOISE_TAGS = [
    "ff", "f4f", "l4l", "followme", "follow4follow", "followforfollow",
    "like4like", "likeforlike", "repost", "rt", "tfb", "sfs",
    "followback", "teamfollowback", "instagood", "instadaily",
    "photooftheday", "picoftheday",
]

# HTML entities and what they become, in order.
ENTITIES = {
    "&amp;": "and",
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&apos;": "'",
    "&nbsp;": " ",
}

# Words of one or two letters that are not noise.
SHORT_WORDS = [
    "i", "a", "an", "am", "is", "it", "in", "on", "at", "to",
    "no", "me", "my", "we", "us", "or", "be", "do", "go", "so",
    "up", "if", "of", "ok",
]

# Patterns and limits of the rules.
URL = rf"(?i)https?://{SOLID}+|www\.{SOLID}+"
MENTION = rf"@{WORD}+"
SEPARATOR = r"[-=*~_]{4,}"
ASCII_ART = r"[|/\\<>^]{3,}"
MARKS = r"[-=*~_|/\\<>^!?.]{2}"
PLACEHOLDER = rf"_{WORD}+_"
MIN_WORDS = 3
CAPS_SHARE = 0.7
LATIN_SHARE = 0.5
LETTER_SHARE = 0.3
LETTER_SHARE_FROM = 5
NOISE_SHARE = 0.7
NOISE_SHARE_FROM = 3


def strip_urls(text: Column) -> Column:
    # Plain searches cost far less than the pattern, or than lower case for "www.".
    likely = text.contains("://")
    for tail in ("ww.", "wW.", "Ww.", "WW."):
        likely |= text.contains(tail)
    return F.when(likely, without(text, URL)).otherwise(text)


def strip_mentions(text: Column) -> Column:
    return F.when(text.contains("@"), without(text, MENTION)).otherwise(text)


def drop_noise_tags(text: Column) -> Column:
    return without(text, rf"(?i)#(?:{'|'.join(NOISE_TAGS)})(?!{WORD})")


def open_tags(text: Column) -> Column:
    """Put a space into camelCase tags, then drop the ``#`` of every tag."""
    # \G carries on inside the tag that the previous match was in.
    parted = F.regexp_replace(text, rf"((?:#|(?!\A)\G){WORD}*?[a-z])(?=[A-Z])", "$1 ")
    return without(parted, rf"#(?={WORD})")


def expand_hashtags(text: Column) -> Column:
    return F.when(text.contains("#"), open_tags(drop_noise_tags(text))).otherwise(text)


def fix_entities(text: Column) -> Column:
    fixed = text
    for entity, plain in ENTITIES.items():
        fixed = F.replace(fixed, F.lit(entity), F.lit(plain))
    return F.when(text.contains("&"), fixed).otherwise(text)


def strip_separators(text: Column) -> Column:
    return without(text, SEPARATOR)


def strip_ascii_art(text: Column) -> Column:
    return without(text, ASCII_ART)


def collapse_punct(text: Column) -> Column:
    """Runs of ``!`` and ``?`` to one, runs of four or more dots to three."""
    # Drops each mark that enough of its kind follow.
    return without(text, r"[!?.](?:(?<=!)(?=!)|(?<=\?)(?=\?)|(?<=\.)(?=\.{3}))")


def tidy(text: Column) -> Column:
    """Separators, ASCII art and repeated marks, in that order."""
    # All of them need two marks in a row, which most texts do not have.
    tidied = collapse_punct(strip_ascii_art(strip_separators(text)))
    return F.when(text.rlike(MARKS), tidied).otherwise(text)


def breaks_to_spaces(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" "))


def collapse_spaces(text: Column) -> Column:
    return F.when(text.contains("  "), F.regexp_replace(text, " {2,}", " ")).otherwise(text)


def collapse_whitespace(text: Column) -> Column:
    """Runs of spaces, tabs and line feeds to one space; other white space stays."""
    return collapse_spaces(breaks_to_spaces(text))


def without_placeholders(text: Column) -> Column:
    """The text that language detection sees."""
    return strip(without(text, PLACEHOLDER))


def letter_count(text: Column) -> Column:
    return F.length(text) - F.length(without(text, f"{LETTER}+"))


def capital_count(text: Column) -> Column:
    return F.length(without(text, f"{NO_CAPITAL}+"))


def is_all_caps(text: Column, letters: Column) -> Column:
    return F.when(letters > 0, capital_count(text) / letters > CAPS_SHARE).otherwise(False)


def is_latin(text: Column, letters: Column) -> Column:
    """Whether Latin letters are the majority; true for text without letters."""
    # Below U+0250 every letter is Latin but for the ordinals and the micro sign.
    beyond_ascii = F.octet_length(text) != F.length(text)
    mixed = beyond_ascii & text.rlike(r"[\xaa\xb5\xba\x{250}-\x{10ffff}]")
    latin = F.length(text) - F.length(without(text, f"{latin_letters()}+"))
    return F.when(mixed & (letters > 0), latin / letters > LATIN_SHARE).otherwise(True)


def word_count(text: Column) -> Column:
    """Tokens that hold a letter."""
    return F.regexp_count(text, F.lit(f"{LETTER}{SOLID}*+"))


def has_words(text: Column, n: int = MIN_WORDS) -> Column:
    """``word_count(text) >= n`` without reading past the n-th word."""
    return text.rlike(rf"\A(?:{NO_LETTER}*+{LETTER}{SOLID}*+){{{n}}}")


def single_spaced(text: Column) -> Column:
    """Stripped text with each run of white space as one space; cheap if it already is."""
    even = F.regexp_replace(text, rf"{SPACE}++", " ")
    return F.when(text.rlike(ODD_SPACE) | text.contains("  "), even).otherwise(text)


def token_count(spaced: Column) -> Column:
    """Tokens of a ``single_spaced`` text."""
    spaces = F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" "), F.lit("")))
    return F.when(spaced == "", 0).otherwise(spaces + 1)


def noise_token_count(spaced: Column) -> Column:
    """Tokens of one or two characters that are no short word."""
    padded = F.concat(F.lit(" "), spaced, F.lit(" "))
    words = "|".join(SHORT_WORDS)
    return F.regexp_count(padded, F.lit(rf" (?=[^ ]{{1,2}} )(?!(?i:{words}) )"))


def is_gibberish(spaced: Column, letters: Column, length: Column) -> Column:
    """Hardly any letters, or mostly short tokens that are no words.

    Takes the text ``single_spaced`` along with its own letters and length.
    """
    few_letters = (length > LETTER_SHARE_FROM) & (letters / length < LETTER_SHARE)
    tokens = token_count(spaced)
    noisy = F.when(
        tokens >= NOISE_SHARE_FROM, noise_token_count(spaced) / tokens > NOISE_SHARE
    )
    return F.coalesce((spaced == "") | few_letters | noisy, F.lit(False))
