"""Character classes shared by the text rules, as Java regular expressions.

Java's own ``\\w`` and ``\\s`` are ASCII, so the Unicode classes are spelled out.
"""

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTER = r"\p{L}"
NO_LETTER = r"\P{L}"
NO_CAPITAL = r"\P{Lu}"
WORD = r"[\p{L}\p{N}_]"

# ASCII first: Java tests it with a bit set and turns to categories only after that.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0[\x{1680}-\x{3000}&&\p{Z}]]"
SOLID = r"[!-~[^\s\p{Z}\x1c-\x1f\x85]]"

# Holds every space but U+0020, and more: one range is quicker to test than ten.
ODD_SPACE = r"[\t-\r\x1c-\x1f\x85\xa0\x{1680}-\x{3000}]"


def char_ranges(members) -> str:
    """Sorted code points as the inside of a regex character class."""
    spans: list[list[int]] = []
    for code in members:
        if spans and code == spans[-1][1] + 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in spans)


@lru_cache(maxsize=1)
def latin_letters() -> str:
    """Letters whose Unicode name says LATIN; scripts alone would add ordinals and modifiers."""
    return "[{}]".format(
        char_ranges(
            code
            for code in range(0x20000)
            if chr(code).isalpha() and "LATIN" in unicodedata.name(chr(code), "")
        )
    )


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends."""
    edges = F.concat(F.left(text, F.lit(1)), F.right(text, F.lit(1)))
    # The look-behind keeps long inner runs linear: a match may only start where a run starts.
    cut = F.regexp_replace(text, rf"\A{SPACE}++|(?<!{SPACE}){SPACE}++\z", "")
    return F.when(edges.rlike(SPACE), cut).otherwise(text)


def is_blank(text: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return ~F.coalesce(text.rlike(SOLID), F.lit(False))


def without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")
