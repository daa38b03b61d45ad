"""Emoji and other symbols written out as words.

Spark has no Unicode normalisation and the JVM's character tables lag behind
Python's, so this one step runs as an Arrow-batched UDF. Text that cannot change
is recognised in the JVM and handed to Python as null.
"""

import re
import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Emoji with a name of their own. The other symbols take their
# Unicode name. Each name is written with an underscore on either side and a
# space after it.
EMOJI_NAMES = {
    # anger
    "😠": "angry_face",
    "😡": "enraged_face",
    "😤": "face_with_steam",
    "🤬": "face_with_symbols_on_mouth",
    # joy
    "😊": "smiling_face",
    "😄": "grinning_face",
    "😁": "beaming_face",
    "😃": "grinning_face_with_big_eyes",
    "🙂": "slightly_smiling_face",
    "😀": "grinning_face",
    "🥰": "smiling_face_with_hearts",
    "😍": "heart_eyes_face",
    # sadness
    "😞": "disappointed_face",
    "😢": "crying_face",
    "😭": "loudly_crying_face",
    "😔": "pensive_face",
    "🥺": "pleading_face",
    "😿": "crying_cat",
    # fear
    "😨": "fearful_face",
    "😟": "worried_face",
    "😰": "anxious_face_with_sweat",
    "😱": "face_screaming_in_fear",
    "🫣": "face_with_peeking_eye",
    # surprise
    "😲": "astonished_face",
    "😮": "face_with_open_mouth",
    "🤯": "exploding_head",
    "😯": "hushed_face",
    # disgust
    "🤢": "nauseated_face",
    "🤮": "face_vomiting",
    "😒": "unamused_face",
    # hearts
    "❤️": "red_heart",
    "❤": "red_heart",
    "💚": "green_heart",
    "💙": "blue_heart",
    "💛": "yellow_heart",
    "💜": "purple_heart",
    "🖤": "black_heart",
    "🤍": "white_heart",
    "💔": "broken_heart",
    "💕": "two_hearts",
    "💗": "growing_heart",
    "💖": "sparkling_heart",
    # other
    "🔥": "fire",
    "🚀": "rocket",
    "🎉": "party_popper",
    "🌍": "earth_globe",
    "✨": "sparkles",
    "👍": "thumbs_up",
    "👎": "thumbs_down",
    "👏": "clapping_hands",
    "🙏": "folded_hands",
    "💪": "flexed_biceps",
    "😂": "face_with_tears_of_joy",
    "🤣": "rolling_on_floor_laughing",
    "😅": "grinning_face_with_sweat",
    "🤔": "thinking_face",
    "🤷": "person_shrugging",
    "🙄": "face_with_rolling_eyes",
    "😴": "sleeping_face",
    "🥳": "partying_face",
    "😎": "smiling_face_with_sunglasses",
    "🤗": "hugging_face",
    "😈": "smiling_face_with_horns",
    "👀": "eyes",
    "💀": "skull",
    "🫠": "melting_face",
    "💯": "hundred_points",
    "⭐": "star",
    "🌟": "glowing_star",
    "🏆": "trophy",
    "⚡": "high_voltage",
    "🎯": "bullseye",
    "🤝": "handshake",
    "✅": "check_mark",
    "❌": "cross_mark",
    "⚠️": "warning",
    "⚠": "warning",
    "💡": "light_bulb",
    "📢": "loudspeaker",
    "🗣️": "speaking_head",
    "🗣": "speaking_head",
}

EMOJI_STYLE = "\ufe0f"

# Ranges where no character is a symbol, changes under NFC or joins the one
# before it. Text made of these alone is its own result.
SETTLED = [
    (0x0000, 0x00A5),
    (0x00A7, 0x00A8),
    (0x00AA, 0x00AD),
    (0x00AF, 0x00AF),
    (0x00B1, 0x02FF),
    (0x038E, 0x03A1),
    (0x03A3, 0x03F5),
    (0x0400, 0x0481),
    (0x048A, 0x052F),
    (0x05D0, 0x05EA),
    (0x0620, 0x064A),
    (0x2010, 0x2027),
    (0x2030, 0x205E),
    (0x20A0, 0x20BF),
    (0x3041, 0x3096),
    (0x30A1, 0x30FA),
    (0x4E00, 0x9FFC),
    (0xAC00, 0xD7A3),
    (0xFF01, 0xFF5E),
]

# Below U+0300 only four characters are not settled, which makes the first test
# quick. Both classes say what they look for: Java is slow at negated ranges.
NOT_LATIN = r"[\xa6\xa9\xae\xb0\x{300}-\x{10ffff}]"
UNSETTLED = "[{}]".format(
    "".join(
        rf"\x{{{last + 1:x}}}-\x{{{first - 1:x}}}"
        for (_, last), (first, _) in zip(SETTLED, [*SETTLED[1:], (0x110000, 0x110000)])
    )
)

SPELLED = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("named", T.BooleanType())]
)


def is_symbol(char: str) -> bool:
    kind = unicodedata.category(char)
    return kind == "So" or (kind == "Cn" and char > "\U0001f000")


def symbol_class() -> str:
    """Character class of everything that is written out."""
    symbols = {c for c in map(chr, range(0xA0, sys.maxunicode + 1)) if is_symbol(c)}
    spans: list[list[int]] = []
    for code in sorted(map(ord, symbols.union(emoji[0] for emoji in EMOJI_NAMES))):
        if spans and code == spans[-1][1] + 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[{}]".format("".join(f"{chr(a)}-{chr(b)}" for a, b in spans))


@lru_cache(maxsize=1)
def unlisted_symbols() -> dict[str, str]:
    """The symbols that are not in the list, with the names that they get from Unicode."""
    names = {c: unicodedata.name(c, "") for c in map(chr, range(0xA0, sys.maxunicode + 1)) if is_symbol(c)}
    return {c: name.lower().replace(" ", "_") for c, name in names.items() if name and c not in EMOJI_NAMES}


# The UDFs are closures: they travel with the plan, and executors need no copy
# of this package.
@lru_cache(maxsize=1)
def _spelling_udf():
    names, style = dict(EMOJI_NAMES), EMOJI_STYLE
    pattern = re.compile(f"({symbol_class()})({style}?)")

    def spell(text: str | None) -> tuple[str | None, bool | None]:
        if text is None:
            return None, None
        named = 0

        def write_out(match: re.Match) -> str:
            nonlocal named
            symbol, rest = match.groups()
            if symbol + rest in names:
                symbol, rest = symbol + rest, ""
            name = names.get(symbol) or unicodedata.name(symbol, "").lower().replace(" ", "_")
            # Unassigned code points have no name: they vanish and do not count.
            named += bool(name)
            return (f"_{name}_ " if name else "") + rest

        spelled = pattern.sub(write_out, unicodedata.normalize("NFC", text))
        return spelled, named > 0

    def spell_batch(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([spell(t) for t in texts], columns=["text", "named"])

    return F.pandas_udf(spell_batch, SPELLED)


@lru_cache(maxsize=1)
def _composing_udf():
    def compose_batch(texts: pd.Series) -> pd.Series:
        return texts.astype("object").str.normalize("NFC")

    return F.pandas_udf(compose_batch, T.StringType())


def unsettled(text: Column) -> Column:
    """The text if it may change under NFC or holds symbols, else null."""
    # From cheap to exact: equal byte and character counts mean ASCII.
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(~ascii_only & text.rlike(NOT_LATIN) & text.rlike(UNSETTLED), text)


@lru_cache(maxsize=1)
def _finding_udf():
    symbols = frozenset(unlisted_symbols())

    def find(text: str | None) -> list[str] | None:
        if text is None:
            return None
        composed = unicodedata.normalize("NFC", text)
        return [] if symbols.isdisjoint(composed) else [c for c in composed if c in symbols]

    def find_batch(texts: pd.Series) -> pd.Series:
        return pd.Series([find(t) for t in texts], dtype="object")

    return F.pandas_udf(find_batch, T.ArrayType(T.StringType()))


def find_unlisted(text: Column) -> Column:
    """Every symbol of a text that is not in the list, one by one."""
    # Settled text holds none. Java would try some 200 ranges at each of its characters.
    none = F.when(text.isNotNull(), F.array().cast("array<string>"))
    return F.coalesce(_finding_udf()(unsettled(text)), none)


def compose(text: Column) -> Column:
    """Unicode NFC."""
    return F.coalesce(_composing_udf()(unsettled(text)), text)


def name_symbols(text: Column, suspect: Column | None = None) -> Column:
    """NFC, then every symbol as ``_its_name_ ``: struct of ``text`` and ``named``.

    ``suspect`` may pass ``unsettled(text)`` as a column of its own.
    """
    spelled = _spelling_udf()(unsettled(text) if suspect is None else suspect)
    return F.struct(
        F.coalesce(spelled["text"], text).alias("text"),
        F.coalesce(spelled["named"], F.lit(False)).alias("named"),
    )
