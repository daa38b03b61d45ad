import sys
import unicodedata

from pyspark.sql import functions as F

from moodwell.functions.chars import latin_letters
from moodwell.functions.symbols import (
    EMOJI_NAMES,
    SETTLED,
    compose,
    find_unlisted,
    is_symbol,
    name_symbols,
    unlisted_symbols,
)


def test_settled_characters_never_change():
    joins = set()
    for code in range(sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(code))
        if parts and not parts.startswith("<"):
            joins.update(int(p, 16) for p in parts.split()[1:])
    joins.update(range(0x1161, 0x1176), range(0x11A8, 0x11C3))
    for first, last in SETTLED:
        for code in range(first, last + 1):
            char = chr(code)
            assert not is_symbol(char), hex(code)
            assert unicodedata.normalize("NFC", char) == char, hex(code)
            assert unicodedata.combining(char) == 0 and code not in joins, hex(code)
    settled = {c for a, b in SETTLED for c in range(a, b + 1)}
    assert not any(ord(c) in settled for emoji in EMOJI_NAMES for c in emoji)


def test_every_known_emoji(spark):
    assert len(EMOJI_NAMES) == 81
    rows = [(e, f"_{n}_ ") for e, n in EMOJI_NAMES.items()]
    df = spark.createDataFrame(rows, "e string, want string")
    got = df.withColumn("s", name_symbols(F.col("e")))
    assert got.where("s.text <> want OR NOT s.named").count() == 0


def test_symbols_against_a_character_loop(spark):
    chars = [chr(c) for c in range(0x20, sys.maxunicode + 1, 7) if not 0xD800 <= c < 0xE000]
    texts = ["a" + "".join(chars[i : i + 50]) for i in range(0, len(chars), 50)]

    def expected(text):
        out = []
        for char in unicodedata.normalize("NFC", text):
            if char in EMOJI_NAMES:
                out.append(f"_{EMOJI_NAMES[char]}_ ")
            elif is_symbol(char):
                name = unicodedata.name(char, "").lower().replace(" ", "_")
                out.append(f"_{name}_ " if name else "")
            else:
                out.append(char)
        return "".join(out)

    rows = [(i, t, expected(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string, want string")
    wrong = df.withColumn("s", name_symbols(F.col("t"))).where("s.text <> want").collect()
    assert not wrong


def test_compose(spark):
    df = spark.createDataFrame([("café",), ("plain",), (None,), ("각",)], "t string")
    got = [r[0] for r in df.select(compose(F.col("t"))).collect()]
    assert got == ["café", "plain", None, "각"]


def test_latin_letters_follow_the_names(spark):
    chars = [(chr(c), "LATIN" in unicodedata.name(chr(c), "")) for c in range(0x41, 0x2100)
             if chr(c).isalpha()]
    df = spark.createDataFrame(chars, "c string, want boolean")
    assert df.where(F.col("c").rlike(latin_letters()) != F.col("want")).count() == 0


def test_unsettled_is_the_rest(spark):
    from moodwell.functions.symbols import NOT_LATIN, UNSETTLED

    settled = {c for a, b in SETTLED for c in range(a, b + 1)}
    codes = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(chr(c), c not in settled) for c in codes], "t string, rest boolean")
    found = F.col("t").rlike(NOT_LATIN) & F.col("t").rlike(UNSETTLED)
    assert df.where(found != F.col("rest")).count() == 0


def test_every_symbol_without_a_listed_name(spark):
    members = list(unlisted_symbols())
    assert len(members) > 5000 and "©" in members and not set(members) & set(EMOJI_NAMES)
    texts = ["".join(members), "© ©x° 😊❤️\U0001fffe", "é", None]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [r[0] for r in rows.select(find_unlisted(F.col("text"))).collect()]
    # Some symbols are written otherwise under NFC.
    whole = [c for c in unicodedata.normalize("NFC", texts[0]) if c in unlisted_symbols()]
    assert found == [whole, ["©", "©", "°"], [], None]
    named = rows.limit(0).sparkSession.createDataFrame([(c,) for c in set(whole)], "c string")
    told = {r.c: r.s.text for r in named.select("c", name_symbols(F.col("c")).alias("s")).collect()}
    assert told == {c: f"_{unlisted_symbols()[c]}_ " for c in set(whole)}


def test_search_for_symbols_leaves_settled_text_alone(spark, capsys):
    """Only text that may hold a symbol is looked through, and by no expression of hundreds of ranges."""
    unlisted = unlisted_symbols()
    assert not {c for a, b in SETTLED for c in map(chr, range(a, b + 1))} & set(unlisted)
    texts = ["plain", "née", "текст", "漢字", "", "a" * 5000 + "🚗", "é ☀", "a̸®", "❤️", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = df.select(find_unlisted(F.col("text")).alias("found"))
    expected = [t and [c for c in unicodedata.normalize("NFC", t) if c in unlisted] for t in texts]
    assert [r.found for r in found.collect()] == [[] if t == "" else e for t, e in zip(texts, expected)]
    found.explain()
    assert "regexp_extract_all" not in capsys.readouterr().out
