"""Golden rows for the cleaning rules; language is trained, so its flag is left out."""

import pytest
from pyspark.sql import functions as F

from moodwell.operators.cleaning import (
    clean_posts,
    clean_response,
    clean_stage,
    normalize_text,
    uncleaned,
)

GOLDEN = [
    ("This queue is slow 😠", "This queue is slow _angry_face_", "ok", "had_emojis"),
    ("Late again 😠😠 this morning", "Late again _angry_face_ _angry_face_ this morning", "ok", "had_emojis"),
    ("We are 😠", "We are _angry_face_", "ok", "had_emojis"),
    (
        "Paint it 💙 like my old van 🚗",
        "Paint it _blue_heart_ like my old van _automobile_",
        "ok",
        "had_emojis",
    ),
    ("Tea ❤️ then ⚠️ then ⚠", "Tea _red_heart_ then _warning_ then _warning_", "ok", "had_emojis"),
    ("all rights © reserved 21° here", "all rights _copyright_sign_ reserved 21_degree_sign_ here",
     "ok", "had_emojis"),
    ("odd \U0001fbff code points here", "odd code points here", "ok", ""),
    ("thumbs 👍🏽 up and more", "thumbs _thumbs_up_ 🏽 up and more", "ok", "had_emojis"),
    ("The map at www.example.com shows every stop", "The map at shows every stop", "ok", "had_urls"),
    ("Look up HTTPS://Example.com/x?y before noon", "Look up before noon", "ok", "had_urls"),
    ("Dinner with @user1 and @user2 was late", "Dinner with and was late", "ok", "had_mentions"),
    ("Dinner with @café_1 was late", "Dinner with was late", "ok", "had_mentions"),
    ("write to me@site.org please now", "write to me.org please now", "ok", "had_mentions"),
    ("Rain stopped #happy we walk home", "Rain stopped happy we walk home", "ok", "had_hashtags"),
    (
        "Notes on #RiverWalks and #WinterLight",
        "Notes on River Walks and Winter Light",
        "ok",
        "had_hashtags",
    ),
    ("My garden grows #followme #f4f every spring", "My garden grows every spring", "ok", "had_hashtags"),
    ("nonHashtag camelCase stays #aB so", "nonHashtag camelCase stays a B so", "ok", "had_hashtags"),
    ("Bread &amp; cheese travel well", "Bread and cheese travel well", "ok", "encoding_issue"),
    ("A&amp;B is one name", "AandB is one name", "ok", "encoding_issue"),
    ("it&#39;s a fine day", "it&39;s a fine day", "ok", "had_hashtags"),
    ("Printed &copy; 2019 by two friends", "Printed &copy; 2019 by two friends", "ok", ""),
    ("Upper shelf ----- lower shelf", "Upper shelf lower shelf", "ok", ""),
    ("one &lt;&lt;&lt; two three", "one two three", "ok", "encoding_issue"),
    ("Where??????? Not here?????? hm..", "Where? Not here? hm..", "ok", ""),
    ("The kettle........then it sang", "The kettle...then it sang", "ok", ""),
    ("Top row\n\n\nNext\trow  down", "Top row Next row down", "ok", ""),
    ("We NEED that ladder back soon", "We NEED that ladder back soon", "ok", ""),
    ("WHO TOOK THE LADDER AWAY", "WHO TOOK THE LADDER AWAY", "ok", "all_caps"),
    ("isn't shan't couldn't NOR neither", "isn't shan't couldn't NOR neither", "ok", ""),
    (None, None, "too_short", ""),
    ("", None, "too_short", ""),
    ("   \n\t 　", None, "too_short", ""),
    ("hi ok", None, "too_short", ""),
    ("?!;:,.()[]{}<>+%$^*", None, "too_short", ""),
    ("今天早上的面包很好吃", None, "too_short", ""),
    ("القطار وصل الى المدينة باكرا", "القطار وصل الى المدينة باكرا", "non_latin_script", ""),
    ("half абв half абвг абвгд", "half абв half абвг абвгд", "non_latin_script", ""),
    ("zq xw vk 12 q9 text", None, "gibberish", ""),
    ("a1234567 b1234567 c1234567", None, "gibberish", ""),
    ("plomvu qwazet dufgin zebrok wertulan", "plomvu qwazet dufgin zebrok wertulan", "ok", ""),
    (
        "Hey @driver 😠😡 see https://bus.example #lateAgain was crowded &amp; noisy "
        "all day!!!!! -----",
        "Hey _angry_face_ _enraged_face_ see late Again was crowded and noisy all day!",
        "ok",
        "had_emojis,had_urls,had_mentions,had_hashtags,encoding_issue",
    ),
]


@pytest.fixture(scope="module")
def posts(spark):
    rows = [(i, "b", row[0]) for i, row in enumerate(GOLDEN)]
    return spark.createDataFrame(rows, "id long, batch_id string, raw_text string")


def test_golden_rows(posts):
    cleaned = clean_posts(posts).withColumn("flags", F.array_join("flags", ",")).orderBy("id")
    for row, (text, want, status, flags) in zip(cleaned.collect(), GOLDEN):
        assert (row.cleaned_text, row.status, row.flags) == (want, status, flags), text
        assert row.emoji_converted == ("had_emojis" in flags)
        assert row.language == "en"


def test_every_post_gives_one_row(posts):
    assert clean_posts(posts).count() == len(GOLDEN)


def test_clean_text_stays_the_same(spark, posts):
    once = clean_posts(posts).where("status = 'ok'").select("id", F.col("cleaned_text").alias("t"))
    kept = once.where(~F.col("t").rlike("[&#]"))
    again = clean_posts(kept, "t")
    assert again.where(~F.col("cleaned_text").eqNullSafe(F.col("t"))).count() == 0


def test_long_tag_and_long_runs(spark):
    tag = "#" + "fooBar" * 3000
    texts = [(tag + " one two three",), ("one" + " " * 20000 + "two three",), ("字" * 50000,)]
    got = clean_posts(spark.createDataFrame(texts, "raw_text string")).collect()
    assert got[0].cleaned_text == "foo Bar" * 3000 + " one two three"
    assert got[1].status == "ok" and len(got[1].cleaned_text) == len('one two three')
    assert got[2].status == "too_short"


def test_rules_run_once_and_python_once(spark, posts):
    plan = clean_posts(posts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("[-=*~_]{4,}, , 1") == 1
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in plan


def test_ascii_texts_skip_python(spark):
    df = spark.createDataFrame([("plain",), ("naïve façade ñ",), ("“quoted”",), ("😠",)], "t string")
    from moodwell.functions.symbols import unsettled

    assert [r[0] for r in df.select(unsettled(F.col("t"))).collect()] == [None, None, None, "😠"]


def test_stage_skips_cleaned_posts_and_keeps_empty_text(spark, posts):
    moment = F.lit("2024-01-01 00:00:00")
    first = clean_stage(posts, None, moment)
    rows = {r.raw_post_id: r for r in first.collect()}
    assert len(rows) == len(GOLDEN)
    assert rows[31].cleaned_text == "" and rows[31].id == 31
    some = first.where("raw_post_id < 10")
    rest = clean_stage(posts, some, moment, batch_id="b")
    assert rest.count() == len(GOLDEN) - 10
    assert clean_stage(posts, first, moment).count() == 0
    assert uncleaned(posts, some).count() == len(GOLDEN) - 10
    moved = some.withColumn("batch_id", F.lit("other"))
    assert clean_stage(posts, moved, moment).count() == len(GOLDEN) - 10
    shown = {r.post_id: r for r in clean_response(first).collect()}
    assert shown[31].cleaned_text is None and shown[0].cleaned_text == "This queue is slow _angry_face_"


def test_normalize_keeps_rows_in_place(posts):
    assert normalize_text(posts, "raw_text").count() == posts.count()


def test_filters_on_results_do_not_repeat_the_rules(posts):
    found = clean_posts(posts).where("status = 'ok' AND cleaned_text LIKE '%love%'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("[-=*~_]{4,}, , 1") == 1 and plan.count("ArrowEvalPython") == 1
