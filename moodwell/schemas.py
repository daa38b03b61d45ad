"""Schemas of the stored tables and the values they may hold."""

from pyspark.sql import types as T

# The emotions, in the order used for ties and for reports.
EMOTIONS = ["joy", "anger", "fear", "disgust", "sadness", "surprise", "neutral"]

# Status of a cleaned post, in the order the tests are applied.
STATUSES = ["too_short", "gibberish", "non_latin_script", "ok"]

# Flags of a cleaned post, in the order they are listed.
FLAGS = [
    "had_emojis",
    "had_urls",
    "had_mentions",
    "had_hashtags",
    "encoding_issue",
    "mixed_language",
    "all_caps",
]

DISTRIBUTION = T.StructType([T.StructField(e, T.DoubleType()) for e in EMOTIONS])

COMMENTS = T.StructType(
    [
        T.StructField("device", T.StringType()),
        T.StructField("comment_id", T.LongType()),
        T.StructField("comment", T.StringType()),
    ]
)

RAW_POSTS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("platform", T.StringType(), False),
        T.StructField("keyword", T.StringType()),
        T.StructField("raw_text", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("raw_json", T.StringType()),
        T.StructField("fetched_at", T.TimestampNTZType()),
    ]
)

CLEANED_POSTS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("raw_post_id", T.LongType(), False),
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("cleaned_text", T.StringType(), False),
        T.StructField("language", T.StringType()),
        T.StructField("emoji_converted", T.BooleanType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("flags", T.ArrayType(T.StringType()), False),
        T.StructField("processed_at", T.TimestampNTZType()),
    ]
)

ENRICHED_POSTS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("cleaned_post_id", T.LongType(), False),
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("emotion_label", T.StringType()),
        T.StructField("confidence", T.DecimalType(3, 2)),
        T.StructField("emotion_intensity", T.DecimalType(3, 2)),
        T.StructField("emotion_distribution_data", DISTRIBUTION),
        T.StructField("analyzed_at", T.TimestampNTZType()),
    ]
)
