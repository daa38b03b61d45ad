"""The three tables of the application, derived from the test tables.

The SQL texts serve Spark and the checking engine alike where both read them
the same way. Every document keeps its whole text; by ``doc_id`` it gets an
addition or a change that one of the cleaning rules answers to.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
CYRILLIC = "абцдефгхийклмнопярстувшщыз"

DECORATED = f"""CASE doc_id % 18
 WHEN 0 THEN text
 WHEN 1 THEN text || ' 😠😠 I am so angry😡'
 WHEN 2 THEN text || ' https://example.com/a?b=1 WWW.example.org HTTP://x.y'
 WHEN 3 THEN text || ' @user_1 @café a@b.example'
 WHEN 4 THEN text || ' #climateChange ##TwoHashes #happy #été_Été #aB#cD'
 WHEN 5 THEN text || ' #FollowMe #f4f #rtx #RT'
 WHEN 6 THEN text || ' salt &amp; pepper &lt;x&gt; &nbsp; &amp;lt; &copy; &quot;q&quot; &apos;'
 WHEN 7 THEN text || ' it&#39;s a happy day'
 WHEN 8 THEN text || ' ----- =-=-= |||| &lt;&lt;&lt; ab**cd __x__'
 WHEN 9 THEN text || ' wow!!!! why??? hmm..... ok.. what?!?! so...'
 WHEN 10 THEN '  ' || text || chr(9) || chr(10) || chr(10) || 'end  '
 WHEN 11 THEN translate(text, '{LOWER}', '{UPPER}')
 WHEN 12 THEN text || ' ❤️ ⚠️ ⚠ 💚 café 🚗🚗 © 21° 😠️'
 WHEN 13 THEN translate(text, '{LOWER}', '{CYRILLIC}')
 WHEN 14 THEN replace(replace(text, ' ', ''), chr(10), '')
 WHEN 15 THEN CASE WHEN n_chars % 2 = 0 THEN NULL ELSE repeat(' ', CAST(length(text) AS INT)) END
 WHEN 16 THEN translate(text, 'aeiouyéèáóíüöäñst', '                 ')
 ELSE translate(text, 'bcdefghijklmnopqrstuvwxyz', '1234567890123456789012345')
END"""

EMOTION_OF_DOC = """CASE doc_id % 7 WHEN 0 THEN 'joy' WHEN 1 THEN 'anger' WHEN 2 THEN 'fear'
 WHEN 3 THEN 'disgust' WHEN 4 THEN 'sadness' WHEN 5 THEN 'surprise' ELSE 'neutral' END"""

CONFIDENCE_OF_DOC = "CAST(CAST(doc_id % 101 AS DOUBLE) / 100 AS DECIMAL(3,2))"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hours(start: str, modulus: int) -> str:
    return (
        f"timestamp_ntz'{start}' + make_dt_interval(0, CAST(doc_id % {modulus} AS INT), 0, 0)"
    )


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = _hours("2024-01-01 00:00:00", 97)
    return read_table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS id",
        "source AS batch_id",
        "'web' AS platform",
        "lang AS keyword",
        f"{DECORATED} AS raw_text",
        f"CASE WHEN n_chars % 50 <> 0 THEN {created} END AS created_at",
        "concat('{\"upvotes\": ', n_chars, '}') AS raw_json",
        f"{created} AS fetched_at",
    )


def cleaned_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts in all languages but Spanish, whose cleaning is behind."""
    return (
        read_table(spark, sf_dir, "documents")
        .where("lang <> 'es'")
        .selectExpr(
            "doc_id AS id",
            "doc_id AS raw_post_id",
            "source AS batch_id",
            "CASE WHEN n_chars >= 60 THEN text ELSE '' END AS cleaned_text",
            "lang AS language",
            "doc_id % 18 IN (1, 12) AS emoji_converted",
            "CASE WHEN n_chars >= 60 THEN 'ok' ELSE 'too_short' END AS status",
            "array('had_urls') AS flags",
            f"{_hours('2024-02-01 00:00:00', 97)} AS processed_at",
        )
    )


def enriched_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for each cleaned post that ``labels`` knows."""
    scored = (
        read_table(spark, sf_dir, "documents")
        .where("lang <> 'es'")
        .select("doc_id", "source")
        .join(read_table(spark, sf_dir, "labels").select("doc_id"), "doc_id")
    )
    shares = ", ".join(
        f"'{e}', CASE WHEN {EMOTION_OF_DOC} = '{e}' THEN CAST({CONFIDENCE_OF_DOC} AS DOUBLE) "
        "ELSE 0.0D END"
        for e in ["joy", "anger", "fear", "disgust", "sadness", "surprise", "neutral"]
    )
    return scored.selectExpr(
        "doc_id AS id",
        "doc_id AS cleaned_post_id",
        "source AS batch_id",
        f"{EMOTION_OF_DOC} AS emotion_label",
        f"{CONFIDENCE_OF_DOC} AS confidence",
        f"{CONFIDENCE_OF_DOC} AS emotion_intensity",
        f"named_struct({shares}) AS emotion_distribution_data",
        f"{_hours('2024-03-01 00:00:00', 89)} AS analyzed_at",
    )


RAW_SQL = f"""SELECT doc_id AS id, source AS batch_id, 'web' AS platform, lang AS keyword,
 {DECORATED} AS raw_text,
 CASE WHEN n_chars % 50 <> 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_hours(doc_id % 97) END AS created_at,
 concat('{{"upvotes": ', n_chars, '}}') AS raw_json
 FROM documents"""

CLEANED_SQL = """SELECT doc_id AS id, doc_id AS raw_post_id, source AS batch_id,
 CASE WHEN n_chars >= 60 THEN text ELSE '' END AS cleaned_text, lang AS language,
 doc_id % 18 IN (1, 12) AS emoji_converted,
 CASE WHEN n_chars >= 60 THEN 'ok' ELSE 'too_short' END AS status,
 TIMESTAMP '2024-02-01 00:00:00' + to_hours(doc_id % 97) AS processed_at
 FROM documents WHERE lang <> 'es'"""

ENRICHED_SQL = f"""SELECT doc_id AS id, doc_id AS cleaned_post_id, source AS batch_id,
 {EMOTION_OF_DOC} AS emotion_label, {CONFIDENCE_OF_DOC} AS confidence,
 TIMESTAMP '2024-03-01 00:00:00' + to_hours(doc_id % 89) AS analyzed_at
 FROM documents JOIN labels USING (doc_id) WHERE lang <> 'es'"""

WITH_TABLES = f"""WITH raw_posts AS ({RAW_SQL}),
cleaned_posts AS ({CLEANED_SQL}),
enriched_posts AS ({ENRICHED_SQL})
"""
