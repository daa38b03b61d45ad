"""One query per operator over the test tables, each on whole tables and texts."""

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwell.functions import rules
from moodwell.functions.chars import is_blank, strip
from moodwell.functions.emotions import model_scorer
from moodwell.functions.ids import ingest_batch_id, search_batch_id
from moodwell.functions.moments import moment
from moodwell.functions.symbols import compose, find_unlisted, name_symbols
from moodwell.operators import (
    batches,
    cleaning,
    emotion_training,
    explorer,
    ingest,
    language,
    progress,
    reports,
    scoring,
)
from moodwell.operators.cleaning import clean_posts
from moodwell.plans import deletion, flow
from moodwell.plans.testviews import cleaned_posts, enriched_posts, raw_posts, read_table
from moodwell.schemas import CLEANED_POSTS, COMMENTS, EMOTIONS, ENRICHED_POSTS, RAW_POSTS
from moodwell.session import work_folder
from moodwell.sources import buckets
from moodwell.sources.comments import read_comments_csv
from moodwell.sources.tables import append_posts, export_csv, read_posts
from moodwell.streaming.incremental import clean_and_score_stream, watch_raw_posts

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

MOMENT = datetime(2024, 5, 1, 12, 0, 0)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """origin, id and text of all posts, pages and conversation turns."""
    posts = raw_posts(spark, sf_dir).select(
        F.lit("post").alias("origin"), "id", F.col("raw_text").alias("text")
    )
    pages = read_table(spark, sf_dir, "pages").select(
        F.lit("page").alias("origin"), F.col("page_id").alias("id"), F.col("html").alias("text")
    )
    turns = read_table(spark, sf_dir, "conversations").select(
        F.lit("turn").alias("origin"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text"
    )
    return posts.unionByName(pages).unionByName(turns)


def stated(column: str):
    """A moment as text, the same in every engine."""
    return F.col(column).cast("string").alias(column)


def as_number(column: str):
    return F.col(column).cast("double").alias(column)


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as source comments under unevenly written keywords."""
    device = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("  "), F.upper("lang"))).otherwise(
        F.col("lang")
    )
    comment = F.when(F.col("n_chars") % 40 == 0, "").otherwise(
        F.concat(F.lit(" "), F.col("text"), F.lit(" \n"))
    )
    return read_table(spark, sf_dir, "documents").select(
        device.alias("device"), F.col("doc_id").alias("comment_id"), comment.alias("comment")
    )


# Sources, sinks and ingestion


@query
def scan_csv_comments(spark, sf_dir):
    path = work_folder(spark, "comments")
    export_csv(comments(spark, sf_dir).select(*COMMENTS.names), path)
    return read_comments_csv(spark, path)


@query
def ingest_keyword_match(spark, sf_dir):
    return ingest.match_comments(comments(spark, sf_dir), " En ")


@query
def ingest_limit(spark, sf_dir):
    return ingest.match_comments(comments(spark, sf_dir), "fr", limit=50)


@query
def ingest_ilike(spark, sf_dir):
    return ingest.match_comments(comments(spark, sf_dir), "%E_", mode="ilike")


@query
def batch_slug_ingest(spark, sf_dir):
    titles = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit(" "), F.col("source"), F.lit(" A "), F.col("lang")).alias("kw")
    )
    suffix = F.lpad(F.col("doc_id").cast("string"), 8, "0")
    return titles.select("doc_id", ingest_batch_id(F.col("kw"), suffix).alias("batch_id"))


@query
def ingest_batch(spark, sf_dir):
    found = ingest.match_comments(comments(spark, sf_dir), "de")
    rows = ingest.to_raw_posts(found, "de-0a1b2c3d", "de", "csv", moment(MOMENT))
    return rows.select(
        "id", "batch_id", "platform", "keyword", "raw_text", stated("created_at"), "raw_json"
    )


@query
def ingest_keys(spark, sf_dir):
    """Two batches ingested into a table, the first of them twice: keys without gaps, given once."""
    raw = f"{work_folder(spark, 'ingested')}/raw"
    source = comments(spark, sf_dir)
    for keyword in ("en", "De", "en"):
        flow.run_ingestion(source, raw, keyword, "0a1b2c3d", MOMENT)
    posts = read_posts(spark, raw, RAW_POSTS)
    return posts.select("id", "batch_id", "platform", "keyword", "raw_text", stated("created_at"))


@query
def raw_json_payload(spark, sf_dir):
    posts = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("keyword"),
        F.when(F.col("doc_id") % 3 == 0, F.col("n_chars")).alias("upvotes"),
        F.when(F.col("doc_id") % 5 == 0, F.lit("joy")).alias("emotion"),
    )
    return ingest.with_raw_json(posts).select("id", "platform", "keyword", "raw_json")


@query
def cleaned_sink_roundtrip(spark, sf_dir):
    path = work_folder(spark, "cleaned")
    append_posts(cleaned_posts(spark, sf_dir), path)
    back = read_posts(spark, path, CLEANED_POSTS)
    return back.select(
        "id", "batch_id", "cleaned_text", "language", "emoji_converted", "status",
        stated("processed_at"),
    )


@query
def enriched_sink_roundtrip(spark, sf_dir):
    path = work_folder(spark, "enriched")
    append_posts(enriched_posts(spark, sf_dir), path)
    back = read_posts(spark, path, ENRICHED_POSTS)
    return back.select(
        "cleaned_post_id", "batch_id", "emotion_label", as_number("confidence"),
        F.col("emotion_distribution_data.joy").alias("joy"), stated("analyzed_at"),
    )


@query
def export_csv_roundtrip(spark, sf_dir):
    path = work_folder(spark, "export")
    export_csv(enriched_posts(spark, sf_dir), path)
    schema = "id long, cleaned_post_id long, batch_id string, emotion_label string, "
    schema += "confidence double, emotion_intensity double, emotion_distribution_data string, "
    back = spark.read.schema(schema + "analyzed_at string").option("header", True)
    return back.option("escape", '"').csv(path).select("id", "batch_id", "emotion_label", "confidence")


@query
def simple_clean_first_emoji(spark, sf_dir):
    raw = raw_posts(spark, sf_dir)
    bounds = raw.agg(F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    return ingest.simple_clean_posts(raw, bounds.lo, bounds.hi)


@query
def delete_batch_cascade(spark, sf_dir):
    left = batches.drop_batch(
        raw_posts(spark, sf_dir), cleaned_posts(spark, sf_dir), enriched_posts(spark, sf_dir), "src3"
    )
    return remaining(left[:3], left[3])


@query
def delete_stored_batch(spark, sf_dir):
    """The same, from stored tables."""
    folder = work_folder(spark, "deletion")
    views = [raw_posts(spark, sf_dir), cleaned_posts(spark, sf_dir), enriched_posts(spark, sf_dir)]
    paths = [f"{folder}/{name}" for name in ("raw", "cleaned", "enriched")]
    for view, path in zip(views, paths):
        append_posts(view, path)
    gone = deletion.run_deletion(spark, *paths, "src3")
    schemas = [RAW_POSTS, CLEANED_POSTS, ENRICHED_POSTS]
    left = [read_posts(spark, path, schema) for path, schema in zip(paths, schemas)]
    return remaining(left, spark.createDataFrame([gone], "raw_deleted long, cleaned_deleted long"))


def remaining(left, counts):
    """What is left of the three tables by batch, and how many rows of the batch went."""
    names = ["raw_posts", "cleaned_posts", "enriched_posts"]
    kept = [
        reports.posts_per_batch(df).select(F.lit(name).alias("item"), "batch_id", "posts")
        for name, df in zip(names, left)
    ]
    gone = counts.select(
        F.inline(
            F.array(
                F.struct(F.lit("raw_deleted").alias("item"), F.lit("src3").alias("batch_id"),
                         F.col("raw_deleted").cast("bigint").alias("posts")),
                F.struct(F.lit("cleaned_deleted").alias("item"), F.lit("src3").alias("batch_id"),
                         F.col("cleaned_deleted").cast("bigint").alias("posts")),
            )
        )
    )
    return kept[0].unionByName(kept[1]).unionByName(kept[2]).unionByName(gone)


# Batch assignment


@query
def search_posts(spark, sf_dir):
    found = batches.search_posts(raw_posts(spark, sf_dir), "HA_PY")
    return found.select("id", "platform", "keyword", "raw_text", "batch_id", stated("created_at"))


@query
def search_topk(spark, sf_dir):
    found = batches.search_posts(raw_posts(spark, sf_dir), "En")
    return batches.newest(found, 50).select("id", "batch_id", "keyword", stated("created_at"))


@query
def assign_batch(spark, sf_dir):
    raw = raw_posts(spark, sf_dir)
    matched = batches.newest(batches.search_posts(raw, "happy"), 200)
    return batches.assign_batch(raw, matched, "frontend-happy-1700000000").select(
        "id", "batch_id", "keyword"
    )


@query
def assign_preview(spark, sf_dir):
    raw = raw_posts(spark, sf_dir)
    matched = batches.newest(batches.search_posts(raw, "happy"), 50)
    counted = matched.agg(F.count("*").alias("n"))
    return (
        batches.assignment_preview(matched)
        .select("id", "batch_id", "keyword", "raw_text")
        .withColumn("matched_count", counted.scalar())
    )


@query
def batch_slug_search(spark, sf_dir):
    titles = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 9 == 0, " ?! ")
        .otherwise(F.concat(F.lit(" --É"), F.col("source"), F.lit(" & "), F.upper("lang")))
        .alias("kw"),
    )
    suffix = (F.col("doc_id") + 1700000000).cast("string")
    return titles.select("doc_id", search_batch_id(F.col("kw"), suffix).alias("batch_id"))


# Cleaning rules


def rule_query(name: str, rule) -> None:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        changed = texts(spark, sf_dir).withColumn("out", rule(F.col("text")))
        return changed.select(
            "origin", "id", "out", F.coalesce(F.col("out") != F.col("text"), F.lit(False)).alias("hit")
        )

    QUERIES[name] = build


rule_query("clean_nfc", compose)
rule_query("strip_urls", rules.strip_urls)
rule_query("strip_mentions", rules.strip_mentions)
rule_query("hashtags_noise", rules.drop_noise_tags)
rule_query("hashtags_words", rules.expand_hashtags)
rule_query("fix_entities", rules.fix_entities)
rule_query("strip_separators", rules.strip_separators)
rule_query("strip_ascii_art", rules.strip_ascii_art)
rule_query("collapse_punct", rules.collapse_punct)
rule_query("collapse_whitespace", lambda text: strip(rules.collapse_whitespace(text)))
rule_query("detection_text", rules.without_placeholders)


@query
def clean_null_guard(spark, sf_dir):
    cleaned = clean_posts(texts(spark, sf_dir), "text")
    return cleaned.where(is_blank(F.col("text"))).select(
        "origin", "id", "cleaned_text", "language", "emoji_converted", "status",
        F.array_join("flags", ",").alias("flags"),
    )


@query
def emoji_known(spark, sf_dir):
    named = texts(spark, sf_dir).withColumn("s", name_symbols(F.col("text")))
    return named.select("origin", "id", F.col("s.text").alias("out"), F.col("s.named").alias("hit"))


@query
def emoji_unknown(spark, sf_dir):
    """The symbols without a name of their own, by the name they get."""
    found = texts(spark, sf_dir).select(F.explode(find_unlisted(F.col("text"))).alias("symbol"))
    uses = found.groupBy("symbol").agg(F.count("*").alias("uses"))
    named = uses.withColumn("s", name_symbols(F.col("symbol")))
    return named.select(F.rtrim(F.col("s.text")).alias("symbol"), "uses")


@query
def flag_all_caps(spark, sf_dir):
    counted = texts(spark, sf_dir).withColumn("letters", rules.letter_count(F.col("text")))
    return counted.select(
        "origin", "id", F.col("letters").cast("bigint").alias("letters"),
        rules.capital_count(F.col("text")).cast("bigint").alias("capitals"),
        rules.is_all_caps(F.col("text"), F.col("letters")).alias("all_caps"),
    )


@query
def script_latin(spark, sf_dir):
    counted = texts(spark, sf_dir).withColumn("letters", rules.letter_count(F.col("text")))
    return counted.select(
        "origin", "id", rules.is_latin(F.col("text"), F.col("letters")).alias("latin")
    )


@query
def meaningful_words(spark, sf_dir):
    return texts(spark, sf_dir).select(
        "origin", "id", rules.word_count(F.col("text")).cast("bigint").alias("words"),
        rules.has_words(F.col("text")).alias("enough"),
    )


@query
def gibberish_score(spark, sf_dir):
    shaped = (
        texts(spark, sf_dir)
        .withColumn("text", strip(F.col("text")))
        .withColumn("spaced", rules.single_spaced(F.col("text")))
        .withColumn("letters", rules.letter_count(F.col("text")))
    )
    gibberish = rules.is_gibberish(F.col("spaced"), F.col("letters"), F.length("text"))
    return shaped.select(
        "origin", "id", rules.token_count(F.col("spaced")).cast("bigint").alias("tokens"),
        rules.noise_token_count(F.col("spaced")).cast("bigint").alias("noise"),
        gibberish.alias("gibberish"),
    )


def trained(spark: SparkSession, sf_dir: str) -> language.LanguageModel:
    documents = read_table(spark, sf_dir, "documents")
    return language.load_model(language.train_profile(documents))


@query
def clean_batch(spark, sf_dir):
    """The flagship: every post cleaned by all rules, its language detected."""
    posts = raw_posts(spark, sf_dir).select("id", "batch_id", "raw_text")
    cleaned = clean_posts(posts, model=trained(spark, sf_dir))
    return cleaned.select(
        F.col("id").alias("post_id"), "batch_id", "cleaned_text", "language",
        "emoji_converted", "status", F.array_join("flags", ",").alias("flags"),
    )


@query
def clean_rules(spark, sf_dir):
    """Cleaning of posts, pages and turns without language detection."""
    cleaned = clean_posts(texts(spark, sf_dir), "text")
    return cleaned.select(
        "origin", "id", "cleaned_text", "emoji_converted", "status",
        F.array_join("flags", ",").alias("flags"),
    )


@query
def clean_status(spark, sf_dir):
    return clean_posts(texts(spark, sf_dir), "text").select("origin", "id", "status")


@query
def clean_flags(spark, sf_dir):
    cleaned = clean_posts(texts(spark, sf_dir), "text")
    return cleaned.select("origin", F.explode("flags").alias("flag")).groupBy("origin", "flag").agg(
        F.count("*").alias("posts")
    )


@query
def clean_stage(spark, sf_dir):
    """Posts not cleaned yet, as rows of the cleaned table."""
    rows = cleaning.clean_stage(
        raw_posts(spark, sf_dir), cleaned_posts(spark, sf_dir), moment(MOMENT)
    )
    return rows.select(
        "id", "raw_post_id", "batch_id", "cleaned_text", "emoji_converted", "status",
        F.array_join("flags", ",").alias("flags"), stated("processed_at"),
    )


@query
def clean_answer(spark, sf_dir):
    rows = cleaning.clean_stage(raw_posts(spark, sf_dir), None, moment(MOMENT))
    return cleaning.clean_response(rows).select("post_id", "batch_id", "cleaned_text", "status")


@query
def status_breakdown(spark, sf_dir):
    posts = raw_posts(spark, sf_dir)
    return reports.status_breakdown(clean_posts(posts))


# Language


@query
def langid_profile(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents")
    profile = language.train_profile(documents)
    return profile.select("lang", F.posexplode("costs").alias("bucket", "cost")).select(
        "lang", F.col("bucket").cast("bigint").alias("bucket"), F.col("cost").cast("bigint").alias("cost")
    )


@query
def langid_detect(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents")
    scored = language.with_language_costs(documents, trained(spark, sf_dir), "text")
    return scored.select("doc_id", F.inline("language_costs")).select("doc_id", "lang", "cost")


@query
def langid_mixed(spark, sf_dir):
    found = language.detect_language(texts(spark, sf_dir), trained(spark, sf_dir))
    return found.select("origin", "id", "language", "mixed_language")


@query
def langid_joined(spark, sf_dir):
    """Every document with the next one behind it, half of which are in two languages."""
    documents = read_table(spark, sf_dir, "documents")
    after = documents.select((F.col("doc_id") - 1).alias("doc_id"), F.col("lang").alias("second"), F.col("text").alias("more"))
    both = documents.join(after, "doc_id").select(
        "doc_id", (F.col("lang") != F.col("second")).alias("differ"), F.concat("text", F.lit(" "), "more").alias("text")
    )
    found = language.detect_language(both, trained(spark, sf_dir))
    return found.select("doc_id", "differ", "language", "mixed_language")


@query
def langid_unknown(spark, sf_dir):
    """A model of two languages on documents in four: the others are in no known language."""
    documents = read_table(spark, sf_dir, "documents")
    known = documents.where("lang IN ('en', 'fr')")
    model = language.load_model(language.train_profile(known.where("doc_id % 5 <> 4")))
    model = language.with_limit(model, known.where("doc_id % 5 = 4"))
    return language.detect_language(documents, model).select("doc_id", "lang", "language")


@query
def langid_confusion(spark, sf_dir):
    """Given and detected languages of the fifth of the documents that the model did not learn from."""
    documents = read_table(spark, sf_dir, "documents")
    model = language.load_model(language.train_profile(documents.where("doc_id % 5 <> 4")))
    found = language.detect_language(documents.where("doc_id % 5 = 4"), model)
    return language.language_confusion(found)


# Emotions


def emotion_columns():
    return ["emotion_label", "confidence", *EMOTIONS]


@query
def score_lexicon(spark, sf_dir):
    return scoring.score_posts(texts(spark, sf_dir), text_col="text").select(
        "origin", "id", *emotion_columns()
    )


LEARNED, LEFT_OUT = "id % 5 <> 4", "id % 5 = 4"


@query
def emotion_profile(spark, sf_dir):
    """What seed words teach of all words: a cost per emotion and bucket, from four fifths of the texts."""
    labelled = emotion_training.weak_labels(texts(spark, sf_dir).where(LEARNED), "text")
    profile = emotion_training.emotion_profile(labelled)
    return profile.select(
        "label", F.col("prior").cast("bigint").alias("prior"), F.posexplode("costs").alias("bucket", "cost")
    ).select(
        "label", "prior", F.col("bucket").cast("bigint").alias("bucket"), F.col("cost").cast("bigint").alias("cost")
    )


@query
def emotion_agreement(spark, sf_dir):
    """How the trained model labels the fifth of the texts that it did not learn from."""
    rows = texts(spark, sf_dir)
    labelled = emotion_training.weak_labels(rows.where(LEARNED), "text")
    model = emotion_training.load_emotions(emotion_training.emotion_profile(labelled))
    judged = emotion_training.with_costs(
        emotion_training.weak_labels(rows.where(LEFT_OUT), "text"), model, "words", "costs"
    )
    told = judged.withColumn("told", emotion_training.cheapest(F.col("costs"), model.labels))
    return told.groupBy("label", "told").agg(F.count("*").alias("texts"))


@query
def score_fallback(spark, sf_dir):
    """Scores with a scorer that fails on half of the posts."""

    def flaky(text):
        ok = F.length(text) % 2 == 0
        return F.when(ok, F.array(F.struct(F.lit("fear").alias("label"), F.lit(0.75).alias("score"))))

    posts = raw_posts(spark, sf_dir)
    return scoring.score_posts(posts, flaky, "raw_text").select(
        "id", "scoring_failed", *emotion_columns()
    )


def made_up_scores():
    """Scores computed from the columns of a document, labels as a model might write them."""

    def entry(label, expression):
        return F.struct(F.lit(label).alias("label"), F.expr(expression).alias("score"))

    return F.array(
        entry("JOY", "CAST(doc_id % 97 AS DOUBLE) / 97"),
        entry("Anger", "CAST(n_chars % 89 AS DOUBLE) / 89"),
        entry("bogus", "CAST(1 AS DOUBLE)"),
        entry("fear", "CAST(doc_id % 7 AS DOUBLE) / 7"),
        entry("sadness", "CAST(n_chars % 5 AS DOUBLE) / 5"),
        entry("Sadness", "CAST(n_chars % 3 AS DOUBLE) / 3"),
    )


@query
def score_normalize(spark, sf_dir):
    scored = read_table(spark, sf_dir, "documents").withColumn("scores", made_up_scores())
    return scoring.label_scores(scored).select("doc_id", *EMOTIONS)


@query
def score_argmax(spark, sf_dir):
    scored = read_table(spark, sf_dir, "documents").withColumn("scores", made_up_scores())
    return scoring.label_scores(scored).select("doc_id", "emotion_label", "confidence")


@query
def score_model_stub(spark, sf_dir):
    """A Python model behind the model adapter: scores from vowel counts."""
    def load():
        def vowels(batch):
            counts = [[t.lower().count(v) for v in "aeiou"] for t in batch]
            labels = ["joy", "anger", "fear", "sadness", "neutral"]
            return [
                [{"label": l, "score": n / max(1, sum(row))} for l, n in zip(labels, row)]
                for row in counts
            ]

        return vowels

    turns = read_table(spark, sf_dir, "conversations")
    return scoring.score_posts(turns, model_scorer(load), "text").select(
        "conv_id", "turn", *emotion_columns()
    )


@query
def confidence_decimal(spark, sf_dir):
    scored = read_table(spark, sf_dir, "documents").withColumn("scores", made_up_scores())
    stored = scoring.label_scores(scored).select(
        "doc_id", F.col("confidence").cast("decimal(3,2)").alias("confidence")
    )
    return stored.select("doc_id", as_number("confidence"))


@query
def enrich_record(spark, sf_dir):
    scored = read_table(spark, sf_dir, "documents").withColumn("scores", made_up_scores())
    labelled = scoring.label_scores(
        scored.select(F.col("doc_id").alias("id"), F.col("source").alias("batch_id"), "scores")
    )
    rows = scoring.to_enriched(labelled, moment(MOMENT))
    return rows.select(
        "cleaned_post_id", "batch_id", "emotion_label", as_number("confidence"),
        as_number("emotion_intensity"), F.col("emotion_distribution_data.joy").alias("joy"),
        F.col("emotion_distribution_data.sadness").alias("sadness"), stated("analyzed_at"),
    )


@query
def enrich_stage(spark, sf_dir):
    rows = scoring.enrich_stage(
        cleaned_posts(spark, sf_dir), enriched_posts(spark, sf_dir), moment(MOMENT)
    )
    return rows.select("cleaned_post_id", "batch_id", "emotion_label", as_number("confidence"))


# Joins


@query
def unanalyzed_posts(spark, sf_dir):
    left = scoring.unanalyzed(cleaned_posts(spark, sf_dir), enriched_posts(spark, sf_dir))
    return left.select("id", "batch_id", "language", "cleaned_text")


@query
def uncleaned_posts(spark, sf_dir):
    left = cleaning.uncleaned(raw_posts(spark, sf_dir), cleaned_posts(spark, sf_dir))
    return left.select("id", "batch_id", "keyword")


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.joined_posts(
        raw_posts(spark, sf_dir), cleaned_posts(spark, sf_dir),
        enriched_posts(spark, sf_dir), same_ids=True,
    )


@query
def joined_posts(spark, sf_dir):
    return joined(spark, sf_dir).select(
        "raw_post_id", "batch_id", "raw_text", "keyword", "cleaned_text", "language",
        "emotion_label", as_number("confidence"), stated("analyzed_at"),
    )


def bucketed(spark: SparkSession, sf_dir: str) -> str:
    """The three tables in buckets; returns the prefix of their names."""
    prefix, folder = f"posts_{uuid.uuid4().hex}", work_folder(spark, "buckets")
    for stage, view in zip(buckets.KEYS, (raw_posts, cleaned_posts, enriched_posts), strict=True):
        buckets.append_bucketed(view(spark, sf_dir), prefix, stage, 8, folder)
    return prefix


@query
def joined_in_place(spark, sf_dir):
    return buckets.joined_in_place(spark, bucketed(spark, sf_dir)).select(
        "raw_post_id", "batch_id", "raw_text", "keyword", "cleaned_text", "language",
        "emotion_label", as_number("confidence"), stated("analyzed_at"),
    )


@query
def unanalyzed_in_place(spark, sf_dir):
    left = buckets.unanalyzed_in_place(spark, bucketed(spark, sf_dir))
    return left.select("id", "batch_id", "language", "cleaned_text")


@query
def unanalyzed_by_batch(spark, sf_dir):
    return progress.unanalyzed_by_batch(cleaned_posts(spark, sf_dir), enriched_posts(spark, sf_dir))


# Counts and reports


@query
def cleaning_stats(spark, sf_dir):
    return progress.cleaning_stats(raw_posts(spark, sf_dir), cleaned_posts(spark, sf_dir))


@query
def analysis_stats(spark, sf_dir):
    return progress.analysis_stats(cleaned_posts(spark, sf_dir), enriched_posts(spark, sf_dir))


@query
def batch_results(spark, sf_dir):
    return reports.batch_results(enriched_posts(spark, sf_dir)).select(
        "batch_id", "total_results", "id", "emotion_label", as_number("confidence"),
        stated("analyzed_at"),
    )


@query
def hero_counts(spark, sf_dir):
    return reports.hero_counts(joined(spark, sf_dir))


@query
def emotion_distribution(spark, sf_dir):
    return reports.emotion_distribution(joined(spark, sf_dir))


@query
def emotion_share(spark, sf_dir):
    return reports.emotion_share(joined(spark, sf_dir))


@query
def emotion_percentage(spark, sf_dir):
    return reports.emotion_percentage(enriched_posts(spark, sf_dir))


@query
def confidence_by_emotion(spark, sf_dir):
    return reports.confidence_by_emotion(enriched_posts(spark, sf_dir))


@query
def emotion_by_batch(spark, sf_dir):
    return reports.emotion_by_batch(enriched_posts(spark, sf_dir))


@query
def posts_per_batch_cleaned(spark, sf_dir):
    return reports.posts_per_batch(cleaned_posts(spark, sf_dir))


@query
def posts_per_batch_raw(spark, sf_dir):
    return reports.posts_per_batch(raw_posts(spark, sf_dir))


@query
def distinct_counts(spark, sf_dir):
    return reports.distinct_counts(raw_posts(spark, sf_dir))


@query
def fleet_status(spark, sf_dir):
    return progress.fleet_status(cleaned_posts(spark, sf_dir), enriched_posts(spark, sf_dir))


@query
def unanalyzed_limit(spark, sf_dir):
    rows = scoring.enrich_stage(
        cleaned_posts(spark, sf_dir), enriched_posts(spark, sf_dir), moment(MOMENT), limit=100
    )
    return rows.select("cleaned_post_id", "batch_id", "emotion_label")


@query
def table_counts(spark, sf_dir):
    return reports.table_counts(
        {
            "raw_posts": raw_posts(spark, sf_dir),
            "cleaned_posts": cleaned_posts(spark, sf_dir),
            "enriched_posts": enriched_posts(spark, sf_dir),
        }
    )


REPORTED = {"src0": "Test Batch: Zero", "src7": "Test Batch: Seven", "absent": "Test Batch: Absent"}


@query
def batch_count_report(spark, sf_dir):
    return reports.batch_count_report(raw_posts(spark, sf_dir), REPORTED)


# Explorer


@query
def explore_text(spark, sf_dir):
    return explorer.explore(joined(spark, sf_dir), text="  Happy|An(gr)y ").select(
        "raw_post_id", "emotion_label", "confidence"
    )


@query
def explore_literal(spark, sf_dir):
    return explorer.explore(joined(spark, sf_dir), text="wow!!!! why???", literal=True).select(
        "raw_post_id", "emotion_label", "confidence"
    )


@query
def explore_emotion(spark, sf_dir):
    return explorer.explore(joined(spark, sf_dir), emotion="fear").select(
        "raw_post_id", "emotion_label", "confidence"
    )


@query
def explore_confidence(spark, sf_dir):
    """Confidence as text that is sometimes no number."""
    written = F.when(F.col("raw_post_id") % 4 == 0, "n/a").otherwise(
        F.col("confidence").cast("string")
    )
    rows = joined(spark, sf_dir).withColumn("confidence", written)
    return explorer.explore(rows, min_confidence=0.25).select("raw_post_id", "confidence")


@query
def shorten_text(spark, sf_dir):
    return texts(spark, sf_dir).select(
        "origin", "id", explorer.shorten(F.col("text"), 180).alias("short"),
        explorer.shorten(F.col("text"), 160).alias("shorter"),
    )


@query
def explore_view(spark, sf_dir):
    shown = explorer.explore(joined(spark, sf_dir), text="the|der", min_confidence=0.1)
    return explorer.display(shown)


@query
def explore_counts(spark, sf_dir):
    rows = joined(spark, sf_dir)
    return explorer.shown_counts(rows, explorer.explore(rows, emotion="joy", min_confidence=0.5))


@query
def sample_posts(spark, sf_dir):
    return reports.sample_posts(raw_posts(spark, sf_dir), "raw_text", 20)


@query
def raw_posts_by_batch(spark, sf_dir):
    return batches.raw_posts_by_batch(raw_posts(spark, sf_dir))


@query
def json_upvotes(spark, sf_dir):
    posts = reports.json_field(raw_posts(spark, sf_dir), "raw_json", "upvotes")
    return posts.select("id", "upvotes")


@query
def json_event_props(spark, sf_dir):
    events = reports.json_field(read_table(spark, sf_dir, "events"), "props", "k")
    return events.groupBy("event_type").agg(
        F.count("k").alias("with_k"), F.sum("k").alias("sum_k"), F.max("k").alias("max_k")
    )


# Streaming


@query
def stream_clean(spark, sf_dir):
    """The raw table cleaned and scored as a stream that stops when it has caught up."""
    folder = work_folder(spark, "stream")
    raw, cleaned, enriched = f"{folder}/raw", f"{folder}/cleaned", f"{folder}/enriched"
    append_posts(raw_posts(spark, sf_dir), raw, compact=True)
    started = clean_and_score_stream(
        watch_raw_posts(spark, raw), cleaned, enriched, f"{folder}/checkpoint"
    )
    started.awaitTermination()
    done = reports.joined_posts(
        read_posts(spark, raw, RAW_POSTS),
        read_posts(spark, cleaned, CLEANED_POSTS),
        read_posts(spark, enriched, ENRICHED_POSTS),
        same_ids=True,
    )
    return done.select("raw_post_id", "batch_id", "cleaned_text", "emotion_label", as_number("confidence"))
