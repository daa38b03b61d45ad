import collections
import math

import pytest
from pyspark.sql import functions as F

from moodwell.functions.language import BUCKETS, PART_MARGIN, PART_PAIRS
from moodwell.operators.language import (
    detect_language,
    language_confusion,
    load_model,
    pair_counts,
    train_profile,
    with_language_costs,
    with_limit,
)


def pairs_of(text):
    letters, gap = "", False
    for char in text.lower():
        if char.isalpha():
            letters, gap = letters + char, False
        elif not gap:
            letters, gap = letters + " ", True
    return [(ord(a) * 257 + ord(b)) % BUCKETS for a, b in zip(letters, letters[1:])]


def test_counts_and_costs_against_a_loop(spark):
    texts = [("x", "Éa ba!!ab"), ("x", "ab"), ("y", "zz zz z"), ("y", None), ("y", ""), ("x", "1")]
    df = spark.createDataFrame(texts, "lang string, text string")
    want = collections.Counter((l, b) for l, t in texts if t for b in pairs_of(t))
    got = {(r.lang, r.bucket): r.n for r in pair_counts(df).collect()}
    assert got == want
    model = load_model(train_profile(df))
    totals = collections.Counter(l for l, t in texts if t for _ in pairs_of(t))
    for lang, costs in zip(model.langs, model.costs):
        assert len(costs) == BUCKETS
        for bucket in range(0, BUCKETS):
            n = want.get((lang, bucket), 0)
            assert costs[bucket] == round(-1000 * math.log((n + 1) / (totals[lang] + BUCKETS)))
    scored = with_language_costs(df.where("text IS NOT NULL"), model, "text").collect()
    for row in scored:
        found = pairs_of(row.text)
        if not found:
            assert row.language_costs is None
        else:
            sums = sorted((sum(c[b] for b in found), l) for l, c in zip(model.langs, model.costs))
            assert [(c.cost, c.lang) for c in row.language_costs] == sums


def test_many_languages(spark, monkeypatch):
    from moodwell.functions import language as functions
    from moodwell.operators import language as operators

    df = spark.createDataFrame([(f"l{i % 9}", "abc " * i) for i in range(40)], "lang string, text string")
    want = {tuple(r) for r in pair_counts(df).collect()}
    monkeypatch.setattr(functions, "MAX_LANGUAGES", 2)
    monkeypatch.setattr(operators, "MAX_LANGUAGES", 2)
    assert {tuple(r) for r in pair_counts(df.coalesce(1)).collect()} == want
    with pytest.raises(ValueError):
        load_model(train_profile(df))


def test_default_language_and_mixed_flag(spark):
    df = spark.createDataFrame([("a", "aaaa"), ("b", "bbbb")], "lang string, text string")
    model = load_model(train_profile(df))
    texts = [("aaa",), ("bbbbb",), ("123 !",), (None,), ("zq",)]
    got = detect_language(spark.createDataFrame(texts, "text string"), model).collect()
    assert [r.language for r in got] == ["a", "b", "en", "en", "a"]
    assert [r.mixed_language for r in got] == [False, False, False, False, True]


def test_clear_text_is_not_mixed(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet").where("n_chars > 200")
    found = detect_language(documents, load_model(train_profile(documents)))
    # Document 64 has a French passage amid its English.
    assert [r.doc_id for r in found.where("mixed_language").collect()] == [64]
    right = language_confusion(found).where("lang = language").agg(F.sum("posts")).first()[0]
    assert right / documents.count() > 0.99


def test_texts_are_not_shuffled(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    found = detect_language(documents, load_model(train_profile(documents)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("ArrowEvalPython") == 1


def of(spark, small, lang):
    return spark.read.parquet(f"{small}/documents.parquet").where((F.col("lang") == lang) & (F.col("n_chars") > 400))


def test_joined_texts_are_mixed(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    model = load_model(train_profile(documents.where("doc_id % 2 = 0")))
    parts = of(spark, small, "en").select("doc_id", F.left("text", F.lit(900)).alias("a")).limit(20)
    other = of(spark, small, "de").select(F.col("doc_id").alias("other"), F.left("text", F.lit(400)).alias("b")).limit(20)
    joined = parts.crossJoin(other.limit(5)).select(F.concat("a", F.lit(". "), "b").alias("text"))
    found = detect_language(joined, model)
    mixed = found.agg(F.avg(F.col("mixed_language").cast("int"))).first()[0]
    assert mixed > 0.95
    single = detect_language(parts.select(F.concat("a", F.lit(" "), "a").alias("text")), model)
    assert single.where("mixed_language").isEmpty()


def test_parts_against_a_loop(spark):
    df = spark.createDataFrame([("a", "ab" * 400), ("b", "bcd" * 300)], "lang string, text string")
    model = load_model(train_profile(df))
    texts = ["ab" * 300 + "bcd" * 60, "ab" * 300 + "bcd" * 40, "ab" * 100, "a", "ab" * 64 + "bcd" * 43, "é" * 500]
    found = detect_language(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    for row in found:
        pairs = pairs_of(row.text)
        whole = [sum(c[b] for b in pairs) for c in model.costs]
        main, n = whole.index(min(whole)), max(1, len(pairs) // PART_PAIRS)
        inside = [0, 0]
        for k in range(n):
            part = pairs[k * PART_PAIRS : (k + 1) * PART_PAIRS if k < n - 1 else None]
            costs = [sum(c[b] for b in part) for c in model.costs]
            if costs[main] - min(costs) > PART_MARGIN:
                inside[costs.index(min(costs))] += len(part)
        chances = [math.exp((min(whole) - c) / 1000) for c in whole]
        both = bool(pairs) and (min(chances) / sum(chances) > 0.2 or max(inside) > 0.2 * len(pairs))
        assert (row.language, row.mixed_language) == (model.langs[main] if pairs else "en", both)
    assert {r.mixed_language for r in found} == {True, False}


def test_unknown_language(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet").where("n_chars > 200")
    known = documents.where("lang IN ('en', 'fr')")
    model = load_model(train_profile(known.where("doc_id % 2 = 0")))
    limited = with_limit(model, known.where("doc_id % 2 = 1"))
    found = detect_language(documents, limited).withColumn("right", F.col("language") == F.when(
        F.col("lang").isin("en", "fr"), F.col("lang")).otherwise("und"))
    assert found.agg(F.avg(F.col("right").cast("int"))).first()[0] > 0.95
    assert with_limit(model, known.limit(0)).limit is None
    letterless = detect_language(spark.createDataFrame([("12",), (None,)], "text string"), limited).collect()
    assert [r.language for r in letterless] == ["en", "en"]
