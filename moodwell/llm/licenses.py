"""License scans by diagonal voting, with DataFrame functions alone.

Every rolling word k-gram of a text is joined, by its hash and then its words, to the
places where templates hold it. A place in the text less the place in the template is a
diagonal; the votes on a diagonal tell how much of the template stands there. Neighbouring
diagonals, apart by a few words put in or left out, are merged, and a span counts if it
holds enough of the template's k-grams. Short phrases are templates of two-word
grams that need every vote on one diagonal.

Defined results: null and empty texts, and those without words, have no words, no spans
and a score of 0; texts are read whole, however long; rows equal in id and text get equal results,
each its own row; an empty table gives an empty result; other columns are not read.
Only votes travel, not texts; templates are a fixed list, hence their broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodwell.llm.common import words_of

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices as their licenses word them.
NOTICES = {
    "mit": """permission is hereby granted free of charge to any person obtaining a copy of this
 software and associated documentation files the software to deal in the software without
 restriction including without limitation the rights to use copy modify merge publish distribute
 sublicense and or sell copies of the software and to permit persons to whom the software is
 furnished to do so""",
    "apache": """licensed under the apache license version 2 0 the license you may not use this file
 except in compliance with the license you may obtain a copy of the license at""",
    "gpl": """this program is free software you can redistribute it and or modify it under the terms
 of the gnu general public license as published by the free software foundation""",
    "bsd": """redistribution and use in source and binary forms with or without modification are
 permitted provided that the following conditions are met""",
}

GRAM = 4  # words of a notice's grams
SHIFT = 4  # words put in or left out between diagonals that are merged
COVERED = 0.5  # share of a notice's grams that a span has to hold
_HEADER = "\x01"


def templates(spark: SparkSession) -> DataFrame:
    """Each k-gram of a template: hash, size, words, template, label, at (its place), grams (how
    many the template has). Template -1 meets the row that holds a text's length."""
    rows = [(2, _HEADER, -1, "", 0, 1)]
    notices = [(label, text.split(), GRAM) for label, text in NOTICES.items()]
    phrases = [(label, phrase.split(), 2) for phrase, label in PHRASES.items()]
    for k, (label, words, size) in enumerate(phrases + notices):
        grams = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
        rows += [(size, gram, k, label, i, len(grams)) for i, gram in enumerate(grams)]
    fields = "size int, gram string, template int, label string, at int, grams int"
    parts = F.split("gram", " ")
    hashed = F.xxhash64(*[F.get(parts, k) for k in range(GRAM)]).alias("gram_hash")
    return spark.createDataFrame(rows, fields).select("*", hashed)


def _rows(words: Column) -> Column:
    """The text's length in words in a first row, then each word with those behind it."""
    ahead = [
        F.slice(words, F.lit(1 + k), F.greatest(F.size(words) - k, F.lit(0))) for k in range(GRAM)
    ]
    names = [f"w{k}" for k in range(GRAM)]
    header = F.struct(
        F.lit(_HEADER).alias(names[0]),
        F.size(words).cast("string").alias(names[1]),
        *[F.lit(None).cast("string").alias(name) for name in names[2:]],
    )
    zipped = F.arrays_zip(*[a.alias(name) for a, name in zip(ahead, names, strict=True)])
    return F.concat(F.array(header), zipped)


def votes(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """How often each diagonal's places of a template were met; template -1 has the length."""
    text = F.col(text_column)
    key = F.unhex(F.md5(F.coalesce(text, F.lit(""))))
    worded = df.select(
        F.col(id_column).alias("id"), key.alias("key"), words_of(text).alias("words")
    )
    placed = worded.select("id", "key", F.posexplode(_rows(F.col("words"))).alias("place", "w"))
    words = [F.col(f"w.w{k}") for k in range(GRAM)]
    header = words[0] == _HEADER
    # Nulls leave a hash as it is: the header's is that of its mark alone.
    pair = F.struct(F.xxhash64(words[0], F.when(~header, words[1])).alias("gram_hash"), F.lit(2).alias("size"))
    four = F.struct(F.xxhash64(*words).alias("gram_hash"), F.lit(GRAM).alias("size"))
    hashed = placed.select("*", F.explode(F.array(pair, four)).alias("h")).select(
        "id", "key", "place", *[w.alias(f"w{k}") for k, w in enumerate(words)], "h.*"
    )
    pair_words = F.concat_ws(" ", "w0", F.when(F.col("w0") != _HEADER, F.col("w1")))
    said = F.when(F.col("size") == 2, pair_words).otherwise(F.concat_ws(" ", "w0", "w1", "w2", "w3"))
    # Not as one more key: the words are compared only where the hashes agree.
    same = (said <= F.col("gram")) & (said >= F.col("gram"))
    known = F.broadcast(templates(df.sparkSession))
    found = hashed.join(known, ["gram_hash", "size"]).where(same)
    n_words = F.col("w1").cast("int")
    place = F.when(F.col("template") < 0, n_words).otherwise(F.col("place") - 1)
    diagonal = (place - F.col("at")).alias("diagonal")
    return (
        found.groupBy("id", "key", "template", "label", "grams", "at", diagonal)
        .agg(F.count("*").alias("copies"))  # equal rows vote at the same place
        .groupBy("id", "key", "template", "label", "grams", "diagonal")
        .agg(F.collect_set("at").alias("met"), F.max("copies").alias("copies"))
    )


def spans(voted: DataFrame) -> DataFrame:
    """start, end and covered of each span of a template, from merged diagonals."""
    phrase = F.col("template") < len(PHRASES)
    own = Window.partitionBy("id", "key", "template").orderBy("diagonal")
    jump = F.col("diagonal") - F.lag("diagonal").over(own)
    apart = F.coalesce(jump > F.when(phrase, 0).otherwise(SHIFT), F.lit(True))
    merged = voted.where("template >= 0").withColumn(
        "span", F.sum(apart.cast("int")).over(own)
    )
    met = F.array_distinct(F.flatten(F.collect_list("met")))
    first = F.min(F.col("diagonal") + F.array_min("met"))
    last = F.max(F.col("diagonal") + F.array_max("met"))
    grouped = merged.groupBy("id", "key", "template", "label", "grams", "span").agg(
        first.alias("start"), last.alias("last_gram"), F.size(met).alias("n_met")
    )
    covered = F.col("n_met") / F.col("grams")
    held = grouped.withColumn("covered", covered).withColumn("is_phrase", phrase)
    size = F.when(F.col("is_phrase"), 2).otherwise(GRAM)
    return held.where(F.col("covered") >= F.when(F.col("is_phrase"), 1.0).otherwise(COVERED)).select(
        "id", "key", "label", "is_phrase", "covered", "start",
        (F.col("last_gram") + size).alias("end"),
    )


def scan_licenses(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: its words, its phrases, all labels, the spans found and a score."""
    voted = votes(df, id_column, text_column)
    lengths = voted.where("template < 0").select(
        "id", "key", F.col("diagonal").cast("long").alias("n_words"), "copies"
    )
    where = F.when(F.col("is_phrase"), F.col("start"))
    by_text = spans(voted).groupBy("id", "key").agg(
        F.count(where).alias("n_base"),
        F.min(where).cast("long").alias("first_word"),
        F.max(where).cast("long").alias("last_word"),
        F.collect_set(F.when(F.col("is_phrase"), F.col("label"))).alias("base"),
        F.collect_set("label").alias("all"),
        F.max("covered").alias("score"),
        F.sort_array(F.collect_list(F.struct("start", "end", "label"))).alias("spans"),
    )
    same = F.col("l.id").eqNullSafe(F.col("s.id")) & (F.col("l.key") == F.col("s.key"))
    joined = lengths.alias("l").join(by_text.alias("s"), same, "left")
    joined_labels = [
        F.coalesce(F.array_join(F.sort_array(c), ","), F.lit("")).alias(name)
        for c, name in (("base", "base_labels"), ("all", "labels"))
    ]
    out = joined.select(
        F.col("l.id").alias(id_column),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        *joined_labels,
        F.coalesce("score", F.lit(0.0)).alias("score"),
        "spans",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
    )
    return out.drop("_copy")
