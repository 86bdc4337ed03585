"""License scan by diagonal voting, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.common import stage, text_of

LETTERS_UPPER, LETTERS_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 2

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices that the method looks for, and their labels.
NOTICES = {
    "this work is licensed under the gnu general public license version 3": "gpl",
    "licensed under the apache license version 2 0": "apache",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "eclipse public license version 2 0": "epl",
}


def words_of() -> Column:
    return F.regexp_extract_all(F.translate(text_of(), LETTERS_UPPER, LETTERS_LOWER), F.lit(WORD), F.lit(0))


def templates(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """One row per k-gram of every template: gram, template, label, exact, place, n_grams."""
    rows = [(i, label, i < len(phrases), text) for i, (text, label) in enumerate([*phrases.items(), *notices.items()])]
    given = spark.createDataFrame(rows, "template int, label string, exact boolean, text string")
    listed = given.withColumn("words", F.split("text", " ")).withColumn("n_grams", F.size("words") - (GRAM - 1))
    grams = listed.select("template", "label", "exact", "n_grams", F.posexplode(rolling("words")).alias("place", "gram"))
    return grams.where("place < n_grams")


def rolling(words: str) -> Column:
    """Hash of each word with the next one; the last word's entry is no k-gram."""
    return F.transform(F.col(words), lambda w, i: F.xxhash64(w, F.get(F.col(words), i + 1)))


def license_scan(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES,
    share: float = 0.75, drift: int = 2,
) -> DataFrame:
    """Phrases and notices in every text.

    All rolling word 2-gram hashes are joined with template positions and counted by
    document, template and diagonal (offset of text against template). A phrase stands
    where one diagonal holds all its 2-grams. For notices, diagonals at most ``drift``
    apart are merged, so that a few words more or less do not break them, and a span
    counts if it covers at least ``share`` of the template's 2-grams and is not longer than
    the template by half.

    One row per document: doc_id, n_words, n_base (places of all phrases), first_word and
    last_word (least and greatest start, else NULL), base_labels, labels (with those of
    notices; distinct, sorted, comma-joined), score (best covered share, 1 for a phrase),
    spans (label:first_word:last_word of notices). NULL and empty texts have no words;
    repeated rows give repeated results; an empty table gives no rows; other columns are
    ignored.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("node"), words_of().alias("words"))
    known = templates(spark, phrases, notices)
    grams = source.select("doc_id", "node", F.posexplode(rolling("words")).alias("at", "gram"))
    hits = grams.join(F.broadcast(known), "gram")  # a few hundred rows, fixed by the templates
    diagonal = ["doc_id", "node", "template", "label", "exact", "n_grams", (F.col("at") - F.col("place")).alias("diagonal")]
    # a repeated row of the input has the same hits: counted once
    hits = hits.groupBy(*diagonal, "place").agg(F.first("at").alias("at"))
    voted = hits.groupBy("doc_id", "node", "template", "label", "exact", "n_grams", "diagonal").agg(
        F.count("*").alias("votes"), F.min("at").alias("low"), F.max("at").alias("high"), F.collect_set("place").alias("places")
    )
    voted = stage(voted)
    key = ["doc_id", "node"]
    phrase = voted.where("exact and votes = n_grams").groupBy(*key).agg(
        F.count("*").alias("n_base"), F.min("diagonal").alias("first_word"), F.max("diagonal").alias("last_word"),
        F.collect_set("label").alias("base"),
    )
    by = Window.partitionBy(*key, "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by) > drift).cast("int"), F.lit(1))
    merged = (
        voted.where("not exact").withColumn("apart", apart)
        .withColumn("group", F.sum("apart").over(by))
        .groupBy(*key, "template", "label", "n_grams", "group")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered"), F.min("low").alias("low"), F.max("high").alias("high"))
        .withColumn("score", F.col("covered") / F.col("n_grams"))
        .where((F.col("score") >= share) & (F.col("high") - F.col("low") + 1 <= 1.5 * F.col("n_grams") + drift))
    )
    notice = merged.groupBy(*key).agg(
        F.collect_set("label").alias("more"), F.max("score").alias("score"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "label", "low", F.col("high") + GRAM - 1))), ",").alias("spans"),
    )
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("node"),
        F.regexp_count(F.translate(text_of(), LETTERS_UPPER, LETTERS_LOWER), F.lit(WORD)).cast("long").alias("n_words"),
    )

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnsRenamed({"doc_id": "_d", "node": "_n"})
        return left.join(right, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("node") == F.col("_n")), "left").drop("_d", "_n")

    none = F.array().cast("array<string>")
    return joined(joined(counted, phrase), notice).select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.coalesce("base", none)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(F.coalesce("base", none), F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("score", F.lit(0.0))).cast("double").alias("score"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
