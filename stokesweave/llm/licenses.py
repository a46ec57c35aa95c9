"""Licence scan by diagonal voting, in DataFrame operations only.

Texts and templates are sequences of words.  Every rolling pair of words of a text joins the
pairs of the templates by hash; a hit at text position ``p`` and template position ``t`` votes for
diagonal ``p - t``.  A template that stands in a text whole puts all its votes on one diagonal;
inserted or dropped words move the rest to neighbouring diagonals, which are merged.  Merged spans are
verified by the share of template pairs they cover and by their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stokesweave.llm.common import text_of

# fixed values: phrases of the base labels
PHRASES = [
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
]
# fixed values: notices as their publishers word them
NOTICES = [
    ("mit-notice", "released under the mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc0", "licensed under cc0 1 0"),
    ("all-rights-reserved", "all rights reserved"),
]
#: what is no word, after lower-casing
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def template_pairs(templates: list[tuple[str, str]]) -> list[tuple[int, int, str, str]]:
    """(template, position, word, next word) of every rolling pair."""
    return [(n, at, a, b) for n, (_, words) in enumerate(templates) for at, (a, b) in enumerate(zip(words.split(), words.split()[1:]))]


def scan(
    df: DataFrame,
    phrases: list[tuple[str, str]] | None = None,
    notices: list[tuple[str, str]] | None = None,
    coverage: float = 0.75,
    max_shift: int = 2,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per input row: word count, places of the phrases, labels, and a score.

    Returns ``key, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``; ``spans`` lists
    (label, start, words, covered) of the verified spans.  A phrase counts where all its words
    stand consecutively.  A notice counts where a merged span covers at least ``coverage`` of its
    pairs and is no longer than dropped and inserted words explain; of notices
    that start together the best covered counts.  ``score`` is the largest
    covered share of an accepted span, 0 without one.  Only A-Z are lower-cased where it matters:
    the letters that Unicode folds into others are words either way.  Null and empty texts have no
    words, no labels and score 0; repeated rows are scanned once and returned as often as they came.
    """
    phrases, notices = PHRASES if phrases is None else phrases, NOTICES if notices is None else notices
    templates = [*phrases, *notices]
    spark = df.sparkSession
    listed, seen = [], set()
    for tid, tpos, w1, w2 in template_pairs(templates):
        listed.append((tid, tpos, w1, w2, (w1, w2) not in seen))
        seen.add((w1, w2))
    pairs = spark.createDataFrame(listed, "tid int, tpos int, w1 string, w2 string, once boolean").withColumn("gram", F.xxhash64("w1", "w2"))
    lowered = F.lower(text_of(text))
    docs = (
        df.select(F.col(key).alias("key"), F.xxhash64(text_of(text)).alias("same"), F.split(lowered, BETWEEN).alias("parts"))
        # only the first and the last part can be empty
        .withColumn("lead", (F.element_at("parts", 1) == "").cast("int"))
        .withColumn("n_words", F.greatest(F.lit(0), F.size("parts") - F.col("lead") - (F.element_at("parts", -1) == "").cast("int")))
    )
    # each position with the word there and the next; position 0 is always kept, it carries the row itself
    grams = docs.select("key", "same", "lead", "n_words", "parts", F.posexplode_outer("parts").alias("at", "word")).select(
        "key", "same", "n_words", "at", (F.col("at") - F.col("lead")).alias("pos"), "word", F.get("parts", F.col("at") + 1).alias("next")
    )
    hits = (
        grams.withColumn("gram", F.xxhash64("word", "next"))
        .join(F.broadcast(pairs), "gram", "left")  # the templates: a fixed table of a few hundred rows
        .withColumn("hit", F.coalesce((F.col("word") == F.col("w1")) & (F.col("next") == F.col("w2")), F.lit(False)))
        .filter("hit or at = 0")
    )
    diagonals = hits.groupBy("key", "same", F.when(F.col("hit"), F.col("tid")).alias("tid"), F.when(F.col("hit"), F.col("pos") - F.col("tpos")).alias("diagonal")).agg(
        F.max("n_words").alias("n_words"),
        # rows that repeat vote on the same diagonal; places are counted once
        F.collect_set(F.when(F.col("hit"), F.col("tpos"))).alias("votes"),
        # a pair of several templates joins more than once
        F.sum(F.when((F.col("at") == 0) & F.coalesce(F.col("once"), F.lit(True)), 1).otherwise(0)).alias("rows"),
    )
    sizes = F.array(*[F.lit(len(words.split())) for _, words in templates])
    labels = F.array(*[F.lit(label) for label, _ in templates])
    n_phrases = len(phrases)
    order = Window.partitionBy("key", "same", "tid").orderBy("diagonal")
    placed = diagonals.withColumn("start", F.col("diagonal") + F.array_min("votes")).withColumn("stop", F.col("diagonal") + F.array_max("votes") + 2)
    # phrases stand whole on one diagonal; diagonals of a notice merge if they are near in shift and in place
    apart = (
        (F.col("tid") < n_phrases)
        | (F.col("diagonal") - F.lag("diagonal").over(order) > max_shift)
        | (F.col("start") > F.lag("stop").over(order) + max_shift)
    )
    runs = placed.withColumn("run", F.sum(F.when(F.coalesce(apart, F.lit(True)), 1).otherwise(0)).over(order))
    spans = (
        runs.groupBy("key", "same", "tid", "run")
        .agg(
            F.max("n_words").alias("n_words"),
            F.sum("rows").alias("rows"),
            F.min("start").alias("start"),
            (F.max("stop") - F.min("start")).alias("words"),
            F.array_distinct(F.flatten(F.collect_list("votes"))).alias("votes"),
            F.count("*").alias("merged"),
        )
        .withColumn("size", F.get(sizes, F.col("tid")))
        .withColumn("covered", F.size("votes") / (F.col("size") - 1))
        .withColumn(
            "kept",
            F.when(F.col("tid") < n_phrases, F.col("covered") == 1.0)
            .when(F.col("tid").isNotNull(), (F.col("covered") >= coverage) & (F.abs(F.col("words") - F.col("size")) <= F.col("size") * (1 - coverage) + max_shift * (F.col("merged") - 1)))
            .otherwise(F.lit(False)),
        )
    )

    # of notices that start together, such as versions of one licence, the best covered stands
    phrase = F.coalesce(F.col("tid") < n_phrases, F.lit(False))
    found_at = (
        spans.withColumn("span", F.when(F.col("kept"), F.struct("covered", "size", F.col("start").cast("bigint").alias("start"), F.col("words").cast("bigint").alias("words"), F.get(labels, F.col("tid")).alias("label"))))
        .groupBy("key", "same", F.when(F.col("kept"), F.col("start")).alias("start"), F.when(phrase, F.col("tid")).alias("phrase"))
        .agg(F.sum("rows").alias("rows"), F.max("n_words").alias("n_words"), F.max("span").alias("span"))
    )

    def joined(values: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(values)), ",")

    base = F.when(F.col("phrase").isNotNull(), F.col("span"))
    found = found_at.groupBy("key", "same").agg(
        F.sum("rows").alias("rows"),
        F.max("n_words").cast("bigint").alias("n_words"),
        F.count(base).alias("n_base"),
        F.min(base["start"]).alias("first_word"),
        F.max(base["start"]).alias("last_word"),
        joined(base["label"]).alias("base_labels"),
        joined(F.col("span.label")).alias("labels"),
        F.coalesce(F.max("span.covered"), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("span").isNotNull(), F.struct("span.start", "span.words", "span.label", "span.covered")))).alias("spans"),
    )
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).select(F.col("key").alias(key), *names)
