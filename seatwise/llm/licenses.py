"""License scans by diagonal voting, in DataFrame operations only.

Every run of three words of a text is looked up, by hash and then by its words,
among the runs of the license templates. A match at word ``p`` of the text and
word ``t`` of the template votes for the diagonal ``p - t``. Neighbouring
diagonals, which differ by a few words put in or left out, are merged, and the
merged span counts if enough of the template stands in about its length. A short
phrase must stand whole on one diagonal.

The templates are a constant of the operator, a few hundred rows, so they are
broadcast whatever the size of the corpus; texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words of a run.
K = 3
#: Diagonals this far apart belong to one copy of a template.
SLACK = 4
#: Share of a template's runs that must be found.
COVERAGE = 0.6
#: A span may be this many times as long as its template.
STRETCH = 1.5

#: What a word is not, and the phrases to be counted wherever they stand.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

#: Public wording of licenses and notices.
NOTICES = [
    ("gpl-3", "licensed under the gnu general public license version 3"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the "
        "terms of the gnu general public license as published by the free software foundation",
    ),
    ("lgpl", "terms of the gnu lesser general public license as published by the free software"),
    ("agpl", "terms of the gnu affero general public license as published by the free software"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("apache-2", "licensed under the apache license version 2 0 the license"),
    ("apache-2", "you may not use this file except in compliance with the license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "has waived all copyright and related or neighboring rights to this work"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all rights reserved no part of this publication may be reproduced"),
]


def template_rows() -> list[tuple[int, str, bool, int, int, str]]:
    """``(template, label, phrase, runs, place, run)`` for every run of a template."""
    out = []
    named = [(*x, True) for x in PHRASES] + [(*x, False) for x in NOTICES]
    for number, (label, text, phrase) in enumerate(named):
        words = text.split(" ")
        runs = len(words) - K + 1
        for place in range(runs):
            run = " ".join(words[place : place + K])
            out.append((number, label, phrase, runs, place, run))
    return out


def _templates(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(
        template_rows(),
        "template int, label string, phrase boolean, runs int, place int, run string",
    )
    words = F.split("run", " ")
    return rows.withColumn("run_hash", F.xxhash64(*(words[i] for i in range(K))))


def words_of(text):
    """The words of a text column, A-Z in lower case; null has none.

    Lower case changes other letters too, but no word's bounds: all of them count
    as letters. Only the Kelvin sign would turn into a plain letter, so it goes first.
    """
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ø")))
    return F.array_remove(F.split(plain, NOT_WORD), "")


def scan(docs: DataFrame) -> DataFrame:
    """Licenses of each document, one row for each input row.

    ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score``; the score is the best share of a template found, 1 for a phrase.
    Null and empty texts have no words and no labels. Rows alike in id and text
    share their work and come out as many as they went in. Texts are read whole
    whatever their length, no rows give none. Only ``doc_id`` and ``text`` are read,
    other columns are left aside whatever their names.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        words_of(F.col("text").cast("string")).alias("words"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
    )
    document = ["doc_id", "text_hash", "n_words"]

    def run(i):
        three = [F.get("words", i + n) for n in range(K)]
        return F.struct(
            i.alias("at"),
            F.xxhash64(*three).alias("run_hash"),
            F.concat_ws(" ", *three).alias("run"),
        )

    # The run at -1 fits no template. It stands for its document, found or not.
    runs = texts.select(
        "doc_id",
        "text_hash",
        F.size("words").cast("long").alias("n_words"),
        F.explode(F.transform(F.sequence(F.lit(-1), F.size("words") - 1), run)).alias("r"),
    ).select(*document, "r.*")
    found = (
        runs.join(F.broadcast(_templates(docs.sparkSession)), ["run_hash", "run"], "left")
        .where((F.col("at") == -1) | F.col("template").isNotNull())
        .groupBy(*document, "template", "label", "phrase", "runs", "at", "place")
        .agg(F.count("*").alias("copies"))
    )
    diagonal = found.groupBy(
        *document, "template", "label", "phrase", "runs", (F.col("at") - F.col("place")).alias("d")
    ).agg(
        F.count("place").alias("votes"),
        F.collect_set("place").alias("places"),
        F.min("at").alias("low"),
        F.max("at").alias("high"),
        F.max("copies").alias("copies"),
    )
    # Diagonals of a notice that stand close together are one copy of it.
    order = Window.partitionBy(*document, "template").orderBy("d")
    fresh = F.when(
        F.col("phrase") | (F.col("d") - F.lag("d").over(order) > SLACK), 1
    ).otherwise(0)
    spans = (
        diagonal.withColumn("fresh", fresh)
        .withColumn("part", F.sum("fresh").over(order))
        .groupBy(*document, "template", "label", "phrase", "runs", "part")
        .agg(
            F.min("d").alias("start"),
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("all_votes"),
            F.max(F.size("places")).alias("best_votes"),
            (F.max("high") - F.min("low") + K).alias("length"),
            F.max("copies").alias("copies"),
        )
    )
    # A merged span that is too long for one copy is judged by its best diagonal, which
    # is never longer than the template.
    fits = F.col("length") <= STRETCH * (F.col("runs") + K - 1)
    spans = spans.withColumn(
        "votes", F.when(fits, F.col("all_votes")).otherwise(F.col("best_votes"))
    )
    share = F.col("votes") / F.col("runs")
    whole = F.col("phrase") & (F.col("votes") == F.col("runs"))
    noticed = ~F.col("phrase") & (share >= COVERAGE)
    start = F.when(whole, F.col("start")).cast("long")

    def joined(label):
        return F.concat_ws(",", F.sort_array(F.collect_set(label)))

    return (
        spans.groupBy(*document)
        .agg(
            F.count(start).alias("n_base"),
            F.min(start).alias("first_word"),
            F.max(start).alias("last_word"),
            joined(F.when(whole, F.col("label"))).alias("base_labels"),
            joined(F.when(whole | noticed, F.col("label"))).alias("labels"),
            F.coalesce(F.max(F.when(whole | noticed, share)), F.lit(0.0)).alias("score"),
            F.max(F.when(F.col("template").isNull(), F.col("copies"))).alias("copies"),
        )
        .select(
            "doc_id",
            "n_words",
            "n_base",
            "first_word",
            "last_word",
            "base_labels",
            "labels",
            "score",
            F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
        )
        .drop("copy")
    )


def oracle_sql() -> str:
    """The same rows in DuckDB's SQL, templates included."""
    values = ", ".join(
        f"({n}, '{label}', {phrase}, {runs}, {place}, '{run}')"
        for n, label, phrase, runs, place, run in template_rows()
    )
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
    WITH templates(template, label, phrase, runs, place, run) AS (VALUES {values}),
    texts AS (
      SELECT doc_id, list_filter(string_split_regex(
               translate(coalesce(text, ''), '{upper}', '{lower}'), '{NOT_WORD}'),
               lambda w: w <> '') AS words
      FROM documents),
    places AS (
      SELECT doc_id, words, unnest(range(len(words) - {K - 1})) AS pos FROM texts),
    runs AS (
      SELECT doc_id, pos, words[pos + 1] || ' ' || words[pos + 2] || ' ' || words[pos + 3] AS run
      FROM places),
    votes AS (
      SELECT doc_id, template, label, phrase, runs, pos, place, pos - place AS d
      FROM runs JOIN templates USING (run)),
    diagonals AS (
      SELECT doc_id, template, label, phrase, runs, d, min(pos) AS low, max(pos) AS high,
             list(place) AS places
      FROM votes GROUP BY ALL),
    fresh AS (
      SELECT *, CASE WHEN phrase OR d - lag(d) OVER w > {SLACK} THEN 1 ELSE 0 END AS fresh
      FROM diagonals WINDOW w AS (PARTITION BY doc_id, template ORDER BY d)),
    parts AS (
      SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY d) AS part FROM fresh),
    spans AS (
      SELECT doc_id, template, label, phrase, runs, part, min(d) AS start,
             CASE WHEN max(high) - min(low) + {K} <= {STRETCH} * (runs + {K - 1})
               THEN len(list_distinct(flatten(list(places))))
               ELSE max(len(list_distinct(places))) END AS votes
      FROM parts GROUP BY doc_id, template, label, phrase, runs, part),
    kept AS (
      SELECT *, phrase AND votes = runs AS whole,
             NOT phrase AND votes / runs >= {COVERAGE} AS noticed
      FROM spans)
    SELECT t.doc_id, len(words)::BIGINT AS n_words,
           count(start) FILTER (whole) AS n_base,
           min(start) FILTER (whole)::BIGINT AS first_word,
           max(start) FILTER (whole)::BIGINT AS last_word,
           coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (whole)), ','), '')
             AS base_labels,
           coalesce(array_to_string(
             list_sort(list(DISTINCT label) FILTER (whole OR noticed)), ','), '') AS labels,
           coalesce(max(votes / runs) FILTER (whole OR noticed), 0)::DOUBLE AS score
    FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
    GROUP BY t.doc_id, words
    """
