"""Licence scan with a positional index over rare words, in DataFrame operations only.

The words of all licence templates are the index's vocabulary; their document frequencies
are counted over the whole table. Each template has postings of its rarest words, and every
occurrence of such a word in a file is looked up in them. Occurrences that agree on where the template would
begin are summed up; a beginning with enough weight is a licence if the mandatory phrases of
the template stand word for word in their places.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.storage import materialise

from .common import ascii_lower

# The phrases that give a label by themselves.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Label, template, and the phrases of it that have to stand there.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software",
        ("permission is hereby granted free of charge", "associated documentation files"),
    ),
    ("apache", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    (
        "gpl",
        "this work is licensed under the gnu general public license version 3",
        ("gnu general public license",),
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
        ("gnu general public license", "free software foundation"),
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    (
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution",),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
        ("with or without fee is hereby granted",),
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
)
# Words of the templates that are too common to be looked up.
COMMON = frozenset(
    "a and any are as by can for in is it of or that the this to under with without you".split()
)
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
INDEXED = 8  # rarest words of a template that have postings
PLACED = 0.6  # share of a template's weight that has to agree on its beginning
BASE_SCORE = 0.5  # of a file with a base label whose place fits no template


def vocabulary() -> list[str]:
    words = {w for _, text, _ in TEMPLATES for w in text.split()}
    return sorted((words | {w for phrase in BASE for w in phrase.split()}) - COMMON)


def words_of(text: Column) -> Column:
    """Null texts have no words."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.array_remove(parts, "")


def occurrences(docs: DataFrame) -> DataFrame:
    """Per row: ``n_words``, and where it has any, ``hits`` (place, word) and all its words."""
    listed = vocabulary()
    split = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    marked = split.withColumn("_any", F.size(F.array_intersect("words", F.lit(listed))) > 0)
    hits = F.filter(
        F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word"))),
        lambda h: h["word"].isin(listed),
    )
    return marked.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.when(F.col("_any"), hits).alias("hits"),
        F.when(F.col("_any"), F.col("words")).alias("words"),
    )


def base_places(hits: Column) -> Column:
    """Where the base phrases stand: array of (at, label), ascending.

    Every word of a phrase is in the vocabulary, so consecutive words are consecutive hits.
    """

    def place(h: Column, i: Column) -> Column:
        found = F.lit(None).cast("string")
        for phrase, label in BASE.items():
            first, *rest = phrase.split()
            fits = h["word"] == first
            for k, word in enumerate(rest, 1):
                next_ = F.get(hits, i + k)
                fits = fits & (next_["word"] == word) & (next_["at"] == h["at"] + k)
            found = F.coalesce(found, F.when(fits, F.lit(label)))
        return F.struct(h["at"].alias("at"), found.alias("label"))

    return F.filter(F.transform(hits, place), lambda p: p["label"].isNotNull())


def inverse_frequencies(found: DataFrame) -> dict[str, float]:
    """1 + ln((rows + 1) / (rows with the word + 1)) of every word of the vocabulary.

    The constant keeps a weight on words that every row has.
    """
    total = F.lit(found.count() + 1.0)
    counted = (
        found.filter("hits IS NOT NULL")
        .select(F.explode(F.array_distinct("hits.word")).alias("word"))
        .groupBy("word")
        .agg((1.0 + F.log(total / (F.count(F.lit(1)) + 1.0))).alias("idf"))
    )
    known = {r["word"]: r["idf"] for r in counted.collect()}  # at most the vocabulary
    most = found.sparkSession.range(1).select(1.0 + F.log(total)).first()[0]
    return {w: known.get(w, most) for w in vocabulary()}


def postings(spark: SparkSession, idf: Mapping[str, float]) -> DataFrame:
    """One row per place of a template's rarest words: what it weighs, and what else the
    template asks for."""
    rows = []
    for number, (label, text, phrases) in enumerate(TEMPLATES):
        words = text.split()
        rare = sorted(set(words) - COMMON, key=lambda w: (-idf[w], w))[:INDEXED]
        total = sum(idf[w] for w in words if w in rare)
        wanted = F.array(
            *[
                F.struct(
                    F.lit(text[: f" {text} ".index(f" {p} ")].count(" ")).alias("at"),
                    F.lit(p.split()).alias("words"),
                )
                for p in phrases
            ]
        )
        rows += [
            F.struct(
                F.lit(w).alias("word"), F.lit(at).alias("place"), F.lit(number).alias("template"),
                F.lit(label).alias("label"), F.lit(float(idf[w])).alias("weight"),
                F.lit(float(total)).alias("total"), wanted.alias("phrases"),
            )
            for at, w in enumerate(words) if w in rare
        ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: words, base phrases, labels and score.

    ``score`` is the largest share of a template's weight found in place, BASE_SCORE if
    there are only base phrases, else 0. Null and empty texts have no words and no labels;
    repeated rows each give a row; columns other than ``doc_id`` and ``text`` are ignored.
    """
    found = materialise(occurrences(docs.select("doc_id", "text")))
    idf = inverse_frequencies(found)
    indexed = postings(docs.sparkSession, idf)
    listed = sorted({r["word"] for r in indexed.select("word").distinct().collect()})  # templates
    licensed = found.filter("hits IS NOT NULL")
    looked_up = licensed.select(
        "row", F.explode(F.filter("hits", lambda h: h["word"].isin(listed))).alias("h")
    )
    # The hint is safe: the postings are the fixed templates.
    placed = (
        looked_up.select("row", "h.at", "h.word")
        .join(F.broadcast(indexed), "word")
        .withColumn("begin", F.col("at") - F.col("place"))
        .groupBy("row", "template", "begin")
        .agg(
            F.sum("weight").alias("weight"),
            F.first("total").alias("total"),
            F.first("label").alias("label"),
            F.first("phrases").alias("phrases"),
        )
        .withColumn("share", F.when(F.col("total") > 0, F.col("weight") / F.col("total")))
        .filter((F.col("share") >= PLACED) & (F.col("begin") >= 0))
    )
    verified = placed.join(licensed.select("row", "words"), "row").filter(
        F.forall(
            "phrases",
            lambda p: F.slice("words", F.col("begin") + p["at"] + 1, F.size(p["words"])) == p["words"],
        )
    )
    by_method = verified.groupBy("row").agg(
        F.collect_set("label").alias("more"), F.least(F.max("share"), F.lit(1.0)).alias("share")
    )
    none = F.array().cast("array<string>")
    places = F.when(F.col("hits").isNotNull(), base_places(F.col("hits")))
    based = found.select("row", "doc_id", "n_words", places.alias("base"))
    full = based.join(by_method, "row", "left")
    base_labels = F.coalesce(F.array_sort(F.array_distinct("base.label")), none)
    labels = F.array_sort(F.array_union(base_labels, F.coalesce("more", none)))
    score = F.coalesce(
        "share", F.when(F.size(F.coalesce("base.label", none)) > 0, BASE_SCORE), F.lit(0.0)
    )
    return full.select(
        "doc_id",
        "n_words",
        F.size(F.coalesce("base.label", none)).cast("long").alias("n_base"),
        F.array_min("base.at").cast("long").alias("first_word"),
        F.array_max("base.at").cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        score.alias("score"),
    )
