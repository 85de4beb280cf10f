"""License scans by diagonal voting.

Every rolling word k-gram of a text is hashed and joined to the positions of the same k-gram in license templates. Hits are
counted by diagonal (text position minus template position), neighbouring diagonals are merged, and a merged span counts
if it covers enough of its template. Built-in column functions only. The templates are fixed and few, so their k-grams are
broadcast; what is shuffled are hits, keyed by the hash of the text and pre-aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from formtide.llm.common import let, steps, text_of

K = 4
#: Diagonals at most this far apart are one span: words were put in or left out between them.
NEAR = 3
#: Share of a template's words that a span has to cover.
COVERAGE = 0.6
#: Notices by label, in words as the scan sees them.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
#: Phrases that are enough by themselves.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Fixed value: what parts words in lower-cased text.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_words(text: Column) -> Column:
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.filter(F.split(F.translate(text, upper, upper.lower()), BREAK), lambda w: w != "")


def _hash(words: Column, i: Column, k: int) -> Column:
    return F.xxhash64(*(words[i + j] for j in range(k)))


def template_grams(spark: SparkSession, templates=TEMPLATES, k: int = K) -> DataFrame:
    """(gram, template, label, length, place): every k-gram of every template. Shorter templates have none."""
    rows = [F.struct(F.lit(n).alias("template"), F.lit(a).alias("label"), F.lit(b).alias("text")) for n, (a, b) in enumerate(templates)]
    frame = spark.range(1).select(F.inline(F.array(*rows)))
    frame = frame.withColumn("words", F.split("text", " ")).withColumn("length", F.size("words"))
    grams = let(F.col("words"), lambda w: F.transform(steps(F.size(w) - (k - 1)), lambda i: _hash(w, i, k)))
    return frame.select("template", "label", "length", F.posexplode(grams).alias("place", "gram"))


def _key(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def spans(docs: DataFrame, templates=TEMPLATES, k: int = K, near: int = NEAR, coverage: float = COVERAGE) -> DataFrame:
    """Verified spans by text: key, label, template, first and last word, coverage (0 to 1).

    Equal texts have one row per span together. Null and empty texts have none.
    """
    text = text_of()
    grams = let(license_words(text), lambda w: F.transform(steps(F.size(w) - (k - 1)), lambda i: _hash(w, i, k)))
    rolled = docs.select(_key(text).alias("key"), F.posexplode(grams).alias("at", "gram"))
    hits = rolled.join(F.broadcast(template_grams(docs.sparkSession, templates, k)), "gram")
    votes = hits.groupBy("key", "template", "label", "length", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"), F.min("at").alias("low"), F.max("at").alias("high")
    )
    by_diagonal = Window.partitionBy("key", "template").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > near, F.lit(True))
    votes = votes.withColumn("new", new.cast("int")).withColumn("span", F.sum("new").over(by_diagonal))
    merged = votes.groupBy("key", "template", "label", "length", "span").agg(
        F.flatten(F.collect_list("places")).alias("places"), F.min("low").alias("first"), (F.max("high") + k - 1).alias("last")
    )
    words = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + k - 1))))
    merged = merged.withColumn("coverage", F.size(words) / F.col("length"))
    fits = (F.col("coverage") >= coverage) & (F.col("last") - F.col("first") < 1.5 * F.col("length"))
    return merged.filter(fits).select("key", "label", "template", "first", "last", "coverage")


def base_places(words: Column, text: Column) -> Column:
    """Array of (at, label) of the phrases. Texts without the word that all phrases share are not searched."""

    def of(phrase: str, label: str) -> Column:
        parts = phrase.split()

        def here(i: Column) -> Column:
            match = words[i] == parts[0]
            for j, part in enumerate(parts[1:], 1):
                match = match & (words[i + j] == part)
            return match

        at = F.filter(steps(F.size(words) - (len(parts) - 1)), here)
        return F.transform(at, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))

    found = F.concat(*(of(*x) for x in PHRASES))
    return F.when(text.rlike("(?i)license"), found).otherwise(F.array().cast("array<struct<at:bigint,label:string>>"))


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (the best coverage, else 0).

    A null text is an empty one; repeated rows stay.
    """
    text = text_of()
    base = let(
        license_words(text),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), base_places(w, text).alias("found")),
    )
    rows = docs.select("doc_id", _key(text).alias("key"), base.alias("base")).select("doc_id", "key", "base.*")
    at = F.transform("found", lambda x: x["at"])
    rows = rows.select(
        "doc_id",
        "key",
        "n_words",
        F.size("found").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        F.sort_array(F.array_distinct(F.transform("found", lambda x: x["label"]))).alias("own"),
    )
    best = spans(docs).groupBy("key").agg(F.collect_set("label").alias("more"), F.max("coverage").alias("score"))
    joined = rows.join(best, "key", "left")
    more = F.coalesce("more", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("own", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("own", more)), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
