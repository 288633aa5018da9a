"""License scans by diagonal voting.

All rolling word 3-grams of all texts are joined, by hash and then by their words, to the
positions of license templates (a fixed table, broadcast). A match of text position p and template
position t votes for the diagonal p - t. A phrase stands at every diagonal that has the votes of all
its grams. For longer templates, diagonals with several votes are merged with neighbours, as words
put in or left out shift the rest; a merged span is verified: its distinct template grams must cover
enough of the template and lie close together.
Defined results: null and empty texts have no words; repeated rows and null ids give one row each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from wattloom.llm.common import saved

GRAM = 3
#: Share of a template's grams that a span must hold (all of a template of at most so many words), diagonals between
#: neighbours, longest span against the template.
COVERAGE, SHORT, NEIGHBOURS, STRETCH = 0.6, 14, 6, 1.6
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that count wherever they stand, and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notices of well-known public licenses, and their labels.
TEMPLATES = {
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"],
    "apache-2": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "gpl": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "gpl-3": ["licensed under the GNU General Public License, version 3"],
    "gpl-2": ["licensed under the GNU General Public License, version 2"],
    "lgpl": ["under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "agpl": ["under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "mpl-2": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "cc-by": ["licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa": ["licensed under a Creative Commons Attribution ShareAlike 4.0 International License"],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
}


def template_words(text: str) -> list[str]:
    return re.findall(WORD, re.sub("[A-Z]+", lambda m: m[0].lower(), text))


def template_rows() -> list[tuple]:
    """(template, label, exact, grams, words, position, gram) of every template position."""
    all_ = [(text, label, True) for text, label in PHRASES.items()] + [(text, label, False) for label, texts in TEMPLATES.items() for text in texts]
    out = []
    for number, (text, label, exact) in enumerate(all_):
        words = template_words(text)
        grams = len(words) - GRAM + 1
        out += [(number, label, exact, grams, len(words), k, " ".join(words[k : k + GRAM])) for k in range(grams)]
    return out


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(text.rlike(r"^\p{ASCII}*$"), F.lower(text)).otherwise(F.translate(text, letters, letters.lower()))


def matches(docs: DataFrame) -> DataFrame:
    """A row for each gram that stands in a template, and one at least for each row of docs."""
    spark = docs.sparkSession
    templates = spark.createDataFrame(template_rows(), "template int, label string, exact boolean, grams int, length int, t int, tgram string").withColumn("hash", F.xxhash64("tgram"))
    words = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.regexp_extract_all(lower_ascii(F.coalesce("text", F.lit(""))), F.lit(WORD), 0).alias("w")).withColumn("n_words", F.size("w"))
    gram = lambda i: F.concat_ws(" ", *(F.element_at("w", i + 1 + k) for k in range(GRAM)))
    grams = F.when(F.col("n_words") >= GRAM, F.transform(F.sequence(F.lit(0), F.col("n_words") - GRAM), gram))
    rolled = words.select("row", "doc_id", "n_words", F.posexplode_outer(grams).alias("p", "gram")).withColumn("hash", F.xxhash64("gram"))
    joined = rolled.join(F.broadcast(templates), (rolled["hash"] == templates["hash"]) & (F.col("gram") == F.col("tgram")), "left")
    return joined.where("template is not null or p is null or p = 0").select("row", "doc_id", "n_words", "template", "label", "exact", "grams", "length", "p", "t")


def spans(found: DataFrame) -> DataFrame:
    """row, label, exact, start, stop (words) and coverage of every verified span."""
    votes = found.where("template is not null").groupBy("row", "template", "label", "exact", "grams", "length", (F.col("p") - F.col("t")).alias("diagonal")).agg(F.count("*").alias("votes"), F.min("p").alias("lo"), F.max("p").alias("hi"), F.collect_set("t").alias("ts"))
    phrases = votes.where("exact and votes = grams").select("row", "label", "exact", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("length")).alias("stop"), F.lit(1.0).alias("coverage"))
    own = Window.partitionBy("row", "template").orderBy("diagonal")
    strong = votes.where("not exact and votes > 1").withColumn("new", F.when(F.col("diagonal") - F.lag("diagonal").over(own) <= NEIGHBOURS, 0).otherwise(1)).withColumn("group", F.sum("new").over(own))
    merged = strong.groupBy("row", "template", "label", "exact", "grams", "length", "group").agg(F.min("lo").alias("start"), (F.max("hi") + GRAM).alias("stop"), F.size(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("covered"))
    coverage = F.col("covered") / F.col("grams")
    near = (F.col("stop") - F.col("start") <= STRETCH * F.col("length") + GRAM) & (coverage >= F.when(F.col("length") <= SHORT, 1.0).otherwise(COVERAGE))
    return phrases.unionByName(merged.where(near).select("row", "label", "exact", "start", "stop", coverage.alias("coverage")))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    found = saved(matches(docs))
    joined = lambda c: F.coalesce(F.array_join(F.sort_array(c), ","), F.lit(""))
    base = F.when(F.col("exact"), F.col("start"))
    by_row = spans(found).groupBy("row").agg(F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"), F.collect_set(F.when(F.col("exact"), F.col("label"))).alias("bases"), F.collect_set("label").alias("all"), F.max("coverage").alias("score"))
    rows = found.select("row", "doc_id", "n_words").distinct().join(by_row, "row", "left")
    return rows.select("doc_id", F.col("n_words").cast("long"), F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long"), F.col("last_word").cast("long"), joined("bases").alias("base_labels"), joined("all").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
