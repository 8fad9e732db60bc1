"""License scans by diagonal voting.

All rolling word pairs of a text are joined by hash to the positions of the
same pair in license phrases and templates. Joined pairs are checked word by
word, then counted per text, template and diagonal (place in the text less
place in the template). Neighbouring diagonals are merged into bands that overlap
by half, so up to ``DRIFT`` words put in or left out do not break a template. A
band is verified by its longest chain of pairs that ascends in the text and in
the template: it is a span if the chain reaches ``SHARE`` of the template's pairs.

A null text is empty. Equal texts share their result, so repeated rows each get
it. A phrase needs all of its pairs on one diagonal, which is the same as its
words standing in a row. An empty table gives an empty result. Only the id and
text columns are read, so other columns cannot clash.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.llm.common import load, settled

DRIFT = 8
SHARE = 0.6
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: The usual notice of each license.
TEMPLATES = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files to deal in the software without restriction",
    "apache-notice": "licensed under the apache license version 2 0 you may not use this file except in compliance with the license",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice appear in all copies",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
    "compile sell or distribute this software either in source code form or as a compiled binary for any purpose",
    "cc-notice": "this work is licensed under a creative commons attribution 4 0 international license",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
#: A pair of two of these is too common to seed a template.
COMMON = "a and any as by can for in is it may not of on or that the this to under with you".split()


def template_pairs() -> list[tuple]:
    """(template, label, is_phrase, pairs wanted, place, first word, second word)."""
    rows = []
    for text, label, phrase in [(t, k, True) for t, k in PHRASES.items()] + [(t, k, False) for k, t in TEMPLATES.items()]:
        w = text.split()
        pairs = [(i, a, b) for i, (a, b) in enumerate(zip(w, w[1:], strict=False)) if phrase or not (a in COMMON and b in COMMON)]
        rows += [(text, label, phrase, len(pairs), i, a, b) for i, a, b in pairs]
    return rows


def _templates(spark: SparkSession) -> DataFrame:
    schema = "template string, label string, phrase boolean, wanted int, place int, a string, b string"
    return spark.createDataFrame(template_pairs(), schema).withColumn("h", F.xxhash64("a", "b"))


def _words(text):
    # lower case changes no word's bounds; outside A-Z it touches no phrase
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def diagonals(texts: DataFrame) -> DataFrame:
    """Distinct places of template pairs per text (``key``), template and diagonal."""
    d = texts.select("key", _words(F.col("text")).alias("w"))
    n = F.size("w")
    at = F.when(n > 1, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
    pair = F.transform(at, lambda i: F.struct(
        i.alias("i"), F.xxhash64(F.get("w", i), F.get("w", i + 1)).alias("h"), F.get("w", i).alias("wa"), F.get("w", i + 1).alias("wb")))
    d = d.select("key", F.explode(pair).alias("p")).select("key", "p.*")
    # the pairs of the fixed templates above, some hundred rows whatever the input
    # holds: without the hint every pair of every text would be shuffled
    d = d.join(F.broadcast(_templates(texts.sparkSession)), "h").filter("a = wa and b = wb")
    return d.groupBy("key", "template", "label", "phrase", "wanted", (F.col("i") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"))


def verified(found: DataFrame) -> DataFrame:
    """Per text: phrase places and labels, template labels and the best share."""
    phrases = found.filter("phrase and size(places) = wanted").groupBy("key").agg(
        F.count(F.lit(1)).alias("n_base"), F.min("diagonal").cast("long").alias("first_word"),
        F.max("diagonal").cast("long").alias("last_word"), F.collect_set("label").alias("base"))
    # a diagonal lies in two bands of 2 * DRIFT; a band holds at most so many hits per place of the template
    band = F.explode(F.transform(F.array(F.lit(0), F.lit(1)), lambda k: F.struct(
        k.alias("shifted"), F.floor((F.col("diagonal") + k * DRIFT) / (2 * DRIFT)).alias("at"))))
    hits = F.transform("places", lambda p: F.struct((p + F.col("diagonal")).alias("i"), p.alias("place")))
    d = found.filter("not phrase").select("key", "template", "label", "wanted", band.alias("band"), hits.alias("hits"))
    d = d.groupBy("key", "template", "label", "wanted", "band").agg(F.sort_array(F.flatten(F.collect_list("hits"))).alias("hits"))
    d = d.withColumn("chain", chain(F.col("hits")))
    share = F.col("chain.n") / F.col("wanted")
    span = F.struct(F.col("chain.first").alias("start"), (F.col("chain.i") + 2).alias("end"), F.col("label"))
    own = d.groupBy("key").agg(
        F.max(share).alias("share"), F.collect_set(F.when(share >= SHARE, F.col("label"))).alias("own"),
        F.sort_array(F.collect_set(F.when(share >= SHARE, span))).alias("spans"))
    return phrases.join(own, "key", "full_outer")


def chain(hits):
    """Longest chain of sorted hits ``(i, place)`` that ascends in both: ``n``, ``i`` of its last hit and ``first`` of its first."""
    def grow(done, hit):
        before = F.filter(done, lambda c: (c["i"] < hit["i"]) & (c["place"] < hit["place"]))
        best = F.array_max(F.transform(before, lambda c: F.struct(c["n"].alias("n"), (-c["i"]).alias("near"), c["first"].alias("first"))))
        link = F.struct((F.coalesce(best["n"], F.lit(0)) + 1).alias("n"), hit["i"].alias("i"), hit["place"].alias("place"),
                        F.coalesce(best["first"], hit["i"]).alias("first"))
        return F.concat(done, F.array(link))

    none = F.array().cast("array<struct<n:int,i:int,place:int,first:int>>")
    return F.array_max(F.aggregate(hits, none, grow))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` with its license places, labels, score and template spans (words, end exclusive).

    A text without any pair of a license has no part in the join back; the side
    with the results is small and holds a text once.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), F.md5(text).alias("key"), text.alias("text"))
    found = settled(diagonals(d.select("key", "text")), "license-diagonals")
    none = F.array().cast("array<string>")
    d = d.select("doc_id", "key", F.size(_words(F.col("text"))).cast("long").alias("n_words"))
    d = d.join(verified(found), "key", "left")
    base, own = F.coalesce("base", none), F.coalesce("own", none)
    joined = lambda x: F.array_join(F.sort_array(x), ",")
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.least(F.coalesce("share", F.lit(0.0)), F.lit(1.0)))
    return d.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        joined(base).alias("base_labels"), joined(F.array_union(base, own)).alias("labels"), score.alias("score"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int,label:string>>")).alias("spans"))


def op7_licenses(spark, folder):
    d = scan(load(spark, folder, "documents"))
    told = F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["start"].cast("string"), s["end"].cast("string")))
    return d.withColumn("spans", F.array_join(told, ","))
