"""License scan: word k-grams vote for the offset diagonal between a document and a template."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from targetlens.llm.common import Scratch, let, plain_words, row_identity, same_row

K = 3
#: Diagonals at most this far apart belong to one span (words inserted or left out in between).
DIAGONAL_GAP = 3
MIN_COVERAGE = 0.8

#: Base phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Wording of common public licence notices, in plain words.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in "
               "compliance with the license you may obtain a copy of the license at"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction including "
            "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
            "copies of the software"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
            "is hereby granted provided that the above copyright notice and this permission notice appear in all "
            "copies"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def templates(spark: SparkSession) -> DataFrame:
    """(template, label, base, wording) of the phrases and notices."""
    rows = [(label, True, text) for text, label in PHRASES.items()]
    rows += [(label, False, text) for label, text in TEMPLATES]
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)], "template int, label string, base boolean, wording string"
    )


def _grams(words: Column, size: int) -> Column:
    """Array of (pos, gram): hashes of all runs of ``size`` words."""
    last = F.size(words) - size + 1
    return F.when(last >= 1, F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.struct((i - 1).alias("pos"), F.xxhash64(F.slice(words, i, size)).alias("gram")),
    )).otherwise(F.array().cast("array<struct<pos:int,gram:bigint>>"))


def _short_grams(words: Column, phrases: list[list[str]]) -> Column:
    """(pos, gram) of the runs that can begin a phrase of fewer than K words."""
    out = F.array().cast("array<struct<pos:int,gram:bigint>>")
    for size in sorted({len(p) for p in phrases}):
        firsts = sorted({p[0] for p in phrases if len(p) == size})
        starts = F.filter(
            F.transform(words, lambda w, i: F.when(w.isin(firsts), i)), lambda i: i.isNotNull()
        )
        out = F.concat(out, F.transform(starts, lambda i: F.struct(
            i.alias("pos"), F.xxhash64(F.slice(words, i + 1, size)).alias("gram"))))
    return out


def template_grams(kinds: DataFrame) -> DataFrame:
    """(template, label, base, n_grams, at, gram); a wording of under K words is one gram."""
    words = kinds.withColumn("w", F.split("wording", " "))
    size = F.least(F.size("w"), F.lit(K))
    gram = F.transform(
        F.sequence(F.lit(1), F.size("w") - size + 1),
        lambda i: F.xxhash64(F.slice("w", i, F.least(F.size("w"), F.lit(K)))),
    )
    return words.select(
        "template", "label", "base", size.alias("k"), (F.size("w") - size + 1).alias("n_grams"),
        F.posexplode(gram).alias("at", "gram"),
    )


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _h, template, label, base, first, last, coverage) of every verified place.

    Each gram match votes for the diagonal position minus template position. Neighbouring
    diagonals are merged while their places overlap, and the merged span stands if it holds enough
    of the template's grams, in no more room than the template with its gaps needs. Phrases must
    be whole and on one diagonal.
    """
    scratch = Scratch(docs.sparkSession)
    grams = scratch.keep(template_grams(templates(docs.sparkSession)))
    short = [p.split() for p in PHRASES if len(p.split()) < K]
    placed = docs.select(
        *row_identity(id_col, text_col),
        F.explode(let(plain_words(F.col(text_col)), lambda w: F.concat(_grams(w, K), _short_grams(w, short)))).alias("e"),
    ).select("_id", "_h", "e.pos", "e.gram")
    # the templates are constants of this module: about 200 rows on every executor
    votes = placed.join(F.broadcast(grams), "gram")
    row = ["_id", "_h", "template", "label", "base", "n_grams", "k"]
    diagonals = (
        votes.groupBy(*row, (F.col("pos") - F.col("at")).alias("diagonal"))
        .agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.collect_set("at").alias("at"))
    )
    phrases = diagonals.where("base").where(F.size("at") == F.col("n_grams"))
    along = W.partitionBy("_id", "_h", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(along)
    notices = (
        diagonals.where("not base")
        .withColumn("opens", F.when(step <= DIAGONAL_GAP, 0).otherwise(1))
        .withColumn("span", F.sum("opens").over(along.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy(*row, "span")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"))
        .where(F.size("at") >= MIN_COVERAGE * F.col("n_grams"))
        .where((F.col("hi") - F.col("lo") + 1) * MIN_COVERAGE <= F.col("n_grams") + 2 * DIAGONAL_GAP)
    )
    shape = [
        "_id", "_h", "template", "label", "base", F.col("lo").alias("first"),
        (F.col("hi") + F.col("k") - 1).alias("last"), (F.size("at") / F.col("n_grams")).alias("coverage"),
    ]
    return phrases.select(*shape).unionByName(notices.select(*shape))


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``_id``, ``_h``, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the largest verified coverage, 0 without any place. A NULL or empty text has no
    words; its labels are empty and its places NULL. Repeated rows get the same answer.
    """
    spans = license_spans(docs, id_col, text_col).distinct()
    base = F.when(F.col("base"), F.col("label"))
    start = F.when(F.col("base"), F.col("first"))
    per_doc = spans.groupBy("_id", "_h").agg(
        F.count(start).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(base)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("coverage").alias("score"),
    )
    rows = docs.select(*row_identity(id_col, text_col), F.size(plain_words(F.col(text_col))).cast("long").alias("n_words"))
    return rows.join(per_doc, same_row(rows, per_doc), "left").select(
        rows["_id"], rows["_h"], "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
