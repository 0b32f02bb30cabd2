"""License scan by diagonal voting.

Every rolling word k-gram of every document is joined with the template
positions holding the same k-gram (hash join, then the k-gram's bytes are
compared). A hit at document word p and template word t votes for diagonal
p - t; votes are summed per (document, template, diagonal), neighbouring
diagonals (words inserted or lost) are merged, and a merged run is verified:
a label is given when the distinct template k-grams found cover at least
``min_cover`` of the template within a span of at most ``max_stretch`` times
its length (templates of fewer than ``SHORT`` words must be covered whole:
one word tells CC BY from CC BY-NC). A diagonal holding all k-grams of its template is an exact place.

The templates are the fixed list below (or the caller's, at most
``MAX_TEMPLATE_WORDS`` words in all), so broadcasting them is bounded.

Defined results: null and empty texts have no words, no places, score 0.0;
repeated rows are scanned each for itself (told apart by input position);
places may overlap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .decontam import tokenised
from .store import materialise
from .text import SENTINEL_LONG, hash_words, ngram_hashes

MAX_TEMPLATE_WORDS = 100_000

#: phrases whose exact places are counted
BASE = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
#: notices recognised with insertions and losses
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files to deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "cc0 1 0 universal public domain dedication"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved"),
]
K = 2
SHORT = 8


def template_grams(spark, base, notices) -> DataFrame:
    """One row per template k-gram: hash, template, position, template length, bytes of the k-gram."""
    import numpy as np
    rows = []
    total = 0
    for i, (kind, (label, phrase)) in enumerate([("base", x) for x in base] + [("notice", x) for x in notices]):
        words = phrase.split()
        total += len(words)
        grams = ngram_hashes(np.array(hash_words(words), np.int64).view(np.uint64), K).view(np.int64).tolist()
        for t, g in enumerate(grams):
            rows.append((g, i, label, kind == "base", t, len(words), (" ".join(words[t:t + K]) + " ").encode()))
    if total > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates hold {total} words; at most {MAX_TEMPLATE_WORDS} are broadcast")
    rows.append((SENTINEL_LONG, -1, None, False, 0, 0, None))
    return spark.createDataFrame(
        rows, "gram long, template int, label string, base boolean, tpos int, len int, bytes binary")


def votes(docs: DataFrame, *, text_col: str = "text", keys: list[str], base=BASE, notices=NOTICES) -> DataFrame:
    """Votes per diagonal: ``keys``, ``n``, ``template``, ``label``, ``base``, ``len``, ``diag``, ``tset`` (template k-grams found)."""
    grams = tokenised(docs, text_col, keys, K)
    post = grams.select(*keys, "_n", "_norm", "_offs", F.posexplode("_tokens").alias("pos", "gram"))
    hit = post.join(F.broadcast(template_grams(docs.sparkSession, base, notices)), "gram")
    a, b = F.get("_offs", F.col("pos")), F.get("_offs", F.col("pos") + K)
    same = F.substring(F.col("_norm"), a + 1, b - a) == F.col("bytes")
    end = F.col("pos") == F.greatest(F.col("_n") - (K - 1), F.lit(0))
    hit = hit.where(F.when(F.col("template") < 0, end).otherwise((F.col("pos") + K <= F.col("_n")) & same))
    return hit.groupBy(*keys, "template", "label", "base", "len", (F.col("pos") - F.col("tpos")).alias("diag")).agg(
        F.first("_n").alias("n"), F.collect_set("tpos").alias("tset"))


def spans(v: DataFrame, keys: list[str], *, slack: int = 2, min_cover: float = 0.8, max_stretch: float = 1.5) -> DataFrame:
    """Merge neighbouring diagonals and verify: ``keys``, ``template``, ``label``, ``first``, ``last`` word, ``cover``."""
    v = v.where((F.col("template") >= 0) & ~F.col("base"))
    w = Window.partitionBy(*keys, "template").orderBy("diag")
    v = v.withColumn("_new", F.when(F.col("diag") - F.lag("diag").over(w) <= slack, 0).otherwise(1))
    v = v.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    m = v.groupBy(*keys, "template", "label", "len", "_run").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("tset")))).alias("found"),
        F.max(F.size("tset")).alias("straight"),
        F.min(F.col("diag") + F.array_min("tset")).alias("first"),
        F.max(F.col("diag") + F.array_max("tset") + K - 1).alias("last"))
    m = m.withColumn("cover", F.col("found") / (F.col("len") - (K - 1)))
    need = F.when(F.col("len") < SHORT, 1.0).otherwise(min_cover)
    # one diagonal alone may suffice: chance votes beside it must not hide it
    return m.withColumn("verified", ((F.col("cover") >= need)
                                     & (F.col("last") - F.col("first") + 1 <= max_stretch * F.col("len")))
                        | (F.col("straight") >= need * (F.col("len") - (K - 1)))).drop("_run", "straight")


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text", base=BASE, notices=NOTICES,
         min_cover: float = 0.8) -> DataFrame:
    """One row per document row: word and place counts, labels and the best template cover."""
    src = docs.select(F.col(f"`{doc_id}`").alias("_doc"), F.col(f"`{text_col}`").alias("_body"),
                      F.monotonically_increasing_id().alias("_row"))
    keys = ["_row", "_doc"]
    v = materialise(votes(src, text_col="_body", keys=keys, base=base, notices=notices))
    full = F.col("base") & (F.size("tset") == F.col("len") - (K - 1))
    per = v.groupBy("_row").agg(
        F.first("_doc").alias("_doc"), F.first("n").cast("long").alias("n_words"),
        F.count(F.when(full, 1)).alias("n_base"),
        F.min(F.when(full, F.col("diag"))).cast("long").alias("first_word"),
        F.max(F.when(full, F.col("diag"))).cast("long").alias("last_word"),
        F.collect_set(F.when(full, F.col("label"))).alias("_base"),
        F.max(F.when(F.col("base"), F.size("tset") / (F.col("len") - (K - 1)))).alias("_base_cover"))
    s = spans(v, keys, min_cover=min_cover).groupBy("_row").agg(
        F.collect_set(F.when(F.col("verified"), F.col("label"))).alias("_more"), F.max("cover").alias("_cover"))
    d = per.join(s, "_row", "left")
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    none = F.array().cast("array<string>")
    return d.select(F.col("_doc").alias(doc_id), "n_words", "n_base", "first_word", "last_word",
                    joined(F.col("_base")).alias("base_labels"),
                    joined(F.concat("_base", F.coalesce("_more", none))).alias("labels"),
                    F.greatest(F.coalesce("_base_cover", F.lit(0.0)), F.coalesce("_cover", F.lit(0.0))).alias("score"))
