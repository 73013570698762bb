"""License scans: an exact set-similarity join of text blocks with notice templates, by containment.

A block is a line, as in the SQL; a notice wrapped over lines is found with `spanning`, which takes paragraphs (between blank lines)
and overlapping windows of twice the longest template instead. Its distinct words that occur in a template are ordered by how many blocks of the whole corpus
hold them, rarest first (words of no template cannot add to an overlap and are left out beforehand). A template must share
ceil(threshold * size) words with a block, so

- length: the block has at least that many template words;
- prefix: one of the template's first `size - needed + 1` words is among the block's first ones;
- position: at their first common word, what is left on both sides still reaches the number needed.

Survivors are counted exactly. The templates are a table of fixed, small size; only it is broadcast, and only the counts
of its words come to the driver.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rangehaul.llm.store import written

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(rb"\n[ \t\r]*\n")
THRESHOLD = 0.8

# Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Wording of public notices, and labels of our own.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-2.0-or-later", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("mit-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit-notice", "Released under the MIT License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("all-rights-reserved", "All rights reserved"),
)


def tokens(text: str) -> list[str]:
    return [w.decode() for w in WORD.findall(text.encode().lower())]


def _spanning(data: bytes, words: list[bytes], known: dict[bytes, int], most: int) -> list[list[int]]:
    """Template words of each paragraph, and of windows of which one holds any `most` words in a row; each set once."""
    runs = [WORD.findall(p) for p in BLANK.split(data)] + [words[at : at + 2 * most] for at in range(0, max(1, len(words) - most), most)]
    sets = {tuple(sorted(known[w] for w in known.keys() & set(run))) for run in runs}
    return [list(ids) for ids in sorted(sets) if ids]


def _scanned(phrases: Sequence[tuple[str, str]], vocabulary: list[str], most: int | None):
    known = {w.encode(): i for i, w in enumerate(vocabulary)}
    wanted = [(p.encode().split(), label) for p, label in phrases]
    lasts = {p[-1] for p, _ in wanted}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, places, blocks = [], [], []
            for text in batch.column("text"):
                data = (text.as_py() or "").encode().lower()  # bytes: A-Z only
                found, start, own = [], 0, []
                may = any(w in data for w in lasts)
                for line in data.split(b"\n"):
                    words = WORD.findall(line)
                    if most is None and (ids := known.keys() & set(words)):
                        own.append(sorted(known[w] for w in ids))
                    if may or most is not None:
                        found.extend(words)
                    start += len(words)
                if most is not None:
                    own = _spanning(data, found, known, most)
                counts.append(start)
                blocks.append(own)
                places.append([{"start": at - len(p) + 1, "label": label} for at, word in enumerate(found) if word in lasts for p, label in wanted if found[max(0, at - len(p) + 1) : at + 1] == p])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(places, pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))), pa.array(blocks, pa.list_(pa.list_(pa.int32())))],
                names=["doc_id", "n_words", "places", "blocks"],
            )

    return run


def license_scan(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD, spanning: bool = False) -> DataFrame:
    """Phrases (exact places) and templates (containment of at least `threshold` in a line, or with `spanning` in a paragraph or window) of each row.

    One row per row of `documents`: `doc_id`, `n_words`, `places` (start, label), `n_base`, `first_word`, `last_word`, `base_labels`,
    `labels`, `score` (greatest containment of a found template; 1 with a phrase; 0 with neither).

    - null text is empty; a null id is kept as it is; equal rows get equal results;
    - a line of any length is one block; a document of one line is one block;
    - an empty table gives an empty result; other columns are ignored.
    """
    spark = documents.sparkSession
    sets = [(label, sorted(set(tokens(notice)))) for label, notice in templates]
    sets = [(label, words, math.ceil(threshold * len(words) - 1e-9)) for label, words in sets if words]
    vocabulary = sorted({w for _, words, _ in sets for w in words})
    most = max((len(tokens(notice)) for _, notice in templates), default=1) or 1
    most = most if spanning else None
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    kinds = "doc_id long, n_words long, places array<struct<start: long, label: string>>, blocks array<array<int>>"
    scanned = written(rows.mapInArrow(_scanned(phrases, vocabulary, most), kinds).withColumn("row", F.monotonically_increasing_id()), "blocks")

    blocks = scanned.select("row", F.posexplode("blocks").alias("block", "ids"))
    counts = dict(blocks.select(F.explode("ids").alias("id")).groupBy("id").count().collect())
    order = sorted(range(len(vocabulary)), key=lambda i: (counts.get(i, 0), i))
    rank = {i: r for r, i in enumerate(order)}
    number = {w: rank[i] for i, w in enumerate(vocabulary)}

    ranked = [(label, sorted(number[w] for w in words), needed) for label, words, needed in sets]
    prefixes = [(t, label, ids, needed, place, ids[place]) for t, (label, ids, needed) in enumerate(ranked) for place in range(len(ids) - needed + 1)]
    table = spark.createDataFrame(prefixes, "template int, label string, words array<int>, needed int, place int, word int")
    least = min((needed for *_, needed in sets), default=1)
    ranks = F.array(*[F.lit(rank[i]) for i in range(len(vocabulary))])
    ordered = blocks.where(F.size("ids") >= least).withColumn("own", F.array_sort(F.transform("ids", lambda i: F.element_at(ranks, i + 1))))
    size = F.size("own")
    # The prefix of the block for the template that needs least; the others' is shorter and checked below.
    prefix = F.slice("own", 1, size - least + 1)
    met = ordered.select("row", "block", "own", F.posexplode(prefix).alias("at", "word")).join(F.broadcast(table), "word")
    able = (size >= F.col("needed")) & (F.col("at") <= size - F.col("needed"))
    left = 1 + F.least(size - F.col("at") - 1, F.size("words") - F.col("place") - 1)
    candidates = met.where(able & (left >= F.col("needed"))).select("row", "block", "template", "label", "needed", "own", "words")
    shared = F.size(F.array_intersect("own", "words"))
    found = candidates.where(shared >= F.col("needed")).select("row", "label", (shared / F.size("words")).alias("containment"))
    best = found.groupBy("row").agg(F.collect_set("label").alias("own_labels"), F.max("containment").alias("containment"))

    base = F.array_distinct(F.col("places.label"))
    joined = scanned.drop("blocks").join(best, "row", "left")
    some = F.size("places") > 0
    return joined.select(
        "doc_id", "n_words", "places", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("own_labels", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(some, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
