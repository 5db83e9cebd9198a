"""License scan by diagonal voting.

All rolling word ``K``-grams of a document are joined to the places where they stand in license templates. A vote is a
pair (word in the document, word in the template); its diagonal is the difference of the two. Votes are counted by
(document, template, diagonal), neighbouring diagonals (up to ``NEAR`` words apart: small edits) are merged, and a span
is kept if its votes cover at least ``COVER`` of the template's K-grams at ``LEAST_VOTES`` places. Grams that no template
has are left out inside the scan, and each vote's words are compared, so a join row is a true match. The
template table is a fixed text and is broadcast.

Beside that, fixed phrases (``PHRASES``) are found word for word.

Defined results: null and empty texts have no words and no labels; repeated rows are reported each; a null id is an id
like any other; extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import words
from riskloom.session import at_rest

K = 5
NEAR = 3
COVER = 0.5
LEAST_VOTES = 2

#: Fixed values of the contract.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Public license texts and notices (label, text).
TEMPLATES = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software."""),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at"""),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version."""),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
General Public License as published by the Free Software Foundation"""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at"""),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("warranty-disclaimer", """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""),
)


def _words(text: str) -> list[bytes]:
    (piece,) = words.pieces(pa.array([text]), words.ALNUM, lower=True)
    return [piece.text(i, i + 1) for i in range(len(piece.hash))]


def _gram(own: list[bytes]) -> int:
    (piece,) = words.pieces(pa.array([b" ".join(own).decode()]), words.ALNUM, lower=True)
    return int(piece.grams(len(own))[1][0])


def template_grams(templates=TEMPLATES, k: int = K) -> list[tuple[int, bytes, int, int, str, int]]:
    """(hash, words, template, place, label, number of grams) of every k-gram of every template."""
    out = []
    for number, (label, text) in enumerate(templates):
        own = _words(text)
        count = max(0, len(own) - k + 1)
        out += [(_gram(own[i : i + k]), b" ".join(own[i : i + k]), number, i, label, count) for i in range(count)]
    return out


def scan(docs: DataFrame, templates=TEMPLATES, k: int = K, cover: float = COVER) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score for every row."""
    spark = docs.sparkSession
    table = template_grams(templates, k)
    by_hash = {h: text for h, text, *_ in table}
    known = np.array(sorted(by_hash), np.uint64)
    phrases = [(len(p.split()), np.uint64(_gram([w.encode() for w in p.split()])), p.encode(), label) for p, label in PHRASES]
    given = docs.select("doc_id", F.xxhash64("text").alias("tag"), F.col("text").cast("string"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch["text"], words.ALNUM, lower=True):
                n = piece.hi - piece.lo
                places: list[list[int]] = [[] for _ in range(n)]
                labels: list[set] = [set() for _ in range(n)]
                for size, h, text, label in phrases:
                    at, grams = piece.grams(size)
                    for i in at[grams == h].tolist():
                        if piece.text(i, i + size) == text:
                            row = int(piece.row[i])
                            places[row].append(i - int(piece.first[row]))
                            labels[row].add(label)
                votes: list[list[dict]] = [[] for _ in range(n)]
                at, grams = piece.grams(k)
                if len(known) and len(at):
                    slot = np.minimum(np.searchsorted(known, grams), len(known) - 1)
                    for j in np.flatnonzero(known[slot] == grams).tolist():
                        i, h = int(at[j]), int(grams[j])
                        if piece.text(i, i + k) == by_hash[h]:
                            row = int(piece.row[i])
                            votes[row].append({"place": i - int(piece.first[row]), "gram": h - (1 << 64) if h >> 63 else h})
                part = batch.slice(piece.lo, n)
                kind = pa.list_(pa.struct([("place", pa.int64()), ("gram", pa.int64())]))
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"], part["tag"], pa.array(piece.counts.astype(np.int64)), pa.array([len(p) for p in places], pa.int64()),
                    pa.array([min(p) if p else None for p in places], pa.int64()), pa.array([max(p) if p else None for p in places], pa.int64()),
                    pa.array([sorted(x) for x in labels], pa.list_(pa.string())), pa.array(votes, kind),
                ], ["doc_id", "tag", "n_words", "n_base", "first_word", "last_word", "found", "votes"])

    schema = f"doc_id {given.schema['doc_id'].dataType.simpleString()}, tag long, n_words long, n_base long, first_word long, last_word long, found array<string>, votes array<struct<place:long,gram:long>>"
    scanned = at_rest(given.mapInArrow(step, schema), "licence-votes")
    rows = [(h - (1 << 64) if h >> 63 else h, number, place, label, count) for h, _, number, place, label, count in table]
    grams = spark.createDataFrame(rows, "gram long, template int, t_place long, label string, n_grams long")
    judged = verified(vote(scanned, F.broadcast(grams)), cover)
    marks = judged.groupBy("doc_id", "tag").agg(F.collect_set(F.when(F.col("kept"), F.col("label"))).alias("added"), F.max("cover").alias("best"))
    marks = marks.withColumnsRenamed({"doc_id": "marked_id", "tag": "marked_tag"})
    same = F.col("doc_id").eqNullSafe(F.col("marked_id")) & (F.col("tag") == F.col("marked_tag"))
    every = F.array_sort(F.array_distinct(F.concat("found", F.coalesce("added", F.array().cast("array<string>")))))
    return scanned.join(marks, same, "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("found", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"), F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def vote(scanned: DataFrame, grams: DataFrame) -> DataFrame:
    """Votes with their diagonal; repeated rows vote once."""
    some = scanned.where(F.size("votes") > 0).select("doc_id", "tag", "votes").dropDuplicates(["doc_id", "tag"])
    each = some.select("doc_id", "tag", F.explode("votes").alias("v")).select("doc_id", "tag", "v.place", "v.gram")
    return each.join(grams, "gram").withColumn("diagonal", F.col("place") - F.col("t_place"))


def verified(votes: DataFrame, cover: float = COVER, near: int = NEAR) -> DataFrame:
    """One row per merged diagonal band: its label, words, cover of the template, and whether it is kept."""
    one = ["doc_id", "tag", "template", "label", "n_grams"]
    lines = votes.groupBy(*one, "diagonal").agg(F.collect_set("t_place").alias("hit"), F.min("place").alias("first"), F.max("place").alias("last"))
    order = Window.partitionBy("doc_id", "tag", "template").orderBy("diagonal")
    jump = (F.col("diagonal") - F.lag("diagonal").over(order) > near).cast("int")
    bands = lines.withColumn("jump", F.coalesce(jump, F.lit(0))).withColumn("band", F.sum("jump").over(order))
    merged = bands.groupBy(*one, "band").agg(F.array_distinct(F.flatten(F.collect_list("hit"))).alias("hit"), F.min("first").alias("first"), F.max("last").alias("last"))
    share = F.size("hit") / F.col("n_grams")
    return merged.select(*one, "first", "last", share.alias("cover")).withColumn(
        "kept", (F.col("cover") >= cover) & (F.col("cover") * F.col("n_grams") >= F.least(F.lit(LEAST_VOTES), F.col("n_grams")) - 0.5)
    )
