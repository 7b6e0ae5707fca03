"""License scans by diagonal voting.

All rolling word k-grams of a text are joined by hash to their places in license texts. Grams of a copy
lie on one diagonal (place in the document minus place in the license), edits move it a little. So hits
are counted per diagonal, neighbouring diagonals are merged, and the resulting spans are verified.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm import hashing as H

#: Phrases that count wherever their words stand in a row.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notices and opening clauses of common licenses.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

PHRASE_GRAM, NOTICE_GRAM = 2, 4
#: Diagonals this close are one span.
NEAR = 3
#: Part of a notice's grams that must be found, and how much longer than the notice a span may be.
COVER, STRETCH = 0.6, 1.5
#: Words whose grams travel in one row.
SEGMENT = 4096

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

SEGMENTS = "row long, doc_id long, first long, n long, words binary, at array<int>, n_short int, grams array<long>"


def _hashed(texts: list[bytes]) -> H.Words:
    data = H.LOWER[np.frombuffer(b"".join(texts), np.uint8)]
    return H.Words(data, np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64), H.LETTERS)


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    return H.gram_hashes(words, size) + np.uint64(size)


def template_positions() -> list[tuple[int, int, int, bytes, int, int, str]]:
    """Every gram of the phrases and notices: hash, template, place, gram, its words, number of grams,
    label. Their number is fixed by the lists above."""
    rows = []
    known = [(label, text, PHRASE_GRAM) for text, label in PHRASES.items()] + [(label, text, NOTICE_GRAM) for label, text in NOTICES]
    for number, (label, text, size) in enumerate(known):
        words = _WORD.findall(text.lower().encode())
        hashes = _grams(_hashed([text.encode()]).hashes(), size).view(np.int64).tolist()
        rows += [(h, number, i, b" ".join(words[i : i + size]), size, len(hashes), label) for i, h in enumerate(hashes)]
    return rows


def segments(docs: DataFrame) -> DataFrame:
    """The words of each row in pieces of ``SEGMENT`` words, with the hashes of the grams that begin there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.blocks(batches):
            data, offsets = H.text_bytes(batch.column("text"))
            words = H.Words(H.LOWER[data], offsets, H.LETTERS)
            hashes = words.hashes()
            joined, starts, ends = words.joined()
            raw, after = joined.tobytes(), np.append(starts, len(joined)).astype(np.int32)
            by_size = {k: _grams(hashes, k).view(np.int64) for k in (PHRASE_GRAM, NOTICE_GRAM)}
            rows, docs_ = batch.column("row").to_pylist(), batch.column("doc_id").to_pylist()
            out = []
            for i, (begin, stop) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
                for first in range(begin, max(stop, begin + 1), SEGMENT):
                    last = min(first + SEGMENT, stop)
                    reach = min(last + NOTICE_GRAM, stop)
                    short = by_size[PHRASE_GRAM][first : max(first, min(last, stop - PHRASE_GRAM + 1))]
                    long_ = by_size[NOTICE_GRAM][first : max(first, min(last, stop - NOTICE_GRAM + 1))]
                    at = after[first : reach + 1] - after[first] if reach > first else after[:0]
                    text = raw[after[first] : after[reach]] if reach > first else b""
                    out.append((rows[i], docs_[i], first - begin, last - first, text, at, len(short), np.concatenate((short, long_))))
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64()] * 4 + [pa.binary(), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.int64())]
            names = [x.split()[0] for x in SEGMENTS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return numbered.mapInArrow(run, SEGMENTS)


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(template_positions(), "hash long, template int, place int, own binary, size int, n_grams int, label string")


def spans(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n, template, label, is_phrase, first_word, last_word, share): the verified spans,
    and for each row of ``docs`` one or more entries without a template that add up to its words.

    A gram is a hit if its words are those of the template. Each diagonal keeps the template places it
    has; a merged span is verified if it is not much longer than its template and covers enough of it,
    a phrase if its one diagonal has all places.
    """
    # The null in front of a segment's grams finds no template: its row carries the segment's words.
    grams = F.concat(F.array(F.lit(None).cast("long")), "grams")
    flat = segments(docs).select("row", "doc_id", "first", "n", "words", "at", "n_short", F.posexplode(grams).alias("at_gram", "hash"))
    flat = flat.withColumn("i", F.col("at_gram") - 1)
    size = F.when(F.col("i") < F.col("n_short"), PHRASE_GRAM).otherwise(NOTICE_GRAM)
    begin = F.when(F.col("i") < F.col("n_short"), F.col("i")).otherwise(F.col("i") - F.col("n_short"))
    # The templates are a fixed list of a few hundred grams.
    joined = flat.withColumns({"k": size, "p": begin}).join(F.broadcast(templates(docs.sparkSession)), "hash", "left")
    start = F.get("at", F.col("p"))
    gram = F.col("words").substr(start + 1, F.get("at", F.col("p") + F.col("k")) - start - 1)
    base = F.col("i") < 0
    hit = ~base & F.col("template").isNotNull() & (F.col("k") == F.col("size")) & (gram == F.col("own"))
    kept = joined.select(
        "row", "doc_id",
        F.when(base, F.col("n")).otherwise(0).alias("n"),
        F.when(hit, F.col("template")).alias("template"), "label", "n_grams", "size",
        (F.col("first") + F.col("p")).alias("word"), "place", hit.alias("hit"), base.alias("base"),
    ).where("hit or base")
    votes = kept.groupBy("row", "doc_id", "template", F.when(F.col("hit"), F.col("word") - F.col("place")).alias("diagonal")).agg(
        F.max("label").alias("label"), F.max("n_grams").alias("n_grams"), F.max("size").alias("size"),
        F.collect_set(F.when(F.col("hit"), F.col("place"))).alias("places"), F.min("word").alias("low"), F.max("word").alias("high"), F.sum("n").alias("n"),
    )
    lane = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(lane)
    far = gap.isNull() | (gap > NEAR) | (F.col("size") == PHRASE_GRAM)
    merged = (
        votes.withColumn("far", F.when(far, 1).otherwise(0))
        .withColumn("island", F.sum("far").over(lane))
        .groupBy("row", "doc_id", "template", "island")
        .agg(
            F.max("label").alias("label"), F.max("n_grams").alias("n_grams"), F.max("size").alias("size"),
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered"),
            F.min("low").alias("first_word"), (F.max("high") + F.max("size") - 1).alias("last_word"), F.sum("n").alias("n"),
        )
    )
    is_phrase = F.col("size") == PHRASE_GRAM
    length = F.col("last_word") - F.col("first_word") + 1
    fits = length <= STRETCH * (F.col("n_grams") + F.col("size") - 1)
    share = F.col("covered") / F.col("n_grams")
    verified = F.when(is_phrase, F.col("covered") == F.col("n_grams")).otherwise(fits & (share >= COVER))
    found = F.col("template").isNotNull() & verified
    return merged.select(
        "row", "doc_id", "n", F.when(found, F.col("template")).alias("template"), F.when(found, F.col("label")).alias("label"),
        is_phrase.alias("is_phrase"), "first_word", "last_word", F.when(found, share).alias("share"),
    )


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the largest covered part of a verified span, 0 without one. A null text has no words;
    a null doc_id is carried; repeated rows are scanned one by one; other columns are not read; an
    empty table gives an empty result.
    """
    phrase = F.col("label").isNotNull() & F.col("is_phrase")
    labels = F.array_join(F.array_sort(F.collect_set("label")), ",")
    return (
        spans(docs)
        .groupBy("row", "doc_id")
        .agg(
            F.sum("n").cast("long").alias("n_words"),
            F.count(F.when(phrase, 1)).alias("n_base"),
            F.min(F.when(phrase, F.col("first_word"))).cast("long").alias("first_word"),
            F.max(F.when(phrase, F.col("first_word"))).cast("long").alias("last_word"),
            F.array_join(F.array_sort(F.collect_set(F.when(phrase, F.col("label")))), ",").alias("base_labels"),
            labels.alias("labels"),
            F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )
