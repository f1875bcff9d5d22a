"""License scan by diagonal voting.

The hashes of all rolling word k-grams of the documents are joined with the places of the templates'
k-grams. Each hit votes for a diagonal (place in the document minus place in the template). Diagonals
with votes that lie close together are one candidate, which is verified word by word.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm.blocks import documents
from lamina.llm.joins import gram_hashes, grams, with_known

# Base phrases, and the public license texts and notices looked for, with their labels.
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
TEXTS = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software."""),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer."""),
    ("mit", "released under the MIT License"),
    ("apache", "licensed under the Apache License, Version 2.0"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("cc-by", "licensed under CC BY 4.0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
)
#: Words of a gram for phrases and for texts; how far neighbouring diagonals may lie apart; the share of
#: a text's words that must be found (all of them in short notices).
PHRASE_GRAM, TEXT_GRAM, SLACK, LEAST_SHARE, SHORT = 2, 4, 8, 0.6, 12
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.encode().lower().decode())


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    phrase: bool

    @property
    def gram(self) -> int:
        return PHRASE_GRAM if self.phrase else TEXT_GRAM


def templates(phrases=PHRASES, texts=TEXTS) -> list[Template]:
    """Phrases need two words at least, texts four."""
    return [Template(a, tuple(words_of(b)), True) for a, b in phrases] + [Template(a, tuple(words_of(b)), False) for a, b in texts]


def _template_grams(spark: SparkSession, known: list[Template]) -> DataFrame:
    """(gram, size, template, at): places of all k-grams of the templates."""
    rows = spark.createDataFrame(
        [(k, " ".join(t.words), t.gram) for k, t in enumerate(known)], "template long, text string, size int"
    )
    sides = [
        grams(rows.where(F.col("size") == size), "template", size).withColumn("size", F.lit(size))
        for size in (PHRASE_GRAM, TEXT_GRAM)
    ]
    return sides[0].unionByName(sides[1]).withColumnRenamed("position", "at")


def votes(rows: DataFrame, known: list[Template]) -> DataFrame:
    """(doc_id, votes array<struct<template, diagonal, n, low, high>>) of documents with any hit.

    low and high are the first and last template place that voted.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, words, (two, four) in gram_hashes(batches, (PHRASE_GRAM, TEXT_GRAM)):
            for size, column in ((PHRASE_GRAM, two), (TEXT_GRAM, four)):
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), pa.array(np.full(len(column), size), pa.int32()), column],
                    ["doc_id", "size", "grams"],
                )

    rolling = rows.mapInArrow(run, "doc_id long, size int, grams array<long>")
    rolling = rolling.select("doc_id", "size", F.posexplode("grams").alias("place", "gram"))
    hits = with_known(rolling, _template_grams(rows.sparkSession, known).withColumnRenamed("size", "of")).where("size = of")
    diagonals = hits.groupBy("doc_id", "template", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.min("at").alias("low"), F.max("at").alias("high")
    )
    return diagonals.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("template", "diagonal", "n", "low", "high"))).alias("votes")
    )


def verified(words: list[str], listed: list[dict], known: list[Template]) -> tuple[list[tuple[int, str]], dict[str, float], list]:
    """(phrase places, best share per label, spans) of one document from its votes."""
    places, shares, spans = [], {}, []
    for k in sorted({v["template"] for v in listed}):
        template = known[k]
        want, own = template.words, [v for v in listed if v["template"] == k]
        if template.phrase:
            for vote in own:
                at = vote["diagonal"]
                if at >= 0 and tuple(words[at : at + len(want)]) == want:
                    places.append((at, template.label))
            continue
        cluster: list[dict] = []
        for vote in [*own, None]:
            if cluster and (vote is None or vote["diagonal"] - cluster[-1]["diagonal"] > SLACK):
                found = set()
                for c in cluster:
                    for at in range(max(c["low"], -c["diagonal"]), min(c["high"] + template.gram, len(words) - c["diagonal"])):
                        if words[at + c["diagonal"]] == want[at]:
                            found.add((at, at + c["diagonal"]))
                share = len({at for at, _ in found}) / len(want)
                if share >= (1.0 if len(want) <= SHORT else LEAST_SHARE):
                    begin, end = min(p for _, p in found), max(p for _, p in found) + 1
                    spans.append((begin, end, template.label, share))
                    shares[template.label] = max(share, shares.get(template.label, 0.0))
                cluster = []
            if vote is not None:
                cluster.append(vote)
    return sorted(places), shares, sorted(spans)


def scan(docs: DataFrame, phrases=PHRASES, texts=TEXTS) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans).

    ``spans`` are [word from, word to, label, share] of the verified texts as JSON. ``score`` is the
    largest share of a template that was verified: 1 for a phrase, 0 without any. A document gathers
    at most its own votes. Null texts are empty, null ids are left out, repeated ids count once, an
    empty table gives an empty result. The template grams are broadcast after a count.
    """
    known = templates(phrases, texts)
    rows = documents(docs)
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string,"
        " labels string, score double, spans string"
    )
    names = [part.split()[0] for part in schema.replace("\n", " ").split(",")]
    kinds = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.float64(), pa.string()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, counted, _ in gram_hashes(batches, ()):
            listed, out = block.column("votes").to_pylist(), []
            texts_ = block.column("text")
            for k, (doc_id, n) in enumerate(zip(block.column("doc_id").to_pylist(), counted.counts.tolist())):
                places, shares, spans = [], {}, []
                if listed[k]:
                    places, shares, spans = verified(words_of(texts_[k].as_py()), listed[k], known)
                base = {label for _, label in places}
                ends = (places[0][0], places[-1][0]) if places else (None, None)
                score = max([1.0 if places else 0.0, *shares.values()])
                out.append((doc_id, n, len(places), *ends, ",".join(sorted(base)), ",".join(sorted(base | set(shares))), score, json.dumps(spans)))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), kinds)], names)

    return rows.join(votes(rows, known), "doc_id", "left").mapInArrow(run, schema)
