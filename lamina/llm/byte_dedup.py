"""Removal of byte strings that an earlier document holds, by sharded suffix arrays.

Every string of LENGTH bytes has one anchor: its gram of GRAM bytes with the smallest hash. The strings
that share an anchor place form a segment of the text, and the anchor's hash names the shard that gets it,
so equal strings meet in one shard. Anchors that no other document has are
dropped beforehand. A shard sorts all suffixes of its segments by induced sorting; neighbours with
LENGTH bytes in common are occurrences of one string, and the smallest document among them keeps it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.blocks import BASES, BYTE_VALUES, U64, Rolling, blocks, documents, flat, lists
from lamina.llm.graph import buckets
from lamina.llm.owners import Keys, flat_places, gathered, holders, joined, packed, packed_schema
from lamina.llm.suffix_arrays import Segmented, common_prefixes, suffix_array

LENGTH, GRAM = 50, 20
#: Bytes of segments sorted at once. A larger shard is cut by anchor, so its memory is that of a part.
SORTED_BYTES = 1 << 20
#: Room for any place in a block; an Arrow array of texts holds less than 2**31 bytes.
PLACE_BITS = U64(32)


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(anchor, first, last, hashes): anchor places and the range of string starts each stands for."""
    hashes = Rolling(BYTE_VALUES[data]).windows(gram)
    span = length - gram + 1
    count = len(data) - length + 1
    if count <= 0:
        return (np.zeros(0, np.int64),) * 3 + (hashes,)
    # The place in the low bits settles ties to the left. Its width is fixed: were it that of the block, copies
    # of a string in a short and a long block could be given different anchors and never meet.
    bits = PLACE_BITS
    low = ((hashes >> bits) << bits) | np.arange(len(hashes), dtype=U64)
    width = 1
    while 2 * width <= span:
        low, width = np.minimum(low[: len(low) - width], low[width:]), 2 * width
    rest = span - width
    low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
    anchor = (low[:count] & ((U64(1) << bits) - U64(1))).astype(np.int64)
    start = np.arange(count)
    inside = start + length <= np.repeat(offsets[1:], np.diff(offsets))[:count]
    start, anchor = start[inside], anchor[inside]
    if not len(start):
        return (np.zeros(0, np.int64),) * 3 + (hashes,)
    heads = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1))))
    return anchor[heads], start[heads], start[np.append(heads[1:], len(start)) - 1], hashes


def _anchor_keys(length: int, gram: int):
    def keys_of(block: pa.RecordBatch) -> Keys:
        data, offsets = flat(block.column("text"))
        anchor, _, _, hashes = _anchors(data, offsets, length, gram)
        row = np.searchsorted(offsets, anchor, side="right") - 1
        return Keys(row, anchor - offsets[row], hashes[anchor])

    return keys_of


def _segments(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """(bucket, anchors, content, sizes, docs, starts, known_*): segments of shared anchors, dealt to shards.

    Equal segments of a block are sent once, for the smallest document; the others are covered as a
    whole and their places are handed on.
    """
    parts = buckets(rows) // 2

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in enumerate(blocks(batches)):
            data, offsets = flat(block.column("text"))
            anchor, first, last, hashes = _anchors(data, offsets, length, gram)
            row, place = flat_places(block.column("places"))
            chosen = np.isin(anchor, offsets[row] + place)
            anchor, first, last = anchor[chosen], first[chosen], last[chosen]
            row = np.searchsorted(offsets, anchor, side="right") - 1
            ids, start, size = block.column("doc_id").to_numpy()[row], first - offsets[row], last - first + length
            sums = [Rolling(BYTE_VALUES[data], base).of(first, last + length) for base in BASES[:2]]
            order = np.lexsort((start, ids, size, *sums))
            equal = np.ones(len(order), bool)
            for column in (*sums, size):
                equal[1:] &= column[order][1:] == column[order][:-1]
            heads = np.flatnonzero(~equal | (np.arange(len(order)) == 0))
            owner = np.repeat(ids[order][heads], np.diff(np.append(heads, len(order))))
            known = np.zeros(len(order), bool)
            known[order] = ids[order] != owner
            sent = np.flatnonzero(~known)
            bucket = (hashes[anchor[sent]] % U64(parts)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            sent, per = sent[by], np.bincount(bucket, minlength=parts)
            total = np.cumsum(size[sent])
            shift = np.repeat(first[sent] - (total - size[sent]), size[sent])
            content = data[np.arange(len(shift)) + shift]
            cuts = np.concatenate(([0], total))[np.concatenate(([0], np.cumsum(per)))]
            local = np.zeros(parts, np.int64)
            if len(ids):
                local[int(ids[0] + number) % parts] = known.sum()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(parts)), lists(per, (hashes[anchor[sent]] >> U64(40)).astype(np.int32), pa.int32()),
                    pa.array([content[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    lists(per, size[sent], pa.int32()), lists(per, ids[sent], pa.int64()), lists(per, start[sent], pa.int32()),
                    lists(local, ids[known], pa.int64()), lists(local, start[known], pa.int32()),
                    lists(local, (start + size)[known], pa.int32()),
                ],
                ["bucket", "anchors", "content", "sizes", "docs", "starts", "known_docs", "known_starts", "known_ends"],
            )

    return rows.mapInArrow(
        send,
        "bucket long, anchors array<int>, content binary, sizes array<int>, docs array<long>, starts array<int>,"
        " known_docs array<long>, known_starts array<int>, known_ends array<int>",
    )


def _covered(segments: DataFrame, length: int) -> DataFrame:
    """(doc_id, begins array<int>, ends array<int>): stretches of strings an earlier document holds."""

    def meet(group: pa.Table) -> pa.Table:
        flat_of = lambda c: group.column(c).combine_chunks().flatten().to_numpy()
        sizes, docs, starts = flat_of("sizes").astype(np.int64), flat_of("docs"), flat_of("starts")
        found = [(flat_of("known_docs"), flat_of("known_starts"), flat_of("known_ends"))]
        if len(sizes):
            content = np.frombuffer(b"".join(group.column("content").to_pylist()), np.uint8)
            part = flat_of("anchors") % -(-len(content) // SORTED_BYTES)
            begins = np.cumsum(sizes) - sizes
            for k in range(part.max() + 1):
                own = np.flatnonzero(part == k)
                if len(own):
                    shift = np.repeat(begins[own] - (np.cumsum(sizes[own]) - sizes[own]), sizes[own])
                    data = content[np.arange(len(shift)) + shift]
                    found.append(_later(Segmented(data, sizes[own]), docs[own], starts[own], length))
        docs, begins, ends = (np.concatenate(c) for c in zip(*found))
        return packed(docs, {"begins": begins, "ends": ends}, parts)

    parts = buckets(segments)
    met = segments.groupBy("bucket").applyInArrow(meet, packed_schema("begins", "ends"))
    return gathered(met, "begins", "ends")


def _later(text: Segmented, docs: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(doc, begin, end) of the stretches whose strings a smaller document of the shard holds."""
    order = suffix_array(text)
    agree = common_prefixes(text, order, length)[order]
    heads = np.flatnonzero(~agree)
    of = docs[text.segment[order]]
    owner = np.minimum.reduceat(of, heads)
    later = np.zeros(len(order), bool)
    later[order] = of > np.repeat(owner, np.diff(np.append(heads, len(order))))
    # Runs of strings one after the other are one stretch.
    begins = np.flatnonzero(later & ~np.concatenate(([False], later[:-1])))
    ends = np.flatnonzero(later & ~np.concatenate((later[1:], [False]))) + length
    segment = text.segment[begins]
    shift = starts[segment] - text.begins[segment]
    return docs[segment], begins + shift, ends + shift


def repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, text, begins, ends): every document with the stretches an earlier one holds, or null."""
    rows = documents(docs)
    copies = _copies(rows)
    first = rows.join(copies.select("doc_id"), "doc_id", "left_anti")
    anchors = holders(first, _anchor_keys(length, gram), shared=True)
    covers = _covered(_segments(joined(rows, anchors, "inner"), length, gram), length)
    # An equal text of a smaller document covers a copy from end to end.
    whole = copies.where(F.col("size") >= length).select(
        "doc_id", F.array(F.lit(0)).alias("begins"), F.array("size").alias("ends")
    )
    return joined(rows, covers.unionByName(whole), "left")


def _copies(rows: DataFrame) -> DataFrame:
    """(doc_id, size): documents whose text, by a 128-bit digest, a smaller one has as a whole."""
    digests = rows.select(
        "doc_id", F.octet_length("text").alias("size"),
        F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"),
    )
    first = digests.groupBy("size", "h1", "h2").agg(F.min("doc_id").alias("doc_id"))
    return digests.join(first.select("doc_id"), "doc_id", "left_anti").select("doc_id", "size")


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): documents without repeated bytes.

    A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller
    id; strings are judged on the input, and never cross documents. What is kept is given as bytes, as
    a cut may part a character. Null texts are empty, null ids are left out, repeated ids count once,
    an empty table gives an empty result. A whole text is in one task once.
    """
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            data, offsets = flat(block.column("text"))
            row, begin = flat_places(block.column("begins"))
            _, end = flat_places(block.column("ends"))
            change = np.zeros(len(data) + 1, np.int64)
            np.add.at(change, offsets[row] + begin, 1)
            np.add.at(change, offsets[row] + end, -1)
            gone = np.cumsum(change[:-1]) > 0
            fresh = gone.copy()
            fresh[1:] &= ~gone[:-1]
            edges = offsets[:-1][offsets[:-1] < len(data)]
            fresh[edges] = gone[edges]
            removed, spans = (np.concatenate(([0], np.cumsum(x)))[offsets] for x in (gone, fresh))
            kept = []
            for a, b, n in zip(offsets[:-1], offsets[1:], np.diff(removed)):
                kept.append(data[a:b][~gone[a:b]].tobytes() if n else data[a:b].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"), pa.array(np.diff(offsets)), pa.array(np.diff(removed).astype(np.int64)),
                    pa.array(np.diff(spans).astype(np.int64)),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary()),
                ],
                [part.split()[0] for part in schema.split(", ")],
            )

    return repeated_bytes(docs, length, gram).mapInArrow(run, schema)
