"""Removal of word sequences that an earlier document holds, found by difference-cover anchors.

A document is hashed only at word places that lie in a difference cover modulo a period: whatever the
offset between two documents, any common window of WINDOW words holds a place that is in the cover
in both, so the shorter window anchored there has the same hash in both. Only around shared anchors are
full windows worked out, and each is given to the smallest document that holds it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lamina.llm.blocks import BASES, SPACED, Rolling, Words, blocks, documents, flat
from lamina.llm.owners import Keys, flat_places, holders, joined

WINDOW = 50
#: Differences of these give every residue modulo the period (a perfect difference set).
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)


def _anchors(window: int):
    """Hashes of the anchored windows at cover places of each document."""
    length = window - PERIOD + 1

    def keys_of(block: pa.RecordBatch) -> Keys:
        words = Words(*flat(block.column("text")), SPACED)
        place = np.arange(len(words)) - np.repeat(words.first[:-1], words.counts)
        row = np.repeat(np.arange(len(words.counts)), words.counts)
        covered = np.zeros(PERIOD, bool)
        covered[list(COVER)] = True
        inside = words.windows_inside(length)
        chosen = np.flatnonzero(inside & covered[place[: len(inside)] % PERIOD])
        return Keys(row[chosen], place[chosen], Rolling(words.hashes()).of(chosen, chosen + length))

    return keys_of


def _windows(window: int):
    """Two hashes of each full window that holds a shared anchor."""
    reach = PERIOD - 1

    def keys_of(block: pa.RecordBatch) -> Keys:
        words = Words(*flat(block.column("text")), SPACED)
        row, anchor = flat_places(block.column("places"))
        low = words.first[row] + np.maximum(anchor - reach, 0)
        near = _covering(len(words), low, words.first[row] + anchor + 1)
        inside = words.windows_inside(window)
        chosen = np.flatnonzero(inside & near[: len(inside)])
        of = np.repeat(np.arange(len(words.counts)), words.counts)
        sides = [Rolling(words.hashes(base=base), base).of(chosen, chosen + window) for base in BASES[1:]]
        return Keys(of[chosen], chosen - words.first[of[chosen]], *sides)

    return keys_of


def _covering(size: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in one of the stretches."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, np.minimum(ends, size), -1)
    return np.cumsum(change[:-1]) > 0


def repeated_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text, places): every document with the starts of windows an earlier one holds.

    ``places`` is null without any. ``window`` must be at least PERIOD words.
    """
    rows = documents(docs)
    anchors = holders(rows, _anchors(window), shared=True)
    starts = holders(joined(rows, anchors, "inner"), _windows(window), shared=False)
    return joined(rows, starts, "left")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept): documents without words an earlier one holds.

    A word goes if a window of ``window`` words that covers it also starts in a document with a smaller
    id; windows are judged on the input. Words are parted by ASCII white space and compared as they
    are; kept words are joined by one space. Null texts have no words, null ids are left out, repeated
    ids count once, an empty table gives an empty result. A whole text is in one task once.
    """
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            row, start = flat_places(block.column("places"))
            edges = np.searchsorted(row, np.arange(block.num_rows + 1))
            out = []
            for k, (doc_id, text) in enumerate(zip(block.column("doc_id").to_pylist(), block.column("text").to_pylist())):
                words, removed = text.encode().split(), 0
                if edges[k] < edges[k + 1]:
                    begins = start[edges[k] : edges[k + 1]].astype(np.int64)
                    gone = _covering(len(words), begins, begins + window)
                    removed = int(gone.sum())
                    kept = b" ".join(compress(words, ~gone))
                else:
                    kept = b" ".join(words)
                out.append((doc_id, len(words), removed, hashlib.sha256(kept).hexdigest(), kept.decode()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], [f.split()[0] for f in schema.split(", ")])

    return repeated_words(docs, window).mapInArrow(run, schema)
