"""Joining rolling word hashes of all documents with a small table of known hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.blocks import ALPHANUMERIC, Rolling, Words, blocks, flat, lists

#: Rows of a table of hashes that may be broadcast (24 bytes each, so 48 MB); larger ones are shuffled.
MOST_BROADCAST = 2_000_000


def gram_hashes(batches: Iterable[pa.RecordBatch], sizes: tuple[int, ...]) -> Iterator[tuple[pa.RecordBatch, Words, list[pa.Array]]]:
    """Each block with its words and, for every size, a list column of the hashes of all k-grams.

    The i-th hash of a document is that of the k-gram starting at its word i. Words are runs of
    letters and digits with A-Z in lower case; grams never cross documents.
    """
    for block in blocks(batches):
        words = Words(*flat(block.column("text")), ALPHANUMERIC)
        rolling = Rolling(words.hashes(lower=True))
        columns = []
        for size in sizes:
            inside = words.windows_inside(size)
            # Without windows at the end of a document, those of a document are still in order.
            hashes = rolling.windows(size)[inside].view(np.int64)
            columns.append(lists(np.maximum(words.counts - size + 1, 0), hashes, pa.int64()))
        yield block, words, columns


def grams(docs: DataFrame, key: str, size: int) -> DataFrame:
    """(key, position, gram): one row per k-gram of every whole text; null texts have none."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, (hashes,) in gram_hashes(batches, (size,)):
            yield pa.RecordBatch.from_arrays([block.column(key), hashes], [key, "grams"])

    hashed = docs.selectExpr(f"cast({key} AS long) AS {key}", "cast(text AS string) AS text").mapInArrow(
        run, f"{key} long, grams array<long>"
    )
    return hashed.select(key, F.posexplode("grams").alias("position", "gram"))


def with_known(rows: DataFrame, known: DataFrame, column: str = "gram", how: str = "inner") -> DataFrame:
    """Join with a table of hashes or ids; that side is broadcast only if a count finds it small."""
    few = known.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    return rows.join(F.broadcast(known) if few else known, column, how)
