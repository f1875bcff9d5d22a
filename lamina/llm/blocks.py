"""Whole texts as NumPy arrays, one bounded block of rows at a time.

Spark hands a task its rows in Arrow batches of up to 10,000 rows. The operators work on slices of
those batches, so a task holds arrays for one block only. A text longer than a block is a block of
its own: memory follows the longest text, never the partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 21
U64 = np.uint64


def documents(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string): one row per document, the form joins by document need.

    Null texts are empty. Rows without doc_id are no documents and are left out. If ids repeat, the
    smallest text stands for the id; that costs a shuffle of the texts, so one narrow job looks
    first whether any id repeats. Other columns are ignored.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where(F.col("doc_id").isNotNull())
    repeated = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.limit(1).count() == 0:
        return rows
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores in front as it takes to be none of the columns'."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def blocks(batches: Iterable[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices with at most ``limit`` bytes of column ``text``."""
    for batch in batches:
        ends = np.cumsum(sizes(batch.column("text")))
        begin = 0
        while begin < batch.num_rows:
            used = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, used + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def sizes(texts: pa.Array) -> np.ndarray:
    """Bytes of each text; null counts as empty."""
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): all texts end to end in UTF-8; text i is bytes[offsets[i]:offsets[i+1]]."""
    column = pc.fill_null(texts, "").cast(pa.large_string())
    _, places, content = column.buffers()
    if not len(column) or content is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(content, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (the finaliser of SplitMix64)."""
    values = (values ^ (values >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> U64(27))) * U64(0x94D049BB133111EB)
    return values ^ (values >> U64(31))


#: Odd multipliers of the rolling hashes, and one random value for each byte.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
BYTE_VALUES = mixed(np.arange(1, 257, dtype=U64) * U64(0xA24BAED4963EE407))


#: Exponents are split into a fine and a coarse part, so that powers come from two short tables and none is kept
#: that is as long as a block: Python workers outlive their tasks, with whatever they hold.
FINE_BITS = 11
FINE = 1 << FINE_BITS


@lru_cache(maxsize=64)
def _powers(base: int, length: int) -> np.ndarray:
    """Powers of the base modulo 2**64."""
    steps = np.full(length, base, U64)
    steps[0] = 1
    return np.cumprod(steps, dtype=U64)


def powers(base: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(fine, coarse): fine[k % FINE] * coarse[k // FINE] is the power k, for k below the length asked for."""
    count = max(1, -(-length // FINE))
    return _powers(base, FINE), _powers(pow(base, FINE, 1 << 64), 1 << (count - 1).bit_length())[:count]


class Rolling:
    """Karp-Rabin hashes of any stretch of a sequence of 64-bit values, by prefix sums."""

    def __init__(self, values: np.ndarray, base: int = BASES[0]):
        size = len(values)
        fine, coarse = powers(base, size + 1)
        self.fine, self.coarse = powers(pow(base, -1, 1 << 64), size + 1)
        self.sums = np.zeros(size + 1, U64)
        terms, whole = self.sums[1:], size // FINE
        rows = terms[: whole * FINE].reshape(whole, FINE)
        np.multiply(values[: whole * FINE].reshape(whole, FINE), fine, out=rows)
        rows *= coarse[:whole, None]
        terms[whole * FINE :] = values[whole * FINE :] * fine[: size - whole * FINE] * coarse[whole : whole + 1]
        np.cumsum(terms, dtype=U64, out=terms)

    def of(self, starts: np.ndarray, ends: np.ndarray | int) -> np.ndarray:
        """Hashes of values[start:end]; equal stretches have equal hashes wherever they stand."""
        downs = self.fine[starts & (FINE - 1)] * self.coarse[starts >> FINE_BITS]
        return mixed((self.sums[ends] - self.sums[starts]) * downs)

    def windows(self, length: int) -> np.ndarray:
        """Hashes of all windows of ``length`` values."""
        count = len(self.sums) - length
        if count <= 0:
            return np.zeros(0, U64)
        sums = self.sums[length:] - self.sums[:count]
        whole = count // FINE
        rows = sums[: whole * FINE].reshape(whole, FINE)
        rows *= self.fine
        rows *= self.coarse[:whole, None]
        sums[whole * FINE :] *= self.fine[: count - whole * FINE] * self.coarse[whole : whole + 1]
        return mixed(sums)


class Words:
    """Words of a block: byte places, word ranges of the documents, 64-bit hashes.

    ``letters`` tells for each byte whether it belongs to words. Document i has the words
    first[i]:first[i+1]. A word never crosses documents.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, letters: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = letters[data]
        fresh = inside.copy()
        fresh[1:] &= ~inside[:-1]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        fresh[edges] = inside[edges]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[edges - 1] = inside[edges - 1]
        self.starts = np.flatnonzero(fresh)
        self.ends = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False, base: int = BASES[0]) -> np.ndarray:
        values = BYTE_VALUES[LOWER] if lower else BYTE_VALUES
        return Rolling(values[self.data], base).of(self.starts, self.ends)

    def windows_inside(self, length: int) -> np.ndarray:
        """Which windows of ``length`` words, by first word, lie within one document."""
        count = len(self) - length + 1
        if count <= 0:
            return np.zeros(0, bool)
        doc = np.repeat(np.arange(len(self.counts)), self.counts)
        return doc[:count] == doc[length - 1 :]


#: Bytes with A-Z in lower case.
LOWER = np.arange(256)
LOWER[65:91] += 32
#: Bytes of words that ASCII white space separates: [^\x20\x09-\x0D].
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words of letters and digits, after lower-casing: [^\x00-\x2F\x3A-\x60\x7B-\x7F].
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x41:0x5B] = ALPHANUMERIC[0x61:0x7B] = True
ALPHANUMERIC[0x80:] = True


def lists(counts: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Consecutive runs of ``values`` as an Arrow list column."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
