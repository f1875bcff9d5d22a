"""Fill-in-the-middle: cut a text at two random token bounds and write it as prefix, suffix and middle.

A text is cut into blocks of a fixed number of bytes. A Fenwick tree over the blocks holds how many tokens
end in them and how many code points begin in them. A binary-lifting descent finds the block in which a
wanted token ends; only that block is searched for the bound. The draws come from a digest of seed and
doc_id, so every run, partitioning and retry makes the same cuts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.blocks import SPACED, blocks, flat

PIECE_BYTES = 1 << 10
# The marks, the seed of the draws, shares in percent of cut texts and of the suffix-first form.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, CUT_SHARE, SUFFIX_FIRST_SHARE = 42, 50, 80
PLAIN, PSM, SPM = "plain", "psm", "spm"


class Fenwick:
    """Prefix sums of several counts per block, with a descent to the block that reaches a count."""

    def __init__(self, counts: np.ndarray):
        """counts[i] holds the counts of block i, one column each."""
        size = len(counts)
        self.tree = np.zeros((size + 1, counts.shape[1]), np.int64)
        # Node i covers the blocks (i - lowbit(i), i]: a difference of running sums.
        sums = np.concatenate((self.tree[:1], np.cumsum(counts, axis=0)))
        nodes = np.arange(1, size + 1)
        self.tree[1:] = sums[nodes] - sums[nodes - (nodes & -nodes)]
        self.total = sums[-1]
        self.leap = 1 << size.bit_length() >> 1

    def descend(self, wanted: int, column: int = 0) -> tuple[int, np.ndarray]:
        """(block, counts before it): the first block with which the column's sum reaches ``wanted``, at least 1."""
        at, before, leap = 0, np.zeros(self.tree.shape[1], np.int64), self.leap
        while leap:
            after = at + leap
            if after < len(self.tree) and before[column] + self.tree[after, column] < wanted:
                at, before = after, before + self.tree[after]
            leap >>= 1
        return at, before


class Units:
    """Tokens of one text: white space with the word after it, or what white space ends the text.

    ``data`` is the text in UTF-8. A token ends after the last byte of a word, or at the end of the text.
    """

    def __init__(self, data: np.ndarray, piece: int = PIECE_BYTES):
        self.data, self.piece = data, piece
        letters = SPACED[data]
        self.ends = letters.copy()
        self.ends[:-1] &= ~letters[1:]
        if len(data):
            self.ends[-1] = True
        # Continuation bytes are 10xxxxxx; every other byte begins a code point.
        self.points = (data & 0xC0) != 0x80
        begins = np.arange(0, len(data), piece)
        counts = [np.add.reduceat(flags, begins, dtype=np.int64) for flags in (self.ends, self.points)] if len(data) else [[], []]
        self.tree = Fenwick(np.array(counts, np.int64).reshape(2, -1).T)

    def __len__(self) -> int:
        return int(self.tree.total[0])

    def bound(self, units: int) -> tuple[int, int]:
        """(byte, code point) after the first ``units`` tokens."""
        if units == 0:
            return 0, 0
        block, (ended, points) = self.tree.descend(units)
        begin = block * self.piece
        inside = self.ends[begin : begin + self.piece]
        stop = begin + int(np.flatnonzero(inside)[units - ended - 1]) + 1
        return stop, int(points) + int(np.count_nonzero(self.points[begin:stop]))


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 from the digest of seed and id; without id the digest has none."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def rearranged(data: np.ndarray, doc_id: int | None, seed: int, cut_share: int, suffix_first_share: int):
    """(n, form, prefix_chars, middle_chars, output bytes) of one text in UTF-8."""
    units, whole = Units(data), data.tobytes()
    n, (one, two, cut, first) = len(units), draws(doc_id, seed)
    marks = [mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE)]
    if not n or cut % 100 >= cut_share or any(mark in whole for mark in marks):
        return n, PLAIN, None, None, whole
    lower, upper = sorted((one % (n + 1), two % (n + 1)))
    (begin, before), (end, until) = units.bound(lower), units.bound(upper)
    prefix, middle, suffix = whole[:begin], whole[begin:end], whole[end:]
    if first % 100 < suffix_first_share:
        form, output = SPM, b"".join((marks[1], suffix, marks[0], prefix, marks[2], middle))
    else:
        form, output = PSM, b"".join((marks[0], prefix, marks[1], suffix, marks[2], middle))
    return n, form, before, until - before, output


def fill_middle(
    docs: DataFrame, seed: int = SEED, cut_share: int = CUT_SHARE, suffix_first_share: int = SUFFIX_FIRST_SHARE
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): every text in its training form.

    A text is plain if it is empty, holds one of the marks, or is not drawn. Null texts are empty. Every row
    gives one row: repeated rows and ids are kept, rows without doc_id draw from the seed alone. Other
    columns are ignored; an empty table gives no rows. No shuffle; a task holds one block of rows, and a
    longer text is a block of its own.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for block in blocks(batches):
            data, places = flat(block.column("text"))
            ids = block.column("doc_id").to_pylist()
            rows = [
                (doc_id, *rearranged(data[places[i] : places[i + 1]], doc_id, seed, cut_share, suffix_first_share))
                for i, doc_id in enumerate(ids)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "cast(text AS string) AS text").mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(form: Column, output: Column) -> Column:
    """The text an output was made from. Each mark stands once in it: a cut text holds none itself."""

    def between(left: str, right: str | None) -> Column:
        rest = F.substring_index(output, left, -1)
        return rest if right is None else F.substring_index(rest, right, 1)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)."""
    cut = fill_middle(docs)
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )


ORACLE = r"""
WITH parts AS (
  SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), drawn AS (
  SELECT doc_id, body, units, len(units) AS n,
         CAST('0x' || digest[1:8] AS BIGINT) % (len(units) + 1) AS one,
         CAST('0x' || digest[9:16] AS BIGINT) % (len(units) + 1) AS two,
         CAST('0x' || digest[17:24] AS BIGINT) % 100 AS cut, CAST('0x' || digest[25:32] AS BIGINT) % 100 AS first
  FROM parts
), placed AS (
  SELECT doc_id, body, n,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR cut >= 50
              THEN 'plain' WHEN first < 80 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(units[1:least(one, two)], '') AS prefix,
         array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
         array_to_string(units[greatest(one, two) + 1:n], '') AS suffix
  FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN body ELSE prefix || middle || suffix END) AS restored_sha256
FROM placed
"""
