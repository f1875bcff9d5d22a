"""Benchmark decontamination by greedy string tiling.

Word k-grams of all documents are joined with those of the benchmark items (seeds). A document and an
item with enough shared seeds are tiled: again and again the longest match between unmarked words
is marked, until none of at least k words is left. The share of the item's words under tiles decides, so
passages whose parts were put in another order are caught as well.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.blocks import documents, free_name
from lamina.llm.joins import grams, with_known

#: Shortest tile in words, and the share of an item's words that must be tiled.
TILE_WORDS, LEAST_COVERAGE = 5, 0.5


def tiles(doc_places: np.ndarray, item_places: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from seeds: (place in document, place in item, words) of each tile.

    A seed says that ``size`` words from either place agree, so consecutive seeds on one diagonal are
    a longer match; every match of at least ``size`` words is such a run. Longest first, ties by
    place in the item, then in the document.
    """
    diagonal = doc_places - item_places
    order = np.lexsort((item_places, diagonal))
    diagonal, item = diagonal[order], item_places[order]
    fresh = np.concatenate(([True], (np.diff(diagonal) != 0) | (np.diff(item) != 1)))
    heads = np.flatnonzero(fresh)
    lengths = np.diff(np.append(heads, len(item))) + size - 1
    runs = [(int(n), int(item[h]), int(diagonal[h])) for n, h in zip(lengths, heads)]
    in_item, in_doc, found = set(), set(), []
    waiting = {}
    for n, at, shift in runs:
        waiting.setdefault(n, []).append((at, shift))
    while waiting:
        longest = max(waiting)
        again = []
        for at, shift in sorted(waiting.pop(longest), key=lambda r: (r[0], r[0] + r[1])):
            free = [k for k in range(at, at + longest) if k not in in_item and k + shift not in in_doc]
            if len(free) == longest:
                found.append((at + shift, at, longest))
                in_item.update(free)
                in_doc.update(k + shift for k in free)
            else:
                again += _stretches(free, shift, size)
        for n, at, shift in again:
            waiting.setdefault(n, []).append((at, shift))
    return found


def _stretches(free: list[int], shift: int, size: int) -> Iterator[tuple[int, int, int]]:
    """What is left of a run after marking, in stretches of at least ``size`` words."""
    begin = 0
    for k in range(1, len(free) + 1):
        if k == len(free) or free[k] != free[k - 1] + 1:
            if k - begin >= size:
                yield k - begin, free[begin], shift
            begin = k


def contaminated(
    docs: DataFrame, items: DataFrame, size: int = TILE_WORDS, coverage: float = LEAST_COVERAGE
) -> DataFrame:
    """(doc_id, item_id, n_tiles, longest, matched_words, item_words, coverage) above the threshold.

    Words are runs of letters and digits with A-Z in lower case. Seeds are joined by hash; the
    benchmark side is broadcast only after a count. Seeds of one document and item are gathered before
    tiling: at most the document's words times the item's repeats of them. Items shorter than
    ``size`` words are compared by their whole sequence. Null or empty texts match nothing, null ids
    are left out, repeated ids count once, an empty table on either side gives no rows.
    """
    named = documents(items.select(F.col("item_id").alias("doc_id"), "text")).withColumnRenamed("doc_id", "item_id")
    return _search(documents(docs), named, size, coverage)


def _search(rows: DataFrame, named: DataFrame, size: int, coverage: float) -> DataFrame:
    """Tiled pairs of (doc_id, text) and (item_id, text); rows with equal ids must have equal texts."""
    # Seeds of short items are as long as the items, so every item has at least one seed.
    lengths = grams(named, "item_id", 1).groupBy("item_id").agg(F.count(F.lit(1)).cast("int").alias("item_words"))
    found = _tiled(rows, named.join(lengths.where(F.col("item_words") >= size), "item_id"), size, coverage)
    for short in range(1, size):
        some = named.join(lengths.where(F.col("item_words") == short), "item_id")
        if some.limit(1).count():
            found = found.unionByName(_tiled(rows, some, short, coverage))
    return found


def _tiled(rows: DataFrame, items: DataFrame, size: int, coverage: float) -> DataFrame:
    known = grams(items, "item_id", size).withColumnRenamed("position", "item_place")
    known = known.join(items.select("item_id", "item_words"), "item_id")
    seeds = with_known(grams(rows, "doc_id", size), known)
    # Copies under one id give equal seeds, which are combined before the shuffle.
    seeds = seeds.select("doc_id", "item_id", "item_words", "position", "item_place").distinct()
    gathered = seeds.groupBy("doc_id", "item_id").agg(
        F.first("item_words").alias("item_words"),
        F.collect_list("position").alias("doc_places"),
        F.collect_list("item_place").alias("item_places"),
    )
    # Bound: m different seeds of an item cover at most m * size of its words.
    possible = F.size(F.array_distinct("item_places")) * size >= coverage * F.col("item_words")
    schema = "doc_id long, item_id long, n_tiles int, longest int, matched_words int, item_words int, coverage double"
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                marked = tiles(np.array(row["doc_places"]), np.array(row["item_places"]), size)
                words = sum(n for _, _, n in marked)
                share = words / row["item_words"]
                if share >= coverage:
                    out.append((row["doc_id"], row["item_id"], len(marked), max(n for *_, n in marked), words, row["item_words"], share))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
            columns = zip(*out) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return gathered.where(possible).mapInArrow(run, schema)


def clean_rows(docs: DataFrame, items: DataFrame, size: int = TILE_WORDS, coverage: float = LEAST_COVERAGE) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns.

    Every row is searched for every item text: rows and items go by a 64-bit hash of their text, as seeds do,
    so null and repeated ids, on either side and with whatever texts, hide nothing. Null texts are empty.
    """
    digest = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    named = items.select(digest.alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    rows = docs.select(digest.alias("doc_id"), F.col("text").cast("string").alias("text"))
    leaking = free_name(docs, "leaking")
    found = _search(rows, named, size, coverage).select(F.col("doc_id").alias(leaking)).distinct()
    return docs.join(found, digest == F.col(leaking), "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
