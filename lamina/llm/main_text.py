"""Main text of web pages: a recurrent network labels every leaf block in the context of the whole page.

A page becomes a sequence of leaf blocks (``page_blocks``). Names of the elements on the path, shape of the
block and its words are hashed to vectors; a bidirectional LSTM (``recurrent``) reads the sequence both ways
and tells main blocks from the rest. It is fitted on ``TRAINING_PAGES`` labelled pages (``page_layouts``), a
fixed bound that does not depend on the input. Every block of every page is classified.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lamina.llm.blocks import SPACED, Words, blocks, flat
from lamina.llm.page_blocks import Leaf, Paths, leaves
from lamina.llm.page_layouts import MARK, Layout
from lamina.llm.recurrent import BUCKETS, WIDTH, Example, Weights, bag_sums, scale_of, scores, train

TRAINING_PAGES, EPOCHS, SEED = 1200, 9, 7
PAGE_BYTES = 1 << 20


def bucket(name: str) -> int:
    """The same in every process, unlike Python's own hash."""
    value = 0xCBF29CE484222325
    for byte in name.encode():
        value = ((value ^ byte) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
    return int((value ^ (value >> 29)) & (BUCKETS - 1))


_bucket = lru_cache(maxsize=1 << 16)(bucket)


def shape(leaf: Leaf) -> list[str]:
    """Length, share of link text, and how the block ends."""
    size = len(leaf.text)
    return [f"length {size.bit_length()}", f"links {4 * leaf.linked // size}", f"ends {leaf.text[-1] if leaf.text[-1] in '.!?:,;' else ''}"]


def words_of(found: list[Leaf]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, owners) of all words of the blocks, in lower case."""
    data, offsets = flat(pa.array([leaf.text for leaf in found], pa.string()))
    words = Words(data, offsets, SPACED)
    owners = np.repeat(np.arange(len(found)), words.counts)
    return (words.hashes(lower=True) & np.uint64(BUCKETS - 1)).astype(np.int64), owners


def _shapes(found: list[Leaf]) -> tuple[np.ndarray, np.ndarray]:
    names = [shape(leaf) for leaf in found]
    buckets = np.array([_bucket(n) for group in names for n in group], np.int64)
    return buckets, np.repeat(np.arange(len(found)), [len(group) for group in names])


def example(marked: str) -> Example:
    """A training page whose main blocks begin with the mark."""
    paths = Paths()
    found = leaves(marked, paths)
    labels = np.array([leaf.text.startswith(MARK) for leaf in found], np.float32)
    found = [Leaf(leaf.node, leaf.text.removeprefix(MARK), leaf.linked) for leaf in found]
    chains = [[_bucket(name) for name in paths.chain(leaf.node)] for leaf in found]
    owners = np.repeat(np.arange(len(found)), [len(chain) for chain in chains])
    path = np.array([b for chain in chains for b in chain], np.int64)
    return Example([(path, owners), _shapes(found), words_of(found)], labels)


@lru_cache(maxsize=4)
def fitted(pages: int = TRAINING_PAGES, epochs: int = EPOCHS, seed: int = SEED) -> Weights:
    """The labeller, trained once per process on the driver; a few hundred kilobytes go to the tasks."""
    made = [example(Layout(seed * 1_000_003 + i).html()) for i in range(pages)]
    return train([e for e in made if len(e.labels)], seed, epochs)


def path_vectors(weights: Weights, paths: Paths) -> tuple[np.ndarray, np.ndarray]:
    """(sum of name vectors, number of names) of every path, each from the path one element shorter."""
    names = weights.arrays["names"]
    total, counts = np.zeros((len(paths.parents), WIDTH), np.float32), np.zeros(len(paths.parents), np.int64)
    for node in range(1, len(paths.parents)):
        above, own = paths.parents[node], [_bucket(name) for name in paths.names[node]]
        total[node] = total[above] + names[own].sum(axis=0)
        counts[node] = counts[above] + len(own)
    return total, counts


def label(weights: Weights, pages: list[str]) -> list[list[tuple[str, float]]]:
    """Per page the text of each leaf block and the log-odds that it is main text."""
    paths = Paths()
    sequences = [leaves(page, paths) for page in pages]
    found = [leaf for sequence in sequences for leaf in sequence]
    if not found:
        return [[] for _ in pages]
    totals, counts = path_vectors(weights, paths)
    nodes = np.array([leaf.node for leaf in found])
    parts = [totals[nodes] / scale_of(0, counts[nodes])]
    for bag, (buckets, owners) in enumerate((_shapes(found), words_of(found)), 1):
        sums = bag_sums(weights.arrays["names"], buckets, owners, len(found))
        parts.append(sums / scale_of(bag, np.bincount(owners, minlength=len(found))))
    lengths = np.array([len(sequence) for sequence in sequences])
    odds = iter(scores(weights, np.hstack(parts), lengths).tolist())
    return [[(leaf.text, next(odds)) for leaf in sequence] for sequence in sequences]


def extract(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """(page_id, url, text, n_chars): the main blocks of every page, two line feeds between them.

    Null pages are empty; a page without main blocks has an empty text. Every row gives one row: repeated
    rows and null ids are kept, other columns are ignored, an empty table gives no rows. The whole page is
    read whatever its length; a task holds about a megabyte of pages, or one longer page.
    """
    weights = weights or fitted()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, PAGE_BYTES):
            labelled = label(weights, [html or "" for html in block.column("text").to_pylist()])
            texts = ["\n\n".join(text for text, odds in page if odds > 0) for page in labelled]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("page_id"), block.column("url"),
                    pa.array(texts, pa.string()), pa.array([len(text) for text in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.selectExpr("cast(page_id AS long) AS page_id", "cast(url AS string) AS url", "cast(html AS string) AS text")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
