"""Which documents share a key, and which one holds it first, for very many keys.

A key is the hash of a stretch of text. Keys of a block travel together as arrays, one row per bucket,
instead of one row each. Within a block every key is settled first: only the smallest document's
occurrences are sent, the others are known to have an earlier holder. So a key that a third of all
documents hold costs its bucket one entry per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lamina.llm.blocks import U64, blocks, lists, mixed
from lamina.llm.graph import buckets


class Keys(NamedTuple):
    """Keys of a block: row of the document, place in it, hash, and a second hash or None."""

    row: np.ndarray
    place: np.ndarray
    key: np.ndarray
    check: np.ndarray | None = None


def holders(rows: DataFrame, keys_of: Callable[[pa.RecordBatch], Keys], shared: bool) -> DataFrame:
    """(doc_id, places array<int>): places of keys that other documents hold as well.

    With ``shared`` all of them; without, those that a document with a smaller id holds. Keys are
    compared by 32 bits and their bucket, with the second hash by 96 bits and the bucket: the first serves to
    find candidates, the second to decide.
    """
    parts = buckets(rows)

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in enumerate(blocks(batches)):
            found = keys_of(block)
            ids = block.column("doc_id").to_numpy()[found.row]
            order = np.lexsort((found.place, ids, found.key))
            key, ids = found.key[order], ids[order]
            check = np.zeros(len(key), U64) if found.check is None else found.check[order]
            first, several = _groups((key, check) if found.check is not None else (key,), ids)
            known = several if shared else ids != first
            told = np.sort(order[known])
            # In the order of the text: ids and places then hardly take room in the shuffle.
            mine = np.sort(order[ids == first])
            bucket = (found.key[mine] % U64(parts)).astype(np.int64)
            mine, per = mine[np.argsort(bucket, kind="stable")], np.bincount(bucket, minlength=parts)
            local = np.zeros(parts, np.int64)
            if len(told):
                local[int(told[0] + number + block.column("doc_id")[0].as_py()) % parts] = len(told)
            ids = block.column("doc_id").to_numpy()
            rest = (found.key[mine] >> U64(32)).astype(np.uint32).view(np.int32)
            columns = [
                pa.array(np.arange(parts)), lists(per, rest, pa.int32()), lists(per, ids[found.row[mine]], pa.int64()),
                lists(per, found.place[mine], pa.int32()), lists(local, ids[found.row[told]], pa.int64()),
                lists(local, found.place[told], pa.int32()),
            ]
            names = ["bucket", "keys", "docs", "places", "known_docs", "known_places"]
            if found.check is not None:
                columns.append(lists(per, found.check[mine].view(np.int64), pa.int64()))
                names.append("checks")
            yield pa.RecordBatch.from_arrays(columns, names)

    def meet(group: pa.Table) -> pa.Table:
        flat_of = lambda c: group.column(c).combine_chunks().flatten().to_numpy()
        keys, docs, places = flat_of("keys"), flat_of("docs"), flat_of("places")
        columns = (keys, flat_of("checks")) if "checks" in group.column_names else (keys,)
        order = np.lexsort((docs, *columns[::-1]))
        docs, places = docs[order], places[order]
        first, several = _groups(tuple(c[order] for c in columns), docs)
        told = several if shared else docs != first
        docs = np.concatenate((docs[told], flat_of("known_docs")))
        return packed(docs, {"places": np.concatenate((places[told], flat_of("known_places")))}, parts)

    probe = "bucket long, keys array<int>, docs array<long>, places array<int>, known_docs array<long>, known_places array<int>"
    decided = "" if shared else ", checks array<long>"
    met = rows.mapInArrow(send, probe + decided).groupBy("bucket").applyInArrow(meet, packed_schema("places"))
    return gathered(met, "places")


def packed_schema(*names: str) -> str:
    return ", ".join(["target long, docs array<long>", *(f"{name} array<int>" for name in names)])


def packed(docs: np.ndarray, columns: dict[str, np.ndarray], parts: int) -> pa.Table:
    """Answers for documents, as one row per target part instead of one per document.

    There are a quarter as many targets as buckets, so that the rows between them stay few.
    """
    parts = -(-parts // 4)
    target = (mixed(docs.view(U64)) % U64(parts)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    per = np.bincount(target, minlength=parts)
    some = np.flatnonzero(per)
    held = {"target": pa.array(some, pa.int64()), "docs": lists(per[some], docs[order], pa.int64())}
    return pa.table(held | {name: lists(per[some], c[order], pa.int32()) for name, c in columns.items()})


def gathered(answers: DataFrame, *names: str) -> DataFrame:
    """(doc_id, one array<int> per name): the packed answers of each document, in one row."""

    def gather(group: pa.Table) -> pa.Table:
        flat_of = lambda c: group.column(c).combine_chunks().flatten().to_numpy()
        docs = flat_of("docs")
        order = np.argsort(docs, kind="stable")
        docs = docs[order]
        heads = np.flatnonzero(np.concatenate((np.ones(min(1, len(docs)), bool), docs[1:] != docs[:-1])))
        per = np.diff(np.append(heads, len(docs)))
        return pa.table({"doc_id": docs[heads]} | {n: lists(per, flat_of(n)[order], pa.int32()) for n in names})

    schema = ", ".join(["doc_id long", *(f"{name} array<int>" for name in names)])
    return answers.groupBy("target").applyInArrow(gather, schema)


def _groups(columns: tuple[np.ndarray, ...], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by key: the smallest id of each row's key, and whether the key has several ids.

    Rows are sorted by the first column at least; where a second column tells keys apart, rows of one
    first column are few and are sorted once more by both.
    """
    if not len(ids):
        return ids, np.zeros(0, bool)
    again = np.arange(len(ids))
    if len(columns) > 1:
        again = np.lexsort((ids, columns[1], columns[0]))
    fresh = np.zeros(len(ids), bool)
    fresh[0] = True
    for column in columns:
        sorted_ = column[again]
        fresh[1:] |= sorted_[1:] != sorted_[:-1]
    heads = np.flatnonzero(fresh)
    length = np.diff(np.append(heads, len(ids)))
    low = np.repeat(np.minimum.reduceat(ids[again], heads), length)
    high = np.repeat(np.maximum.reduceat(ids[again], heads), length)
    first, several = np.empty_like(ids), np.empty(len(ids), bool)
    first[again], several[again] = low, low != high
    return first, several


def joined(rows: DataFrame, places: DataFrame, how: str) -> DataFrame:
    """The documents with their places; those without have null. Both sides hold a document once."""
    return rows.join(places, "doc_id", how)


def flat_places(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of a column array<int>; null counts as empty."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), lengths), column.flatten().to_numpy(zero_copy_only=False)
