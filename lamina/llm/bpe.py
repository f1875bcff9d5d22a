"""Byte-level BPE encoding and decoding by replaying the merges over whole blocks of the corpus.

Texts are cut by the tokenizer's pattern. The distinct pieces of a block stand end to end in one
symbol array, with an inverted index from token pair (named by the rank of its merge) to the
places where it occurs. Ranks are taken from a heap, lowest first; a merge is applied at all its
places at once and only the pairs beside them change. The vocabulary is never trained here.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lamina.llm.blocks import blocks

NO_RANK = np.iinfo(np.int32).max
#: Distinct stretches, and token ids of them, that a task remembers before it starts anew; the settings have no
#: influence on results. The second bounds memory where stretches are long.
REMEMBERED, REMEMBERED_IDS = 300_000, 1 << 21
#: Bytes of text whose pieces are replayed together.
REPLAY_BYTES = 1 << 21


class Vocabulary:
    """Ranks of a tiktoken file, and for each pair of tokens the rank of what they merge into."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            entries = [line.split() for line in lines if line.strip()]
        self.rank = {base64.b64decode(token): int(number) for token, number in entries}
        self.token = {number: token for token, number in self.rank.items()}
        self.single = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        self.width = max(self.token) + 1
        pairs = {}
        for whole, number in self.rank.items():
            for cut in range(1, len(whole)):
                left, right = self.rank.get(whole[:cut]), self.rank.get(whole[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = number
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.fromiter(pairs.values(), np.int32, len(pairs))[order]
        left, right = np.divmod(np.arange(1 << 16), 256)
        self.byte_pairs = self.merged(self.single[left], self.single[right])

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NO_RANK where there is none."""
        keys = left.astype(np.int64) * self.width + right
        place = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[place] == keys, self.pair_ranks[place], NO_RANK)

    def one_by_one(self, piece: bytes) -> list[int]:
        """Ids of one piece by the definition: always the lowest rank, leftmost first."""
        parts = [bytes([b]) for b in piece]
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, NO_RANK) for a, b in zip(parts, parts[1:])]
            lowest = min(ranks)
            if lowest == NO_RANK:
                break
            at = ranks.index(lowest)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[part] for part in parts]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def replay(pieces: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids, count): token ids of all pieces end to end, and how many each piece has."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    if not pieces:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    content = np.frombuffer(b"".join(pieces), np.uint8)
    symbol = vocab.single[content]
    size = len(symbol)
    owner = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
    following = np.arange(1, size + 1, dtype=np.int32)
    before = np.arange(-1, size - 1, dtype=np.int32)
    ends = np.cumsum(lengths)
    following[(ends - 1)[lengths > 0]] = -1
    before[(ends - lengths)[lengths > 0]] = -1
    rank = np.full(size, NO_RANK, np.int32)
    linked = np.flatnonzero(following >= 0)
    rank[linked] = vocab.byte_pairs[content[linked].astype(np.int64) * 256 + content[linked + 1]]
    alive = np.ones(size, bool)
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def add(places: np.ndarray) -> None:
        ranks = rank[places]
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        begins = [0, *cuts.tolist(), len(places)]
        for begin, end in zip(begins, begins[1:]):
            number = int(ranks[begin])
            if number not in index:
                index[number] = []
                heapq.heappush(queue, number)
            index[number].append(places[begin:end])

    linked = linked[rank[linked] != NO_RANK]
    if len(linked):
        add(linked)
    disturbed: list[np.ndarray] = []
    while queue:
        number = heapq.heappop(queue)
        listed = index.pop(number)
        places = listed[0] if len(listed) == 1 else np.unique(np.concatenate(listed))
        places = places[alive[places] & (rank[places] == number)]
        if not len(places):
            continue
        right = following[places]
        if len(places) > 1:
            # Runs of one symbol: every second of the overlapping places, from the left.
            overlapping = right[:-1] == places[1:]
            if overlapping.any():
                head = np.flatnonzero(np.concatenate(([True], ~overlapping)))
                run = np.repeat(head, np.diff(np.append(head, len(places))))
                keep = (np.arange(len(places)) - run) % 2 == 0
                places, right = places[keep], right[keep]
        symbol[places] = number
        alive[right] = False
        after = following[right]
        following[places] = after
        inner = after >= 0
        before[after[inner]] = places[inner]
        rank[places] = NO_RANK
        rank[places[inner]] = vocab.merged(symbol[places[inner]], symbol[after[inner]])
        left = before[places]
        led = left >= 0
        rank[left[led]] = vocab.merged(symbol[left[led]], symbol[places[led]])
        touched = np.concatenate((places[inner], left[led]))
        touched = touched[rank[touched] != NO_RANK]
        if len(touched):
            lower = touched[rank[touched] < number]
            if len(lower):
                disturbed.append(owner[lower])
            add(touched)
    ids, held = symbol[alive], np.bincount(owner[alive], minlength=len(pieces))
    if disturbed:
        # A merge made a pair of a lower rank. Where the merge stood more than once in the piece,
        # the order within the piece could matter, so those pieces are settled one by one.
        ids, held = _settled(np.unique(np.concatenate(disturbed)), pieces, ids, held, vocab)
    return ids, held


def _settled(which, pieces, ids, held, vocab):
    parts = np.split(ids, np.cumsum(held)[:-1])
    for k in which.tolist():
        parts[k] = np.array(vocab.one_by_one(pieces[k]), np.int32)
    return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))


class Encoder:
    """Encodes texts block by block; stretches met before in the task are looked up.

    A single space between two characters that are no white space always begins a new piece, so
    texts are first cut there and the pattern only runs over the distinct stretches of a block.
    Stretches are named by what follows the space; where a space has white space beside it, no cut
    is made.
    """

    def __init__(self, path: str, pattern: str):
        self.vocab = vocabulary(path)
        self.pattern = regex.compile(pattern)
        self.forget()

    def forget(self) -> None:
        #: Code of each stretch after a space, and of each stretch without one before it.
        self.spaced: dict[str, int] = _numbering()
        self.bare: dict[str, int] = _numbering()
        self.known = [0, 0]
        self.ids, self.held = np.zeros(0, np.int32), [np.zeros(0, np.int64)] * 2
        self.begins = [np.zeros(0, np.int64)] * 2
        self.opens, self.closes = np.zeros(0, bool), np.zeros(0, bool)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.spaced) + len(self.bare) > REMEMBERED or len(self.ids) > REMEMBERED_IDS:
            self.forget()
        # Only one text at a time is held in parts, which take ten times its room; of the others, codes.
        coded = []
        for text in texts:
            parts = text.split(" ")
            coded.append(np.fromiter(map(self.spaced.__getitem__, islice(parts, 1, None)), np.int32, len(parts) - 1))
        new = list(self.spaced)[len(self.opens) :]
        self.opens = np.concatenate((self.opens, [bool(p) and not p[0].isspace() for p in new])).astype(bool)
        self.closes = np.concatenate((self.closes, [bool(p) and not p[-1].isspace() for p in new])).astype(bool)
        heads = []
        for text, codes in zip(texts, coded, strict=True):
            first = text[: text.find(" ")] if len(codes) else text
            fine = self.opens[codes]
            fine[1:] &= self.closes[codes[:-1]]
            if len(fine):
                fine[0] &= not first[-1:].isspace()
            if fine.all():
                heads.append((self.bare[first], None))
            else:
                heads.append(self._glued(text.split(" "), codes, fine))
        self._learn()
        return [
            self._gather(codes, head, names) for codes, (head, names) in zip(coded, heads, strict=True)
        ]

    def _glued(self, parts: list[str], codes: np.ndarray, fine: np.ndarray) -> tuple[int, np.ndarray]:
        """Names of the stretches of a text where some spaces do not cut; bare ones are negative."""
        edges = [0, *(np.flatnonzero(fine) + 1).tolist(), len(parts)]
        names = []
        for begin, end in zip(edges, edges[1:]):
            if begin and end == begin + 1:
                names.append(int(codes[begin - 1]))
            else:
                whole = " ".join(parts[begin:end])
                names.append(-1 - self.bare[" " + whole if begin else whole])
        return -1, np.array(names, np.int64)

    def _learn(self) -> None:
        for side, (table, lead) in enumerate(((self.spaced, " "), (self.bare, ""))):
            fresh = list(table)[self.known[side] :]
            if not fresh:
                continue
            pieces = [self.pattern.findall(lead + stretch) for stretch in fresh]
            counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
            # Each distinct piece once; then the pieces of each stretch end to end.
            table_of = _numbering()
            which = np.fromiter(map(table_of.__getitem__, chain.from_iterable(pieces)), np.int64)
            ids, held = replay([piece.encode() for piece in table_of], self.vocab)
            begins, held = (np.cumsum(held) - held)[which], held[which]
            ids = ids[_ranges(begins, held)]
            total = np.concatenate(([0], np.cumsum(held)))
            ends = total[np.cumsum(counts)]
            begins = total[np.cumsum(counts) - counts]
            self.begins[side] = np.concatenate((self.begins[side], begins + len(self.ids)))
            self.held[side] = np.concatenate((self.held[side], ends - begins))
            self.ids = np.concatenate((self.ids, ids))
            self.known[side] = len(table)

    def _gather(self, codes: np.ndarray, head: int, names: np.ndarray | None) -> np.ndarray:
        if names is None:
            held = np.concatenate((self.held[1][head : head + 1], self.held[0][codes]))
            begins = np.concatenate((self.begins[1][head : head + 1], self.begins[0][codes]))
        else:
            bare, code = names < 0, np.where(names < 0, -1 - names, names)
            held, begins = np.empty(len(names), np.int64), np.empty(len(names), np.int64)
            for side, chosen in ((0, ~bare), (1, bare)):
                held[chosen] = self.held[side][code[chosen]]
                begins[chosen] = self.begins[side][code[chosen]]
        return self.ids[_ranges(begins, held)]


def _ranges(begins: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of runs of the given lengths, end to end."""
    shift = np.repeat(begins - (np.cumsum(held) - held), held)
    return np.arange(len(shift)) + shift


def _numbering() -> defaultdict:
    """A dictionary that numbers new keys in the order in which they are asked for."""
    table = defaultdict()
    table.default_factory = table.__len__
    return table


def decode(ids: np.ndarray, vocab: Vocabulary) -> bytes:
    return b"".join(map(vocab.token.__getitem__, ids.tolist()))


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>): token ids of every whole text, row by row, no shuffle.

    Null and empty texts have no ids; null doc_ids and repeated rows are kept as they are.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for block in blocks(batches, REPLAY_BYTES):
            ids = encoder.encode([text or "" for text in block.column("text").to_pylist()])
            column = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), column], ["doc_id", "ids"])

    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "cast(text AS string) AS text").mapInArrow(
        run, "doc_id long, ids array<int>"
    )


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, content binary): the bytes that the ids stand for."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                contents = [decode(np.array(i or [], np.int32), vocab) for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(contents, pa.binary())], ["doc_id", "content"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, content binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, decode again, digest both.

    One pass; ids and bytes of a block never leave the task. Null and empty texts: no tokens and
    the digests of nothing. Null doc_ids and repeated rows give one result row each.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for block in blocks(batches, REPLAY_BYTES):
            encoded = encoder.encode([text or "" for text in block.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.array([len(ids) for ids in encoded], pa.int64()),
                    pa.array([hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest() for ids in encoded]),
                    pa.array([hashlib.sha256(decode(ids, encoder.vocab)).hexdigest() for ids in encoded]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "cast(text AS string) AS text").mapInArrow(
        run, schema
    )
