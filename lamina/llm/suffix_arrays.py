"""Suffix arrays of segmented texts by induced sorting, with NumPy.

Suffixes are classified as smaller (S) or larger (L) than their successor. Leftmost S suffixes (LMS) are
sorted through their substrings, which are named and sorted in turn by doubling; from their order
the whole array is induced, bucket of first symbols by bucket, in one pass up and one pass down. A
pass handles all suffixes of a bucket at once instead of one by one.

A text is a row of segments, each followed by a separator. Separators differ from each other and are
smaller than every byte, so no common prefix runs across one; the last separator is the smallest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

NONE = np.zeros(0, np.int64)


class Segmented:
    """Segments with separators: bytes, symbols, and for each place the bytes left in its segment."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray):
        count, size = len(lengths), len(data) + len(lengths)
        self.begins = np.cumsum(lengths + 1) - (lengths + 1)
        stops = self.begins + lengths
        of_byte = np.ones(size, bool)
        of_byte[stops] = False
        self.data = np.zeros(size, np.uint8)
        self.data[of_byte] = data
        self.symbols = self.data.astype(np.int64) + count
        self.symbols[stops] = np.arange(count - 1, -1, -1)
        #: Bucket of first symbols: one for the separators, one per byte value. Numbers of 16 bits are sorted by radix.
        self.bucket = np.where(of_byte, self.data.astype(np.uint16) + 1, 0).astype(np.uint16)
        self.segment = np.repeat(np.arange(count), lengths + 1)
        self.left = stops[self.segment] - np.arange(size)


def classified(symbols: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type S; the last symbol is smaller than all others."""
    change = np.flatnonzero(symbols[1:] != symbols[:-1])
    # Suffixes of a run of equal symbols take the type of its last one.
    runs = np.diff(np.concatenate(([0], change + 1, [len(symbols)])))
    rising = np.ones(len(runs), bool)
    rising[:-1] = symbols[change] < symbols[change + 1]
    return np.repeat(rising, runs)


def _refined(rank: np.ndarray, active: np.ndarray, value: np.ndarray, limit: int) -> np.ndarray:
    """Splits ties of the active items by ``value``, below ``limit``; a rank is the place of a tie's first item.

    Changes ``rank`` and returns the items that are still tied. The span of ranks times the limit must fit 63 bits.
    """
    key = (rank[active] - rank[active].min()) * limit + value
    order = np.argsort(key)
    items, key = active[order], key[order]
    old = rank[items]
    part = np.concatenate(([True], key[1:] != key[:-1]))
    tie_heads = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1])))
    heads = np.flatnonzero(part)
    size = np.diff(np.append(heads, len(items)))
    first = tie_heads[np.searchsorted(tie_heads, heads, side="right") - 1]
    rank[items] = np.repeat(old[heads] + heads - first, size)
    return items[np.repeat(size > 1, size)]


#: Bits of a bucket, or of the value beyond all buckets.
BUCKET_BITS = 9


def lms_order(bucket: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The LMS suffixes in ascending order: by their substrings, then by doubling over the names.

    Separators are the smallest suffixes, later ones first, and come only at the ends of substrings; there
    they count as equal, and the doubling tells them apart by their ranks.
    """
    count, size = len(lms), len(bucket)
    length = np.append(np.diff(lms) + 1, 1)
    beyond = (1 << BUCKET_BITS) - 1
    separator = bucket[lms] == 0
    rank = np.full(count, separator.sum())
    rank[separator] = np.arange(separator.sum())[::-1]
    active, step = np.flatnonzero(~separator), 0
    while len(active):
        # At first there is one rank only, so all bits are left to symbols.
        packed = (62 - int(np.ptp(rank[active])).bit_length()) // BUCKET_BITS
        value = np.zeros(len(active), np.int64)
        place, left = lms[active], length[active]
        for k in range(step, step + packed):
            # A substring that ends here is larger than one that goes on: L comes before S.
            symbol = bucket[np.minimum(place + k, size - 1)]
            value = (value << BUCKET_BITS) | np.where(k < left, symbol, beyond)
        active, step = _refined(rank, active, value, 1 << (BUCKET_BITS * packed)), step + packed
        # One step more than the substring is long, so that its end has been compared.
        active = active[step <= length[active]]
    ties = np.bincount(rank, minlength=count)[rank] > 1
    active, reach = np.flatnonzero(ties), 1
    while len(active):
        ahead = np.where(active + reach < count, rank[np.minimum(active + reach, count - 1)] + 1, 0)
        active, reach = _refined(rank, active, ahead, count + 1), 2 * reach
    order = np.empty(count, np.int64)
    order[rank] = lms
    return order


def _dealt(places: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The places by bucket, each bucket in the order given."""
    if len(places):
        of = bucket[places]
        by = np.argsort(of, kind="stable")
        of, places = of[by], places[by]
        cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(places)]
        for begin, end in zip(cuts, cuts[1:]):
            yield int(of[begin]), places[begin:end]


def induced(bucket: np.ndarray, smaller: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All suffixes in ascending order, from the sorted LMS suffixes ``ends``."""
    width = 257
    seeds = [NONE] * width
    for k, part in _dealt(ends, bucket):
        seeds[k] = part

    def swept(k: int, waiting: list[list[np.ndarray]], wanted: bool) -> np.ndarray:
        """Settles one bucket and hands its predecessors of the wanted type to theirs."""
        settled, frontier = [], np.concatenate(waiting[k]) if waiting[k] else NONE
        while len(frontier):
            settled.append(frontier)
            frontier = pushed(frontier, waiting, wanted, k)
        return np.concatenate(settled) if settled else NONE

    def pushed(places: np.ndarray, waiting: list[list[np.ndarray]], wanted: bool, own: int) -> np.ndarray:
        before = places[places > 0] - 1
        again = NONE
        for k, part in _dealt(before[smaller[before] == wanted], bucket):
            if k == own:
                again = part
            else:
                waiting[k].append(part)
        return again

    larger: list[np.ndarray] = []
    waiting: list[list[np.ndarray]] = [[] for _ in range(width)]
    for k in range(width):
        larger.append(swept(k, waiting, False))
        pushed(seeds[k], waiting, False, -1)
    order: list[np.ndarray] = []
    waiting = [[] for _ in range(width)]
    for k in range(width - 1, -1, -1):
        # The separators are all LMS and differ, so their order is known already.
        falling = swept(k, waiting, True) if k else seeds[0][::-1]
        pushed(larger[k][::-1], waiting, True, -1)
        order += [falling, larger[k][::-1]]
    return np.concatenate(order)[::-1]


def suffix_array(text: Segmented) -> np.ndarray:
    """Places of all suffixes in ascending order, separators included."""
    if len(text.symbols) < 2:
        return np.arange(len(text.symbols))
    smaller = classified(text.symbols)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if smaller[0] and text.bucket[0] == 0:
        lms = np.concatenate(([0], lms))  # an empty first segment
    return induced(text.bucket, smaller, lms_order(text.bucket, lms))


def common_prefixes(text: Segmented, order: np.ndarray, length: int) -> np.ndarray:
    """For each place, in text order: whether ``length`` bytes agree with its predecessor in ``order``.

    This is the permuted array of common prefixes, cut off at ``length`` (at least 8): it is filled by
    place in the text, so one side is read in sequence.
    """
    size = len(text.data)
    before = np.full(size, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.flatnonzero((text.left >= length) & (before >= 0))
    place = place[text.left[before[place]] >= length]
    padded = np.concatenate((text.data, np.zeros(8, np.uint8)))
    words = np.ndarray((size,), "<u8", padded.data, strides=(1,))
    for step in [*range(0, length - 7, 8), length - 8]:
        place = place[words[place + step] == words[before[place] + step]]
    agree = np.zeros(size, bool)
    agree[place] = True
    return agree
