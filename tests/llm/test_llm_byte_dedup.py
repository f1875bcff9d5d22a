"""Suffix arrays against sorted suffixes; byte dedup against a direct search of all strings."""

import hashlib
import random
import tracemalloc

import numpy as np
from llm_helpers import docs_of, rows_of

from lamina.llm import byte_dedup
from lamina.llm.blocks import U64, Rolling
from lamina.llm.byte_dedup import without_repeats
from lamina.llm.suffix_arrays import Segmented, common_prefixes, suffix_array


def test_suffix_array_equals_sorting():
    picked = random.Random(1)
    for trial in range(300):
        alphabet = picked.choice([b"a", b"ab", b"abc", b"abcdefgh", bytes(range(256))])
        count = 300 if trial % 20 == 0 else picked.randint(1, 6)
        parts = [bytes(picked.choices(alphabet, k=picked.randint(1, 60))) for _ in range(count)]
        parts += parts if trial % 3 == 0 else []
        text = Segmented(np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts]))
        symbols = text.symbols.tolist()
        order = sorted(range(len(symbols)), key=lambda i: symbols[i:])
        found = suffix_array(text)
        assert found.tolist() == order
        agree = common_prefixes(text, found, 8)
        for i, j in zip(order[1:], order):
            fits = text.left[i] >= 8 and text.left[j] >= 8
            assert agree[i] == (fits and text.data[i : i + 8].tolist() == text.data[j : j + 8].tolist())


def test_few_places_are_sorted_by_comparison(monkeypatch):
    """Two per byte at most, however many segments there are; sorts of 16-bit numbers go by radix."""
    letters = np.random.default_rng(0).choice(np.frombuffer(b"etaoin shrdlu", np.uint8), 60_000)
    text = Segmented(np.tile(letters, 2), np.full(2_000, 60))
    handled = []
    argsort, lexsort = np.argsort, np.lexsort

    def counted(values, **how):
        handled.append(len(values) if values.dtype.itemsize > 2 else 0)
        return argsort(values, **how)

    def counted_keys(keys):
        handled.extend(map(len, keys))
        return lexsort(keys)

    monkeypatch.setattr(np, "argsort", counted)
    monkeypatch.setattr(np, "lexsort", counted_keys)
    order = suffix_array(text)
    monkeypatch.undo()
    assert sum(handled) < 2 * len(text.data)
    assert np.array_equal(np.sort(order), np.arange(len(text.data)))


def test_hashes_leave_no_tables_behind():
    values = np.arange(1 << 20, dtype=U64)
    tracemalloc.start()
    rolling = Rolling(values)
    found = rolling.windows(7)
    assert np.array_equal(found, rolling.of(np.arange(len(found)), np.arange(7, len(values) + 1)))
    assert found[5] == Rolling(values[5:12]).windows(7)[0] and len(Rolling(values[:6]).windows(7)) == 0
    del rolling, found
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 1 << 18


def brute(pairs, length=50):
    texts = {}
    for doc_id, text in pairs:
        if doc_id is not None:
            texts[doc_id] = min(text or "", texts.get(doc_id, text or ""))
    earlier, out = set(), {}
    for doc_id in sorted(texts):
        data = texts[doc_id].encode()
        strings = [data[i : i + length] for i in range(len(data) - length + 1)]
        gone = np.zeros(len(data) + 1, bool)
        for i, string in enumerate(strings):
            if string in earlier:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((gone[1:] > gone[:-1]).sum() + gone[0])
        out[doc_id] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
        earlier.update(strings)
    return out


def test_equal_to_direct_search(spark):
    picked = random.Random(8)
    new = lambda n: "".join(picked.choices("abcdefgh é漢\n", k=n))
    passages = [new(n) for n in (40, 49, 50, 51, 90, 400)] + ["z" * 60, "ab" * 40]
    docs = []
    for _ in range(150):
        body = new(picked.randint(0, 200))
        for _ in range(picked.randint(0, 3)):
            at, source = picked.randint(0, len(body)), picked.choice(passages)
            body = body[:at] + source[picked.randint(0, 20) :] + body[at:]
        docs.append(body)
    docs += [docs[3], docs[4] * 2, "q" * 3000, "q" * 77, "", "x"]
    picked.shuffle(docs)
    pairs = [*enumerate(docs), (None, docs[0]), (7000, None), (9, docs[9])]
    rows = rows_of(without_repeats(docs_of(spark, pairs)))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert got == brute(pairs) and len(rows) == len(got)
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in rows)
    assert without_repeats(docs_of(spark, [])).collect() == []


def test_anchor_does_not_depend_on_the_block(monkeypatch):
    """Grams that agree in all but their lowest bits, as may happen by chance, in blocks of two lengths."""
    real = Rolling.windows

    def alike(self, length):
        return (real(self, length) % U64(1 << 20)) | (U64(5) << U64(40))

    monkeypatch.setattr(Rolling, "windows", alike)
    picked = np.random.default_rng(3)
    string = picked.integers(97, 123, 50, dtype=np.uint8)
    places = set()
    for before in (0, 50_000, 4 << 20):
        data = np.concatenate((picked.integers(97, 123, before, dtype=np.uint8), string))
        anchor, first, last, _ = byte_dedup._anchors(data, np.array([0, len(data)]), 50, 20)
        of = np.flatnonzero((first <= before) & (before <= last))
        places.add(int(anchor[of[0]]) - before)
    assert len(places) == 1


def test_copies_between_a_short_and_a_very_long_text(spark):
    picked = random.Random(5)
    new = lambda n: "".join(picked.choices("abcdefghijklmnop ", k=n))
    short = new(50_000)
    parts = []
    for _ in range(400):
        at = picked.randrange(len(short) - 60)
        parts += [new(10_400), short[at : at + picked.randint(45, 60)]]
    pairs = [(1, short), (2, "".join(parts)), (3, new(50_000) + parts[-1] + parts[200])]
    assert len(pairs[1][1]) > 4_000_000
    rows = rows_of(without_repeats(docs_of(spark, pairs)))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert got == brute(pairs)
