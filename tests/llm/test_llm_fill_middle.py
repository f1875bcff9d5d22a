"""Fill-in-the-middle against the contract written out with a plain regular expression."""

import hashlib
import random
import re

import numpy as np
from llm_helpers import docs_of, rows_of

from lamina.llm import fill_middle as fim

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plainly(doc_id, text):
    """One result row, straight from the contract."""
    text = text or ""
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    n, digest = len(tokens), sha(f"42:{doc_id}")
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:low]), "".join(tokens[low:high]), "".join(tokens[high:])
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


ODD = [
    "", " ", "\n\t  ", "a", " a", "a ", "a b", "a\x0bb\x0cc\rd", "é漢😀 ß x y z", "<P>", "x <S> y", "<M", "a< P>", "<P <S <M",
    "S>P>M>", "<<<", "word " * 5000, " " * 5000 + "x", "x" + "\n" * 5000, "漢" * 4000 + " 字 " * 3000,
]


def test_rows_equal_the_contract(spark):
    picked = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "bc", "é", "漢字", "😀", "<", "<P", ">", "S>", "M>", "\x1c", " "]
    texts = ODD * 8 + ["".join(picked.choices(parts, k=picked.randrange(80))) for _ in range(1500)]
    pairs = [*enumerate(texts), (9000, None), (9001, "a b c"), (9001, "a b c"), (9001, "d e"), (-5, "one two three")]
    found = [tuple(r.values()) for r in rows_of(fim.digests(docs_of(spark, pairs)))]
    expected = [plainly(i, t) for i, t in pairs]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    forms = [row[2] for row in expected]
    assert {"plain", "psm", "spm"} == set(forms) and forms.count("spm") > 2 * forms.count("psm") > 0


def test_rows_without_id_and_empty_tables(spark):
    row = rows_of(fim.fill_middle(docs_of(spark, [(None, "a b c d")]), cut_share=100))[0]
    assert row["doc_id"] is None and row["n"] == 4 and row["form"] != "plain"
    assert fim.digests(docs_of(spark, [])).collect() == []


def test_shares_and_seed(spark):
    docs = docs_of(spark, [(i, f"one two three four {i}") for i in range(200)])
    forms = lambda **o: {r["form"] for r in rows_of(fim.fill_middle(docs, **o))}
    assert forms(cut_share=0) == {"plain"}
    assert forms(cut_share=100, suffix_first_share=0) == {"psm"} and forms(cut_share=100, suffix_first_share=100) == {"spm"}
    outputs = [sorted(r["output"] for r in rows_of(fim.fill_middle(docs, seed=s))) for s in (42, 42, 43)]
    assert outputs[0] == outputs[1] != outputs[2]


def test_descent_finds_every_bound():
    picked = np.random.default_rng(2)
    for size in (1, 2, 3, 7, 8, 9, 31):
        counts = picked.integers(0, 4, (size, 2))
        tree, sums = fim.Fenwick(counts), np.cumsum(counts[:, 0])
        for wanted in range(1, int(sums[-1]) + 1):
            block, before = tree.descend(wanted)
            assert block == int(np.searchsorted(sums, wanted)) and before.tolist() == counts[:block].sum(axis=0).tolist()
    text = "ab  é漢 c\nd   " * 40
    ends = [m.end() for m in TOKEN.finditer(text)]
    for piece in (1, 2, 5, 64, 10_000):
        units = fim.Units(np.frombuffer(text.encode(), np.uint8), piece)
        assert len(units) == len(ends)
        for k, end in enumerate([0, *ends]):
            assert units.bound(k) == (len(text[:end].encode()), end)
