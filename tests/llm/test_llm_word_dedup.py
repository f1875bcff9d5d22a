"""Word windows against a direct search of every window in every earlier document."""

import hashlib
import random
import re

from llm_helpers import docs_of, rows_of

from lamina.llm.word_dedup import COVER, PERIOD, without_repeats


def brute(pairs, window=50):
    texts = {}
    for doc_id, text in pairs:
        if doc_id is not None:
            texts[doc_id] = min(text or "", texts.get(doc_id, text or ""))
    earlier, out = set(), {}
    for doc_id in sorted(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[doc_id])
        grams = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
        gone = set()
        for i, gram in enumerate(grams):
            if gram in earlier:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc_id] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
        earlier.update(grams)
    return out


def corpus():
    picked = random.Random(31)
    new = lambda n: [f"w{picked.randint(0, 500)}" for _ in range(n)]
    passages = [new(n) for n in (49, 50, 51, 75, 120, 300)]
    docs = []
    for k in range(150):
        body = new(picked.randint(0, 90))
        for _ in range(picked.randint(0, 2)):
            source = picked.choice(passages)
            begin = picked.randint(0, max(0, len(source) - 60))
            at = picked.randint(0, len(body))
            body[at:at] = source[begin:]
        docs.append(body)
    docs += [docs[3], docs[4] + docs[4], ["the"] * 500, ["the"] * 130, ["the"] * 49 + ["X"]]
    picked.shuffle(docs)
    return [picked.choice([" ", "\n", "\t "]).join(d) for d in docs]


def test_cover_reaches_every_offset():
    for offset in range(PERIOD):
        assert any((c + offset) % PERIOD in COVER for c in COVER)


def test_equal_to_direct_search(spark):
    texts = corpus()
    pairs = [*enumerate(texts), (None, texts[0]), (7000, None), (7001, "é  漢 x " * 60), (7002, "é  漢 x " * 60), (9, texts[9])]
    rows = rows_of(without_repeats(docs_of(spark, pairs)))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows}
    assert got == brute(pairs) and len(rows) == len(got)
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] for r in rows)
    assert without_repeats(docs_of(spark, [])).collect() == []


def test_same_id_other_text(spark):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    pairs = [(1, b), (1, a), (2, a), (3, b)]
    got = {r["doc_id"]: r["n_removed"] for r in rows_of(without_repeats(docs_of(spark, pairs)))}
    assert got == {1: 0, 2: 60, 3: 0}
