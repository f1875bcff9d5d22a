"""License scan against a direct search for the phrases, and edited license texts."""

import random

from llm_helpers import docs_of, rows_of

from lamina.llm.license_scan import PHRASES, TEXTS, scan, words_of


def brute(text):
    words = words_of(text or "")
    places = []
    for label, phrase in PHRASES:
        want = phrase.split()
        places += [(k, label) for k in range(len(words)) if words[k : k + len(want)] == want]
    places.sort()
    ends = (places[0][0], places[-1][0]) if places else (None, None)
    return len(words), len(places), *ends, ",".join(sorted({x for _, x in places}))


def test_base_and_labels(spark):
    picked = random.Random(6)
    parts = ["mit", "MIT", "License", "license.", "apache", "general", "Public", "é", "gpl", "\n", "x9", "-"]
    texts = [" ".join(picked.choices(parts, k=picked.randint(0, 40))) for _ in range(400)]
    mit = TEXTS[0][1].split()
    edited = mit[:30] + ["inserted", "words"] + mit[30:60] + mit[63:]
    texts += ["", "MIT-license mit license", "word " * 30000, " ".join(["pre"] * 50 + edited), " ".join(mit[:12])]
    texts += ["All is Licensed under CC BY-NC 4.0.", "Licensed under CC BY-ND 4.0", "mit license " * 3000]
    pairs = [*enumerate(texts), (None, "mit license"), (7000, None), (3, texts[3])]
    rows = {r["doc_id"]: r for r in rows_of(scan(docs_of(spark, pairs)))}
    assert set(rows) == {*range(len(texts)), 7000}
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    for doc_id, row in rows.items():
        text = "" if doc_id == 7000 else texts[doc_id]
        assert tuple(row[n] for n in names) == brute(text), repr(text[:80])
        assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(",")) and 0 <= row["score"] <= 1
    tail = {k: rows[len(texts) - 8 + k] for k in range(8)}
    assert tail[3]["labels"] == "mit" and 0.9 < tail[3]["score"] < 1 and tail[4]["labels"] == ""
    assert tail[5]["labels"] == "cc-by-nc" and tail[6]["labels"] == "" and tail[7]["n_base"] == 3000


def test_empty_table(spark):
    assert scan(docs_of(spark, [])).collect() == []
