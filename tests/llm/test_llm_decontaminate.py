"""Greedy string tiling against a direct version over all pairs of documents and items."""

import random
import re

from llm_helpers import docs_of, rows_of

from lamina.llm.decontaminate import clean_rows, contaminated


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(doc, item, size):
    """Words of the item under greedy tiles, found by comparing every pair of places each round."""
    size = min(size, len(item))
    used_d, used_i, tiled = [False] * len(doc), [False] * len(item), 0
    while size:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n] and not used_i[i + n] and not used_d[d + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < size:
            break
        used_i[i : i + n] = used_d[d : d + n] = [True] * n
        tiled += n
    return tiled


def items_of(spark, pairs):
    return spark.createDataFrame(pairs, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS gram")


def test_pairs_equal_direct_tiling(spark):
    picked = random.Random(9)
    vocabulary = [f"w{k}" for k in range(40)] + ["a", "é"]
    items = [(k, " ".join(picked.choices(vocabulary, k=n))) for k, n in enumerate([30, 25, 12, 7, 3, 1, 40, 18])]
    docs = []
    for k in range(60):
        body = picked.choices(vocabulary, k=picked.randint(0, 60))
        item = items[k % len(items)][1].split()
        cut = picked.randint(0, len(item))
        if k % 3 == 0:
            body[5:5] = item[cut:] + ["X"] + item[:cut]
        elif k % 3 == 1:
            body[2:2] = item[: cut // 2] + ["Y,"] + item[cut:]
        docs.append((k, ". ".join(" ".join(body).title().split("  "))))
    docs += [(None, items[0][1]), (900, None), (901, ""), (902, items[0][1] * 1), (902, items[0][1])]
    found = rows_of(contaminated(docs_of(spark, docs), items_of(spark, [*items, (77, ""), (78, None), (None, "w1 w2")])))
    got = {(r["doc_id"], r["item_id"]): (r["matched_words"], r["item_words"]) for r in found}
    assert len(got) == len(found)
    expected = {}
    for doc_id, text in docs:
        for item_id, content in items:
            if doc_id is not None and words(content):
                tiled = brute(words(text), words(content), 5)
                if tiled >= 0.5 * len(words(content)):
                    expected[doc_id, item_id] = (tiled, len(words(content)))
    assert got == expected


def test_clean_rows_stay_whole(spark):
    item = " ".join(f"t{k}" for k in range(20))
    docs = docs_of(spark, [(1, f"x {item} y"), (2, "other words"), (None, item), (3, None), (2, "other words")])
    kept = clean_rows(docs, items_of(spark, [(0, item)]))
    assert kept.columns == docs.columns
    # A row without an id is searched like any other.
    assert sorted(str(r["doc_id"]) for r in rows_of(kept)) == ["2", "2", "3"]
    assert clean_rows(docs, items_of(spark, [])).count() == 5
    assert contaminated(docs_of(spark, []), items_of(spark, [(0, item)])).collect() == []


def test_every_row_is_searched_for_every_item(spark):
    """Texts under one id, items under one id, rows and items without id, names that clash."""
    one, two = (" ".join(f"{w}{k}" for k in range(20)) for w in "tu")
    pairs = [(1, "a clean text"), (1, f"so {one} it is"), (1, "a clean text"), (None, two), (None, "clean too"), (7, two), (7, two), (8, "b clean text")]
    docs = docs_of(spark, pairs).selectExpr("*", "3 AS leaking", "4 AS _leaking", "5 AS gram", "6 AS item_id")
    kept = clean_rows(docs, items_of(spark, [(5, "other"), (5, one), (None, two)]))
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in rows_of(kept)) == [("1", "a clean text"), ("1", "a clean text"), ("8", "b clean text"), ("None", "clean too")]
