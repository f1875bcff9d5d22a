"""Quality statistics against plain Python; votes, model and verdicts."""

import random
import re
from collections import Counter

import pytest
from llm_helpers import docs_of, rows_of
from pyspark.sql import functions as F

from lamina.llm.quality_votes import estimate, keep_good, report


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = list(zip(words, words[1:], words[2:]))
    count, covered, seen, repeated = Counter(grams), set(), set(), 0
    for i, gram in enumerate(grams):
        if count[gram] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed


def texts():
    picked = random.Random(11)
    vocabulary = ["the", "of", "a", "Wort", "été", "x#", "|", "\n", "\t", " ", "line\n", " "]
    made = [" ".join(picked.choices(vocabulary, k=picked.randint(0, 120))) for _ in range(150)]
    prose = [" ".join("w%d" % picked.randint(0, 5000) for _ in range(200)) for _ in range(60)]
    junk = [p.replace(" ", "### ") for p in prose[:20]] + [p.upper().replace(" ", "!! ") for p in prose[:20]]
    return ["", " \n ", "one", "a b c", "a b c a b c", "word " * 20000, "x" * 100000, *made, *prose, *junk]


def test_report(spark):
    listed = texts()
    pairs = [*enumerate(listed), (None, "no id"), (7000, None), (3, listed[3])]
    rows = rows_of(report(docs_of(spark, pairs)))
    assert len(rows) == len(pairs)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for row in rows:
        if row["doc_id"] is not None:
            text = "" if row["doc_id"] == 7000 else listed[row["doc_id"]]
            assert tuple(row[n] for n in names) == brute(text), repr(text[:80])
            assert not (row["base_failed"] and row["kept"])
    kept = {row["doc_id"]: row["kept"] for row in rows}
    prose = range(len(listed) - 100, len(listed) - 40)
    assert all(kept[k] for k in prose)
    assert not any(kept[k] for k in range(len(listed) - 40, len(listed)))


def test_kept_rows_have_their_columns(spark):
    docs = docs_of(spark, [(1, " ".join(f"w{i}" for i in range(90))), (2, "short"), (None, None)])
    kept = keep_good(docs)
    assert kept.columns == docs.columns and [r["doc_id"] for r in rows_of(kept)] == [1]
    assert report(docs_of(spark, [])).collect() == []


def test_columns_named_like_statistics_stay(spark):
    names = ["_text", "_list", "_windows", "_line_list", "_words", "_votes", "_good", "_failed", "_kept", "row", "_row", "a.b"]
    docs = docs_of(spark, [(1, " ".join(f"w{i}" for i in range(90))), (2, "short")])
    docs = docs.select("*", *(F.lit(f"value of {name}").alias(name) for name in names))
    kept = keep_good(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert [row.asDict() for row in kept.collect()] == [row.asDict() for row in docs.where("doc_id = 1").collect()]
    assert report(docs).count() == 2


def test_no_python_in_the_plan(spark):
    plan = report(docs_of(spark, [(1, "a b c")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_model_finds_kinds():
    model = estimate({"ggggggg": 900, "bgggggg": 60, "ggggb-g": 40, "gbbgggg": 30, "-gggggg": 5})
    assert model.good("ggggggg") > 0.95 and model.good("-gggggg") > 0.5
    assert model.good("bgggggg") < 0.1 and model.good("gbbgggg") < 0.1


def test_labels_agree(spark):
    """Held-out labels: nearly all good documents that pass the base test stay, nearly all bad go."""
    sf = "/root/testdata/sf0.01"
    rows = report(spark.read.parquet(f"{sf}/documents.parquet"))
    held = rows_of(rows.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("NOT base_failed"))
    good = [r["kept"] for r in held if r["quality"] == 1]
    bad = [r["kept"] for r in held if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)
    assert pytest.approx(1, abs=1) == rows.selectExpr("max(posterior)").first()[0]
