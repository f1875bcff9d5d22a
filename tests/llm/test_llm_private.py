"""Personal data against plain searches; reliabilities and classifier on planted votes."""

import hashlib
import random
import re

from llm_helpers import docs_of, rows_of

from lamina.llm.private_spans import classifier, digest, find, reliabilities

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return spans


TEXTS = [
    "", None, "é😀 a@b.co_x@d.com, c@d..e f@g.h.i-j", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.255 9999.1.1.1.1.1.1", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "+1 (207) 555-7294 +1 23 ++49 30 1234567", "4" * 40, "0" * 15, "a" * 60000 + "@", "@" * 500, "x@y " * 300, "1.2.3.4 " * 400,
    "+++++1+2 345 678 901", "漢 4397865138547350 漢", "SSN 123-45-6789", "Dear Mr. James", "1-2-3 4 5 6 7 8 9 0 1 2 3 4 5",
]


def test_base_spans(spark):
    picked = random.Random(4)
    parts = ["a", "@", ".", "b.c", "+", "1", "23", "4111111111111111", " ", "-", "(", ")", "é", "255", "x_y", "\n"]
    texts = TEXTS + ["".join(picked.choices(parts, k=picked.randint(0, 40))) for _ in range(2000)]
    pairs = [*enumerate(texts), (None, "q@r.st"), (5, TEXTS[5])]
    rows = rows_of(digest(docs_of(spark, pairs)))
    assert len(rows) == len(pairs)
    for row in rows:
        text = "q@r.st" if row["doc_id"] is None else texts[row["doc_id"]] or ""
        spans = brute(text)
        joined = ",".join(":".join(map(str, s)) for s in spans)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), repr(text)
        assert [row[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        assert set(joined.split(",")) - {""} <= set(row["spans"].split(","))


LONG = {
    "0 1 2 3 4 5 6 7 8 9 " * 50_000: [],
    "7" * 1_000_000: [],
    "a@b" + ".c" * 100_000: [("email", 0, 200_003)],
    "1." * 100_000: [("ip", 8 * k, 8 * k + 7) for k in range(25_000)],
    "-".join("12" * 100_000): [],
    "a." * 100_000 + "@b.c": [("email", 0, 200_004)],
    "x@" + "y-" * 100_000 + ".z..": [("email", 0, 200_004)],
    "+1" + " (2)" * 50_000: [],
    "a@b" + ".." * 100_000: [],
}


def test_long_runs(spark):
    """Runs of digits, labels and parts far beyond what a call per repetition has stack for."""
    rows = {r["doc_id"]: r for r in rows_of(digest(docs_of(spark, [*enumerate(LONG)])))}
    for k, (text, spans) in enumerate(LONG.items()):
        joined = ",".join(":".join(map(str, span)) for span in spans)
        assert rows[k]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), text[:20]


def test_kept_cards_among_decoys(spark):
    """Planted numbers with right check digits, decoys of the same lengths and issuers with wrong ones."""
    picked = random.Random(11)

    def number(valid):
        digits = picked.choice(["4", "51", "36", "6011", "35"])
        digits += "".join(picked.choices("0123456789", k=picked.choice([14, 15, 16]) - len(digits)))
        ending = next(d for d in "0123456789" if luhn(digits + d))
        return digits + (ending if valid else str((int(ending) + picked.randint(1, 9)) % 10))

    before = ["card ", "pay with visa ", "order ", "serial id ", "the number ", "", "see "]
    texts, truth = [], []
    for k in range(900):
        valid = k % 3 == 0
        texts.append(f"some words {picked.choice(before)}{number(valid)} and more {picked.choice(['', 'a@b.org ', '10.0.0.1 '])}words")
        truth.append(valid)
    rows = {r["doc_id"]: "card:" in r["spans"] for r in rows_of(digest(docs_of(spark, [*enumerate(texts)])))}
    kept = sum(rows.values())
    right = sum(rows[k] and truth[k] for k in rows)
    assert right / kept >= 0.9 and right / sum(truth) >= 0.9


def test_spans_have_contents_and_no_python(spark):
    found = find(docs_of(spark, [(1, "mail me: ab@cd.org now"), (2, None)]))
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().executedPlan().toString())
    rows = {r["doc_id"]: r["found"] for r in rows_of(found)}
    assert [(f["kind"], f["content"], f["kept"]) for f in rows[1]] == [("email", "ab@cd.org", True)] and rows[2] == []
    assert digest(docs_of(spark, [])).collect() == []


def test_model_follows_reliable_labelers():
    counts = {("card", "yyyyy"): 500, ("card", "nnn-y"): 300, ("card", "yn--y"): 80, ("ssn", "y--yy"): 20, ("ssn", "n---n"): 30}
    model = classifier(counts, reliabilities(counts))
    assert model["card", "yyyyy"] > 0.9 and model["card", "nnn-y"] < 0.1
    assert model["ssn", "y--yy"] > 0.5 > model["ssn", "n---n"]
    assert classifier({}, {}) == {}
