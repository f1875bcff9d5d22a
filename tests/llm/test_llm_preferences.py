"""Preference formatting against plain Python and the SQL."""

import random

import duckdb
from llm_helpers import rows_of

from lamina.llm.preferences import ORACLE, format_pairs, preference_examples

TURNS = "conv_id long, turn long, role string, text string"


def shown(turns):
    return "".join(f"<|{role}|>\n{text}<|end|>\n" for role, text in turns)


def masked(turns):
    at, out = 0, []
    for role, text in turns:
        whole = len(shown([(role, text)]))
        if role == "assistant":
            out.append(f"{at + 5 + len(role)}:{at + whole}")
        at += whole
    return ",".join(out)


def formatted(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    return n, shown(chosen[:n]), shown(chosen[n:]), shown(rejected[n:]), masked(chosen[n:]), masked(rejected[n:])


NAMES = ("n_prefix", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask")


def test_pairs(spark):
    picked = random.Random(12)
    make = lambda: [(picked.choice(["user", "assistant"]), picked.choice(["a", "b", "é\n", ""])) for _ in range(picked.randint(0, 5))]
    pairs = [(k, make(), make()) for k in range(400)] + [(900, [("user", "x")] * 3, [("user", "x")] * 3)]
    rows = [(k, [(n, *t) for n, t in enumerate(a)], [(n + 7, *t) for n, t in enumerate(b)]) for k, a, b in pairs]
    kind = "array<struct<turn:bigint,role:string,text:string>>"
    df = spark.createDataFrame([*rows, (901, None, None)], f"pair long, chosen_turns {kind}, rejected_turns {kind}")
    got = {r["pair"]: tuple(r[n] for n in NAMES) for r in rows_of(format_pairs(df))}
    assert got == {**{k: formatted(a, b) for k, a, b in pairs}, 901: (0, "", "", "", "", "")}


def test_table_equals_sql(spark):
    picked = random.Random(13)
    rows = [(k, t, picked.choice(["user", "assistant", "system", None]), picked.choice(["hi", "é😀", None, "", "x\n"])) for k in range(60) for t in range(picked.randint(0, 6))]
    rows += [(70, 0, "assistant", "a"), (70, 0, "assistant", "a"), (70, 0, "assistant", "b"), (None, 1, "user", "x"), (71, None, "user", "x"), (72, 0, "user", "long " * 20000), (72, 1, "assistant", "ok")]
    df = spark.createDataFrame(rows, TURNS)
    engine = duckdb.connect()
    engine.register("conversations", df.toArrow())
    cursor = engine.execute(ORACLE)
    columns = [c[0] for c in cursor.description]
    expected = sorted(cursor.fetchall())
    got = preference_examples(df.selectExpr("*", "1 AS n_prefix", "2 AS turns"))
    assert got.columns == columns
    assert sorted(tuple(r) for r in got.collect()) == expected
    assert preference_examples(spark.createDataFrame([], TURNS)).collect() == []
