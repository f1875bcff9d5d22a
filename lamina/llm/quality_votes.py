"""Quality rules as weak supervision, with DataFrame functions only.

Each rule votes good, bad or abstains on a document. Expectation-maximisation over the vote patterns
of the whole corpus estimates how often each rule casts each vote on good and on bad documents; the
posterior probability of being good then decides, instead of all rules having to pass.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.session import shared_folder

# Word separators, symbols, and the base test.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS, MOST_REPEATED = 50, 50
GOOD, BAD, ABSTAIN = "g", "b", "-"
MOST_FALSE_ALARMS = 0.005

#: Rule: (SQL for bad, SQL for good); what is neither is an abstention.
RULES = {
    "symbols": ("_symbols > 0.05 * _letters", "_symbols < 0.01 * _letters"),
    "capitals": ("_capitals > 0.5 * _letters", "_capitals < 0.2 * _letters"),
    "marks": ("_marks > 0.4 * _words", "_marks < 0.05 * _words"),
    "repeats": ("_repeats > 0.3 * _words", "_repeats < 0.1 * _words"),
    "lines": ("_dup_lines > 0.6 * _lines AND _lines >= 5", "_dup_lines = 0"),
    "variety": ("_distinct < 0.3 * _words AND _words >= 50", "_distinct > 0.5 * _words"),
    "word_length": ("_letters < 2.5 * _words OR _letters > 14 * _words", "_letters BETWEEN 3 * _words AND 12 * _words"),
}
STATISTICS = ("_words", "_letters", "_symbols", "_dup_lines", "_repeats", "_lines", "_capitals", "_marks", "_distinct")


def _among(text: str, characters: str) -> Column:
    """How many characters of ``text`` are in the regular-expression class."""
    return F.regexp_count(text, F.lit(characters)).cast("long")


def repeated_words(hashes: str) -> str:
    """SQL for the number of words inside 3-word windows that occur twice or more in the text.

    ``hashes`` holds the 64-bit hash of each window. Texts without a repeated window, the usual
    case, end at the size test. Otherwise hash and place are packed into one long, so that one sort
    of longs brings equal windows together with their places ascending; what the packing cut off
    the hashes is compared for the few neighbours that look equal. Linear but for the sort, and no
    row is exploded.
    """
    bits = f"length(bin(size({hashes})))"
    packed = f"sort_array(transform({hashes}, (h, i) -> shiftleft(h, {bits}) | i))"
    alike = "shiftrightunsigned(x ^ get(a.p, i {0} 1), a.bits) = 0"
    place = "cast({0} & (shiftleft(1L, a.bits) - 1) AS int)"
    same = f"{hashes}[s.at] = get({hashes}, s.{{0}})"
    close = (
        f"filter(transform(filter(transform(a.p, (x, i) -> CASE WHEN {alike.format('-')} OR {alike.format('+')}"
        f" THEN i END), i -> i IS NOT NULL), i -> named_struct('at', {place.format('a.p[i]')},"
        f" 'low', {place.format('get(a.p, i - 1)')}, 'high', {place.format('get(a.p, i + 1)')})),"
        f" s -> {same.format('low')} OR {same.format('high')})"
    )
    # transform over an array of one names the sorted array, so that it is computed once.
    places = (
        f"sort_array(transform(array(named_struct('p', {packed}, 'bits', {bits})),"
        f" a -> transform({close}, s -> s.at))[0])"
    )
    covered = (
        f"aggregate({places}, named_struct('free', 0, 'n', 0L), (a, at) ->"
        f" named_struct('free', at + 3, 'n', a.n + (at + 3 - greatest(a.free, at))), a -> a.n)"
    )
    return (
        f"CASE WHEN size({hashes}) < 2 OR size(array_distinct({hashes})) = size({hashes}) THEN 0L"
        f" ELSE {covered} END"
    )


def statistics(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` and the document statistics, row by row, no shuffle.

    Null and empty texts count as texts without words. Names that start with an underscore are
    added and replace columns of that name.
    """
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD))
    windows = (
        "CASE WHEN size(_list) >= 3 THEN transform(sequence(0, size(_list) - 3),"
        " i -> xxhash64(_list[i], _list[i + 1], _list[i + 2])) ELSE cast(array() AS array<bigint>) END"
    )
    rows = docs.withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = rows.withColumns(
        {
            "_list": F.filter(F.split("_text", SPACE), lambda word: word != ""),
            "_line_list": lines,
            "_symbols": _among("_text", SYMBOLS),
            "_capitals": _among("_text", "[A-Z]"),
            "_marks": _among("_text", "[!?]"),
        }
    )
    rows = rows.withColumn("_windows", F.expr(windows))
    rows = rows.withColumns(
        {
            "_words": F.size("_list").cast("long"),
            "_letters": F.length(F.array_join("_list", "")).cast("long"),
            "_distinct": F.size(F.array_distinct("_list")).cast("long"),
            "_lines": F.size("_line_list").cast("long"),
            "_dup_lines": (F.size("_line_list") - F.size(F.array_distinct("_line_list"))).cast("long"),
            "_repeats": F.expr(repeated_words("_windows")),
        }
    )
    return rows.drop("_text", "_list", "_line_list", "_windows")


def votes() -> Column:
    """One letter per rule; documents without words get abstentions only."""
    letters = [
        F.expr(f"CASE WHEN _words = 0 THEN '{ABSTAIN}' WHEN {bad} THEN '{BAD}' WHEN {good} THEN '{GOOD}' ELSE '{ABSTAIN}' END")
        for bad, good in RULES.values()
    ]
    return F.concat(*letters)


@dataclass(frozen=True)
class Model:
    """Share of each class and, class by rule, the probability of either vote; abstaining says nothing.

    Class 0 is good; class k is bad of the kind that rule k is made for, as junk of one kind rarely
    shows the marks of another.
    """

    shares: tuple[float, ...]
    given: tuple[tuple[dict[str, float], ...], ...]

    def classes(self, pattern: str) -> list[float]:
        """Probability of each class given the votes."""
        logs = [
            math.log(share)
            + sum(math.log(table[vote]) for table, vote in zip(tables, pattern) if vote != ABSTAIN)
            for share, tables in zip(self.shares, self.given)
        ]
        most = max(logs)
        weights = [math.exp(value - most) for value in logs]
        return [weight / sum(weights) for weight in weights]

    def good(self, pattern: str) -> float:
        return self.classes(pattern)[0]


def _first_guess(pattern: str) -> list[float]:
    """Bad of the kinds whose rules say so; good if none does."""
    kinds = [1.0 if vote == BAD else 0.0 for vote in pattern]
    guess = [0.04, *kinds] if BAD in pattern else [1.0, *(0.001 for _ in pattern)]
    return [weight / sum(guess) for weight in guess]


def estimate(patterns: dict[str, int], rounds: int = 50, smoothing: float = 0.5) -> Model:
    """Expectation-maximisation on counted vote patterns.

    ``smoothing`` is added to every count, so no probability is zero. The number of patterns is
    bounded by 3 ** rules, whatever the corpus; the work does not grow with it. Votes alone cannot
    tell a kind of junk that trips one rule only from good documents that the rule gets wrong as
    often, so the rate of wrong alarms on good documents is held under MOST_FALSE_ALARMS.
    """
    width = len(RULES)
    posterior = {pattern: _first_guess(pattern) for pattern in patterns}
    for _ in range(rounds):
        mass = [smoothing] * (width + 1)
        counts = [[dict.fromkeys((GOOD, BAD), smoothing) for _ in range(width)] for _ in mass]
        for pattern, n in patterns.items():
            for kind, probability in enumerate(posterior[pattern]):
                mass[kind] += n * probability
                for table, vote in zip(counts[kind], pattern):
                    if vote != ABSTAIN:
                        table[vote] += n * probability
        given = [[{v: n / sum(t.values()) for v, n in t.items()} for t in tables] for tables in counts]
        for table in given[0]:
            table[BAD] = min(table[BAD], MOST_FALSE_ALARMS)
            table[GOOD] = 1 - table[BAD]
        model = Model(tuple(m / sum(mass) for m in mass), tuple(tuple(tables) for tables in given))
        posterior = {pattern: model.classes(pattern) for pattern in patterns}
    return model


def judged(docs: DataFrame, threshold: float = 0.5, carry: tuple[str, ...] | None = None) -> DataFrame:
    """The columns of ``docs`` (or those of them in ``carry``) with statistics, ``_votes``, ``_failed``, ``_good`` and ``_kept``.

    The statistics are written once to the shared folder and read for both the estimate and the
    verdict. Only counts of vote patterns come to the driver, at most 3 ** rules of them. A document
    fails outright under 50 words or if more than half of its words stand in repeated 3-word windows.
    Null doc_ids, repeated rows and ties are judged row by row; an empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "quality")
    kept = docs.columns if carry is None else carry
    statistics(docs).select(*kept, *STATISTICS, votes().alias("_votes")).write.parquet(folder)
    rows = spark.read.parquet(folder)
    # Bounded: one row per pattern of votes.
    patterns = {r["_votes"]: r["n"] for r in rows.groupBy("_votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = estimate(patterns)
    verdicts = json.dumps({pattern: model.good(pattern) for pattern in patterns})
    verdict = spark.range(1).select(
        F.explode(F.from_json(F.lit(verdicts), "map<string,double>")).alias("_votes", "_good")
    )
    failed = (F.col("_words") < LEAST_WORDS) | (100 * F.col("_repeats") > MOST_REPEATED * F.col("_words"))
    return rows.join(F.broadcast(verdict), "_votes", "left").withColumn("_failed", failed).withColumn(
        "_kept", ~F.col("_failed") & (F.col("_good") >= threshold)
    )


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, ...)."""
    return judged(docs.select("doc_id", "text"), carry=("doc_id",)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("_words").alias("n_words"),
        F.col("_letters").alias("word_chars"), F.col("_symbols").alias("n_symbols"),
        F.col("_dup_lines").alias("n_dup_lines"), F.col("_repeats").alias("n_repeat_words"),
        F.col("_failed").alias("base_failed"), F.col("_kept").alias("kept"),
        F.col("_votes").alias("votes"), F.round("_good", 6).alias("posterior"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``, whatever their names.

    A row travels as one struct, so no column of it can meet a statistic of the same name.
    """
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns))
    packed = docs.select(row.alias("row"), F.col("text"))
    return judged(packed, carry=("row",)).where("_kept").select("row.*")
