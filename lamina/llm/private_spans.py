"""Personal data by weak supervision, with DataFrame functions only.

Regular expressions propose candidate spans. Labelers (form, check digits, gazetteers, context,
boundary) vote on each; expectation-maximisation over the vote patterns of the whole corpus estimates
how reliable each labeler is, kind by kind. A logistic span classifier, trained on the resulting
posteriors, then decides about candidates that the base rules do not already keep.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.session import shared_folder

# Kinds in their order, expressions, and the lists of the gazetteer and context labelers.
# \G and the look-behind only keep a failed run of characters from being tried again inside. A repeated group
# takes one character and looks back at what must not stand together: the engine repeats groups of fixed length
# in a loop, others by a call for each, which runs out of stack on long runs.
CANDIDATES = {
    "email": (
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])"
        r"[A-Za-z0-9-](?:[A-Za-z0-9.-](?<!\.\.))+(?<!\.)"
    ),
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9](?:[0-9\x20-](?<![\x20-][\x20-]))+(?<=[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "name": r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Sra?)\.?\x20\p{Lu}\p{Ll}+",
}
#: What a text must hold for a candidate to be possible; a plain search is cheaper than the expression.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-", "name": " "}
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = tuple(CANDIDATES)
BASE_RULES = {
    "email": "true",
    "ip": r"m RLIKE '^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$'",
    "card": "length(d) BETWEEN 13 AND 19 AND luhn_check(d)",
    "phone": "length(d) BETWEEN 9 AND 15",
    "ssn": "false",
    "name": "false",
}
#: Labeler: kind: (SQL for private, SQL for not private) over m (match), d (its digits), b and a (text
#: before and after). What is neither, or has no entry, is an abstention.
LABELERS = {
    "form": {
        "email": (r"m RLIKE '\\.[A-Za-z]{2,24}$'", r"m RLIKE '\\.[0-9]+$'"),
        "ip": (r"NOT m RLIKE '(^|\\.)0[0-9]'", r"m RLIKE '(^|\\.)0[0-9]'"),
        "card": ("length(d) BETWEEN 13 AND 16", "length(d) < 13 OR length(d) > 19"),
        "phone": ("length(d) BETWEEN 10 AND 13", "length(d) < 9 OR length(d) > 15"),
        "ssn": ("NOT m RLIKE '^(000|666|9)' AND NOT m RLIKE '-00-'", "m RLIKE '^(000|666|9)' OR m RLIKE '-00-'"),
        "name": ("length(m) > 6", "length(m) <= 5"),
    },
    "check": {
        "ip": (BASE_RULES["ip"], f"NOT ({BASE_RULES['ip']})"),
        "card": ("luhn_check(d)", "NOT luhn_check(d)"),
        "phone": (BASE_RULES["phone"], f"NOT ({BASE_RULES['phone']})"),
    },
    "gazetteer": {
        "email": (r"lower(m) RLIKE '@(gmail|yahoo|hotmail|outlook|icloud|gmx|web|orange|proton)[.]|[.](com|org|net|edu|de|fr|es|uk)$'", r"lower(m) RLIKE '[.](png|jpg|gif|js|css|py)$'"),
        "ip": (r"false", r"m RLIKE '^(0|127)[.]'"),
        "card": (r"d RLIKE '^(4|5[1-5]|2[2-7]|34|37|6011|65|35|36|30)'", r"NOT d RLIKE '^[2-6]'"),
        "phone": (r"d RLIKE '^(1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])'", "d LIKE '0%'"),
        "name": (r"m RLIKE ' (James|Mary|John|Anna|Peter|Paul|Maria|Michael|Thomas|Laura|Pierre|Marie|Hans|Klaus|Carlos|Ana)$'", "false"),
    },
    "context": {
        "email": (r"lower(b) RLIKE '(e-?mail|contact|write|mailto|kontakt|correo|courriel)'", "false"),
        "ip": (r"lower(b) RLIKE '(ip|host|server|address|login|from)\\W*$'", r"lower(b) RLIKE '(version|release|section|v)\\W*$'"),
        "card": (r"lower(b) RLIKE '(card|visa|master|credit|karte|carte|tarjeta)'", r"lower(b) RLIKE '(isbn|order|invoice|serial|hash|id)\\W*$'"),
        "phone": (r"lower(b) RLIKE '(phone|tel|call|fax|mobile|telefon)'", "false"),
        "ssn": (r"lower(b) RLIKE '(ssn|social)'", r"lower(b) RLIKE '(part|order|item|isbn)'"),
        "name": (r"lower(b) RLIKE '(name|contact|patient|dear|signed)'", "false"),
    },
    "boundary": {
        kind: (r"NOT b RLIKE '[A-Za-z0-9]$' AND NOT a RLIKE '^[A-Za-z0-9]'", r"b RLIKE '[A-Za-z0-9]$' OR a RLIKE '^[A-Za-z0-9]'")
        for kind in KINDS
    },
}
#: Labelers whose reliability is known by construction: how often they say yes to private and to other
#: spans. Check digits hold in every real card number and in one of ten others.
KNOWN = {("check", "card"): (0.995, 0.1)}
CONTEXT = 24
YES, NO, ABSTAIN = "y", "n", "-"


def _of_kind(kind: str, found: str, between: str) -> str:
    """SQL for the candidates of a kind, ascending, from matches and the text between them.

    Places count code points. One pass over the matches of a row; texts without one end at once.
    """
    votes = []
    for rules in LABELERS.values():
        yes, no = rules.get(kind, ("false", "false"))
        votes.append(f"CASE WHEN {no} THEN '{NO}' WHEN {yes} THEN '{YES}' ELSE '{ABSTAIN}' END")

    places = (
        f"aggregate(sequence(0, size({found}) - 1), named_struct('at', 0, 'out', cast(array() AS"
        f" array<struct<s:int,m:string,d:string,b:string,a:string>>)), (x, i) -> named_struct("
        f"'at', x.at + length({between}[i]) + length({found}[i]), 'out', array_append(x.out, named_struct("
        f"'s', x.at + length({between}[i]), 'm', {found}[i], 'd', regexp_replace({found}[i], '[^0-9]', ''),"
        f" 'b', right({between}[i], {CONTEXT}), 'a', left({between}[i + 1], 1)))), x -> x.out)"
    )
    # Rules are written over plain names; within the lambda they are fields of c.
    rule = _fields(BASE_RULES[kind])
    pattern = "concat(" + ", ".join(_fields(v) for v in votes) + ")"
    return (
        f"CASE WHEN size({found}) = 0 THEN cast(array() AS"
        f" array<struct<kind:string,start:int,end:int,content:string,base:boolean,votes:string>>)"
        f" ELSE transform({places}, c -> named_struct('kind', '{kind}', 'start', c.s, 'end', c.s + length(c.m),"
        f" 'content', c.m, 'base', coalesce({rule}, false), 'votes', {pattern})) END"
    )


def _fields(sql: str) -> str:
    """The SQL with the bare names m, d, b and a as fields of c; text in quotes stays."""
    parts = sql.split("'")
    for k in range(0, len(parts), 2):
        words = parts[k].replace("(", " ( ").replace(")", " ) ").split(" ")
        parts[k] = " ".join(f"c.{w}" if w in ("m", "d", "b", "a") else w for w in words)
    return "'".join(parts)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, found array<struct<kind, start, end, content, base, votes>>), row by row, no shuffle.

    Null and empty texts have no candidates; null doc_ids and repeated rows are kept. Candidates
    stand in the order of their kinds, then by start.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"),
    )
    none = F.lit(None).cast("array<string>")
    matches = {}
    for kind, pattern in CANDIDATES.items():
        listed = F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))
        need = F.contains("_text", F.lit(NEEDS[kind])) if kind in NEEDS else F.col("_text").rlike("[0-9]")
        matches[f"_m_{kind}"] = F.when(need, listed).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumns(matches)
    rows = rows.withColumns(
        {
            f"_p_{kind}": F.when(F.size(f"_m_{kind}") > 0, F.split("_text", pattern, -1)).otherwise(none)
            for kind, pattern in CANDIDATES.items()
        }
    )
    return rows.select(
        "doc_id", F.concat(*(F.expr(_of_kind(k, f"_m_{k}", f"_p_{k}")) for k in KINDS)).alias("found")
    )


def reliabilities(counts: dict[tuple[str, str], int], rounds: int = 40, smoothing: float = 1.0) -> dict:
    """Posterior of being private for each (kind, votes), by expectation-maximisation per kind.

    It starts from the share of yes among the votes cast, or where a labeler's reliability is known from
    that labeler alone. Other labelers are taken to be right more often than not; abstaining says nothing.
    Labelers that look at the same trait agree on right and wrong spans alike, so votes alone may rate
    the one good labeler as the odd one out; the known one keeps its weight. The number of patterns is bounded by kinds * 3 ** labelers.
    """
    posterior = {}
    for kind in KINDS:
        patterns = {votes: n for (k, votes), n in counts.items() if k == kind}
        guess = {v: (v.count(YES) + 0.5) / (v.count(YES) + v.count(NO) + 1) for v in patterns}
        known = {k: KNOWN[name, kind] for k, name in enumerate(LABELERS) if (name, kind) in KNOWN}
        for k, (given_private, given_not) in known.items():
            sure = {YES: given_private / (given_private + given_not), NO: (1 - given_private) / (2 - given_private - given_not)}
            guess = {v: sure.get(v[k], p) for v, p in guess.items()}
        for _ in range(rounds):
            mass = sum(guess[v] * n for v, n in patterns.items()) + smoothing
            total = sum(patterns.values()) + 2 * smoothing
            right = []
            for k in range(len(LABELERS)):
                hit, miss = [2 * smoothing, smoothing], [smoothing, 2 * smoothing]
                for v, n in patterns.items():
                    if v[k] != ABSTAIN:
                        side = hit if v[k] == YES else miss
                        side[0] += n * guess[v]
                        side[1] += n * (1 - guess[v])
                yes = (hit[0] / (hit[0] + miss[0]), hit[1] / (hit[1] + miss[1]))
                right.append(known.get(k, (max(yes[0], 0.5), min(yes[1], 0.5))))
            for v in patterns:
                odds = np.log(mass / (total - mass))
                for vote, (given_private, given_not) in zip(v, right):
                    if vote == YES:
                        odds += np.log(given_private / given_not)
                    elif vote == NO:
                        odds += np.log((1 - given_private) / (1 - given_not))
                guess[v] = float(1 / (1 + np.exp(-np.clip(odds, -30, 30))))
        posterior |= {(kind, v): p for v, p in guess.items()}
    return posterior


def classifier(counts: dict[tuple[str, str], int], posterior: dict, rounds: int = 25, ridge: float = 1.0) -> dict:
    """Probability of each (kind, votes) by a logistic model trained on the posteriors, all spans counted.

    Features: kind, and each labeler's vote of yes or no within the kind. Newton steps on the counted
    patterns, so the work is bounded whatever the corpus.
    """
    keys = sorted(counts)
    if not keys:
        return {}
    names = {}
    rows = []
    for kind, votes in keys:
        listed = [("kind", kind), *((k, kind, v) for k, v in enumerate(votes) if v != ABSTAIN)]
        rows.append([names.setdefault(name, len(names)) for name in listed])
    design = np.zeros((len(keys), len(names)))
    for k, row in enumerate(rows):
        design[k, row] = 1
    n = np.array([counts[key] for key in keys], float)
    target = np.array([posterior[key] for key in keys])
    weights = np.zeros(len(names))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (n * (target - p)) - ridge * weights
        curve = (design.T * (n * p * (1 - p))) @ design + ridge * np.eye(len(names))
        weights = weights + np.clip(np.linalg.solve(curve, slope), -4, 4)
    p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
    return dict(zip(keys, p.tolist()))


def find(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, found array<struct<kind, start, end, content, base, votes, probability, kept>>).

    ``base`` spans are always kept; of the other candidates, those the classifier gives at least
    ``threshold``. Candidates are written once to the shared folder; only counts of vote patterns
    (at most kinds * 3 ** labelers) come to the driver. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "spans")
    candidates(docs).write.parquet(folder)
    rows = spark.read.parquet(folder)
    counted = rows.select(F.explode("found").alias("f")).groupBy("f.kind", "f.votes").agg(F.count(F.lit(1)).alias("n"))
    # Bounded: one row per kind and pattern of votes.
    counts = {(r["kind"], r["votes"]): r["n"] for r in counted.collect()}
    model = classifier(counts, reliabilities(counts))
    table = json.dumps({f"{kind} {votes}": round(p, 6) for (kind, votes), p in model.items()})
    scored = "coalesce(try_element_at(model, concat(f.kind, ' ', f.votes)), 0D)"
    return rows.withColumn("model", F.from_json(F.lit(table), "map<string,double>")).selectExpr(
        "doc_id",
        "transform(found, f -> named_struct('kind', f.kind, 'start', f.start, 'end', f.end, 'content', f.content,"
        f" 'base', f.base, 'votes', f.votes, 'probability', {scored},"
        f" 'kept', f.base OR {scored} >= {threshold})) AS found",
    )


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) from :func:`find`."""
    joined = "array_join(transform(filter(found, f -> f.{0}), f -> concat_ws(':', f.kind, f.start, f.end)), ',')"
    return find(docs).selectExpr(
        "doc_id",
        *(f"cast(size(filter(found, f -> f.base AND f.kind = '{k}')) AS long) AS n_{k}" for k in BASE_KINDS),
        f"sha2({joined.format('base')}, 256) AS base_sha256", f"{joined.format('kept')} AS spans",
    )
