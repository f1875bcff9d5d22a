"""Chat preference formatting: shared prompt once, then two masked completions.

A pair is two conversations, one chosen and one rejected. Their longest common prefix of turns is the
prompt; what follows in each is its completion, in which only the assistant's turns are learned from.
DataFrame functions only: turns are gathered per conversation, pairs are joined by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How a turn is written, and whose turns are learned from.
TURN_OPEN, TURN_MIDDLE, TURN_CLOSE = "<|", "|>\n", "<|end|>\n"
LEARNED = "assistant"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<turn, role, text>>), ascending by turn.

    Null roles and texts count as empty. Rows without conv_id or turn cannot be placed and are left
    out; repeated rows count once, two different rows of one turn stand in the order of role and text.
    A conversation is one document: its turns are gathered in one row.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    ).where("conv_id IS NOT NULL AND t.turn IS NOT NULL")
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_set("t")).alias("turns"))


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(TURN_OPEN), turn["role"], F.lit(TURN_MIDDLE), turn["text"], F.lit(TURN_CLOSE))


def joined_text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def mask(turns: Column) -> Column:
    """"start:end" of each learned stretch in the rendered turns, comma-joined, in code points.

    A learned stretch is an assistant's text with the mark that ends its turn.
    """
    opened = F.lit(len(TURN_OPEN) + len(TURN_MIDDLE))
    closed = F.lit(len(TURN_CLOSE))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + opened + F.length(turn["role"])
        end = begin + F.length(turn["text"]) + closed
        one = F.concat_ws(":", begin, end)
        more = F.when(state["out"] == "", one).otherwise(F.concat_ws(",", state["out"], one))
        return F.struct(end.alias("at"), F.when(turn["role"] == LEARNED, more).otherwise(state["out"]).alias("out"))

    return F.aggregate(turns, start, step, lambda state: state["out"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Adds n_prefix, prompt, chosen, rejected, chosen_mask, rejected_mask to (..., chosen, rejected) turns.

    ``chosen_turns`` and ``rejected_turns`` are arrays of turns; a null one is empty. Turns are equal if role
    and text are, so the prefix does not depend on how turns are numbered. Of two equal
    conversations all is prompt and both completions are empty.
    """
    none = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    sides = pairs.withColumns({c: F.coalesce(c, none) for c in ("chosen_turns", "rejected_turns")})
    same = F.zip_with(
        "chosen_turns", "rejected_turns",
        lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)),
    )
    first = F.array_position(same, F.lit(False))
    sides = sides.withColumn("n_prefix", F.when(first == 0, F.size("chosen_turns")).otherwise(first - 1).cast("int"))
    rest = {
        f"_{c}": F.slice(f"{c}_turns", F.col("n_prefix") + 1, F.greatest(F.size(f"{c}_turns") - F.col("n_prefix"), F.lit(0)))
        for c in ("chosen", "rejected")
    }
    return sides.withColumns(rest).select(
        *(c for c in pairs.columns if c not in ("chosen_turns", "rejected_turns")),
        "n_prefix",
        joined_text(F.slice("chosen_turns", F.lit(1), F.col("n_prefix"))).alias("prompt"),
        joined_text(F.col("_chosen")).alias("chosen"), joined_text(F.col("_rejected")).alias("rejected"),
        mask(F.col("_chosen")).alias("chosen_mask"), mask(F.col("_rejected")).alias("rejected_mask"),
    )


def with_other_replies(turns: DataFrame) -> DataFrame:
    """(conv_id, chosen_turns, rejected_turns): every conversation against one with a foreign reply.

    The table holds no preferences, so each conversation is the chosen one of a pair, and the rejected
    one is the same conversation with its last assistant turn replaced by that of its partner, the
    conversation whose id differs in the last bit. Every conversation with an assistant turn takes part; without a
    partner's reply the rejected conversation ends before the turn. One join by key, each key once
    on either side, so no conversation is paired with many.
    """
    whole = conversations(turns)
    replies = F.filter("turns", lambda t: t["role"] == LEARNED)
    last = F.when(F.size(replies) > 0, F.element_at(replies, -1))
    own = whole.withColumn("_last", last).where("_last IS NOT NULL")
    other = own.select(F.expr("conv_id ^ 1").alias("conv_id"), F.col("_last").alias("_theirs"))
    changed = F.transform(
        F.filter("turns", lambda t: (t != F.col("_last")) | F.col("_theirs").isNotNull()),
        lambda t: F.when(
            t == F.col("_last"),
            F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.col("_theirs")["text"].alias("text")),
        ).otherwise(t),
    )
    return own.join(other, "conv_id", "left").select("conv_id", F.col("turns").alias("chosen_turns"), changed.alias("rejected_turns"))


def preference_examples(turns: DataFrame) -> DataFrame:
    """(conv_id, n_prefix, prompt, chosen, rejected, chosen_mask, rejected_mask) of a whole table."""
    return format_pairs(with_other_replies(turns))


#: The same for an independent engine.
ORACLE = """
WITH rows AS (
  SELECT DISTINCT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role,
         coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM rows),
replies AS (SELECT conv_id, max(n) AS n_last, max_by(text, n) AS reply FROM placed WHERE role = 'assistant' GROUP BY conv_id),
paired AS (
  SELECT p.conv_id, p.n, p.role, p.text, r.n_last, o.reply IS NOT NULL AS answered, o.reply,
         p.n = r.n_last AS is_last
  FROM placed p JOIN replies r ON p.conv_id = r.conv_id LEFT JOIN replies o ON o.conv_id = xor(p.conv_id, 1)),
prefixed AS (
  SELECT *, CASE WHEN NOT coalesce(bool_or(is_last AND (NOT answered OR reply <> text)) OVER (PARTITION BY conv_id), false)
                 THEN count(*) OVER (PARTITION BY conv_id) ELSE n_last - 1 END AS n_prefix
  FROM paired),
sides AS (
  SELECT conv_id, n, role, text, n_prefix, 'chosen' AS side FROM prefixed
  UNION ALL
  SELECT conv_id, n, role, CASE WHEN is_last THEN reply ELSE text END, n_prefix, 'rejected' FROM prefixed
  WHERE NOT is_last OR answered),
shown AS (SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown FROM sides),
counted AS (
  SELECT *, coalesce(sum(length(shown)) FILTER (n > n_prefix) OVER (
    PARTITION BY conv_id, side ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM shown)
SELECT conv_id, CAST(max(n_prefix) AS INT) AS n_prefix,
  coalesce(string_agg(shown, '' ORDER BY n) FILTER (n <= n_prefix AND side = 'chosen'), '') AS prompt,
  coalesce(string_agg(shown, '' ORDER BY n) FILTER (n > n_prefix AND side = 'chosen'), '') AS chosen,
  coalesce(string_agg(shown, '' ORDER BY n) FILTER (n > n_prefix AND side = 'rejected'), '') AS rejected,
  coalesce(string_agg(CAST(ahead + 5 + length(role) AS BIGINT) || ':' || CAST(ahead + length(shown) AS BIGINT), ',' ORDER BY n)
    FILTER (n > n_prefix AND side = 'chosen' AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(CAST(ahead + 5 + length(role) AS BIGINT) || ':' || CAST(ahead + length(shown) AS BIGINT), ',' ORDER BY n)
    FILTER (n > n_prefix AND side = 'rejected' AND role = 'assistant'), '') AS rejected_mask
FROM counted GROUP BY conv_id
"""
