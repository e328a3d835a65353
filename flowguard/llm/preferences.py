"""Preference pairs of conversations as a common prompt and two masked completions.

The prompt is the longest common prefix, turn by turn (role and text), of the chosen and the
rejected conversation, rendered once; the completions are the turns after it. A mask lists the
character spans of a completion that count for the loss: text and end mark of its assistant
turns, without the header.

Defined results: a null text is an empty one and a null role is 'user'; turns stand in the order
of their number, then role and text, a null number first; repeated turns are kept; rows without
a conversation id belong to none; conversations that are equal, or one a prefix of the other,
give empty completions and ``differs`` tells whether the two completions do; an empty table gives
an empty table. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import let

ASSISTANT = "assistant"
END = "<|end|>\n"


def header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def rendered(turn: Column) -> Column:
    return F.concat(header(turn), turn["text"], F.lit(END))


def rendered_all(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def spans(turns: Column) -> Column:
    """Spans (start, end) of the assistant turns in the rendered turns."""
    def over(ends: Column) -> Column:
        every = F.transform(turns, lambda t, i: F.struct(
            (F.when(i > 0, F.get(ends, i - 1)).otherwise(0) + F.length(header(t))).cast("long").alias("start"),
            F.get(ends, i).cast("long").alias("end"), (t["role"] == ASSISTANT).alias("own")))
        return F.transform(F.filter(every, lambda s: s["own"]), lambda s: F.struct(s["start"], s["end"]))

    sizes = F.transform(turns, lambda t: F.length(rendered(t)).cast("long"))
    running = F.aggregate(sizes, F.array().cast("array<bigint>"),
                          lambda a, n: F.concat(a, F.array(F.coalesce(F.element_at(F.when(F.size(a) > 0, a), -1), F.lit(0)) + n)))
    return let(running, over)


def common_turns(a: Column, b: Column) -> Column:
    m = F.least(F.size(a), F.size(b))
    same = F.transform(F.slice(a, F.lit(1), m), lambda t, i: t.eqNullSafe(F.get(b, i)))
    return F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, m).cast("int")


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """conv_id and its turns, an array of (role, text)."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("user")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return turns.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("conv_id")) \
                .agg(F.sort_array(F.collect_list(turn)).alias("t")) \
                .select("conv_id", F.transform("t", lambda t: F.struct(t["role"], t["text"])).alias("turns"))


def retold(talks: DataFrame) -> DataFrame:
    """Pairs from one conversation each: as it is, and with its last assistant turn saying what
    its first one said."""
    place = F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == ASSISTANT, i)), lambda i: i.isNotNull())
    first, last = F.element_at("own", 1), F.element_at("own", -1)
    worse = F.transform("turns", lambda t, i: F.when(i == last, F.struct(t["role"], F.get("turns", first)["text"].alias("text")))
                        .otherwise(t))
    return talks.withColumn("own", place).filter(F.size("own") > 1).select(
        F.concat(F.lit("own-"), F.col("conv_id").cast("string")).alias("pair_id"), F.col("turns").alias("chosen"),
        worse.alias("rejected"))


def neighbours(talks: DataFrame) -> DataFrame:
    """Pairs of the conversations 2k (chosen) and 2k + 1 (rejected)."""
    k = F.floor(F.col("conv_id") / 2)
    a = talks.filter("conv_id % 2 = 0").select(k.alias("k"), F.col("turns").alias("chosen"))
    b = talks.filter("conv_id % 2 <> 0").select(k.alias("k"), F.col("turns").alias("rejected"))
    return a.join(b, "k").select(F.concat(F.lit("next-"), F.col("k").cast("string")).alias("pair_id"), "chosen", "rejected")


def format_preferences(pairs: DataFrame) -> DataFrame:
    """pair_id, n_common, differs, prompt, and for chosen and rejected the completion and its mask.
    ``pairs``: pair_id, chosen and rejected, arrays of (role, text)."""
    n = F.col("n_common")
    rest = lambda c: F.slice(c, n + 1, F.greatest(F.size(c) - n, F.lit(0)))
    step = pairs.withColumn("n_common", common_turns(F.col("chosen"), F.col("rejected"))).select(
        "pair_id", "n_common", F.slice("chosen", F.lit(1), n).alias("shared"), rest("chosen").alias("a"), rest("rejected").alias("b"))
    return step.select("pair_id", "n_common", (F.col("a") != F.col("b")).alias("differs"), rendered_all(F.col("shared")).alias("prompt"),
                       rendered_all(F.col("a")).alias("chosen"), spans(F.col("a")).alias("chosen_mask"),
                       rendered_all(F.col("b")).alias("rejected"), spans(F.col("b")).alias("rejected_mask"))
