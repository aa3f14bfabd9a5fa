"""Dialogues from the perspective of every participant.

A dialogue of several parties is rendered once for each of them: the turns of that speaker are the
assistant's, those of all others are a user's with the speaker's name, and only the assistant's words
are to be trained on. Turns of ``SYSTEM`` speakers set the scene; they are rendered as such and have no
perspective. The template of a turn is ``<|role|>`` or ``<|user name=...|>``, a line feed, the text,
``<|end|>`` and a line feed.

The masks are runs of code points [begin, end) of the dialogue that are trained on: the text of each
assistant turn with its end mark.

A dialogue comes in parts of ``PART`` turn numbers, numbered from 0 in order; nearly all have one. Where more than
``PART`` rows have their numbers in one such range (repeated or null numbers), it makes several parts of ``PART`` rows.
``offset`` is the place of a part's first code point in the dialogue, and masks count from the start of the part, so the
texts of the parts put together are the dialogue. So a dialogue of any length meets no single task whole: rows are
sorted over all tasks, equal ones too, and numbered by where they stand in their task and how many stand in
those before; texts are grouped by part, and only lengths and speakers of parts, not texts, by dialogue.

Defined results: turns of one number stand in the order of speaker and text; null turn numbers stand last, in
parts of their own; a null text is empty; a null speaker is the participant ``unknown``; null is a dialogue of
its own; repeated rows are turns of their own; a dialogue with system turns only has no rows; an empty table
gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderflow.llm.common import stored

SYSTEM = ("system",)
UNKNOWN = "unknown"
PART = 256
END = "<|end|>"


def perspectives(
    turns: DataFrame,
    dialogue: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    part_turns: int = PART,
) -> DataFrame:
    """One row per dialogue, speaker and part.

    Columns: the dialogue, ``perspective``, ``part``, ``offset``, ``n_turns``, ``text``, ``masks`` (an array of
    begin and end) and ``n_trained``, the code points to train on.
    """
    last = 1 << 62
    rows = turns.select(
        F.col(dialogue).alias("d"),
        F.coalesce(F.floor(F.col(turn) / part_turns).cast("long"), F.lit(last)).alias("p"),
        F.coalesce(F.col(turn).cast("long"), F.lit(last)).alias("n"),
        F.coalesce(F.col(speaker), F.lit(UNKNOWN)).alias("s"),
        F.coalesce(F.col(text), F.lit("")).alias("t"),
    )
    is_system = F.col("s").isin(*SYSTEM)
    turns = _numbered(rows, part_turns).select(
        "d", "p", "q", "n", "s", "t", "chars", F.char_length("s").alias("named"), is_system.alias("system")
    )
    # What a turn is long for others: '<|', name, '|>' and so on; for its speaker, 'assistant' replaces 'user name=' and the name.
    plain = F.col("chars") + F.col("named") + F.when(F.col("system"), 5).otherwise(15) + len(END) + 1
    lengths = turns.groupBy("d", "p", "q").agg(F.sum(plain).alias("length"))
    own = turns.groupBy("d", "p", "q", "s").agg(F.count(F.lit(1)).alias("spoken"))
    speakers = rows.filter(~is_system).select(F.col("d").alias("own"), F.col("s").alias("me")).distinct()
    wanted = lengths.join(speakers, F.col("d").eqNullSafe(F.col("own"))).drop("own")
    own = own.select(F.col("d").alias("own"), F.col("p").alias("p2"), F.col("q").alias("q2"), F.col("s").alias("s2"), "spoken")
    same = [F.col("d").eqNullSafe(F.col("own")), *(F.col(x) == F.col(y) for x, y in (("p", "p2"), ("q", "q2")))]
    saved = F.coalesce("spoken", F.lit(0)) * (F.char_length("me") + 1)
    order = W.partitionBy("d", "me").orderBy("p", "q")
    earlier = F.sum("length").over(order.rowsBetween(W.unboundedPreceding, -1))
    places = (
        wanted.join(own, [*same, F.col("me") == F.col("s2")], "left")
        .select("d", "p", "q", "me", (F.col("length") - saved).alias("length"))
        .select(
            F.col("d").alias("own"), F.col("p").alias("p2"), F.col("q").alias("q2"), "me",
            (F.row_number().over(order) - 1).alias("part"),
            F.coalesce(earlier, F.lit(0)).cast("long").alias("offset"),
        )
    )
    parts = turns.groupBy("d", "p", "q").agg(F.sort_array(F.collect_list(F.struct("n", "s", "t"))).alias("turns"))
    is_system = " or ".join(f"x.s = '{name}'" for name in SYSTEM)
    rendered = (
        parts.join(places, same)
        .withColumn(
            "heads",
            F.expr(
                f"""transform(turns, x -> case when {is_system} then concat('<|', x.s, '|>\\n')
                    when x.s = me then '<|assistant|>\\n'
                    else concat('<|user name=', x.s, '|>\\n') end)"""
            ),
        )
        .withColumn("bodies", F.expr(f"transform(turns, x -> concat(x.t, '{END}'))"))
        .withColumn(
            "ends",
            F.expr(
                """transform(heads, (h, i) -> char_length(h) + char_length(bodies[i]) + 1)"""
            ),
        )
        .select(
            "d",
            "me",
            "part",
            "offset",
            F.size("turns").alias("n_turns"),
            F.expr("array_join(transform(heads, (h, i) -> concat(h, bodies[i], '\\n')), '')").alias("text"),
            # Running sums of the lengths, made once per part.
            F.expr(
                """aggregate(ends, array(0), (a, e) -> array_append(a, element_at(a, -1) + e))"""
            ).alias("begins"),
            "heads",
            "bodies",
            F.expr("transform(turns, x -> x.s = me)").alias("mine"),
        )
        .withColumn(
            "masks",
            F.expr(
                """filter(transform(mine, (m, i) -> if(m, named_struct(
                       'begin', begins[i] + char_length(heads[i]),
                       'end', begins[i] + char_length(heads[i]) + char_length(bodies[i])), null)),
                   x -> x is not null)"""
            ),
        )
    )
    return rendered.select(
        F.col("d").alias(dialogue),
        F.col("me").alias("perspective"),
        "part",
        "offset",
        "n_turns",
        "text",
        "masks",
        F.expr("cast(aggregate(masks, 0, (a, m) -> a + m.end - m.begin) as bigint)").alias("n_trained"),
    )


def _numbered(rows: DataFrame, part_turns: int) -> DataFrame:
    """``rows`` (d, p, n, s, t) with ``chars``, the length of the text, and ``q``: the how-manieth ``part_turns`` rows of (d, p).

    Equal rows are told apart by ``copy``, so a row that is repeated often is dealt to several tasks as well.
    """
    keys = ["d", "p", "n", "s", "t", "copy"]
    dealt = rows.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*keys)
    dealt = dealt.sortWithinPartitions(*keys).drop("copy").withColumn("chars", F.char_length("t"))
    dealt = stored(dealt.withColumn("at", F.monotonically_increasing_id()), "turns")
    dealt = dealt.withColumn("task", F.shiftright("at", 33))
    runs = dealt.groupBy("d", "p", "task").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n_rows"))
    earlier = F.sum("n_rows").over(W.partitionBy("d", "p").orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    runs = runs.select(
        F.col("d").alias("d2"), F.col("p").alias("p2"), F.col("task").alias("task2"), "first",
        F.coalesce(earlier, F.lit(0)).alias("before"),
    )
    same = [F.col("d").eqNullSafe(F.col("d2")), F.col("p") == F.col("p2"), F.col("task") == F.col("task2")]
    place = F.col("before") + F.col("at") - F.col("first")
    return dealt.join(runs, same).withColumn("q", F.floor(place / part_turns).cast("long")).drop("d2", "p2", "task2")
