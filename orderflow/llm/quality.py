"""Quality rules that vote or abstain, combined by weak supervision.

Each rule looks at one statistic of a text and votes good (1) or bad (-1) or abstains (0). Nobody
says which rule is right: expectation-maximisation over the counts of vote patterns estimates how
often each rule casts each vote on good and on bad documents, and every document gets the
posterior probability that it is good. Before any vote good and bad are held for equally likely: defects are
rare and of many kinds, so a share estimated from them would outweigh a rule that is nearly never wrong. Only the counts of distinct vote patterns, at most
3 ** 8 rows whatever the input, reach the driver. Everything else is column expressions.

Defined results: a null or empty text has no words, fails the base rule and is not kept; repeated
rows are judged one by one, alike; an empty table gives an empty table; other columns are carried
unchanged whatever their names; nothing is read of a row but its text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import SPACES, packed, stored, text_of, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A share, SQL over the fields of ``s``: up to ``good`` a good vote, from ``bad`` on a bad one."""

    name: str
    part: str
    whole: str
    good: float
    bad: float


RULES = (
    Rule("symbols", "s.n_symbols", "s.n_words", 0.02, 0.2),
    Rule("repeated_words", "s.n_repeat_words", "s.n_words", 0.02, 0.2),
    Rule("repeated_lines", "s.n_dup_lines", "s.n_lines", 0.0, 0.3),
    Rule("capitals", "s.n_capitals", "s.n_letters", 0.15, 0.4),
    Rule("exclamations", "s.n_exclamations", "s.n_words", 0.02, 0.2),
    Rule("long_words", "s.word_chars", "s.n_words", 10.0, 20.0),
    Rule("non_letters", "s.word_chars - s.n_letters", "s.word_chars", 0.15, 0.55),
    Rule("unended_lines", "s.n_lines - s.n_ended_lines", "s.n_lines", 0.5, 0.95),
)


def text_statistics(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with a struct ``s`` of the statistics of ``text``.

    Repeated windows are found inside the row: window hashes are compared as a set, and only where
    that shows a repeat are they sorted with their positions. 64-bit hashes are compared within
    one text only.
    """
    carried = df.columns
    df = df.withColumn("t", text).withColumn("w", words_of(F.col("t")))
    window = ", ".join(f"w[i + {k}]" for k in range(WINDOW))
    last = WINDOW - 1
    df = df.withColumn(
        "h",
        F.expr(
            f"""if(size(w) > {last},
                   transform(sequence(0, size(w) - {WINDOW}), i -> xxhash64({window})),
                   cast(array() as array<bigint>))"""
        ),
    ).withColumn("l", F.expr(r"filter(split(t, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"))
    df = df.withColumn(
        "o",
        F.expr(
            """if(size(array_distinct(h)) < size(h),
                  sort_array(transform(h, (x, i) -> struct(x as x, i as i))), null)"""
        ),
    )
    df = df.withColumn(
        "p",
        F.expr(
            """sort_array(transform(filter(o, (v, j) ->
                   v.x <=> get(o, j - 1).x or v.x <=> get(o, j + 1).x), v -> v.i))"""
        ),
    )

    def without(characters: str, column: str = "t") -> str:
        return f"char_length(translate({column}, '{characters}', ''))"

    spaces = SPACES.encode("unicode_escape").decode().replace("\\x", "\\u00")
    statistics = F.expr(
        f"""named_struct(
            'n_words', cast(size(w) as bigint),
            'word_chars', cast({without(spaces)} as bigint),
            'n_symbols', cast(char_length(t) - {without(SYMBOLS)} as bigint),
            'n_dup_lines', cast(size(l) - size(array_distinct(l)) as bigint),
            'n_repeat_words', coalesce(aggregate(
                transform(p, (x, j) -> least({WINDOW}, coalesce(get(p, j + 1) - x, {WINDOW}))),
                cast(0 as bigint), (a, b) -> a + b), 0),
            'n_lines', size(l),
            'n_ended_lines', size(filter(l, x -> x rlike '[.!?:;]["\\')]*[\\\\x20\\\\x09-\\\\x0D]*$')),
            'n_exclamations', char_length(t) - {without("!")},
            'n_letters', char_length(regexp_replace(t, '[^\\\\p{{L}}]+', '')),
            'n_capitals', char_length(regexp_replace(t, '[^\\\\p{{Lu}}]+', '')))"""
    )
    return df.select(*[F.col(f"`{name}`") for name in carried], statistics.alias("s"))


def base_failed(s: str = "s") -> Column:
    """Under ten words, or over a fifth of the words in repeated windows."""
    return F.expr(f"{s}.n_words < 10 or 100 * {s}.n_repeat_words > 20 * {s}.n_words")


def votes(rules: tuple[Rule, ...] = RULES) -> Column:
    """The votes of all rules on the struct ``s``: an array of -1, 0 and 1.

    A rule whose whole is 0 abstains.
    """
    cast = []
    for rule in rules:
        share = f"try_divide(cast({rule.part} as double), cast({rule.whole} as double))"
        cast.append(
            f"case when {share} >= {rule.bad} then -1 when {share} <= {rule.good} then 1 else 0 end"
        )
    return F.expr(f"array({', '.join(cast)})")


@dataclass(frozen=True)
class VoteModel:
    """Per rule the share of each vote (-1, 0, 1) among good and among bad documents."""

    good: tuple[tuple[float, float, float], ...]
    bad: tuple[tuple[float, float, float], ...]

    def log_odds(self, pattern: list[int]) -> float:
        return sum(
            math.log(self.good[j][v + 1] / self.bad[j][v + 1])
            for j, v in enumerate(pattern)
            if v != 0
        )

    def posterior(self, votes_column: Column) -> Column:
        """The probability of a good document as a column expression; abstentions say nothing."""
        total = F.lit(0.0)
        for j, (good, bad) in enumerate(zip(self.good, self.bad, strict=True)):
            vote = votes_column[j]
            total = total + (
                F.when(vote == 1, math.log(good[2] / bad[2]))
                .when(vote == -1, math.log(good[0] / bad[0]))
                .otherwise(0.0)
            )
        return 1 / (1 + F.exp(-total))


def fit_votes(
    patterns: list[tuple[list[int], int]], rules: int, rounds: int = 50, smoothing: float = 1.0
) -> VoteModel:
    """Expectation-maximisation over counted vote patterns.

    It starts from the belief that a document with a bad vote is bad. An abstention is neither
    right nor wrong, so only votes enter the products. Counts are smoothed; with no documents at
    all the smoothing alone is left.
    """
    weight = [0.1 if -1 in pattern else 0.95 for pattern, _ in patterns]
    model = None
    for _ in range(rounds):
        shares = []
        for side in (1, 0):
            per_rule = []
            for j in range(rules):
                # Pseudo-counts say that a rule is more often right than wrong.
                counts = [smoothing * (0.1 if (v == 1) != bool(side) else 0.9) for v in (-1, 0, 1)]
                for w, (pattern, n) in zip(weight, patterns, strict=True):
                    counts[pattern[j] + 1] += (w if side else 1 - w) * n
                per_rule.append(tuple(c / sum(counts) for c in counts))
            shares.append(tuple(per_rule))
        model = VoteModel(*shares)
        weight = [1 / (1 + math.exp(-min(max(model.log_odds(p), -700), 700))) for p, _ in patterns]
    return model


def fit_from(scored: DataFrame, rules: tuple[Rule, ...] = RULES) -> VoteModel:
    """The model of a table with the struct ``s``; documents that fail the base rule don't count."""
    counted = (
        scored.filter(~base_failed())
        .groupBy(votes(rules).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    return fit_votes(sorted((list(r.v), r.n) for r in counted), len(rules))


def judge(documents: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: ``row`` (its columns), ``s``, ``base_failed``, ``posterior``, ``kept``.

    Rows and statistics are stored once: the model is fitted to them and they are then judged by it.
    """
    rows = packed(documents)
    scored = stored(text_statistics(rows, text_of(F.col("row").getField(text))).select("row", "s"), "quality")
    fitted = fit_from(scored)
    judged = scored.select("row", "s", base_failed().alias("base_failed"), votes().alias("v"))
    return judged.withColumn("posterior", fitted.posterior(F.col("v"))).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)
    )


def statistics_and_verdict(
    documents: DataFrame, key: str, text: str = "text", threshold: float = 0.5
) -> DataFrame:
    """``judge`` with a narrow result: only ``key`` is kept of a row."""
    rows = documents.select(F.col(key).alias("key"), text_of(text).alias("x"))
    scored = stored(text_statistics(rows, F.col("x")).select("key", "s"), "quality")
    fitted = fit_from(scored)
    judged = scored.select("key", "s", base_failed().alias("base_failed"), votes().alias("v"))
    return judged.withColumn("posterior", fitted.posterior(F.col("v"))).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)
    )


def keep_good(documents: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that are kept, with their columns as they were."""
    return judge(documents, text, threshold).filter("kept").select("row.*")
