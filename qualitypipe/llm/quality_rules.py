"""Quality rules by weak supervision: rules vote or abstain, EM estimates how far to trust them, a posterior decides.

Each rule looks at one measure of a text and says good (1), bad (-1) or nothing (0). Expectation-maximisation over the table of
vote patterns, at most 3 to the number of rules, estimates for each rule how often it says good and bad about good
and about bad texts, and how many texts are good. A text is kept if its posterior probability of being good is 0.5 or more.
Everything on the rows is DataFrame functions.

Defined results: a null text counts as empty; it has no words, so rules on shares abstain. Without rows
the rules keep their starting accuracies. Long texts are measured whole, within their row. Repeated rows each get their row. Only id
and text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitypipe.llm.shared import written

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with counts of words, symbols, repetition, lines, capitals and marks of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACE, "") != "")
    texts = docs.select(*keep, text.alias("_text"), words.alias("_words"), lines.alias("_lines"))
    word = F.col("_words")
    windows = F.transform(
        F.sequence(F.lit(0), F.size(word) - 3), lambda i: F.struct(F.xxhash64(word[i], word[i + 1], word[i + 2]).alias("h"), i.alias("i"))
    )
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    length = F.length("_text")
    counted = texts.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", SPACE, "")).cast("long").alias("word_chars"),
        (length - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
        F.length(F.regexp_replace("_text", "[^\\p{Lu}]+", "")).cast("long").alias("n_capitals"),
        (length - F.length(F.translate("_text", "!", ""))).cast("long").alias("n_shouts"),
        (length - F.length(F.translate("_text", "|", ""))).cast("long").alias("n_bars"),
        # sorted by content, so that equal windows are neighbours
        F.when(F.size("_words") >= 3, F.sort_array(windows)).otherwise(empty).alias("_windows"),
    )
    w = F.col("_windows")
    twice = F.filter(
        w,
        lambda x, i: F.coalesce(F.get(w, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(w, i + 1)["h"] == x["h"], F.lit(False)),
    )
    placed = counted.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(a["end"], i)).alias("n"), (i + 3).alias("end")),
        lambda a: a["n"],
    )
    return placed.withColumn("n_repeat_words", covered.cast("long")).drop("_windows", "_at")


@dataclass(frozen=True)
class VotingRule:
    name: str
    vote: Column


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def default_rules() -> list[VotingRule]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    some = F.col("n_words") >= 10
    mean = F.col("word_chars") / n
    symbols, shouts, bars = F.col("n_symbols") / n, F.col("n_shouts") / n, F.col("n_bars") / n
    repeated, lines = F.col("n_repeat_words") / n, F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    capitals, distinct = F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)), F.col("n_distinct") / n
    return [
        VotingRule("length", _vote(F.col("n_words") >= 50, F.col("n_words") < 5)),
        VotingRule("word_length", _vote(some & mean.between(3, 12), some & ((mean < 2) | (mean > 20)))),
        VotingRule("symbols", _vote(some & (symbols < 0.05), some & (symbols > 0.3))),
        VotingRule("shouting", _vote(some & (shouts < 0.05), some & (shouts > 0.3))),
        VotingRule("bars", _vote(some & (bars < 0.05), some & (bars > 0.2))),
        VotingRule("repetition", _vote(some & (repeated < 0.2), some & (repeated > 0.35))),
        VotingRule("lines", _vote((F.col("n_lines") > 0) & (lines < 0.1), lines > 0.3)),
        VotingRule("capitals", _vote(some & (capitals < 0.15), some & (capitals > 0.35))),
        VotingRule("variety", _vote(some & (distinct > 0.3), (F.col("n_words") >= 50) & (distinct < 0.1))),
    ]


@dataclass
class Trust:
    """Share of good texts; for each rule, how often it says good when it votes, on good and on bad texts."""

    good: float
    on_good: list[float]
    on_bad: list[float]


def start(n: int) -> Trust:
    return Trust(0.8, [0.95] * n, [0.6] * n)


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], int]], n: int, rounds: int = 50) -> Trust:
    """patterns: votes and how many texts cast them. Bounded so that a rule never speaks against itself."""
    trust = start(n)
    total = sum(count for _, count in patterns)
    if not total:
        return trust
    for _ in range(rounds):
        good_mass = 0.0
        says = [[1.0, 2.0, 1.0, 2.0] for _ in range(n)]  # good and votes on good, good and votes on bad texts, smoothed
        for votes, count in patterns:
            p = posterior(trust, votes)
            good_mass += p * count
            for j, vote in enumerate(votes):
                if vote:
                    says[j][0] += (vote > 0) * p * count
                    says[j][1] += p * count
                    says[j][2] += (vote > 0) * (1 - p) * count
                    says[j][3] += (1 - p) * count
        on_good = [min(0.999, max(0.5, s[0] / s[1])) for s in says]
        on_bad = [min(s[2] / s[3], g - 0.001) for s, g in zip(says, on_good, strict=True)]
        trust = Trust(min(0.99, max(0.01, good_mass / total)), on_good, [max(0.001, b) for b in on_bad])
    return trust


def weights(trust: Trust) -> tuple[float, list[tuple[float, float]]]:
    """Log-odds of a good text before any vote, and what a vote for good or bad adds for each rule."""
    each = [(math.log(g / b), math.log((1 - g) / (1 - b))) for g, b in zip(trust.on_good, trust.on_bad, strict=True)]
    return math.log(trust.good / (1 - trust.good)), each


def posterior(trust: Trust, votes: tuple[int, ...]) -> float:
    constant, each = weights(trust)
    odds = constant + sum(w[0] if v > 0 else w[1] if v < 0 else 0.0 for v, w in zip(votes, each, strict=True))
    return 1 / (1 + math.exp(-odds))


def judge(docs: DataFrame, keep: list[str], rules: list[VotingRule] | None = None) -> DataFrame:
    """The columns ``keep`` with the base counts, ``base_failed``, ``p_good`` and ``kept``."""
    rules = default_rules() if rules is None else rules
    if len(rules) > 10:
        raise ValueError("more than 10 rules: vote patterns must stay few")
    measured = written(measures(docs, keep), "measures")
    voted = measured.withColumns({f"_v{j}": r.vote for j, r in enumerate(rules)})
    names = [f"_v{j}" for j in range(len(rules))]
    # at most 3 ** 10 rows come back
    patterns = [(tuple(row[:-1]), row[-1]) for row in voted.groupBy(*names).count().collect()]
    constant, each = weights(expectation_maximisation(sorted(patterns), len(rules)))
    odds = F.lit(constant)
    for name, (good, bad) in zip(names, each, strict=True):
        odds = odds + F.when(F.col(name) > 0, good).when(F.col(name) < 0, bad).otherwise(0.0)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    p_good = 1 / (1 + F.exp(-odds))
    judged = voted.select(*keep, *BASE, failed.alias("base_failed"), p_good.alias("p_good"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))
