"""Quality by weak supervision, in DataFrame operations alone.

Labelling rules look at a document's measures and vote good or bad, or abstain. How far each
rule is to be believed is estimated from their agreement over *all* documents, by expectation
maximisation over a histogram of vote patterns, which has at most 3 ** rules rows whatever the
corpus. A document is kept if its posterior probability of being good is at least a half.

No rule is a veto. The accuracies that the rules' agreement tells are then drawn to a prior with the
weight of a fifth of the corpus, which keeps them off 1 however clean the corpus is: a bad vote
weighs some three units of log-odds, and the good votes of all others outweigh it. Rules that look
at the same thing agree by nature: of a group of such, the strongest vote counts in full and the
others by three quarters.
No rule depends on a text's length or script.

Defined results: NULL and empty texts have no words; all measures are 0, every rule abstains,
and they fail the base rules. Repeated rows are judged each, alike. An empty table gives no
rows and the model its starting values. Very long texts are measured whole.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import WORD, let

GOOD, BAD, ABSTAIN = 1, -1, 0
MIN_WORDS = 50
# Of a longer text, distinct words are counted in each stretch of as many words.
WINDOW = 2_000


# --- Measures -----------------------------------------------------------------------


def _repeats(words: Column) -> Column:
    """Words in windows of three that occur twice or more in the text, the first included.

    The windows are sorted with their places, so that equal ones are neighbours; the places of
    those, in order, cover at most three words each, less what the one before covers.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(
            F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("w"), i.alias("at")
        ),
    )
    twice = lambda ws: F.filter(
        ws,
        lambda x, i: F.when(i > 0, F.get(ws, i - 1)["w"] == x["w"]).otherwise(False)
        | F.coalesce(F.get(ws, i + 1)["w"] == x["w"], F.lit(False)),
    )
    places = F.array_sort(F.transform(let(F.array_sort(windows), twice), lambda x: x["at"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda done, at: F.struct(
            at.alias("last"), (done["n"] + F.least(F.lit(3), at - done["last"])).alias("n")
        ),
        lambda done: done["n"],
    )
    return F.when(F.size(words) >= 3, covered).otherwise(F.lit(0)).cast("long")


def _equal_to_an_earlier(lines: Column) -> Column:
    """Lines that an earlier one equals: in sorted order, those equal to the one before."""
    same = lambda sorted_: F.size(
        F.filter(
            sorted_, lambda x, i: F.when(i > 0, F.get(sorted_, i - 1) == x).otherwise(False)
        )
    )
    return let(F.array_sort(lines), same)


def _distinct_in_windows(words: Column) -> Column:
    """Distinct words of each window, added up: as a share of all words it does not fall with length."""

    def of(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes), F.lit(WINDOW))
        added = F.aggregate(
            starts,
            F.lit(0).cast("long"),
            lambda n, at: n + F.size(F.array_distinct(F.slice(hashes, at, F.lit(WINDOW)))),
        )
        return F.when(F.size(hashes) > 0, added).otherwise(F.lit(0).cast("long"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def _count(text: Column, kept: str) -> Column:
    """Characters of a class: the length of the text without all others."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def measures(text: Column) -> Column:
    """A struct of what the rules look at, from a whole text."""

    def of(text: Column) -> Column:
        def of_words(words: Column) -> Column:
            def of_lines(lines: Column) -> Column:
                return F.struct(
                    F.size(words).cast("long").alias("n_words"),
                    F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
                    _count(text, r"#*$%&|<>").alias("n_symbols"),
                    _equal_to_an_earlier(lines).cast("long").alias("n_dup_lines"),
                    _repeats(words).alias("n_repeat_words"),
                    F.size(lines).cast("long").alias("n_lines"),
                    _count(text, r"\p{Lu}").alias("n_capitals"),
                    _count(text, r"\p{L}\p{M}").alias("n_letters"),
                    _count(text, "!").alias("n_exclamations"),
                    F.size(F.filter(words, lambda w: F.length(w) == 1)).cast("long").alias("n_single"),
                    F.size(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))
                    .cast("long").alias("n_distinct"),
                    _distinct_in_windows(words).alias("n_window_distinct"),
                )

            return let(F.filter(F.split(text, "\n", -1), lambda line: F.regexp_like(line, F.lit(WORD))), of_lines)

        return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of_words)

    return let(F.coalesce(text, F.lit("")), of)


# --- Rules --------------------------------------------------------------------------


@dataclass(frozen=True)
class LabelRule:
    """Votes bad from ``bad`` on and good up to ``good`` (or the other way round, if ``bad`` is
    the smaller), of one measure divided by another; between them, or by nothing, it abstains.
    ``windowed`` is the part as measured in windows, the same for texts of up to ``WINDOW`` words."""

    name: str
    part: str
    whole: str
    good: float
    bad: float
    windowed: str | None = None

    def vote(self, of: Column) -> Column:
        ratio = F.try_divide(of[self.windowed or self.part], of[self.whole])  # NULL where there is nothing to divide by
        high = self.bad > self.good
        is_bad = ratio >= self.bad if high else ratio <= self.bad
        is_good = ratio <= self.good if high else ratio >= self.good
        return F.when(is_bad, BAD).when(is_good, GOOD).otherwise(ABSTAIN)


RULES = (
    LabelRule("symbols", "n_symbols", "n_words", 0.02, 0.2),
    LabelRule("repeated words", "n_repeat_words", "n_words", 0.15, 0.5),
    LabelRule("repeated lines", "n_dup_lines", "n_lines", 0.1, 0.4),
    LabelRule("few distinct words", "n_distinct", "n_words", 0.35, 0.15, "n_window_distinct"),
    LabelRule("capitals", "n_capitals", "n_letters", 0.15, 0.4),
    LabelRule("exclamations", "n_exclamations", "n_words", 0.05, 0.4),
    LabelRule("letters", "n_letters", "word_chars", 0.85, 0.75),
    LabelRule("single characters", "n_single", "n_words", 0.25, 0.4),
)


def votes(of: Column, rules: Sequence[LabelRule] = RULES) -> Column:
    return F.array(*[r.vote(of) for r in rules])


# --- Model --------------------------------------------------------------------------

# Rules that look at the same thing, by their place in RULES.
GROUPS = ((0, 6, 7), (1, 2, 3), (4, 5))
# What a vote weighs in a group beside the strongest one.
DEPENDENT = 0.75
# How often rules are right of good and of bad documents, before any were seen, and the weight of
# that as a share of all documents.
PRIOR_GOOD, PRIOR_BAD, PRIOR_MASS = 0.9, 0.3, 0.2


@dataclass
class Model:
    """The share of good documents, and per rule how often its vote is right: of good documents
    on which it votes, and of bad ones. ``groups`` are the places of rules that depend on each other."""

    prior: float = 0.85
    right_on_good: list[float] = field(default_factory=list)
    right_on_bad: list[float] = field(default_factory=list)
    groups: Sequence[Sequence[int]] = ()

    @classmethod
    def start(cls, rules: int) -> Model:
        """Rules rarely accuse a good document, and each knows one kind of bad ones."""
        return cls(0.85, [0.97] * rules, [0.3] * rules)

    def weights(self) -> list[tuple[float, float]]:
        """Per rule, what a good and a bad vote add to the log-odds of good."""
        return [
            (math.log(g / (1 - b)), math.log((1 - g) / b))
            for g, b in zip(self.right_on_good, self.right_on_bad, strict=True)
        ]

    def _parts(self) -> list[Sequence[int]]:
        grouped = {i for group in self.groups for i in group}
        return [*self.groups, *([i] for i in range(len(self.right_on_good)) if i not in grouped)]

    def log_odds(self, pattern: Sequence[int]) -> float:
        total, weights = math.log(self.prior / (1 - self.prior)), self.weights()
        for part in self._parts():
            own = [weights[i][0] if pattern[i] == GOOD else weights[i][1] if pattern[i] == BAD else 0.0 for i in part]
            strongest = max(max(own), -min(own)) * (1 if max(own) >= -min(own) else -1)
            total += DEPENDENT * sum(own) + (1 - DEPENDENT) * strongest
        return total

    def posterior(self, votes: Column) -> Column:
        """Probability of good, as an expression over a votes array."""
        total, weights = F.lit(math.log(self.prior / (1 - self.prior))), self.weights()
        for part in self._parts():
            own = [F.when(votes[i] == GOOD, weights[i][0]).when(votes[i] == BAD, weights[i][1]).otherwise(0.0) for i in part]
            high, low = (own[0], own[0]) if len(own) == 1 else (F.greatest(*own), F.least(*own))
            strongest = F.when(high >= -low, high).otherwise(low)
            total = total + DEPENDENT * reduce(lambda x, y: x + y, own) + (1 - DEPENDENT) * strongest
        return 1 / (1 + F.exp(-total))


def estimate(
    histogram: Sequence[tuple[Sequence[int], int]],
    rules: int,
    *,
    groups: Sequence[Sequence[int]] = (),
    mass: float = PRIOR_MASS,
    rounds: int = 500,
    settled: float = 1e-7,
) -> Model:
    """Expectation maximisation over (votes, documents) pairs, each pattern once, with votes taken for
    independent and smoothed by one document, half right and half wrong. At the end accuracies are
    drawn to their prior with the weight of ``mass`` of all documents, and ``groups`` are heeded."""

    def told(believed: list[tuple], weight: float, right: tuple[float, float]) -> Model:
        new = Model((sum(n * q for _, n, q in believed) + 0.5) / (total + 1), [], [])
        for i in range(rules):
            good = sum(n * q for p, n, q in believed if p[i] == GOOD)
            wronged = sum(n * q for p, n, q in believed if p[i] == BAD)
            caught = sum(n * (1 - q) for p, n, q in believed if p[i] == BAD)
            missed = sum(n * (1 - q) for p, n, q in believed if p[i] == GOOD)
            new.right_on_good.append((good + weight * right[0]) / (good + wronged + weight))
            new.right_on_bad.append((caught + weight * right[1]) / (caught + missed + weight))
        return new

    model = Model.start(rules)
    rows = sorted((tuple(p), n) for p, n in histogram)
    total = sum(n for _, n in rows)
    believed: list[tuple] = []
    for _ in range(rounds if total else 0):
        believed = [(p, n, 1 / (1 + math.exp(-max(-700.0, min(700.0, model.log_odds(p)))))) for p, n in rows]
        new = told(believed, 1, (0.5, 0.5))
        moved = max(
            abs(a - b)
            for a, b in zip(
                [model.prior, *model.right_on_good, *model.right_on_bad],
                [new.prior, *new.right_on_good, *new.right_on_bad],
                strict=True,
            )
        )
        model = new
        if moved < settled:
            break
    if believed and mass:
        model = told(believed, mass * total + 1, (PRIOR_GOOD, PRIOR_BAD))
    model.groups = groups
    return model


def fit(measured: DataFrame, of: str, rules: Sequence[LabelRule] = RULES) -> Model:
    """The model of a stored table whose column ``of`` has the measures. What comes to the driver
    is one row per vote pattern that occurs, of 3 ** rules at most."""
    patterns = measured.filter(F.col(of)["n_words"] > 0).groupBy(votes(F.col(of), rules).alias("votes")).count()
    groups = GROUPS if rules is RULES else ()
    return estimate([(r["votes"], r["count"]) for r in patterns.collect()], len(rules), groups=groups)


def base_failed(of: Column) -> Column:
    return (of["n_words"] < MIN_WORDS) | (100 * of["n_repeat_words"] > 50 * of["n_words"])


def judge(measured: DataFrame, of: str, rules: Sequence[LabelRule] = RULES) -> DataFrame:
    """A stored table with ``posterior``, ``base_failed`` and ``kept``."""
    model, it = fit(measured, of, rules), F.col(of)
    judged = measured.withColumns(
        {"posterior": model.posterior(votes(it, rules)), "base_failed": base_failed(it)}
    )
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))
