"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Only DataFrame operations: the measures of a text are array expressions over its words, votes are
compared with fixed bounds, and each EM round is one aggregation over the table of distinct vote
patterns, of which there are at most 3 to the number of rules (8) however many documents there are.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilframe.llm.common import staged

BLANK = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]"
#: Words of a window that must not come twice.
WINDOW = 8
#: Base limits: fewest words, and the largest share of words in repeated windows, in percent.
LEAST_WORDS, MOST_REPEATED = 20, 30

#: Measures that should be low, as a count by a count: fine up to, bad from. The rule of each votes
#: bad or abstains.
LOW = {
    "symbols": ("n_symbols", "n_words", 0.05, 0.15),
    "repeats": ("n_repeat_words", "n_words", 0.2, 0.3),
    "lines": ("n_dup_lines", "n_lines", 0.35, 0.5),
    "capitals": ("n_capitals", "word_chars", 0.25, 0.4),
    "shouts": ("n_shouts", "n_words", 0.1, 0.25),
}
#: Words of a usable length; the rule votes bad outside.
WORD_LENGTH = (2.5, 14.0)
#: Different words to the square root of all words; the rule votes bad below.
VARIETY = 1.2
#: ``clean`` votes good where all measures of LOW are fine. Any one kind of junk looks good to the
#: rules for the other kinds, so these say nothing rather than good.
RULES = (*LOW, "word_length", "variety", "clean")
#: Rounds of EM; share of good documents taken for granted; accuracy a rule starts from and, with
#: the weight of so many votes, is drawn to; its bounds; posterior from which a text is kept.
ROUNDS, EVEN, ACCURACY, WEIGHT, BOUNDS, KEEP_FROM = 15, 0.5, 0.9, 50, (0.55, 0.995), 0.5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id and what the rules look at; null text is empty."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = docs.select(F.col(f"`{doc_id}`").alias("id"), body.alias("body")).select(
        "id", "body",
        F.array_remove(F.split("body", f"{BLANK}+"), "").alias("words"),
        F.filter(F.split("body", "\n"), lambda line: line.rlike(WORD)).alias("lines"),
    )
    # Every array is used at least twice, so that none is inlined into another's lambda.
    counted = words.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("body", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("body", F.lit("[\\p{Lu}]")).cast("long").alias("n_capitals"),
        F.regexp_count("body", F.lit("!")).cast("long").alias("n_shouts"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    kept = [c for c in counted.columns if c != "hashes"]
    windowed = counted.select(
        *kept,
        F.size(F.array_distinct("hashes")).cast("long").alias("n_distinct"),
        F.when(
            F.size("hashes") >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("hashes") - (WINDOW - 1)),
                lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    kept.append("n_distinct")
    ordered = windowed.select(
        *kept,
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform(
                "windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))),
        ).alias("ordered"),
    )
    twice = F.filter(
        "ordered",
        lambda x, i: F.coalesce(F.get("ordered", i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("ordered", i + 1)["h"] == x["h"], F.lit(False)),
    )
    at = F.sort_array(F.transform(twice, lambda x: x["at"]))
    covered = F.aggregate(
        at,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct(
            (a["n"] + p + WINDOW - F.greatest(a["end"], p)).alias("n"), (p + WINDOW).alias("end")),
    )["n"]
    return ordered.select(
        *kept, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")
    )


def votes() -> dict[str, Column]:
    """1 good, -1 bad, 0 no opinion, also where a measure is undefined, as without words."""
    share = {n: F.try_divide(count, of) for n, (count, of, _, _) in LOW.items()}
    found = {n: F.when(share[n] >= bad, -1).otherwise(0) for n, (_, _, _, bad) in LOW.items()}
    length = F.try_divide("word_chars", "n_words")
    found["word_length"] = F.when(~length.between(*WORD_LENGTH), -1).otherwise(0)
    variety = F.try_divide("n_distinct", F.sqrt("n_words"))
    found["variety"] = F.when(variety < VARIETY, -1).otherwise(0)
    fine = reduce(Column.__and__, (share[n] <= fine for n, (_, _, fine, _) in LOW.items()))
    found["clean"] = F.when(fine, 1).otherwise(0)
    return found


def _log_odds(accuracy: dict[str, float]) -> Column:
    """Logarithm of good against bad, given the votes; an abstention says nothing."""
    terms = (F.col(r) * math.log(a / (1 - a)) for r, a in accuracy.items())
    return sum(terms, F.lit(math.log(EVEN / (1 - EVEN))))


def _posterior(accuracy: dict[str, float]) -> Column:
    return 1 / (1 + F.exp(-_log_odds(accuracy)))


def fit(patterns: DataFrame, rounds: int = ROUNDS) -> dict[str, float]:
    """Each rule's accuracy, by EM over the counted vote patterns ``(rules..., n)``: the expected
    share of its votes that agree with the hidden class. A rule without votes keeps its prior."""
    accuracy = dict.fromkeys(RULES, ACCURACY)
    for _ in range(rounds):
        good = _posterior(accuracy)
        right = patterns.select(
            "n", *(
                c for r in RULES for c in (
                    (F.abs(r) * F.col("n")).alias(f"{r}_votes"),
                    (F.when(F.col(r) > 0, good).when(F.col(r) < 0, 1 - good).otherwise(0.0)
                     * F.col("n")).alias(f"{r}_right"),
                )
            )
        )
        row = right.groupBy().sum().first()
        for rule in RULES:
            votes_, right_ = (row[f"sum({rule}_{c})"] or 0 for c in ("votes", "right"))
            share = (right_ + WEIGHT * ACCURACY) / (votes_ + WEIGHT)
            accuracy[rule] = min(max(share, BOUNDS[0]), BOUNDS[1])
    return accuracy


def assess(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, measures, one vote per rule, ``base_failed``, ``quality`` (the
    posterior probability of being good, even without votes) and ``kept``.

    Null, empty and blank texts have no words and fail the base limits. Equal texts get equal
    verdicts, repeated rows and null ids one row each; other columns are ignored.
    """
    measured = staged(measures(docs, doc_id, text))
    voted = measured.select("*", *(v.alias(n) for n, v in votes().items()))
    patterns = staged(voted.groupBy(*RULES).agg(F.count("*").alias("n")).coalesce(1))
    accuracy = fit(patterns)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return (
        voted.withColumn("base_failed", failed)
        .withColumn("quality", _posterior(accuracy))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM))
        .withColumnRenamed("id", doc_id)
    )


def filtered(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are kept, by id."""
    keep = assess(docs, doc_id, text).where("kept").select(f"`{doc_id}`").distinct()
    return docs.join(keep, doc_id, "left_semi")
