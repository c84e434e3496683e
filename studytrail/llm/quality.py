"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

A rule says "good", "bad" or nothing. How often a rule speaks on good and on bad documents
is estimated without labels, from the counts of the vote patterns (at most 2^rules rows,
whatever the corpus). A document is kept if its posterior probability of being good is at
least one half, so a single odd sign does not decide against an otherwise sound text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studytrail.llm.common import SPACE_CLASS, kept, packed, whole, words

WINDOW = 5
ROUNDS = 25
# How often a rule speaks on good and on bad documents, and the share of good ones, before a
# document was seen; they weigh as many documents as the second figures say.
START, START_WEIGHT = {"good": (0.9, 0.5), "bad": (0.05, 0.5)}, 2
PRIOR, PRIOR_WEIGHT = 0.8, 10

# (name, vote, condition on the measures); conditions read the same in DuckDB.
RULES = [
    ("symbols", "bad", "100 * n_symbols > 20 * n_words"),
    ("separators", "bad", "100 * n_bare > 10 * n_words"),
    ("capitals", "bad", "100 * n_upper > 40 * n_letters"),
    ("exclamations", "bad", "100 * n_bangs > 20 * n_words"),
    ("repeated_lines", "bad", "100 * n_dup_lines > 30 * n_lines"),
    ("repeated_words", "bad", "100 * n_repeat_words > 10 * n_words"),
    ("letters", "good", "100 * n_letters >= 85 * word_chars and n_letters > 0"),
    ("case", "good", "100 * n_upper <= 20 * n_letters and n_letters > 0"),
    ("word_length", "good", "word_chars >= 2 * n_words and word_chars <= 12 * n_words and n_words > 0"),
    ("variety", "good", "(5 * n_distinct >= n_words or n_distinct >= 200) and n_words > 0"),
    ("sentences", "good", "100 * n_ends >= n_words and 100 * n_ends <= 50 * n_words and n_words > 0"),
]
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_upper", "n_bare", "n_bangs", "n_ends", "n_distinct",
]
BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


def _left(text: Column, pattern: str) -> Column:
    """Code points that stay when the pattern's matches go."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("bigint")


def measured(docs: DataFrame) -> DataFrame:
    """(row, __m): the columns of ``docs`` and the measures, counted over the whole text."""
    given = ["row"]
    df = packed(docs).select(*given, whole("row.text").alias("__t"))
    df = df.select(*given, "__t", words(F.col("__t")).alias("__w"))
    lines = F.filter(F.split("__t", "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = df.select(*given, "__t", F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"), lines.alias("__l"))
    at = [lambda i, k=k: F.get("__h", i + k) for k in range(WINDOW)]
    starts = F.sequence(F.lit(0), F.size("__h") - WINDOW)
    windows = F.when(F.size("__h") >= WINDOW, F.transform(starts, lambda i: F.xxhash64(*[f(i) for f in at])))
    df = df.select(*given, "__t", "__h", "__l", windows.alias("__g"))
    # Sorted by hash, equal windows are neighbours; their places are sorted back.
    has_copies = F.size(F.array_distinct("__g")) < F.size("__g")
    ordered = F.sort_array(F.transform("__g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    df = df.select(*given, "__t", "__h", "__l", F.when(has_copies, ordered).alias("__s"))
    twin = lambda e, i: (e.x == F.get("__s", i - 1).x) | (e.x == F.get("__s", i + 1).x)
    places = F.sort_array(F.transform(F.filter("__s", twin), lambda e: e.i))
    df = df.select(*given, "__t", "__h", "__l", places.alias("__p"))
    step = lambda n, i: n + F.coalesce(F.least(F.lit(WINDOW), F.get("__p", i + 1) - F.get("__p", i)), F.lit(WINDOW))
    repeated = F.aggregate(F.sequence(F.lit(0), F.size("__p") - 1), F.lit(0), step)
    t = F.col("__t")
    counts = {
        "n_words": F.size("__h"),
        "word_chars": _left(t, SPACE_CLASS + "+"),
        "n_symbols": _left(t, "[^#*$%&|<>]+"),
        "n_dup_lines": F.size("__l") - F.size(F.array_distinct("__l")),
        "n_repeat_words": F.when(F.size("__p") > 0, repeated).otherwise(0),
        "n_lines": F.size("__l"),
        "n_letters": _left(t, r"\P{L}+"),
        "n_upper": _left(t, r"\P{Lu}+"),
        "n_bare": F.regexp_count(t, F.lit(r"(?:^|[\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}\p{N}]+(?![^\x20\x09-\x0D])")),
        "n_bangs": _left(t, "[^!]+"),
        "n_ends": F.regexp_count(t, F.lit(r"[.!?]+(?![^\x20\x09-\x0D])")),
        "n_distinct": F.size(F.array_distinct("__h")),
    }
    return df.select(*given, F.struct(*[counts[m].cast("bigint").alias(m) for m in MEASURES]).alias("__m"))


def voted(docs: DataFrame) -> DataFrame:
    """(row, __m, __v): ``measured`` with ``__v``, the bit mask of the rules that speak."""
    df = measured(docs)
    mask = F.lit(0)
    for bit, (_, _, condition) in enumerate(RULES):
        mask = mask + F.when(_holds(condition), 1 << bit).otherwise(0)
    return df.withColumn("__v", mask)


def _holds(condition: str) -> Column:
    """The condition over the measures in ``__m``."""
    return F.expr(re.sub(r"\b(%s)\b" % "|".join(MEASURES), r"__m.\1", condition))


def vote_counts(votes: DataFrame) -> dict[int, int]:
    """Documents of each vote pattern; the base rule's failures do not teach the others."""
    told = votes.filter(~_holds(BASE_FAILED))
    return {r["__v"]: r["n"] for r in told.groupBy("__v").agg(F.count(F.lit(1)).alias("n")).collect()}


@dataclass(frozen=True)
class Model:
    """P(good), and per rule how often it speaks on good and on bad documents."""

    prior: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def log_odds(self, mask: int) -> float:
        odds = math.log(self.prior / (1 - self.prior))
        for bit, (g, b) in enumerate(zip(self.on_good, self.on_bad)):
            odds += math.log(g / b) if mask >> bit & 1 else math.log((1 - g) / (1 - b))
        return odds

    def probability(self, mask: int) -> float:
        return 1 / (1 + math.exp(-self.log_odds(mask)))


def fit(counts: Mapping[int, int], rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over the vote patterns; an empty corpus gives the start values.

    Rates are free between 0 and 1. A rule that speaks more often on the class it speaks
    against is worse than chance and gets its common rate on both classes, so it says nothing
    in that round; this also keeps the classes from changing places."""
    start = [START[vote] for _, vote, _ in RULES]
    model = Model(PRIOR, tuple(g for g, _ in start), tuple(b for _, b in start))
    total = sum(counts.values())
    for _ in range(rounds if total else 0):
        good = {mask: n * model.probability(mask) for mask, n in counts.items()}
        n_good = sum(good.values())
        rates = []
        for bit, (_, vote, _) in enumerate(RULES):
            g, b = START[vote]
            spoke_good = sum(w for mask, w in good.items() if mask >> bit & 1)
            spoke = sum(n for mask, n in counts.items() if mask >> bit & 1)
            on_good = (spoke_good + START_WEIGHT * g) / (n_good + START_WEIGHT)
            on_bad = (spoke - spoke_good + START_WEIGHT * b) / (total - n_good + START_WEIGHT)
            if (on_good < on_bad) == (vote == "good"):
                on_good = on_bad = (spoke + START_WEIGHT * (g + b)) / (total + 2 * START_WEIGHT)
            rates.append((on_good, on_bad))
        prior = (n_good + PRIOR_WEIGHT * PRIOR) / (total + PRIOR_WEIGHT)
        model = Model(prior, tuple(g for g, _ in rates), tuple(b for _, b in rates))
    return model


def verdict(model: Model, mask: Column) -> Column:
    """True where the posterior is at least one half."""
    odds = F.lit(math.log(model.prior / (1 - model.prior)))
    for bit, (g, b) in enumerate(zip(model.on_good, model.on_bad)):
        spoke = F.shiftright(mask, bit).bitwiseAND(1) == 1
        odds = odds + F.when(spoke, math.log(g / b)).otherwise(math.log((1 - g) / (1 - b)))
    return odds >= 0


def _decided(votes: DataFrame, model: Model) -> DataFrame:
    return votes.withColumn("__failed", _holds(BASE_FAILED)).withColumn("__kept", ~F.col("__failed") & verdict(model, F.col("__v")))


def assessed(docs: DataFrame) -> DataFrame:
    """doc_id, the base measures, base_failed, votes (bit mask in the order of RULES), kept.

    One row per input row, null ids included. A null or empty text has zero words and fails
    the base rule. Repeated rows count and are judged each. An empty table gives no rows."""
    light = kept(voted(docs.select("doc_id", "text")).select("row.doc_id", "__m", "__v"), "quality-votes")
    decided = _decided(light, fit(vote_counts(light)))
    base = [F.col(f"__m.{m}").alias(m) for m in MEASURES[:5]]
    return decided.select("doc_id", *base, F.col("__failed").alias("base_failed"), F.col("__v").alias("votes"), F.col("__kept").alias("kept"))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    votes = kept(voted(docs), "quality-votes")
    return _decided(votes, fit(vote_counts(votes))).filter("__kept").select("row.*")
